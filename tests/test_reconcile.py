import datetime as dt

import pytest

from tessera.functions.exprs import object_id_bound, object_id_hex
from tessera.plans import reconcile as R

SPEC = R.ReconcileSpec("orders", "analytics.f_requests", "requested_ts_utc",
                       {"price": "price_loc", "credit": "discount_loc"})


def _oid(ts: dt.datetime, k: int) -> str:
    secs = int(ts.replace(tzinfo=dt.timezone.utc).timestamp())
    return f"{secs:08x}{k:016x}"


@pytest.fixture()
def stores(spark):
    d1, d2, d3 = dt.datetime(2019, 1, 1, 10), dt.datetime(2019, 1, 2, 11), dt.datetime(2019, 1, 3, 12)
    src = spark.createDataFrame([
        (_oid(d1, 1), d1, 10.125, 1.0, None),
        (_oid(d1, 2), d1, 0.0, None, None),
        (_oid(d2, 3), d2, 0.0, 0.0, None),      # source sum 0 → pct NULL
        (_oid(dt.datetime(2019, 1, 5), 9), dt.datetime(2019, 1, 5), 7.0, 7.0, None),   # outside window
    ], "_id string, created_at timestamp_ntz, price double, credit double, ghost double")
    tgt = spark.createDataFrame([
        (d1, 10.0, 1.0), (d1, 0.0, None),
        (d3, 5.0, 5.0),                          # day only in target → lost
    ], "requested_ts_utc timestamp_ntz, price_loc double, discount_loc double")
    return src, tgt


def test_counts_left_join_semantics(spark, stores):
    src, tgt = stores
    out = R.reconcile_window(src, tgt, SPEC, "docs_level", "2019-01-01", "2019-01-04", "2020-01-01 00:00:00")
    got = {str(r.day): (r.source_cnt, r.target_cnt, r.diff_abs, r.diff_pct) for r in out.collect()}
    assert got == {"2019-01-01": (2, 2, 0.0, 0.0), "2019-01-02": (1, 0, 1.0, 100.0)}
    assert out.columns == ["run_ts_utc", "source_collection", "target_table", "day", "source_cnt",
                           "target_cnt", "diff_abs", "diff_pct"]


def test_sums_rounding_unmapped_and_zero(spark, stores):
    src, tgt = stores
    spec = R.ReconcileSpec("orders", "t", "requested_ts_utc", {"price": "price_loc", "credit": "discount_loc"})
    out = R.reconcile_window(src, tgt, spec, "fields_level", "2019-01-01", "2019-01-04", "2020-01-01 00:00:00")
    got = {(str(r.day), r.source_field): (r.target_column, r.source_sum, r.target_sum, r.diff_abs, r.diff_pct)
           for r in out.collect()}
    assert got[("2019-01-01", "price")] == ("price_loc", 10.12, 10.0, 0.12, 1.19)   # 10.125 → 10.12 (half-even)
    assert got[("2019-01-01", "credit")] == ("discount_loc", 1.0, 1.0, 0.0, 0.0)
    assert got[("2019-01-02", "price")] == ("price_loc", 0.0, 0.0, 0.0, None)        # 0/0 → NULL, not NaN
    assert ("2019-01-03", "price") not in got


def test_all_null_field_and_shared_target_column(spark, stores):
    src, tgt = stores
    spec = R.ReconcileSpec("orders", "t", "requested_ts_utc", {"price": "price_loc", "ghost": "discount_loc"})
    out = R.reconcile_window(src, tgt, spec, "fields_level", "2019-01-01", "2019-01-02", "2020-01-01 00:00:00")
    ghost = [r for r in out.collect() if r.source_field == "ghost"][0]
    # an all-NULL source field sums to 0; the percent drift over a 0 source is NULL, not inf
    assert (ghost.target_column, ghost.source_sum, ghost.target_sum, ghost.diff_abs, ghost.diff_pct) == \
        ("discount_loc", 0.0, 1.0, -1.0, None)


def test_batch_windows_and_exclusive_bound(spark, stores):
    src, tgt = stores
    res = R.reconcile_batch({"orders": src}, {"analytics.f_requests": tgt}, [SPEC], ["docs_level"],
                            [("2019-01-01", "2019-01-02"), ("2019-01-01", "2019-01-06")], "2020-01-01 00:00:00")
    rows = {(str(r.window_to), str(r.day)): r.source_cnt for r in res["docs_level"].collect()}
    assert rows == {("2019-01-02", "2019-01-01"): 2, ("2019-01-06", "2019-01-01"): 2,
                    ("2019-01-06", "2019-01-02"): 1, ("2019-01-06", "2019-01-05"): 1}


def test_unknown_mode_rejected(spark, stores):
    src, tgt = stores
    with pytest.raises(ValueError):
        R.reconcile_window(src, tgt, SPEC, "rows_level", "2019-01-01", "2019-01-02", "2020-01-01 00:00:00")


def test_specs_from_settings():
    specs = R.specs_from_settings({"stock": {"source_collection": "items", "target_table": "dw.stock", "target_ts_column": "loaded_at",
                                             "columns_map": {"pieces": "qty"}}})
    assert specs["stock"] == R.ReconcileSpec("items", "dw.stock", "loaded_at", {"pieces": "qty"})


def test_ids_are_utc_in_any_session_zone(spark, stores):
    from pyspark.sql import functions as F
    zone = spark.conf.get("spark.sql.session.timeZone")
    src, tgt = stores
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        one = spark.range(1).select(object_id_bound(F.lit("2019-01-01").cast("date")).alias("b"),
                                    object_id_hex(F.lit("2019-01-01 10:00:00").cast("timestamp_ntz"), F.lit(1)).alias("h")).first()
        assert one.b == "5c2aad80" + "0" * 16 and one.h == _oid(dt.datetime(2019, 1, 1, 10), 1)
        out = R.reconcile_window(src, tgt, SPEC, "docs_level", "2019-01-01", "2019-01-04", "2020-01-01 00:00:00")
        assert {str(r.day): r.source_cnt for r in out.collect()} == {"2019-01-01": 2, "2019-01-02": 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
