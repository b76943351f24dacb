"""One key holding a third of all rows must give the same answers (the plans
pre-aggregate before shuffling; AQE splits skewed join partitions)."""
import datetime as dt

from tessera.operators import cleaning as K
from tessera.plans import lifecycle, zones


def test_hot_passenger_churn(spark):
    rows = []
    for i in range(600):                     # passenger 1 holds a third of the journeys
        rows.append((1, i, dt.datetime(2019, 1, 1), dt.date(2019, 1 + (i % 6), 1 + (i % 28))))
    for p in range(2, 1202):
        rows.append((p, 10_000 + p, dt.datetime(2019, 2, 1), dt.date(2019, 2, 1 + p % 27)))
    j = spark.createDataFrame(rows, "passenger_id long, journey_id long, "
                                    "passenger_first_completed_ts_loc timestamp_ntz, completed_dt_loc date")
    u = spark.createDataFrame([(p, "X", "Y", "web") for p in range(1, 1202)],
                              "user_id long, country_code string, city string, last_attribution_channel string")
    out = {str(r.month): r for r in lifecycle.churn_monthly(j, u, "2019-12-15").collect()}
    assert out["2019-01-01"].new == 1
    assert out["2019-02-01"].retained == 1 and out["2019-02-01"].new == 1200
    assert out["2019-03-01"].churned == 1200 and out["2019-07-01"].churned == 1


def test_hot_duplicate_group(spark):
    rows = [(1, "hot")] * 500 + [(i, "cold") for i in range(1000)]
    df = spark.createDataFrame(rows, "k long, v string")
    s = K.duplicate_summary(df).first()
    assert (s.n_rows, s.n_duplicate_rows) == (1500, 499)
    assert K.duplicate_rows(df).count() == 499


def test_select_trips_filter_pushdown(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2018, 12, 31), "London", "done"), (dt.datetime(2019, 1, 2), "London", "done"),
                                (dt.datetime(2019, 1, 2), "Paris", "done"), (dt.datetime(2019, 1, 2), "London", "failed")],
                               "completed_ts_loc timestamp_ntz, city string, status string")
    p = str(tmp_path / "journeys")
    df.write.parquet(p)
    sel = zones.select_trips(spark.read.parquet(p), "2019-01-01", "London", "done")
    assert sel.count() == 1
    plan = spark._jvm.PythonSQLUtils.explainString(sel._jdf.queryExecution(), "formatted")
    assert "PushedFilters" in plan and "EqualTo(city,London)" in plan
