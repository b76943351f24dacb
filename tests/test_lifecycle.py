import datetime as dt

from tessera.plans import lifecycle

AS_OF = "2020-03-15"


def _m(y, m):
    return dt.date(y, m, 1)


def brute_force(journeys, users, as_of):
    """The reference SQL evaluated literally in Python."""
    cutoff = dt.date.fromisoformat(as_of).replace(day=1)
    first = {}
    for pid, _jid, first_ts, day in journeys:
        first[pid] = first_ts
    active = sorted({(pid, first_ts.date().replace(day=1), day.replace(day=1))
                     for pid, _jid, first_ts, day in journeys if day < cutoff})
    per = {}
    for pid, fm, m in active:
        per.setdefault(pid, []).append((fm, m))
    md = (lambda a, b: (b.year - a.year) * 12 + b.month - a.month)
    rows = set()
    for pid, lst in per.items():
        lst.sort(key=lambda x: x[1])
        for i, (fm, m) in enumerate(lst):
            prev = lst[i - 1][1] if i else None
            nxt = lst[i + 1][1] if i + 1 < len(lst) else None
            rows.add((pid, m, fm == m, prev is not None and md(prev, m) == 1,
                      prev is not None and md(prev, m) > 1, False))
            if nxt is None or md(m, nxt) != 1:
                nm = (m.replace(year=m.year + 1, month=1) if m.month == 12 else m.replace(month=m.month + 1))
                rows.add((pid, nm, False, False, False, True))
    out = {}
    for pid, m, *flags in rows:
        if m >= cutoff or pid not in users:
            continue
        for u in users[pid]:
            key = (u[0], u[1], u[2], m)
            sets = out.setdefault(key, [set(), set(), set(), set()])
            for k, f in enumerate(flags):
                if f:
                    sets[k].add(pid)
    return sorted(k + tuple(len(s) for s in v) for k, v in out.items())


def test_churn_edge_cases_against_brute_force(spark):
    ts = lambda y, m, d=1: dt.datetime(y, m, d)
    journeys = [
        (1, 10, ts(2019, 5), dt.date(2019, 5, 3)),                         # single month
        (2, 20, ts(2019, 6), dt.date(2019, 6, 1)), (2, 21, ts(2019, 6), dt.date(2019, 7, 9)),   # gap of 1
        (3, 30, ts(2019, 6), dt.date(2019, 6, 2)), (3, 31, ts(2019, 6), dt.date(2019, 8, 2)),   # gap of 2
        (4, 40, ts(2019, 12, 5), dt.date(2019, 12, 5)), (4, 41, ts(2019, 12, 5), dt.date(2020, 1, 7)),  # Dec→Jan
        (5, 50, ts(2019, 9), dt.date(2019, 9, 9)),                         # not in users
        (6, 60, ts(2020, 2), dt.date(2020, 2, 1)), (6, 61, ts(2020, 2), dt.date(2020, 3, 2)),   # current month
        (7, 70, ts(2019, 1), dt.date(2019, 1, 1)), (7, 71, ts(2019, 1), dt.date(2019, 1, 20)),  # two rides, one month
    ]
    users = {1: [("UK", "London", "web")], 2: [("UK", "London", "app")], 3: [("UK", "Leeds", "web")],
             4: [("FR", "Paris", "app")], 6: [("FR", "Paris", "web")], 7: [("UK", "London", "web")]}
    jdf = spark.createDataFrame(
        journeys, "passenger_id long, journey_id long, passenger_first_completed_ts_loc timestamp_ntz, "
                  "completed_dt_loc date")
    udf = spark.createDataFrame([(k, *v[0]) for k, v in users.items()],
                                "user_id long, country_code string, city string, last_attribution_channel string")
    got = sorted(tuple(r) for r in lifecycle.churn_monthly(jdf, udf, AS_OF).collect())
    assert got == brute_force(journeys, users, AS_OF)
    # the December user is retained in January, and churned in February
    assert ("FR", "Paris", "app", _m(2020, 1), 0, 1, 0, 0) in got
    assert ("FR", "Paris", "app", _m(2020, 2), 0, 0, 0, 1) in got
    # the current month (March 2020) never appears
    assert all(r[3] < _m(2020, 3) for r in got)


def test_state_rows_are_unique_per_passenger_month(spark):
    ts = dt.datetime(2019, 1, 1)
    jdf = spark.createDataFrame([(1, 1, ts, dt.date(2019, 1, 5)), (1, 2, ts, dt.date(2019, 3, 5))],
                                "passenger_id long, journey_id long, passenger_first_completed_ts_loc timestamp_ntz, "
                                "completed_dt_loc date")
    st = lifecycle.user_month_states(jdf, "2019-12-01").orderBy("month").collect()
    assert [(str(r.month), r.is_new, r.is_reactivated, r.is_churned) for r in st] == [
        ("2019-01-01", True, False, False), ("2019-02-01", False, False, True),
        ("2019-03-01", False, True, False), ("2019-04-01", False, False, True)]


def test_two_first_ride_dates_do_not_repeat_churn_rows(spark):
    import datetime as dt
    d = dt.date(2019, 3, 5)
    j = spark.createDataFrame([(1, 10, dt.datetime(2019, 3, 1), d), (1, 11, dt.datetime(2018, 1, 1), d), (1, 12, dt.datetime(2017, 1, 1), d)],
                              "passenger_id long, journey_id long, passenger_first_completed_ts_loc timestamp_ntz, completed_dt_loc date")
    got = sorted(tuple(r)[1:] for r in lifecycle.user_month_states(j, "2019-12-15").collect())
    assert got == [(dt.date(2019, 3, 1), False, False, False, False), (dt.date(2019, 3, 1), True, False, False, False),
                   (dt.date(2019, 4, 1), False, False, False, True)]


def test_single_months_equal_the_full_run(spark, tmp_path):
    import random

    from pyspark.sql import functions as F

    from tessera.sources import sinks
    rng = random.Random(7)
    rows = []
    for pid in [*range(40), None]:
        first = dt.datetime(2019, 1, 1) + dt.timedelta(days=rng.randint(0, 600), hours=5)
        for j in range(rng.randint(1, 14)):
            day = (first + dt.timedelta(days=int(rng.expovariate(1 / 120)) if j else 0)).date()
            rows.append((pid, j, first, min(day, dt.date(2021, 2, 27))))
    journeys = spark.createDataFrame(rows, "passenger_id long, journey_id long, passenger_first_completed_ts_loc timestamp_ntz, completed_dt_loc date")
    path, state, table = (str(tmp_path / n) for n in ("journeys", "state", "table"))
    sinks.write_partitioned_table(journeys.withColumn("month", F.trunc("completed_dt_loc", "month")), path, "month")
    months = [f"{2019 + k // 12}-{k % 12 + 1:02d}-01" for k in range(24)]
    for month in [*months[:5], months[4], *months[5:]]:  # one month twice: a repeated run changes nothing
        lifecycle.refresh_month(spark, path, state, table, month)
    columns = ["passenger_id", "month", *lifecycle.STATES]
    key = lambda r: tuple(map(str, r))
    full = lifecycle.user_month_states(journeys, "2021-01-01").where("month < '2021-01-01'").select(*columns)
    again = spark.read.parquet(table).select(*columns)
    want = sorted(map(tuple, full.collect()), key=key)
    assert len(want) > 150 and any(r[5] for r in want) and sorted(map(tuple, again.collect()), key=key) == want
    one = spark.read.parquet(path).where(F.col("month") == F.lit("2020-03-01").cast("date"))
    plan = lifecycle.month_states(one, spark.read.parquet(f"{state}/month=2020-02-01"), "2020-03-01")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in text and "2020-03-01" in text


def test_journeys_are_dealt_by_passenger_into_parts_of_their_count(spark, tmp_path, monkeypatch):
    from tessera.catalog import QUERIES
    k = spark.range(2000)
    k.selectExpr("id as o_orderkey", "id % 400 + 1 as o_custkey", "timestamp_ntz'1995-01-01' + make_interval(0, int(id % 60)) as o_orderdate").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(400).selectExpr("id + 1 as c_custkey", "id % 5 as c_nationkey", "'A' as c_mktsegment").write.parquet(str(tmp_path / "customer.parquet"))
    spark.range(5).selectExpr("id as n_nationkey", "concat('n', id) as n_name", "0L as n_regionkey").write.parquet(str(tmp_path / "nation.parquet"))
    spark.range(1).selectExpr("id as r_regionkey", "'r' as r_name").write.parquet(str(tmp_path / "region.parquet"))
    whole = QUERIES["churn_user_states"](spark, str(tmp_path))
    want = sorted(map(str, whole.collect()))
    monkeypatch.setattr(lifecycle, "TASK_ROWS", 100, raising=False)
    dealt = QUERIES["churn_user_states"](spark, str(tmp_path))
    assert sorted(map(str, dealt.collect())) == want
    assert ", 20), REPARTITION_BY_NUM" in dealt._jdf.queryExecution().executedPlan().toString()
