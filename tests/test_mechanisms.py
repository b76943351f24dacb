"""Radix selection, prefix scans, line numbers, document ranges, history appends, expected counts."""

import datetime as dt
import math
import random
import struct

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import cleaning, windows
from tessera.plans import sessions
from tessera.sources import files, sinks


def test_sort_key_orders_like_the_double(spark):
    rng = random.Random(1)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values += [s * v for v in (0.0, 5e-324, 1e-310, 2.0 ** -1022, 1.0, 1.5, 2.0, 1e15, 1.7976931348623157e308, math.inf) for s in (1, -1)]
    values += [math.nextafter(2.0 ** e, d) for e in range(-1021, 1023, 7) for d in (0, math.inf)] + [2.0 ** e for e in range(-1074, 1024)]
    values = [v for v in values if not math.isnan(v)]
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", cleaning.sort_key(F.col("x")).alias("k")).collect()
    order = sorted(rows, key=lambda r: r.x)
    assert all((a.x < b.x) == (a.k < b.k) for a, b in zip(order, order[1:]))
    nan = spark.createDataFrame([(math.nan,), (None,), (math.inf,)], "x double").select(cleaning.sort_key(F.col("x")).alias("k")).collect()
    assert nan[0].k > nan[2].k and nan[1].k == 0


def test_describe_of_heavy_tails(spark):
    rng = random.Random(2)
    data = [(10 ** rng.uniform(-300, 300) * rng.choice([1, -1]), 1.0 + rng.random() * 1e-12, 7.0, None if i % 3 else float(i)) for i in range(999)]
    df = spark.createDataFrame(data, "wide double, narrow double, same double, holes double")
    got = cleaning.describe(df).toPandas().set_index("column")
    want = pd.DataFrame(data, columns=["wide", "narrow", "same", "holes"]).astype(float).describe()
    for c in want:
        for k, name in (("25%", "p25"), ("50%", "p50"), ("75%", "p75")):
            assert math.isclose(got.loc[c, name], want.loc[k, c], rel_tol=1e-15), (c, name)
        assert got.loc[c, "count"] == want.loc["count", c] and got.loc[c, "min"] == want.loc["min", c] and got.loc[c, "max"] == want.loc["max", c]
    assert cleaning.describe(df.where("false")).count() == 0


def test_describe_reads_its_table_twice(spark, tmp_path):
    spark.range(5000).selectExpr("cast(id as double) a", "cast(id % 7 as double) b").write.parquet(str(tmp_path / "t"))
    df = cleaning.describe(spark.read.parquet(str(tmp_path / "t")))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") <= 5  # every round as written; a round's copy is a reused exchange


def test_prefix_scan_equals_the_window(spark):
    rng = random.Random(3)
    rows = [(s, i, rng.choice([None, rng.randint(0, 9)]), rng.choice([None, rng.randint(-5, 5)])) for s in ("a", "b", None) for i in range(-60, 240)]
    rows += [("c", 5, None, None), ("c", 900, 1, 1), ("d", None, 4, 4), ("d", 3, None, 2)]
    df = spark.createDataFrame(rows, "s string, i int, v int, w int")
    for series in ([], ["s"]):
        own = df if series else df.where("s = 'a'")
        w = Window.partitionBy(*series).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        want = own.select("s", "i", F.last("v", ignorenulls=True).over(w).alias("v"), "w", F.sum("w").over(w).alias("w_total"))
        got = windows.prefix_scan(own, "i", F.floor(F.col("i") / 16), fill=["v"], sums=["w"], series=series)
        key = lambda r: tuple(map(str, r))
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
        cuts = windows.order_buckets(own, "i", 8)
        again = windows.prefix_scan(own, "i", F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= F.col("i"))), fill=["v"], series=series)
        assert again.where("v is null").count() == got.where("v is null").count()


def test_one_long_series_runs_in_many_tasks(spark):
    n = 400_000
    df = spark.range(n).select("id", F.when(F.col("id") % 1000 == 7, F.col("id")).alias("v"), (F.col("id") % 10).alias("w"))
    got = windows.prefix_scan(df, "id", F.floor(F.col("id") / 4096), fill=["v"], sums=["w"])
    assert got.where((F.col("id") % 1000 >= 7) & (F.col("v") != F.col("id") - F.col("id") % 1000 + 7)).count() == 0
    tens = F.floor(F.col("id") / 10) * 45
    assert got.where(F.col("w_total") != tens + (F.col("id") % 10) * (F.col("id") % 10 + 1) / 2).count() == 0
    assert got.where("v is null").count() == 7


def test_line_numbers_over_many_splits(spark, tmp_path):
    d = tmp_path / "lists"
    d.mkdir()
    rng = random.Random(4)
    texts = {f"list{k}.txt": [f"{k}:{i}" + "x" * rng.randint(0, 30) for i in range(1, n + 1)] for k, n in enumerate((1, 5000, 0, 1700))}
    for name, lines in texts.items():
        (d / name).write_text("".join(line + "\n" for line in lines))
    (d / "other.csv").write_text("0:1\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("4096", "100000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1024")
            got = files.read_text_lines(spark, str(d)).orderBy("file_name", "line_no").collect()
            assert [(r.file_name, r.line_no, r.value) for r in got] == [(n, i, v) for n in sorted(texts) for i, v in enumerate(texts[n], 1)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
        spark.conf.set("spark.sql.files.openCostInBytes", before[1])
    assert {r.file_name for r in files.read_text_lines(spark, str(d), contains="t3").collect()} == {"list3.txt"}


def test_document_range_reads_its_days_only(spark, tmp_path):
    start = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    rows = [(f"{int((start + dt.timedelta(hours=5 * i)).timestamp()):08x}{i:016x}", i, "payload") for i in range(100)]
    path = str(tmp_path / "docs")
    files.write_documents_by_day(spark.createDataFrame(rows, "_id string, v int, body string"), path)
    got = files.read_document_range(spark, path, "2024-03-05", "2024-03-08", ["_id", "v"])
    want = [i for i in range(100) if dt.date(2024, 3, 5) <= (start + dt.timedelta(hours=5 * i)).date() < dt.date(2024, 3, 8)]
    assert sorted(r.v for r in got.collect()) == want
    assert got.select(F.input_file_name().alias("f")).distinct().count() <= 2 * 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "PartitionFilters: [isnotnull(id_day" in scan and "GreaterThanOrEqual(_id" in scan and "body" not in scan[scan.index("ReadSchema"):]
    assert files.read_document_range(spark, path, "2030-01-01", "2031-01-01").columns == ["_id", "v", "body"]


def test_a_repeated_append_leaves_the_same_rows(spark, tmp_path):
    path, columns = str(tmp_path / "h"), ["run_ts_utc", "k", "v"]
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2)], "k string, v int")
    first, second = (sinks.stamp_run(df, ts) for ts in ("2024-01-01 00:00:00", "2024-01-02 03:04:05.000006"))
    for run in (first, second, first, second.where("k = 'b'")):
        sinks.append_history(run, path, columns)
    back = sinks.read_history(spark, path, columns)
    assert back.columns == columns
    assert sorted((str(r.run_ts_utc), r.k) for r in back.collect()) == [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:00:00", "b"), ("2024-01-01 00:00:00", "b"),
                                                                        ("2024-01-02 03:04:05.000006", "b"), ("2024-01-02 03:04:05.000006", "b")]


def test_expected_and_low_cells(spark):
    rng = random.Random(5)
    rows = [(rng.choice([0, 0, 0, 1, None]), rng.choice("aaaabbbcde"), rng.choice([None, 1, 2])) for _ in range(60)] + [(1, "z", 2)]
    df = spark.createDataFrame(rows, "b int, x string, y int")
    tests = [("x", "x", None), ("y", "y", F.col("y") != 1)]
    got = {(r.variable, r.rv, r.key): (r.observed, r.expected) for r in sessions.chi2_expected(df, "b", tests).collect()}
    low = {r.variable: (r.n_cells, r.n_low) for r in sessions.chi2_low_cells(df, "b", tests).collect()}
    for name, pick in (("x", lambda r: r[1]), ("y", lambda r: r[2] if r[2] != 1 else None)):
        seen = [(r[0], str(pick(r))) for r in rows if r[0] is not None and pick(r) is not None]
        grid = {(a, b): (seen.count((a, b)), sum(s[0] == a for s in seen) * sum(s[1] == b for s in seen) / len(seen)) for a in {s[0] for s in seen} for b in {s[1] for s in seen}}
        assert {k[1:]: v for k, v in got.items() if k[0] == name} == grid
        assert low[name] == (len(grid), sum(e < 5 for _, e in grid.values()))


def test_types_are_inferred_as_by_the_frame_library(spark, tmp_path):
    rng = random.Random(9)
    pool = {"int": lambda: str(rng.randint(-99, 99)), "float": lambda: rng.choice(["1.5", "-2.", ".25", "1e3", "2E-2", "inf", "-inf", "7"]), "blank": lambda: rng.choice(["", "NA", "null", "n/a", "NaN"]),
            "bool": lambda: rng.choice(["True", "False"]), "text": lambda: rng.choice(["a", "1d", "1,5", "0x10", "- 3", "1_0", "12a", "e5"]), "big": lambda: str(10 ** 15 + rng.randint(0, 9))}
    mixes = [["int"], ["int", "blank"], ["float"], ["float", "int"], ["float", "blank"], ["bool"], ["bool", "blank"], ["bool", "int"], ["blank"], ["text"], ["text", "int"], ["int", "text", "blank"], ["big"], ["big", "int"]]
    rows = [[pool[m[i % len(m)]]() for m in mixes] for i in range(60)]
    names = [f"{'_'.join(m)}" for m in mixes]
    path = tmp_path / "t.csv"
    path.write_text("\n".join(";".join(r) for r in [names, *rows]) + "\n")
    frame = pd.read_csv(path, sep=";")
    got = files.read_delimited_inferred(spark, str(path), ";")
    want = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}
    assert dict(got.dtypes) == {n: want[str(t)] for n, t in frame.dtypes.items()}
    for name, kind in got.dtypes:
        own, theirs = [r[0] for r in got.select(f"`{name}`").collect()], frame[name].tolist()
        if kind in ("bigint", "double", "boolean"):
            assert [None if v is None else float(v) for v in own] == [None if v != v else float(v) for v in theirs], name
        else:
            assert [v is None for v in own] == [v is None or v != v for v in theirs] and [str(v) for v in own if v is not None] == [str(v) for v in theirs if v == v and v is not None], name
