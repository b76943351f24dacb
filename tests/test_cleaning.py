import numpy as np
import pandas as pd
import pytest

from tessera.operators import cleaning as K
from tessera.operators import windows as W


def test_nulls_duplicates_dedupe(spark):
    df = spark.createDataFrame([(1, "a", None), (1, "a", None), (1, "a", None), (2, None, 1.0), (2, None, 1.0),
                                (3, "c", 2.0)], "x int, y string, z double")
    assert {r.column: r.n_null for r in K.null_counts(df).collect()} == {"x": 0, "y": 2, "z": 3}
    s = K.duplicate_summary(df).first()
    assert (s.n_rows, s.n_distinct_rows, s.n_duplicate_rows) == (6, 3, 3)
    dups = sorted(tuple(r) for r in K.duplicate_rows(df).collect())
    assert dups == [(1, "a", None), (1, "a", None), (2, None, 1.0)]   # NULLs compare equal
    assert K.dedupe(df).count() == 3
    assert sorted(tuple(r) for r in K.duplicate_rows(df, step=1).collect()) == dups


def test_describe_matches_pandas(spark):
    vals = [3, 1, 4, 1, 5, 9, 2, 6, 5, 3, 5]
    df = spark.createDataFrame([(v,) for v in vals], "c int")
    d = K.describe(df, ["c"]).first()
    p = pd.Series(vals, dtype=float).describe()
    assert d["count"] == p["count"] and d.min == p["min"] and d.max == p["max"]
    for ours, theirs in ((d.mean, "mean"), (d.std, "std"), (d.p25, "25%"), (d.p50, "50%"), (d.p75, "75%")):
        assert ours == pytest.approx(p[theirs])


@pytest.mark.parametrize("digit", [8, 16, 32])
def test_quartiles_with_ties_and_nulls(spark, digit):
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 40, 333):
        vals = [None if rng.random() < 0.1 else float(rng.integers(-20, 20)) ** 3 for _ in range(n)] + [7.0]
        d = K.describe(spark.createDataFrame([(v,) for v in vals], "c double"), ["c"], digit=digit).first()
        p = pd.Series([v for v in vals if v is not None]).describe()
        assert (d.p25, d.p50, d.p75) == pytest.approx((p["25%"], p["50%"], p["75%"]))


def test_text_range_and_head(spark):
    df = spark.createDataFrame([("b", 2), (None, 1), ("a", 3)], "t string, n int")
    assert tuple(K.text_range(df, ["t"]).first()) == ("t", "a", "b")
    assert [r.n for r in K.head(df, 2, ["n"]).collect()] == [1, 2]


def test_histogram_matches_numpy(spark):
    vals = [0, 0, 1, 0, 1, 1, 1, 0, 0, 0]
    df = spark.createDataFrame([(v,) for v in vals], "b int")
    got = {r.bin: r["count"] for r in K.histogram(df, "b", 10).collect()}
    counts, _ = np.histogram(vals, bins=10)
    assert got == {i: int(c) for i, c in enumerate(counts)}
    const = spark.createDataFrame([(7,), (7,)], "b int")
    r = K.histogram(const, "b", 10).collect()
    assert len(r) == 10 and [x for x in r if x["count"]][0].bin_lower <= 7 <= [x for x in r if x["count"]][0].bin_upper
    assert K.histogram(const.limit(0), "b", 10).count() == 0


def test_profile_and_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (None, "b")], "x int, y string")
    p = {r.column: r for r in K.profile(df).collect()}
    assert (p["x"].dtype, p["x"].n_rows, p["x"].n_non_null, p["x"].n_distinct) == ("int", 3, 2, 2)
    assert {r.y: r.n_rows for r in K.distinct_values(df, "y").collect()} == {"a": 2, "b": 1}


def test_forward_fill_and_split(spark):
    df = spark.createDataFrame([("s", 1, 1.0), ("s", 2, None), ("s", 3, None), ("s", 4, 4.0), ("t", 1, None)],
                               "k string, w int, v double")
    ff = {(r.k, r.w): r.v for r in W.forward_fill(df, ["k"], "w", ["v"]).collect()}
    assert ff == {("s", 1): 1.0, ("s", 2): 1.0, ("s", 3): 1.0, ("s", 4): 4.0, ("t", 1): None}
    sp = {(r.k, r.w): r.is_train for r in W.positional_split(df, ["k"], "w", 2).collect()}
    assert sp[("s", 2)] and not sp[("s", 3)] and sp[("t", 1)]
