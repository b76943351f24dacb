"""The hash-prefix forest against brute force: recall, exact scores, run counts, edge cases."""

from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import prefix_forest as pf
from tessera.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, asked, k):
    """{query: [(score, id)]}: the k best of clean rows, an id once with its best row, a query once with its smallest vector."""
    good = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if i is not None and v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v) and any(v)]
    out = {}
    for q in sorted({i for i, _ in good if i in asked}):
        a = min((tuple(v) for i, v in good if i == q))
        best = {}
        for i, v in good:
            if i != q and len(v) == len(a):
                best[i] = max(best.get(i, -np.inf), float((np.array(a) * v).sum()))
        out[q] = sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:k]
    return out


def found(df):
    got = df.toPandas().sort_values(["query_id", "rank"])
    assert (got.groupby("query_id")["rank"].apply(list).map(lambda r: r == list(range(1, len(r) + 1)))).all()
    return {q: list(zip(g.score, g.vec_id)) for q, g in got.groupby("query_id")}


@pytest.mark.parametrize("size", ["sf0.001", "sf0.1"])
def test_query_recall_and_scores(spark, size):
    sf = f"/root/testdata/{size}"
    table = pd.read_parquet(f"{sf}/embeddings.parquet")
    want = brute(list(zip(table.vec_id, table.embedding)), {i for i in table.vec_id if i % 20 == 0}, 20)
    got = found(QUERIES["op13_prefix_forest"](spark, sf))
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    vector = dict(zip(table.vec_id, table.embedding))
    for q, own in got.items():
        assert all(abs(s - float((vector[q].astype(float) * vector[i].astype(float)).sum())) < 1e-14 for s, i in own)
        assert own == sorted(own, key=lambda x: (-x[0], x[1])) and q not in [i for _, i in own]
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / len(want[q]) for q in want]) >= 0.9


def clustered(n, seed=1):
    """``n`` vectors of 24 dimensions: tight clusters, one of a third of all rows, and repeated vectors."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 40, 24))
    at = np.where(np.arange(n) % 3 == 0, 0, rng.integers(0, len(centres), n))
    x = (centres[at] + 0.05 * rng.normal(size=(n, 24))).astype(np.float32)
    x[5:n:50] = x[5]
    return [(i, [float(c) for c in v]) for i, v in enumerate(x)]


def test_clusters_use_longer_prefixes_and_bounded_blocks(spark):
    rows = clustered(6000)
    want = brute(rows, set(range(0, 6000, 20)), 10)
    df = spark.createDataFrame(rows, VECTORS)
    got = found(pf.neighbours(df, df.where("vec_id % 20 = 0"), k=10, chunk=300, asks=16))
    assert set(got) == set(want) and all(len(v) == 10 for v in got.values())
    assert np.mean([len({i for _, i in got[q]} & {i for _, i in want[q]}) / 10 for q in want]) >= 0.9
    asked = pf.entries(pf.clean(df.where("vec_id % 20 = 0"), "vec_id", "embedding"), pf.TREES)
    counts = pf.run_counts(pf.entries(pf.clean(df, "vec_id", "embedding"), pf.TREES))
    reach = pf.totals(asked, counts, pf.LEVELS).where(f"total > {10 * pf.TREES}").groupBy("id").agg(F.max("level").alias("l"))
    assert reach.agg(F.percentile_approx("l", 0.5)).first()[0] >= 5


def test_run_counts_match_a_plain_count(spark):
    rows = [*clustered(900, 3), *clustered(900, 3)[:20]]  # the last rows are repeats and count once
    entered = pf.entries(pf.clean(spark.createDataFrame(rows, VECTORS), "vec_id", "embedding"), 3)
    plain = Counter()
    for r in entered.distinct().collect():
        plain.update((r.dim, r.tree, l, r.s >> (pf.BITS - l)) for l in pf.LEVELS)
    for parts in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got = {(r.dim, r.tree, r.level, r.node): r.n for r in pf.run_counts(entered).collect()}
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        assert all(plain[key] == n for key, n in got.items()) and all(key in got for key, n in plain.items() if n >= pf.LEAF)


def test_edge_cases_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    plain = [(i, [float(c) for c in np.float32(rng.normal(size=3))]) for i in range(60)]
    odd = [(100, None), (120, []), (140, [0.0, 0.0, 0.0]), (160, [1.0, None, 2.0]), (180, [float("nan")] * 3), (200, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]),
           (220, [1.0, 2.0]), (221, [2.0, 1.0]), (240, [5.0])]
    again = [plain[0], plain[0], (20, [9.0, 9.0, 9.0]), (7, [9.0, 9.0, 9.0]), (301, plain[3][1]), (302, plain[3][1])]
    rows = [*plain, *odd, *again]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit("mine") for c in ("id", "v", "cell", "asks", "tree", "s", "level", "n", "score")})
    got = found(pf.neighbours(df, df.where("vec_id % 20 = 0"), k=8))
    want = brute(rows, {i for i, _ in rows if i is not None and i % 20 == 0}, 8)
    assert {q: [i for _, i in own] for q, own in got.items()} == {q: [i for _, i in own] for q, own in want.items() if own}
    assert all(abs(a - b) < 1e-12 for q in got for (a, _), (b, _) in zip(got[q], want[q]))


def test_empty_table(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert pf.neighbours(empty, empty).count() == 0
    some = spark.createDataFrame(clustered(100), VECTORS)
    assert pf.neighbours(some, empty).count() == 0 and pf.neighbours(empty, some).count() == 0
