"""Exact top-k inner products over norm-sorted blocks.

Vectors become integers, floor(scale * x).  A rotation by the eigenvectors of
their Gram matrix (the right singular vectors) moves most of each product into
the first coordinates.  Candidates are range-partitioned by descending length
and packed into blocks; queries are packed into blocks too.  A grid deals every
pair of a group of candidate blocks and a group of query blocks to one task of
bounded size.  There the candidates are walked from the longest down: a block
is skipped when |q| |v| cannot reach the query's k-th best score so far, and a
pair when the partial sum over the first rotated coordinates plus the product
of the residual lengths (Cauchy-Schwarz) cannot.  What is left gets the exact
integer product.  The k-th best score against the longest candidates, found
first, starts the bound and lets the grid drop cells before they are shuffled.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

SCALE, K = 256, 5
#: Vectors in a block; blocks of candidates and of queries in a grid cell; longest candidates that start the bounds.
BLOCK, CAND_BLOCKS, QUERY_BLOCKS, HEAD = 1024, 32, 4, 4096  # a cell: 32,768 candidates and 4,096 queries at most, on average
LONG_MAX = 2**63 - 1
_BLOCK = "dim int, first double, ids binary, ints binary, r int"


def _pack(b) -> tuple[np.ndarray, np.ndarray]:
    """ids (n), integers (n, dim) of a packed block."""
    ids = np.frombuffer(b["ids"], "<i8")
    return ids, np.frombuffer(b["ints"], "<i8").reshape(len(ids), -1)


def integers(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """(id, v array<long>, norm): rows with an id whose components are all finite numbers; components outside a long saturate."""
    sized = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x")).where(
        F.col("id").isNotNull() & F.col("x").isNotNull()
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))))
    ints = sized.select("id", F.transform("x", lambda c: F.floor(F.greatest(F.least(c * F.lit(float(scale)), F.lit(9.2e18)), F.lit(-9.2e18))).cast("long")).alias("v"))
    return ints.withColumn("norm", F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))))


def blocks(rows: DataFrame, block: int) -> DataFrame:
    """Packs (id, v, norm) rows, in the order they come within a partition, into blocks of one dimension; ``r`` is the partition."""
    def run(batches):
        held: dict[int, list] = {}
        here = TaskContext.get().partitionId()

        def emit(dim):
            own, held[dim] = held[dim], []
            ids = np.array([r[0] for r in own], "<i8")
            ints = np.array([r[1] for r in own], "<i8").reshape(len(own), dim)
            return pd.DataFrame({"dim": [dim], "first": [max(r[2] for r in own)], "ids": [ids.tobytes()], "ints": [ints.tobytes()], "r": [here]})

        for pdf in batches:
            for row in zip(pdf["id"], pdf["v"], pdf["norm"]):
                held.setdefault(len(row[1]), []).append(row)
                if len(held[len(row[1])]) == block:
                    yield emit(len(row[1]))
        for dim in [d for d in held if held[d]]:
            yield emit(dim)

    return rows.select("id", "v", "norm").mapInPandas(run, _BLOCK)


def rotations(packed: DataFrame) -> dict[int, np.ndarray]:
    """Right singular vectors of the integer vectors of each dimension, largest singular value first.

    Each task adds up its own Gram matrices; the driver gets dim x dim sums.
    """
    def gram(batches):
        total: dict[int, np.ndarray] = {}
        for pdf in batches:
            for b in pdf.to_dict("records"):
                x = _pack(b)[1].astype(np.float64)
                total[b["dim"]] = total.get(b["dim"], 0) + x.T @ x
        for dim, g in total.items():
            i, j = np.indices(g.shape)
            yield pd.DataFrame({"dim": dim, "i": i.ravel(), "j": j.ravel(), "x": g.ravel()})

    out = {}
    sums = packed.mapInPandas(gram, "dim int, i int, j int, x double").groupBy("dim", "i", "j").agg(F.sum("x").alias("x")).toPandas()
    for dim, own in sums.groupby("dim"):
        g = np.zeros((dim, dim))
        g[own["i"], own["j"]] = own["x"]
        g = np.nan_to_num((g + g.T) / 2, posinf=0.0, neginf=0.0)
        out[int(dim)] = np.linalg.eigh(g)[1][:, ::-1].copy()
    return out


def products(q: np.ndarray, v: np.ndarray, bound: float) -> np.ndarray:
    """Exact integer products, saturated at the ends of a long."""
    if bound < 2**52:
        return np.rint(q.astype(np.float64) @ v.astype(np.float64).T).astype(np.int64)
    if bound < 2**62:
        return q @ v.T
    exact = q.astype(object) @ v.astype(object).T
    return np.clip(exact, -LONG_MAX - 1, LONG_MAX).astype(np.int64)


class Best:
    """The k best (score, candidate) of each query of a block: scores descending, ties to smaller ids."""

    def __init__(self, ids: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.k, self.floor = ids, k, floor  # floor: a score that the k-th best is known to reach
        self.score = [np.empty(0, np.int64) for _ in ids]
        self.cand = [np.empty(0, np.int64) for _ in ids]

    def add(self, i: int, score: np.ndarray, cand: np.ndarray) -> None:
        use = (cand != self.ids[i]) & (score >= self.floor[i])
        if use.any():
            score, cand = np.append(self.score[i], score[use]), np.append(self.cand[i], cand[use])
            order = np.lexsort((cand, np.invert(score)))[: self.k]
            self.score[i], self.cand[i] = score[order], cand[order]
            if len(order) == self.k:
                self.floor[i] = max(self.floor[i], int(self.score[i][-1]))

    def rows(self) -> pd.DataFrame:
        n = [len(s) for s in self.score]
        return pd.DataFrame({"query_id": np.repeat(self.ids, n), "vec_id": np.concatenate([*self.cand, np.empty(0, np.int64)]), "score": np.concatenate([*self.score, np.empty(0, np.int64)])})


def search(queries, candidates, turn: np.ndarray | None, k: int, floors) -> list[pd.DataFrame]:
    """k best candidates of every query; blocks of candidates come in descending order of length."""
    out = []
    cands = []
    for ids, v in candidates:
        x = v.astype(np.float64)
        x = x @ turn if turn is not None and x.size else x
        cands.append((ids, v, x, np.sqrt((x * x).sum(axis=1))))
    cands.sort(key=lambda c: -c[3].max(initial=0.0))
    for (qid, q), floor in zip(queries, floors):
        best, y = Best(qid, k, floor), q.astype(np.float64)
        y = y @ turn if turn is not None and y.size else y
        length = np.sqrt((y * y).sum(axis=1))
        h = max(1, y.shape[1] // 4) if y.shape[1] else 0
        rest_q = np.sqrt((y[:, h:] ** 2).sum(axis=1))
        for ids, v, x, norm in cands:
            slack = 1.0 + 1e-9 * length * norm.max(initial=0.0)  # rounding of the rotated sums
            live = np.flatnonzero(length * norm.max(initial=0.0) + slack >= best.floor)
            if not len(live):
                continue
            partial = y[live, :h] @ x[:, :h].T
            reach = partial + rest_q[live, None] * np.sqrt((x[:, h:] ** 2).sum(axis=1))[None, :]
            hit = reach + slack[live, None] >= best.floor[live, None]
            cols = np.flatnonzero(hit.any(axis=0))
            if not len(cols):
                continue
            top = float(length[live].max() * norm.max())
            score = products(q[live], v[cols], top * 1.01 + 1)
            for r, i in enumerate(live):
                own = hit[r, cols]
                best.add(i, score[r, own], ids[cols][own])
        out.append(best.rows())
    return out


def top_k(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, scale: int = SCALE,
          block: int = BLOCK, cand_blocks: int = CAND_BLOCKS, query_blocks: int = QUERY_BLOCKS, head: int = HEAD) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k best inner products of every query row against all rows of other ids.

    Vectors that are null or hold a null or non-finite component, and rows
    without id, take no part.  Vectors meet others of their own dimension only.
    Repeated candidate rows are candidates each; a query id on several rows is
    asked once, with its smallest vector.  Fewer than k candidates give fewer
    rows, an empty table none.
    """
    spark = vectors.sparkSession
    parts = max(2 * spark.sparkContext.defaultParallelism, -(-vectors.count() // (block * cand_blocks)))
    sorted_rows = (integers(vectors, id_col, vec_col, scale).repartitionByRange(parts, F.desc("norm"), "id")
                   .sortWithinPartitions(F.desc("norm"), "id"))
    packed = materialize(blocks(sorted_rows, block).withColumn("c", F.xxhash64("ids", "ints")))
    asked = integers(queries, id_col, vec_col, scale).groupBy("id").agg(F.min(F.struct("v", "norm")).alias("x")).select("id", "x.v", "x.norm")
    asked = materialize(blocks(asked.repartition(F.xxhash64("id")), block).drop("r").withColumn("q", F.xxhash64("ids", "ints")))
    turns = rotations(packed)

    # Start of the bounds: a fixed number of the longest candidates of each dimension, read by every task.
    longest = {}
    for dim in turns:
        rows = packed.where(F.col("dim") == dim).orderBy(F.desc("first"), "c").limit(max(1, head // block)).collect()
        longest[dim] = [_pack(r.asDict()) for r in rows]

    def start(batches):
        for pdf in batches:
            for b in pdf.to_dict("records"):
                ids, q = _pack(b)
                low = np.full(len(ids), -LONG_MAX - 1, np.int64)
                if b["dim"] in longest:
                    [found] = search([(ids, q)], longest[b["dim"]], turns[b["dim"]], k, [low.copy()])
                    kth = found.groupby("query_id")["score"].agg(["size", "min"])
                    full = kth.loc[kth["size"] >= k, "min"]
                    at = {int(i): int(s) for i, s in full.items()}
                    low = np.array([at.get(int(i), -LONG_MAX - 1) for i in ids], np.int64)
                yield pd.DataFrame({**{c: [b[c]] for c in ("dim", "first", "ids", "ints", "q")}, "low": [low.astype("<i8").tobytes()], "least": [int(low.min())]})

    asked = materialize(asked.mapInPandas(start, _BLOCK.removesuffix(", r int") + ", q long, low binary, least long"))
    cols_g = -(-asked.count() // query_blocks) or 1
    # a range partition of the candidates, next to each other in length, is one row of the grid
    reach = packed.groupBy("dim", "r").agg(F.max("first").alias("top"))
    asked = asked.withColumn("col", F.pmod("q", F.lit(cols_g)).cast("int"))
    needs = asked.groupBy("dim", "col").agg(F.max("first").alias("top_q"), F.min("least").alias("least"))
    cells = reach.join(needs, "dim").where(F.col("top") * F.col("top_q") * 1.000001 + 1 >= F.col("least")).select("dim", "r", "col")
    left = packed.join(cells, ["dim", "r"]).select("dim", "r", "col", F.lit(0).alias("side"), "ids", "ints", F.lit(None).cast("binary").alias("low"))
    right = asked.join(cells, ["dim", "col"]).select("dim", "r", "col", F.lit(1).alias("side"), "ids", "ints", "low")

    def cell(pdf: pd.DataFrame) -> pd.DataFrame:
        recs = pdf.to_dict("records")
        asks = [r for r in recs if r["side"]]
        cands = [_pack(r) for r in recs if not r["side"]]
        found = search([_pack(r) for r in asks], cands, turns.get(int(pdf["dim"].iloc[0])), k, [np.frombuffer(r["low"], "<i8").copy() for r in asks])
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")

    found = left.unionAll(right).groupBy("dim", "r", "col").applyInPandas(cell, "query_id long, vec_id long, score long")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
      from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""
