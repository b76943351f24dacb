"""Approximate nearest neighbours by a forest of hash prefixes.

Every vector gets one long hash string per tree: symbols that name the nearest
signed axis of a random low-dimensional frame, the sign before the axis, so that
any prefix of bits is a hash of its own.  Entries sorted by (tree, string) are
the trees: a prefix is a run of neighbours in the sorted array, and one pass
over the arrays counts the runs of every prefix length that is used.

A query descends every tree along its own string and then ascends all trees
together, one prefix length at a time, to the longest prefix whose runs hold
enough entries in sum.  How many are enough is fitted: for a bounded sample of
queries with exactly known neighbours, the smallest number that finds the wanted
share of them.  Where no prefix reaches it the ascent ends at the root, the
whole table.  The runs that queries ask for are dealt to tasks in blocks of
bounded size (a long run in several, its queries in blocks too) and scored there
with the original vectors.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize

K, TREES, BITS, FRAME = 20, 12, 60, 16
#: Prefix lengths at which the ascent may stop; 0 is the root.
LEVELS = (0, 3, 4, 5, 9, 10, 14, 15, 20, 25, 30, 40, 50, 60)
#: Sampled queries that fit the number of candidates; the share of their neighbours to be found.
SAMPLE, RECALL = 200, 0.92
#: Entries and queries in one scored block, entries multiplied at once; runs of fewer entries are not counted one by one.
CHUNK, ASKS, SLICE, LEAF = 32_768, 1_024, 4_096, 8


def clean(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v array<double>): rows with an id and a finite vector that is not zero."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec_col}`").alias("v"))
    return rows.where(F.col("id").isNotNull() & F.col("v").isNotNull()
                      & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
                      & F.exists("v", lambda c: c != 0))


@lru_cache(maxsize=256)
def frames(dim: int, tree: int, bits: int = BITS) -> tuple[list[np.ndarray], int]:
    """Random orthonormal frames of a tree's symbols, and the bits of a symbol."""
    width = 1 << min(FRAME.bit_length() - 1, dim.bit_length() - 1)
    symbol = 1 + width.bit_length() - 1
    rng = np.random.default_rng((dim, tree))
    return [np.linalg.qr(rng.standard_normal((dim, width)))[0] for _ in range(bits // symbol)], symbol


def strings(x: np.ndarray, trees: int, bits: int = BITS) -> np.ndarray:
    """Hash strings (rows, trees) of the rows of ``x`` as longs of ``bits`` bits, first symbol highest."""
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow; the direction alone counts
    out = np.empty((len(x), trees), np.int64)
    for t in range(trees):
        axes, symbol = frames(x.shape[1], t, bits)
        y = np.zeros(len(x), np.int64)
        for frame in axes:
            z = x @ frame
            axis = np.abs(z).argmax(axis=1)
            y = (y << symbol) | ((z[np.arange(len(x)), axis] > 0).astype(np.int64) << (symbol - 1)) | axis
        out[:, t] = y << (bits - symbol * len(axes))
    return out


def by_dimension(lists: pa.Array):
    """(row numbers, matrix of doubles) of the rows of each length in a column of number lists."""
    size = np.asarray(lists.value_lengths())
    for dim in np.unique(size):
        at = np.flatnonzero(size == dim)
        yield at, lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), dim)


def entries(rows: DataFrame, trees: int) -> DataFrame:
    """(id, dim, tree, s): the hash string of every row in every tree."""
    def run(batches):
        for b in batches:
            for at, x in by_dimension(b.column(1)):
                s = strings(x, trees)
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(pa.array(np.repeat(at, trees))), pa.array(np.full(s.size, x.shape[1], np.int32)),
                    pa.array(np.tile(np.arange(trees, dtype=np.int32), len(at))), pa.array(s.ravel())], ["id", "dim", "tree", "s"])

    return rows.select("id", "v").mapInArrow(run, "id long, dim int, tree int, s long")


def run_counts(entered: DataFrame, levels: tuple[int, ...] = LEVELS, leaf: int = LEAF) -> DataFrame:
    """(dim, tree, level, node, n): entries under every prefix that has ``leaf`` entries or more (some with fewer too).

    The entries are sorted over all partitions; each task counts the runs of its
    own part, and only the first and last run of a part can go on in another.
    Repeated rows of an id count once.
    """
    order = ["dim", "tree", "s", "id"]
    ordered = entered.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        before = None
        open_runs: dict[int, list] = {}  # level -> key, count, whether it began the part

        def rows(own):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in own], kind) for k, kind in
                                               enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], ["dim", "tree", "level", "node", "n"])

        for b in batches:
            dim, tree, s, ids = (np.asarray(c) for c in b.columns)
            if not len(s):
                continue
            head = (dim[0], tree[0], s[0], ids[0]) != before
            before = dim[-1], tree[-1], s[-1], ids[-1]
            keep = np.r_[head, (np.diff(ids) != 0) | (np.diff(s) != 0) | (np.diff(tree) != 0) | (np.diff(dim) != 0)]
            dim, tree, s = dim[keep], tree[keep], s[keep]
            for level in levels:
                node = s >> (BITS - level)
                new = np.flatnonzero(np.r_[True, (dim[1:] != dim[:-1]) | (tree[1:] != tree[:-1]) | (node[1:] != node[:-1])][: len(s)])
                if not len(new):
                    continue
                size = np.diff(np.r_[new, len(s)])
                held = open_runs.get(level)
                if held and held[0] == (int(dim[0]), int(tree[0]), int(node[0])):
                    size[0] += held[1]
                elif held and (held[2] or held[1] >= leaf):
                    yield rows([(*held[0][:2], level, held[0][2], held[1])])
                keep = np.flatnonzero((size[:-1] >= leaf) | (np.arange(len(size) - 1) == 0) & (held is None or held[2]))
                yield pa.RecordBatch.from_arrays([pa.array(dim[new[keep]]), pa.array(tree[new[keep]]), pa.array(np.full(len(keep), level, np.int32)),
                                                  pa.array(node[new[keep]]), pa.array(size[keep])], ["dim", "tree", "level", "node", "n"])
                last = new[-1]
                open_runs[level] = [(int(dim[last]), int(tree[last]), int(node[last])), int(size[-1]), (held is None or held[2]) and len(new) == 1]
        if open_runs:
            yield rows([(*held[0][:2], level, held[0][2], held[1]) for level, held in open_runs.items()])

    parts = ordered.mapInArrow(run, "dim int, tree int, level int, node long, n long")
    return parts.groupBy("dim", "tree", "level", "node").agg(F.sum("n").alias("n"))


def at_levels(entered: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """Entries once per prefix length as (.., level, node); at the root the first tree stands for all."""
    prefix = F.array(*[F.struct(F.lit(l).alias("level"), F.shiftrightunsigned("s", BITS - l).alias("node")) for l in levels])
    return entered.withColumn("p", F.explode(prefix)).where("p.level > 0 or tree = 0").select("*", "p.level", "p.node").drop("p")


def totals(asked: DataFrame, counts: DataFrame, levels: tuple[int, ...]) -> DataFrame:
    """(id, level, total, most): entries that a query meets at each prefix length, in all trees and in the fullest."""
    met = at_levels(asked, levels).join(counts, ["dim", "tree", "level", "node"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return met.groupBy("id", "level").agg(F.sum("n").alias("total"), F.max("n").alias("most"))


def score(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of equally many rows, each summed alone and in the same order everywhere."""
    return (q * c).sum(axis=1)


class Best:
    """The k best candidates of a block of queries; candidates come in blocks, an id counts once."""

    def __init__(self, ids: np.ndarray, q: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, q, k
        self.best = [(np.empty(0), np.empty(0, np.int64))] * len(ids)

    def add(self, ids: np.ndarray, c: np.ndarray) -> None:
        for at in range(0, len(ids), SLICE):
            self._add(ids[at:at + SLICE], c[at:at + SLICE])

    def _add(self, ids: np.ndarray, c: np.ndarray) -> None:
        near = self.q @ c.T
        slack = 1e-12 * np.linalg.norm(self.q, axis=1) * np.linalg.norm(c, axis=1).max(initial=0.0)
        near[self.ids[:, None] == ids[None, :]] = -np.inf
        own, order = near, np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(ids[order]) != 0])
        if len(first) < len(ids):  # the best row of every id
            own = np.maximum.reduceat(near[:, order], first, axis=1)
        least = np.partition(own, -self.k, axis=1)[:, -self.k] if len(first) > self.k else np.full(len(self.ids), -np.inf)
        for i, low in enumerate(least):
            old, known = self.best[i]
            low = max(low, old[-1] if len(old) == self.k else -np.inf)
            hit = np.flatnonzero((near[i] >= low - slack[i]) & (ids != self.ids[i]))
            if len(hit):
                s, n = np.append(old, score(self.q[i][None, :], c[hit])), np.append(known, ids[hit])
                order = np.lexsort((n, -s))
                first = np.sort(np.unique(n[order], return_index=True)[1])[: self.k]  # best row of every id
                self.best[i] = s[order][first], n[order][first]

    def rows(self) -> pa.RecordBatch:
        n = [len(s) for s, _ in self.best]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(self.ids, n)), pa.array(np.concatenate([x for _, x in self.best] + [np.empty(0, np.int64)])),
            pa.array(np.concatenate([s for s, _ in self.best] + [np.empty(0)]))], ["query_id", "vec_id", "score"])


_FOUND = "query_id long, vec_id long, score double"


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact(rows: DataFrame, asked: list, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of a bounded list of query rows, against every row."""
    by_dim: dict[int, list] = {}
    for r in asked:
        by_dim.setdefault(len(r.v), []).append(r)

    def run(batches):
        best = {d: Best(np.array([r.id for r in own]), np.array([r.v for r in own], float), k) for d, own in by_dim.items()}
        for b in batches:
            for at, x in by_dimension(b.column(1)):
                if x.shape[1] in best:
                    best[x.shape[1]].add(np.asarray(b.column(0))[at], x)
        yield from (own.rows() for own in best.values())

    return ranked(rows.select("id", "v").mapInArrow(run, _FOUND), k)


def fit(rows: DataFrame, asked: DataFrame, sums: DataFrame, k: int, trees: int, levels: tuple[int, ...], recall: float) -> int:
    """Entries that an ascent must meet so that the sampled queries find ``recall`` of their true neighbours.

    The sample is small, so the lower end of its error (two standard deviations over queries) must reach ``recall``.
    """
    sample = asked.select("id", "v").collect()
    if not sample:
        return 0
    truth = exact(rows, sample, k)
    ends = truth.join(rows.select(F.col("id").alias("vec_id"), "v"), "vec_id").groupBy("query_id", "vec_id").agg(F.min("v").alias("v")).collect()
    number = {r.id: i for i, r in enumerate(sample)}
    met = np.zeros((len(sample), len(levels)))
    for r in sums.join(F.broadcast(asked.select("id")), "id").collect():
        met[number[r.id], levels.index(r.level)] = r.total if r.most > k else 0
    # share of a query's neighbours that share a prefix of each length with it in some tree
    found, known = np.zeros((len(sample), len(levels))), np.zeros(len(sample))
    for dim in {len(r.v) for r in ends}:
        own = [r for r in ends if len(r.v) == dim]
        at = np.array([number[r.query_id] for r in own])
        apart = strings(np.array([sample[i].v for i in at], float), trees) ^ strings(np.array([r.v for r in own], float), trees)
        shared = np.array([BITS - min(int(d).bit_length() for d in row) for row in apart])
        np.add.at(found, at, shared[:, None] >= np.array(levels))
        np.add.at(known, at, 1)
    met, found = met[known > 0], found[known > 0] / known[known > 0][:, None]
    every = np.unique(met)
    for enough in every[every > 0]:
        deepest = np.where(met >= enough, np.arange(len(levels)), 0).max(axis=1)  # the root is the first level
        share = found[np.arange(len(found)), deepest]
        if share.mean() - 2 * share.std() / len(share) ** 0.5 >= recall:
            return int(enough)
    return int(every[-1]) + 1 if len(every) else 0


def neighbours(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, trees: int = TREES,
               levels: tuple[int, ...] = LEVELS, recall: float = RECALL, sample: int = SAMPLE, chunk: int = CHUNK, asks: int = ASKS) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): the k largest inner products found for every query, ties to smaller ids.

    Vectors that are null, zero, or hold null or non-finite entries, and rows
    without id, take no part.  Vectors meet others of their own length only.
    An id on several rows is one candidate with its best score; a query id on
    several rows is asked once, with its smallest vector.  Fewer than k
    candidates are all returned (the ascent ends at the root; only where one id
    has many different vectors in a run may the runs hold fewer than k ids); an
    empty table gives no rows.  Every row is indexed; ``sample`` queries, those with the
    smallest hashes, fit the number of candidates.
    """
    rows = materialize(clean(vectors, id_col, vec_col))
    asked = materialize(clean(queries, id_col, vec_col).groupBy("id").agg(F.min("v").alias("v")))
    entered = entries(rows, trees)
    counts = materialize(run_counts(entered, levels))
    asked_entries = entries(asked, trees)
    sums = materialize(totals(asked_entries, counts, levels))
    enough = fit(rows, asked.orderBy(F.xxhash64("id"), "id").limit(sample), sums, k, trees, levels, recall)
    held = (F.col("total") >= enough) & (F.col("most") > k)  # one run of more than k entries holds k others
    stop = sums.groupBy("id").agg(F.max(F.when(held, F.col("level")).otherwise(0)).alias("level"))

    # the runs that are asked for, and how many blocks each has on either side
    goals = at_levels(asked_entries, levels).join(stop, ["id", "level"])
    runs = materialize(goals.groupBy("dim", "tree", "level", "node").agg(F.count(F.lit(1)).alias("q"))
                       .join(counts, ["dim", "tree", "level", "node"], "left")
                       .select("dim", "tree", "level", "node", F.ceil(F.col("q") / asks).cast("int").alias("cols"),
                               F.ceil(F.coalesce("n", F.lit(1)) / chunk).cast("int").alias("parts")))
    used = tuple(sorted(r.level for r in runs.select("level").distinct().collect()))
    cell = F.xxhash64("dim", "tree", "level", "node", "part", "col").alias("cell")  # two cells of one hash would share their candidates

    if not used:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def dealt(side, own, other, all_of):
        placed = side.join(runs, ["dim", "tree", "level", "node"])
        mine = F.pmod(F.xxhash64(F.col("id"), F.lit(own)), F.col("parts" if own == "part" else "cols")).cast("int")
        return placed.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(all_of) - 1))).select("id", cell)

    left = dealt(at_levels(entered, used), "part", "col", "cols").join(rows, "id").select("cell", F.lit(False).alias("asks"), "id", "v")
    right = dealt(goals, "col", "part", "parts").join(asked, "id").select("cell", F.lit(True).alias("asks"), "id", "v")
    blocks = left.unionAll(right).repartition("cell").sortWithinPartitions("cell", F.desc("asks"))

    def run(batches):
        here, best, queries = None, {}, {}
        for b in batches:
            cells, asking, ids, lists = np.asarray(b.column(0)), b.column(1).to_numpy(zero_copy_only=False), np.asarray(b.column(2)), b.column(3)
            new = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])[: len(cells)].tolist()
            for a, z in zip(new, [*new[1:], len(cells)]):
                if cells[a] != here:
                    yield from (own.rows() for own in best.values())
                    here, best, queries = cells[a], {}, {}
                n = int(asking[a:z].sum())  # the queries of a cell come first
                for at, x in by_dimension(lists.slice(a, n)):
                    queries.setdefault(x.shape[1], []).append((ids[a:a + n][at], x))
                for at, x in by_dimension(lists.slice(a + n, z - a - n)):
                    dim = x.shape[1]
                    if dim in queries and dim not in best:
                        best[dim] = Best(np.concatenate([i for i, _ in queries[dim]]), np.concatenate([q for _, q in queries[dim]]), k)
                    if dim in best:
                        best[dim].add(ids[a + n:z][at], x)
        yield from (own.rows() for own in best.values())

    return ranked(blocks.mapInArrow(run, _FOUND), k)
