"""Token-id matrices by best-fit-decreasing packing.

Token sequences longer than a row are split losslessly into full rows and one
remainder.  Pieces are dealt to shards of a bounded number of tokens by a hash
of their document, so a hot document or source does not fill a task; each shard
packs its pieces by decreasing length, and a segment tree over capacities finds
the fullest open row that still fits in logarithmic time.  The output row holds
the ids of one matrix row (padded), the cumulative lengths of its segments and
positions that restart at every segment.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

#: Tokens in a row; tokens a shard should hold; id of the padding.
ROW, SHARD_TOKENS, PAD = 2048, 2_000_000, 50256


class Capacities:
    """Segment tree over free room 0..row: counts open rows by room and finds the least room that is enough."""

    def __init__(self, row: int):
        self.size = 1 << (row + 1).bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(row + 1)]

    def add(self, room: int, index: int) -> None:
        self.rows[room].append(index)
        at = room + self.size
        while at:
            self.count[at] += 1
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """(room, row) of the least room of at least ``need``, taken out; None if there is none."""
        at = need + self.size
        while not self.count[at]:
            while at & 1:  # right child: its right neighbour is under another parent
                at >>= 1
            if at <= 1:
                return None
            at += 1
        while at < self.size:
            at = 2 * at if self.count[2 * at] else 2 * at + 1
        room = at - self.size
        while at:
            self.count[at] -= 1
            at >>= 1
        return room, self.rows[room].pop()


def best_fit(lengths: list[int], row: int) -> list[list[int]]:
    """Rows of item numbers, best fit decreasing; ties keep the order given."""
    rows: list[list[int]] = []
    tree = Capacities(row)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        need = lengths[i]
        found = tree.take(need) if need < row else None
        if found is None:
            rows.append([i])
            room, at = row, len(rows) - 1
        else:
            room, at = found
            rows[at].append(i)
        if room > need:
            tree.add(room - need, at)
    return rows


def pieces(tokens: DataFrame, id_col: str, ids_col: str, row: int, shards: int) -> DataFrame:
    """(doc, start, part, shard): lossless parts of at most ``row`` tokens; documents without tokens have none.

    Ids in bytes are cut by Spark itself, so no second Python worker stands
    behind each of those that encode.
    """
    doc = F.col(id_col).cast("long").alias("doc")
    if isinstance(tokens.schema[ids_col].dataType, BinaryType):
        last = (F.length(ids_col) / 4 - 1).cast("long")
        starts = F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last, F.lit(row).cast("long")))
        cut = (tokens.select(doc, F.col(ids_col).alias("_ids"), F.explode(starts).alias("start"))
               .select("doc", "start", F.substring("_ids", (4 * F.col("start") + 1).cast("int"), F.lit(4 * row)).alias("part")))
    else:
        cut = tokens.select(doc, ids_col).mapInArrow(_cut_arrays(row), "doc long, start long, part binary")
    return cut.withColumn("shard", F.pmod(F.xxhash64("doc", "start", "part"), F.lit(shards)).cast("int"))


def _cut_arrays(row: int):
    def run(batches):
        for b in batches:
            out = [[], [], []]
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1)):
                if not ids.is_valid:
                    continue
                x = np.asarray(ids.values, np.int32).astype("<u4").tobytes()
                for at in range(0, len(x) // 4, row):
                    for column, v in zip(out, (doc, at, x[4 * at:4 * (at + row)])):
                        column.append(v)
                    if len(out[0]) == 2048:
                        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["doc", "start", "part"])
                        out = [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())], ["doc", "start", "part"])

    return run


def pack(tokens: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", row: int = ROW, pad: int = PAD, shards: int | None = None,
         total_tokens: int | None = None, matrix: bool = True) -> DataFrame:
    """One row per matrix row: shard, row, n_tokens, doc_ids, starts, cu_seqlens, ids_sha256, positions_sha256 and, if
    ``matrix``, ids and positions (little-endian unsigned 32-bit integers in bytes, padded to ``row``).

    Segment s holds tokens starts[s].. of document doc_ids[s] in places
    cu_seqlens[s]..cu_seqlens[s + 1].  A document without id packs as null;
    repeated rows are packed as often as they occur; of equally long parts the
    one of the smaller id and start comes first.  Ids come as arrays or as such
    bytes.  Documents without tokens and an
    empty table give no rows.  Only the two named columns are read.
    """
    if shards is None:
        if total_tokens is None:
            total_tokens = tokens.agg(F.sum(F.length(ids_col) / 4 if isinstance(tokens.schema[ids_col].dataType, BinaryType) else F.size(ids_col))).first()[0] or 0
        shards = max(1, -(-int(total_tokens) // SHARD_TOKENS))

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part").to_pylist()
        start, doc = table.column("start").to_pylist(), table.column("doc").to_pylist()
        order = sorted(range(len(part)), key=lambda i: (doc[i] is None, doc[i] or 0, start[i], part[i]))
        lengths = [len(part[i]) // 4 for i in order]
        out: dict[str, list] = {k: [] for k in names}
        shard = table.column("shard")[0].as_py()
        for n, items in enumerate(best_fit(lengths, row)):
            own = [order[i] for i in items]
            cu = np.cumsum([0, *[lengths[i] for i in items]])
            ids = b"".join(part[i] for i in own) + np.full(row - cu[-1], pad, "<u4").tobytes()
            positions = np.concatenate([*[np.arange(lengths[i]) for i in items], np.zeros(row - cu[-1], np.int64)]).astype("<u4").tobytes()
            for k, v in (("shard", shard), ("row", n), ("n_tokens", int(cu[-1])), ("doc_ids", [doc[i] for i in own]), ("starts", [start[i] for i in own]), ("cu_seqlens", cu.tolist()),
                         ("ids_sha256", hashlib.sha256(ids).hexdigest()), ("positions_sha256", hashlib.sha256(positions).hexdigest()), ("ids", ids), ("positions", positions)):
                if k in out:
                    out[k].append(v)
        return pa.table({k: pa.array(v, types[k]) for k, v in out.items()})

    kinds = {"shard": "int", "row": "int", "n_tokens": "long", "doc_ids": "array<long>", "starts": "array<long>", "cu_seqlens": "array<int>", "ids_sha256": "string", "positions_sha256": "string"}
    kinds |= {"ids": "binary", "positions": "binary"} if matrix else {}
    names = list(kinds)
    types = {"shard": pa.int32(), "row": pa.int32(), "n_tokens": pa.int64(), "doc_ids": pa.list_(pa.int64()), "starts": pa.list_(pa.int64()), "cu_seqlens": pa.list_(pa.int32()),
             "ids_sha256": pa.string(), "positions_sha256": pa.string(), "ids": pa.binary(), "positions": pa.binary()}
    return pieces(tokens, id_col, ids_col, row, shards).groupBy("shard").applyInArrow(run, ", ".join(f"{k} {v}" for k, v in kinds.items()))


def write_matrix(packed: DataFrame, path: str) -> None:
    """Writes the packed rows as Parquet, one folder per shard, ids and positions as fixed-width binary."""
    packed.write.partitionBy("shard").parquet(path)
