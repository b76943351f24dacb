"""SimHash near-duplicates through forests of vantage-point trees.

Distinct fingerprints are dealt to shards by vantage-point trees: a node holds
a vantage fingerprint and a radius, fingerprints at most that far lie inside,
the others outside.  A fingerprint lives in the one leaf it falls into and also
visits every leaf that its search ball may overlap by the triangle inequality,
so each linked pair meets in the home shard of either end.  A shard searches
its members with a local vantage-point tree under the full distance and emits
a spanning forest of the links it finds, never all pairs of a group; the links
of all shards are joined to components.

Distances of unrelated 64-bit fingerprints crowd at 32 +- 4, so one tree under
the whole distance with radius 4 prunes next to nothing.  The forest therefore
has one tree for each of several bands of bits, measured by the Hamming
distance on that band, with band radii r_i such that sum(r_i + 1) exceeds the
bit budget: a pair within the budget is within r_i on some band i (pigeonhole),
so the search stays exact.  A tree of radius 1 deals a fingerprint to about
1.4 times as many shards with every level, one of radius 0 to one shard; the
default ``BAND_RADII = (1, 0, 0, 0)`` on bands of 16 bits covers 4 bits.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import connected_components, part, row_key, tuck
from tessera.session import materialize

SHINGLE_WORDS, MAX_BITS = 4, 4
BAND_RADII = (1, 0, 0, 0)
#: Fingerprints read by the driver to place vantage points; home fingerprints a leaf should hold; most rows of one search task.
SAMPLE, LEAF, CELL = 16384, 4096, 65536


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned SimHash of one text; null and texts without words give zero."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: lowers A-Z only and splits at ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        return xxhash.xxh64_intdigest(joined, 42)
    size = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(size + 1) - 1
    n = len(words) - shingle_words + 1
    starts, ends = (ends - size)[:n], ends[shingle_words - 1:]
    votes, h64 = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, 65536):
        h = np.array([h64(joined[a:b], 42) for a, b in zip(starts[at:at + 65536].tolist(), ends[at:at + 65536].tolist())], "<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keys: list[str], text_col: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(*keys, fp long): one row per row of ``docs``."""
    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), shingle_words) for t in b.column(len(keys))), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keys)], pa.array(fp.view(np.int64))], [*keys, "fp"])

    src = docs.select(*keys, text_col)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1])
    return src.mapInArrow(run, f"{kinds}, fp long")


# ---- vantage-point trees ------------------------------------------------------------

def far(a, b, mask=np.uint64(2**64 - 1)):
    return np.bitwise_count((a ^ b) & mask)


class Tree:
    """Vantage-point tree on the bits of ``mask``: nodes are (vantage, mu, inner, outer) or None for a leaf."""

    def __init__(self, sample: np.ndarray, mask: int, total: int, leaf: int):
        self.mask, self.nodes = np.uint64(mask), []
        self._grow(sample, total / max(1, len(sample)), leaf, 0)

    def _grow(self, pts, scale, leaf, depth) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        if len(pts) * scale > leaf and len(pts) >= 32 and depth < 40:
            for v in pts[:: max(1, len(pts) // 4)][:4]:
                d = far(pts, v, self.mask)
                mu = int(np.median(d))
                if (d <= mu).all():
                    mu -= 1
                if (d <= mu).any():
                    self.nodes[at] = (v, mu, self._grow(pts[d <= mu], scale, leaf, depth + 1), self._grow(pts[d > mu], scale, leaf, depth + 1))
                    break
        return at

    def visit(self, fps: np.ndarray, radius: int):
        """(row, leaf, home) of every leaf that a ball of that radius may overlap."""
        out, todo = [], [(0, np.arange(len(fps)), np.ones(len(fps), bool))]
        while todo:
            at, rows, home = todo.pop()
            if not len(rows):
                continue
            if self.nodes[at] is None:
                out.append((rows, np.full(len(rows), at, np.int32), home))
                continue
            v, mu, inner, outer = self.nodes[at]
            d = far(fps[rows], v, self.mask).astype(np.int16)
            for child, own, near in ((inner, d <= mu, d <= mu + radius), (outer, d > mu, d > mu - radius)):
                todo.append((child, rows[near], (home & own)[near]))
        return [np.concatenate(x) for x in zip(*out)] if out else [np.empty(0, t) for t in (np.int64, np.int32, bool)]


def band_masks(n: int) -> list[int]:
    cuts = [round(64 * i / n) for i in range(n + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]


def spanning_links(p: np.ndarray, q: np.ndarray, max_bits: int) -> np.ndarray:
    """Star edges (member, smallest member) of the components that links between p and q make.

    A local vantage-point tree on p, visited by q with radius ``max_bits``,
    prunes before the blocks of XOR and population counts.
    """
    both = np.unique(np.concatenate([p, q]))
    label = np.arange(len(both))
    home, guests = np.searchsorted(both, np.unique(p)), np.searchsorted(both, np.unique(q))
    tree = Tree(both[home], 2**64 - 1, len(home), 1024)
    own_row, own_leaf, is_home = tree.visit(both[home], 0)
    g_row, g_leaf, _ = tree.visit(both[guests], max_bits)
    for leaf in np.unique(own_leaf):
        left = home[own_row[(own_leaf == leaf) & is_home]]
        right = guests[g_row[g_leaf == leaf]]
        for i in range(0, len(left), 256):
            a = left[i:i + 256]
            for j in range(0, len(right), 4096):
                b = right[j:j + 4096]
                near = far(both[a][:, None], both[b][None, :]) <= max_bits
                for k in np.flatnonzero((near & (label[b] != label[a][:, None])).any(axis=1)):
                    meet = np.unique(np.append(label[b[near[k]]], label[a[k]]))
                    if len(meet) > 1:
                        label[np.isin(label, meet)] = meet[0]
    moved = np.flatnonzero(label != np.arange(len(both)))
    return np.stack([both[moved], both[label[moved]]], axis=1)


def linked_pairs(fps: DataFrame, max_bits: int = MAX_BITS, band_radii=BAND_RADII,
                 sample: int = SAMPLE, leaf: int = LEAF, cell: int = CELL) -> DataFrame:
    """Spanning links (a, b) between the distinct longs of ``fps.fp`` within ``max_bits`` bits.

    A shard with more rows than ``cell`` is searched as a grid of cells, a part
    of its members against a part of its visitors, so that no task's memory
    grows with a dense group.
    """
    if sum(r + 1 for r in band_radii) <= max_bits:
        raise ValueError("band radii do not cover the bit budget")
    total = fps.count()
    picked = fps.orderBy(F.xxhash64("fp"), "fp").limit(sample).toPandas()["fp"].to_numpy(np.int64).view(np.uint64)
    trees = [Tree(picked, m, total, leaf) for m in band_masks(len(band_radii))]

    def deal(batches):
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(x), 8192):
                part = x[at:at + 8192]
                for band, (tree, radius) in enumerate(zip(trees, band_radii)):
                    row, where, home = tree.visit(part, radius)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(row), band, np.int32)), pa.array(where), pa.array(part[row].view(np.int64)), pa.array(home)],
                        ["band", "leaf", "fp", "home"])

    dealt = fps.select("fp").mapInArrow(deal, "band int, leaf int, fp long, home boolean")
    grid = dealt.groupBy("band", "leaf").agg(F.ceil(F.count(F.lit(1)) / F.lit(cell)).cast("int").alias("g"))
    side = lambda salt: F.pmod(F.xxhash64("fp", F.lit(salt)), F.col("g")).cast("int")
    cells = F.expr("""case when g = 1 then array(struct(0 as i, 0 as j, if(home, 3, 2) as kind))
        else concat(if(home, transform(sequence(0, g - 1), x -> struct(ri as i, x as j, 1 as kind)), array()),
                    transform(sequence(0, g - 1), x -> struct(x as i, rj as j, 2 as kind))) end""")
    placed = (dealt.join(grid, ["band", "leaf"]).withColumn("ri", side(1)).withColumn("rj", side(2))
              .select("band", "leaf", "fp", F.explode(cells).alias("c")).select("band", "leaf", "fp", "c.i", "c.j", "c.kind"))

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        x, kind = pdf["fp"].to_numpy(np.int64).view(np.uint64), pdf["kind"].to_numpy()
        return pd.DataFrame(spanning_links(x[kind & 1 > 0], x[kind & 2 > 0], max_bits).view(np.int64), columns=["a", "b"])

    return placed.groupBy("band", "leaf", "i", "j").applyInPandas(search, "a long, b long")


def fingerprint_groups(keyed: DataFrame, max_bits: int = MAX_BITS, **search) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable from each distinct one."""
    distinct = materialize(keyed.select("fp").distinct())
    roots = connected_components(linked_pairs(distinct, max_bits, **search))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, **search) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits.  Null and wordless texts have fingerprint zero
    and link like any other; repeated rows give repeated rows; a row without id
    belongs to its component without naming it (component_id is null only if
    no member has an id).
    """
    keyed = materialize(fingerprints(docs, [id_col], text_col, shingle_words))
    groups = fingerprint_groups(keyed, max_bits, **search)
    least = keyed.groupBy("fp").agg(F.min(id_col).alias("least"))
    named = least.join(groups, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    per_fp = groups.join(named, "root").select("fp", "component_id")
    return keyed.join(per_fp, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, **search) -> DataFrame:
    """Rows of ``docs`` that stay: of each component the one with the smallest id.

    Rows without id come after all others, ties are broken by a hash of the
    text, and of rows equal in id and text one stays.
    """
    rows = tuck(docs).withColumn("_key", row_key(f"_row.`{id_col}`", f"_row.`{text_col}`"))
    plain = rows.select(part(id_col).alias("_id"), "_key", part(text_col).alias("_text"))
    keyed = materialize(fingerprints(plain, ["_id", "_key"], "_text", shingle_words))
    groups = fingerprint_groups(keyed, max_bits, **search)
    rank = F.struct(F.col("_id").isNull().alias("n"), F.col("_id").alias("d"), F.col("_key").alias("k"))
    first = keyed.groupBy("fp").agg(F.min(rank).alias("r"))
    stay = first.join(groups, "fp").groupBy("root").agg(F.min("r").alias("r")).select(F.col("r.k").alias("_key"))
    return rows.join(stay, "_key").dropDuplicates(["_key"]).select("_row.*")
