"""Periodic runs of words by suffix-tree LCE and Lyndon roots.

A run is a stretch of words with smallest period q that no neighbouring word
extends.  Every run has a root that is the longest Lyndon word at its place, in
one of two opposite orders of the words.  So the candidates are one (place,
period) per word and order: the distance to the next smaller suffix, read off
the order of the suffixes.  Each candidate is extended to the right by the
longest common extension of its place and the place one period on, to the left
by the same in the reversed words.  Both come from Ukkonen's suffix trees of the
words and of their reversal: the string depth of the lowest common ancestor of
two leaves is the least depth between them on the tree's tour, a range minimum
answered in constant time (minima up to the ends of blocks, and a sparse table
over the blocks).

Trees are built where a run can be.  Any eight words in a row of a run of at
least 24 words and three periods stand in it a second time, one period away;
stretches of a text where some eight words have no second place that near hold
no run, and a run never leaves the stretch it is in.  The rest of the work is
the trees', one text at a time, in memory proportional to the stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS, MIN_PERIODS = 24, 3
#: Range minima: leaves of the tour in a block.
BLOCK = 32
RUNS = "array<struct<start:long,length:long,period:long>>"


# ---- suffix trees ---------------------------------------------------------------------

class SuffixTree:
    """Ukkonen's tree of a list of whole numbers from 1 on; 0 ends it and is the smallest in every order."""

    def __init__(self, symbols: list[int]):
        s = [*symbols, 0]
        n, base = len(s), max(s) + 1
        self.n, self.base = n, base
        begin, stop, link, depth = [0], [0], [0], [0]  # node 0 is the root; an edge is s[begin:stop] into its node
        follow: dict[int, int] = {}                    # parent * base + first symbol -> child
        node, edge, length, left = 0, 0, 0, 0
        for i, c in enumerate(s):
            left += 1
            last = 0
            while left:
                if not length:
                    edge = i
                key = node * base + s[edge]
                child = follow.get(key)
                if child is None:
                    follow[key] = len(begin)
                    begin.append(i); stop.append(n); link.append(0); depth.append(n - i + left - 1)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    size = stop[child] - begin[child]
                    if length >= size:
                        edge += size
                        length -= size
                        node = child
                        continue
                    at = begin[child]
                    if s[at + length] == c:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    split = len(begin)
                    follow[key] = split
                    begin.append(at); stop.append(at + length); link.append(0); depth.append(depth[node] + length)
                    follow[split * base + c] = split + 1
                    begin.append(i); stop.append(n); link.append(0); depth.append(n - i + left - 1)
                    begin[child] = at + length
                    follow[split * base + s[at + length]] = child
                    if last:
                        link[last] = split
                    last = split
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - left + 1
        keys = np.fromiter(follow.keys(), np.int64, len(follow))
        self.child = np.fromiter(follow.values(), np.int64, len(follow))
        self.parent, self.symbol = keys // base, keys % base
        self.depth = np.array(depth, np.int64)
        self.leaf = np.array(stop) == n
        self.leaf[0] = False

    def tour(self, falling: bool = False) -> np.ndarray:
        """Nodes in the order of a depth-first walk, children by symbol, rising or falling (0 first either way)."""
        by = np.where(self.symbol == 0, 0, self.base - self.symbol) if falling else self.symbol
        order = np.lexsort((-by, self.parent))
        kids, size = self.child[order].tolist(), np.bincount(self.parent, minlength=len(self.depth))
        z = np.cumsum(size)
        a, z = (z - size).tolist(), z.tolist()
        out, stack = [], [0]
        pop, push, put = stack.pop, stack.extend, out.append
        while stack:
            v = pop()
            put(v)
            if a[v] != z[v]:
                push(kids[a[v]:z[v]])
        return np.array(out)

    def suffix_ranks(self, tour: np.ndarray) -> np.ndarray:
        """Rank of every suffix (the end's own one left out) in the order of the tour."""
        leaves = tour[self.leaf[tour]]
        rank = np.empty(self.n, np.int64)
        rank[self.n - self.depth[leaves]] = np.arange(len(leaves))
        return rank[:-1]


class CommonExtension:
    """Longest common extensions of pairs of places: depth of the lowest common ancestor of their leaves."""

    def __init__(self, tree: SuffixTree, tour: np.ndarray):
        up = np.zeros(len(tree.depth), np.int64)
        up[tree.child] = tree.depth[tree.parent]
        # between two nodes of the tour the walk comes up as far as the parent of some node after the first
        level = up[tour]
        self.place = np.empty(tree.n, np.int64)
        leaves = np.flatnonzero(tree.leaf[tour])
        self.place[tree.n - tree.depth[tour[leaves]]] = leaves
        blocks = -(-len(level) // BLOCK)
        padded = np.full(blocks * BLOCK, np.iinfo(np.int64).max)
        padded[: len(level)] = level
        grid = padded.reshape(blocks, BLOCK)
        self.flat = padded
        self.to_here = np.minimum.accumulate(grid, axis=1).ravel()
        self.from_here = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self.table = [grid.min(axis=1)]
        while 2 << (len(self.table) - 1) <= blocks:
            half, low = 1 << (len(self.table) - 1), self.table[-1]
            self.table.append(np.minimum(low[:-half], low[half:]))

    def __call__(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For places x != y."""
        a, b = self.place[x], self.place[y]
        a, b = np.minimum(a, b) + 1, np.maximum(a, b)
        first, last = a // BLOCK, b // BLOCK
        out = np.minimum(self.from_here[a], self.to_here[b])
        for k, low in enumerate(self.table):  # whole blocks between
            between = last - first - 1
            use = np.flatnonzero((between >= 1 << k) & (between < 2 << k))
            if len(use):
                f, l = first[use] + 1, last[use] - (1 << k)
                out[use] = np.minimum(out[use], np.minimum(low[f], low[l]))
        same = np.flatnonzero(first == last)
        if len(same):
            own, f, l = self.flat[b[same]], a[same], b[same]
            for k in range(int((l - f).max(initial=0))):
                own = np.minimum(own, self.flat[np.minimum(f + k, l)])
            out[same] = own
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """Place of the next suffix of smaller rank, or the end."""
    n = len(rank)
    nxt = [n] * n
    for i in range(n - 2, -1, -1):
        r, j = rank[i], i + 1
        while j < n and rank[j] > r:
            j = nxt[j]
        nxt[i] = j
    return nxt


def runs_of(symbols: list[int]) -> np.ndarray:
    """All runs (start, length, period) of two periods or more of a list of whole numbers from 1 on, sorted."""
    n = len(symbols)
    if n < 2:
        return np.zeros((0, 3), np.int64)
    tree, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    tour = tree.tour()
    right, left = CommonExtension(tree, tour), CommonExtension(back, back.tour())
    here = np.arange(n)
    found = []
    for rank in (tree.suffix_ranks(tour), tree.suffix_ranks(tree.tour(falling=True))):
        after = np.array(next_smaller(rank.tolist()))
        i = here[after < n]  # a root that ends the words cannot repeat
        q = after[i] - i
        more, less = right(i, i + q), left(n - i - q, n - i)
        found.append(np.stack([i - less, less + q + more, q], axis=1)[less + more >= q])
    return np.unique(np.concatenate(found), axis=0)


# ---- texts ----------------------------------------------------------------------------

class Numbers(dict):
    """Numbers words from 1 on as they come."""

    def __missing__(self, word):
        self[word] = number = len(self) + 1
        return number


def stretches(ids: np.ndarray, least: int, periods: int) -> list[tuple[int, int]]:
    """Parts [a, b) of the words outside of which no run of ``least`` words and ``periods`` (3 or more) periods has a word."""
    gram = max(1, least // periods)
    if len(ids) < least:
        return []
    # hashes of the grams, by doubling; equal grams have equal hashes, a chance collision only keeps a part too many
    h, width = ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 1
    h ^= h >> np.uint64(29)
    while width < gram:
        step = min(width, gram - width)
        h = h[: len(h) - step] * np.uint64(0xD6E8FEB86659FD93) + h[step:]
        h ^= h >> np.uint64(32)
        width += step
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    near = np.full(len(h), len(ids))
    gap = np.diff(order)
    near[order[1:][same]] = gap[same]
    near[order[:-1][same]] = np.minimum(near[order[:-1][same]], gap[same])
    parts, open_parts = [], [(0, len(h))]  # in places of grams
    while open_parts:
        a, z = open_parts.pop()
        words = z - a + gram - 1
        if words < least:
            continue
        fit = np.r_[False, near[a:z] <= words // periods, False]
        edge = np.flatnonzero(fit[1:] != fit[:-1]) + a
        if len(edge) == 2 and edge[0] == a and edge[1] == z:
            parts.append((a, z + gram - 1))
        else:
            open_parts.extend(zip(edge[::2].tolist(), edge[1::2].tolist()))
    return sorted(parts)


def word_runs(words: list, least: int = MIN_WORDS, periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """Runs (start, length, period) of at least ``least`` words and ``periods`` periods, by start and period."""
    if len(words) < least:
        return []
    ids = np.fromiter(map(Numbers().__getitem__, words), np.int64, len(words))
    out = []
    for a, z in stretches(ids, least, periods):
        found = runs_of((np.unique(ids[a:z], return_inverse=True)[1] + 1).tolist())
        found = found[(found[:, 1] >= least) & (found[:, 1] >= periods * found[:, 2])]
        out += [(a + s, n, q) for s, n, q in found.tolist()]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by one space."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period:start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def periodic_runs(docs: DataFrame, keep: list[str], text_col: str = "text", least: int = MIN_WORDS, periods: int = MIN_PERIODS) -> DataFrame:
    """Columns ``keep`` of every row, its ``runs`` (start, length, period, by start and period) and its ``collapsed`` text.

    Words are what ASCII white space separates.  A null text has no words, no
    runs and an empty collapsed text, as an empty one has.  Every row is worked
    on alone: repeated rows give equal rows, an empty table none.  Texts of any
    length are taken whole.  Columns of ``docs`` outside ``keep`` are not read,
    whatever their names; ``runs`` and ``collapsed`` cannot be kept ones.
    """
    if periods < 3:
        raise ValueError("stretches are proved for three periods or more")
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.select(*[F.col(f"`{c}`") for c in keep]).schema.fields)
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("_text"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                spans, texts = [], []
                for t in part.column(len(keep)):
                    words = t.as_py().split()  # bytes: exactly the six ASCII white-space characters separate
                    found = word_runs(words, least, periods)
                    spans.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    texts.append(collapsed(words, found).decode("utf-8", "replace"))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], pa.array(spans, kind), pa.array(texts, pa.string())], [*keep, "runs", "collapsed"])

    return rows.mapInArrow(run, f"{kinds}runs {RUNS}, collapsed string")
