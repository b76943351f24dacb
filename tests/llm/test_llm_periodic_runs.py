"""Periodic runs against a quadratic search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import periodic_runs as pr
from tessera.llm.queries import QUERIES


def brute(s, least=2, periods=2):
    """Runs (start, length, period) of a sequence: maximal stretches for every period that no smaller period explains."""
    codes, out = np.unique(np.array(s, dtype=object).astype(str), return_inverse=True)[1] if len(s) else np.zeros(0, int), []
    for q in range(1, len(s) // periods + 1):
        same = np.r_[False, codes[q:] == codes[:-q], False]
        edge = np.flatnonzero(same[1:] != same[:-1])
        for a, z in zip(edge[::2], edge[1::2]):
            n = int(z - a) + q
            w = codes[a:a + n]
            if n >= max(least, periods * q) and not any((w[r:] == w[:-r]).all() for r in range(1, q)):
                out.append((int(a), n, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def repeated(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def expected(doc_id, text):
    words = repeated(doc_id, text)
    runs = brute(words, 24, 3)
    drop = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in drop)))


def digests(df):
    got = {}
    for r in df.collect():
        got.setdefault(r.doc_id, []).append((r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256))
    return got


def test_query_matches_brute_force(spark, small_sf):
    got = digests(QUERIES["op11_periodic_runs"](spark, small_sf))
    docs = pd.read_parquet(f"{small_sf}/documents.parquet")
    assert got == {r.doc_id: [expected(r.doc_id, r.text)] for r in docs.itertuples()}
    assert sum(v[0][0] for v in got.values()) > 5


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_all_runs_of_small_alphabets(letters):
    rng = random.Random(letters)
    for _ in range(400):
        s = [rng.randint(1, letters) for _ in range(rng.randint(0, 60))]
        if len(s) > 9 and rng.random() < 0.6:
            a, q = rng.randrange(len(s) - 8), rng.randint(1, 7)
            s = [v if i < a else s[a + (i - a) % q] for i, v in enumerate(s)]
        assert [tuple(r) for r in pr.runs_of(s).tolist()] == sorted(brute(s))


def test_common_extensions_of_long_sequences():
    rng = np.random.default_rng(0)
    s = rng.integers(1, 3, 3000)
    s[1000:2500] = s[np.arange(1500) % 37 + 1000]
    tree = pr.SuffixTree(s.tolist())
    lce = pr.CommonExtension(tree, tree.tour())
    x, y = rng.integers(0, 3000, 4000), rng.integers(0, 3000, 4000)
    x, y = x[x != y], y[x != y]
    for a, b, n in zip(x, y, lce(x, y)):
        m = 3000 - max(a, b)
        apart = np.flatnonzero(s[a:a + m] != s[b:b + m])
        assert n == (apart[0] if len(apart) else m)
    order = sorted(range(3000), key=lambda i: s[i:].tolist())
    assert tree.suffix_ranks(tree.tour())[order].tolist() == list(range(1, 3001))  # the end is the smallest suffix


def test_stretches_lose_no_run():
    rng = random.Random(8)
    for _ in range(250):
        n = rng.randint(20, 400)
        s = [rng.randint(1, rng.choice([2, 6, 60])) for _ in range(n)]
        for _ in range(rng.randint(0, 4)):
            a, q, m = rng.randrange(n), rng.randint(1, 40), rng.randint(10, 150)
            for i in range(a + q, min(n, a + m)):
                s[i] = s[i - q]
        assert pr.word_runs(s) == brute(s, 24, 3)
        assert pr.word_runs(s, 12, 4) == brute(s, 12, 4)


def test_edge_rows(spark, tmp_path):
    line = "the same line again and "
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "one"), (5, "a " * 23), (5, "a " * 24), (5, "a " * 24), (None, line * 9), (None, None),
            (6, "x " * 9 + line * 40 + "é\x1cü " * 30), (30, "pre fix " + "\x85   " * 20), (-5, line * 3), (7, line * 5 + "b c " * 3000 + line * 5), (8, "w " * 30000)]
    rows += [(i, " ".join(random.Random(i).choices("abcdefgh", k=80))) for i in range(40, 90)]  # some of these ids are planted
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("runs", "collapsed", "_text", "best", "start", "Length")})
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = digests(QUERIES["op11_periodic_runs"](spark, str(tmp_path)))
    want = {}
    for doc_id, text in rows:
        if doc_id != 8:
            want.setdefault(doc_id, []).append(expected(doc_id, text))
    [eight] = got.pop(8)
    assert eight[:5] == (1, 0, 30000, 1, 30000000) and eight[6] == hashlib.sha256(b"w").hexdigest()
    key = lambda rows: sorted(rows, key=str)
    assert {k: key(v) for k, v in got.items()} == {k: key(v) for k, v in want.items()}


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pr.periodic_runs(empty, ["doc_id"]).count() == 0
