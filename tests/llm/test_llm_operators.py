"""The corpus operators against brute-force versions on small frames: nulls in any
column, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import (bpe, html_extract, line_quality, mixing, packing, quality_classifier, simhash_neardup,
                         substring_dedup, topk_search, toxicity)
from tessera.llm.queries import TOKENIZER

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
RNG = random.Random(3)


def prose(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


LONG = prose(9000, 99)
EDGE = [
    (1, prose(120, 1), "en", "a", 1), (2, prose(120, 1), "en", "a", 1), (2, prose(120, 1), "en", "a", 1),  # a copy and a repeated row
    (3, "", "en", "a", 0), (4, None, None, None, None), (None, prose(70, 2), "de", None, 5), (None, None, None, "a", None),
    (5, " \t\n\x0b\x0c\r ", "en", "b", 7), (6, LONG, "fr", "b", len(LONG)), (7, "one two three", "en", "b", 13),
    (8, prose(30, 5) + " " + prose(60, 77) + " " + prose(40, 6), "en", "c", 0), (9, prose(25, 8) + " " + prose(60, 77), "en", "c", 0),
]
CLASHES = ("_row", "rid", "fp", "stats", "score", "predicted", "kept", "topic", "probability", "n_tokens", "cell", "_key", "_t", "h", "Label")


def clashing(df):
    """``df`` with more columns, named like the operators' own."""
    return df.withColumns({c: F.lit("mine") for c in CLASHES})


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(EDGE, DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# ---- 1 top-k ------------------------------------------------------------------------

def brute_top(rows, asked, k):
    clean = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows
             if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = []
    for q, a in sorted(x for x in clean if x[0] in asked):
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in clean if i != q and len(b) == len(a))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [3, 1024])
def test_top_k_matches_brute_force(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=8) * (1 + i % 5)]) for i in range(60)]
    rows += [(100 + i, rows[7][1]) for i in range(6)]  # ties
    rows += [(200, None), (201, [1.0, None] * 4), (202, [float("nan")] * 8), (203, [float("inf")] * 8), (None, rows[0][1]), (204, [0.0] * 8), (205, [1.0, 2.0]), (206, [])]
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    got = topk_search.top_k(df, df.where("vec_id % 5 = 0"), block=block, cand_blocks=2, query_blocks=2, head=3)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, {i for i, _ in rows if i is not None and i % 5 == 0}, 5)


def test_top_k_large_components_and_empty_table(spark):
    rows = [(i, [1e5 * (i + 1), -3e5, 1e4 * i]) for i in range(12)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(map(tuple, topk_search.top_k(df, df.where("vec_id % 5 = 0")).collect())) == brute_top(rows, {0, 5, 10}, 5)
    none = df.limit(0)
    assert topk_search.top_k(none, none).count() == 0


# ---- 2 mixing -----------------------------------------------------------------------

def test_raking_meets_all_marginals():
    tokens = {(s, lang): float(RNG.randint(1, 500)) for s in "abc" for lang in ("x", "y")}
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"x": 0.7, "y": 0.3}}
    scale, gap = mixing.rake(tokens, targets)
    total = sum(tokens.values())
    for k, t in enumerate(targets.values()):
        for name, want in t.items():
            assert sum(tokens[c] * scale[c] / total for c in tokens if c[k] == name) == pytest.approx(want, abs=1e-8)
    assert gap < 1e-9 and mixing.rake({}, targets) == ({}, 0.0)


def test_raking_tells_of_targets_that_contradict():
    with pytest.warns(UserWarning, match="contradict"):
        _, gap = mixing.rake({("a", "x"): 1.0, ("b", "y"): 1.0}, {"s": {"a": 0.9, "b": 0.1}, "l": {"x": 0.1, "y": 0.9}})
    assert gap > 0.1


def test_mix_keeps_rows_by_a_hash_of_their_id(spark, edge, empty):
    rows = [(i, f"word{i} " * (1 + i % 9), "en" if i % 3 else "de", "src0" if i % 2 else "src1", 0) for i in range(3000)]
    df = spark.createDataFrame(rows, DOCS)
    targets = {"source": {"src0": 0.8, "src1": 0.2}, "lang": {"en": 0.5, "de": 0.5}}
    got = mixing.mix(df, targets).collect()
    for r in got:
        u = int(hashlib.md5(f"{mixing.SEED}:{r['doc_id']}".encode()).hexdigest()[:13], 16) / 16**13
        assert r["kept"] == (u < r["probability"])
    kept = Counter()
    for r in got:
        kept[r["source"]] += r["n_tokens"] * r["probability"]
    assert kept["src0"] / sum(kept.values()) == pytest.approx(0.8, abs=1e-6)
    assert max(r["probability"] for r in got) == pytest.approx(1.0)
    assert mixing.mix(edge).count() == len(EDGE) and mixing.mix(empty).count() == 0
    clash = mixing.sample(clashing(edge))
    assert set(clash.columns) == {*edge.columns, *CLASHES} and {r["topic"] for r in clash.collect()} <= {"mine"}


def test_one_rare_row_does_not_empty_the_mix(spark):
    rows = [(i, "one two three", "en", f"src{i % 4}", 0) for i in range(8000)]
    targets = {"source": {**{f"src{i}": 1.0 for i in range(4)}, mixing.REST: 1.0}}
    with pytest.warns(UserWarning, match="too few tokens"):
        got = mixing.mix(spark.createDataFrame(rows + [(9999, "one two three", "en", None, 0)], DOCS), targets).collect()
    copies = Counter()
    for r in got:
        assert r["kept"] == (r["copies"] > 0) and r["copies"] <= mixing.REPEATS
        copies[r["source"]] += r["copies"]
    assert copies[None] == mixing.REPEATS and sum(copies.values()) > 0.15 * len(rows)
    assert mixing.sample(spark.createDataFrame(rows[:40] + [(9999, "four", "en", None, 0)], DOCS), targets).where("doc_id = 9999").count() == 4


# ---- 3 SimHash ----------------------------------------------------------------------

def brute_groups(fps, bits):
    label = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits and label[i] != label[j]:
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


@pytest.mark.parametrize("radii", [(4,), (2, 1), (1, 1, 0), (1, 0, 0, 0), (0,) * 5])
def test_linked_pairs_give_the_components_of_brute_force(spark, radii):
    rng = random.Random(11)
    fps = [rng.getrandbits(64) for _ in range(150)]
    for _ in range(250):  # chains and dense groups
        x = rng.choice(fps)
        for _ in range(rng.randint(0, 4)):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    fps = sorted(set(fps))
    signed = [(x - 2**64 if x >> 63 else x,) for x in fps]
    links = simhash_neardup.linked_pairs(spark.createDataFrame(signed, "fp long"), 4, radii, sample=256, leaf=16, cell=64).collect()
    at = {s[0]: i for i, s in enumerate(signed)}
    label = list(range(len(fps)))
    for a, b in links:
        x, y = sorted((label[at[a]], label[at[b]]))
        label = [x if z == y else z for z in label]
    want = brute_groups(fps, 4)
    assert len(set(zip(label, want))) == len(set(label)) == len(set(want))


def test_fingerprint_definition():
    import xxhash

    text = "Über The\tquick BROWN  fox\njumps"
    words = ["Über", "the", "quick", "brown", "fox", "jumps"]
    votes = [0] * 64
    for i in range(3):
        h = xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    assert simhash_neardup.fingerprint(text) == sum(1 << b for b in range(64) if 2 * votes[b] > 3)
    assert simhash_neardup.fingerprint(None) == simhash_neardup.fingerprint(" \x0b") == 0
    assert simhash_neardup.fingerprint("A b") == xxhash.xxh64_intdigest(b"a b", 42)


def test_near_duplicates_and_the_one_that_stays(edge, empty):
    got = simhash_neardup.near_duplicates(edge).collect()
    assert len(got) == len(EDGE)
    by = {r["doc_id"]: r for r in got}
    assert by[1]["component_id"] == by[2]["component_id"] == 1 and by[6]["component_id"] == 6
    assert {by[i]["component_id"] for i in (3, 4, 5)} == {3} and by[3]["fingerprint"] == "0" * 16
    stay = simhash_neardup.keep_one(clashing(edge))
    assert sorted(r["doc_id"] or 0 for r in stay.collect()) == [0, 1, 3, 6, 7, 8, 9] and set(stay.columns) == {*edge.columns, *CLASHES}
    assert simhash_neardup.near_duplicates(empty).count() == 0 and simhash_neardup.keep_one(empty).count() == 0


# ---- 4 BPE --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(TOKENIZER)


@pytest.mark.parametrize("alphabet", ["ab", "abc'stre ", "aé日 \n1$'ll", "x  \t\n", "1234567890", "!?*'sd", "日本語", "a<|endoftext|> "])
def test_pieces_join_to_the_librarys_ids(codec, monkeypatch, alphabet):
    monkeypatch.setattr(bpe, "RUN", 16)
    rng = random.Random(alphabet)
    for _ in range(150):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300)))
        if "|" in alphabet:
            text = text.replace("a", "<|endoftext|>")
        want = np.array(codec.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        codec.words.clear()
        codec.heads.clear()
        assert codec.encode(text) == want
        pieces = codec.segments(text, 20)
        assert "".join(pieces) == text and codec.tree([(p, codec.encode(p)) for p in pieces]) == want
        assert codec.decode_ids(np.frombuffer(want, "<u4")) == codec.lib.decode(np.frombuffer(want, "<u4").tolist(), skip_special_tokens=False)


def test_encode_and_decode_rows(codec, edge, empty):
    more = edge.unionAll(edge.where("doc_id = 6"))  # a repeated long row
    got = bpe.encode(more, TOKENIZER, ["doc_id", "text"], want=("n_tokens", "ids", "ids_sha256", "decoded"), segment=1000).collect()
    assert len(got) == len(EDGE) + 1
    for r in got:
        ids = codec.lib.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["decoded"] == (r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    back = bpe.decode(bpe.encode(edge, TOKENIZER, ["doc_id", "text"]), TOKENIZER)
    assert all(r["decoded"] == (r["text"] or "") for r in back.collect())
    assert bpe.encode(empty, TOKENIZER, ["doc_id"]).count() == 0


# ---- 5 substring dedup --------------------------------------------------------------

def test_chain_is_the_best_collinear_one():
    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 9)
        pts = sorted({(rng.randint(0, 30), rng.randint(0, 30)) for _ in range(n)})
        x, y = np.array([p[0] for p in pts]), np.array([p[1] for p in pts])
        best = 0.0
        for mask in range(1, 1 << len(pts)):
            own = [p for i, p in enumerate(pts) if mask >> i & 1]
            if all(a[0] < b[0] and a[1] < b[1] for a, b in zip(own, own[1:])):
                best = max(best, 5 * len(own) - 0.5 * sum(b[0] - a[0] + b[1] - a[1] for a, b in zip(own, own[1:])))
        c = substring_dedup.chain(x, y, 5, 0.5)[0]
        assert 5 * len(c) - 0.5 * ((x[c[-1]] - x[c[0]]) + (y[c[-1]] - y[c[0]])) == pytest.approx(best)


def test_repeated_passages_exact_and_fuzzy(spark, edge, empty):
    shared = prose(60, 500).split()
    fuzzy = list(shared)
    fuzzy[20], fuzzy[41] = "changed", "also"
    del fuzzy[30]
    rows = [(1, prose(40, 1) + " " + " ".join(shared) + " " + prose(90, 2), "en", "a", 0), (5, prose(77, 3) + "\n" + " ".join(shared).upper(), "en", "a", 0),
            (7, " ".join(fuzzy) + " " + prose(30, 4), "en", "a", 0), (9, prose(300, 6), "en", "a", 0), (11, prose(12, 8) + " " + " ".join(shared[:45]), "en", "a", 0)]
    got = {r["doc_id"]: r for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()}
    assert set(got) == {5, 7}
    assert (got[5]["start_word"], got[5]["n_words"], got[5]["source_doc_id"], got[5]["source_start_word"], got[5]["similarity"]) == (77, 60, 1, 40, 1.0)
    assert (got[7]["start_word"], got[7]["n_words"], got[7]["source_n_words"]) == (0, 59, 60) and 0.9 < got[7]["similarity"] < 1
    cut = {r["doc_id"]: r for r in substring_dedup.remove_passages(spark.createDataFrame(rows, DOCS), count_col="n_chars").collect()}
    assert cut[5]["text"] == prose(77, 3) and cut[5]["n_chars"] == len(cut[5]["text"]) and cut[7]["text"] == prose(30, 4)
    assert cut[1]["text"] == rows[0][1] and cut[9]["text"] == rows[3][1] and cut[11]["n_chars"] == 0
    assert substring_dedup.repeated_passages(empty).count() == 0 and substring_dedup.remove_passages(empty).count() == 0
    kept = substring_dedup.remove_passages(clashing(edge))
    assert {r["text"] for r in kept.collect()} >= {None, "", "one two three", LONG} and set(kept.columns) == {*edge.columns, *CLASHES}


def test_passage_in_a_hot_group_and_far_beyond_its_seeds(spark):
    body = prose(700, 900)
    parts = [(i, prose(30, 1000 + i) + " " + body + " " + prose(30, 3000 + i), "en", "a", 0) for i in range(40)]
    rows = substring_dedup.repeated_passages(spark.createDataFrame(parts, DOCS)).collect()
    assert {r["doc_id"] for r in rows if r["n_words"] == 700 and r["start_word"] == 30} == set(range(1, 40))
    assert len(rows) == 39  # links to the first holder, not all pairs


@pytest.mark.parametrize("gap", [15, 20, 30, 43])
def test_passages_of_one_chain_are_all_reported(spark, gap):
    one, two = prose(60, 501), prose(70, 502)
    rows = [(1, " ".join([prose(20, 1), one, prose(gap, 2), two, prose(20, 3)]), "en", "a", 0), (2, " ".join([prose(30, 4), one, prose(gap, 5), two, prose(9, 6)]), "en", "a", 0)]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()
    assert sorted((r["doc_id"], r["start_word"], r["n_words"], r["source_start_word"], r["similarity"]) for r in got) == [(2, 30, 60, 20, 1.0), (2, 90 + gap, 70, 80 + gap, 1.0)]


def test_stretches_of_an_alignment():
    own = lambda *runs: substring_dedup._stretches(list(runs), 4, 50)
    assert own((0, 0, 60), (70, 70, 60)) == [(0, 2)] and own((0, 0, 60), (73, 73, 50)) == [(0, 1), (1, 2)]
    assert own((0, 0, 30), (37, 37, 28)) == [(0, 2)] and own((0, 0, 10), (15, 15, 44)) == [(0, 2)]  # short ones that make 50 words at 0.8 together
    assert own((0, 0, 30), (60, 60, 30)) == [(0, 1), (1, 2)] and own() == []


def test_passage_whose_pieces_stand_in_earlier_documents(spark):
    w = prose(60, 503).split()
    parts = [(1, w[:30]), (2, w[30:]), (3, w[:49]), (4, w[11:]), (8, w), (9, w)]
    rows = [(i, " ".join([prose(40, 10 + i), *p, prose(25, 30 + i)]), "en", "a", 0) for i, p in parts]
    got = substring_dedup.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()
    assert [(r["start_word"], r["n_words"], r["similarity"]) for r in got if (r["doc_id"], r["source_doc_id"]) == (9, 8)] == [(40, 60, 1.0)]


@pytest.mark.parametrize("period,first,second", [(1, 60, 60), (3, 20, 20), (6, 10, 10), (6, 10, 25), (9, 7, 7), (14, 5, 9)])
def test_passage_that_repeats_within_itself(spark, period, first, second):
    line = prose(period, 504).split()
    rows = [(1, " ".join([prose(33, 1), *line * first, prose(21, 2)]), "en", "a", 0), (2, " ".join([prose(18, 3), *line * second, prose(40, 4)]), "en", "a", 0)]
    covered = np.zeros(18 + period * second + 40, bool)
    for r in substring_dedup.repeated_passages(spark.createDataFrame(rows, DOCS)).collect():
        assert r["doc_id"] == 2 and r["similarity"] >= 0.8
        covered[r["start_word"]:r["start_word"] + r["n_words"]] = True
    assert covered[18:18 + period * second].all() and covered.sum() == period * second


def test_equal_links_make_one_chain(spark):
    links = spark.createDataFrame([(2, 1, p, p + 9) for p in (4, 4, 8, 12, 12, 300, 300)], "rid long, src long, pos int, at int")
    got = substring_dedup.chains(links, 5, 0.05, 1, 50).collect()
    assert sorted(tuple(r) for r in got) == [(2, 1, 4, 17, 13, 26), (2, 1, 300, 305, 309, 314)]


@pytest.mark.parametrize("edits,least", [(5, 1.0), (7, 1.0), (10, 0.95)])
def test_seeds_find_fuzzy_passages(edits, least):
    rng = np.random.default_rng(edits)
    hits = 0
    for _ in range(300):
        a, b = (rng.integers(0, 1 << 63, 150).astype(np.uint64) for _ in "ab")
        b[50:100] = a[50:100]
        at = 50 + rng.choice(np.arange(1, 49), edits, replace=False)
        b[at] = rng.integers(0, 1 << 63, edits).astype(np.uint64)
        common = np.intersect1d(*(substring_dedup.seeds_of(w, substring_dedup.K, substring_dedup.WINDOW)[0] for w in (a, b)))
        hits += len(common) >= substring_dedup.MIN_SEEDS
    assert hits >= least * 300


@pytest.mark.parametrize("similarity,share", [(0.8, 0.75), (0.85, 0.75), (0.9, 0.85)])
def test_fuzzy_passages_are_aligned(similarity, share):
    rng = np.random.default_rng(7)
    words = 0
    for _ in range(150):
        x, y = (rng.integers(0, 1 << 32, 270).astype("<u4") for _ in "xy")
        y[100:170] = x[100:170]
        at = 100 + rng.choice(70, round(70 * (1 - similarity)), replace=False)
        y[at] = rng.integers(0, 1 << 32, len(at))
        seed = next((i for i in range(100, 166) if (x[i:i + 5] == y[i:i + 5]).all()), None)
        found = substring_dedup.align(x, y, seed, seed)[0] if seed else []
        assert all(same * 5 >= 4 * max(b - a, d - c) for a, b, c, d, same in found)
        longest = max((min(b - a, d - c) for a, b, c, d, _ in found), default=0)
        words += longest * (longest >= 50)
    assert words >= share * 150 * 70


def test_walk_is_the_best_alignment_of_few_words():
    rng = random.Random(11)
    for _ in range(200):
        x = [rng.randint(0, 3) for _ in range(rng.randint(0, 12))]
        y = list(x)
        for _ in range(rng.randint(0, 3)):
            k = rng.randint(0, len(y))
            y[k:k + rng.randint(0, 1)] = [rng.randint(0, 3)] * rng.randint(0, 1)
        cost = np.zeros((len(x) + 1, len(y) + 1), int)
        for i in range(len(x) + 1):
            for j in range(len(y) + 1):
                cost[i, j] = max(i, j) if not i or not j else min(cost[i - 1, j - 1] + (x[i - 1] != y[j - 1]), cost[i - 1, j] + 1, cost[i, j - 1] + 1)
        runs = substring_dedup._walk(np.array(x, "<u4"), np.array(y, "<u4"))
        assert all(x[a:a + n] == y[b:b + n] for a, b, n in runs)
        assert all(a + n <= c and b + n <= d for (a, b, n), (c, d, _) in zip(runs, runs[1:]))
        if not cost[-1, -1]:
            assert runs == ([(0, 0, len(x))] if x else [])


def test_seeds_of_hot_documents_link_to_the_first_holder(spark, monkeypatch):
    rows = [(h, r, p) for h in (5, 9) for r in range(3, 300) for p in (r % 7, 40)] + [(7, 4, 1), (7, 4, 8), (8, 2, 3), (8, 6, 1)]
    parts = [(h, r, p, 0 if r < 6 else 1 if r == 6 and p < 9 else 2 + r % 64) if h in (5, 9) else (h, r, p, 0) for h, r, p in rows]
    got = substring_dedup.matches(spark.createDataFrame(parts, substring_dedup.SEED)).collect()
    first = lambda h: min((r, p) for g, r, p in rows if g == h)
    want = [(r, first(h)[0], p, first(h)[1], h in (5, 9)) for h, r, p in rows if h in (5, 9) or r != first(h)[0]]
    assert sorted(tuple(r) for r in got) == sorted(want)


# ---- 6 packing ----------------------------------------------------------------------

def test_best_fit_takes_the_fullest_row_that_fits():
    rng = random.Random(2)
    for _ in range(50):
        row = rng.randint(1, 40)
        lengths = [rng.randint(1, row) for _ in range(rng.randint(0, 60))]
        want: list[list[int]] = []
        room: list[int] = []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fit = [r for r in range(len(room)) if room[r] >= lengths[i]]
            r = min(fit, key=lambda r: room[r]) if fit else len(want)
            if not fit:
                want.append([])
                room.append(row)
            want[r].append(i)
            room[r] -= lengths[i]
        got = packing.best_fit(lengths, row)
        assert sorted(sum(got, [])) == list(range(len(lengths))) and all(sum(lengths[i] for i in r) <= row for r in got)
        assert sorted(sum(lengths[i] for i in r) for r in got) == sorted(sum(lengths[i] for i in r) for r in want)


def test_packed_rows_hold_every_token_once(spark):
    rows = [(i, [i * 1000 + t for t in range(n)]) for i, n in enumerate([0, 1, 5, 8, 9, 23, 8, 3])] + [(None, [7, 7]), (9, None), (2, [1, 2])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    for shards in (1, 3):
        got = packing.pack(df, row=8, pad=0, shards=shards).collect()
        parts = []
        for r in got:
            ids, pos = np.frombuffer(r["ids"], "<u4"), np.frombuffer(r["positions"], "<u4")
            assert len(ids) == len(pos) == 8 and r["n_tokens"] == r["cu_seqlens"][-1] <= 8
            for doc, start, a, b in zip(r["doc_ids"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:]):
                parts.append((doc, start, ids[a:b].tolist()))
                assert pos[a:b].tolist() == list(range(b - a))
        want = [(d, s, x[s:s + 8]) for d, x in rows if x for s in range(0, len(x), 8)]
        key = lambda t: (t[0] is None, t[0] or 0, t[1], t[2])
        assert sorted(parts, key=key) == sorted(want, key=key)
    assert packing.pack(df.limit(0)).count() == 0


# ---- 7 HTML -------------------------------------------------------------------------

WEIGHT = {"word": 1.0, "link": -0.5, "aside": -1.0, "t:other": -0.5, "t:marked": -3.0, "t:raw": -2.0, "t:p": -0.2, "t:/p": -0.2, "t:div": -1.0, "t:li": -1.0, "t:a": -1.0, "gap": 0.0, "in:tag": -0.05, "out:word": -1.0, "out:tag": -1.0}


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain words only", "plain words only"),
    ("<nav><a>Home</a></nav><article><h1>A&amp;B</h1><p>one <b>t</b>wo<br>three&nbsp;&#228;</p><p>fo\nur</article><footer>x y z</footer>", "A&B one two three ä fo ur"),
    ("<article><p>keep this text please</p><aside>not this</aside><div class='comments'><p>nor this one</p></div><p>and keep this</p></article>", "keep this text please and keep this"),
    ("<div class=menu><a>x</a> <a>y</a></div><div><p>the story goes on and on for long</p></div><script>var a='<p>no</p>';</script><div id=footer>c</div>", "the story goes on and on for long"),
    ("<article>a < b and c > d &lt;p&gt; end of it</article>", "a < b and c > d <p> end of it"),
    ("<p>long text in front of the article here</p><main><p>short</p><ul><li>list <a>of</a></li><li>items</li></ul><p>end</p></main><p>and behind it as well</p>", "short list of items end"),
    ("<article><p>unclosed <i>tags and <!-- gone --> words", "unclosed tags and words"),
])
def test_main_text_of_small_pages(page, text):
    assert html_extract.extract_text(page, WEIGHT) == text


def test_best_region_matches_brute_force():
    rng = random.Random(8)
    for _ in range(200):
        s = [rng.randint(-5, 5) for _ in range(rng.randint(0, 12))]
        a, b = html_extract.best_region(s)
        assert sum(s[a:b]) == max([0, *(sum(s[i:j]) for i in range(len(s)) for j in range(i + 1, len(s) + 1))])


def test_extract_rows(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>" + "many words here " * 20000 + "</p></article>"), (2, None, None), (None, "v", ""), (1, "u", "<article>x y</article>")],
                                  "page_id long, url string, html string").withColumns({"text": F.lit("mine")})
    got = html_extract.extract(pages, ["page_id", "url"]).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 3, 16 * 20000 - 1]
    assert html_extract.extract(pages.limit(0), ["page_id", "url"]).count() == 0


# ---- 8 quality classifier, 9 toxicity -------------------------------------------------

def labelled(spark, n=400):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        text = ". ".join(prose(12, 7000 + 31 * i + k) for k in range(rng.randint(3, 9))) + "."
        bad, rude = i % 5 == 0, i % 4 == 0
        if rude:
            w = text.split()
            for _ in range(2):
                w.insert(rng.randrange(len(w)), rng.choice(["idiot", "moron", "zquarl" + rng.choice("abc")]))
            text = " ".join(w)
        rows.append((i, text.upper() if bad else text, int(not bad), int(rude)))
    return spark.createDataFrame(rows, "doc_id long, text string, quality int, toxic int")


def test_rules_learn_and_score_every_row(spark, edge, empty):
    rows = labelled(spark)
    model = quality_classifier.fit(rows.where("doc_id % 3 <> 0"), "quality")
    assert 0 < len(model.rules) <= 60
    held = quality_classifier.classify(rows.where("doc_id % 3 = 0"), model).collect()
    assert np.mean([r["predicted"] == r["quality"] for r in held]) > 0.95
    got = quality_classifier.classify(clashing(edge), model).collect()
    assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert {r["score"] for r in quality_classifier.accepted(clashing(edge), model).collect()} <= {"mine"}
    assert quality_classifier.classify(empty, model).count() == 0
    flat = quality_classifier.fit(rows.limit(0), "quality")
    assert {r["score"] for r in quality_classifier.classify(edge, flat).collect()} == {0.5}
    ones = quality_classifier.fit(rows.where("quality = 1").limit(8), "quality")
    assert quality_classifier.classify(edge, ones).first()["score"] == pytest.approx(0.9)


def test_training_rows_are_bounded_and_never_held_out(spark):
    rows = labelled(spark, 60)
    picked = quality_classifier.training_rows(rows.select("doc_id", "text"), rows.select("doc_id", "quality").unionAll(rows.select("doc_id", F.lit(None).cast("int"))),
                                              "quality", quality_classifier.fold(4) != 2, sample=20)
    assert picked.count() == 20 and picked.where(quality_classifier.fold(4) == 2).count() == 0


def test_label_model_finds_accurate_and_repeated_voters():
    rng = np.random.default_rng(0)
    y = rng.random(4000) < 0.2
    good = (rng.random((4000, 3)) < np.where(y[:, None], 0.7, 0.02)).astype(float)
    noise = (rng.random((4000, 1)) < 0.3).astype(float)
    votes = np.concatenate([good, noise, good[:, :1]], axis=1)  # the last repeats the first
    model = toxicity.LabelModel(np.full(5, 0.5), np.full(5, 0.1), 0.2).fit(votes)
    assert np.mean((model.posterior(votes) > 0.5) == y) > 0.93
    assert model.rates[1][:3].min() > 0.5 and abs(model.rates[1][3] - model.rates[0][3]) < 0.1
    assert model.weight[0] < 0.7 and model.weight[4] < 0.7 and model.weight[1] > 0.9


def test_toxicity_learns_lexicon_and_stems(spark, edge, empty):
    rows = labelled(spark)
    model = toxicity.fit(rows.where("doc_id % 3 <> 0"), "toxic")
    held = model.score(rows.where("doc_id % 3 = 0"), ["doc_id", "toxic"]).collect()
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.95
    got = model.score(edge, ["doc_id"]).collect()
    assert len(got) == len(EDGE) and all(0 <= r["score"] <= 1 for r in got) and sum(r["predicted"] for r in got) == 0
    assert model.score(empty, ["doc_id"]).count() == 0
    flat = toxicity.fit(rows.limit(0), "toxic").score(edge, ["doc_id"]).collect()
    assert {r["score"] for r in flat} == {0.5}


# ---- 10 line quality ------------------------------------------------------------------

def brute_counts(text):
    import re
    text = text or ""
    ws = re.findall(r"[^\x20\x09-\x0D]+", text)
    win = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    hit = {i + k for i in range(len(ws) - 2) if win[tuple(ws[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_line_counts_match_brute_force(spark, edge, empty):
    rng = random.Random(6)
    texts = [r[1] for r in EDGE] + ["".join(rng.choice(["a ", "b ", "c", "\n", "é日", "#", " ", "\t", "x y z "]) for _ in range(rng.randint(0, 80))) for _ in range(60)]
    df = clashing(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    for r in line_quality.clean_lines(df).collect():
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute_counts(r["text"])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"])
    assert line_quality.clean_lines(empty).count() == 0


def test_bad_lines_go_first(spark):
    good = [prose(12, 40 + k).capitalize() + "." for k in range(6)]
    bad = ["Home | News | About | Contact", "WIN!! BIG!! MONEY!! NOW!!", "a** b## c$$ d%% e&& f||", "Read more", "We use cookies: see our cookie policy.", good[0]]
    rows = [(1, "\n".join(good + bad)), (2, "\n".join(good[:2] + ["a | b | c | d " * 12] * 1 + ["x!! " * 40]))]
    got = {r["doc_id"]: r for r in line_quality.clean_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["cleaned"] == "\n".join(good) and got[1]["kept"] and not got[2]["kept"]


# ---- 7: pages that mislead ---------------------------------------------------------------

STORY = "<p>" + "The river ran high and the boats stayed in port for the week. " * 6 + "</p>"
REPLY = "<p>Great story, thanks a lot</p>"


@pytest.mark.parametrize("page", [
    f"<body><div class='page-header-fixed'>{STORY}</div></body>",
    f"<body><div class='post social-science'>{STORY}</div></body>",
    f"<body><nav><a>Home</a><div>{STORY}</div></body>",
    f"<body><nav><a>Home</a><article>{STORY}</article></body>",
    f"<body><article>{STORY}<article class='comment'>{REPLY}</article></article></body>",
    f"<body><main>{STORY}</main><section class='comments'><article class='comment'>{REPLY}</article><article>{REPLY}</article></section></body>",
])
def test_pages_that_mislead(page):
    text = html_extract.extract_text(page, html_extract.weights({}))
    assert text.split()[:2] != [] and "The river ran high" in text and "Great" not in text and text.endswith("for the week.")


@pytest.mark.parametrize("name", html_extract.RAW)
def test_a_page_cut_inside_a_tag_ends_soon(name):
    import time
    start = time.time()
    for attribute in ('a="b" ', "a='b' ", 'a="b ', "a ", "/ "):
        html_extract.extract_text(f"<body><p>some words</p><{name} " + attribute * 10_000, html_extract.weights({}))
    assert time.time() - start < 10


def test_pages_repeat_tie_and_clash(spark):
    pages = [(1, "u", f"<body>{STORY}</body>"), (1, "u", f"<body>{STORY}</body>"), (None, None, None), (2, "v", ""), (3, "w", "<p>one two</p><hr><hr><hr><hr><hr><hr><hr><hr><hr><hr><p>six ten</p>")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({c: F.lit("mine") for c in ("text", "n_chars", "_h", "f", "inside")})
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in html_extract.extract(df, ["page_id", "url"], weight=html_extract.weights({})).collect())
    story = " ".join(["The river ran high and the boats stayed in port for the week."] * 6)
    assert got[0][1:] == got[1][1:] == (story, len(story)) and got[2] == ("2", "", 0) and got[4] == ("None", "", 0)
    assert got[3][1] in ("one two", "six ten", "one two six ten")
    assert html_extract.extract(df.where("false"), ["page_id"], weight=html_extract.weights({})).count() == 0


def test_pack_of_an_empty_table_and_clashing_columns(spark):
    rows = spark.createDataFrame([(1, [1, 2, 3]), (1, [1, 2, 3]), (None, [4]), (2, []), (3, None)], "doc_id long, ids array<int>")
    mine = rows.withColumns({c: F.lit("mine") for c in ("doc", "start", "part", "shard", "row", "positions")})
    [one] = packing.pack(mine, row=16, shards=1).collect()
    assert one.n_tokens == 7 and one.doc_ids == [1, 1, None] and one.cu_seqlens == [0, 3, 6, 7]
    assert packing.pack(mine.where("false"), row=16).count() == 0
