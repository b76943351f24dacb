"""The registered corpus queries on the smallest driver tables: SQL twins where SQL
can say it, brute force, the library or held-out labels elsewhere; the pipeline."""

import hashlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from tessera.checks.compare import compare_one, duck_connection
from tessera.llm import bpe, simhash_neardup, substring_dedup
from tessera.llm.queries import ORACLE, QUERIES, TOKENIZER


@pytest.fixture(scope="module")
def docs(small_sf):
    return pd.read_parquet(f"{small_sf}/documents.parquet")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_its_twin(spark, small_sf, name):
    r = compare_one(spark, duck_connection(small_sf), name, QUERIES[name], ORACLE[name], small_sf)
    assert r["cols_match"] and r["exact"], r


def test_near_duplicates_match_brute_force(spark, small_sf, docs):
    got = QUERIES["op3_simhash_neardup"](spark, small_sf).toPandas().set_index("doc_id")
    fps = docs.text.map(simhash_neardup.fingerprint).to_numpy(np.uint64)
    label = docs.doc_id.to_numpy().copy()
    for i in np.argsort(label):
        near = np.bitwise_count(fps ^ fps[i]) <= 4
        meet = np.unique(label[near])
        label[np.isin(label, meet)] = meet[0]
    assert got.loc[docs.doc_id, "component_id"].tolist() == label.tolist()
    assert got.loc[docs.doc_id, "fingerprint"].tolist() == [f"{int(f):016x}" for f in fps]


def test_bpe_matches_the_library(spark, small_sf, docs):
    got = QUERIES["op4_bpe"](spark, small_sf).toPandas().set_index("doc_id")
    lib = bpe.Codec(TOKENIZER).lib
    for r in docs.itertuples():
        ids = lib.encode(r.text, add_special_tokens=False).ids
        row = got.loc[r.doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def uncovered(docs, found, least=50):
    """Words of exact runs of ``least`` words that a smaller document has too and no reported passage covers."""
    words = {r.doc_id: substring_dedup.word_hashes(r.text) for r in docs.itertuples()}
    covered = {d: np.zeros(len(w), bool) for d, w in words.items()}
    for r in found.itertuples():
        covered[r.doc_id][r.start_word:r.start_word + r.n_words] = True
    holders = defaultdict(list)
    for d in sorted(words):
        for p in range(len(words[d]) - least + 1):
            holders[words[d][p:p + least].tobytes()].append((d, p))
    return [(d, p) for at in holders.values() for d, p in at if d != at[0][0] and not covered[d][p:p + least].all()]


def test_passages_cover_every_exact_repeat(spark, small_sf, docs):
    found = QUERIES["op5_substring_dedup"](spark, small_sf).toPandas()
    assert len(found) and found.n_words.min() >= 50 and found.similarity.min() >= 0.8
    assert not uncovered(docs, found)


def test_packed_rows_cover_every_token(spark, small_sf, docs):
    got = QUERIES["op6_packing"](spark, small_sf).toPandas()
    codec = bpe.Codec(TOKENIZER)
    held = defaultdict(dict)
    for r in got.itertuples():
        ids, positions = np.frombuffer(r.ids, "<u4"), np.frombuffer(r.positions, "<u4")
        assert len(ids) == len(positions) and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 and hashlib.sha256(r.positions).hexdigest() == r.positions_sha256
        for d, start, a, b in zip(r.doc_ids, r.starts, r.cu_seqlens, r.cu_seqlens[1:]):
            held[d][start] = ids[a:b]
            assert positions[a:b].tolist() == list(range(b - a))
    whole = {d: np.concatenate([parts[k] for k in sorted(parts)]).tobytes() for d, parts in held.items()}
    assert whole == {r.doc_id: x for r in docs.itertuples() if (x := codec.encode(r.text))}


def test_mix_marginals(spark, small_sf):
    got = QUERIES["op2_mixing"](spark, small_sf).toPandas()
    mass = (got.n_tokens * got.probability).groupby(got.source).sum()
    assert np.allclose(mass / mass.sum(), 1 / len(mass), atol=1e-6) and got.kept.any()


def test_pages(spark, small_sf):
    import html
    import re
    got = QUERIES["op7_html_extract"](spark, small_sf).toPandas().set_index("page_id")
    for r in pd.read_parquet(f"{small_sf}/pages.parquet").itertuples():
        m = re.search(r"<article>(.*?)</article>", r.html, re.S)
        if m:
            assert got.loc[r.page_id].text == " ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", m[1]))).split())


@pytest.mark.parametrize("name,label,divisor,fold,least", [("op8_quality_classifier", "quality", 4, 2, 0.9), ("op9_toxicity", "toxic", 5, 0, 0.8)])
def test_classifiers_on_held_out_labels(spark, small_sf, docs, name, label, divisor, fold, least):
    import zlib
    got = QUERIES[name](spark, small_sf).toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id) and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(d).encode()) % divisor == fold for d in got.doc_id]).all()
    both = got[got.held_out].merge(pd.read_parquet(f"{small_sf}/labels.parquet"), on="doc_id")
    assert (both.predicted == both[label]).mean() >= least


@pytest.mark.parametrize("name,label,divisor,fold", [("op8_quality_classifier", "quality", 4, 2), ("op9_toxicity", "toxic", 5, 0)])
def test_precision_and_recall_on_held_out_labels(spark, name, label, divisor, fold):
    sf = "/root/testdata/sf0.1"
    both = QUERIES[name](spark, sf).where("held_out").toPandas().merge(pd.read_parquet(f"{sf}/labels.parquet"), on="doc_id")
    hit = ((both.predicted == 1) & (both[label] == 1)).sum()
    assert both[label].sum() > 50 and hit >= 0.85 * both.predicted.sum() and hit >= 0.8 * both[label].sum()


def test_pipeline_stages_against_brute_force(spark, small_sf, tmp_path):
    import corpus_pipeline as cp
    rows = spark.read.parquet(f"{small_sf}/documents.parquet")
    columns, before = rows.columns, rows.toPandas()
    for k, (name, stage) in enumerate(cp.STAGES):
        stage(spark, rows, small_sf).write.parquet(str(tmp_path / str(k)))
        rows = spark.read.parquet(str(tmp_path / str(k)))
        now = rows.toPandas()
        if k < 4:
            assert rows.columns == columns
        if k == 1:
            fps = now.text.map(simhash_neardup.fingerprint).to_numpy(np.uint64)
            assert all((np.bitwise_count(fps ^ f) <= 4).sum() == 1 for f in fps) and set(now.doc_id) <= set(before.doc_id)
        if k == 2:
            assert set(now.doc_id) <= set(before.doc_id) and (now.n_chars == now.text.str.len()).mean() > 0.9
        if k == 4:
            codec = bpe.Codec(TOKENIZER)
            texts = before.drop_duplicates("doc_id").set_index("doc_id").text  # the mix may repeat documents
            assert sorted(now.doc_id) == sorted(before.doc_id)
            assert all(list(r.ids) == np.frombuffer(codec.encode(texts[r.doc_id]), "<u4").tolist() for r in now.itertuples())
        before = now
