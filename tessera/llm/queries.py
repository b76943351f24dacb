"""The ``opN_*`` queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tessera.llm import (bpe, html_extract, line_quality, mixing, packing, periodic_runs, prefix_forest, quality_classifier,
                         simhash_neardup, substring_dedup, topk_search, toxicity, whitening)
from tessera.llm.common import WORD, let, read_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_topk_search(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0))


def op2_mixing(spark, sf_dir):
    return mixing.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "kept", "copies")


def op3_simhash_neardup(spark, sf_dir):
    return simhash_neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_bpe(spark, sf_dir):
    return bpe.encode(read_table(spark, sf_dir, "documents"), TOKENIZER, ["doc_id"], want=("n_tokens", "ids_sha256", "decoded_sha256"))


def op5_substring_dedup(spark, sf_dir):
    return substring_dedup.repeated_passages(read_table(spark, sf_dir, "documents"))


def op6_packing(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    tokens = (docs.agg(F.sum(F.length("text"))).first()[0] or 0) // 2  # sizes the shards only
    return packing.pack(bpe.encode(docs, TOKENIZER, ["doc_id"], want=("ids_binary",)), ids_col="ids_binary", total_tokens=tokens)


def op7_html_extract(spark, sf_dir):
    return html_extract.extract(read_table(spark, sf_dir, "pages"), ["page_id", "url"])


def quality_model(spark, sf_dir) -> quality_classifier.RuleModel:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    rows = quality_classifier.training_rows(docs, labels, "quality", quality_classifier.fold(4) != 2)
    return quality_classifier.fit(rows, "quality")


def op8_quality_classifier(spark, sf_dir):
    scored = quality_classifier.classify(read_table(spark, sf_dir, "documents").select("doc_id", "text"), quality_model(spark, sf_dir))
    return scored.select("doc_id", (quality_classifier.fold(4) == 2).alias("held_out"), "score", "predicted")


def op9_toxicity(spark, sf_dir):
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    rows = quality_classifier.training_rows(docs, labels, "toxic", quality_classifier.fold(5) != 0, toxicity.SAMPLE)
    scored = toxicity.fit(rows, "toxic").score(docs, ["doc_id"])
    return scored.select("doc_id", (quality_classifier.fold(5) == 0).alias("held_out"), "score", "predicted")


def op10_line_quality(spark, sf_dir):
    return line_quality.clean_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "cleaned")


def repeating(docs):
    """(doc_id, text): documents whose hashed id ends in 0 repeat the words of their end, as the contract of op11 plants them."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def planted(words):
        n = F.size(words)
        g = F.floor(h / 10)
        a = F.pmod(g, n)
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        return F.when(n > 0, let(F.struct(a.cast("int").alias("a"), p.cast("int").alias("p")), lambda v: F.array_join(F.transform(
            words, lambda w, i: F.when(i >= v["a"], F.get(words, v["a"] + F.pmod(i - v["a"], v["p"]))).otherwise(w)), " ")))

    repeated = let(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), planted)
    return docs.select("doc_id", F.when(F.pmod(h, F.lit(10)) == 0, repeated).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark, sf_dir):
    found = periodic_runs.periodic_runs(repeating(read_table(spark, sf_dir, "documents")), ["doc_id"])
    # greatest length / period; the earlier run (smaller start, then period) stays on ties
    best = F.reduce("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"), lambda b, r: F.when(
        b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))), "")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256")))


def op12_whitening(spark, sf_dir):
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op13_prefix_forest(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return prefix_forest.neighbours(vectors, vectors.where(F.col("vec_id") % 20 == 0))


QUERIES = {f.__name__: f for f in (
    op1_topk_search, op2_mixing, op3_simhash_neardup, op4_bpe, op5_substring_dedup, op6_packing, op7_html_extract,
    op8_quality_classifier, op9_toxicity, op10_line_quality, op11_periodic_runs, op12_whitening, op13_prefix_forest)}

ORACLE = {"op1_topk_search": topk_search.ORACLE, "op10_line_quality": line_quality.ORACLE}
