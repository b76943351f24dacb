"""Quality classifier: a sparse rule ensemble over text statistics.

Statistics of each text are Spark column expressions.  A small random forest is
grown on a bounded sample of labelled rows; each path from a root to any node
below it is a conjunctive rule, and a lasso logistic regression over the 0/1
rules keeps few of them.  The rules that stay are compiled into one column
expression, so scoring is a map inside the scan's stage: no shuffle, no Python.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import let, part, tuck, untuck
from tessera.llm.line_quality import SPACE, SYMBOLS, words
from tessera.session import materialize

#: Labelled rows that training reads at most, chosen by a hash of their id.
SAMPLE = 20_000
TREES, DEPTH, LASSO, SEED = 12, 3, 0.0005, 7
THRESHOLD = 0.7
#: Partitions of the bounded training rows.
PARTS = 6

def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


#: Statistics of d: text t, words w, lines l, n words and their c characters.
STATISTICS = {
    "log_words": lambda d: F.log1p(d["n"]),
    "word_length": lambda d: _share(d["c"], d["n"]),
    "distinct_words": lambda d: _share(F.size(F.array_distinct(d["w"])), d["n"]),
    "upper": lambda d: _share(F.regexp_count(d["t"], F.lit(r"\p{Lu}")), d["c"]),
    "digits": lambda d: _share(F.regexp_count(d["t"], F.lit("[0-9]")), d["c"]),
    "symbols": lambda d: _share(F.regexp_count(d["t"], F.lit(SYMBOLS)), d["n"]),
    "shouts": lambda d: _share(F.regexp_count(d["t"], F.lit("[!?]{2,}")), d["n"]),
    "sentences": lambda d: _share(F.regexp_count(d["t"], F.lit(r"[.!?](?=\s|$)")), d["n"]),
    "repeated_lines": lambda d: 1 - F.size(F.array_distinct(d["l"])) / F.size(d["l"]),
    "line_words": lambda d: F.log1p(d["n"] / F.size(d["l"])),
}


def statistics(text: Column) -> Column:
    """Struct of the statistics of a text; null texts count as empty, whose shares are zero."""
    cut = lambda t: F.struct(t.alias("t"), words(t).alias("w"), F.split(t, "\n").alias("l"))
    count = lambda d: F.struct(d["t"].alias("t"), d["w"].alias("w"), d["l"].alias("l"), F.size(d["w"]).alias("n"),
                               (F.length(d["t"]) - F.regexp_count(d["t"], F.lit(SPACE))).alias("c"))
    every = lambda d: F.struct(*[f(d).cast("double").alias(k) for k, f in STATISTICS.items()])
    return let(F.coalesce(text, F.lit("")), lambda t: let(cut(t), lambda d: let(count(d), every)))


Condition = tuple[str, bool, float]  # statistic, whether at most, threshold


@dataclass
class RuleModel:
    """Rules (conjunctions of conditions) with weights; ``score`` is their logistic sum."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self, stats: Column) -> Column:
        total = F.lit(self.intercept)
        for conditions, weight in self.rules:
            total = total + F.when(rule(conditions, stats), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def rule(conditions: tuple[Condition, ...], stats: Column) -> Column:
    out = None
    for name, at_most, cut in conditions:
        c = stats[name]
        c = c <= cut if at_most else c > cut
        out = c if out is None else out & c
    return out


def paths(debug: str, names: list[str]) -> set[tuple[Condition, ...]]:
    """Rules of one tree from its printed form: the conditions on the way to each node below the root."""
    found, trail = set(), []
    for line in debug.splitlines():
        if m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-+\d.Ee]+)\)", line):
            trail = [t for t in trail if t[0] < len(m[1])] + [(len(m[1]), (names[int(m[2])], m[3] == "<=", float(m[4])))]
            tightest: dict[tuple[str, bool], float] = {}
            for _, (name, at_most, cut) in trail:
                old = tightest.get((name, at_most), cut)
                tightest[name, at_most] = min(old, cut) if at_most else max(old, cut)
            found.add(tuple(sorted((n, a, c) for (n, a), c in tightest.items())))
    return found


def fit(labelled: DataFrame, label: str, text_col: str = "text", trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleModel:
    """Model of a 0/1 ``label`` from bounded training rows; rows with a null label don't count.

    Without rows of both labels the score is the smoothed share of label 1.
    """
    names = list(STATISTICS)
    train = materialize(labelled.where(F.col(label).isNotNull()).select(F.col(label).cast("double").alias("label"), statistics(F.col(text_col)).alias("stats")).repartition(PARTS))
    n, ones = train.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    prior = math.log((ones + 1) / (n - ones + 1))
    if not 0 < ones < n:
        return RuleModel(prior)
    flat = VectorAssembler(inputCols=names, outputCol="features").transform(train.select("label", "stats", "stats.*"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, featureSubsetStrategy="0.6", maxBins=64).fit(flat)
    rules = sorted(set().union(*(paths(t.toDebugString, names) for t in forest.trees)))
    if not rules:
        return RuleModel(prior)
    hits = train.select("label", array_to_vector(F.array(*[rule(r, F.col("stats")).cast("double") for r in rules])).alias("features"))
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=30, standardization=False).fit(hits)
    weights = lr.coefficients.toArray()
    return RuleModel(float(lr.intercept), [(r, float(w)) for r, w in zip(rules, weights) if abs(w) > 1e-6])


def training_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, sample: int = SAMPLE) -> DataFrame:
    """At most ``sample`` labelled rows (those first by a hash of their id) that ``learn`` admits, with their texts."""
    picked = (labels.where(learn & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("_label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").withColumnRenamed("_label", label)


def fold(divisor: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def classify(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted``; input columns of these names give way.

    Null texts count as empty; each row is scored alone, so repeated rows score
    equally and an empty table gives none.  A score of exactly ``threshold`` is
    predicted 1.
    """
    return untuck(scored(docs, model, text_col, threshold), docs.columns, "score", "predicted")


def accepted(docs: DataFrame, model: RuleModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the model scores at least ``threshold``."""
    return scored(docs, model, text_col, threshold).where("predicted = 1").select("_row.*")


def scored(docs: DataFrame, model: RuleModel, text_col: str, threshold: float) -> DataFrame:
    rows = tuck(docs).withColumn("score", let(statistics(part(text_col)), model.score))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
