"""Toxicity by weak supervision.

Voters are words, word beginnings and patterns; a lexicon of voters is mined
from a bounded sample of labelled rows and added to a short fixed list.  A
generative label model (latent class, fitted by expectation maximisation to the
votes alone) estimates how often each voter fires on either class and, from the
residuals, how strongly voters depend on each other; voters that repeat each
other share one vote.  Its posterior labels train a linear classifier over
words and word beginnings, which scores every text in the scan's stage.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize

#: Labelled rows that training reads at most; mined voters; fewest toxic rows of a voter; features of the classifier.
SAMPLE, VOTERS, SUPPORT, FEATURES = 20_000, 150, 4, 600
#: Standard deviations by which a feature of the classifier must be commoner in toxic rows than chance.
GAIN = 7.5
#: Correlation beyond the classes from which two voters repeat each other.
REPEAT = 0.6
#: Share of the rows with a mined voter that must be toxic.
PRECISION = 0.8
#: Partitions of the bounded training rows.
PARTS = 6
THRESHOLD, PREFIXES = 0.5, (4, 5)
#: Fixed voters: common insults (whole words) and patterns on the lower-cased text.
LEXICON = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless", "disgusting", "clown",
           "imbecile", "dumbass", "jerk", "bastard", "vermin", "filth", "abschaum", "trottel", "connard", "imbécile", "estúpido", "basura")
PATTERNS = {
    "~you": r"\b(you are|you're|du bist|tu es|eres)\s+(an?\s+|such\s+an?\s+|ein\s+|eine\s+|un\s+|une\s+|una\s+)?\w+\s*!",
    "~hate": r"\b(shut up|go to hell|drop dead|kill yourself|hate you|halt die klappe|ta gueule|cállate)\b",
}
_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = {k: re.compile(v) for k, v in PATTERNS.items()}


def features(text: str | None) -> set[str]:
    """Words, marked word beginnings and fired patterns of a text."""
    low = (text or "").lower()
    ws = set(_WORD.findall(low))
    out = set(ws)
    for n in PREFIXES:
        out.update(["^" + w[:n] for w in ws if len(w) >= n])
    out.update(k for k, p in _PATTERNS.items() if p.search(low))
    return out


def with_features(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """(other columns, f array<string>): distinct features of each row's text."""
    keep = [c for c in rows.columns if c != text_col]

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array([sorted(features(t.as_py())) for t in part.column(len(keep))], pa.list_(pa.string()))], [*keep, "f"])

    src = rows.select(*keep, text_col)
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
    return src.mapInArrow(run, kinds + "f array<string>")


class LabelModel:
    """Latent-class model of voters that fire or stay silent: prior, firing rates by class, shared-vote weights from correlations.

    The rates are fitted to fired and silent votes.  A posterior counts the
    fired votes only (one more voter fires where all others are silent), so
    that a short text with one insult is not outvoted by the voters it has no
    room for.
    """

    def __init__(self, rates1: np.ndarray, rates0: np.ndarray, prior: float):
        self.rates, self.prior, self.weight = np.stack([rates0, rates1]), prior, np.ones(len(rates1))
        self.none = np.array([0.9, 0.1])

    def _squash(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x + math.log(self.prior / (1 - self.prior)), -50, 50)))

    def _fired(self, votes: np.ndarray) -> np.ndarray:
        return votes @ (self.weight * np.log(self.rates[1] / self.rates[0]))

    def _fit_posterior(self, votes: np.ndarray) -> np.ndarray:
        return self._squash(self._fired(votes) + (1 - votes) @ (self.weight * np.log((1 - self.rates[1]) / (1 - self.rates[0]))))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return self._squash(self._fired(votes) + ~votes.any(axis=1) * math.log(self.none[1] / self.none[0]))

    def correlations(self, votes: np.ndarray) -> np.ndarray:
        """Correlation of the votes that the classes do not explain."""
        p = self._fit_posterior(votes)[:, None]
        rest = votes - (p * self.rates[1] + (1 - p) * self.rates[0])
        size = np.sqrt((rest**2).mean(axis=0)) + 1e-12
        return (rest.T @ rest) / len(votes) / size / size[:, None]

    def fit(self, votes: np.ndarray, rounds: int = 30) -> "LabelModel":
        for step in range(rounds):
            p = self._fit_posterior(votes)
            n1, n0 = p.sum(), (1 - p).sum()
            self.prior = float(np.clip((n1 + 1) / (n1 + n0 + 2), 1e-4, 0.5))
            self.rates = np.stack([((1 - p) @ votes + 0.1) / (n0 + 10), (p @ votes + 0.5) / (n1 + 1)])
            if step % 10 == 5 and votes.shape[1]:
                c = np.abs(self.correlations(votes))
                self.weight = 1 / np.maximum(1, np.where(c > REPEAT, c, 0).sum(axis=1))
        silent = ~votes.any(axis=1)
        p = self._fit_posterior(votes)
        self.none = np.array([((1 - p) @ silent + 0.5) / ((1 - p).sum() + 1), (p @ silent + 0.5) / (p.sum() + 1)])
        return self


class ToxicityModel:
    """Linear classifier over features; ``score`` adds the columns to a table."""

    def __init__(self, intercept: float, weights: dict[str, float], label_model: LabelModel | None = None, voters: tuple[str, ...] = ()):
        self.intercept, self.weights, self.label_model, self.voters = intercept, weights, label_model, voters

    def score(self, docs: DataFrame, keep: list[str], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
        """``keep`` of every row, ``score`` (0 to 1) and ``predicted``.

        Null texts count as empty; texts of any length are read whole; each row
        is scored alone, so repeated rows score equally and an empty table gives
        none.  A score of exactly ``threshold`` is predicted 1.  Columns outside
        ``keep`` are not read, whatever their names; ``score`` and ``predicted``
        cannot be kept ones.
        """
        intercept, weights = self.intercept, self.weights

        def run(batches):
            known = weights.keys()
            for b in batches:
                x = np.array([intercept + sum(map(weights.__getitem__, features(t.as_py()) & known)) for t in b.column(len(keep))], np.float64)
                s = 1 / (1 + np.exp(-np.clip(x, -500, 500)))
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s), pa.array((s >= threshold).astype(np.int32))], [*keep, "score", "predicted"])

        src = docs.select(*keep, text_col)
        kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in src.schema.fields[:-1])
        return src.mapInArrow(run, kinds + "score double, predicted int")


def sketch(size: int = 4):
    """Hash of the smallest hashes among a row's long words: near copies of a training text mostly share it and count once."""
    long = F.filter("f", lambda w: F.length(w) >= 9)
    low = F.slice(F.sort_array(F.transform(long, lambda w: F.xxhash64(w))), 1, size)
    return F.when(F.size(low) == size, F.xxhash64(low)).otherwise(F.xxhash64("f"))


def mine_voters(rows: DataFrame, label: str, voters: int = VOTERS, support: int = SUPPORT) -> list[tuple[str, float, float]]:
    """(feature, rate on label 1, rate on label 0) of the features that tell label 1 best, by weight of evidence."""
    n1, n0 = rows.agg(F.coalesce(F.sum(label), F.lit(0)), F.coalesce(F.sum(1 - F.col(label)), F.lit(0))).first()
    if not n1 or not n0:
        return []
    seen = rows.select(label, F.explode("f").alias("w")).groupBy("w").agg(F.sum(label).alias("a"), F.sum(1 - F.col(label)).alias("b"))
    r1, r0 = (F.col("a") + 0.5) / (n1 + 1), (F.col("b") + 0.5) / (n0 + 1)
    listed = F.col("w").isin([*LEXICON, *PATTERNS])
    share, n = n1 / (n1 + n0), F.col("a") + F.col("b")
    rare = (F.col("a") - share * n) / F.sqrt(n * share * (1 - share))  # standard deviations above chance
    good = seen.where((F.col("a") >= support) & (rare >= 6) & (F.col("a") > PRECISION * n) | listed & (r1 > r0)).select("w", r1.alias("r1"), r0.alias("r0"))
    return [tuple(r) for r in good.orderBy(F.desc(F.col("r1") * F.log(F.col("r1") / F.col("r0"))), "w").limit(voters).collect()]


def fit(labelled: DataFrame, label: str, text_col: str = "text", voters: int = VOTERS, support: int = SUPPORT, width: int = FEATURES) -> ToxicityModel:
    """Model from bounded training rows (see ``training_rows`` of the quality classifier); null labels don't count.

    Labels choose the voters and their starting rates; the classifier sees the
    label model's posteriors only.  Near copies among the training rows count
    once: else every rare word of a text with many copies looked like evidence.
    Without rows of both labels every score is
    the smoothed share of label 1.
    """
    rows = materialize(with_features(labelled.where(F.col(label).isNotNull()).select(F.col(label).cast("int").alias("label"), text_col), text_col)
                       .withColumn("i", F.xxhash64("f")).withColumn("_copy", sketch()).dropDuplicates(["label", "_copy"]).drop("_copy").repartition(PARTS))
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    prior = (ones + 1) / (n + 2)
    mined = mine_voters(rows, "label", voters, support)
    if not mined:
        return ToxicityModel(math.log(prior / (1 - prior)), {})
    names = [m[0] for m in mined]
    found = rows.select("i", F.array_intersect("f", F.array(*map(F.lit, names))).alias("v")).toPandas()  # bounded by the training sample
    at = {w: k for k, w in enumerate(names)}
    votes = np.zeros((len(found), len(names)))
    for r, fired in enumerate(found["v"]):
        votes[r, [at[w] for w in fired]] = 1
    model = LabelModel(np.array([m[1] for m in mined]), np.array([m[2] for m in mined]), prior).fit(votes)
    found["p"] = model.posterior(votes)
    spark = labelled.sparkSession
    post = spark.createDataFrame(found.groupby("i", as_index=False)["p"].first())
    soft = rows.join(F.broadcast(post), "i")
    seen = F.col("a") + F.col("b")
    share = float(np.clip(found["p"].mean(), 1e-4, 0.9999))
    gain = (F.col("a") - share * seen) / F.sqrt(seen * share * (1 - share))  # standard deviations above chance
    vocabulary = [r["w"] for r in soft.select("p", F.explode("f").alias("w")).groupBy("w").agg(F.sum("p").alias("a"), F.sum(1 - F.col("p")).alias("b"))
                  .where((seen >= support) & (gain >= GAIN)).orderBy(F.desc(gain), "w").limit(width).collect()]
    if not vocabulary:
        return ToxicityModel(math.log(prior / (1 - prior)), {}, model, tuple(names))
    vectors = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="f", outputCol="features", binary=True)
    pairs = soft.select("f", F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("w")))).alias("x"))
    train = vectors.transform(pairs.select("f", "x.label", "x.w").where("w > 1e-6"))
    lr = LogisticRegression(weightCol="w", regParam=0.00001, elasticNetParam=0.0, maxIter=40, standardization=False).fit(train)
    weights = {w: float(c) for w, c in zip(vocabulary, lr.coefficients.toArray()) if c}
    return ToxicityModel(float(lr.intercept), weights, model, tuple(names))
