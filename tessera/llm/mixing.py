"""Mixing documents to target weights by iterative proportional fitting.

Token counts per (source, language, topic) cell are one aggregate with map-side
partials, so a source that holds a third of all rows is one partial row a task.
Categories without a target share one rest category, so the cells are bounded
by the target tables, not by the data.  Raking scales the cells to each
marginal in turn until all agree; a cell's expected copies are its scale times
the share of tokens to keep.  That share is the one at which no document is
repeated, but ``KEEP`` at least: a rare cell does not set the size of the
sample, its documents are repeated, up to ``REPEATS`` times.  Kept tokens meet
the targets in expectation unless a cell runs out of repeats (a warning tells).
The part of a copy is decided by a hash of the document's id: the same rows
give the same sample however they are partitioned.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, part, tuck, untuck

REST = "other"
SEED = "mix-1"
TOLERANCE, ROUNDS = 1e-10, 10_000
#: Least share of the tokens that the sample has; most copies of a document.
KEEP, REPEATS = 0.25, 4
#: Topics by what a text holds, first match counts; fixed patterns.
TOPICS = {
    "licence": r"(?i)\blicen[cs]ed?\b|\bcopyright\b",
    "contact": r"[A-Za-z0-9]@[A-Za-z0-9-]+\.[A-Za-z]|\b\d{1,3}(\.\d{1,3}){3}\b",
    "table": r"\S \| \S",
    "figures": r"[0-9]",
}

#: Targets of the production mix (shares; they are scaled to one over the categories that occur).
TARGETS: dict[str, dict[str, float]] = {
    "source": {**{f"src{i}": 1.0 for i in range(20)}, REST: 1.0},
    "lang": {"en": 0.58, "de": 0.155, "fr": 0.155, "es": 0.11, REST: 0.01},
    "topic": {"prose": 0.93, "licence": 0.01, "contact": 0.01, "table": 0.01, "figures": 0.04},
}


def topic(text: Column) -> Column:
    text = F.coalesce(text, F.lit(""))
    out = F
    for name, pattern in TOPICS.items():
        out = out.when(text.rlike(pattern), name)
    return out.otherwise("prose")


def with_cells(docs: DataFrame, targets: Mapping[str, Mapping[str, float]], text_col: str = "text") -> DataFrame:
    """(_row, n_tokens, topic, cell): tucked rows, words, topic and a struct of the categories; null and unlisted ones are the rest."""
    df = tuck(docs).withColumn("n_tokens", F.regexp_count(F.coalesce(part(text_col), F.lit("")), F.lit(WORD)).cast("long")).withColumn("topic", topic(part(text_col)))
    side = lambda k: F.col("topic") if k == "topic" else part(k)
    cell = [F.when(side(k).isin(*t), side(k)).otherwise(REST).alias(k) for k, t in targets.items()]
    return df.withColumn("cell", F.struct(*cell))


def rake(tokens: Mapping[tuple[str, ...], float], targets: Mapping[str, Mapping[str, float]]) -> tuple[dict[tuple[str, ...], float], float]:
    """Scale of every cell and the largest gap between a marginal share and its target.

    Targets are taken over the categories that have tokens.  Where empty cells
    make the targets contradict each other the rounds end at the limit; the gap
    says so and a warning is given.
    """
    cells = [c for c, n in tokens.items() if n > 0]
    if not cells:
        return {}, 0.0
    mass = np.array([tokens[c] for c in cells], float)
    mass /= mass.sum()
    scale, sides = np.ones(len(cells)), []
    for k, (_, target) in enumerate(targets.items()):
        names = sorted({c[k] for c in cells})
        index = np.array([names.index(c[k]) for c in cells])
        want = np.array([max(0.0, target.get(n, 0.0)) for n in names])
        want = want / want.sum() if want.sum() else np.bincount(index, mass)
        sides.append((index, want))
    gap = 0.0
    for _ in range(ROUNDS):
        for index, want in sides:
            have = np.bincount(index, mass * scale, minlength=len(want))
            scale = scale * np.divide(want, have, out=np.zeros_like(want), where=have > 0)[index]
        gap = max(float(np.abs(np.bincount(i, mass * scale, minlength=len(w)) - w).max()) for i, w in sides)
        if gap < TOLERANCE:
            break
    else:
        warnings.warn(f"targets contradict each other in cells without tokens: a share is {gap:.2g} off", stacklevel=2)
    return dict(zip(cells, scale.tolist())), gap


def probabilities(celled: DataFrame, targets: Mapping[str, Mapping[str, float]]) -> dict[tuple[str, ...], float]:
    """Expected copies of a document of each cell.  At most one row per combination of target categories reaches the driver."""
    counts = celled.groupBy("cell").agg(F.sum("n_tokens").alias("n")).collect()
    scale, _ = rake({tuple(r["cell"]): float(r["n"] or 0) for r in counts}, targets)
    top = max(scale.values(), default=0.0)
    keep = max(1 / top, KEEP) if top else 0.0
    if keep * top > REPEATS:
        warnings.warn(f"{sum(s * keep > REPEATS for s in scale.values())} cells have too few tokens for their targets, also with {REPEATS} copies of each document", stacklevel=2)
    return {c: min(s * keep, float(REPEATS)) for c, s in scale.items()}


def unit_hash(ident: Column, text: Column, seed: str = SEED) -> Column:
    """Number in [0, 1) from the id, or from the text where the id is null."""
    key = F.concat(F.lit(seed + ":"), F.coalesce(ident.cast("string"), F.md5(F.coalesce(text, F.lit("")).cast("binary"))))
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``topic``, ``n_tokens``, ``probability``, ``kept`` and ``copies``; input columns of these names give way.

    ``probability`` is the expected number of copies, above one in rare cells.

    Rows without words have weight zero; they share the probability of their
    cell, which is zero if the whole cell is without words.  Rows equal in id
    share their fate.  An empty table stays empty.
    """
    return untuck(weighed(docs, targets, id_col, text_col), docs.columns, "topic", "n_tokens", "probability", "kept", "copies")


def sample(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] = TARGETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the mix keeps, each as often as it has copies, all columns as they are."""
    return weighed(docs, targets, id_col, text_col).where("kept").select("_row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("_row.*")


def weighed(docs: DataFrame, targets: Mapping[str, Mapping[str, float]], id_col: str, text_col: str) -> DataFrame:
    celled = with_cells(docs, targets, text_col)
    chance = probabilities(celled, targets)
    name = F.concat_ws("\x1f", *[F.col(f"cell.{k}") for k in targets])
    table = docs.sparkSession.createDataFrame([("\x1f".join(c), p) for c, p in chance.items()] or [("", 0.0)], "_cell string, _p double")
    joined = celled.withColumn("_cell", name).join(F.broadcast(table), "_cell", "left")  # bounded by the target tables
    return (joined.withColumn("probability", F.coalesce("_p", F.lit(0.0)))
            .withColumn("_u", unit_hash(part(id_col), part(text_col)))
            .withColumn("kept", F.col("_u") < F.col("probability"))
            .withColumn("copies", (F.floor("probability") + (F.col("_u") < F.col("probability") - F.floor("probability")).cast("int")).cast("int")))
