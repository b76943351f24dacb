"""Helpers shared by the operators: table access, row keys, connected components."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialize

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Non-null key of a row's id and text; only rows equal in both share it."""
    return F.xxhash64(F.col(id_col), F.col(id_col).isNull(), F.col(text_col), F.col(text_col).isNull())


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often it is used.

    Filters move below projections and take copies of their columns along; a
    lambda's argument is not copied.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def tuck(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as one struct column ``_row``, so that no added column can clash with theirs."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))


def part(column: str) -> Column:
    return F.col(f"_row.`{column}`")


def untuck(rows: DataFrame, columns: list[str], *more: str) -> DataFrame:
    """Columns of the tucked rows and ``more``; a tucked column gives way to one of ``more`` of the same name."""
    taken = {m.lower() for m in more}
    return rows.select(*[part(c).alias(c) for c in columns if c.lower() not in taken], *more)


def keyed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_row, _doc, _text, rid): tucked rows, id and text, and a long that identifies a document.

    ``rid`` is the id where all ids are non-null and unique (one aggregate over
    the ids tells).  Otherwise it is a hash of id and text for every row, so
    that rows equal in both are one document and no others mix.
    """
    rows = tuck(docs).select("_row", part(id_col).cast("long").alias("_doc"), part(text_col).alias("_text"))
    ids = docs.select(F.col(f"`{id_col}`").cast("long").alias("_doc"))
    unique = not ids.groupBy("_doc").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or _doc is null").limit(1).count()
    return rows.withColumn("rid", F.col("_doc") if unique else row_key("_doc", "_text"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Root (smallest node) of every node of an undirected edge list of longs.

    Alternating large-star / small-star rounds: every round is two aggregates
    with map-side partials and two equi-joins, so a hub with a third of all
    edges is one aggregated row on one side of a join that adaptive execution
    may split on the other.  Each round is checkpointed to the shared folder.
    Returns (node, root), one row per node that has an edge.
    """
    def state(e):
        row = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return tuple(row)

    e = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct())
    last = state(e)
    while last[0]:
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        near = large.groupBy("u").agg(F.min("v").alias("m"))
        e = materialize(large.join(near, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").where("u != v").distinct())
        now = state(e)
        if now == last:
            break
        last = now
    stars = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root").distinct())
