"""Profiling and cleaning operators.

Everything is a distributed aggregate; results are small tables (one row per
column, per bin or per duplicate group), never the data itself on the driver.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def numeric_columns(df: DataFrame) -> list[str]:
    return [n for n, t in df.dtypes if t in NUMERIC or t.startswith("decimal")]


def dedupe(df: DataFrame) -> DataFrame:
    """U4 ``drop_duplicates()``: exact duplicate rows removed (NULLs compare equal)."""
    return df.dropDuplicates()


def null_counts(df: DataFrame, cols=None) -> DataFrame:
    """P17 ``isnull().sum()``: one row per column (column, n_null)."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null")


def duplicate_summary(df: DataFrame, cols=None) -> DataFrame:
    """P18 ``duplicated().sum()`` with the row count and the distinct-row count.

    One partial/final aggregate on the full row; a hot duplicate group is
    collapsed map-side, so skew does not reach the shuffle.
    """
    cols = list(cols or df.columns)
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.sum("_n").cast("long").alias("n_rows"),
                      F.count(F.lit(1)).alias("n_distinct_rows"),
                      F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n_duplicate_rows"))


def duplicate_rows(df: DataFrame, cols=None, step: int = 65536) -> DataFrame:
    """P18 ``df[df.duplicated()]``: every second and later occurrence of a row.

    Copies are identical, so a row with n occurrences is written n − 1 times
    from its count: first one row per ``step`` copies, dealt to all tasks, then
    the copies, so that a group with most of the rows is split.
    """
    cols = list(cols or df.columns)
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    parts = groups.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("_n") - 2) / step))).alias("_part"))
    dealt = parts.repartition(F.xxhash64(*cols, "_part"))
    copies = F.least(F.lit(step), F.col("_n") - 1 - F.col("_part") * step)
    return dealt.select(*cols, F.explode(F.sequence(F.lit(1), copies.cast("int"))).alias("_copy")).drop("_copy")


QUARTILES = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))


def sort_key(x) -> F.Column:
    """A long that orders like the double ``x``: sign, exponent and fraction bits; NaN last, null as 0."""
    a = F.abs(x)
    near = F.floor(F.log2(a)).cast("int")  # may be one off next to a power of two
    two = lambda e: F.pow(F.lit(2.0), e)
    e = F.when(a >= two(near + 1), near + 1).when(a < two(near), near - 1).otherwise(near)
    bits = F.when(a < F.lit(2.0 ** -1022), (a / F.lit(5e-324)).cast("long")).otherwise(
        (e + 1023).cast("long") * (1 << 52) + ((a / two(e) - 1) * F.lit(2.0 ** 52)).cast("long"))
    whole = F.when(F.isnan(x), (2047 << 52) + 1).when(a == F.lit(float("inf")), 2047 << 52).otherwise(bits)
    return F.coalesce(F.when(x == 0, F.lit(0)).when(x < 0, -whole).otherwise(whole), F.lit(0)).cast("long")


def quantile_ends(values: DataFrame, quantiles, digit: int = 16) -> DataFrame:
    """(column, <name>_lo, <name>_hi ..): the values on both sides of the linear quantiles of (column, x, k, n) counts, by radix selection.

    ``k`` orders like ``x``.  Each round (four of 16 bits) counts one digit of the
    keys under the prefixes that hold a wanted rank, and keeps the longer
    prefixes that do.  A round's result has at most 65,536 rows per prefix kept,
    and a heavy-tailed column spreads over tasks like any other.
    """
    ranks = {f"{name}_{end}": f((F.col("total") - 1) * F.lit(q)) for name, q in quantiles for end, f in (("lo", F.floor), ("hi", F.ceil))}
    held = lambda rank: (rank >= F.col("before")) & (rank < F.col("before") + F.col("n"))
    kept = values.groupBy("column").agg(F.sum("n").alias("total")).select("column", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("start"), "total")
    for shift in range(64 - digit, -1, -digit):
        above = F.shiftright("k", shift + digit) if shift + digit < 64 else F.lit(0).cast("long")
        keys = ["column", "prefix", "start", "total", "next"]
        # the kept prefixes are six a column at most
        counts = (values.select("column", "x", "n", above.alias("prefix"), F.shiftright("k", shift).alias("next")).join(F.broadcast(kept), ["column", "prefix"])
                  .groupBy(*keys).agg(F.sum("n").alias("n"), F.min("x").alias("x")))
        earlier = Window.partitionBy("column", "prefix").orderBy("next").rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.withColumn("before", F.col("start") + F.coalesce(F.sum("n").over(earlier), F.lit(0)))
        last = placed.where(functools.reduce(operator.or_, map(held, ranks.values())))
        kept = last.select("column", F.col("next").alias("prefix"), F.col("before").alias("start"), "total")
    return last.groupBy("column").agg(*[F.min(F.when(held(rank), F.col("x"))).alias(name) for name, rank in ranks.items()])


def describe(df: DataFrame, cols=None, digit: int = 16) -> DataFrame:
    """A12 ``describe()``: count, mean, sample std, min, exact linear quartiles, max.

    The table is read twice: once for the moments, once for counts per value,
    which the rounds of the radix selection share.
    """
    cols = list(cols or numeric_columns(df))
    long = df.unpivot([], [F.col(c).cast("double").alias(c) for c in cols], "column", "x").where("x IS NOT NULL")
    base = long.groupBy("column").agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                                      F.min("x").alias("min"), F.max("x").alias("max"))
    values = long.groupBy("column", "x").agg(F.count(F.lit(1)).alias("n")).select("column", "x", sort_key(F.col("x")).alias("k"), "n")
    rank = lambda p: (F.col("count") - 1) * F.lit(p)
    line = [(F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * (rank(p) - F.floor(rank(p)))).alias(n) for n, p in QUARTILES]
    return base.join(quantile_ends(values, QUARTILES, digit), "column").select("column", "count", "mean", "std", "min", *line, "max")


def text_range(df: DataFrame, cols) -> DataFrame:
    """A10 on text: smallest and largest value of each column."""
    return df.unpivot([], list(cols), "column", "x").groupBy("column").agg(F.min("x").alias("min"), F.max("x").alias("max"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """A14 ``hist()``: counts in ``bins`` equal-width bins between min and max, empty ones too.

    The last bin is closed on the right; a constant column spans [v-0.5, v+0.5]
    (NumPy's rule).  min/max are one scalar subquery.  A column without values has no bins.
    """
    x = F.col(col).cast("double")
    stats = df.select(F.min(x).alias("lo"), F.max(x).alias("hi"))
    bounds = stats.select(F.struct(
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi")).alias("_b"))
    rows = df.select(x.alias("_x"), bounds.scalar().alias("_b")).where(F.col("_x").isNotNull())
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    width = (hi - lo) / F.lit(float(bins))
    b = F.least(F.floor((F.col("_x") - lo) / width).cast("int"), F.lit(bins - 1))
    counts = rows.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = bounds.where("_b.lo IS NOT NULL").select("_b", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return every.join(counts, "bin", "left").select("bin", (lo + F.col("bin") * width).alias("bin_lower"),
                                                    (lo + (F.col("bin") + 1) * width).alias("bin_upper"),
                                                    F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """P19/A13 ``unique()``: the distinct values of one column with their counts."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))


def profile(df: DataFrame) -> DataFrame:
    """P19 ``shape`` + ``info()``: per column its type, rows, non-null and distinct count.

    One pass over (column, value) pairs and one distinct aggregate, whatever the number of columns.
    """
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    long = df.unpivot([], [F.col(c).cast("string").alias(c) for c in df.columns], "column", "value")
    groups = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return groups.groupBy("column").agg(
        F.sum("n").alias("n_rows"), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("n_non_null"),
        F.count("value").alias("n_distinct")).select("column", F.element_at(types, F.col("column")).alias("dtype"), "n_rows", "n_non_null", "n_distinct")


def head(df: DataFrame, n: int, order_by) -> DataFrame:
    """O3 head/tail: ``orderBy(...).limit(n)`` (tail = descending order)."""
    return df.orderBy(*order_by).limit(n)
