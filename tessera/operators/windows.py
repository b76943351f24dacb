"""Window operators: growth, forward fill, positional split.

Windows are partitioned by the series key, so each task holds one series
(weeks of one campaign), never the whole table; ``prefix_scan`` also splits a
series over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _series_window(partition_by, order_by):
    # an unpartitioned window would pull the whole table into one task
    if not partition_by:
        raise ValueError("a series key is required: windows are partitioned per series")
    return Window.partitionBy(*partition_by).orderBy(*order_by)


def wow_growth(x, prev) -> F.Column:
    """N3 ``abs(pct_change) * sign(diff)``: |x/prev − 1|·sign(x − prev).

    NULL where the previous value is missing or zero (the frame gives ±inf).
    """
    x, prev = F.col(x) if isinstance(x, str) else x, F.col(prev) if isinstance(prev, str) else prev
    return F.abs(F.try_divide(x, prev) - 1) * F.signum(x - prev)


def forward_fill(df: DataFrame, series, order_col: str, cols) -> DataFrame:
    """N4 ``fillna(method='ffill')`` per series: last non-NULL value so far."""
    w = _series_window(series, [order_col]).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(*[F.last(c, ignorenulls=True).over(w).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def order_buckets(df: DataFrame, order_col: str, buckets: int) -> list:
    """Cut points of ``order_col`` into about equal parts: a bounded list, from one approximate-percentile job."""
    shares = [k / buckets for k in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(order_col, shares, 10 * buckets).alias("c")).first().c if shares else []
    return sorted(set(cuts or []))


def prefix_scan(df: DataFrame, order_col: str, bucket, fill=(), sums=(), series=()) -> DataFrame:
    """N4/N6 over many tasks: ``fill`` columns forward filled, running totals ``<name>_total`` of ``sums``.

    ``bucket`` is a column that never falls as ``order_col`` rises (a month of a
    timestamp, a quotient of a number); rows are dealt by (series, bucket), so
    one series is no longer one task.  Inside a bucket a window does the work; a
    small table with one row per bucket carries the last non-null value and the
    total on to the later ones.  Rows with equal order get any order among
    themselves, as with one window.  Null orders come first, in a bucket of
    their own.
    """
    keys, series = [*series, "_bucket"], list(series)
    own = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys).orderBy(order_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = own.withColumns({**{f"_f_{c}": F.last(c, ignorenulls=True).over(inside) for c in fill},
                             **{f"_s_{c}": F.sum(c).over(inside) for c in sums}})
    ends = own.groupBy(*keys).agg(*[F.max_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.struct(order_col))).alias(f"_e_{c}") for c in fill],
                                  *[F.sum(c).alias(f"_t_{c}") for c in sums], F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*(series or [F.lit(0)])).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)  # one row a bucket
    carry = ends.select(*keys, *[F.last(f"_e_{c}", ignorenulls=True).over(before).alias(f"_b_{c}") for c in fill],
                        *[F.sum(f"_t_{c}").over(before).alias(f"_c_{c}") for c in sums])
    same = [local[k].eqNullSafe(carry[k]) for k in keys]
    joined = local.join(carry, _all(same))
    total = lambda c: F.when(F.col(f"_s_{c}").isNull(), F.col(f"_c_{c}")).otherwise(F.col(f"_s_{c}") + F.coalesce(F.col(f"_c_{c}"), F.lit(0)))
    return joined.select(*[F.coalesce(f"_f_{c}", f"_b_{c}").alias(c) if c in fill else local[c] for c in df.columns],
                         *[total(c).alias(f"{c}_total") for c in sums])


def _all(conditions) -> F.Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def positional_split(df: DataFrame, series, order_col: str, n_first: int) -> DataFrame:
    """N5 ``x[:n]`` / ``x[n:]``: flags the first ``n_first`` rows of each series
    (in ``order_col`` order) with ``is_train``."""
    w = _series_window(series, [order_col])
    return df.select("*", (F.row_number().over(w) <= n_first).alias("is_train"))
