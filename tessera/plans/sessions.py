"""C14–C16 — web-session enrichment, conversion distributions, chi-squared tests.

Per-session work is a map-only projection; distributions and contingency
tables are partial/final aggregates whose size is the number of attribute
values, independent of the number of sessions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import bround, div_half_even, hms_seconds, minute_range_label, wrap_midnight
from tessera.functions.stats import chi2_finish_udf

# Test confidence and the two decision texts of the notebook.
PROBABILITY = 0.95
DEPENDENT = "Dependent (reject H0)"
INDEPENDENT = "Independent (fail to reject H0)"


def enrich(sessions: DataFrame) -> DataFrame:
    """C15: duration (midnight-wrapped), start hour, rounded minutes, minute range."""
    start = hms_seconds("session_start_text")
    dur = wrap_midnight(hms_seconds("session_end_text") - start)
    return sessions.select(
        "*",
        dur.alias("session_duration_sec"),
        (start / 3600).cast("int").alias("session_start_hour"),
        bround(dur / 60.0, 0).cast("int").alias("session_duration_min"),
        minute_range_label(dur).alias("session_duration_range"),
    )


def _anomaly(df: DataFrame) -> F.Column:
    return F.coalesce((F.col("clickouts") == 0) & (F.col("booking") == 1), F.lit(False))


def anomalies(sessions: DataFrame) -> DataFrame:
    """P16: sessions with a booking but no clickout — count and share (%) of all."""
    n_bad = F.count_if(_anomaly(sessions))
    n = F.count(F.lit(1))
    return sessions.agg(n.alias("n_sessions"), n_bad.alias("n_anomalies"),
                        (F.lit(100.0) * n_bad / n).alias("pct_anomalies"))


def clean(sessions: DataFrame) -> DataFrame:
    """P15: drop the booking-without-clickout anomalies."""
    return sessions.where(~_anomaly(sessions))


def conversion_distribution(sessions: DataFrame, var: str) -> DataFrame:
    """C16 ``calc_sessions_distribution(var)``: per value of ``var`` the sessions
    without and with a booking, the total and the booked share (4 dp).

    A value seen with one class only ends with total 0 and share 0 (the total
    is taken before NULLs are filled, as in the notebook).
    """
    # NULL keys are dropped after the aggregate (a NULL booking matches neither
    # pivot value).  The predicate also reads the counts, so Catalyst cannot
    # push it below the aggregate, where it would inline the derived key
    # expression into a filter and evaluate it again for every row.
    counts = (sessions.groupBy(var).pivot("booking", [0, 1]).agg(F.count(F.lit(1)))
              .where(F.when(F.col(var).isNull(), F.lit(False))
                     .otherwise(F.col("0").isNotNull() | F.col("1").isNotNull())))
    n0, n1 = F.col("0"), F.col("1")
    total = n0 + n1
    return counts.select(
        var,
        F.coalesce(n0, F.lit(0)).cast("long").alias("n_not_booked"),
        F.coalesce(n1, F.lit(0)).cast("long").alias("n_booked"),
        F.coalesce(total, F.lit(0)).cast("long").alias("total_sessions"),
        F.coalesce(div_half_even(n1, total, 4), F.lit(0.0)).alias("pct_booked"))


def chart_distributions(sessions: DataFrame, variables) -> DataFrame:
    """C20: the long table behind the distribution charts — per attribute value its sessions and booked share."""
    parts = [conversion_distribution(sessions, v).select(F.lit(v).alias("chart"), F.col(v).cast("string").alias("label"), "total_sessions", "pct_booked") for v in variables]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def crosstabs(df: DataFrame, row_var: str, tests) -> DataFrame:
    """(variable, rv, key, n): the observed cells of several (label, column, row filter or None) crosstabs, in one aggregate."""
    pairs = []
    for label, col, cond in tests:
        key = F.col(col).cast("string")
        if cond is not None:
            key = F.when(cond, key)
        pairs.append(F.struct(F.lit(label).alias("variable"), key.alias("key")))
    long = df.select(F.col(row_var).alias("rv"), F.inline(F.array(*pairs)))
    return (long.groupBy("variable", "rv", "key").agg(F.count(F.lit(1)).alias("n"))
            .where(F.when(F.col("rv").isNull() | F.col("key").isNull(), F.lit(False))
                   .otherwise(F.col("n") > 0)))


def _marginals(cells: DataFrame):
    rows = cells.groupBy("variable", "rv").agg(F.sum("n").alias("r"))
    cols = cells.groupBy("variable", "key").agg(F.sum("n").alias("c"))
    return rows, cols, rows.groupBy("variable").agg(F.sum("r").alias("total"))


def chi2_expected(df: DataFrame, row_var: str, tests) -> DataFrame:
    """C14 expected frequencies: (variable, rv, key, observed, expected = r·c/N) for every cell, empty ones too.

    The grid is the product of the marginals of one test, an equi-join of two
    small aggregates; the data are read once for the observed cells.
    """
    cells = crosstabs(df, row_var, tests)
    rows, cols, total = _marginals(cells)
    grid = rows.join(cols, "variable").join(total, "variable")
    return (grid.join(cells, ["variable", "rv", "key"], "left")
            .select("variable", "rv", "key", F.coalesce("n", F.lit(0)).cast("long").alias("observed"),
                    ((F.col("r") * F.col("c")).cast("double") / F.col("total").cast("double")).alias("expected")))


def chi2_low_cells(df: DataFrame, row_var: str, tests, least: float = 5.0) -> DataFrame:
    """(variable, n_cells, n_low): cells of each test, and those with an expected frequency below ``least``.

    No grid: a row with sum r has as many low cells as there are columns with
    c < least·N/r, a running count over the sorted marginals of the test.
    """
    rows, cols, total = _marginals(crosstabs(df, row_var, tests))
    bound = rows.join(total, "variable").select("variable", (F.lit(least) * F.col("total") / F.col("r")).alias("v"), F.lit(0).alias("is_col"))
    merged = cols.select("variable", F.col("c").cast("double").alias("v"), F.lit(1).alias("is_col")).unionAll(bound)
    below = Window.partitionBy("variable").orderBy("v", "is_col").rowsBetween(Window.unboundedPreceding, -1)  # a bound comes before an equal column
    counted = merged.withColumn("low", F.when(F.col("is_col") == 0, F.coalesce(F.sum("is_col").over(below), F.lit(0))))
    return counted.groupBy("variable").agg((F.sum("is_col") * F.sum(1 - F.col("is_col"))).cast("long").alias("n_cells"), F.sum("low").cast("long").alias("n_low"))


def chi2_statistics(df: DataFrame, row_var: str, tests) -> DataFrame:
    """Pearson chi-squared statistics of several crosstabs in ONE pass.

    ``tests`` is a list of (label, column, row filter or None).  Each row is
    expanded into one (test, key) pair per test it takes part in, so a single
    partial/final aggregate builds every contingency table.  Then, per test:
    without correction N·Σ O²/(r·c) − N over observed cells (zero cells add
    nothing); with it (dof = 1, 2×2) every cell has the same |O−E| = D, so the
    statistic is (D − min(½, D))² · N · Σ_i 1/r_i · Σ_j 1/c_j — no cell grid
    is built.  Marginals are two small aggregates of the cell table joined back
    to it, so no class of cells is gathered in one task.  One row per test; the
    statistic keeps full precision.
    """
    cells = crosstabs(df, row_var, tests)
    rows = cells.groupBy("variable", "rv").agg(F.sum("n").alias("r"), F.count(F.lit(1)).alias("k_r"))
    cols = cells.groupBy("variable", "key").agg(F.sum("n").alias("c"), F.count(F.lit(1)).alias("k_c"))
    j = cells.join(rows, ["variable", "rv"]).join(cols, ["variable", "key"])
    n, r, c = (F.col(x).cast("double") for x in ("n", "r", "c"))
    agg = j.groupBy("variable").agg(
        F.sum("n").alias("N"),
        F.count_distinct("rv").alias("R"),
        F.count_distinct("key").alias("C"),
        F.sum(n * n / (r * c)).alias("s1"),
        F.sum(F.lit(1.0) / (r * F.col("k_r"))).alias("inv_r"),
        F.sum(F.lit(1.0) / (c * F.col("k_c"))).alias("inv_c"),
        F.min_by(F.struct(n.alias("o"), r.alias("r"), c.alias("c")), F.struct("rv", "key")).alias("cell"))
    big_n = F.col("N").cast("double")
    dof = ((F.col("R") - 1) * (F.col("C") - 1)).cast("long")
    d = F.abs(F.col("cell.o") - F.col("cell.r") * F.col("cell.c") / big_n)
    yates = F.pow(d - F.least(F.lit(0.5), d), 2) * big_n * F.col("inv_r") * F.col("inv_c")
    plain = big_n * F.col("s1") - big_n
    stat = F.when(dof == 1, yates).when(dof == 0, F.lit(0.0)).otherwise(plain)
    return agg.select("variable", F.col("N").alias("n"), dof.alias("dof"), stat.alias("stat"))


def chi2_statistic(df: DataFrame, row_var: str, col_var: str, label: str | None = None) -> DataFrame:
    """Chi-squared statistic of one crosstab (see :func:`chi2_statistics`)."""
    return chi2_statistics(df, row_var, [(label or col_var, col_var, None)])


def chi2_finish(stats: DataFrame, probability: float = PROBABILITY) -> DataFrame:
    """Critical value, p-value and both decisions for rows of ``chi2_statistic``;
    the distribution functions run once over all test rows (one pandas UDF).
    Decisions use the full-precision values; all three are reported to 6 dp."""
    alpha = round(1.0 - probability, 12)
    fin = chi2_finish_udf(F.col("stat"), F.col("dof").cast("double"), F.lit(probability))
    raw = stats.select("variable", "n", "dof", "stat", fin.alias("_f"))
    dep_stat = F.abs("stat") >= F.col("_f.critical")
    dep_p = F.col("_f.p") <= F.lit(alpha)
    return raw.select(
        "variable", "n", "dof", F.lit(probability).alias("probability"),
        bround(F.col("_f.critical"), 6).alias("critical"), bround("stat", 6).alias("stat"), F.lit(alpha).alias("significance"),
        bround(F.col("_f.p"), 6).alias("p"),
        F.when(dep_stat, DEPENDENT).otherwise(INDEPENDENT).alias("decision_by_stat"),
        F.when(dep_p, DEPENDENT).otherwise(INDEPENDENT).alias("decision_by_p"))


def chi2_test(df: DataFrame, row_var: str, col_var: str, label: str | None = None,
              probability: float = PROBABILITY) -> DataFrame:
    """C14 chi-squared independence test of two attributes: statistic, dof,
    critical value, p-value and both decisions."""
    return chi2_finish(chi2_statistic(df, row_var, col_var, label), probability)


def notebook_crosstabs() -> list:
    return [("session_start_hour", "session_start_hour", None), ("session_duration_min", "session_duration_min", None),
            ("clickouts", "clickouts", F.col("clickouts") != 0)]


def notebook_tests(enriched_clean: DataFrame, stats_only: bool = False) -> DataFrame:
    """The notebook's three tests: start hour, duration minutes, clickouts (non-zero)."""
    stats = chi2_statistics(enriched_clean, "booking", notebook_crosstabs())
    return stats.withColumn("stat", bround("stat", 6)) if stats_only else chi2_finish(stats)
