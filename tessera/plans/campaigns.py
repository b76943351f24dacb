"""C8–C13, C20 — campaign KPIs, growth, metric development, spend scenario,
OLS forecast and the chart-ready series.

The per-week campaign table is an aggregate of the event stream (bounded by
weeks × campaigns); every step here is a groupBy or a window partitioned by
the series, so no step gathers the table in one task.  Money is carried as
DECIMAL until the output, ratios are rounded in exact integer arithmetic and
the regression uses the built-in least-squares aggregates; means, growth and
coefficients are rounded once, at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import bround, div_half_even, units
from tessera.operators.windows import forward_fill, positional_split, wow_growth

# Fixed values of the analysis: the scenario adds 250 per week to the target
# campaign from week 31 to week 45, the regression trains on the first 25 weeks.
LAST_WEEK = 30
EXTRA_SPEND = 250
FORECAST_LAST_WEEK = 45
TRAIN_WEEKS = 25
OVERALL = "Overall"
GROWTH_SCALE = 10   # decimals of means, growths and coefficients in the output
METRICS = ("Visits", "Revenue", "Cost", "Profit")


def _dec(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,8)")


def _diff(a, b) -> F.Column:
    """a − b of two DECIMAL sums without Spark's precision-loss rescale."""
    return a.cast("decimal(30,8)") - b.cast("decimal(30,8)")


def _romi(revenue, cost) -> F.Column:
    """ROMI = (Revenue − Cost)/Cost to 4 dp, from exact amounts."""
    return div_half_even(units(revenue) - units(cost), units(cost), 4)


def campaign_kpis(campaigns: DataFrame) -> DataFrame:
    """C8 per campaign and week (after U4 dedupe): Profit, ROMI, RPV."""
    df = campaigns.dropDuplicates()
    return df.select(
        "Week", "Campaign", "Visits", "Revenue", "Cost",
        _diff(_dec("Revenue"), _dec("Cost")).cast("double").alias("Profit"),
        _romi("Revenue", "Cost").alias("ROMI"),
        F.try_divide(F.col("Revenue"), F.col("Visits").cast("double")).alias("RPV"))


def market_kpis(campaigns: DataFrame) -> DataFrame:
    """A6 + C8: the weekly market roll-up with Profit, ROMI and RPV."""
    df = campaigns.dropDuplicates()
    wk = df.groupBy("Week").agg(F.sum("Visits").alias("Visits"),
                                F.sum(_dec("Revenue")).alias("_rev"),
                                F.sum(_dec("Cost")).alias("_cost"))
    return wk.select(
        "Week", F.col("Visits").cast("long").alias("Visits"),
        F.col("_rev").cast("double").alias("Revenue"), F.col("_cost").cast("double").alias("Cost"),
        _diff(F.col("_rev"), F.col("_cost")).cast("double").alias("Profit"),
        _romi(F.col("_rev"), F.col("_cost")).alias("ROMI"),
        F.try_divide(F.col("_rev").cast("double"), F.col("Visits").cast("double")).alias("RPV"))


def series_table(campaigns: DataFrame) -> DataFrame:
    """Overall market and every campaign as one long table keyed by ``series``."""
    per = campaign_kpis(campaigns).withColumnRenamed("Campaign", "series")
    overall = market_kpis(campaigns).withColumn("series", F.lit(OVERALL))
    return per.unionByName(overall)


def _long(series: DataFrame, metrics) -> DataFrame:
    return series.unpivot(["series", "Week"], [F.col(m).cast("double").alias(m) for m in metrics],
                          "metric", "value")


def growth_summary(series: DataFrame, metrics=METRICS + ("ROMI", "RPV")) -> DataFrame:
    """C9 ``calc_mean``: mean level and mean signed week-over-week growth per
    (series, metric).  A zero previous value gives no growth (NULL), not inf."""
    long = _long(series, metrics)
    w = Window.partitionBy("series", "metric").orderBy("Week")
    g = long.select("series", "metric", "value", wow_growth(F.col("value"), F.lag("value").over(w)).alias("g"))
    return g.groupBy("series", "metric").agg(
        bround(F.avg("value"), GROWTH_SCALE).alias("mean_abs"),
        bround(F.avg("g"), GROWTH_SCALE).alias("mean_wow_growth"))


def metric_development(series: DataFrame, metric: str, first_week: int = 1,
                       last_week: int = LAST_WEEK) -> DataFrame:
    """C10 ``calc_metric_dev``: min, max, mean, first/last week value (2 dp),
    first→last growth and mean WoW growth, for the market and each campaign."""
    x = F.col(metric).cast("double")
    w = Window.partitionBy("series").orderBy("Week")
    g = series.select("series", "Week", x.alias("x"), wow_growth(x, F.lag(x).over(w)).alias("g"))
    agg = g.groupBy("series").agg(
        F.min("x").alias("min"), F.max("x").alias("max"),
        F.avg("x").alias("mean_abs"),
        F.max(F.when(F.col("Week") == first_week, F.col("x"))).alias("w_first"),
        F.max(F.when(F.col("Week") == last_week, F.col("x"))).alias("w_last"),
        F.avg("g").alias("mean_wow_growth"))
    return agg.select(
        "series", F.lit(metric).alias("metric"),
        *[bround(c, 2).alias(c) for c in ("min", "max", "mean_abs")],
        bround("w_first", 2).alias(f"week{first_week}"), bround("w_last", 2).alias(f"week{last_week}"),
        bround(wow_growth(F.col("w_last"), F.col("w_first")), GROWTH_SCALE).alias(f"w{first_week}_to_w{last_week}_growth"),
        bround("mean_wow_growth", GROWTH_SCALE).alias("mean_wow_growth"))


def spend_scenario(campaigns: DataFrame, target: str, extra: int = EXTRA_SPEND,
                   last_week: int = LAST_WEEK, horizon: int = FORECAST_LAST_WEEK) -> DataFrame:
    """C11: week ``last_week`` as is, then every later week to ``horizon`` with
    each campaign frozen at its last week and the target's cost raised by
    ``extra`` per week, cumulatively (U7 row generation + N6 closed form)."""
    last = campaigns.dropDuplicates().where(F.col("Week") == last_week)
    weeks = F.sequence(F.lit(last_week + 1), F.lit(horizon))
    future = last.select(F.explode(weeks).alias("Week"), "Visits", "Campaign", "Revenue", "Cost")
    future = future.withColumn(
        "Cost", F.when(F.col("Campaign") == target,
                       F.col("Cost") + F.lit(float(extra)) * (F.col("Week") - last_week)).otherwise(F.col("Cost")))
    return (last.select("Week", "Visits", "Campaign", "Revenue", "Cost").unionByName(future)
            .select(F.col("Week").cast("int").alias("Week"), F.col("Visits").cast("long").alias("Visits"),
                    "Campaign", "Revenue", "Cost"))


def spend_scenario_ffill(campaigns: DataFrame, target: str, extra: int = EXTRA_SPEND,
                         last_week: int = LAST_WEEK, horizon: int = FORECAST_LAST_WEEK) -> DataFrame:
    """C11 as the notebook builds it: week-31 seeds, empty rows for the later
    weeks (only the target's cost set), then a forward fill per campaign (N4)."""
    last = campaigns.dropDuplicates().where(F.col("Week") == last_week)
    seed = last.select(F.lit(last_week + 1).alias("Week"), "Visits", "Campaign", "Revenue",
                       F.when(F.col("Campaign") == target, F.col("Cost") + float(extra))
                       .otherwise(F.col("Cost")).alias("Cost"))
    later = last.select(F.explode(F.sequence(F.lit(last_week + 2), F.lit(horizon))).alias("Week"),
                        F.lit(None).cast("long").alias("Visits"), "Campaign",
                        F.lit(None).cast("double").alias("Revenue"), F.col("Cost").alias("_last_cost"))
    later = later.select("Week", "Visits", "Campaign", "Revenue",
                         F.when(F.col("Campaign") == target,
                                F.col("_last_cost") + F.lit(float(extra)) * (F.col("Week") - last_week))
                         .alias("Cost"))
    filled = forward_fill(seed.unionByName(later), ["Campaign"], "Week", ["Visits", "Revenue", "Cost"])
    filled = last.select("Week", "Visits", "Campaign", "Revenue", "Cost").unionByName(filled)
    return filled.select(F.col("Week").cast("int").alias("Week"), F.col("Visits").cast("long").alias("Visits"),
                         "Campaign", "Revenue", "Cost")


def ols_coefficients(campaigns: DataFrame, target: str, x: str = "Cost", ys=("Revenue", "Visits"),
                     n_train: int = TRAIN_WEEKS) -> F.Column:
    """C12 fit: one-feature least squares per ``y`` on the first ``n_train``
    weeks of the target campaign, as ONE struct-valued scalar subquery
    ``{<y>: {slope, intercept}}`` (evaluated once, reused by every reference).

    """
    df = _train_flagged(campaigns, target, n_train).where("is_train")
    xd = F.col(x).cast("double")
    fits = [F.struct(F.regr_slope(F.col(y).cast("double"), xd).alias("slope"),
                     F.regr_intercept(F.col(y).cast("double"), xd).alias("intercept")).alias(y) for y in ys]
    return df.agg(F.struct(*fits).alias("_coef")).scalar()


def _train_flagged(campaigns: DataFrame, target: str, n_train: int) -> DataFrame:
    return positional_split(campaigns.dropDuplicates().where(F.col("Campaign") == target), ["Campaign"], "Week", n_train)


def ols_fit(campaigns: DataFrame, target: str, x: str = "Cost", ys=("Revenue", "Visits"),
            n_train: int = TRAIN_WEEKS) -> DataFrame:
    """C12: coefficients and the mean absolute error on the held-out weeks (2 dp)."""
    # the coefficients enter the plan once, as one struct column of the test rows
    test = (_train_flagged(campaigns, target, n_train).where(~F.col("is_train"))
            .select("*", ols_coefficients(campaigns, target, x, ys, n_train).alias("_coef")))
    coef = F.col("_coef")
    aggs = []
    for y in ys:
        pred = coef[y]["intercept"] + coef[y]["slope"] * F.col(x).cast("double")
        err = F.abs(F.col(y).cast("double") - pred)
        aggs.append(F.struct(F.lit(y).alias("target"),
                             bround(F.first(coef[y]["slope"]), GROWTH_SCALE).alias("slope"),
                             bround(F.first(coef[y]["intercept"]), GROWTH_SCALE).alias("intercept"),
                             bround(F.avg(err), 2).alias("mae")))
    return test.agg(F.array(*aggs).alias("_fits")).select(F.inline("_fits"))


def market_forecast(campaigns: DataFrame, target: str) -> DataFrame:
    """C13: predictions overwrite the target's scenario rows (the copied last
    week included; visits truncated), weekly roll-up, then appended to the
    actual weekly market — so the last actual week appears twice."""
    sc = spend_scenario(campaigns, target).select("*", ols_coefficients(campaigns, target).alias("_coef"))
    coef = F.col("_coef")
    is_t = F.col("Campaign") == target
    cost = F.col("Cost").cast("double")
    rev = F.when(is_t, coef["Revenue"]["intercept"] + coef["Revenue"]["slope"] * cost).otherwise(F.col("Revenue"))
    vis = F.when(is_t, (coef["Visits"]["intercept"] + coef["Visits"]["slope"] * cost).cast("long")) \
        .otherwise(F.col("Visits"))
    sc = sc.select("Week", vis.alias("Visits"), rev.alias("Revenue"), "Cost")
    future = sc.groupBy("Week").agg(F.sum("Visits").alias("Visits"), F.sum(_dec("Revenue")).alias("_rev"),
                                    F.sum(_dec("Cost")).alias("_cost"))
    future = future.select("Week", F.col("Visits").cast("long").alias("Visits"),
                           F.col("_rev").cast("double").alias("Revenue"), F.col("_cost").cast("double").alias("Cost"),
                           _diff(F.col("_rev"), F.col("_cost")).cast("double").alias("Profit"),
                           F.lit(True).alias("is_forecast"))
    actual = market_kpis(campaigns).select("Week", "Visits", "Revenue", "Cost", "Profit",
                                           F.lit(False).alias("is_forecast"))
    return actual.unionByName(future)


def forecast_growth(campaigns: DataFrame, target: str) -> DataFrame:
    """C9 over the forecast weeks: mean level and mean growth of the market after ``LAST_WEEK``."""
    weeks = market_forecast(campaigns, target).where(F.col("Week") > LAST_WEEK).withColumn("series", F.lit(OVERALL))
    return growth_summary(weeks, METRICS)


def chart_series(campaigns: DataFrame, target: str) -> DataFrame:
    """C20: the long tables behind the notebook's charts — market development
    (actual + forecast flag), ROMI and revenue per visitor per series."""
    s = series_table(campaigns)
    dev = (market_forecast(campaigns, target)
           .unpivot(["Week", "is_forecast"], [F.col(m).cast("double").alias(m) for m in METRICS], "metric", "value")
           .select(F.lit("market_development").alias("chart"), F.lit(OVERALL).alias("series"),
                   "Week", "metric", "value", "is_forecast"))
    kpi = (_long(s, ("ROMI", "RPV"))
           .select(F.lower("metric").alias("chart"), "series", "Week", "metric", "value",
                   F.lit(False).alias("is_forecast")))
    return dev.unionByName(kpi)
