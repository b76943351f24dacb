"""Registry of the runnable queries: name -> (spark, sf_dir) -> DataFrame.

Each entry builds the reference job's inputs from the driver tables
(``tessera.sources.fixtures``) and runs the job on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import cleaning, windows
from tessera.plans import campaigns, finance, heatmap, licences, lifecycle, reconcile, sessions, zones
from tessera.sources import fixtures as fx
from tessera.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]


def churn_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return lifecycle.churn_monthly(fx.journeys(t, task_rows=lifecycle.TASK_ROWS), fx.users(t), fx.AS_OF)


def churn_user_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return lifecycle.user_month_states(fx.journeys(t, task_rows=lifecycle.TASK_ROWS), fx.AS_OF)


def _finance(spark, sf_dir, granularity):
    t = Tables(spark, sf_dir)
    j = fx.journeys(t, first_ride=False)
    return finance.finance_report(fx.finance_daily(t, j), fx.partner_costs(t), j, granularity, granularity)


def finance_weekly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finance(spark, sf_dir, "week")


def finance_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _finance(spark, sf_dir, "month")


def finance_partner_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return finance.partner_split(fx.partner_costs(t), fx.journeys(t, first_ride=False), "month", "period")


def _recon(spark, sf_dir, mode, windows=None):
    t = Tables(spark, sf_dir)
    spec = reconcile.ReconcileSpec(**fx.RECON_SPEC)
    if windows is None:
        a, b = fx.RECON_SINGLE_WINDOW
        return reconcile.reconcile_window(fx.recon_source(t), fx.recon_target(t), spec, mode, a, b, fx.RUN_TS)
    users = reconcile.ReconcileSpec(**fx.RECON_USERS_SPEC)
    return reconcile.reconcile_batch(
        {spec.source_collection: fx.recon_source(t), users.source_collection: fx.recon_users_source(t)},
        {spec.target_table: fx.recon_target(t), users.target_table: fx.recon_users_target(t)},
        [spec, users], [mode], windows, fx.RUN_TS)[mode]


def reconcile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recon(spark, sf_dir, "docs_level")


def reconcile_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recon(spark, sf_dir, "fields_level")


def reconcile_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recon(spark, sf_dir, "docs_level", fx.RECON_WINDOWS)


def reconcile_batch_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recon(spark, sf_dir, "fields_level", fx.RECON_WINDOWS)


def _sessions(spark, sf_dir):
    return fx.sessions(Tables(spark, sf_dir))


def _clean_sessions(spark, sf_dir):
    return sessions.clean(sessions.enrich(_sessions(spark, sf_dir)))


def sessions_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.enrich(_sessions(spark, sf_dir))


def sessions_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.anomalies(_sessions(spark, sf_dir))


def sessions_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_sessions(spark, sf_dir)


def sessions_by_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.conversion_distribution(_clean_sessions(spark, sf_dir), "session_duration_range")


def sessions_by_clickouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.conversion_distribution(_clean_sessions(spark, sf_dir), "clickouts")


def sessions_chi2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.notebook_tests(_clean_sessions(spark, sf_dir), stats_only=True)


def sessions_chi2_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.notebook_tests(_clean_sessions(spark, sf_dir))


def sessions_expected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.chi2_expected(_clean_sessions(spark, sf_dir), "booking", sessions.notebook_crosstabs())


def sessions_low_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.chi2_low_cells(_clean_sessions(spark, sf_dir), "booking", sessions.notebook_crosstabs())


#: Events in a bucket of the long series.
SERIES_BUCKET = 16_384


def events_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one series: the last purchase's k so far, and the value so far."""
    rows = Tables(spark, sf_dir).events.select("event_id", F.col("value").cast("decimal(18,2)").alias("value"),
                                               F.when(F.col("event_type") == "purchase", F.get_json_object("props", "$.k").cast("int")).alias("k"))
    return windows.prefix_scan(rows, "event_id", F.floor(F.col("event_id") / SERIES_BUCKET), fill=["k"], sums=["value"])


SESSION_MEASURES = ("clickouts", "booking", "session_duration_sec", "session_start_hour", "session_duration_min")


def _rounded(d: DataFrame) -> DataFrame:
    return d.select("column", "count", *[F.bround(c, 6).alias(c) if c not in ("min", "max") else F.col(c)
                                         for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def sessions_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cleaning.describe(_clean_sessions(spark, sf_dir), SESSION_MEASURES))


def sessions_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.histogram(_sessions(spark, sf_dir), "booking", 10)


def sessions_text_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.text_range(_sessions(spark, sf_dir), ("session_start_text", "session_end_text"))


def sessions_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.head(_sessions(spark, sf_dir), 5, ["session"])


def sessions_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.duplicate_summary(_sessions(spark, sf_dir))


def sessions_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.duplicate_rows(_sessions(spark, sf_dir).drop("session", "session_start_text"))


def sessions_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.dedupe(_sessions(spark, sf_dir).drop("session"))


def chart_distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.chart_distributions(_clean_sessions(spark, sf_dir), ("session_duration_range", "clickouts"))


def _campaigns(spark, sf_dir):
    return fx.campaigns(Tables(spark, sf_dir))


def forecast_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.forecast_growth(_campaigns(spark, sf_dir), fx.CAMPAIGN_TARGET)


def market_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.head(campaigns.market_kpis(_campaigns(spark, sf_dir)), 5, [F.desc("Week")])


def market_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(cleaning.describe(campaigns.market_kpis(_campaigns(spark, sf_dir)), ("Visits", "Revenue", "Cost", "Profit")))


def campaign_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.campaign_kpis(_campaigns(spark, sf_dir))


def market_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.market_kpis(_campaigns(spark, sf_dir))


def campaign_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.growth_summary(campaigns.series_table(_campaigns(spark, sf_dir)))


def campaign_metric_dev(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = campaigns.series_table(_campaigns(spark, sf_dir))
    return campaigns.metric_development(s, "RPV").unionByName(campaigns.metric_development(s, "ROMI"))


def campaign_scenario(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.spend_scenario(_campaigns(spark, sf_dir), fx.CAMPAIGN_TARGET)


def forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.spend_scenario_ffill(_campaigns(spark, sf_dir), fx.CAMPAIGN_TARGET)


def campaign_ols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.ols_fit(_campaigns(spark, sf_dir), fx.CAMPAIGN_TARGET)


def market_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.market_forecast(_campaigns(spark, sf_dir), fx.CAMPAIGN_TARGET)


def chart_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return campaigns.chart_series(_campaigns(spark, sf_dir), fx.CAMPAIGN_TARGET)


def _zone_trips(spark, sf_dir):
    since, city, status = fx.TRIP_FILTER
    return zones.select_trips(fx.trips(Tables(spark, sf_dir)), since, city, status)


def zone_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_flags(_zone_trips(spark, sf_dir), fx.ZONES)


def zone_flags_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_flags(_zone_trips(spark, sf_dir), fx.star_zones(Tables(spark, sf_dir)))


def zone_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_summary(zones.zone_flags(fx.trips(Tables(spark, sf_dir)), fx.ZONES))


def zone_flags_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zones.zone_flags(_zone_trips(spark, sf_dir), [fx.round_zone()])


def fixed_vs_tariff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return heatmap.fixed_vs_tariff(fx.heatmap_trips(Tables(spark, sf_dir)))


def _cells(t):
    return fx.heatmap_table(heatmap.fixed_vs_tariff(fx.heatmap_trips(t)))


def heatmap_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return heatmap.heatmap_cells(_cells(t), fx.airports(t))


def heatmap_new_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return heatmap.heatmap_cells(_cells(t), fx.airports(t), direction="from",
                                 values_field="price_tariff_rub_discounted", is_new_prices=True)


def licence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = Tables(spark, sf_dir)
    return licences.licence_check(fx.licence_lines(t), fx.licence_registry(t))


def profile_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.null_counts(_sessions(spark, sf_dir))


def profile_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.profile(_sessions(spark, sf_dir))


def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.duplicate_summary(_campaigns(spark, sf_dir))


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.duplicate_rows(_campaigns(spark, sf_dir))


def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.dedupe(_campaigns(spark, sf_dir))


def distinct_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.distinct_values(_campaigns(spark, sf_dir), "Campaign")


QUERIES: dict[str, Query] = {
    "churn_monthly": churn_monthly,
    "churn_user_states": churn_user_states,
    "finance_weekly": finance_weekly,
    "finance_monthly": finance_monthly,
    "finance_partner_split": finance_partner_split,
    "reconcile_counts": reconcile_counts,
    "reconcile_sums": reconcile_sums,
    "reconcile_batch_counts": reconcile_batch_counts,
    "reconcile_batch_sums": reconcile_batch_sums,
    "zone_flags": zone_flags,
    "zone_summary": zone_summary,
    "zone_flags_round": zone_flags_round,
    "zone_flags_table": zone_flags_table,
    "campaign_kpis": campaign_kpis,
    "market_kpis": market_kpis,
    "market_tail": market_tail,
    "market_describe": market_describe,
    "campaign_growth": campaign_growth,
    "campaign_metric_dev": campaign_metric_dev,
    "campaign_scenario": campaign_scenario,
    "forward_fill": forward_fill,
    "campaign_ols": campaign_ols,
    "market_forecast": market_forecast,
    "forecast_growth": forecast_growth,
    "chart_series": chart_series,
    "chart_distributions": chart_distributions,
    "sessions_enriched": sessions_enriched,
    "sessions_anomalies": sessions_anomalies,
    "sessions_clean": sessions_clean,
    "sessions_by_duration": sessions_by_duration,
    "sessions_by_clickouts": sessions_by_clickouts,
    "sessions_chi2": sessions_chi2,
    "sessions_chi2_test": sessions_chi2_test,
    "sessions_expected": sessions_expected,
    "sessions_low_cells": sessions_low_cells,
    "events_scan": events_scan,
    "sessions_describe": sessions_describe,
    "sessions_hist": sessions_hist,
    "sessions_text_range": sessions_text_range,
    "sessions_head": sessions_head,
    "sessions_duplicates": sessions_duplicates,
    "sessions_repeats": sessions_repeats,
    "sessions_dedupe": sessions_dedupe,
    "fixed_vs_tariff": fixed_vs_tariff,
    "heatmap_cells": heatmap_cells,
    "heatmap_new_prices": heatmap_new_prices,
    "licence_check": licence_check,
    "profile_nulls": profile_nulls,
    "profile_columns": profile_columns,
    "profile_duplicates": profile_duplicates,
    "duplicate_rows": duplicate_rows,
    "dedupe": dedupe,
    "distinct_campaigns": distinct_campaigns,
}
