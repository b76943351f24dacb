"""C2 — period finance report (13 metrics × 4 currencies + partner revenue split).

Both sides are aggregated to (period, segment, country, city) before the
4-key LEFT JOIN.  On the partner side the cost lines join their journey first
and the map side of the aggregate after it does the shrinking: nearly every
line is its own (journey, period, partner), so summing before the join would
only add a wide aggregate.  All money is summed as DECIMAL; the output is the
nearest DOUBLE of each exact sum, nothing is rounded to cents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import trunc_date

# Metric names, currencies and partner names of the report.
METRICS = ("gross_bookings", "parking", "toll_roads", "tips", "net_bookings",
           "gross_revenue", "chauffeur_fines", "net_revenue_b2c", "net_revenue_b2b",
           "net_revenue_total", "passenger_bonuses", "vat", "chauffeur_total_bonuses")
CURRENCIES = ("rub", "gbp", "eur", "usd")
PARTNERS = ("PARTNER1", "PARTNER2", "PARTNER3")
KEYS = ("segment", "country", "city")


def _money_sql(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


# Wide projections and aggregates are written as SQL expression strings and
# passed in one ``selectExpr``/``agg`` call: the plan is the same as with
# Column objects, but the Python side makes a handful of JVM calls instead of
# one per operator (the 77-column report would otherwise cost seconds to build).

def metrics_by_period(daily: DataFrame, granularity: str, period_col: str) -> DataFrame:
    """The daily metrics summed per period and place."""
    cols = ["n_journeys"] + [f"{m}_{c}" for m in METRICS for c in CURRENCIES]
    g = daily.select(trunc_date(granularity, "day").alias(period_col), *KEYS, *cols)
    return g.groupBy(period_col, *KEYS).agg(*[F.expr(f"sum(`{c}`) AS `{c}`") for c in cols])


def partner_revenue(partner_costs: DataFrame, journeys: DataFrame, granularity: str,
                    period_col: str) -> DataFrame:
    """Costs per named partner, "other" and total, per period and place.

    Lines meet their journey, then four sums per (period, place, partner) and,
    on that table of a few rows per place and period, the 20 buckets.  ``NOT
    IN`` keeps SQL's three-valued logic: a NULL partner is in the total but in
    no named bucket and not in "other".
    """
    period = trunc_date(granularity, F.col("completed_ts_loc").cast("timestamp_ntz")).alias(period_col)
    costs = [f"partner_cost_{cur}" for cur in CURRENCIES]
    joined = (partner_costs.select("journey_id", period, "partner_name", *costs)
              .join(journeys.select("journey_id", *KEYS), "journey_id"))
    per_partner = (joined.groupBy(period_col, *KEYS, "partner_name")
                   .agg(*[F.expr(f"sum(partner_cost_{cur}) AS cost_{cur}") for cur in CURRENCIES]))
    names = ", ".join(f"'{p}'" for p in PARTNERS)
    out = []
    for cur in CURRENCIES:
        for p in PARTNERS:
            out.append(f"sum(CASE WHEN partner_name = '{p}' THEN cost_{cur} END) AS {p}_privileges_revenue_{cur}")
        out.append(f"sum(CASE WHEN partner_name NOT IN ({names}) THEN cost_{cur} END) AS other_privileges_revenue_{cur}")
        out.append(f"sum(cost_{cur}) AS privileges_revenue_total_{cur}")
    return per_partner.groupBy(period_col, *KEYS).agg(*[F.expr(e) for e in out])


def report_columns(period_col: str) -> list[str]:
    """The report's SELECT list over ``m`` (metrics) LEFT JOIN ``pd`` (partners)."""
    cols = [f"m.`{period_col}` AS `{period_col}`"] + [f"m.{k} AS {k}" for k in KEYS]
    cols.append("m.n_journeys AS n_journeys")
    for cur in CURRENCIES:
        cols += [f"{_money_sql(f'm.{x}_{cur}')} AS {x}_{cur}" for x in
                 ("gross_bookings", "parking", "toll_roads", "tips", "net_bookings", "gross_revenue")]
        cols.append(f"{_money_sql(f'coalesce(m.chauffeur_total_bonuses_{cur}, 0)')} AS chauffeur_total_bonuses_{cur}")
        cols.append(f"{_money_sql(f'coalesce(m.passenger_bonuses_{cur}, 0)')} AS passenger_bonuses_{cur}")
        for p in PARTNERS + ("other",):
            cols.append(f"{_money_sql(f'coalesce(pd.{p}_privileges_revenue_{cur}, 0)')} AS {p}_privileges_revenue_{cur}")
        cols.append(f"{_money_sql(f'coalesce(pd.privileges_revenue_total_{cur}, 0)')} AS privileges_revenue_total_{cur}")
        cols += [f"{_money_sql(f'm.{x}_{cur}')} AS {x}_{cur}" for x in
                 ("net_revenue_b2c", "net_revenue_b2b", "net_revenue_total")]
        cols.append(f"{_money_sql(f'coalesce(m.chauffeur_fines_{cur}, 0)')} AS chauffeur_fines_{cur}")
        # narrowed before subtracting: decimal(38,x) − decimal(38,x) would lose a decimal in Spark
        diff = (f"CAST(coalesce(m.chauffeur_fines_{cur}, 0) AS DECIMAL(30,8)) "
                f"- CAST(coalesce(m.chauffeur_total_bonuses_{cur}, 0) AS DECIMAL(30,8))")
        cols.append(f"{_money_sql(diff)} AS chauffeurs_fines_minus_bonuses_{cur}")
    return cols


def finance_report(daily: DataFrame, partner_costs: DataFrame, journeys: DataFrame,
                   granularity: str = "week", period_col: str = "period") -> DataFrame:
    """The period report for any granularity and period-column name, as one plan."""
    m = metrics_by_period(daily, granularity, period_col).alias("m")
    pd = partner_revenue(partner_costs, journeys, granularity, period_col).alias("pd")
    cond = [F.col(f"m.{k}") == F.col(f"pd.{k}") for k in (period_col, *KEYS)]
    return m.join(pd, cond, "left").selectExpr(*report_columns(period_col))


def partner_split(partner_costs: DataFrame, journeys: DataFrame, granularity: str = "month",
                  period_col: str = "period") -> DataFrame:
    """The partner split on its own."""
    pd = partner_revenue(partner_costs, journeys, granularity, period_col)
    return pd.selectExpr(period_col, *KEYS, *[f"{_money_sql(c)} AS {c}" for c in pd.columns
                                              if c not in (period_col, *KEYS)])
