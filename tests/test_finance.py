import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tessera.plans import finance


def _daily(spark, rows):
    cols = ["day date", "segment string", "country string", "city string", "n_journeys long"]
    cols += [f"{m}_{c} decimal(18,2)" for m in finance.METRICS for c in finance.CURRENCIES]
    data = []
    for day, seg, country, city, n, val, nullable in rows:
        vals = []
        for m in finance.METRICS:
            for _ in finance.CURRENCIES:
                vals.append(None if (nullable and m in ("chauffeur_fines", "passenger_bonuses",
                                                          "chauffeur_total_bonuses")) else Decimal(val))
        data.append((day, seg, country, city, n, *vals))
    return spark.createDataFrame(data, ", ".join(cols))


def test_partner_split_null_partner_and_left_join(spark):
    journeys = spark.createDataFrame(
        [(1, "A", "UK", "London"), (2, "A", "UK", "London"), (3, "B", "UK", None)],
        "journey_id long, segment string, country string, city string")
    costs = spark.createDataFrame(
        [(1, dt.datetime(2020, 1, 6), "PARTNER1", Decimal("1.00")),
         (1, dt.datetime(2020, 1, 7), None, Decimal("2.00")),        # NULL partner: total only
         (2, dt.datetime(2020, 1, 8), "ACME", Decimal("4.00")),      # other
         (3, dt.datetime(2020, 1, 8), "PARTNER2", Decimal("8.00")),  # NULL city: never joins
         (2, dt.datetime(2020, 3, 2), "PARTNER3", Decimal("16.00"))],  # period only in partner data
        "journey_id long, completed_ts_loc timestamp_ntz, partner_name string, partner_cost_rub decimal(18,2)")
    for c in ("gbp", "eur", "usd"):
        costs = costs.withColumn(f"partner_cost_{c}", F.col("partner_cost_rub"))
    daily = _daily(spark, [(dt.date(2020, 1, 6), "A", "UK", "London", 2, "10.00", True),
                           (dt.date(2020, 1, 7), "B", "UK", None, 1, "5.00", False)])
    rep = finance.finance_report(daily, costs, journeys, "week", "week").collect()
    by_key = {(r.segment, r.city): r for r in rep}
    a = by_key[("A", "London")]
    assert a.n_journeys == 2 and a.gross_bookings_rub == 10.0
    assert a.PARTNER1_privileges_revenue_rub == 1.0 and a.other_privileges_revenue_rub == 4.0
    assert a.privileges_revenue_total_rub == 7.0          # NULL partner counted in the total only
    assert a.chauffeur_fines_rub == 0.0 and a.passenger_bonuses_rub == 0.0   # NULL metrics → 0
    b = by_key[("B", None)]
    assert b.privileges_revenue_total_rub == 0.0          # NULL city never matches (no <=>)
    assert b.chauffeurs_fines_minus_bonuses_rub == 0.0
    assert len(rep) == 2                                  # the March partner-only period is lost


def test_monthly_granularity_names_the_period_column(spark):
    journeys = spark.createDataFrame([(1, "A", "UK", "L")], "journey_id long, segment string, country string, city string")
    costs = spark.createDataFrame([(1, dt.datetime(2020, 1, 6), "PARTNER1", Decimal("1.50"))],
                                  "journey_id long, completed_ts_loc timestamp_ntz, partner_name string, "
                                  "partner_cost_rub decimal(18,2)")
    for c in ("gbp", "eur", "usd"):
        costs = costs.withColumn(f"partner_cost_{c}", F.col("partner_cost_rub"))
    daily = _daily(spark, [(dt.date(2020, 1, 6), "A", "UK", "L", 1, "1.00", False),
                           (dt.date(2020, 1, 30), "A", "UK", "L", 3, "2.00", False)])
    rep = finance.finance_report(daily, costs, journeys, "month", "month_start")
    assert rep.columns[:5] == ["month_start", "segment", "country", "city", "n_journeys"]
    assert len(rep.columns) == 5 + 18 * 4
    r = rep.first()
    assert str(r.month_start) == "2020-01-01" and r.n_journeys == 4 and r.tips_usd == 3.0
    assert r.PARTNER1_privileges_revenue_eur == 1.5
