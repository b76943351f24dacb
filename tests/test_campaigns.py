import numpy as np
import pytest

from tessera.plans import campaigns as C


def _camp(spark, rows):
    return spark.createDataFrame(rows, "Week int, Campaign string, Visits long, Revenue double, Cost double")


def test_kpis_dedupe_romi_rpv(spark):
    df = _camp(spark, [(1, "A", 10, 30.0, 20.0), (1, "A", 10, 30.0, 20.0), (1, "B", 0, 5.0, 8.0)])
    k = {r.Campaign: r for r in C.campaign_kpis(df).collect()}
    assert len(k) == 2                                    # exact duplicate dropped
    assert (k["A"].Profit, k["A"].ROMI, k["A"].RPV) == (10.0, 0.5, 3.0)
    assert (k["B"].ROMI, k["B"].RPV) == (-0.375, None)    # 0 visits → NULL, not inf
    m = C.market_kpis(df).first()
    assert (m.Visits, m.Revenue, m.Cost, m.Profit, m.ROMI) == (10, 35.0, 28.0, 7.0, 0.25)


def test_growth_zero_and_negative_previous(spark):
    df = _camp(spark, [(1, "A", 10, 0.0, 10.0), (2, "A", 20, 5.0, 10.0), (3, "A", 30, 2.0, 10.0)])
    s = C.series_table(df)
    g = {(r.series, r.metric): r for r in C.growth_summary(s).collect()}
    # visits: +100 %, +50 % → mean 0.75
    assert g[("A", "Visits")].mean_wow_growth == 0.75
    # revenue from 0: no growth (NULL skipped), then 5 → 2 = −60 %
    assert g[("A", "Revenue")].mean_wow_growth == -0.6
    # profit −10 → −5 → −8: sign of the change kept with |prev| in the denominator
    assert g[("A", "Profit")].mean_wow_growth == pytest.approx((0.5 + -0.6) / 2)


def test_metric_development_first_last(spark):
    df = _camp(spark, [(w, "A", 10 * w, 2.0 * w, 1.0) for w in range(1, 31)])
    d = C.metric_development(C.series_table(df), "RPV").where("series = 'A'").first()
    assert (d.min, d.max, d.mean_abs, d.week1, d.week30, d.w1_to_w30_growth) == (0.2, 0.2, 0.2, 0.2, 0.2, 0.0)


def test_scenario_cumulative_and_ffill_agree(spark):
    df = _camp(spark, [(30, "T", 100, 50.0, 40.0), (30, "O", 7, 3.0, 2.0), (29, "T", 1, 1.0, 1.0)])
    a = sorted(tuple(r) for r in C.spend_scenario(df, "T").collect())
    b = sorted(tuple(r) for r in C.spend_scenario_ffill(df, "T").collect())
    assert a == b
    cost = {(r[0], r[2]): r[4] for r in a}
    assert cost[(30, "T")] == 40.0 and cost[(31, "T")] == 290.0 and cost[(45, "T")] == 40.0 + 250 * 15
    assert cost[(45, "O")] == 2.0
    assert len(a) == 16 * 2


def test_ols_matches_numpy(spark):
    rng = np.random.default_rng(7)
    cost = rng.integers(100, 1000, 30).astype(float)
    rev = np.round(0.8 * cost + rng.normal(0, 20, 30), 2)
    vis = np.round(0.1 * cost + rng.normal(0, 5, 30)).astype(int)
    df = _camp(spark, [(w + 1, "T", int(vis[w]), float(rev[w]), float(cost[w])) for w in range(30)])
    fit = {r.target: r for r in C.ols_fit(df, "T").collect()}
    for name, y in (("Revenue", rev), ("Visits", vis.astype(float))):
        slope, icpt = np.polyfit(cost[:25], y[:25], 1)
        mae = np.mean(np.abs(y[25:] - (icpt + slope * cost[25:])))
        assert fit[name].slope == pytest.approx(slope, rel=1e-9)
        assert fit[name].intercept == pytest.approx(icpt, rel=1e-9, abs=1e-9)
        assert fit[name].mae == pytest.approx(round(mae, 2), abs=0.011)


def test_forecast_has_last_week_twice(spark):
    rows = [(w, c, 10 * w, 3.0 * w, 2.0 * w) for w in range(1, 31) for c in ("T", "O")]
    f = C.market_forecast(_camp(spark, rows), "T")
    weeks = [r.Week for r in f.collect()]
    assert weeks.count(30) == 2 and max(weeks) == 45 and len(weeks) == 30 + 16
