import math

import pytest

from tessera.functions.stats import chi2_ppf, chi2_sf
from tessera.plans import sessions as S


def _sessions(spark, rows):
    return spark.createDataFrame(rows, "session long, session_start_text string, session_end_text string, "
                                       "clickouts int, booking int")


def test_enrich_midnight_zero_and_labels(spark):
    df = _sessions(spark, [(1, "23:59:30", "00:00:10", 1, 0), (2, "10:00:00", "10:00:00", 2, 1),
                           (3, "10:00:00", "10:01:30", 0, 0), (4, "10:00:00", "10:02:30", 1, 1)])
    out = {r.session: r for r in S.enrich(df).collect()}
    assert (out[1].session_duration_sec, out[1].session_start_hour, out[1].session_duration_range) == (40, 23, "0-1")
    assert (out[2].session_duration_sec, out[2].session_duration_min) == (0, 0)
    assert out[3].session_duration_min == 2      # 1.5 → 2 (half-even)
    assert out[4].session_duration_min == 2      # 2.5 → 2 (half-even)
    assert out[4].session_duration_range == "2-3"


def test_anomalies_and_clean(spark):
    df = _sessions(spark, [(1, "10:00:00", "10:00:01", 0, 1), (2, "10:00:00", "10:00:01", 0, 0),
                           (3, "10:00:00", "10:00:01", None, 1), (4, "10:00:00", "10:00:01", 3, 1)])
    a = S.anomalies(df).first()
    assert (a.n_sessions, a.n_anomalies, a.pct_anomalies) == (4, 1, 25.0)
    assert sorted(r.session for r in S.clean(df).collect()) == [2, 3, 4]   # NULL clickouts kept


def test_distribution_one_class_group(spark):
    df = _sessions(spark, [(1, "10:00:00", "10:00:01", 1, 0), (2, "10:00:00", "10:00:01", 1, 1),
                           (3, "10:00:00", "10:00:01", 1, 0), (4, "10:00:00", "10:00:01", 5, 0)])
    out = {r.clickouts: r for r in S.conversion_distribution(df, "clickouts").collect()}
    assert (out[1].n_not_booked, out[1].n_booked, out[1].total_sessions, out[1].pct_booked) == (2, 1, 3, 0.3333)
    # value seen with one class only: total computed before the fill → 0, share 0
    assert (out[5].n_not_booked, out[5].n_booked, out[5].total_sessions, out[5].pct_booked) == (1, 0, 0, 0.0)


def _chi2_reference(table, correction=True):
    """Textbook Pearson chi-squared with the 2×2 continuity correction."""
    rows, cols = len(table), len(table[0])
    n = sum(map(sum, table))
    r = [sum(x) for x in table]
    c = [sum(table[i][j] for i in range(rows)) for j in range(cols)]
    dof = (rows - 1) * (cols - 1)
    stat = 0.0
    for i in range(rows):
        for j in range(cols):
            e = r[i] * c[j] / n
            o = table[i][j]
            if dof == 1 and correction:
                d = e - o
                o = o + min(0.5, abs(d)) * (1 if d > 0 else -1 if d < 0 else 0)
            stat += (o - e) ** 2 / e
    return stat, dof


def _frame_from_table(spark, table):
    data = []
    for i, row in enumerate(table):
        for j, n in enumerate(row):
            data += [(i, j)] * n
    return spark.createDataFrame(data, "booking int, v int")


@pytest.mark.parametrize("table", [
    [[10, 20], [30, 5]],            # 2×2 → Yates
    [[3, 0], [4, 9]],               # 2×2 with a zero cell
    [[5, 6, 7], [8, 0, 12]],        # 2×3 with a zero cell, no correction
    [[10, 10], [10, 10]],           # independent: D = 0
])
def test_chi2_statistic_matches_textbook(spark, table):
    stat, dof = _chi2_reference(table)
    got = S.chi2_statistic(_frame_from_table(spark, table), "booking", "v").first()
    assert got.dof == dof
    assert got.stat == pytest.approx(stat, abs=1e-9)


def test_chi2_test_decisions(spark):
    t = S.chi2_test(_frame_from_table(spark, [[10, 20], [30, 5]]), "booking", "v").first()
    assert t.critical == pytest.approx(3.841459, abs=1e-6)
    assert t.p == round(chi2_sf(t.stat, 1), 6)       # reported to 6 dp
    assert t.decision_by_stat == t.decision_by_p == S.DEPENDENT


def test_chi2_distribution_functions():
    for k, crit in ((1, 3.841459), (2, 5.991465), (6, 12.591587), (7, 14.067140), (23, 35.172462)):
        assert chi2_ppf(0.95, k) == pytest.approx(crit, abs=1e-5)
        assert chi2_sf(crit, k) == pytest.approx(0.05, abs=1e-6)
    assert chi2_sf(2.0, 2) == pytest.approx(math.exp(-1.0))
    assert chi2_sf(0.0, 3) == 1.0
    assert chi2_sf(1e9, 1e9) == pytest.approx(0.5, abs=2e-5) and chi2_sf(1e9, 1e9) < 0.5
    z = 1.959963984540054   # two formulas meet where one takes over
    x = 1e5 * (1 - 2 / 9e5 + z * math.sqrt(2 / 9e5)) ** 3
    assert chi2_sf(x, 1e5) == pytest.approx(0.025, abs=1e-6) and chi2_sf(x, 1e5) == pytest.approx(chi2_sf(x, 1e5 + 1e-6), abs=1e-6)
