"""DuckDB twins of every registered query (the correctness oracle).

Each twin restates the fixture mapping of ``tessera.sources.fixtures`` and the
job's meaning in plain SQL by another way than the job's: sets of month numbers,
long tables pivoted at the end, expected counts over the full grid, integer
geometry, rounding by whole numbers.  The driver runs them on the same Parquet
tables and compares results.
"""

from __future__ import annotations

from tessera.sources import fixtures as fx

AS_OF = fx.AS_OF
RUN_TS = fx.RUN_TS

# --- fixture CTEs -----------------------------------------------------------

GEO_CUSTOMERS = """geo_customers AS (
  SELECT c.c_custkey, c.c_mktsegment, n.n_name, r.r_name
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey)"""

JOURNEYS = """journeys AS (
  SELECT o.o_custkey AS passenger_id,
         o.o_orderkey AS journey_id,
         min(o.o_orderdate) OVER (PARTITION BY o.o_custkey) AS passenger_first_completed_ts_loc,
         CAST(o.o_orderdate AS DATE) AS completed_dt_loc,
         g.c_mktsegment AS segment, g.r_name AS country, g.n_name AS city
  FROM orders o JOIN geo_customers g ON o.o_custkey = g.c_custkey)"""

USERS = """users AS (
  SELECT CASE WHEN c_custkey % 50 = 0 THEN -c_custkey ELSE c_custkey END AS user_id,
         r_name AS country_code, n_name AS city, c_mktsegment AS last_attribution_channel
  FROM geo_customers)"""


def with_ctes(*parts: str) -> str:
    *ctes, body = parts
    return "WITH " + ",\n".join(ctes) + "\n" + body


# --- C1 churn -------------------------------------------------------------------

# Months are whole numbers (12 · year + month); ``ride`` is the set of active
# months, and each state is a question about the sets of earlier and later ones.
LIFE = f"""ride AS (
  SELECT DISTINCT passenger_id AS p, 12 * year(completed_dt_loc) + month(completed_dt_loc) AS m,
         12 * year(passenger_first_completed_ts_loc) + month(passenger_first_completed_ts_loc) AS m0
  FROM journeys WHERE 12 * year(completed_dt_loc) + month(completed_dt_loc) < 12 * year(DATE '{AS_OF}') + month(DATE '{AS_OF}')),
act AS (SELECT DISTINCT p, m FROM ride),
last_before AS (SELECT a.p, a.m, max(b.m) AS m1 FROM act a JOIN act b ON a.p = b.p AND b.m < a.m GROUP BY a.p, a.m),
gone AS (SELECT p, m + 1 AS m FROM act EXCEPT SELECT p, m FROM act),
states AS (
  SELECT DISTINCT r.p, r.m, r.m = r.m0 AS n, coalesce(l.m1 = r.m - 1, false) AS k, coalesce(l.m1 < r.m - 1, false) AS b, false AS c
  FROM ride r LEFT JOIN last_before l USING (p, m)
  UNION ALL SELECT p, m, false, false, false, true FROM gone)"""

MONTH_DATE = "make_date(((m - 1) // 12)::INT, ((m - 1) % 12 + 1)::INT, 1)"

CHURN_MONTHLY = with_ctes(GEO_CUSTOMERS, JOURNEYS, USERS, LIFE, f"""
SELECT country_code AS country, city, last_attribution_channel AS attribution_channel, {MONTH_DATE} AS month,
       count(*) FILTER (WHERE n) AS new, count(*) FILTER (WHERE k) AS retained,
       count(*) FILTER (WHERE b) AS reactivated, count(*) FILTER (WHERE c) AS churned
FROM (SELECT p, m, bool_or(n) AS n, bool_or(k) AS k, bool_or(b) AS b, bool_or(c) AS c FROM states GROUP BY p, m)
JOIN users ON user_id = p
WHERE m < 12 * year(DATE '{AS_OF}') + month(DATE '{AS_OF}')
GROUP BY ALL""")

CHURN_USER_STATES = with_ctes(GEO_CUSTOMERS, JOURNEYS, LIFE, f"""
SELECT p AS passenger_id, {MONTH_DATE} AS month, n AS is_new, k AS is_retained, b AS is_reactivated, c AS is_churned FROM states""")


# --- C2 finance -----------------------------------------------------------------

def _dec(c):
    return f"CAST({c} AS DECIMAL(12,2))"


FIN_CURRENCIES = tuple(c for c, _ in fx.CURRENCY_RATES)


def _exact_double(x):
    """Nearest double of an exact decimal (through its text)."""
    return f"CAST(CAST({x} AS VARCHAR) AS DOUBLE)"


def _values(rows):
    return "(VALUES " + ", ".join(rows) + ")"


# Metrics in long form: every order's four base amounts times (metric, base,
# weight) and (currency, rate), summed once per period and place.
def _metrics_long(gran):
    metrics = _values(f"('{m}', '{b}', {w}::DECIMAL(4,2), {str(m in fx.NULLABLE_METRICS).lower()})" for m, b, w in fx.FINANCE_METRICS)
    rates = _values(f"('{c}', {r}::DECIMAL(4,1))" for c, r in fx.CURRENCY_RATES)
    price, less, tax = _dec("l_extendedprice"), _dec("l_discount"), _dec("l_tax")
    return f"""place AS (
  SELECT o_orderkey AS k, date_trunc('{gran}', o_orderdate)::DATE AS period, c_mktsegment AS segment, r_name AS country, n_name AS city
  FROM orders JOIN geo_customers ON o_custkey = c_custkey),
base AS (
  SELECT period, segment, country, city, count(DISTINCT k) AS orders, sum({price}) AS gross, sum({price} - {price} * {less}) AS net,
         sum({price} * {less}) AS disc, sum({price} * {tax}) AS tax
  FROM lineitem JOIN place ON l_orderkey = k GROUP BY ALL),
amounts AS (UNPIVOT (SELECT period, segment, country, city, gross::DECIMAL(24,4) AS gross, net::DECIMAL(24,4) AS net,
                            disc::DECIMAL(24,4) AS disc, tax::DECIMAL(24,4) AS tax FROM base) ON gross, net, disc, tax INTO NAME b VALUE v),
metric AS (
  SELECT period, segment, country, city, m, c, v * w * r AS x
  FROM amounts JOIN {metrics} t(m, bb, w, nullable) ON bb = b CROSS JOIN {rates} q(c, r)
  WHERE NOT (nullable AND segment = '{fx.NULL_METRIC_SEGMENT}'))"""


def _partners_long(gran):
    rates = _values(f"('{c}', {r}::DECIMAL(4,1))" for c, r in fx.CURRENCY_RATES)
    return f"""shares AS (
  SELECT date_trunc('{gran}', l_shipdate)::DATE AS period, c_mktsegment AS segment, r_name AS country, n_name AS city,
         l_suppkey % 10 AS b, sum({_dec('l_extendedprice')} * {_dec('l_discount')}) AS v
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN geo_customers ON o_custkey = c_custkey GROUP BY ALL),
partner AS (
  SELECT period, segment, country, city, c, CASE WHEN b = 0 THEN 'none' WHEN b <= 3 THEN 'PARTNER' || b ELSE 'other' END AS who, v::DECIMAL(24,4) * r AS x
  FROM shares CROSS JOIN {rates} q(c, r))"""


_PLACE = "period, segment, country, city"


def _partner_columns(default):
    out = []
    for c in FIN_CURRENCIES:
        for who in ("PARTNER1", "PARTNER2", "PARTNER3", "other"):
            out.append((f"{who}_privileges_revenue_{c}", f"sum(x) FILTER (WHERE who = '{who}' AND c = '{c}')"))
        out.append((f"privileges_revenue_total_{c}", f"sum(x) FILTER (WHERE c = '{c}')"))
    return [(name, f"coalesce({x}, 0)" if default else x) for name, x in out]


def finance_sql(gran: str, period: str) -> str:
    always = ("gross_bookings", "parking", "toll_roads", "tips", "net_bookings", "gross_revenue", "net_revenue_b2c", "net_revenue_b2b", "net_revenue_total")
    wide, out = [], []
    for c in FIN_CURRENCIES:
        of = lambda m: f"sum(x) FILTER (WHERE m = '{m}' AND c = '{c}')"  # noqa: B023, E731
        wide += [f"{of(m)} AS {m}_{c}" for m in always]
        wide += [f"coalesce({of(m)}, 0) AS {m}_{c}" for m in ("chauffeur_fines", "chauffeur_total_bonuses", "passenger_bonuses")]
        out += [f"{_exact_double(f'{m}_{c}')} AS {m}_{c}" for m in (*always, "chauffeur_fines", "chauffeur_total_bonuses", "passenger_bonuses")]
        out.append(f"{_exact_double(f'chauffeur_fines_{c} - chauffeur_total_bonuses_{c}')} AS chauffeurs_fines_minus_bonuses_{c}")
    split = _partner_columns(False)
    out += [f"{_exact_double(f'coalesce({n}, 0)')} AS {n}" for n, _ in split]
    return with_ctes(GEO_CUSTOMERS, _metrics_long(gran), _partners_long(gran),
                     f"wide AS (SELECT {_PLACE}, {', '.join(wide)} FROM metric GROUP BY ALL)",
                     f"split AS (SELECT {_PLACE}, {', '.join(f'{x} AS {n}' for n, x in split)} FROM partner GROUP BY ALL)",
                     f"SELECT period AS {period}, segment, country, city, orders AS n_journeys, {', '.join(out)} "
                     f"FROM base JOIN wide USING ({_PLACE}) LEFT JOIN split USING ({_PLACE})")


def partner_split_sql(gran: str, period: str) -> str:
    cols = ", ".join(f"{_exact_double(x)} AS {n}" for n, x in _partner_columns(False))
    return with_ctes(GEO_CUSTOMERS, _partners_long(gran), f"SELECT period AS {period}, segment, country, city, {cols} FROM partner GROUP BY ALL")


# --- C3-C5 reconciliation --------------------------------------------------------

def _oid(ts_sql):
    return f"lower(lpad(hex(epoch(CAST({ts_sql} AS TIMESTAMP))::BIGINT), 8, '0') || '0000000000000000')"


RECON_SOURCE = f"""recon_source AS (
  SELECT lower(lpad(hex(epoch(o_orderdate)::BIGINT), 8, '0') || lpad(hex(o_orderkey), 16, '0')) AS _id,
         o_orderdate AS created_at,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST('0.05' AS DECIMAL(3,2)) AS DOUBLE) AS credit
  FROM orders)"""

RECON_TARGET = """recon_target AS (
  SELECT o_orderdate AS requested_ts_utc,
         CAST(CASE WHEN o_orderkey % 97 = 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) + 1
                   ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS DOUBLE) AS price_loc,
         CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST('0.05' AS DECIMAL(3,2)) AS DOUBLE) AS discount_loc
  FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem))"""


RECON_USERS = """users_source AS (
  SELECT lower(lpad(hex(epoch(t)::BIGINT), 8, '0') || lpad(hex(c_custkey), 16, '0')) AS _id, t AS created_at,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DOUBLE) AS rating
  FROM (SELECT *, TIMESTAMP '1995-01-01' + to_days((c_custkey % 1500)::INT) AS t FROM customer)),
users_target AS (
  SELECT TIMESTAMP '1995-01-01' + to_days((c_custkey % 1500 + CASE WHEN c_custkey % 89 = 0 THEN 1 ELSE 0 END)::INT) AS registered_ts_utc,
         CAST(CAST(c_acctbal AS DECIMAL(18,2)) + CASE WHEN c_custkey % 97 = 0 THEN 1 ELSE 0 END AS DOUBLE) AS rating
  FROM customer)"""


def _windows_cte(windows):
    vals = ", ".join(f"(DATE '{a}', DATE '{b}')" for a, b in windows)
    return f"windows AS (SELECT * FROM (VALUES {vals}) w(window_from, window_to))"


def _recon_head(spec):
    return (f"TIMESTAMP '{RUN_TS}' AS run_ts_utc, '{spec['source_collection']}' AS source_collection, "
            f"'{spec['target_table']}' AS target_table")


# (spec, source CTE, target CTE, target time column)
RECON_JOBS = ((fx.RECON_SPEC, "recon_source", "recon_target"), (fx.RECON_USERS_SPEC, "users_source", "users_target"))


def recon_sql(one, windows, keep_window, jobs=1):
    parts = [one(windows, keep_window, *job) for job in RECON_JOBS[:jobs]]
    return "\nUNION ALL\n".join(f"(SELECT * FROM ({p}) q)" for p in parts)


def recon_counts_sql(windows, keep_window: bool, spec, source, target) -> str:
    ts = spec['target_ts_column']
    src = f"""src AS (
  SELECT w.window_from, w.window_to, CAST(s.created_at AS DATE) AS day, count(s._id) AS source_cnt
  FROM {source} s JOIN windows w ON s._id >= {_oid('w.window_from')} AND s._id < {_oid('w.window_to')}
  WHERE s.created_at IS NOT NULL GROUP BY 1, 2, 3)"""
    tgt = f"""tgt AS (
  SELECT w.window_from, w.window_to, CAST(t.{ts} AS DATE) AS day, count(*) AS target_cnt
  FROM {target} t JOIN windows w ON t.{ts} >= w.window_from AND t.{ts} < w.window_to
  GROUP BY 1, 2, 3)"""
    win = "s.window_from, s.window_to, " if keep_window else ""
    body = f"""
SELECT {_recon_head(spec)}, {win}s.day, s.source_cnt, COALESCE(t.target_cnt, 0) AS target_cnt,
       round_even(CAST(s.source_cnt - COALESCE(t.target_cnt, 0) AS DOUBLE), 2) AS diff_abs,
       round_even(100.0 * round_even(CAST(s.source_cnt - COALESCE(t.target_cnt, 0) AS DOUBLE), 2)
                  / nullif(CAST(s.source_cnt AS DOUBLE), 0), 2) AS diff_pct
FROM src s LEFT JOIN tgt t ON s.window_from = t.window_from AND s.window_to = t.window_to AND s.day = t.day"""
    return with_ctes(RECON_SOURCE, RECON_TARGET, RECON_USERS, _windows_cte(windows), src, tgt, body)


def recon_sums_sql(windows, keep_window: bool, spec, source, target) -> str:
    cmap, ts = spec["columns_map"], spec["target_ts_column"]
    d = "DECIMAL(38,10)"
    src_cols = ", ".join(f"COALESCE(sum(CAST(s.{f} AS {d})), CAST(0 AS {d})) AS {f}" for f in cmap)
    tgt_cols = ", ".join(f"sum(CAST(t.{c} AS {d})) AS {c}" for c in cmap.values())
    src_wide = f"""src_wide AS (
  SELECT w.window_from, w.window_to, CAST(s.created_at AS DATE) AS day, {src_cols}
  FROM {source} s JOIN windows w ON s._id >= {_oid('w.window_from')} AND s._id < {_oid('w.window_to')}
  WHERE s.created_at IS NOT NULL GROUP BY 1, 2, 3)"""
    tgt_wide = f"""tgt_wide AS (
  SELECT w.window_from, w.window_to, CAST(t.{ts} AS DATE) AS day, {tgt_cols}
  FROM {target} t JOIN windows w ON t.{ts} >= w.window_from AND t.{ts} < w.window_to
  GROUP BY 1, 2, 3)"""
    mapping = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in cmap.items())
    src = "src AS (" + " UNION ALL ".join(
        f"SELECT window_from, window_to, day, '{f}' AS source_field, round_even({f}, 2) AS source_sum, "
        f"CASE '{f}' {mapping} END AS target_column FROM src_wide" for f in cmap) + ")"
    tgt = "tgt AS (" + " UNION ALL ".join(
        f"SELECT window_from, window_to, day, '{c}' AS target_column, round_even({c}, 2) AS target_sum FROM tgt_wide"
        for c in dict.fromkeys(cmap.values())) + ")"
    win = "s.window_from, s.window_to, " if keep_window else ""
    diff = "round_even(s.source_sum - COALESCE(t.target_sum, 0), 2)"
    body = f"""
SELECT {_recon_head(spec)}, {win}s.day, s.source_field, s.target_column,
       CAST(s.source_sum AS DOUBLE) AS source_sum, CAST(COALESCE(t.target_sum, 0) AS DOUBLE) AS target_sum,
       CAST({diff} AS DOUBLE) AS diff_abs,
       round_even(100.0 * CAST({diff} AS DOUBLE) / nullif(CAST(s.source_sum AS DOUBLE), 0), 2) AS diff_pct
FROM src s LEFT JOIN tgt t ON s.window_from = t.window_from AND s.window_to = t.window_to
  AND s.day = t.day AND s.target_column = t.target_column"""
    return with_ctes(RECON_SOURCE, RECON_TARGET, RECON_USERS, _windows_cte(windows), src_wide, tgt_wide, src, tgt, body)


# --- C14-C16 sessions, A12/A14/P16-P18 profiling ---------------------------------

SESSIONS = """sessions AS (
  SELECT event_id AS session,
         strftime(ts, '%H:%M:%S') AS session_start_text,
         strftime(ts + to_seconds(4 * CAST(json_extract_string(props, '$.k') AS INTEGER)), '%H:%M:%S') AS session_end_text,
         CAST(event_id % 8 AS INTEGER) AS clickouts,
         CAST(event_type = 'purchase' AS INTEGER) AS booking
  FROM events)"""


def _hms(t):
    return (f"(CAST(split_part({t}, ':', 1) AS INTEGER) * 3600 + CAST(split_part({t}, ':', 2) AS INTEGER) * 60 "
            f"+ CAST(split_part({t}, ':', 3) AS INTEGER))")


ENRICHED = f"""enriched AS (
  SELECT session, session_start_text, session_end_text, clickouts, booking,
         dur AS session_duration_sec,
         CAST({_hms('session_start_text')} // 3600 AS INTEGER) AS session_start_hour,
         CAST(round_even(dur / 60.0, 0) AS INTEGER) AS session_duration_min,
         CAST(dur // 60 AS VARCHAR) || '-' || CAST(dur // 60 + 1 AS VARCHAR) AS session_duration_range
  FROM (SELECT *, CASE WHEN {_hms('session_end_text')} - {_hms('session_start_text')} < 0
                       THEN {_hms('session_end_text')} - {_hms('session_start_text')} + 86400
                       ELSE {_hms('session_end_text')} - {_hms('session_start_text')} END AS dur
        FROM sessions) x)"""

CLEAN = """clean AS (
  SELECT * FROM enriched WHERE NOT COALESCE(clickouts = 0 AND booking = 1, FALSE))"""


def rounded_ratio_sql(num, den, digits):
    """num/den to ``digits`` decimals, ties to even: half a unit is added before the whole division, an exact tie on an odd result steps back."""
    n, d = f"CAST(abs({num}) AS HUGEINT) * {10 ** digits}", f"CAST(abs({den}) AS HUGEINT)"
    up = f"((2 * {n} + {d}) // (2 * {d}))"
    tie = f"((2 * {n} + {d}) % (2 * {d}) = 0 AND {up} % 2 = 1)"
    size = f"CAST(CAST({up} - CASE WHEN {tie} THEN 1 ELSE 0 END AS VARCHAR) || 'e-{digits}' AS DOUBLE)"
    return (f"(CASE WHEN coalesce({den}, 0) = 0 OR {num} IS NULL THEN NULL "
            f"WHEN (({num}) < 0) <> (({den}) < 0) THEN -{size} ELSE {size} END)")


def distribution_sql(var):
    body = f"""
SELECT {var}, COALESCE(n0, 0) AS n_not_booked, COALESCE(n1, 0) AS n_booked,
       COALESCE(n0 + n1, 0) AS total_sessions,
       COALESCE({rounded_ratio_sql('n1', '(n0 + n1)', 4)}, 0.0) AS pct_booked
FROM (SELECT {var}, sum(CASE WHEN booking = 0 THEN 1 END) AS n0, sum(CASE WHEN booking = 1 THEN 1 END) AS n1
      FROM clean WHERE {var} IS NOT NULL AND booking IS NOT NULL GROUP BY {var}) x"""
    return with_ctes(SESSIONS, ENRICHED, CLEAN, body)


def _chi2_block(name, src, label):
    """Pearson's sum over the full grid of expected counts, with the continuity correction in a two by two table."""
    return f"""{name}_seen AS (SELECT booking AS rv, {label} AS cv FROM {src} WHERE booking IS NOT NULL AND {label} IS NOT NULL),
{name}_grid AS (
  SELECT (SELECT count(*) FROM {name}_seen s WHERE s.rv = r.rv AND s.cv = c.cv) AS o, r.n * c.n / (SELECT count(*)::DOUBLE FROM {name}_seen) AS e
  FROM (SELECT rv, count(*)::DOUBLE AS n FROM {name}_seen GROUP BY rv) r CROSS JOIN (SELECT cv, count(*)::DOUBLE AS n FROM {name}_seen GROUP BY cv) c),
{name} AS (
  SELECT '{label}' AS variable, (SELECT count(*) FROM {name}_seen) AS n,
         (SELECT (count(DISTINCT rv) - 1) * (count(DISTINCT cv) - 1) FROM {name}_seen) AS dof,
         CASE WHEN (SELECT (count(DISTINCT rv) - 1) * (count(DISTINCT cv) - 1) FROM {name}_seen) = 1
              THEN sum(pow(greatest(abs(o - e) - 0.5, 0), 2) / e) ELSE sum(pow(o - e, 2) / e) END AS stat
  FROM {name}_grid)"""


CHI2_STATS = with_ctes(
    SESSIONS, ENRICHED, CLEAN,
    "clean_nz AS (SELECT * FROM clean WHERE clickouts <> 0)",
    _chi2_block("t1", "clean", "session_start_hour"),
    _chi2_block("t2", "clean", "session_duration_min"),
    _chi2_block("t3", "clean_nz", "clickouts"),
    "SELECT variable, n, dof, round_even(stat, 6) AS stat FROM (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3) t")

def _grid_sql(name, label):
    return f"SELECT '{label}' AS variable, r.rv, CAST(c.cv AS VARCHAR) AS key, (SELECT count(*) FROM {name}_seen s WHERE s.rv = r.rv AND s.cv = c.cv) AS observed, " \
           f"(r.n * c.n) / (SELECT count(*)::DOUBLE FROM {name}_seen) AS expected FROM (SELECT rv, count(*)::DOUBLE AS n FROM {name}_seen GROUP BY rv) r " \
           f"CROSS JOIN (SELECT cv, count(*)::DOUBLE AS n FROM {name}_seen GROUP BY cv) c"


CHI2_GRID = with_ctes(
    SESSIONS, ENRICHED, CLEAN, "clean_nz AS (SELECT * FROM clean WHERE clickouts <> 0)",
    _chi2_block("t1", "clean", "session_start_hour"), _chi2_block("t2", "clean", "session_duration_min"), _chi2_block("t3", "clean_nz", "clickouts"),
    "grid AS (" + " UNION ALL ".join(_grid_sql(*t) for t in (("t1", "session_start_hour"), ("t2", "session_duration_min"), ("t3", "clickouts"))) + ")", "{}")

EVENTS_SCAN = """SELECT event_id, sum(CAST(value AS DECIMAL(18,2))) OVER so_far AS value_total, CAST(value AS DECIMAL(18,2)) AS value,
  last_value(CASE WHEN event_type = 'purchase' THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END IGNORE NULLS) OVER so_far AS k
FROM events WINDOW so_far AS (ORDER BY event_id ROWS UNBOUNDED PRECEDING)"""


def _chi2_cdf_sql(x, k):
    """Regularised lower incomplete gamma P(k/2, x/2) by its power series."""
    y = f"(({x}) / 2.0)"
    a = f"(({k}) / 2.0)"
    terms = f"CAST({y} + 50 * sqrt({y}) + 200 AS BIGINT)"
    return (f"list_sum(list_transform(range(0, {terms}), "
            f"lambda n: exp(-{y} + ({a} + n) * ln({y}) - lgamma({a} + n + 1))))")


CHI2_TEST = ("WITH RECURSIVE " + with_ctes(
    SESSIONS, ENRICHED, CLEAN,
    "clean_nz AS (SELECT * FROM clean WHERE clickouts <> 0)",
    _chi2_block("t1", "clean", "session_start_hour"),
    _chi2_block("t2", "clean", "session_duration_min"),
    _chi2_block("t3", "clean_nz", "clickouts"),
    "stats AS (SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT * FROM t3)",
    f"""bis(variable, dof, it, lo, hi) AS (
  SELECT variable, dof, 0, CAST(0.0 AS DOUBLE), CAST(dof + 20 * sqrt(2 * dof) + 20 AS DOUBLE) FROM stats WHERE dof > 0
  UNION ALL
  SELECT variable, dof, it + 1,
         CASE WHEN {_chi2_cdf_sql('(lo + hi) / 2', 'dof')} < 0.95 THEN (lo + hi) / 2 ELSE lo END,
         CASE WHEN {_chi2_cdf_sql('(lo + hi) / 2', 'dof')} < 0.95 THEN hi ELSE (lo + hi) / 2 END
  FROM bis WHERE it < 90)""",
    f"""fin AS (
  SELECT s.variable, s.n, s.dof, s.stat, b.crit,
         CASE WHEN s.stat <= 0 THEN 1.0 ELSE greatest(0.0, 1 - {_chi2_cdf_sql('s.stat', 's.dof')}) END AS p
  FROM stats s LEFT JOIN (SELECT variable, (lo + hi) / 2 AS crit FROM bis WHERE it = 90) b ON s.variable = b.variable)""",
    """
SELECT variable, n, dof, 0.95 AS probability, round_even(crit, 6) AS critical, round_even(stat, 6) AS stat, 0.05 AS significance,
       round_even(p, 6) AS p,
       CASE WHEN abs(stat) >= crit THEN 'Dependent (reject H0)' ELSE 'Independent (fail to reject H0)' END AS decision_by_stat,
       CASE WHEN p <= 0.05 THEN 'Dependent (reject H0)' ELSE 'Independent (fail to reject H0)' END AS decision_by_p
FROM fin""")[len("WITH "):])

DESCRIBE_COLS = ("clickouts", "booking", "session_duration_sec", "session_start_hour", "session_duration_min")


def describe_sql(src_cte_chain, src, cols):
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS "column", count(x) AS count, round_even(avg(x), 6) AS mean,
       round_even(stddev_samp(x), 6) AS std, min(x) AS min, round_even(quantile_cont(x, 0.25), 6) AS p25,
       round_even(quantile_cont(x, 0.5), 6) AS p50, round_even(quantile_cont(x, 0.75), 6) AS p75, max(x) AS max
FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {src}) t""")
    return with_ctes(*src_cte_chain, "\nUNION ALL\n".join(parts))


def histogram_sql(src_cte_chain, src, col, bins=10):
    return with_ctes(*src_cte_chain, f"""ends AS (
  SELECT CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo, CASE WHEN lo = hi THEN hi + 0.5 ELSE hi END AS hi
  FROM (SELECT min({col})::DOUBLE AS lo, max({col})::DOUBLE AS hi FROM {src}))""",
                     f"edges AS (SELECT i::INT AS bin, lo + i * ((hi - lo) / {bins}.0) AS a, lo + (i + 1) * ((hi - lo) / {bins}.0) AS b FROM ends, range({bins}) r(i))",
                     f"SELECT bin, a AS bin_lower, b AS bin_upper, (SELECT count(*) FROM {src} WHERE {col} >= a AND ({col} < b OR bin = {bins - 1})) AS count FROM edges")


# --- C8-C13, C20 campaigns ---------------------------------------------------------

CAMPAIGNS = """campaigns_raw AS (
  SELECT CAST(day(ts) AS INTEGER) AS Week, event_type AS Campaign, count(*) AS Visits,
         CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS Revenue,
         CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS DOUBLE) AS Cost
  FROM events GROUP BY 1, 2),
campaigns AS (
  SELECT * FROM campaigns_raw
  UNION ALL SELECT * FROM campaigns_raw WHERE Week = 30 AND Campaign = 'error'),
dedup AS (SELECT DISTINCT * FROM campaigns)"""

D8 = "DECIMAL(38,8)"


def _units(x):
    return f"CAST(CAST({x} AS {D8}) * 100000000 AS HUGEINT)"


CAMPAIGN_KPIS = f"""campaign_kpis AS (
  SELECT Week, Campaign, Visits, Revenue, Cost,
         CAST(CAST(Revenue AS {D8}) - CAST(Cost AS {D8}) AS DOUBLE) AS Profit,
         {rounded_ratio_sql(f"({_units('Revenue')} - {_units('Cost')})", _units('Cost'), 4)} AS ROMI,
         Revenue / nullif(CAST(Visits AS DOUBLE), 0) AS RPV
  FROM dedup)"""

MARKET_KPIS = f"""market_wk AS (
  SELECT Week, sum(Visits) AS Visits, sum(CAST(Revenue AS {D8})) AS rev, sum(CAST(Cost AS {D8})) AS cost
  FROM dedup GROUP BY Week),
market_kpis AS (
  SELECT Week, CAST(Visits AS BIGINT) AS Visits, CAST(rev AS DOUBLE) AS Revenue, CAST(cost AS DOUBLE) AS Cost,
         CAST(rev - cost AS DOUBLE) AS Profit,
         {rounded_ratio_sql(f"({_units('rev')} - {_units('cost')})", _units('cost'), 4)} AS ROMI,
         CAST(rev AS DOUBLE) / nullif(CAST(Visits AS DOUBLE), 0) AS RPV
  FROM market_wk)"""

SERIES = """series_t AS (
  SELECT Week, Campaign AS series, Visits, Revenue, Cost, Profit, ROMI, RPV FROM campaign_kpis
  UNION ALL SELECT Week, 'Overall', Visits, Revenue, Cost, Profit, ROMI, RPV FROM market_kpis)"""

ALL_METRICS = ("Visits", "Revenue", "Cost", "Profit", "ROMI", "RPV")


def _long_sql(name, src, metrics):
    return f"{name} AS (" + " UNION ALL ".join(
        f"SELECT series, Week, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {src}" for m in metrics) + ")"


def _growth(x, prev):
    return f"(abs({x} / nullif({prev}, 0) - 1) * sign({x} - {prev}))"


GROWTH_SUMMARY = with_ctes(CAMPAIGNS, CAMPAIGN_KPIS, MARKET_KPIS, SERIES, _long_sql("lng", "series_t", ALL_METRICS), f"""
SELECT series, metric,
       round_even(avg(value), 10) AS mean_abs,
       round_even(avg(g), 10) AS mean_wow_growth
FROM (SELECT series, metric, value,
             {_growth('value', 'lag(value) OVER (PARTITION BY series, metric ORDER BY Week)')} AS g
      FROM lng) x
GROUP BY series, metric""")


def metric_dev_sql(metric):
    return f"""
SELECT series, '{metric}' AS metric, round_even(mn, 2) AS min, round_even(mx, 2) AS max,
       round_even(mean_abs, 2) AS mean_abs, round_even(w_first, 2) AS week1, round_even(w_last, 2) AS week30,
       round_even({_growth('w_last', 'w_first')}, 10) AS w1_to_w30_growth,
       round_even(mean_g, 10) AS mean_wow_growth
FROM (SELECT series, min(x) AS mn, max(x) AS mx, avg(x) AS mean_abs,
             max(CASE WHEN Week = 1 THEN x END) AS w_first, max(CASE WHEN Week = 30 THEN x END) AS w_last,
             avg(g) AS mean_g
      FROM (SELECT series, Week, CAST({metric} AS DOUBLE) AS x,
                   {_growth(f'CAST({metric} AS DOUBLE)', f'lag(CAST({metric} AS DOUBLE)) OVER (PARTITION BY series ORDER BY Week)')} AS g
            FROM series_t) a
      GROUP BY series) b"""


METRIC_DEV = with_ctes(CAMPAIGNS, CAMPAIGN_KPIS, MARKET_KPIS, SERIES,
                       metric_dev_sql("RPV") + "\nUNION ALL" + metric_dev_sql("ROMI"))

TARGET = fx.CAMPAIGN_TARGET

SCENARIO = f"""last_w AS (SELECT * FROM dedup WHERE Week = 30),
scenario AS (
  SELECT Week, Visits, Campaign, Revenue, Cost FROM last_w
  UNION ALL
  SELECT CAST(w.range AS INTEGER) AS Week, l.Visits, l.Campaign, l.Revenue,
         CASE WHEN l.Campaign = '{TARGET}' THEN l.Cost + 250.0 * (w.range - 30) ELSE l.Cost END AS Cost
  FROM last_w l CROSS JOIN range(31, 46) w)"""


def _ols_cte(y):
    return f"ols_{y} AS (SELECT regr_slope({y}, Cost) AS slope, regr_intercept({y}, Cost) AS intercept FROM ranked WHERE is_train)"


RANKED = f"""ranked AS (
  SELECT *, row_number() OVER (ORDER BY Week) <= 25 AS is_train FROM dedup WHERE Campaign = '{TARGET}')"""


def _mae_sql(y):
    err = f"abs(CAST(r.{y} AS DOUBLE) - (o.intercept + o.slope * CAST(r.Cost AS DOUBLE)))"
    return f"""SELECT '{y}' AS target, round_even(o.slope, 10) AS slope, round_even(o.intercept, 10) AS intercept,
       round_even(avg({err}), 2) AS mae
FROM ranked r CROSS JOIN ols_{y} o WHERE NOT r.is_train GROUP BY o.slope, o.intercept"""


OLS = with_ctes(CAMPAIGNS, RANKED, _ols_cte("Revenue"), _ols_cte("Visits"),
                _mae_sql("Revenue") + "\nUNION ALL\n" + _mae_sql("Visits"))

FORECAST_CTE = f"""future AS (
  SELECT s.Week,
         sum(CASE WHEN s.Campaign = '{TARGET}' THEN CAST(trunc(ov.intercept + ov.slope * CAST(s.Cost AS DOUBLE)) AS BIGINT)
                  ELSE s.Visits END) AS Visits,
         sum(CAST(CASE WHEN s.Campaign = '{TARGET}' THEN orv.intercept + orv.slope * CAST(s.Cost AS DOUBLE)
                       ELSE s.Revenue END AS {D8})) AS rev,
         sum(CAST(s.Cost AS {D8})) AS cost
  FROM scenario s CROSS JOIN ols_Revenue orv CROSS JOIN ols_Visits ov GROUP BY s.Week),
forecast AS (
  SELECT Week, Visits, Revenue, Cost, Profit, FALSE AS is_forecast FROM market_kpis
  UNION ALL
  SELECT Week, CAST(Visits AS BIGINT), CAST(rev AS DOUBLE), CAST(cost AS DOUBLE), CAST(rev - cost AS DOUBLE), TRUE
  FROM future)"""

FORECAST = with_ctes(CAMPAIGNS, MARKET_KPIS, RANKED, _ols_cte("Revenue"), _ols_cte("Visits"), SCENARIO,
                     FORECAST_CTE, "SELECT * FROM forecast")

FORECAST_GROWTH = with_ctes(CAMPAIGNS, MARKET_KPIS, RANKED, _ols_cte("Revenue"), _ols_cte("Visits"), SCENARIO, FORECAST_CTE,
                            "fw AS (SELECT 'Overall' AS series, * EXCLUDE (is_forecast) FROM forecast WHERE Week > 30)",
                            _long_sql("lng", "fw", ALL_METRICS[:4]), f"""
SELECT series, metric, round_even(avg(value), 10) AS mean_abs, round_even(avg(g), 10) AS mean_wow_growth
FROM (SELECT *, {_growth('value', 'lag(value) OVER (PARTITION BY metric ORDER BY Week)')} AS g FROM lng) x GROUP BY series, metric""")

CHART = with_ctes(CAMPAIGNS, CAMPAIGN_KPIS, MARKET_KPIS, SERIES, RANKED, _ols_cte("Revenue"), _ols_cte("Visits"),
                  SCENARIO, FORECAST_CTE, _long_sql("kpi_long", "series_t", ("ROMI", "RPV")), """
SELECT 'market_development' AS chart, 'Overall' AS series, Week, metric, value, is_forecast FROM (
  SELECT Week, is_forecast, 'Visits' AS metric, CAST(Visits AS DOUBLE) AS value FROM forecast
  UNION ALL SELECT Week, is_forecast, 'Revenue', Revenue FROM forecast
  UNION ALL SELECT Week, is_forecast, 'Cost', Cost FROM forecast
  UNION ALL SELECT Week, is_forecast, 'Profit', Profit FROM forecast) f
UNION ALL
SELECT lower(metric) AS chart, series, Week, metric, value, FALSE AS is_forecast FROM kpi_long""")


# --- C6/C7 zones (whole-number geometry in millionths: trips × edges, winding number per zone) ---------

def _coord_sql(mult, mod):
    return f"CAST(((o_orderkey % {mod}) * {mult % mod}) % {mod} AS DOUBLE) / CAST(1000 AS DOUBLE)"


def _micro(x):
    return f"round({x} * 1000000)::HUGEINT"


TRIPS = f"""trips AS (
  SELECT o_orderkey AS journey_id, o_custkey AS chauffeur_id, o_orderdate AS pickup_ts_loc,
         CAST(o_orderdate AS DATE) AS pickup_dt_loc, 'city ' || (o_custkey % 3) AS city, o_orderstatus AS status,
         o_orderdate + to_minutes(CAST(o_orderkey % 120 AS INTEGER)) AS dropoff_ts_loc,
         CAST(o_orderdate + to_minutes(CAST(o_orderkey % 120 AS INTEGER)) AS DATE) AS dropoff_dt_loc,
         {_micro(_coord_sql(104729, 997))} AS py, {_micro(_coord_sql(15485863, 983))} AS qy, {_micro(_coord_sql(1299709, 991))} AS qx,
         CASE WHEN o_orderkey % 500 <> 0 THEN {_micro(_coord_sql(7919, 1000))} END AS px
  FROM orders)"""

TRIP_KEYS = "journey_id, chauffeur_id, pickup_ts_loc, pickup_dt_loc, dropoff_ts_loc, dropoff_dt_loc"


def ring_edges(rings) -> str:
    rows = []
    for zi, ring in enumerate(rings):
        corners = [(round(x * 1_000_000), round(y * 1_000_000)) for x, y in ring]
        rows += [f"({zi}, {a}, {b}, {c}, {d})" for (a, b), (c, d) in zip(corners, [*corners[1:], corners[0]])]
    return f"SELECT z, x1::HUGEINT AS x1, y1::HUGEINT AS y1, x2::HUGEINT AS x2, y2::HUGEINT AS y2 FROM (VALUES {', '.join(rows)}) e(z, x1, y1, x2, y2)"


def star_edges() -> str:
    dirs = ", ".join(f"({k}, {a}, {b})" for k, (a, b) in enumerate(fx.STAR))
    trunc = lambda d: f"sign({d})::BIGINT * ((r * abs({d})) // 1000)"  # towards zero
    return f"""SELECT a.z, a.x::HUGEINT AS x1, a.y::HUGEINT AS y1, b.x::HUGEINT AS x2, b.y::HUGEINT AS y2 FROM corners a JOIN corners b ON a.z = b.z AND b.k = (a.k + 1) % {len(fx.STAR)}""", f"""corners AS (
  SELECT z, k, (z * 104729) % 999983 + {trunc('dx')} AS x, (z * 15485863) % 999979 + {trunc('dy')} AS y
  FROM (SELECT z, k, dx, dy, [{', '.join(map(str, fx.STAR_RADII))}][(z + k) % 3 + 1]::BIGINT AS r
        FROM (SELECT c_custkey * {fx.STARS_PER_CUSTOMER} + s AS z FROM customer, range({fx.STARS_PER_CUSTOMER}) q(s)), (VALUES {dirs}) d(k, dx, dy)))"""


def zones_sql(edges: str, filtered: bool, select: str, *before: str) -> str:
    since, city, status = fx.TRIP_FILTER
    where = f"AND dropoff_ts_loc >= TIMESTAMP '{since}' AND city = '{city}' AND status = '{status}'" if filtered else ""

    def place(x, y):  # winding number of the zone around the point; 0 where the point is on its boundary
        turn = f"((x2 - x1) * ({y} - y1) - (y2 - y1) * ({x} - x1))"
        wind = f"sum(CASE WHEN y1 <= {y} AND y2 > {y} AND {turn} > 0 THEN 1 WHEN y1 > {y} AND y2 <= {y} AND {turn} < 0 THEN -1 ELSE 0 END)"
        on = f"bool_or({turn} = 0 AND {x} BETWEEN least(x1, x2) AND greatest(x1, x2) AND {y} BETWEEN least(y1, y2) AND greatest(y1, y2))"
        return f"(CASE WHEN {on} THEN 0 ELSE {wind} END <> 0)"

    den = "((qx - px) * (y2 - y1) - (qy - py) * (x2 - x1))"
    t = "((x1 - px) * (y2 - y1) - (y1 - py) * (x2 - x1))"
    u = "((x1 - px) * (qy - py) - (y1 - py) * (qx - px))"
    meets = f"""CASE WHEN {den} <> 0 THEN {t} * sign({den}) BETWEEN 0 AND abs({den}) AND {u} * sign({den}) BETWEEN 0 AND abs({den})
       ELSE {t} = 0 AND {u} = 0 AND greatest(px, qx) >= least(x1, x2) AND least(px, qx) <= greatest(x1, x2)
            AND greatest(py, qy) >= least(y1, y2) AND least(py, qy) <= greatest(y1, y2) END"""
    return with_ctes(
        TRIPS, *before, f"edges AS ({edges})", "boxes AS (SELECT z, min(x1) AS x0, max(x1) AS x9, min(y1) AS y0, max(y1) AS y9 FROM edges GROUP BY z)",
        f"asked AS (SELECT {TRIP_KEYS}, px, py, qx, qy FROM trips WHERE px IS NOT NULL {where})",
        f"""per_zone AS (
  SELECT {TRIP_KEYS}, edges.z, {place('px', 'py')} AS a, {place('qx', 'qy')} AS b, bool_or({meets}) AS c
  FROM asked JOIN boxes ON greatest(px, qx) >= x0 AND least(px, qx) <= x9 AND greatest(py, qy) >= y0 AND least(py, qy) <= y9
  JOIN edges ON edges.z = boxes.z GROUP BY {TRIP_KEYS}, px, py, qx, qy, edges.z)""",
        f"""any_zone AS (SELECT {TRIP_KEYS}, coalesce(bool_or(a), FALSE) AS a, coalesce(bool_or(b), FALSE) AS b, coalesce(bool_or(c), FALSE) AS c
  FROM asked LEFT JOIN per_zone USING ({TRIP_KEYS}) GROUP BY {TRIP_KEYS})""",
        f"""flags AS (SELECT {TRIP_KEYS}, a::INT AS is_pickup_ccz, b::INT AS is_dropoff_ccz, (c AND NOT a AND NOT b)::INT AS is_pass_through_ccz,
  (a OR b OR c)::INT AS is_ccz FROM any_zone)""", select)


# --- C17/C18 heatmap ---------------------------------------------------------------

HEAT_TRIPS = """heat_trips AS (
  SELECT r.r_name AS airport, p.p_brand AS hexagon_id,
         CASE WHEN l.l_returnflag = 'R' THEN 'to' ELSE 'from' END AS direction,
         l.l_extendedprice AS fixed_price, p.p_retailprice * l.l_quantity AS tariff_price
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _d4(x):
    return f"CAST({x} AS DECIMAL(10,4))"


def _pt(x, y):
    return f"'[' || CAST({_d4(x)} AS VARCHAR) || ', ' || CAST({_d4(y)} AS VARCHAR) || ']'"


CELL_N = "CAST(CAST(regexp_extract(hexagon_id, '(\\d+)$', 1) AS INTEGER) AS DECIMAL(10,4))"
LAT = f"CAST(CAST('55.5' AS DECIMAL(10,4)) + {CELL_N} * CAST('0.01' AS DECIMAL(10,4)) AS DECIMAL(10,4))"
LON = f"CAST(CAST('37.3' AS DECIMAL(10,4)) + {CELL_N} * CAST('0.01' AS DECIMAL(10,4)) AS DECIMAL(10,4))"
H = "CAST('0.005' AS DECIMAL(10,4))"
GEO = ("'{\"type\": \"Polygon\", \"coordinates\": [[' || "
       + " || ', ' || ".join([_pt(f"{LON} - {H}", f"{LAT} - {H}"), _pt(f"{LON} + {H}", f"{LAT} - {H}"),
                              _pt(f"{LON} + {H}", f"{LAT} + {H}"), _pt(f"{LON} - {H}", f"{LAT} + {H}"),
                              _pt(f"{LON} - {H}", f"{LAT} - {H}")])
       + " || ']]}'")


def _cents2(x):
    return f"CAST(CAST({x} AS DECIMAL(30,2)) * 100 AS HUGEINT)"


CELLS = f"""cells0 AS (
  SELECT airport, hexagon_id, direction, sum(CAST(fixed_price AS DECIMAL(18,2))) AS f, sum(CAST(tariff_price AS DECIMAL(18,2))) AS t, count(*) AS n
  FROM heat_trips GROUP BY ALL),
fixed AS (
  SELECT airport, hexagon_id, sum(n)::BIGINT AS n_trips,
         max({rounded_ratio_sql(f"(({_cents2('f')} - {_cents2('t')}) * 100)", _cents2('t'), 2)}) FILTER (WHERE direction = 'from') AS fixed_vs_tariff_from_price_pct,
         max({rounded_ratio_sql(f"(({_cents2('f')} - {_cents2('t')}) * 100)", _cents2('t'), 2)}) FILTER (WHERE direction = 'to') AS fixed_vs_tariff_to_price_pct,
         {rounded_ratio_sql(_cents2('sum(t)'), '(sum(n) * 100)', 2)} AS price_tariff_rub_weighted
  FROM cells0 GROUP BY 1, 2),
cells AS (
  SELECT *, {rounded_ratio_sql(f"({_cents2('price_tariff_rub_weighted')} * {fx.NEW_PRICE_PCT})", '10000', 2)} AS price_tariff_rub_discounted,
         CAST({LAT} AS DOUBLE) AS centre_lat, CAST({LON} AS DOUBLE) AS centre_lon, {GEO} AS geojson_polygon,
         'okrug ' || regexp_extract(hexagon_id, '([0-9])[0-9]*$', 1) AS okrug_name
  FROM fixed)"""


def _colour_sql(v, vmin, vmax):
    """Whole-number form of the scale for a value in hundredths: a channel is floor(255.9999 · share)."""
    k, lo, half, hi = f"round({v} * 100)::HUGEINT", round(vmin * 100), round((vmax - vmin) * 50), round(vmax * 100)
    mid = lo + half

    def byte(num, den):
        return f"(2559999::HUGEINT * ({num}) // (({den})::HUGEINT * 10000))"

    def colour(r, g):
        return f"('#' || lpad(lower(hex(({r})::INT)), 2, '0') || lpad(lower(hex(({g})::INT)), 2, '0') || '00')"
    rising = colour("255", byte(f"{k} - {lo}", half))
    falling = colour(byte(f"{mid + half} - {k}", half), byte(f"255 * {half} - 127 * ({k} - {mid})", 255 * half))
    return (f"(CASE WHEN {v} IS NULL THEN NULL WHEN {k} <= {lo} THEN '#ff0000' WHEN {k} >= {hi} THEN '#008000' "
            f"WHEN {k} <= {mid} THEN {rising} ELSE {falling} END)")


AIRPORT_MARKERS = """markers AS (
  SELECT airport, lat_lon[1] AS airport_lat, lat_lon[2] AS airport_lon FROM (
    SELECT r.r_name AS airport,
           arg_min([CAST(55.0 AS DOUBLE) + CAST(n.n_nationkey AS DOUBLE) / CAST(100.0 AS DOUBLE),
                    CAST(37.0 AS DOUBLE) + CAST(n.n_nationkey AS DOUBLE) / CAST(100.0 AS DOUBLE)], n.n_nationkey) AS lat_lon
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey GROUP BY r.r_name) a)"""

HEATMAP = with_ctes(HEAT_TRIPS, CELLS, AIRPORT_MARKERS, f"""
SELECT h.airport, h.direction, h.hexagon_id, h.value,
       h.hexagon_id || ': ' || CAST(h.value AS VARCHAR) || '%' AS label,
       CAST(h.value AS VARCHAR) || '%' AS marker_text,
       {_colour_sql('h.value', -60.0, 60.0)} AS colour,
       h.centre_lat, h.centre_lon, h.geojson_polygon, m.airport_lat, m.airport_lon
FROM (SELECT airport, 'from' AS direction, hexagon_id, fixed_vs_tariff_from_price_pct AS value,
             centre_lat, centre_lon, geojson_polygon FROM cells
      UNION ALL
      SELECT airport, 'to', hexagon_id, fixed_vs_tariff_to_price_pct, centre_lat, centre_lon, geojson_polygon
      FROM cells) h
LEFT JOIN markers m ON h.airport = m.airport""")

HEATMAP_NEW = with_ctes(HEAT_TRIPS, CELLS, AIRPORT_MARKERS, f"""
SELECT h.airport, 'from' AS direction, h.hexagon_id, h.price_tariff_rub_discounted AS value,
       CAST(h.price_tariff_rub_discounted AS VARCHAR) AS label,
       CAST(h.price_tariff_rub_discounted AS VARCHAR) AS marker_text,
       {_colour_sql('d.price', 1500.0, 4500.0)} AS colour,
       h.centre_lat, h.centre_lon, h.geojson_polygon, m.airport_lat, m.airport_lon
FROM cells h JOIN (SELECT DISTINCT ON (airport, okrug_name) airport, okrug_name, price_tariff_rub_weighted AS price
                   FROM cells ORDER BY airport, okrug_name, hexagon_id) d USING (airport, okrug_name)
LEFT JOIN markers m ON h.airport = m.airport""")


# --- C19 licences -----------------------------------------------------------------

LICENCES = """licence_lines AS (
  SELECT 'drivers' || CAST(s_suppkey % 3 + 1 AS VARCHAR) || '.txt' AS file_name, s_suppkey * 2 AS line_no,
         CASE WHEN s_suppkey % 3 = 0 THEN s_name || ' ' || chr(9) ELSE s_name END AS value
  FROM supplier
  UNION ALL
  SELECT 'drivers' || CAST(s_suppkey % 3 + 1 AS VARCHAR) || '.txt', s_suppkey * 2 + 1, '   '
  FROM supplier WHERE s_suppkey % 7 = 0),
reg AS (
  SELECT s.s_suppkey, CASE WHEN s.s_suppkey % 20 = 1 THEN s.s_name || '-old' ELSE s.s_name END AS licence_number, n.n_name AS holder_name,
         strftime(DATE '2024-01-01' + CAST(s.s_suppkey AS INTEGER), '%d/%m/%Y') AS expiry_date
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey),
registry AS (
  SELECT licence_number, holder_name, expiry_date FROM reg
  UNION ALL SELECT licence_number, holder_name || ' (2)', expiry_date FROM reg WHERE s_suppkey % 20 = 0)"""

LICENCE_CHECK = with_ctes(LICENCES, """
SELECT l.file_name, l.line_no, l.value AS licence_number,
       CASE WHEN r.n = 1 THEN r.holder END AS licence_holder_name,
       CASE WHEN r.n = 1 THEN r.expiry END AS licence_expiry_date,
       CASE WHEN r.n IS NULL THEN 'NOT FOUND' WHEN r.n = 1 THEN 'OK' ELSE 'TO CHECK' END AS status
FROM (SELECT file_name, line_no, regexp_replace(value, '\\s+$', '') AS value FROM licence_lines) l
LEFT JOIN (SELECT licence_number, count(*) AS n, min(holder_name) AS holder, min(expiry_date) AS expiry
           FROM registry GROUP BY licence_number) r ON l.value = r.licence_number
WHERE length(l.value) > 0
ORDER BY l.file_name, l.line_no""")


# --- P17/P18/P19/U4/A13 profiling ------------------------------------------------------

SESSION_COLS = (("session", "bigint"), ("session_start_text", "string"), ("session_end_text", "string"),
                ("clickouts", "int"), ("booking", "int"))
CAMPAIGN_COLS = ("Week", "Campaign", "Visits", "Revenue", "Cost")

PROFILE_NULLS = with_ctes(SESSIONS, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM sessions"
    for c, _ in SESSION_COLS))

PROFILE_COLUMNS = with_ctes(SESSIONS, "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(*) AS n_rows, count({c}) AS n_non_null, "
    f"count(DISTINCT {c}) AS n_distinct FROM sessions" for c, t in SESSION_COLS))

_ccols = ", ".join(CAMPAIGN_COLS)
PROFILE_DUPLICATES = with_ctes(CAMPAIGNS, f"""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_distinct_rows, CAST(COALESCE(sum(n - 1), 0) AS BIGINT) AS n_duplicate_rows
FROM (SELECT {_ccols}, count(*) AS n FROM campaigns GROUP BY ALL) g""")

DUPLICATE_ROWS = with_ctes(CAMPAIGNS, f"""
SELECT {_ccols} FROM (SELECT *, row_number() OVER (PARTITION BY {_ccols}) AS rn FROM campaigns) x WHERE rn > 1""")


ORACLE = {
    "fixed_vs_tariff": with_ctes(HEAT_TRIPS, CELLS, "SELECT * FROM fixed"),
    "heatmap_cells": HEATMAP,
    "heatmap_new_prices": HEATMAP_NEW,
    "licence_check": LICENCE_CHECK,
    "profile_nulls": PROFILE_NULLS,
    "profile_columns": PROFILE_COLUMNS,
    "profile_duplicates": PROFILE_DUPLICATES,
    "duplicate_rows": DUPLICATE_ROWS,
    "dedupe": with_ctes(CAMPAIGNS, "SELECT * FROM dedup"),
    "distinct_campaigns": with_ctes(CAMPAIGNS, "SELECT Campaign, count(*) AS n_rows FROM campaigns GROUP BY Campaign"),
    "zone_flags": zones_sql(ring_edges(fx.ZONES), True, "SELECT * FROM flags"),
    "zone_flags_round": zones_sql(ring_edges([fx.round_zone()]), True, "SELECT * FROM flags"),
    "zone_flags_table": zones_sql(star_edges()[0], True, "SELECT * FROM flags", star_edges()[1]),
    "zone_summary": zones_sql(ring_edges(fx.ZONES), False, """
SELECT count(*) AS n_trips, count(*) FILTER (WHERE is_pass_through_ccz = 1) AS n_pass_through,
       count(*) FILTER (WHERE is_pickup_ccz = 1) AS n_pickup, count(*) FILTER (WHERE is_dropoff_ccz = 1) AS n_dropoff,
       count(*) FILTER (WHERE is_ccz = 1) AS n_any
FROM flags"""),
    "market_tail": with_ctes(CAMPAIGNS, MARKET_KPIS, "SELECT * FROM market_kpis ORDER BY Week DESC LIMIT 5"),
    "market_describe": describe_sql((CAMPAIGNS, MARKET_KPIS), "market_kpis", ("Visits", "Revenue", "Cost", "Profit")),
    "forecast_growth": FORECAST_GROWTH,
    "chart_distributions": "\nUNION ALL\n".join(
        f"(SELECT '{v}' AS chart, CAST({v} AS VARCHAR) AS label, total_sessions, pct_booked FROM ({distribution_sql(v)}) q)"
        for v in ("session_duration_range", "clickouts")),
    "sessions_text_range": with_ctes(SESSIONS, """SELECT 'session_start_text' AS "column", min(session_start_text) AS min, max(session_start_text) AS max FROM sessions
UNION ALL SELECT 'session_end_text', min(session_end_text), max(session_end_text) FROM sessions"""),
    "sessions_head": with_ctes(SESSIONS, "SELECT * FROM sessions ORDER BY session LIMIT 5"),
    "sessions_duplicates": with_ctes(SESSIONS, """SELECT count(*) AS n_rows, count(DISTINCT (session, session_start_text, session_end_text, clickouts, booking)) AS n_distinct_rows,
  count(*) - count(DISTINCT (session, session_start_text, session_end_text, clickouts, booking)) AS n_duplicate_rows FROM sessions"""),
    "sessions_repeats": with_ctes(SESSIONS, """SELECT session_end_text, clickouts, booking FROM
  (SELECT *, row_number() OVER (PARTITION BY session_end_text, clickouts, booking ORDER BY session) AS i FROM sessions) WHERE i > 1"""),
    "sessions_dedupe": with_ctes(SESSIONS, "SELECT DISTINCT session_start_text, session_end_text, clickouts, booking FROM sessions"),
    "campaign_kpis": with_ctes(CAMPAIGNS, CAMPAIGN_KPIS, "SELECT * FROM campaign_kpis"),
    "market_kpis": with_ctes(CAMPAIGNS, MARKET_KPIS, "SELECT * FROM market_kpis"),
    "campaign_growth": GROWTH_SUMMARY,
    "campaign_metric_dev": METRIC_DEV,
    "campaign_scenario": with_ctes(CAMPAIGNS, SCENARIO, "SELECT * FROM scenario"),
    "forward_fill": with_ctes(CAMPAIGNS, SCENARIO, "SELECT * FROM scenario"),
    "campaign_ols": OLS,
    "market_forecast": FORECAST,
    "chart_series": CHART,
    "sessions_enriched": with_ctes(SESSIONS, ENRICHED, "SELECT * FROM enriched"),
    "sessions_anomalies": with_ctes(SESSIONS, """
SELECT count(*) AS n_sessions, count(*) FILTER (WHERE COALESCE(clickouts = 0 AND booking = 1, FALSE)) AS n_anomalies,
       100.0 * count(*) FILTER (WHERE COALESCE(clickouts = 0 AND booking = 1, FALSE)) / count(*) AS pct_anomalies
FROM sessions"""),
    "sessions_clean": with_ctes(SESSIONS, ENRICHED, CLEAN, "SELECT * FROM clean"),
    "sessions_by_duration": distribution_sql("session_duration_range"),
    "sessions_by_clickouts": distribution_sql("clickouts"),
    "sessions_chi2": CHI2_STATS,
    "sessions_expected": CHI2_GRID.format("SELECT * FROM grid"),
    "sessions_low_cells": CHI2_GRID.format("SELECT variable, count(*) AS n_cells, count(*) FILTER (WHERE expected < 5) AS n_low FROM grid GROUP BY variable"),
    "events_scan": EVENTS_SCAN,
    "sessions_chi2_test": CHI2_TEST,
    "sessions_describe": describe_sql((SESSIONS, ENRICHED, CLEAN), "clean", DESCRIBE_COLS),
    "sessions_hist": histogram_sql((SESSIONS,), "sessions", "booking"),
    "reconcile_counts": recon_sql(recon_counts_sql, [fx.RECON_SINGLE_WINDOW], False),
    "reconcile_sums": recon_sql(recon_sums_sql, [fx.RECON_SINGLE_WINDOW], False),
    "reconcile_batch_counts": recon_sql(recon_counts_sql, fx.RECON_WINDOWS, True, 2),
    "reconcile_batch_sums": recon_sql(recon_sums_sql, fx.RECON_WINDOWS, True, 2),
    "finance_weekly": finance_sql("week", "week"),
    "finance_monthly": finance_sql("month", "month"),
    "finance_partner_split": partner_split_sql("month", "period"),
    "churn_monthly": CHURN_MONTHLY,
    "churn_user_states": CHURN_USER_STATES,
}
