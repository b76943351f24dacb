"""Reference input tables derived from the driver tables (FIXTURES.md §2).

Each builder returns a lazy DataFrame with the schema the reference job reads,
computed by Spark from the driver's Parquet tables so that its size grows with
the scale factor.  The DuckDB twins of these builders live in
``tessera.checks.oracle_sql`` and must stay in step with this file.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import cents, div_half_even, object_id_hex
from tessera.sources.tables import Tables

# Fixed values of the fixture mapping (FIXTURES.md): evaluation date, run stamp,
# currency rates, the finance metric weights over three base amounts, the
# partner buckets and the reconciliation windows.
AS_OF = "2001-08-15"
RUN_TS = "2001-08-15 00:00:00"
CURRENCY_RATES = (("rub", "90"), ("gbp", "0.8"), ("eur", "0.9"), ("usd", "1"))
# metric -> (base amount, weight); base: gross = l_extendedprice,
# net = l_extendedprice * (1 - l_discount), disc = l_extendedprice * l_discount,
# tax = l_extendedprice * l_tax.
FINANCE_METRICS = (
    ("gross_bookings", "gross", "1.00"),
    ("parking", "gross", "0.01"),
    ("toll_roads", "gross", "0.02"),
    ("tips", "gross", "0.03"),
    ("net_bookings", "net", "1.00"),
    ("gross_revenue", "gross", "0.25"),
    ("chauffeur_fines", "tax", "0.10"),
    ("net_revenue_b2c", "net", "0.15"),
    ("net_revenue_b2b", "net", "0.05"),
    ("net_revenue_total", "net", "0.20"),
    ("passenger_bonuses", "disc", "0.50"),
    ("vat", "tax", "1.00"),
    ("chauffeur_total_bonuses", "disc", "0.30"),
)
# Bonuses and fines are NULL for this segment (exercises the COALESCE defaults).
NULL_METRIC_SEGMENT = "AUTOMOBILE"
NULLABLE_METRICS = ("chauffeur_fines", "passenger_bonuses", "chauffeur_total_bonuses")
PARTNERS = ("PARTNER1", "PARTNER2", "PARTNER3")
RECON_WINDOWS = (
    ("1995-01-01", "1996-01-01"), ("1996-01-01", "1997-01-01"),
    ("1997-01-01", "1998-01-01"), ("1998-01-01", "1999-01-01"),
    ("1999-01-01", "2000-01-01"), ("2000-01-01", "2001-01-01"),
    ("2001-01-01", "2002-01-01"), ("1997-01-01", "1997-12-31"),
)
# The first run of the iterator script on our dates: 1995-01-01 .. 1996-12-31 (exclusive).
RECON_SINGLE_WINDOW = ("1995-01-01", "1996-12-31")
# Comparison spec of the "orders" collection (settings file of the reference).
RECON_SPEC = dict(source_collection="orders", target_table="analytics.f_requests",
                  target_ts_column="requested_ts_utc",
                  columns_map={"price": "price_loc", "credit": "discount_loc"})
# The "users" collection of the same file.
RECON_USERS_SPEC = dict(source_collection="users", target_table="analytics.dim_users",
                        target_ts_column="registered_ts_utc", columns_map={"rating": "rating"})
# The trip filter: completed since, city, status.
TRIP_FILTER = ("1993-01-01", "city 1", "F")
CAMPAIGN_TARGET = "purchase"
DUPLICATE_CAMPAIGN_ROW = (30, "error")


def _geo_customers(t: Tables) -> DataFrame:
    """customer ⨝ nation ⨝ region: one row per customer with its segment and place."""
    return (t.customer
            .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "c_mktsegment", "n_name", "r_name"))


def journeys(t: Tables, first_ride: bool = True, task_rows: int | None = None) -> DataFrame:
    """``f_passengers_journeys``: one row per order, with the passenger's first ride if asked for.

    With ``task_rows`` the orders are dealt by passenger to tasks of about so many rows.
    """
    orders = t.orders
    if task_rows:
        orders = orders.repartition(max(1, -(-orders.count() // task_rows)), "o_custkey")
    dim = _geo_customers(t)
    if first_ride:
        first = (t.orders.groupBy("o_custkey")
                 .agg(F.min("o_orderdate").alias("passenger_first_completed_ts_loc")))
        dim = dim.join(first, F.col("c_custkey") == F.col("o_custkey")).drop("o_custkey")
    return (orders
            .join(dim, F.col("o_custkey") == F.col("c_custkey"))
            .select(F.col("o_custkey").alias("passenger_id"),
                    F.col("o_orderkey").alias("journey_id"),
                    *(["passenger_first_completed_ts_loc"] if first_ride else []),
                    F.to_date("o_orderdate").alias("completed_dt_loc"),
                    F.col("c_mktsegment").alias("segment"),
                    F.col("r_name").alias("country"),
                    F.col("n_name").alias("city")))


def users(t: Tables) -> DataFrame:
    """``dim_users``; every 50th customer has an id that no journey knows, so the inner join loses journeys."""
    k = F.col("c_custkey")
    return (_geo_customers(t)
            .select(F.when(k % 50 == 0, -k).otherwise(k).alias("user_id"),
                    F.col("r_name").alias("country_code"),
                    F.col("n_name").alias("city"),
                    F.col("c_mktsegment").alias("last_attribution_channel")))


def _amount(c: str) -> F.Column:
    return F.col(c).cast("decimal(12,2)")


def finance_daily(t: Tables, journeys_df: DataFrame | None = None) -> DataFrame:
    """``f_finance_metrics_daily``: 13 metrics × 4 currencies per day and city.

    Line items are summed per order first (the shuffle the join needs anyway),
    so the join sees one row per order.
    """
    per_order = (t.lineitem
                 .groupBy("l_orderkey")
                 .agg(F.sum(_amount("l_extendedprice")).alias("gross"),
                      F.sum(_amount("l_extendedprice") * (F.lit(1) - _amount("l_discount"))).alias("net"),
                      F.sum(_amount("l_extendedprice") * _amount("l_discount")).alias("disc"),
                      F.sum(_amount("l_extendedprice") * _amount("l_tax")).alias("tax")))
    j = (journeys_df if journeys_df is not None else journeys(t, first_ride=False)).select(
        "journey_id", "completed_dt_loc", "segment", "country", "city")
    joined = per_order.join(j, F.col("l_orderkey") == F.col("journey_id"))
    keys = [F.col("completed_dt_loc").alias("day"), "segment", "country", "city"]
    aggs = [F.count("journey_id").alias("n_journeys")]
    for base in ("gross", "net", "disc", "tax"):
        # narrowed so that base × weight × rate stays below 38 digits: Spark
        # would otherwise drop the 7th decimal of the product (precision loss)
        aggs.append(F.sum(base).cast("decimal(18,4)").alias(base))
    daily = joined.groupBy(*keys).agg(*aggs)
    cols = ["day", "segment", "country", "city", "n_journeys"]
    for metric, base, weight in FINANCE_METRICS:
        for cur, rate in CURRENCY_RATES:
            v = f"{base} * CAST('{weight}' AS DECIMAL(3,2)) * CAST('{rate}' AS DECIMAL(4,1))"
            if metric in NULLABLE_METRICS:
                v = f"CASE WHEN segment != '{NULL_METRIC_SEGMENT}' THEN {v} END"
            cols.append(f"CAST({v} AS DECIMAL(38,8)) AS {metric}_{cur}")
    return daily.selectExpr(*cols)   # one JVM call for the 52 metric columns


def partner_costs(t: Tables) -> DataFrame:
    """``f_partnerships_journeys_costs``: one row per line item, partner by supplier."""
    bucket = F.col("l_suppkey") % 10
    partner = (F.when(bucket == 0, F.lit(None).cast("string"))
               .when(bucket == 1, F.lit(PARTNERS[0]))
               .when(bucket == 2, F.lit(PARTNERS[1]))
               .when(bucket == 3, F.lit(PARTNERS[2]))
               .otherwise(F.lit("P_OTHER")))
    cost = _amount("l_extendedprice") * _amount("l_discount")
    cols = [F.col("l_orderkey").alias("journey_id"),
            F.col("l_shipdate").alias("completed_ts_loc"),
            partner.alias("partner_name")]
    for cur, rate in CURRENCY_RATES:
        cols.append((cost * F.lit(rate).cast("decimal(4,1)")).cast("decimal(38,8)")
                    .alias(f"partner_cost_{cur}"))
    return t.lineitem.select(*cols)


def recon_source(t: Tables) -> DataFrame:
    """Document-store snapshot of orders: 24-hex id, creation time and two amounts."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    return t.orders.select(
        object_id_hex("o_orderdate", "o_orderkey").alias("_id"),
        F.col("o_orderdate").alias("created_at"),
        price.cast("double").alias("price"),
        (price * F.lit("0.05").cast("decimal(3,2)")).cast("double").alias("credit"))


def recon_target(t: Tables) -> DataFrame:
    """Warehouse copy: only orders that have a line item; every 97th price is off by 1."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    has_line = t.lineitem.select(F.col("l_orderkey"))
    return (t.orders
            .join(has_line, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
            .select(F.col("o_orderdate").alias("requested_ts_utc"),
                    (F.when(F.col("o_orderkey") % 97 == 0, price + 1).otherwise(price))
                    .cast("double").alias("price_loc"),
                    (price * F.lit("0.05").cast("decimal(3,2)")).cast("double").alias("discount_loc")))


def recon_users_source(t: Tables) -> DataFrame:
    """Document-store snapshot of users: id time and registration day by key, rating from the balance."""
    k = F.col("c_custkey")
    registered = F.timestamp_add("DAY", (k % 1500).cast("int"), F.lit("1995-01-01").cast("timestamp_ntz"))
    return t.customer.select(object_id_hex(registered, "c_custkey").alias("_id"), registered.alias("created_at"),
                             F.col("c_acctbal").cast("decimal(18,2)").cast("double").alias("rating"))


def recon_users_target(t: Tables) -> DataFrame:
    """Warehouse copy of the users: every 89th registered a day later, every 97th rating off by 1."""
    k = F.col("c_custkey")
    day = (k % 1500 + F.when(k % 89 == 0, 1).otherwise(0)).cast("int")
    rating = F.col("c_acctbal").cast("decimal(18,2)")
    return t.customer.select(F.timestamp_add("DAY", day, F.lit("1995-01-01").cast("timestamp_ntz")).alias("registered_ts_utc"),
                             F.when(k % 97 == 0, rating + 1).otherwise(rating).cast("double").alias("rating"))


def _coord(key: str, mult: int, mod: int) -> F.Column:
    # (k * mult) % mod without overflow for any 64-bit key
    k = F.col(key)
    return (F.pmod(F.pmod(k, F.lit(mod)) * F.lit(mult % mod), F.lit(mod)) / F.lit(1000.0))


def trips(t: Tables) -> DataFrame:
    """Journeys with straight-line pickup/dropoff coordinates in the unit square, city, status and completion."""
    k = F.col("o_orderkey")
    pickup_lon = F.when(k % 500 == 0, F.lit(None).cast("double")).otherwise(_coord("o_orderkey", 7919, 1000))
    dropoff_ts = F.timestamp_add("MINUTE", (k % 120).cast("int"), F.col("o_orderdate"))
    return (t.orders.select(F.col("o_orderkey").alias("journey_id"),
                    F.col("o_custkey").alias("chauffeur_id"),
                    dropoff_ts.alias("completed_ts_loc"),
                    F.concat(F.lit("city "), F.col("o_custkey") % 3).alias("city"),
                    F.col("o_orderstatus").alias("status"),
                    F.col("o_orderdate").alias("pickup_ts_loc"),
                    F.to_date("o_orderdate").alias("pickup_dt_loc"),
                    dropoff_ts.alias("dropoff_ts_loc"),
                    F.to_date(dropoff_ts).alias("dropoff_dt_loc"),
                    _coord("o_orderkey", 104729, 997).alias("pickup_position_lat"),
                    pickup_lon.alias("pickup_position_lon"),
                    _coord("o_orderkey", 15485863, 983).alias("dropoff_position_lat"),
                    _coord("o_orderkey", 1299709, 991).alias("dropoff_position_lon")))


# The three zone polygons (exterior rings, lon/lat order).
ZONES = (
    ((0.1, 0.1), (0.3, 0.1), (0.3, 0.3), (0.1, 0.3)),
    ((0.5, 0.5), (0.9, 0.5), (0.9, 0.9), (0.7, 0.7), (0.5, 0.9)),
    ((0.6, 0.1), (0.8, 0.1), (0.7, 0.35)),
)


def round_zone(vertices: int = 1000) -> tuple:
    """A zone with many vertices: a circle's polygon, corners to 6 decimals."""
    return tuple((round(0.5 + 0.35 * math.cos(2 * math.pi * i / vertices), 6), round(0.45 + 0.35 * math.sin(2 * math.pi * i / vertices), 6)) for i in range(vertices))


# Corners of a star zone lie in these directions (thousandths), every third one further out.
STAR = ((1000, 0), (707, 707), (0, 1000), (-707, 707), (-1000, 0), (-707, -707), (0, -1000), (707, -707))
STARS_PER_CUSTOMER, STAR_RADII = 7, (2000, 3500, 5000)


def star_zones(t: Tables) -> DataFrame:
    """(zone, ring): seven small star-shaped zones per customer, corners in whole millionths of a degree."""
    zone = F.col("c_custkey") * STARS_PER_CUSTOMER + F.col("k")
    z = t.customer.select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(STARS_PER_CUSTOMER - 1))).alias("k")).select(zone.alias("zone"))
    cx, cy = F.pmod(F.col("zone") * 104729, F.lit(999983)), F.pmod(F.col("zone") * 15485863, F.lit(999979))

    def corner(k, d):
        r = F.element_at(F.array(*map(F.lit, STAR_RADII)), (F.pmod(F.col("zone") + k, F.lit(3)) + 1).cast("int"))
        return F.array(*[(c + (r * d[i] / 1000).cast("long")) / F.lit(1000000.0) for i, c in enumerate((cx, cy))])

    return z.select("zone", F.array(*[corner(k, d) for k, d in enumerate(STAR)]).alias("ring"))


def sessions(t: Tables) -> DataFrame:
    """``session_data.csv``: start/end as HH:MM:SS text, clickouts and booking flag."""
    k = F.get_json_object("props", "$.k").cast("int")
    return t.events.select(
        F.col("event_id").alias("session"),
        F.date_format("ts", "HH:mm:ss").alias("session_start_text"),
        F.date_format(F.timestamp_add("SECOND", k * 4, F.col("ts")), "HH:mm:ss").alias("session_end_text"),
        (F.col("event_id") % 8).cast("int").alias("clickouts"),
        (F.col("event_type") == "purchase").cast("int").alias("booking"))


def campaigns(t: Tables) -> DataFrame:
    """``marketing_campaigns.csv``: weekly visits, revenue and cost per campaign,
    plus one exact duplicate row (week 30 of ``error``)."""
    k = F.get_json_object("props", "$.k").cast("long")
    weekly = (t.events
              .groupBy(F.dayofmonth("ts").alias("Week"), F.col("event_type").alias("Campaign"))
              .agg(F.count(F.lit(1)).alias("Visits"),
                   F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("Revenue"),
                   F.sum(k).cast("double").alias("Cost")))
    week, camp = DUPLICATE_CAMPAIGN_ROW
    dup = weekly.where((F.col("Week") == week) & (F.col("Campaign") == camp))
    return weekly.unionByName(dup)


def heatmap_trips(t: Tables) -> DataFrame:
    """Airport transfers: fixed price vs city tariff per (airport, cell, direction)."""
    return (t.lineitem
            .join(t.part, F.col("l_partkey") == F.col("p_partkey"))
            .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
            .join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("r_name").alias("airport"),
                    F.col("p_brand").alias("hexagon_id"),
                    F.when(F.col("l_returnflag") == "R", F.lit("to")).otherwise(F.lit("from")).alias("direction"),
                    F.col("l_extendedprice").alias("fixed_price"),
                    (F.col("p_retailprice") * F.col("l_quantity")).alias("tariff_price")))


# Centre of cell 0, distance of cells and half a cell in degrees; percent of the average tariff proposed as new price.
CELL_ORIGIN, CELL_STEP, CELL_HALF, NEW_PRICE_PCT = ("55.5", "37.3"), "0.01", "0.005", 90


def heatmap_table(fixed: DataFrame) -> DataFrame:
    """The cell table a map reads: markups with centre, polygon (a square by the brand's number), district and proposed price."""
    d = lambda x: F.lit(x).cast("decimal(10,4)")
    n = F.regexp_extract("hexagon_id", r"(\d+)$", 1).cast("int").cast("decimal(10,4)")
    lat, lon = ((d(o) + n * d(CELL_STEP)).cast("decimal(10,4)") for o in CELL_ORIGIN)
    h = d(CELL_HALF)

    def pt(x, y):
        return F.concat(F.lit("["), x.cast("decimal(10,4)").cast("string"), F.lit(", "), y.cast("decimal(10,4)").cast("string"), F.lit("]"))
    ring = F.concat_ws(", ", pt(lon - h, lat - h), pt(lon + h, lat - h), pt(lon + h, lat + h), pt(lon - h, lat + h), pt(lon - h, lat - h))
    new_price = div_half_even(cents("price_tariff_rub_weighted") * NEW_PRICE_PCT, F.lit(10_000), 2)
    return fixed.select("*", new_price.alias("price_tariff_rub_discounted"), lat.cast("double").alias("centre_lat"), lon.cast("double").alias("centre_lon"),
                        F.concat(F.lit('{"type": "Polygon", "coordinates": [['), ring, F.lit("]]}")).alias("geojson_polygon"),
                        F.concat(F.lit("okrug "), F.regexp_extract("hexagon_id", r"(\d)\d*$", 1)).alias("okrug_name"))


def airports(t: Tables) -> DataFrame:
    """Airport markers; several rows per airport, the first (lowest nation key) wins."""
    return (t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("r_name").alias("airport"),
                    F.col("n_nationkey").alias("row_order"),
                    F.array((F.lit(55.0) + F.col("n_nationkey") / 100.0),
                            (F.lit(37.0) + F.col("n_nationkey") / 100.0)).alias("lat_lon")))


def licence_lines(t: Tables) -> DataFrame:
    """Raw lines of licence list files: names with trailing blanks, plus blank lines."""
    name = F.when(F.col("s_suppkey") % 3 == 0, F.concat("s_name", F.lit(" \t"))).otherwise(F.col("s_name"))
    blank = F.when(F.col("s_suppkey") % 7 == 0, F.array(F.lit("   "))).otherwise(F.array().cast("array<string>"))
    return (t.supplier
            .select(F.format_string("drivers%d.txt", (F.col("s_suppkey") % 3 + 1).cast("int")).alias("file_name"),
                    F.col("s_suppkey").alias("line_no"),
                    F.concat(F.array(name), blank).alias("lines"))
            .select("file_name", "line_no", F.posexplode("lines").alias("sub", "value"))
            .select("file_name", (F.col("line_no") * 2 + F.col("sub")).alias("line_no"), "value"))


def licence_registry(t: Tables) -> DataFrame:
    """Registry snapshot: every 20th licence twice (ambiguous), every 20th+1 under another number."""
    other = F.when(F.col("s_suppkey") % 20 == 1, F.concat("s_name", F.lit("-old"))).otherwise(F.col("s_name"))
    base = (t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey"),
                    other.alias("licence_number"),
                    F.col("n_name").alias("holder_name"),
                    F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("s_suppkey").cast("int")),
                                  "dd/MM/yyyy").alias("expiry_date")))
    dup = (base.where(F.col("s_suppkey") % 20 == 0)
           .withColumn("holder_name", F.concat("holder_name", F.lit(" (2)"))))
    return base.unionByName(dup).drop("s_suppkey")
