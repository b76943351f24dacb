"""C17/C18 — airport transfer price heatmap cells.

C18 aggregates every transfer to (airport, cell) with exact sums of the two
directions.  C17 is the per-cell styling the map callback did: value, colour on
a clamped red→yellow→green scale, label text, centre, polygon and the airport
marker (first-match lookup).  Centre, polygon and district are columns of the
cell table.  The drawing itself is left to any map tool.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.exprs import MARKUP_RANGE, PRICE_RANGE, cents, div_half_even, linear_colour

DIRECTIONS = ("from", "to")

def fixed_vs_tariff(trips: DataFrame) -> DataFrame:
    """C18: per (airport, cell) the fixed-price markup over the city tariff in %
    for each direction, 100·(avg fixed − avg tariff)/avg tariff (2 dp), plus
    the average tariff.  Sums are exact decimals."""
    fixed = F.col("fixed_price").cast("decimal(18,2)")
    tariff = F.col("tariff_price").cast("decimal(18,2)")
    aggs = []
    for d in DIRECTIONS:
        on = F.col("direction") == d
        aggs += [F.sum(F.when(on, fixed)).alias(f"_f_{d}"), F.sum(F.when(on, tariff)).alias(f"_t_{d}")]
    agg = (trips.groupBy("airport", "hexagon_id")
           .agg(*aggs, F.sum(tariff).alias("_t"), F.count(F.lit(1)).alias("n_trips")))
    cols = ["airport", "hexagon_id", "n_trips"]
    for d in DIRECTIONS:
        diff = cents(F.col(f"_f_{d}")) - cents(F.col(f"_t_{d}"))
        cols.append(div_half_even(diff * 100, cents(F.col(f"_t_{d}")), 2).alias(f"fixed_vs_tariff_{d}_price_pct"))
    weighted = div_half_even(cents(F.col("_t")), F.col("n_trips") * 100, 2)
    cols.append(weighted.alias("price_tariff_rub_weighted"))
    return agg.select(*cols)


def airport_markers(airports: DataFrame) -> DataFrame:
    """J8: first row per airport (lowest ``row_order``) → its lat/lon."""
    return (airports.groupBy("airport")
            .agg(F.min_by("lat_lon", "row_order").alias("lat_lon"))
            .select("airport", F.col("lat_lon")[0].alias("airport_lat"), F.col("lat_lon")[1].alias("airport_lon")))


def heatmap_cells(cells: DataFrame, airports: DataFrame, airport: str | None = None,
                  direction: str | None = None, values_field: str | None = None,
                  is_new_prices: bool = False) -> DataFrame:
    """C17 ``prices_heatmap``: one styled row per cell (and direction).

    ``airport``/``direction`` None means all of them in one job (the notebook
    loops); ``values_field`` defaults to ``fixed_vs_tariff_{direction}_price_pct``.
    With new prices the colour follows the ``price_tariff_rub_weighted`` of the
    first cell (by id) of the cell's district, while the label shows ``values_field``.
    """
    df = cells if airport is None else cells.where(F.col("airport") == airport)
    if is_new_prices:
        district = (df.groupBy("airport", "okrug_name")
                    .agg(F.min_by("price_tariff_rub_weighted", "hexagon_id").alias("_price")))
        df = df.join(district, ["airport", "okrug_name"], "left")
    dirs = DIRECTIONS if direction is None else (direction,)
    pairs = [F.struct(F.lit(d).alias("direction"), F.col(values_field or f"fixed_vs_tariff_{d}_price_pct").cast("double").alias("value")) for d in dirs]
    rows = df.select("airport", "hexagon_id", *(["_price"] if is_new_prices else []),
                     "centre_lat", "centre_lon", "geojson_polygon", F.inline(F.array(*pairs)))
    v = F.col("value")
    if not is_new_prices:
        colour = linear_colour(v, *MARKUP_RANGE)
        label = F.concat(F.col("hexagon_id"), F.lit(": "), v.cast("string"), F.lit("%"))
        marker = F.concat(v.cast("string"), F.lit("%"))
    else:
        colour = linear_colour(F.col("_price"), *PRICE_RANGE)
        label = v.cast("string")
        marker = v.cast("string")
    styled = rows.select("airport", "direction", "hexagon_id", "value", label.alias("label"),
                         marker.alias("marker_text"), colour.alias("colour"), "centre_lat", "centre_lon",
                         "geojson_polygon")
    return styled.join(airport_markers(airports), "airport", "left")
