"""Column helpers.

All helpers return built-in Column expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = "Column | str"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- arithmetic -------------------------------------------------------------

def safe_div(num, den) -> Column:
    """Division that yields NULL on a zero (or NULL) divisor instead of an ANSI error."""
    return F.try_divide(_c(num), _c(den))


def bround(x, scale: int = 0) -> Column:
    """Half-even rounding (the frame/NumPy ``round`` behaviour)."""
    return F.bround(_c(x), scale)


def div_half_even(num, den, digits: int) -> Column:
    """num/den of whole numbers rounded half-even to ``digits`` decimals, as the nearest double.

    Quotient, remainder and tie rule are exact DECIMAL arithmetic: numerators
    of up to 30 digits, quotients (scaled) within a 64-bit integer.  NULL where
    either is NULL or the divisor is zero.
    """
    n, d = _c(num).cast("decimal(30,0)"), _c(den).cast("decimal(30,0)")
    whole = F.abs(n) * F.lit(10 ** digits).cast("decimal(7,0)")
    by = F.when(d != 0, F.abs(d))
    q, r = F.call_function("div", whole, by), whole % by
    twice = r * F.lit(2).cast("decimal(1,0)")
    up = q + F.when((twice > by) | ((twice == by) & (q % 2 == 1)), 1).otherwise(0)
    exact = up.cast("decimal(20,0)") * F.lit(f"{10 ** -digits:.{digits}f}").cast(f"decimal({digits + 1},{digits})")
    return F.when((n < 0) != (d < 0), -exact).otherwise(exact).cast("double")


def units(x, scale: int = 8) -> Column:
    """An amount as a whole number of its ``scale``-th decimals (exact)."""
    return (_c(x).cast(f"decimal(30,{scale})") * F.lit(10 ** scale).cast("decimal(9,0)")).cast("decimal(30,0)")


def cents(x) -> Column:
    """A 2-dp amount as a whole number of cents (exact)."""
    return units(x, 2)


# --- dates ------------------------------------------------------------------

def trunc_date(granularity: str, ts) -> Column:
    """``date_trunc(g, ts)::date``; weeks start on Monday."""
    return F.to_date(F.date_trunc(granularity, _c(ts)))


def month_diff(a, b) -> Column:
    """``DATEDIFF('month', a, b)``: month boundaries crossed from a to b."""
    a, b = _c(a), _c(b)
    return (F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))


# --- time of day ------------------------------------------------------------

def hms_seconds(text) -> Column:
    """Seconds since midnight of an ``HH:MM:SS`` string."""
    parts = F.split(_c(text), ":")
    return (parts.getItem(0).cast("int") * 3600 + parts.getItem(1).cast("int") * 60
            + parts.getItem(2).cast("int"))


def wrap_midnight(duration_sec) -> Column:
    """A negative duration means the session crossed midnight: add one day."""
    d = _c(duration_sec)
    return F.when(d < 0, d + 86400).otherwise(d)


def minute_range_label(duration_sec) -> Column:
    """``"k-(k+1)"`` where k is the duration in whole (truncated) minutes."""
    k = (_c(duration_sec) / 60).cast("int")
    return F.concat(k.cast("string"), F.lit("-"), (k + 1).cast("string"))


# --- ids --------------------------------------------------------------------

def unix_day(date) -> Column:
    """Seconds of a date's midnight in UTC, whatever the session's time zone."""
    return F.unix_date(_c(date).cast("date")).cast("long") * 86400


def object_id_hex(ts, serial) -> Column:
    """24-hex document id: 8 hex of the unix seconds of a zone-less UTC time, then 16 hex of a serial."""
    t = _c(ts).cast("timestamp_ntz")
    secs = unix_day(t) + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return F.lower(F.concat(F.lpad(F.hex(secs), 8, "0"), F.lpad(F.hex(_c(serial)), 16, "0")))


def object_id_day(oid) -> Column:
    """UTC day of the time in an id's leading 8 hex digits."""
    secs = F.conv(F.substring(_c(oid), 1, 8), 16, 10).cast("long")
    return F.date_from_unix_date(F.floor(secs / 86400).cast("int"))


def object_id_bound(date) -> Column:
    """Smallest id at a date's midnight (UTC)."""
    return F.lower(F.concat(F.lpad(F.hex(unix_day(date)), 8, "0"), F.lit("0" * 16)))


# --- colour scale -----------------------------------------------------------

# The three colour stops of the heatmap scale, as RGB floats,
# named red, yellow and green in the source (CSS colours #FF0000, #FFFF00,
# #008000), and the two value ranges the scale is drawn over.
COLOUR_STOPS = ((1.0, 0.0, 0.0), (1.0, 1.0, 0.0), (0.0, 128.0 / 255.0, 0.0))
MARKUP_RANGE = (-60.0, 60.0)
PRICE_RANGE = (1500.0, 4500.0)


def linear_colour(value, vmin: float, vmax: float) -> Column:
    """Clamped 3-stop linear colour scale red→yellow→green as ``#rrggbb``.

    Stops sit at vmin, the midpoint and vmax; each channel is interpolated
    linearly and converted to a byte with ``int(f * 255.9999)``.
    """
    v = _c(value).cast("double")
    mid = (vmin + vmax) / 2.0
    half = (vmax - vmin) / 2.0
    lower = (v - F.lit(vmin)) / F.lit(half)          # position inside the first half
    upper = (v - F.lit(mid)) / F.lit(half)           # position inside the second half
    channels = []
    for j in range(3):
        a, b, c = COLOUR_STOPS[0][j], COLOUR_STOPS[1][j], COLOUR_STOPS[2][j]
        f = (F.when(v <= vmin, F.lit(a))
             .when(v >= vmax, F.lit(c))
             .when(v <= mid, F.lit(a) * (1 - lower) + F.lit(b) * lower)
             .otherwise(F.lit(b) * (1 - upper) + F.lit(c) * upper))
        channels.append(F.lpad(F.lower(F.hex(F.floor(f * 255.9999).cast("int"))), 2, "0"))
    return F.when(v.isNull(), F.lit(None)).otherwise(F.concat(F.lit("#"), *channels))
