"""C1 — monthly user lifecycle states: new / retained / reactivated / churned.

Plan shape (see ``explain``):

* (passenger, first month, month) is deduplicated with a map-side partial
  aggregate, so a passenger with a third of all journeys still contributes at
  most one row per month to the shuffle;
* LAG/LEAD run in one window partitioned by passenger;
* the churn follow-up row is produced by a generator on the same rows instead
  of a UNION, which keeps the passenger partitioning for the user join;
* ``COUNT(DISTINCT CASE WHEN flag THEN id END)`` ×4 becomes one dedup
  aggregate on (group, passenger) — satisfied by the passenger partitioning,
  so no extra exchange — followed by a plain partial/final count.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.exprs import month_diff, trunc_date

#: Journeys that one task should hold: adaptive execution sizes tasks by compressed bytes, which tell little of the rows' memory.
TASK_ROWS = 250_000
STATES = ("is_new", "is_retained", "is_reactivated", "is_churned")


def _cutoff(as_of: str) -> F.Column:
    """First day of the (incomplete) month containing ``as_of``."""
    return F.trunc(F.lit(as_of).cast("date"), "month")


def passenger_month_stats(journeys: DataFrame, as_of: str) -> DataFrame:
    """One row per (passenger, active month) with the four lifecycle flags
    and the "no ride next month" marker."""
    cutoff = _cutoff(as_of)
    active = (journeys
              .where(F.col("completed_dt_loc") < cutoff)
              .select("passenger_id",
                      trunc_date("month", "passenger_first_completed_ts_loc").alias("first_month"),
                      trunc_date("month", "completed_dt_loc").alias("month"))
              .distinct())
    w = Window.partitionBy("passenger_id").orderBy("month")
    prev = F.lag("month").over(w)
    nxt = F.lead("month").over(w)
    with_nb = active.select("passenger_id", "month", "first_month",
                            prev.alias("prev_month"), nxt.alias("next_month"))
    gap_prev = month_diff("prev_month", "month")
    return with_nb.select(
        "passenger_id", "month",
        F.coalesce(F.col("first_month") == F.col("month"), F.lit(False)).alias("is_new"),
        F.coalesce(gap_prev == 1, F.lit(False)).alias("is_retained"),
        F.coalesce(gap_prev > 1, F.lit(False)).alias("is_reactivated"),
        (F.col("next_month").isNull() | (month_diff("month", "next_month") != 1)).alias("gone_next_month"),
    )


def user_month_states(journeys: DataFrame, as_of: str) -> DataFrame:
    """Activity rows plus one churn row in the month after each last-active month.

    Equal rows count once (a passenger with two first-ride dates has two rows
    a month before that); the distinct runs on the window's partitioning.
    """
    stats = passenger_month_stats(journeys, as_of)
    activity = F.struct(F.col("month"), F.col("is_new"), F.col("is_retained"),
                        F.col("is_reactivated"), F.lit(False).alias("is_churned"))
    churn = F.struct(F.add_months("month", 1).alias("month"), F.lit(False).alias("is_new"),
                     F.lit(False).alias("is_retained"), F.lit(False).alias("is_reactivated"),
                     F.lit(True).alias("is_churned"))
    rows = F.when(F.col("gone_next_month"), F.array(activity, churn)).otherwise(F.array(activity))
    return stats.select("passenger_id", F.inline(rows)).distinct()


def churn_monthly(journeys: DataFrame, users: DataFrame, as_of: str) -> DataFrame:
    """Per (country, city, attribution channel, month < current month) counts of
    new, retained, reactivated and churned passengers."""
    states = user_month_states(journeys, as_of).where(F.col("month") < _cutoff(as_of))
    u = users.select(F.col("user_id"), F.col("country_code").alias("country"), "city",
                     F.col("last_attribution_channel").alias("attribution_channel"))
    joined = states.join(u, states["passenger_id"] == u["user_id"])
    keys = ["country", "city", "attribution_channel", "month"]
    # distinct passengers per group and state: dedupe on (group, passenger) first
    per_passenger = (joined.groupBy(*keys, "passenger_id")
                     .agg(*[F.max(F.col(s).cast("int")).alias(s) for s in STATES]))
    out = (per_passenger.groupBy(*keys)
           .agg(*[F.sum(s).cast("long").alias(name)
                  for s, name in zip(STATES, ("new", "retained", "reactivated", "churned"))]))
    return out.orderBy("country", "city", "month", "attribution_channel")


# ---- month by month -------------------------------------------------------------------
# The state a run leaves behind is one row per passenger with the last active month, so the
# next run reads one month of journeys and the state, not the history.

def month_states(journeys: DataFrame, state: DataFrame, month: str) -> DataFrame:
    """Lifecycle rows of one month (first day, "yyyy-mm-01"), from its journeys and the (passenger_id, last_month) state before it.

    Equals the month's rows of :func:`user_month_states` over all journeys where
    a passenger has one first-ride date.  Journeys of other months are left out.
    """
    m = F.lit(month).cast("date")
    both = _with_state(journeys, state, m)
    flags = {"is_new": F.col("first_month") == m, "is_retained": month_diff("last_month", m) == 1, "is_reactivated": month_diff("last_month", m) > 1}
    return (both.where(~F.col("_idle") | (month_diff("last_month", m) == 1))
            .select("passenger_id", m.alias("month"), *[(~F.col("_idle") & F.coalesce(f, F.lit(False))).alias(k) for k, f in flags.items()], F.col("_idle").alias("is_churned")))


def next_state(journeys: DataFrame, state: DataFrame, month: str) -> DataFrame:
    """The (passenger_id, last_month) state after the month."""
    m = F.lit(month).cast("date")
    return _with_state(journeys, state, m).select("passenger_id", F.when(F.col("_idle"), F.col("last_month")).otherwise(m).alias("last_month"))


def _with_state(journeys: DataFrame, state: DataFrame, m: F.Column) -> DataFrame:
    active = (journeys.where((F.col("completed_dt_loc") >= m) & (F.col("completed_dt_loc") < F.add_months(m, 1)))
              .select("passenger_id", trunc_date("month", "passenger_first_completed_ts_loc").alias("first_month"), F.lit(True).alias("_active")).distinct())
    old = state.select(F.col("passenger_id").alias("_pid"), "last_month", F.lit(True).alias("_known"))
    joined = active.join(old, F.col("passenger_id").eqNullSafe(F.col("_pid")), "full")
    return joined.select(F.when(F.col("_active"), F.col("passenger_id")).otherwise(F.col("_pid")).alias("passenger_id"), "first_month", "last_month",
                         F.col("_active").isNull().alias("_idle"))


def refresh_month(spark, journeys_path: str, state_path: str, table_path: str, month: str) -> None:
    """K1 one month's run: reads the journeys' ``month=`` folder and the state of the month before, writes the
    month's rows and the state after it.  A repeated run overwrites just what it wrote."""
    before = f"{state_path}/month={_months_before(month, 1)}"
    journeys = spark.read.parquet(journeys_path).where(F.col("month") == F.lit(month).cast("date"))
    try:
        state = spark.read.schema("passenger_id long, last_month date").parquet(before)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        state = spark.createDataFrame([], "passenger_id long, last_month date")  # the first month
    month_states(journeys, state, month).drop("month").write.mode("overwrite").parquet(f"{table_path}/month={month}")
    next_state(journeys, state, month).write.mode("overwrite").parquet(f"{state_path}/month={month}")


def _months_before(month: str, n: int) -> str:
    year, number = int(month[:4]), int(month[5:7]) - 1 - n
    return f"{year + number // 12:04d}-{number % 12 + 1:02d}-01"
