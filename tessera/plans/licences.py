"""C19 — batch licence check against a registry snapshot.

The reference typed each licence into a web form; here the registry is a
DataFrame.  The registry is reduced to one row per licence (count + values)
with a partial aggregate, then left-joined to the licence lines: one match →
holder and expiry, several → ``TO CHECK``, none → ``NOT FOUND``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Status texts; "TO CHECK" is the reference's own marker.
OK, TO_CHECK, NOT_FOUND = "OK", "TO CHECK", "NOT FOUND"
# CSV header of the exported file (reference column names).
EXPORT_HEADER = ("Licence Number", "Licence Holder Name", "Licence Expiry Date")


def clean_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """S7/X4 ``nonblank_lines``: strip trailing whitespace, drop empty lines."""
    v = F.regexp_replace(F.col(col), r"\s+$", "")
    return lines.withColumn(col, v).where(F.length(F.col(col)) > 0)


def licence_check(lines: DataFrame, registry: DataFrame) -> DataFrame:
    """Licence lines (file_name, line_no, value) → holder, expiry and status,
    in file-name then line order (O4)."""
    reg = (registry.groupBy("licence_number")
           .agg(F.count(F.lit(1)).alias("_n"), F.min("holder_name").alias("_holder"),
                F.min("expiry_date").alias("_expiry")))
    j = clean_lines(lines).join(reg, F.col("value") == F.col("licence_number"), "left")
    single = F.col("_n") == 1
    status = F.when(F.col("_n").isNull(), NOT_FOUND).when(single, OK).otherwise(TO_CHECK)
    return (j.select("file_name", "line_no", F.col("value").alias("licence_number"),
                     F.when(single, F.col("_holder")).alias("licence_holder_name"),
                     F.when(single, F.col("_expiry")).alias("licence_expiry_date"),
                     status.alias("status"))
            .orderBy("file_name", "line_no"))


def export_rows(checked: DataFrame) -> DataFrame:
    """K4 payload: only resolved licences, under the reference's header names."""
    return (checked.where(F.col("status") == OK)
            .select(F.col("licence_number").alias(EXPORT_HEADER[0]),
                    F.col("licence_holder_name").alias(EXPORT_HEADER[1]),
                    F.col("licence_expiry_date").alias(EXPORT_HEADER[2])))
