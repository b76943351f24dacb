"""File readers: explicit schemas, or types inferred from all rows.

Every reader is a lazy DataFrame source; Spark splits the files across tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SESSIONS_SCHEMA = T.StructType([
    T.StructField("session", T.LongType()),
    T.StructField("session_start_text", T.StringType()),
    T.StructField("session_end_text", T.StringType()),
    T.StructField("clickouts", T.IntegerType()),
    T.StructField("booking", T.IntegerType()),
])

CAMPAIGNS_SCHEMA = T.StructType([
    T.StructField("Week", T.IntegerType()),
    T.StructField("Campaign", T.StringType()),
    T.StructField("Visits", T.LongType()),
    T.StructField("Revenue", T.DoubleType()),
    T.StructField("Cost", T.DoubleType()),
])

GEOJSON_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
        T.StructField("geometry", T.StructType([
            T.StructField("type", T.StringType()),
            T.StructField("coordinates", T.StringType()),
        ])),
    ]))),
])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ";",
                   header: bool = True) -> DataFrame:
    """S1 ``read_csv(path, delimiter=';')`` with a declared schema.

    A header that names other columns, or in another order, and a field that
    does not parse are errors.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("mode", "FAILFAST")
    return reader.option("enforceSchema", not header).schema(schema).csv(path)


# Fields that the frame library's reader takes for missing.
MISSING = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_INT = r"^\s*[+-]?[0-9]+\s*$"
_FLOAT = r"^\s*[+-]?([0-9]+\.?[0-9]*([eE][+-]?[0-9]+)?|\.[0-9]+([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
_BOOL = r"^(?i:true|false)$"


def inferred_types(raw: DataFrame) -> dict[str, str]:
    """Type of every text column, as the frame library's reader infers it from all rows.

    One aggregate over the data says per column whether all its fields are
    missing, whole numbers that fit a long, numbers, or truth values; the types
    are the lattice long < double < text, and a missing field lifts a long to a
    double and a truth value to text.  A column without fields is a double.
    """
    def facts(c):
        v = F.col(f"`{c}`")
        gone = v.isNull() | v.isin(*MISSING)
        whole = v.rlike(_INT) & F.expr(f"try_cast(trim(BOTH FROM `{c}`) AS BIGINT)").isNotNull()
        return F.struct(F.count_if(gone).alias("gone"), F.count_if(~gone).alias("there"), *[F.count_if(~gone & ~test).alias(k) for k, test in (
            ("not_int", whole), ("not_float", v.rlike(_FLOAT)), ("not_bool", v.rlike(_BOOL)))])

    row = raw.agg(*[facts(c).alias(f"c{i}") for i, c in enumerate(raw.columns)]).first()
    out = {}
    for i, c in enumerate(raw.columns):
        f = row[f"c{i}"]
        if not f.there:
            out[c] = "double" if f.gone else "string"
        elif not f.not_bool and not f.gone:
            out[c] = "boolean"
        else:
            out[c] = "string" if f.not_float else "double" if f.not_int or f.gone else "bigint"
    return out


def read_delimited_inferred(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """S1 ``read_csv(path)``: names from the header, types from all rows (one job), missing fields NULL."""
    raw = spark.read.option("sep", sep).option("header", True).option("inferSchema", False).option("mode", "FAILFAST").csv(path)
    kinds = inferred_types(raw)

    def typed(c):
        v = F.col(f"`{c}`")
        v = F.when(~v.isin(*MISSING), v)
        if kinds[c] == "double":  # Spark's parser knows no "inf"
            v = F.regexp_replace(F.trim(v), "(?i)inf(inity)?$", "Infinity")
        elif kinds[c] != "string":
            v = F.trim(v)
        return v.cast(kinds[c]).alias(c)

    return raw.select(*[typed(c) for c in raw.columns])


def read_warehouse_query(spark: SparkSession, url: str, query: str, properties: dict | None = None,
                         fetch_size: int = 10_000) -> DataFrame:
    """S2/S3 warehouse query scan over JDBC.  The query (with its filters and,
    for S3, its GROUP BY) runs at the source; Spark reads the result.  For a
    partitioned parallel read of a large table use ``dbtable`` with
    ``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions`` options."""
    reader = spark.read.format("jdbc").option("url", url).option("query", query).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_documents(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "json") -> DataFrame:
    """S4 document-store snapshot (JSON lines or Parquet); absent fields are NULL.

    Range filters and projections applied afterwards are pushed into the scan.
    """
    reader = spark.read.schema(schema)
    return reader.json(path) if fmt == "json" else reader.format(fmt).load(path)


#: Partition column of a document snapshot laid out by the day of its ids.
ID_DAY = "id_day"


def _id_day(id_col: str) -> F.Column:
    """Day of an id whose first 8 hex digits are its creation time in seconds (UTC)."""
    return F.to_date(F.timestamp_seconds(F.conv(F.substring(id_col, 1, 8), 16, 10).cast("long")))


def write_documents_by_day(docs: DataFrame, path: str, id_col: str = "_id") -> None:
    """S4 snapshot with one folder per id day; a day with most rows is split into several files."""
    (docs.withColumn(ID_DAY, _id_day(id_col)).hint("rebalance", ID_DAY).sortWithinPartitions(id_col)
     .write.mode("overwrite").partitionBy(ID_DAY).parquet(path))


def read_document_range(spark: SparkSession, path: str, start: str, end: str, fields=None, id_col: str = "_id") -> DataFrame:
    """S4 range and projection at the source: ids created in [start, end), dates in UTC, and only ``fields``.

    The range becomes filters on the day folders (only those are listed and
    read) and on the sorted ids (row groups are skipped); the projection reaches
    the file's columns.
    """
    low, high = (F.rpad(F.lower(F.hex(F.unix_date(F.lit(d).cast("date")).cast("long") * 86400)), 24, "0") for d in (start, end))
    rows = spark.read.parquet(path).where((F.col(ID_DAY) >= F.lit(start).cast("date")) & (F.col(ID_DAY) < F.lit(end).cast("date"))
                                          & (F.col(id_col) >= low) & (F.col(id_col) < high))
    return rows.select(*fields) if fields else rows.drop(ID_DAY)


def read_zone_rings(spark: SparkSession, path: str) -> DataFrame:
    """S6 GeoJSON polygons: one row per feature with its exterior ring
    (``coordinates[0]``); holes are ignored like in the reference.  Any other
    kind of geometry is an error that names it."""
    doc = spark.read.option("multiLine", True).schema(GEOJSON_SCHEMA).json(path)
    kind = F.col("f.geometry.type")
    wrong = F.raise_error(F.concat(F.lit("a zone must be a Polygon, found "), F.coalesce(kind, F.lit("no geometry"))))
    ring = F.when(kind == "Polygon", F.from_json("f.geometry.coordinates", "array<array<array<double>>>")[0]).otherwise(wrong)
    return doc.select(F.posexplode("features").alias("zone", "f")).select("zone", ring.alias("ring"))


def read_text_lines(spark: SparkSession, folder: str, suffix: str = ".txt", contains: str = "") -> DataFrame:
    """S7 directory of list files: only ``*contains*suffix`` files (F17), with file name
    and exact line number from 1, so the output can follow file order (O4).

    A file may be read in many splits.  Each split's lines are counted, the
    counts of a file's earlier splits are added up, and a line's number is its
    place in its split plus that sum; only the counts are shuffled, one row a split.
    """
    df = spark.read.option("pathGlobFilter", f"*{contains}*{suffix}" if contains else f"*{suffix}").text(folder)
    # rows of a split are neighbours in one task: their place in the task, less that of the split's first row
    in_task = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    split = ["_path", "_start"]
    lines = df.select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"), F.col("_metadata.file_name").alias("file_name"),
                      in_task.alias("_at"), "value")
    sizes = lines.groupBy(*split).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*split, "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    return lines.join(offsets, split).select("file_name", (F.col("_at") - F.col("_first") + F.col("_before") + 1).alias("line_no"), "value")
