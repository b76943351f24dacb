import json
import os

import pytest
from pyspark.sql import functions as F

from tessera.plans import licences as L
from tessera.sources import files, sinks


def test_delimited_reader(spark, tmp_path):
    p = tmp_path / "session_data.csv"
    p.write_text("session;session_start_text;session_end_text;clickouts;booking\n"
                 "20170503000726;23:59:30;00:00:10;0;1\n2;10:00:00;10:05:00;3;0\n")
    df = files.read_delimited(spark, str(p), files.SESSIONS_SCHEMA)
    assert [tuple(r) for r in df.orderBy("session").collect()] == [
        (2, "10:00:00", "10:05:00", 3, 0), (20170503000726, "23:59:30", "00:00:10", 0, 1)]


@pytest.mark.parametrize("text", ["session;session_end_text;session_start_text;clickouts;booking\n2;a;b;3;0\n",
                                  "session;session_start_text;session_end_text;clickouts;booking\n2;a;b;many;0\n"])
def test_delimited_reader_refuses_other_headers_and_bad_fields(spark, tmp_path, text):
    p = tmp_path / "bad.csv"
    p.write_text(text)
    with pytest.raises(Exception, match="(?i)header|malformed|parse"):
        files.read_delimited(spark, str(p), files.SESSIONS_SCHEMA).collect()


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_document_reader(spark, tmp_path, fmt):
    p = str(tmp_path / "docs")
    rows = spark.createDataFrame([("a1", 1.5), ("b2", None)], "_id string, price double")
    rows.write.format(fmt).save(p)
    schema = spark.createDataFrame([], "_id string, price double, credit double").schema
    got = files.read_documents(spark, p, schema, fmt).where("_id >= 'b'").collect()
    assert [tuple(r) for r in got] == [("b2", None, None)]


def test_geojson_rings(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "properties": {"name": "a"},
         "geometry": {"type": "Polygon", "coordinates": [[[0, 0], [1, 0], [1, 1], [0, 0]], [[0.2, 0.2], [0.3, 0.2], [0.2, 0.3], [0.2, 0.2]]]}},
        {"type": "Feature", "properties": {"name": "b"},
         "geometry": {"type": "Polygon", "coordinates": [[[5, 5], [6, 5], [6, 6], [5, 5]]]}}]}
    p = tmp_path / "zones.geojson"
    p.write_text(json.dumps(doc, indent=2))
    rings = files.read_zone_rings(spark, str(p))
    assert [[tuple(p) for p in r.ring] for r in rings.orderBy("zone").collect()] == [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 0.0)], [(5.0, 5.0), (6.0, 5.0), (6.0, 6.0), (5.0, 5.0)]]
    doc["features"][1]["geometry"] = {"type": "MultiPolygon", "coordinates": [[[[5, 5], [6, 5], [6, 6], [5, 5]]]]}
    p.write_text(json.dumps(doc))
    with pytest.raises(Exception, match="must be a Polygon, found MultiPolygon"):
        files.read_zone_rings(spark, str(p)).collect()


def test_text_lines_licence_check(spark, tmp_path):
    d = tmp_path / "drivers"
    d.mkdir()
    (d / "drivers1.txt").write_text("L-001 \t\n\n   \nL-002\n")
    (d / "drivers2.txt").write_text("")                      # blank file
    (d / "notes.csv").write_text("L-003\n")                  # not a .txt file: ignored
    (d / "drivers3.txt").write_text("L-003\r\nL-004\n")
    lines = files.read_text_lines(spark, str(d))
    reg = spark.createDataFrame([("L-001", "Ann", "01/01/2025"), ("L-002", "Bob", "02/01/2025"),
                                 ("L-002", "Bea", "03/01/2025"), ("L-003", "Cy", "04/01/2025")],
                                "licence_number string, holder_name string, expiry_date string")
    out = [(r.file_name, r.licence_number, r.licence_holder_name, r.status)
           for r in L.licence_check(lines, reg).collect()]
    assert out == [("drivers1.txt", "L-001", "Ann", "OK"), ("drivers1.txt", "L-002", None, "TO CHECK"),
                   ("drivers3.txt", "L-003", "Cy", "OK"), ("drivers3.txt", "L-004", None, "NOT FOUND")]
    exp = L.export_rows(L.licence_check(lines, reg))
    assert exp.columns == list(L.EXPORT_HEADER)


def test_sinks_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([("2020-01-01", "a", 1), ("2020-02-01", "b", 2), ("2020-02-01", "c", 3)],
                               "month string, k string, v int").withColumn("month", F.col("month").cast("date"))
    t = str(tmp_path / "table")
    sinks.write_partitioned_table(df, t, "month")
    assert sorted(x for x in os.listdir(t) if x.startswith("month=")) == ["month=2020-01-01", "month=2020-02-01"]
    assert spark.read.parquet(t).where("month = '2020-02-01'").count() == 2
    h = str(tmp_path / "history")
    stamped = sinks.stamp_run(df, "2020-03-01 00:00:00")
    sinks.append_history(stamped, h, ["run_ts_utc", "month", "k", "v"])
    sinks.append_history(sinks.stamp_run(df, "2020-03-02 00:00:00"), h, ["run_ts_utc", "month", "k", "v"])
    back = sinks.read_history(spark, h, ["run_ts_utc", "month", "k", "v"])
    assert back.columns == ["run_ts_utc", "month", "k", "v"] and back.count() == 6
    c = str(tmp_path / "report")
    sinks.export_csv(df, c, ["k", "v"])
    sinks.export_csv(df, c, ["k", "v"], mode="append")
    assert spark.read.option("header", True).csv(c).count() == 6
