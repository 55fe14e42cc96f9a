"""Round trips of the readers and writers, and the revision streams."""

import json

import pytest
from pyspark.sql import functions as F

from panelwright.sources import tables
from panelwright.streaming import revisions


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([("a", 2000, 1.5), ("a", 2001, 2.5), ("b", 2000, None)], "entity string, period int, value double")


def _set(df):
    return sorted((tuple(x) for x in df.collect()), key=str)


def test_csv_with_a_mark_and_blanks_in_its_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("﻿ code , value\nA,1\nB,\n", encoding="utf-8")
    assert tables.read_csv(spark, str(tmp_path / "x.csv")).columns == ["code", "value"]
    typed = tables.read_csv(spark, str(tmp_path / "x.csv"), "code string, value int")
    assert _set(typed) == [("A", 1), ("B", None)]


def test_batches_are_joined_by_name(spark, tmp_path):
    (tmp_path / "1.csv").write_text("code,value\nA,1\n")
    (tmp_path / "2.csv").write_text("note,code\nlate,B\n")
    out = tables.read_batches(spark, [str(tmp_path / "1.csv"), str(tmp_path / "2.csv")])
    assert out.columns == ["code", "value", "note"] and _set(out) == [("A", "1", None), ("B", None, "late")]
    with pytest.raises(ValueError, match="no batch"):
        tables.read_batches(spark, [])


def test_export_and_fallback(spark, rows, tmp_path):
    tables.export_csv(rows, str(tmp_path / "out.csv"))
    assert _set(tables.table_or(spark, "no_such_table", str(tmp_path / "out.csv"))) == _set(rows.select("entity", F.col("period").cast("string"), F.col("value").cast("string")))
    rows.write.parquet(str(tmp_path / "out"))
    assert _set(tables.table_or(spark, "no_such_table", str(tmp_path / "out"))) == _set(rows)
    rows.createOrReplaceTempView("some_table")
    assert _set(tables.table_or(spark, "some_table", "nowhere")) == _set(rows)
    assert tables.columns_of(spark, "some_table") == [("entity", "string"), ("period", "int"), ("value", "double")]


def test_tables_are_replaced_and_appended(spark, rows):
    try:
        tables.replace_table(rows, "panelwright_test")
        tables.append_table(rows.where("period = 2001"), "panelwright_test")
        assert spark.table("panelwright_test").count() == 4
        tables.replace_table(rows, "panelwright_test")
        assert _set(spark.table("panelwright_test")) == _set(rows)
    finally:
        spark.sql("DROP TABLE IF EXISTS panelwright_test")


def test_upserts_keep_one_row_a_key(spark, rows, tmp_path):
    new = spark.createDataFrame([("a", 2001, 9.0), ("a", 2001, 7.0), ("c", 2002, 1.0)], rows.schema)
    want = [("a", 2000, 1.5), ("a", 2001, 9.0), ("b", 2000, None), ("c", 2002, 1.0)]
    assert _set(tables.upserted(rows, new, ["entity", "period"])) == want
    assert ("a", 2001, 7.0) in _set(tables.upserted(rows, new, ["entity", "period"], [F.col("value")]))
    rows.write.parquet(str(tmp_path / "panel"))
    version = tables.upsert_path(spark, new, str(tmp_path / "panel"), ["entity", "period"])
    assert _set(spark.read.parquet(version)) == want and _set(spark.read.parquet(str(tmp_path / "panel"))) == _set(rows)


def test_metadata_is_one_report(rows):
    report = json.loads(tables.metadata(rows, {"n": F.count(F.lit(1)), "nulls": F.count_if(F.col("value").isNull()), "last": F.max("period")}))
    assert report == {"n": 3, "nulls": 1, "last": 2001}


def test_revisions_replace_older_values(spark, tmp_path):
    source, path = tmp_path / "in", str(tmp_path / "out")
    schema = "entity string, period int, value double, seen int"

    def arrive(batch):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        revisions.revision_stream(stream, path, ["entity", "period"], [F.col("seen").desc()], str(tmp_path / "ck")).awaitTermination()

    arrive([("a", 2000, 1.0, 1), ("a", 2000, 2.0, 2), ("b", 2000, 5.0, 1)])
    arrive([("a", 2000, 3.0, 3), ("c", 2001, 4.0, 3)])
    assert _set(spark.read.parquet(f"{path}/v1").select("entity", "value")) == [("a", 3.0), ("b", 5.0), ("c", 4.0)]


def test_windowed_sums(spark):
    df = spark.createDataFrame([("a", "2020-01-01 00:05:00", 1.0), ("a", "2020-01-01 00:50:00", 2.0), ("a", "2020-01-01 01:00:00", 4.0)], "k string, t string, v double").withColumn("t", F.to_timestamp("t"))
    out = revisions.windowed_sums(df, "t", "1 hour", "10 minutes", ["k"], "v")
    assert sorted((x["n"], x["total"]) for x in out.collect()) == [(1, 4.0), (2, 3.0)]


def test_jdbc_export_replaces_rows(spark):
    from panelwright.sources.tables import export_jdbc

    url = "jdbc:derby:memory:exports;create=true"
    for rows in ([(1, "a"), (2, "b")], [(3, "c")]):
        export_jdbc(spark.createDataFrame(rows, "k int, v string"), url, "kept", driver="org.apache.derby.jdbc.EmbeddedDriver")
    found = spark.read.jdbc(url, "kept", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    assert [(r["k"], r["v"]) for r in found.select(*[found[c].alias(c.lower()) for c in found.columns]).collect()] == [(3, "c")]


def test_units_stop_a_run_and_magnitudes_are_rescaled(spark):
    from pyspark.sql import functions as F

    from panelwright.operators import derived

    df = spark.createDataFrame([(5.0,), (250_000.0,), (None,), (-3.0,), (0.0,)], "v double")
    out = [r["v"] for r in df.select(derived.magnitude_rescaled(F.col("v"), 100_000, 1000).alias("v")).collect()]
    assert out == [5000.0, 250_000.0, None, -3.0, 0.0]
    assert [r["v"] for r in df.select(derived.unit_checked(F.col("v"), 1e6).alias("v")).collect()] == [5.0, 250_000.0, None, -3.0, 0.0]
    with pytest.raises(Exception, match="unit is wrong"):
        df.select(derived.unit_checked(F.col("v"), 1e5)).collect()
