"""Reading raw files, and writing tables, upserts and views."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """A CSV with a header; a byte-order mark and blanks around names go. Types stay text unless a schema is given."""
    reader = spark.read.option("header", True)
    df = reader.schema(schema).csv(path) if schema else reader.csv(path)
    return df.toDF(*[re.sub("^﻿", "", c).strip() for c in df.columns])


def read_batches(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The union of batch files by name, columns that a batch lacks being null."""
    out = None
    for path in paths:
        part = read_csv(spark, path)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no batch to read")
    return out


def read_cube(cube: DataFrame, members: dict[str, list[str]], codes: DataFrame, code_col: str, statistic_col: str, total_codes: tuple[str, ...] = ()) -> DataFrame:
    """A statistical cube as rows: the given members of each dimension, totals left out, statistics named by a map.

    codes: (statistic, metric), a small table.
    """
    out = cube
    for dimension, wanted in members.items():
        out = out.where(F.col(dimension).isin(wanted))
    out = out.where(~F.col(code_col).isin(*total_codes)) if total_codes else out
    return out.join(codes.withColumnRenamed("statistic", statistic_col), statistic_col)


def table_or(spark: SparkSession, name: str, fallback: str) -> DataFrame:
    """A catalog table, or the Parquet or CSV file at ``fallback`` if there is none."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return read_csv(spark, fallback) if fallback.endswith(".csv") else spark.read.parquet(fallback)


def wide_to_long(df: DataFrame, keys: list[str], name: str = "period", value: str = "value") -> DataFrame:
    """Year columns (those whose names are whole numbers) as rows; rows without a value go."""
    years = [c for c in df.columns if re.fullmatch(r"\d{4}", c)]
    return df.unpivot(keys, years, name, value).withColumn(name, F.col(name).cast("int")).where(F.col(value).isNotNull())


def replace_table(df: DataFrame, name: str) -> None:
    database = name.rpartition(".")[0]
    if database:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    df.write.mode("overwrite").saveAsTable(name)


def append_table(df: DataFrame, name: str) -> None:
    df.write.mode("append").saveAsTable(name)


def upserted(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of the same keys.

    Of equal keys in ``new`` the first in ``order`` stays, or without one the row whose other columns are largest.
    """
    newest = newest_first(new, keys, order or [F.col(c).desc() for c in new.columns if c not in keys] or [F.col(keys[0])])
    return old.join(newest.select(keys), keys, "left_anti").select(old.columns).unionByName(newest.select(old.columns))


def upsert_path(spark: SparkSession, new: DataFrame, path: str, keys: list[str]) -> str:
    """Write the upsert beside the old version, and return the new version's path, which the caller switches to."""
    version = f"{path.rstrip('/')}-{uuid.uuid4().hex[:12]}"
    upserted(spark.read.parquet(path), new, keys).write.parquet(version)
    return version


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def export_jdbc(df: DataFrame, url: str, table: str, **properties: str) -> None:
    df.write.option("truncate", True).jdbc(url, table, "overwrite", properties)


def forecast_view(df: DataFrame, name: str, data_type: str = "data_type") -> None:
    df.where(F.col(data_type) == "forecast").createOrReplaceTempView(name)


def latest_run(df: DataFrame, run_date: str = "forecast_run_date") -> DataFrame:
    """The rows of the latest run date."""
    latest = df.agg(F.max(run_date).alias("_latest"))
    return df.join(F.broadcast(latest), F.col(run_date) == F.col("_latest")).drop("_latest")


def metadata(df: DataFrame, measures: dict[str, Column]) -> str:
    """A JSON report of aggregates, made by one pass."""
    row = df.agg(*[v.alias(k) for k, v in measures.items()]).first()
    return json.dumps(row.asDict(), default=str, sort_keys=True)


def columns_of(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    return spark.table(name).dtypes


def attribute_map(facts: DataFrame, code: str, key: str, value: str) -> DataFrame:
    """code, attributes: a map from key to value for each code; equal keys of a code must agree or the largest stays."""
    unique = facts.groupBy(code, key).agg(F.max(value).alias(value))
    return unique.groupBy(code).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, value)))).alias("attributes"))


def newest_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
