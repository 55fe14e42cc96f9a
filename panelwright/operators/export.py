"""The export: history, forecasts and derived rows as one table with one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def export_table(history: DataFrame, forecast: DataFrame, derived: DataFrame, entities: DataFrame, metrics: DataFrame) -> DataFrame:
    """History, forecasts after each series' last historical period, and derived rows; historical rows win.

    Tables: entity, metric, period, value, lo, hi. entities: (entity, entity_name), metrics: (metric, unit).
    Equal keys of one kind are told apart by value, so the result doesn't depend on order.
    """
    last = history.groupBy("entity", "metric").agg(F.max("period").alias("last_period"))
    later = forecast.join(last, ["entity", "metric"], "left").where(F.col("last_period").isNull() | (F.col("period") > F.col("last_period"))).drop("last_period")
    kinds = ((history, "historical", False), (later, "forecast", False), (derived, "derived", True))
    every = None
    for df, kind, calculated in kinds:
        part = df.withColumn("data_type", F.lit(kind)).withColumn("is_calculated", F.lit(calculated))
        every = part if every is None else every.unionByName(part, allowMissingColumns=True)
    rank = F.when(F.col("data_type") == "historical", 0).when(F.col("data_type") == "forecast", 1).otherwise(2)
    one = F.row_number().over(Window.partitionBy("entity", "metric", "period").orderBy(rank, "value"))
    kept = every.withColumn("_n", one).where("_n = 1").drop("_n")
    return kept.join(entities, "entity", "left").join(metrics, "metric", "left")


def vintages(history: DataFrame, forecasts: DataFrame, run: str = "forecast_run_date") -> DataFrame:
    """History and every run's forecasts, history first."""
    return history.unionByName(forecasts, allowMissingColumns=True).orderBy(F.asc_nulls_first(run), "entity", "metric", "period")


def chart_slices(df: DataFrame) -> DataFrame:
    """entity, metric, past and ahead: arrays of (period, value) in order, and n of both."""
    pick = lambda kind: F.array_sort(F.collect_list(F.when(F.col("data_type") == kind, F.struct("period", "value"))))
    return df.groupBy("entity", "metric").agg(pick("historical").alias("past"), pick("forecast").alias("ahead"), F.count(F.lit(1)).alias("n"))
