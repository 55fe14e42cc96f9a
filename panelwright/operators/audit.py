"""Fingerprints of tables and differences between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Columns that change without the data changing.
VOLATILE = ("vintage", "created_at", "updated_at", "ingested_at", "forecast_run_date")


def fingerprint(df: DataFrame, name: str, period: str | None = None, ignore: tuple[str, ...] = VOLATILE) -> DataFrame:
    """table_name, n_rows, hash, min_period, max_period in one pass, whatever the order of rows and columns.

    The hash joins an exclusive-or and a sum of row hashes, so that rows that occur twice count too.
    """
    columns = sorted(c for c in df.columns if c not in ignore)
    row = F.xxhash64(*columns)
    ends = [F.min(period).cast("long").alias("min_period"), F.max(period).cast("long").alias("max_period")] if period else [F.lit(None).cast("long").alias("min_period"), F.lit(None).cast("long").alias("max_period")]
    total = F.sum(F.pmod(row, F.lit(1 << 31)))
    return df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.concat_ws("-", F.hex(F.coalesce(F.bit_xor(row), F.lit(0))), F.hex(F.coalesce(total, F.lit(0)))).alias("hash"), *ends)


def table_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """status, rows_delta, hash_changed and period_extended of each table of two sets of fingerprints."""
    a, b = (df.select("table_name", *[F.col(c).alias(f"{c}_{s}") for c in ("n_rows", "hash", "max_period")]) for df, s in ((before, "before"), (after, "after")))
    joined = a.join(b, "table_name", "full")
    changed = ~F.col("hash_before").eqNullSafe(F.col("hash_after"))
    status = F.when(F.col("hash_before").isNull(), "CREATED").when(F.col("hash_after").isNull(), "DROPPED").when(changed, "MODIFIED").otherwise("UNCHANGED")
    return joined.select(
        "table_name", status.alias("status"), (F.coalesce("n_rows_after", F.lit(0)) - F.coalesce("n_rows_before", F.lit(0))).alias("rows_delta"), changed.alias("hash_changed"),
        F.coalesce(F.col("max_period_after") > F.col("max_period_before"), F.lit(False)).alias("period_extended"),
    )


def payload_hash(df: DataFrame, key: str, payload: str) -> DataFrame:
    """The first 16 hex digits of each payload's SHA-256."""
    return df.select(key, F.substring(F.sha2(F.col(payload), 256), 1, 16).alias("hash"))


def latest_matrix(df: DataFrame, entity: str, metrics: list[str], value: str = "value", period: str = "period") -> DataFrame:
    """Per entity a column of each metric's latest value."""
    return df.groupBy(entity).agg(*[F.max_by(value, F.when(F.col("metric") == m, F.col(period))).alias(m) for m in metrics])


def upload_report(df: DataFrame, required: list[str], key: list[str], data_type: str = "data_type", period: str = "period") -> DataFrame:
    """problem and n: missing columns, nulls in keys, equal keys, and whether there are forecasts."""
    spark = df.sparkSession
    missing = spark.createDataFrame([(f"missing {c}", 1) for c in required if c not in df.columns], "problem string, n long")
    holes = df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in key]).unpivot([], key, "problem", "n").select(F.concat(F.lit("null "), "problem").alias("problem"), "n")
    twice = df.groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)).alias("n")).select(F.lit("duplicate keys").alias("problem"), "n")
    ahead = df.agg(F.count_if(F.col(data_type) == "forecast").alias("n")).where("n = 0").select(F.lit("no forecasts").alias("problem"), F.lit(1).cast("long").alias("n"))
    return missing.unionByName(holes).unionByName(twice).unionByName(ahead).where("n > 0")


def change_overlay(registry: DataFrame, places: dict[str, str], names: dict[str, str], source: str = "source", indicator: str = "indicator") -> DataFrame:
    """indicator, place, changed and max_period: whether any source of a place brought new data for an indicator, and how far it reaches.

    registry: source, indicator, hash, previous_hash, max_period. places maps sources to places, names joins variants of an
    indicator; sources without a place are left out. A source seen for the first time counts as changed.
    """
    of = lambda c, m: F.coalesce(F.create_map(*[F.lit(x) for pair in m.items() for x in pair])[F.col(c)], F.lit(None)) if m else F.lit(None).cast("string")
    rows = registry.withColumn("place", of(source, places)).where(F.col("place").isNotNull()).withColumn("_indicator", F.coalesce(of(indicator, names), F.col(indicator)))
    changed = F.bool_or(~F.col("hash").eqNullSafe(F.col("previous_hash")))
    return rows.groupBy(F.col("_indicator").alias(indicator), "place").agg(changed.alias("changed"), F.max("max_period").alias("max_period"))


def recipients(people: DataFrame, failed: bool) -> DataFrame:
    """Those who want this run's report: enabled, and either every run's or, as it failed, that of failed ones."""
    wanted = F.col("weekly_report") | (F.col("failures_only") & F.lit(failed))
    return people.where(F.col("enabled") & F.coalesce(wanted, F.lit(False)))
