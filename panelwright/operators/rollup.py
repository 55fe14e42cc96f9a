"""Rolling a panel up to parents: sums, weighted rates, quality, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def summed(df: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """Rows without a key are left out; map-side combined."""
    return df.dropna(subset=keys).groupBy(keys).agg(F.sum(value).alias(value))


def clamped_weights(rates: DataFrame, weights: DataFrame, entity: str = "entity", period: str = "period", weight: str = "weight") -> DataFrame:
    """Rates with the weight of their period, or of the nearest period that has weights at all."""
    ends = weights.agg(F.min(period).alias("_first"), F.max(period).alias("_last"))
    clamped = rates.join(F.broadcast(ends)).withColumn("_at", F.least(F.greatest(F.col(period), F.col("_first")), F.col("_last")))
    return clamped.join(weights.select(entity, F.col(period).alias("_at"), weight), [entity, "_at"], "left").drop("_at", "_first", "_last")


def weighted_rate(df: DataFrame, keys: list[str], value: str = "value", weight: str = "weight", quality: str | None = None) -> DataFrame:
    """The weighted mean of each group, null without weight; any interpolated part marks the whole."""
    some = df.where(F.col(value).isNotNull() & F.col(weight).isNotNull())
    mean = (F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(weight), F.lit(0.0))).alias(value)
    more = [F.when(F.max(F.when(F.col(quality) == "interpolated", 1).otherwise(0)) == 1, "interpolated").otherwise(F.min(quality)).alias(quality)] if quality else []
    return some.groupBy(keys).agg(mean, *more)


def shares(df: DataFrame, within: list[str], value: str = "value") -> DataFrame:
    """share of its group's total; 0 where the total isn't positive."""
    total = F.sum(value).over(Window.partitionBy(*within))
    return df.withColumn("share", F.when(total > 0, F.col(value) / total).otherwise(0.0))


def share_statistics(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(keys).agg(F.avg("share").alias("share"), F.stddev_samp("share").alias("share_std"), F.count("share").alias("share_years"))


def normalised(df: DataFrame, within: list[str], share: str = "share") -> DataFrame:
    return df.withColumn(share, F.col(share) / F.nullif(F.sum(share).over(Window.partitionBy(*within)), F.lit(0.0)))


def trailing(df: DataFrame, years: int, within: list[str], period: str = "period") -> DataFrame:
    """The last ``years`` periods up to the latest of each group, or of all rows if ``within`` is empty."""
    if within:
        return df.withColumn("_last", F.max(period).over(Window.partitionBy(*within))).where(F.col(period) > F.col("_last") - years).drop("_last")
    last = df.agg(F.max(period).alias("_last"))
    return df.join(F.broadcast(last)).where(F.col(period) > F.col("_last") - years).drop("_last")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def weighted_mean(value: Column, weight: Column) -> Column:
    return F.sum(value * weight) / F.nullif(F.sum(weight), F.lit(0.0))


def only_children(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Parents with a single child."""
    return df.groupBy(parent).agg(F.countDistinct(child).alias("children"), F.min(child).alias("child")).where("children = 1").select(parent, "child")


def by_class(df: DataFrame, keys: list[str], is_rate: Column, first: list[str], value: str = "value") -> DataFrame:
    """One aggregate for all metrics: means of rates and sums of the others; of label columns the smallest."""
    mean, total = F.avg(value), F.sum(value)
    return df.groupBy(keys).agg(F.when(F.bool_and(is_rate), mean).otherwise(total).alias(value), *[F.min(c).alias(c) for c in first])
