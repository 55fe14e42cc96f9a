"""Data-quality checks: each gives a table of violations (check, severity, key, measured, threshold).

A violation is an issue or a warning; a gate fails on issues. Thresholds are parameters, since levels differ in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ISSUE, WARNING = "issue", "warning"


def violations(df: DataFrame, check: str, key: list[str], measured: Column, threshold: float | Column | None = None, severity: str = ISSUE) -> DataFrame:
    bar = threshold if isinstance(threshold, Column) else F.lit(threshold).cast("double")
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in key]) if key else F.lit("all")
    return df.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), name.alias("key"), measured.cast("double").alias("measured"), bar.cast("double").alias("threshold"))


def all_of(*checks: DataFrame) -> DataFrame:
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def gate(found: DataFrame) -> DataFrame:
    """issues, warnings and passed."""
    counted = found.agg(F.count_if(F.col("severity") == ISSUE).alias("issues"), F.count_if(F.col("severity") == WARNING).alias("warnings"))
    return counted.withColumn("passed", F.col("issues") == 0)


def coverage(df: DataFrame, expected: DataFrame, column: str = "metric") -> DataFrame:
    return violations(expected.join(df.select(column).distinct(), column, "left_anti"), "coverage", [column], F.lit(0))


def nulls(df: DataFrame, key: list[str], value: str = "value") -> DataFrame:
    return violations(df.where(F.col(value).isNull()).groupBy(key).count(), "nulls", key, F.col("count"), 0)


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    return violations(df.groupBy(key).count().where("count > 1"), "duplicates", key, F.col("count"), 1)


def negatives(df: DataFrame, key: list[str], value: str = "value") -> DataFrame:
    return violations(df.where(F.col(value) < 0), "negatives", key, F.col(value), 0)


def region_count(df: DataFrame, expected: int, entity: str = "entity", by: str = "metric") -> DataFrame:
    return violations(df.groupBy(by).agg(F.countDistinct(entity).alias("n")).where(F.col("n") != expected), "region_count", [by], F.col("n"), expected)


def reconciles(deviations: DataFrame, key: list[str], tolerance: float) -> DataFrame:
    return violations(deviations.where(F.col("deviation") > tolerance), "reconciles", key, F.col("deviation"), tolerance)


def constant_shares(df: DataFrame, key: list[str], tolerance: float = 1e-10) -> DataFrame:
    spread = df.groupBy(key).agg(F.stddev_samp("share").alias("s")).where(F.col("s") > tolerance)
    return violations(spread, "constant_shares", key, F.col("s"), tolerance)


def ratio_identity(df: DataFrame, key: list[str], stored: str, top: str, bottom: str, tolerance: float) -> DataFrame:
    error = F.abs(F.col(stored) - F.col(top) / F.nullif(F.col(bottom), F.lit(0.0))) / F.nullif(F.abs(stored), F.lit(0.0))
    return violations(df.withColumn("_e", error).where(F.col("_e") > tolerance), "ratio_identity", key, F.col("_e"), tolerance)


def bounds(df: DataFrame, key: list[str], low: float, high: float, value: str = "value", severity: str = ISSUE) -> DataFrame:
    over = F.col(value) > high
    return violations(df.where(over | (F.col(value) < low)), "bounds", key, F.col(value), F.when(over, F.lit(high)).otherwise(F.lit(low)), severity)


def part_of_whole(df: DataFrame, key: list[str], part: str, whole: str, low: float, high: float) -> DataFrame:
    share = F.col(part) / F.nullif(F.col(whole), F.lit(0.0))
    found = df.withColumn("_s", share)
    return all_of(violations(found.where(F.col(part) > F.col(whole)), "part_over_whole", key, F.col("_s"), 1.0), violations(found.where((F.col("_s") < low) | (F.col("_s") > high)), "part_of_whole", key, F.col("_s"), high, WARNING))


def continuity(df: DataFrame, series: list[str], down: float, up: float, value: str = "value", period: str = "period", data_type: str = "data_type") -> DataFrame:
    """The step from each series' last historical to its first forecast value."""
    past, ahead = F.col(data_type) == "historical", F.col(data_type) == "forecast"
    ends = df.groupBy(series).agg(F.max_by(value, F.when(past, F.col(period))).alias("a"), F.min_by(value, F.when(ahead, F.col(period))).alias("b"))
    jump = ends.withColumn("jump", F.col("b") / F.nullif(F.col("a"), F.lit(0.0)) - 1)
    return violations(jump.where((F.col("jump") > up) | (F.col("jump") < down)), "continuity", series, F.col("jump"), up)


def vintage_gap(df: DataFrame, series: list[str], period: str = "period", data_type: str = "data_type") -> DataFrame:
    ends = df.groupBy(series).agg(F.max(F.when(F.col(data_type) == "historical", F.col(period))).alias("a"), F.min(F.when(F.col(data_type) == "forecast", F.col(period))).alias("b"))
    return violations(ends.withColumn("gap", F.col("b") - F.col("a")).where("gap <> 1"), "vintage_gap", series, F.col("gap"), 1)


def interval_order(df: DataFrame, key: list[str], value: str = "value", low: str = "lo", high: str = "hi") -> DataFrame:
    wrong = (F.col(low) > F.col(high)) | (F.col(value) < F.col(low)) | (F.col(value) > F.col(high))
    return violations(df.where(wrong), "interval_order", key, F.col(value))


def interval_width(df: DataFrame, by: list[str], limit: float = 50.0, value: str = "value", low: str = "lo", high: str = "hi") -> DataFrame:
    """The 90th percentile of the widths, in percent of the value, where it is over the limit."""
    width = 100.0 * (F.col(high) - F.col(low)) / F.nullif(F.abs(value), F.lit(0.0))
    wide = df.withColumn("_w", width).groupBy(by).agg(F.percentile("_w", F.lit(0.9)).alias("p90")).where(F.col("p90") > limit)
    return violations(wide, "interval_width", by, F.col("p90"), limit, WARNING)


def yearly_change(df: DataFrame, series: list[str], low: float, high: float, value: str = "value", period: str = "period") -> DataFrame:
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(period))
    change = df.withColumn("_c", 100.0 * (F.col(value) / F.nullif(before, F.lit(0.0)) - 1))
    return violations(change.where((F.col("_c") < low) | (F.col("_c") > high)), "yearly_change", [*series, period], F.col("_c"), high, WARNING)


def year_gaps(gaps: DataFrame, series: list[str]) -> DataFrame:
    return violations(gaps, "year_gaps", series, F.col("missing"), 0)


def horizon(df: DataFrame, series: list[str], last: int, period: str = "period") -> DataFrame:
    return violations(df.groupBy(series).agg(F.max(period).alias("p")).where(F.col("p") < last), "horizon", series, F.col("p"), last)


def comovement(wide: DataFrame, by: list[str], a: str, b: str, least: float, rows: int = 5) -> DataFrame:
    found = wide.groupBy(by).agg(F.corr(a, b).alias("r"), F.count(F.lit(1)).alias("n")).where((F.col("n") > rows) & (F.col("r") < least))
    return violations(found, "comovement", by, F.col("r"), least, WARNING)


def growth_plausible(growth: DataFrame, key: list[str], low: float, high: float, column: str = "cagr") -> DataFrame:
    return violations(growth.where((100 * F.col(column) < low) | (100 * F.col(column) > high)), "growth_plausible", key, 100 * F.col(column), high, WARNING)


def caps_honoured(df: DataFrame, series: list[str], low: float, high: float, value: str = "adjusted", period: str = "period", slack: float = 0.001) -> DataFrame:
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(period))
    growth = df.withColumn("_g", F.col(value) / F.nullif(before, F.lit(0.0)) - 1)
    return violations(growth.where((F.col("_g") > high + slack) | (F.col("_g") < low - slack)), "caps_honoured", [*series, period], F.col("_g"), high)


def unmapped(df: DataFrame, dimension: DataFrame, code: str, name: str) -> DataFrame:
    """Codes that the dimension lacks, and names that differ from the dimension's."""
    there = dimension.select(F.col(code), F.col(name).alias("_name"))
    joined = df.select(code, name).distinct().join(there, code, "left")
    return all_of(violations(joined.where(F.col("_name").isNull()), "unmapped", [code], F.lit(0)), violations(joined.where(F.col("_name") != F.col(name)), "name_differs", [code], F.lit(1), severity=WARNING))


def method_share(df: DataFrame, method: str = "method") -> DataFrame:
    """n and share of each method."""
    return df.groupBy(method).agg(F.count(F.lit(1)).alias("n")).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1))))


def rate_against_count(wide: DataFrame, key: list[str], rate: str, part: str, whole: str, most: float = 30.0) -> DataFrame:
    """A rate in percent further than ``most`` points from part / whole."""
    gap = F.col(rate) - 100.0 * F.col(part) / F.nullif(F.col(whole), F.lit(0.0))
    return violations(wide.withColumn("_gap", gap).where(F.abs("_gap") > most), "rate_against_count", key, F.col("_gap"), most, WARNING)


def stored_against_computed(wide: DataFrame, stored: str, top: str, bottom: str, scale: float = 1.0, most: float = 1.0) -> DataFrame:
    """The largest deviation, in percent, of a stored ratio from its sides; one row if it passes ``most``."""
    computed = F.col(top) / F.nullif(F.col(bottom), F.lit(0.0)) * scale
    worst = wide.agg(F.max(F.abs(100.0 * (F.col(stored) - computed) / F.nullif(computed, F.lit(0.0)))).alias("_worst"))
    return violations(worst.where(F.col("_worst") > most), f"stored_{stored}", [], F.col("_worst"), most, WARNING)


def share_drift(wide: DataFrame, key: list[str], part: str, whole: str, most: float = 15.0, period: str = "period") -> DataFrame:
    """Series whose share, in percent, changes by more than ``most`` points from its first to its last period."""
    share = 100.0 * F.col(part) / F.nullif(F.col(whole), F.lit(0.0))
    ends = wide.withColumn("_s", share).groupBy(key).agg((F.max_by("_s", period) - F.min_by("_s", period)).alias("_drift"), F.count(F.lit(1)).alias("_n"))
    return violations(ends.where((F.col("_n") >= 2) & (F.abs("_drift") > most)), "share_drift", key, F.col("_drift"), most, WARNING)
