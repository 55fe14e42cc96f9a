"""The long panel (entity, metric, period, value) and its hygiene.

Every operator takes column names, keeps the panel distributed, and shuffles by series at most once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions.scalars import fiscal_year, to_number

SERIES = ["entity", "metric"]


def tidy(raw: DataFrame, code: list[str], period: list[str], value: list[str], constants: dict[str, str]) -> DataFrame:
    """entity, period, value and constant columns: each taken from the first candidate that the table has.

    Rows without a code, year or number go.
    """

    def pick(candidates: list[str]) -> Column:
        for c in candidates:
            if c in raw.columns:
                return F.col(c)
        raise ValueError(f"none of {candidates} in {raw.columns}")

    out = raw.select(pick(code).cast("string").alias("entity"), fiscal_year(pick(period)).alias("period"), to_number(pick(value)).alias("value"), *[F.lit(v).alias(k) for k, v in constants.items()])
    return out.dropna(subset=["entity", "period", "value"])


def plausible(df: DataFrame, rates: list[str], lowest: str = ">= 0", value: str = "value", metric: str = "metric") -> DataFrame:
    """Rows whose value is in range, rates being exempt; ``lowest`` is ">= 0" or "> 0" by level."""
    return df.where(F.col(metric).isin(*rates) | F.expr(f"`{value}` {lowest}"))


def recode(df: DataFrame, concordance: DataFrame, code: str, sums: list[str], keys: list[str]) -> DataFrame:
    """Old codes replaced by new ones (concordance: old, new) and values of equal keys summed."""
    mapped = df.join(concordance, F.col(code) == F.col("old"), "left").withColumn(code, F.coalesce("new", code))
    return mapped.groupBy(keys).agg(*[F.sum(c).alias(c) for c in sums])


def known_codes(df: DataFrame, codes: DataFrame, code: str) -> DataFrame:
    return df.join(codes.select(code).distinct(), code, "left_semi")


def canonical(df: DataFrame, names: DataFrame, code: str, name: str) -> DataFrame:
    """The rows whose code is in ``names`` (code, name), with its name there, or their own where it has none.

    Of several names of a code the smallest counts.
    """
    official = names.groupBy(code).agg(F.min(name).alias("_official"))
    return df.join(official, code).withColumn(name, F.coalesce("_official", name)).select(df.columns)


def match_rate(df: DataFrame, codes: DataFrame, code: str) -> DataFrame:
    """n, matched, rate of the rows whose code is known."""
    marked = df.join(codes.select(code).distinct().withColumn("_known", F.lit(1)), code, "left")
    return marked.agg(F.count(F.lit(1)).alias("n"), F.count("_known").alias("matched"), F.avg(F.when(F.col("_known").isNotNull(), 1.0).otherwise(0.0)).alias("rate"))


def filter_if_any(df: DataFrame, condition: Column) -> DataFrame:
    """The rows that meet the condition, or all of them if none does."""
    flag = df.agg(F.max(F.when(condition, 1).otherwise(0)).alias("_any"))
    return df.join(F.broadcast(flag)).where(condition | (F.col("_any") == 0)).drop("_any")


def winsorise(df: DataFrame, series: list[str], value: str = "value", k: float = 1.5, least: int = 5) -> DataFrame:
    """Values beyond Tukey's fences of their series moved onto them; short series stay."""
    fences = df.groupBy(series).agg(F.count(value).alias("_n"), F.percentile(value, F.lit(0.25)).alias("_q1"), F.percentile(value, F.lit(0.75)).alias("_q3"))
    spread = F.col("_q3") - F.col("_q1")
    moved = F.least(F.greatest(F.col(value), F.col("_q1") - k * spread), F.col("_q3") + k * spread)
    return df.join(fences, series).withColumn(value, F.when((F.col("_n") >= least) & (spread > 0), moved).otherwise(F.col(value))).drop("_n", "_q1", "_q3")


def ranked_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``, which should name every row."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def historical_wins(df: DataFrame, keys: list[str], tie: list[str], data_type: str = "data_type") -> DataFrame:
    """Of rows with equal keys: historical before forecast before derived before all else, then by ``tie``."""
    rank = F.when(F.col(data_type) == "historical", 0).when(F.col(data_type) == "forecast", 1).when(F.col(data_type) == "derived", 2).otherwise(3)
    return ranked_first(df, keys, [rank, *map(F.col, tie)])


def splice(old: DataFrame, new: DataFrame, from_period: int, period: str = "period") -> DataFrame:
    """``new`` from a period on, ``old`` before it."""
    return old.where(F.col(period) < from_period).unionByName(new.where(F.col(period) >= from_period), allowMissingColumns=True)


def replace_slice(df: DataFrame, new: DataFrame, metrics: list[str], metric: str = "metric") -> DataFrame:
    return df.where(~F.col(metric).isin(*metrics)).unionByName(new, allowMissingColumns=True)


def by_period(df: DataFrame, keys: list[str], periods: list[int], value: str = "value", period: str = "period") -> DataFrame:
    """A column y<period> for each listed period: the smallest value there."""
    return df.groupBy(keys).agg(*[F.min(F.when(F.col(period) == p, F.col(value))).alias(f"y{p}") for p in periods])


def by_metric(df: DataFrame, keys: list[str], metrics: list[str], columns: list[str], metric: str = "metric") -> DataFrame:
    """A column <metric>_<column> for each; one aggregate, no pivot pass."""
    return df.groupBy(keys).agg(*[F.max(F.when(F.col(metric) == m, F.col(c))).alias(f"{m}_{c}") for m in metrics for c in columns])


def by_metric_mean(df: DataFrame, keys: list[str], metrics: list[str], value: str = "value", metric: str = "metric") -> DataFrame:
    """A column for each metric; rows of the same key and metric are averaged."""
    return df.groupBy(keys).agg(*[F.avg(F.when(F.col(metric) == m, F.col(value))).alias(m) for m in metrics])



def unpivoted(df: DataFrame, keys: list[str], periods: list[int], value: str = "value", period: str = "period") -> DataFrame:
    """The inverse of ``by_period``; missing values give no rows."""
    out = df.unpivot(keys, [f"y{p}" for p in periods], period, value)
    return out.withColumn(period, F.substring(period, 2, 4).cast("int")).where(F.col(value).isNotNull())


def densified(df: DataFrame, series: list[str], period: str = "period") -> DataFrame:
    """A row for every period between a series' first and last; new rows hold nulls."""
    spans = df.groupBy(series).agg(F.explode(F.sequence(F.min(period), F.max(period))).alias(period))
    return spans.join(df, [*series, period], "left")


def interpolated(df: DataFrame, series: list[str], value: str = "value", period: str = "period") -> DataFrame:
    """Inner gaps filled on the straight line between their neighbours; data_quality says which rows are new."""
    back = Window.partitionBy(*series).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy(*series).orderBy(period).rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col(period))
    full = densified(df, series, period)
    full = full.select("*", F.last(value, True).over(back).alias("_v0"), F.last(at, True).over(back).alias("_p0"), F.first(value, True).over(ahead).alias("_v1"), F.first(at, True).over(ahead).alias("_p1"))
    line = F.col("_v0") + (F.col("_v1") - F.col("_v0")) * (F.col(period) - F.col("_p0")) / (F.col("_p1") - F.col("_p0"))
    quality = F.when(F.col(value).isNotNull(), "observed").when(line.isNotNull(), "interpolated")
    filled = F.when(F.col(value).isNotNull(), F.col(value)).when(F.col("_p1") > F.col("_p0"), line)
    return full.withColumn("data_quality", quality).withColumn(value, filled).drop("_v0", "_p0", "_v1", "_p1")


def filled_forward(df: DataFrame, series: list[str], period: str, value: str = "value") -> DataFrame:
    back = Window.partitionBy(*series).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.last(value, True).over(back))


def last_of(df: DataFrame, keys: list[str], unit: str, ts: str, value: str, tie: str) -> DataFrame:
    """The last value of each day, month, quarter or year; equal times go to the larger ``tie``."""
    return df.groupBy(*keys, F.date_trunc(unit, ts).alias("bucket")).agg(F.max_by(value, F.struct(ts, tie)).alias(value))
