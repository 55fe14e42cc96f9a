"""Series of mixed frequencies on one calendar of months.

Months are counted from year 0: year * 12 + month - 1. Frequencies are A, Q, M, M3 (three months, named by the last) and D.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.panel import densified, filled_forward, interpolated

#: Months of a period, by frequency.
MONTHS = {"A": 12, "Q": 3}


def month_of(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def month_start(month: Column) -> Column:
    return F.make_date(F.floor(month / 12).cast("int"), (month % 12 + 1).cast("int"), F.lit(1))


def last_in_month(df: DataFrame, series: list[str], day: str, value: str = "value") -> DataFrame:
    """series, month, value: the value of each month's last day that has one; of equal days the largest value."""
    some = df.where(F.col(value).isNotNull())
    return some.groupBy(*series, month_of(F.col(day)).alias("month")).agg(F.max(F.struct(day, value)).alias("_l")).select(*series, "month", F.col(f"_l.{value}").alias(value))


def carried(df: DataFrame, series: list[str], most: int, value: str = "value", month: str = "month") -> DataFrame:
    """A row for every month between a series' first and last; a value is carried for ``most`` months and no further."""
    full = densified(df, series, month)
    observed = full.withColumn("data_quality", F.when(F.col(value).isNotNull(), "observed"))
    at = F.when(F.col(value).isNotNull(), F.col(month))
    filled = filled_forward(filled_forward(observed.withColumn("_at", at), series, month, "_at"), series, month, value)
    near = F.col(month) - F.col("_at") <= most
    return filled.withColumn(value, F.when(near, F.col(value))).withColumn("data_quality", F.coalesce("data_quality", F.when(near, "carried"))).drop("_at")


def level_months(df: DataFrame, series: list[str], value: str = "value", month: str = "month") -> DataFrame:
    """Months between observations of a level, on the straight line between them."""
    return interpolated(df, series, value, month)


def spread_over_months(df: DataFrame, series: list[str], freq: str, period: str = "period", value: str = "value") -> DataFrame:
    """series, month, value: totals of years (A) or quarters (Q) as months that add up to them.

    period counts years, or quarters (year * 4 + quarter - 1). The months of a period lie on lines from its mean to those of
    the periods next to it, shifted so that they add up; where a neighbour is missing the line is flat.
    """
    n = MONTHS[freq]
    w = Window.partitionBy(*series).orderBy(period)
    beside = lambda f: F.when(F.abs(f(period).over(w) - F.col(period)) == 1, f(value).over(w) / n)
    mean = F.col(value) / n
    rows = df.withColumn("_mean", mean).withColumn("_up", F.coalesce(beside(F.lead) - mean, F.lit(0.0))).withColumn("_down", F.coalesce(mean - beside(F.lag), F.lit(0.0)))
    offsets = [(j - (n - 1) / 2) / n for j in range(n)]
    half = sum(d for d in offsets if d > 0)
    shift = -half * (F.col("_up") - F.col("_down")) / n
    months = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(d).alias("d")) for j, d in enumerate(offsets)])).alias("_m")
    out = rows.select(*series, (F.col(period) * n).alias("_first"), "_mean", "_up", "_down", shift.alias("_shift"), months)
    slope = F.when(F.col("_m.d") > 0, F.col("_up")).otherwise(F.col("_down"))
    return out.select(*series, (F.col("_first") + F.col("_m.j")).alias("month"), (F.col("_mean") + slope * F.col("_m.d") + F.col("_shift")).alias(value))


def on_months(parts: dict[str, DataFrame], series: list[str]) -> DataFrame:
    """series, freq, month, value, data_quality: parts of each frequency, already on months, under one another."""
    out = None
    for freq, df in parts.items():
        rows = df if "data_quality" in df.columns else df.withColumn("data_quality", F.lit("observed"))
        rows = rows.select(*series, F.lit(freq).alias("freq"), "month", "value", "data_quality")
        out = rows if out is None else out.unionByName(rows)
    return out
