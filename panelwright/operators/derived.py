"""Ratios of metrics with uncertainty, in closed form and by seeded simulation."""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose draws are made at once.
BLOCK_ROWS = 128


def ratio_with_bounds(df: DataFrame, name: str, top: str, bottom: str, scale: float = 1.0, missing_top: float = 0.05, missing_bottom: float = 0.02) -> DataFrame:
    """value, lo, hi and data_type of top / bottom from columns <metric>_value, _lo, _hi, _data_type.

    The bounds are crossed: lowest over highest and the reverse. Missing bounds count as the given part of the value.
    A ratio is a forecast if either side is; it is null unless the bottom is positive.
    """
    v, w = F.col(f"{top}_value") * scale, F.col(f"{bottom}_value")
    bound = lambda m, which, part, by: F.coalesce(F.col(f"{m}_{which}"), F.col(f"{m}_value") * (1 + (part if which == "hi" else -part))) * by
    low_high = F.when(bound(bottom, "hi", missing_bottom, 1) > 0, bound(top, "lo", missing_top, scale) / bound(bottom, "hi", missing_bottom, 1))
    high_low = F.when(bound(bottom, "lo", missing_bottom, 1) > 0, bound(top, "hi", missing_top, scale) / bound(bottom, "lo", missing_bottom, 1))
    kind = F.when((F.col(f"{top}_data_type") == "forecast") | (F.col(f"{bottom}_data_type") == "forecast"), "forecast").otherwise("historical")
    out = df.withColumn("value", F.when(w > 0, v / w)).withColumn("_a", low_high).withColumn("_b", high_low)
    return out.withColumn("lo", F.least("_a", "_b")).withColumn("hi", F.greatest("_a", "_b")).withColumn("data_type", kind).withColumn("metric", F.lit(name)).drop("_a", "_b")


def horizon_bounds(value: Column, horizon: Column, spread: float, growth: float = 0.0) -> tuple[Column, Column]:
    """Bounds at 1.96 times a part of the value that grows with the horizon."""
    width = 1.96 * spread * (1 + growth * horizon) * value
    return value - width, value + width


def delta_bounds(a: Column, sa: Column, b: Column, sb: Column, rho: float = 0.0) -> tuple[Column, Column]:
    """Bounds of a / b by the delta method, for sides with these deviations and this correlation; null where b is 0."""
    by = F.nullif(b, F.lit(0.0))
    r = a / by
    variance = F.pow(sa / by, F.lit(2.0)) + F.pow(r * sb / by, F.lit(2.0)) - 2 * rho * sa * sb * r / (by * by)
    width = 1.96 * F.sqrt(F.greatest(variance, F.lit(0.0)))
    return r - width, r + width


def ordered_bounds(df: DataFrame, low: str = "lo", high: str = "hi") -> DataFrame:
    return df.withColumn("_l", F.least(low, high)).withColumn(high, F.greatest(low, high)).withColumn(low, F.col("_l")).drop("_l")


def with_width(df: DataFrame, low: str = "lo", high: str = "hi") -> DataFrame:
    return df.withColumn("ci_width", F.col(high) - F.col(low))


def rescaled_bounds(df: DataFrame, old: str, new: str, low: str = "lo", high: str = "hi") -> DataFrame:
    """Bounds moved along with a recomputed value."""
    by = F.col(new) / F.nullif(F.col(old), F.lit(0.0))
    return df.withColumn(low, F.col(low) * by).withColumn(high, F.col(high) * by)


def asymmetric(df: DataFrame, limit: float = 0.1, value: str = "value", low: str = "lo", high: str = "hi") -> DataFrame:
    """Rows whose two half-widths differ by more than a part of the larger one."""
    up, down = F.col(high) - F.col(value), F.col(value) - F.col(low)
    return df.withColumn("asymmetry", F.abs(up - down) / F.nullif(F.greatest(up, down), F.lit(0.0))).where(F.col("asymmetry") > limit)


def point_with_bounds(df: DataFrame, top: str, bottom: str, scale: float = 1.0, known: float = 0.02) -> DataFrame:
    """value, lo, hi of top / bottom, from columns <metric>_value, _lo and _hi: the point is exact, only bounds are modelled.

    A side without bounds is history: both sides so, and the ratio has none; one, and it counts with a deviation of the
    ``known`` part of its value. Bounds follow from the sides' deviations by the delta method and don't go below 0.
    """

    def deviation(m: str) -> Column:
        v, lo, hi = (F.col(f"{m}_{x}") for x in ("value", "lo", "hi"))
        return F.greatest(F.when(lo.isNotNull() & hi.isNotNull(), (hi - lo) / (2 * 1.96)).otherwise(F.abs(v) * known), F.lit(1e-10))

    a, b = F.col(f"{top}_value"), F.col(f"{bottom}_value")
    past = lambda m: F.col(f"{m}_lo").isNull() | F.col(f"{m}_hi").isNull()
    low, high = delta_bounds(a, deviation(top), b, deviation(bottom))
    modelled = ~(past(top) & past(bottom)) & (b > 0)
    bound = lambda c: F.when(modelled, F.greatest(c * scale, F.lit(0.0)))
    return df.withColumn("value", F.when(b > 0, F.greatest(a / F.nullif(b, F.lit(0.0)) * scale, F.lit(0.0))).otherwise(0.0)).withColumn("lo", bound(low)).withColumn("hi", bound(high))


def identity_repaired(df: DataFrame, nominal: str, real: str, deflator: str, tolerance: float = 0.01) -> DataFrame:
    """deviation of nominal from real * deflator / 100, violated where it passes the tolerance; there the deflator is set right."""
    gap = F.when(F.col(nominal) > 0, F.abs(F.col(nominal) - F.col(real) * F.col(deflator) / 100.0) / F.col(nominal)).otherwise(0.0)
    out = df.withColumn("deviation", gap).withColumn("violated", F.coalesce(F.col("deviation") > tolerance, F.lit(False)))
    return out.withColumn(deflator, F.when(F.col("violated") & (F.col(real) != 0), F.col(nominal) / F.col(real) * 100.0).otherwise(F.col(deflator)))



def simulated_ratio(df: DataFrame, keys: list[str], draws: int = 5000, rho: float = 0.0, trim: float | None = 5.0, seed: int = 42, scale: float = 1.0) -> DataFrame:
    """mc_value, mc_lo, mc_hi of a ratio whose sides are normal, correlated by ``rho``; columns a, sa, b, sb.

    The draws of a row depend on the seed and its keys alone, not on partitions. Draws beyond ``trim`` deviations of
    the ratio, and those with a side that isn't positive, are left out; bounds are the 2.5 and 97.5 percentiles.
    """
    marked = df.withColumn("_seed", F.xxhash64(*keys, F.lit(seed)))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema), "mc_value double", "mc_lo double", "mc_hi double"])

    def block(a: np.ndarray, sa: np.ndarray, b: np.ndarray, sb: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """A row of the three results for each input row; the draws of all rows are one array."""
        x, y = (np.empty((len(a), draws)) for _ in range(2))
        for i, key in enumerate(keys):
            r = np.random.default_rng(int(key) & (1 << 63) - 1)
            x[i], y[i] = r.standard_normal(draws), r.standard_normal(draws)
        a, sa, b, sb = (v[:, None] for v in (a, sa, b, sb))
        tops, bottoms = a + sa * x, b + sb * (rho * x + np.sqrt(1 - rho * rho) * y)
        ratio = np.full(x.shape, np.nan)
        np.divide(tops * scale, bottoms, out=ratio, where=(tops > 0) & (bottoms > 0))
        with warnings.catch_warnings():
            warnings.simplefilter("ignore", RuntimeWarning)  # rows without a draw
            if trim is not None:
                off = np.abs(ratio - np.nanmean(ratio, axis=1, keepdims=True))
                ratio[off > trim * np.maximum(np.nanstd(ratio, axis=1, keepdims=True), 1e-300)] = np.nan
            out = np.column_stack([np.nanmean(ratio, axis=1), *np.nanpercentile(ratio, [2.5, 97.5], axis=1)])
            few = np.isfinite(ratio).sum(axis=1) < draws // 10
            out[few] = np.column_stack([(a / b * scale)[few, 0], np.full((few.sum(), 2), np.nan)])
        out[~(b[:, 0] > 0) | np.isnan(a[:, 0])] = np.nan
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for first in range(0, len(batch), BLOCK_ROWS):
                part = batch.iloc[first : first + BLOCK_ROWS]
                sides = [part[c].to_numpy(float) for c in ("a", "sa", "b", "sb")]
                values = pd.DataFrame(block(*sides, part["_seed"].to_numpy()), columns=["mc_value", "mc_lo", "mc_hi"], index=part.index)
                yield pd.concat([part.drop(columns="_seed"), values], axis=1)

    return marked.mapInPandas(run, schema)


def _quantile(ordered: Column, p: float) -> Column:
    """The p-quantile of a sorted array, linear between its values; null for an empty one."""
    at = (F.size(ordered) - 1) * F.lit(p)
    low = F.floor(at).cast("int")
    a, b = F.get(ordered, low), F.get(ordered, F.least(low + 1, F.size(ordered) - 1))
    return F.when(F.size(ordered) > 0, a + (b - a) * (at - low))


def drawn_ratio(df: DataFrame, keys: list[str], draws: int = 1000, rho: float = 0.0, trim: float = 5.0, seed: int = 42, scale: float = 1.0) -> DataFrame:
    """``simulated_ratio`` by expressions alone, from draws that any engine can repeat; within each row, without a shuffle.

    Draw i of a row comes from the MD5 of its keys, the seed and i: 52 bits each for two uniforms, which Box and Muller's
    transform makes normal. Draws with a side that isn't positive, and those beyond ``trim`` deviations, are left out; with
    less than a tenth of the draws left the value is the plain ratio, without bounds. A null side, or a bottom that isn't
    positive, gives nulls.
    """

    def uniform(i: Column, which: int) -> Column:
        text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys], F.lit(str(seed)), i.cast("string"), F.lit(str(which)))
        return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)

    def draw(i: Column) -> Column:
        def sides(n: Column) -> Column:
            x, y = n["r"] * F.cos(n["t"]), n["r"] * F.sin(n["t"])
            top, bottom = F.col("a") + F.col("sa") * x, F.col("b") + F.col("sb") * (rho * x + (1 - rho * rho) ** 0.5 * y)
            return F.transform(F.array(F.struct(top.alias("top"), bottom.alias("bottom"))), lambda z: F.when((z["top"] > 0) & (z["bottom"] > 0), z["top"] * scale / z["bottom"]))[0]

        n = F.struct(F.sqrt(-2 * F.log(uniform(i, 1))).alias("r"), (2 * math.pi * uniform(i, 2)).alias("t"))
        return F.transform(F.array(n), sides)[0]

    def once(value: Column, body) -> Column:
        """body(value), with value worked out once."""
        return F.transform(F.array(value), body)[0]

    def mean(values: Column, term=lambda v: v) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + term(v)) / F.nullif(F.size(values), F.lit(0))

    def near(d: Column) -> Column:
        deviation = lambda m: F.sqrt(mean(d, lambda v: (v - m) * (v - m)))
        return once(mean(d), lambda m: once(deviation(m), lambda s: F.array_sort(F.filter(d, lambda v: F.abs(v - m) <= trim * F.greatest(s, F.lit(1e-300))))))

    fine = F.col("a").isNotNull() & (F.col("b") > 0) & F.col("sa").isNotNull() & F.col("sb").isNotNull()
    plain = F.col("a") / F.nullif(F.col("b"), F.lit(0.0)) * scale

    def result(d: Column) -> Column:
        enough = F.size(d) >= draws // 10
        return F.struct(F.when(enough, mean(d)).otherwise(plain).alias("mc_value"), F.when(enough, _quantile(d, 0.025)).alias("mc_lo"), F.when(enough, _quantile(d, 0.975)).alias("mc_hi"))

    drawn = F.filter(F.transform(F.sequence(F.lit(1), F.lit(draws)), draw), lambda v: v.isNotNull())
    out = df.withColumn("_z", F.explode(F.array(F.when(fine, once(once(drawn, near), result)))))  # a row each, worked out once
    return out.select(*df.columns, "_z.*")


def magnitude_rescaled(value: Column, below: float, by: float) -> Column:
    """A value that is positive but below what its unit allows was given in a larger unit, and is brought to the smaller one."""
    return F.when((value > 0) & (value < below), value * by).otherwise(value)


def unit_checked(value: Column, most: float = 1e7) -> Column:
    """``value``, or an error that stops the run if its size shows a wrong unit."""
    return F.when(F.abs(value) < most, value).when(value.isNull(), value).otherwise(F.raise_error(F.concat(F.lit("a ratio's unit is wrong: "), value.cast("string"))).cast("double"))
