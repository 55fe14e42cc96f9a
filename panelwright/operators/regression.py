"""Least squares with several regressors, and prefix fits, from sums that Spark merges; no Python in tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A pivot below this part of its diagonal makes a system singular.
TOLERANCE = 1e-10


def gram(df: DataFrame, keys: list[str], regressors: dict[str, Column], y: Column) -> DataFrame:
    """keys, n, xtx (the upper triangle's sums, row by row), xty, yty of the rows that have y and all regressors.

    Such rows of sums can be added up, so that parts of a table can be summed apart (``merged``).
    """
    names = list(regressors)
    whole = y.isNotNull()
    for x in regressors.values():
        whole = whole & x.isNotNull()
    rows = df.where(whole).select(*keys, y.cast("double").alias("_y"), *[x.cast("double").alias(f"_x{i}") for i, x in enumerate(regressors.values())])
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = [F.sum(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"_s{i}_{j}") for i, j in pairs] + [F.sum(F.col(f"_x{i}") * F.col("_y")).alias(f"_t{i}") for i in range(len(names))]
    grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("_y") * F.col("_y")).alias("yty"), *sums)
    return grouped.select(*keys, "n", F.array(*[f"_s{i}_{j}" for i, j in pairs]).alias("xtx"), F.array(*[f"_t{i}" for i in range(len(names))]).alias("xty"), "yty")


def merged(sums: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The sums of several parts added up; k is the number of regressors."""
    pairs = k * (k + 1) // 2
    out = sums.groupBy(*keys).agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("xtx")[i]) for i in range(pairs)]).alias("xtx"), F.array(*[F.sum(F.col("xty")[i]) for i in range(k)]).alias("xty"), F.sum("yty").alias("yty"))
    return out.select(*keys, "n", "xtx", "xty", "yty")


def _sum(n: Column, term) -> Column:
    """The sum of term(i) for i from 0 to n - 1."""
    return F.when(n > 0, F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda acc, i: acc + term(i))).otherwise(F.lit(0.0))


def solved(xtx: Column, xty: Column, k: int) -> Column:
    """The k coefficients, by Cholesky's factors of the normal equations; an array of nulls where they are singular."""
    none = F.array().cast("array<double>")

    def entry(i: Column, j: Column) -> Column:
        return F.get(xtx, (i * (2 * k - i + 1) / 2).cast("int") + j - i)  # upper triangle, i <= j

    def factor(low: Column, at: Column) -> Column:
        """Entry ``at`` of the lower factor, row by row, from those before it."""
        i, j = (at / k).cast("int"), at % k
        rest = entry(F.least(i, j), F.greatest(i, j)) - _sum(j, lambda m: F.get(low, i * k + m) * F.get(low, j * k + m))
        pivot = F.when(rest > TOLERANCE * entry(i, i), F.sqrt(rest))
        return F.when(j > i, F.lit(0.0)).when(i == j, pivot).otherwise(rest / F.get(low, j * k + j))

    def over(low: Column) -> Column:
        forward = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), none, lambda z, i: F.concat(z, F.array((F.get(xty, i) - _sum(i, lambda m: F.get(low, i * k + m) * F.get(z, m))) / F.get(low, i * k + i))))
        return F.transform(F.array(forward), lambda z: back(low, z))[0]

    def back(low: Column, z: Column) -> Column:
        """From the last coefficient to the first; found ones stand in front, so that coefficient i is at i - place - 1."""

        def one(found: Column, step: Column) -> Column:
            i = F.lit(k - 1) - step
            known = _sum(step, lambda m: F.get(low, (i + 1 + m) * k + i) * F.get(found, m))
            return F.concat(F.array((F.get(z, i) - known) / F.get(low, i * k + i)), found)

        return F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), none, one)

    lower = F.aggregate(F.sequence(F.lit(0), F.lit(k * k - 1)), none, lambda acc, at: F.concat(acc, F.array(factor(acc, at))))
    return F.transform(F.array(lower), over)[0]


def fitted(df: DataFrame, keys: list[str], regressors: dict[str, Column], y: Column) -> DataFrame:
    """keys, n, a coefficient for each regressor under its name, and sigma, the residuals' deviation (null without freedom)."""
    names, k = list(regressors), len(regressors)
    sums = gram(df, keys, regressors, y).withColumn("_b", solved(F.col("xtx"), F.col("xty"), k))
    explained = _sum(F.lit(k), lambda i: F.get(F.col("_b"), i) * F.get(F.col("xty"), i))
    sigma = F.when(F.col("n") > k, F.sqrt(F.greatest(F.col("yty") - explained, F.lit(0.0)) / (F.col("n") - k)))
    return sums.select(*keys, "n", *[F.get(F.col("_b"), i).alias(name) for i, name in enumerate(names)], sigma.alias("sigma"))


def breaks(t: Column, level: dict[str, float], ramp: dict[str, float]) -> dict[str, Column]:
    """Regressors of structural breaks: 1 from a level break on, and the time since a change of slope."""
    steps = {name: F.when(t >= at, 1.0).otherwise(0.0) for name, at in level.items()}
    return steps | {name: F.greatest(t - at, F.lit(0.0)) for name, at in ramp.items()}


def extended(fits: DataFrame, future: DataFrame, keys: list[str], regressors: dict[str, Column]) -> DataFrame:
    """``future`` (keys and what the regressors are made of) with value, the fitted model carried on."""
    total = None
    for name, x in regressors.items():
        part = F.col(f"_f_{name}") * x
        total = part if total is None else total + part
    renamed = fits.select(*keys, *[F.col(name).alias(f"_f_{name}") for name in regressors])
    return future.join(renamed, keys).withColumn("value", total).drop(*[f"_f_{name}" for name in regressors])


def expanding_errors(df: DataFrame, series: list[str], least: int, value: str = "value", period: str = "period") -> DataFrame:
    """Every fold's one-step errors: series, period, linear, flat, growth; from the row after the first ``least`` rows on.

    The models are a line through the rows before, the last of them, and the last grown by the mean growth so far. Running
    sums give the line of every prefix, so that all folds of all series take one pass of one window. Errors are
    |e| / (|forecast| + |actual|), null where a model has no forecast.
    """
    w = Window.partitionBy(*series).orderBy(period)
    past = w.rowsBetween(Window.unboundedPreceding, -1)
    x, v = F.col("_x"), F.col("_y")
    last, before = F.lag(v).over(w), F.lag(v).over(w)
    rows = df.withColumn("_x", (F.row_number().over(w) - 1).cast("double")).withColumn("_y", F.col(value).cast("double"))
    rows = rows.withColumn("_g", F.when(before > 0, v / before - 1)).withColumn("_last", last)
    n, sx, sy, sxx, sxy = (F.sum(c).over(past) for c in (F.lit(1.0), x, v, x * x, x * v))
    rows = rows.select(*series, period, "_x", "_y", "_last", n.alias("_n"), sx.alias("_sx"), sy.alias("_sy"), sxx.alias("_sxx"), sxy.alias("_sxy"), F.avg("_g").over(past).alias("_mean"))
    slope = (F.col("_n") * F.col("_sxy") - F.col("_sx") * F.col("_sy")) / F.nullif(F.col("_n") * F.col("_sxx") - F.col("_sx") * F.col("_sx"), F.lit(0.0))
    forecasts = {"linear": (F.col("_sy") - slope * F.col("_sx")) / F.col("_n") + slope * x, "flat": F.col("_last"), "growth": F.col("_last") * (1 + F.col("_mean"))}
    error = lambda f: F.abs(f - v) / F.nullif(F.abs(f) + F.abs(v), F.lit(0.0))
    return rows.where(F.col("_n") >= least).select(*series, period, *[error(f).alias(name) for name, f in forecasts.items()])


def inverse_error_weights(errors: DataFrame, series: list[str], models: list[str], floor: float = 1e-6) -> DataFrame:
    """series, folds, and each model's weight: inverse mean errors, adding up to 1; errors count from ``floor`` on."""
    means = errors.groupBy(*series).agg(F.count(F.lit(1)).alias("folds"), *[(1 / F.greatest(F.avg(m), F.lit(floor))).alias(f"_{m}") for m in models])
    total = sum((F.coalesce(f"_{m}", F.lit(0.0)) for m in models[1:]), F.coalesce(f"_{models[0]}", F.lit(0.0)))
    return means.select(*series, "folds", *[(F.coalesce(f"_{m}", F.lit(0.0)) / F.nullif(total, F.lit(0.0))).alias(m) for m in models])
