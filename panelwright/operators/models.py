"""Models of single series and of an entity's series together: smoothing, autoregression, vectors with error correction.

Each fit is a small numpy helper over one series; Spark deals out series, models and folds, and does what combines them.
Draws are seeded by the series' key.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_SCHEMA = "entity string, metric string, period int, value double, lo double, hi double, model string, aicc double"


def _aicc(sse: float, n: int, k: int) -> float:
    return n * np.log(max(sse, 1e-12) / n) + 2 * k + 2 * k * (k + 1) / max(n - k - 1, 1)


def _nothing() -> pd.DataFrame:
    """No forecasts, of the right types."""
    kinds = {"entity": object, "metric": object, "period": "int32", "model": object}
    return pd.DataFrame({c: pd.Series(dtype=kinds.get(c, "float64")) for c in ("entity", "metric", "period", "value", "lo", "hi", "model", "aicc")})


def holt(y: np.ndarray, horizon: int) -> tuple[np.ndarray, float, float]:
    """Forecast, residual deviation and AICc of the best of a grid: level and trend weights, damping, additive or not."""
    best = None
    for damping in (1.0, 0.9, 0.8):
        for alpha in (0.1, 0.3, 0.5, 0.7, 0.9):
            for beta in (0.0, 0.1, 0.3, 0.5):
                level, trend, errors = y[0], y[1] - y[0] if beta else 0.0, []
                for x in y[1:]:
                    guess = level + damping * trend
                    errors.append(x - guess)
                    new = guess + alpha * (x - guess)
                    trend = damping * trend + beta * (new - level - damping * trend) if beta else 0.0
                    level = new
                sse = float(np.square(errors).sum())
                score = _aicc(sse, len(errors), 2 + (beta > 0) + (damping < 1))
                if best is None or score < best[0]:
                    best = (score, level, trend, damping, np.sqrt(sse / max(len(errors) - 2, 1)))
    score, level, trend, damping, sigma = best
    steps = np.cumsum(damping ** np.arange(1, horizon + 1))
    return level + trend * steps, sigma, score


def _lagged(y: np.ndarray, p: int) -> np.ndarray:
    return np.column_stack([np.ones(len(y) - p), *[y[p - i : len(y) - i] for i in range(1, p + 1)]])


def unit_root(y: np.ndarray) -> bool:
    """Dickey-Fuller with a constant at 5%: MacKinnon's response surface for the critical value."""
    d = np.diff(y)
    x = np.column_stack([np.ones(len(d)), y[:-1]])
    coefficients, *_ = np.linalg.lstsq(x, d, rcond=None)
    s2 = np.square(d - x @ coefficients).sum() / max(len(d) - 2, 1)
    se = np.sqrt(s2 * np.linalg.pinv(x.T @ x)[1, 1])
    n = len(d)
    return bool(se <= 0 or coefficients[1] / se > -2.8621 - 2.738 / n - 8.36 / n**2)


def arima(y: np.ndarray, horizon: int, largest: int = 2) -> tuple[np.ndarray, float, float]:
    """Difference if a unit root isn't rejected; orders p, q up to ``largest`` by AICc, fitted by Hannan-Rissanen."""
    d = int(unit_root(y))
    z = np.diff(y) if d else y
    long = min(max(largest + 1, 3), max(1, len(z) // 4))
    x = _lagged(z, long)
    first, *_ = np.linalg.lstsq(x, z[long:], rcond=None)
    shocks = np.concatenate([np.zeros(long), z[long:] - x @ first])
    best = None
    for p in range(largest + 1):
        for q in range(largest + 1):
            start = long + max(p, q)
            if len(z) - start < p + q + 4:
                continue
            x = np.column_stack([np.ones(len(z) - start), *[z[start - i : len(z) - i] for i in range(1, p + 1)], *[shocks[start - j : len(z) - j] for j in range(1, q + 1)]])
            coefficients, *_ = np.linalg.lstsq(x, z[start:], rcond=None)
            sse = float(np.square(z[start:] - x @ coefficients).sum())
            score = _aicc(sse, len(z) - start, 1 + p + q)
            if best is None or score < best[0]:
                best = (score, p, q, coefficients, np.sqrt(sse / max(len(z) - start - 1 - p - q, 1)))
    if best is None:
        return np.full(horizon, y[-1]), float(np.std(np.diff(y), ddof=1)) if len(y) > 2 else 0.0, np.inf
    score, p, q, coefficients, sigma = best
    past, errors = list(z), list(shocks)
    for _ in range(horizon):
        past.append(coefficients[0] + sum(coefficients[i] * past[-i] for i in range(1, p + 1)) + sum(coefficients[p + j] * errors[-j] for j in range(1, q + 1)))
        errors.append(0.0)
    ahead = np.array(past[len(z) :])
    return y[-1] + np.cumsum(ahead) if d else ahead, sigma, score


def trend(y: np.ndarray, horizon: int) -> tuple[np.ndarray, float, float]:
    x = np.arange(len(y))
    slope, intercept = np.polyfit(x, y, 1)
    errors = y - intercept - slope * x
    sse = float(np.square(errors).sum())
    return intercept + slope * (len(y) - 1 + np.arange(1, horizon + 1)), np.sqrt(sse / max(len(y) - 2, 1)), _aicc(sse, len(y), 2)


MODELS = {"arima": arima, "holt": holt, "linear": trend}


#: One-step forecasts at a series' end that weights are found from, and the fewest values that one is fitted to.
FOLDS, LEAST_FIT = 4, 5


def _fitted(model: pd.Series, z: pd.Series, cut: pd.Series, horizon: pd.Series) -> pd.DataFrame:
    """The forecast, deviation and AICc of each row's model, fitted to the first ``cut`` values."""
    found = [MODELS[m](np.asarray(v[:c], float), h) for m, v, c, h in zip(model, z, cut, horizon, strict=True)]
    return pd.DataFrame({"ahead": [f[0].tolist() for f in found], "sigma": [float(f[1]) for f in found], "aicc": [float(f[2]) for f in found]})


def ensemble(df: DataFrame, horizon: int = 5, least: int = 6) -> DataFrame:
    """entity, metric, period, value, lo, hi, model, aicc: models weighted by their inverse cross-validated error.

    Each series, model and fold is a row that is fitted by itself; Spark's grouping finds the errors, the weights and the
    combined path. Positive series are fitted in logarithms. Bounds come from the cross-validation errors, or from the
    fits' own deviations where those are few. Series shorter than ``least`` give no rows.
    """
    keys = ["entity", "metric"]
    ordered = F.array_sort(F.collect_list(F.struct("period", "value")))
    series = df.where(F.col("value").isNotNull()).groupBy(keys).agg(ordered.alias("s")).withColumn("n", F.size("s")).where(F.col("n") >= least)
    series = series.withColumn("y", F.transform("s", lambda x: x["value"])).withColumn("is_log", F.forall("y", lambda v: v > 0))
    series = series.select(*keys, "n", "is_log", F.element_at("s", -1)["period"].alias("last"), F.when(F.col("is_log"), F.transform("y", lambda v: F.log(v))).otherwise(F.col("y")).alias("z"))
    models = F.explode(F.array(*map(F.lit, MODELS))).alias("model")
    cuts = F.explode(F.sequence(F.greatest(F.lit(LEAST_FIT), F.col("n") - FOLDS), F.col("n"))).alias("cut")
    tasks = series.select("*", models).select("*", cuts).withColumn("whole", F.col("cut") == F.col("n"))
    fitted = F.pandas_udf(_fitted, "ahead array<double>, sigma double, aicc double")
    # dealt out anew: a series' fits needn't follow one another in one task
    tasks = tasks.repartition(*keys, "model", "cut").withColumn("fit", fitted("model", "z", "cut", F.when(F.col("whole"), horizon).otherwise(1)))
    actual, ahead = F.get("z", F.col("cut")), F.get("fit.ahead", F.lit(0))
    tasks = tasks.withColumn("error", F.when(~F.col("whole"), actual - ahead))
    score = F.abs("error") / F.greatest(F.abs(ahead) + F.abs(actual), F.lit(1e-12))
    final = F.max(F.when(F.col("whole"), F.col("fit"))).alias("fit")
    by_model = tasks.groupBy(*keys, "is_log", "last", "model").agg(
        F.avg(score).alias("score"), final, F.count("error").alias("errors"), F.sum("error").alias("e1"), F.sum(F.col("error") * F.col("error")).alias("e2")
    )
    raw = 1 / F.greatest(F.coalesce("score", F.lit(1.0)), F.lit(1e-6))
    by_model = by_model.withColumn("raw", raw).withColumn("weight", F.col("raw") / F.sum("raw").over(Window.partitionBy(*keys)))
    n, mean = F.sum("errors"), F.sum("e1") / F.sum("errors")
    spread = F.sqrt(F.greatest(F.sum("e2") - n * mean * mean, F.lit(0.0)) / (n - 1))
    whole = by_model.groupBy(*keys, "is_log", "last").agg(
        F.when(n > 5, spread).otherwise(F.sum(F.col("weight") * F.col("fit.sigma"))).alias("sigma"), F.min("fit.aicc").alias("aicc"),
        *[F.sum(F.col("weight") * F.get("fit.ahead", F.lit(h))).alias(f"h{h}") for h in range(horizon)],
    )
    paths = whole.select(*keys, "is_log", "last", "sigma", "aicc", F.posexplode(F.array(*[f"h{h}" for h in range(horizon)])).alias("h", "centre"))
    width = 1.96 * F.col("sigma") * F.sqrt(F.col("h") + 1)
    back = lambda c: F.when(F.col("is_log"), F.exp(c)).otherwise(c)
    centre = F.col("centre")
    return paths.select(
        *keys, (F.col("last") + F.col("h") + 1).cast("int").alias("period"), back(centre).alias("value"), back(centre - width).alias("lo"), back(centre + width).alias("hi"), F.lit(f"ensemble({len(MODELS)})").alias("model"), "aicc"
    )


def cointegration(y: np.ndarray, lags: int = 1) -> tuple[int, np.ndarray]:
    """How many cointegrating relations there are, by the trace test with a constant at 5% (published points for up to
    four series), and the relations as columns, strongest first."""
    points = (3.8415, 15.4943, 29.7961, 47.8545)
    d = np.diff(y, axis=0)
    x = np.column_stack([np.ones(len(d) - lags), *[d[lags - i : len(d) - i] for i in range(1, lags + 1)]])
    project = lambda a: a - x @ np.linalg.lstsq(x, a, rcond=None)[0]
    r0, r1 = project(d[lags:]), project(y[lags:-1])
    n, k = len(r0), y.shape[1]
    s00, s11, s01 = r0.T @ r0 / n, r1.T @ r1 / n, r0.T @ r1 / n
    roots, vectors = np.linalg.eig(np.linalg.pinv(s11) @ s01.T @ np.linalg.pinv(s00) @ s01)
    order = np.argsort(-roots.real, kind="stable")
    roots, vectors = np.clip(roots.real[order], 0, 1 - 1e-12), vectors.real[:, order]
    for rank in range(k):
        if -n * np.log(1 - roots[rank:]).sum() < points[min(k - rank, len(points)) - 1]:
            return rank, vectors
    return k, vectors


def johansen_rank(y: np.ndarray, lags: int = 1) -> int:
    return cointegration(y, lags)[0]


def error_correction(y: np.ndarray, horizon: int, rank: int, relations: np.ndarray, draws: int = 200, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forecast and bounds of a vector error-correction model with one lagged difference.

    The steps are regressed on a constant, the ``rank`` cointegrating relations of the last levels, and the last step;
    bounds are percentiles of paths with resampled residuals.
    """
    beta, d = relations[:, :rank], np.diff(y, axis=0)
    x = np.column_stack([np.ones(len(d) - 1), y[1:-1] @ beta, d[:-1]])
    b, *_ = np.linalg.lstsq(x, d[1:], rcond=None)
    e = d[1:] - x @ b

    def path(shocks: np.ndarray) -> np.ndarray:
        level, step, out = y[-1], d[-1], []
        for shock in shocks:
            step = np.concatenate([[1.0], level @ beta, step]) @ b + shock
            level = level + step
            out.append(level)
        return np.array(out)

    r = np.random.default_rng(seed)
    paths = np.array([path(e[r.integers(0, len(e), horizon)]) for _ in range(draws)])
    return path(np.zeros((horizon, y.shape[1]))), np.percentile(paths, 2.5, axis=0), np.percentile(paths, 97.5, axis=0)


def vector_forecast(y: np.ndarray, horizon: int, most_lags: int = 3, draws: int = 200, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Forecast, bounds and lags of a vector autoregression chosen by AIC; bounds from resampled residuals.

    They are percentiles of paths around the forecast itself. Without cointegration the series are differenced; with
    fewer relations than series, and rows enough, it is an error-correction model instead, whose lags are given as 0.
    """
    rank, relations = cointegration(y)
    if 0 < rank < y.shape[1] and len(y) - 2 > 2 * (1 + rank + y.shape[1]):
        return *error_correction(y, horizon, rank, relations, draws, seed), 0
    differenced = rank == 0
    z = np.diff(y, axis=0) if differenced else y
    best = None
    for p in range(1, most_lags + 1):
        if len(z) - p <= p * z.shape[1] + 2:
            break
        x = np.column_stack([np.ones(len(z) - p), *[z[p - i : len(z) - i] for i in range(1, p + 1)]])
        b, *_ = np.linalg.lstsq(x, z[p:], rcond=None)
        e = z[p:] - x @ b
        score = np.linalg.slogdet(e.T @ e / len(e) + 1e-12 * np.eye(z.shape[1]))[1] + 2 * b.size / len(e)
        if best is None or score < best[0]:
            best = (score, p, b, e)
    if best is None:
        flat = np.repeat(y[-1:], horizon, axis=0)
        return flat, flat, flat, 0
    _, p, b, e = best

    def path(shocks: np.ndarray) -> np.ndarray:
        past = list(z[-p:])
        for h in range(horizon):
            past.append(np.concatenate([[1.0], *[past[-i] for i in range(1, p + 1)]]) @ b + shocks[h])
        ahead = np.array(past[p:])
        return y[-1] + np.cumsum(ahead, axis=0) if differenced else ahead

    r = np.random.default_rng(seed)
    centre = path(np.zeros((horizon, z.shape[1])))
    paths = np.array([path(e[r.integers(0, len(e), horizon)]) for _ in range(draws)])
    return centre, np.percentile(paths, 2.5, axis=0), np.percentile(paths, 97.5, axis=0), p


def vector_ensemble(df: DataFrame, metrics: list[str], horizon: int = 5, least: int = 6, most_growth: float = 0.25) -> DataFrame:
    """Joint forecasts of an entity's metrics over their common periods; entities with implausible paths give no rows.

    Implausible: not finite, below 0 for a positive series, or growing by more than ``most_growth`` in a step.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        wide = pdf[pdf["metric"].isin(metrics)].pivot_table(index="period", columns="metric", values="value").reindex(columns=metrics).dropna().sort_index()
        if len(wide) < least:
            return _nothing()
        y = wide.to_numpy(float)
        is_log = bool((y > 0).all())
        entity = pdf["entity"].iloc[0]
        centre, low, high, p = vector_forecast(np.log(y) if is_log else y, horizon, seed=zlib.crc32(str(entity).encode()))
        if is_log:
            centre, low, high = np.exp(centre), np.exp(low), np.exp(high)
        steps = np.diff(np.vstack([y[-1:], centre]), axis=0) / np.maximum(np.abs(np.vstack([y[-1:], centre[:-1]])), 1e-12)
        if not np.isfinite(centre).all() or (is_log and (centre < 0).any()) or (np.abs(steps) > most_growth).any():
            return _nothing()
        low, high, rows = np.minimum(low, high), np.maximum(low, high), horizon * len(metrics)
        periods = np.tile(int(wide.index[-1]) + np.arange(1, horizon + 1), len(metrics))
        return pd.DataFrame({"entity": [entity] * rows, "metric": [m for m in metrics for _ in range(horizon)], "period": periods, "value": centre.T.ravel(), "lo": low.T.ravel(), "hi": high.T.ravel(), "model": [f"var({p})" if p else "vecm"] * rows, "aicc": np.full(rows, np.nan)})

    return df.select("entity", "metric", "period", "value").groupBy("entity").applyInPandas(run, _SCHEMA)


def residual_tests(df: DataFrame, lags: int = 3) -> DataFrame:
    """entity, metric, ljung_box, jarque_bera of the residuals from each series' line; null under ``lags`` + 3 values."""
    series = Window.partitionBy("entity", "metric")
    rows = df.where(F.col("value").isNotNull()).select("entity", "metric", "period", "value", (F.row_number().over(series.orderBy("period")) - 1).cast("double").alias("x"))
    rows = rows.withColumn("e", F.col("value") - F.regr_intercept("value", "x").over(series) - F.regr_slope("value", "x").over(series) * F.col("x"))
    rows = rows.select("*", *[(F.col("e") * F.lag("e", k).over(series.orderBy("period"))).alias(f"p{k}") for k in range(1, lags + 1)])
    moment = lambda k: F.avg(F.pow("e", F.lit(float(k)))).alias(f"m{k}")
    sums = rows.groupBy("entity", "metric").agg(F.count(F.lit(1)).alias("n"), *map(moment, (2, 3, 4)), *[F.sum(f"p{k}").alias(f"p{k}") for k in range(1, lags + 1)])
    n, var = F.col("n"), F.greatest("m2", F.lit(1e-300))
    portmanteau = sum(F.pow(F.col(f"p{k}") / (n * var), F.lit(2.0)) / (n - k) for k in range(1, lags + 1))
    skew, kurtosis = F.col("m3") / F.pow(var, F.lit(1.5)), F.col("m4") / (var * var)
    enough = lambda c: F.when(n >= lags + 3, c)
    return sums.select("entity", "metric", enough(n * (n + 2) * portmanteau).alias("ljung_box"), enough(n / 6 * (skew * skew + F.pow(kurtosis - 3, F.lit(2.0)) / 4)).alias("jarque_bera"))
