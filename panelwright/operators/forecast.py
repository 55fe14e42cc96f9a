"""Forecasts that have a closed form: trends, mean reversion, blends, fallbacks and labels of future periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Two-sided 95% points of Student's t by degrees of freedom, fixed values; the normal one beyond.
T_975 = (12.7062, 4.3027, 3.1824, 2.7764, 2.5706, 2.4469, 2.3646, 2.3060, 2.2622, 2.2281, 2.2010, 2.1788, 2.1604, 2.1448, 2.1314, 2.1199, 2.1098, 2.1009, 2.0930, 2.0860, 2.0796, 2.0739, 2.0687, 2.0639, 2.0595, 2.0555, 2.0518, 2.0484, 2.0452, 2.0423)


def t_quantile(degrees: Column) -> Column:
    """The 97.5% point; beyond the table an expansion around the normal one, right to four places."""
    d = degrees.cast("double")
    z = 1.959964
    far = z + (z**3 + z) / (4 * d) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * d * d)
    return F.when(degrees < 1, F.lit(None)).when(degrees <= len(T_975), F.get(F.array(*map(F.lit, T_975)), degrees.cast("int") - 1)).otherwise(far)


def eligible(df: DataFrame, series: list[str], least: Column | int, value: str = "value") -> DataFrame:
    """Series with at least so many values."""
    need = least if isinstance(least, Column) else F.lit(least)
    return df.groupBy(series).agg(F.count(value).alias("n")).where(F.col("n") >= need)


def linear_trend(df: DataFrame, series: list[str], horizon: int, value: str = "value", period: str = "period", interval: str = "mean") -> DataFrame:
    """period, value, lo, hi for ``horizon`` periods beyond each series' last, on the least-squares line over 0..n-1.

    Bounds are 95% ones of the mean, or of a new observation with interval="prediction"; null under three values.
    """
    x = (F.row_number().over(Window.partitionBy(*series).orderBy(period)) - 1).cast("double")
    rows = df.where(F.col(value).isNotNull()).withColumn("_x", x)
    fit = rows.groupBy(series).agg(
        F.count(F.lit(1)).alias("n"), F.max(period).alias("last_period"), F.regr_slope(value, "_x").alias("slope"), F.regr_intercept(value, "_x").alias("intercept"),
        F.avg("_x").alias("mx"), F.regr_sxx(value, "_x").alias("sxx"), F.regr_syy(value, "_x").alias("syy"),
    )
    fit = fit.where("n >= 2").withColumn("s2", F.when(F.col("n") > 2, F.greatest(F.col("syy") - F.col("slope") * F.col("slope") * F.col("sxx"), F.lit(0.0)) / (F.col("n") - 2)))
    ahead = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h")).withColumn("_x", F.col("n") - 1.0 + F.col("h"))
    centre = F.col("intercept") + F.col("slope") * F.col("_x")
    leverage = 1.0 / F.col("n") + F.pow(F.col("_x") - F.col("mx"), F.lit(2.0)) / F.col("sxx") + (1.0 if interval == "prediction" else 0.0)
    width = t_quantile(F.col("n") - 2) * F.sqrt(F.col("s2") * leverage)
    return ahead.select(*series, (F.col("last_period") + F.col("h")).alias(period), centre.alias(value), (centre - width).alias("lo"), (centre + width).alias("hi"))


def mean_reverting(df: DataFrame, series: list[str], horizon: int, theta: float = 0.1, recent: int | None = None, least: int = 5, low: float = 0.0, high: float = 100.0, value: str = "value", period: str = "period") -> DataFrame:
    """An Ornstein-Uhlenbeck path from the last value to the mean (of all values, or of the ``recent`` last ones)."""
    newest = F.row_number().over(Window.partitionBy(*series).orderBy(F.desc(period)))
    rows = df.where(F.col(value).isNotNull()).withColumn("_r", newest)
    mean = F.avg(F.when(F.col("_r") <= recent, F.col(value))) if recent else F.avg(value)
    fit = rows.groupBy(series).agg(F.count(F.lit(1)).alias("n"), mean.alias("mu"), F.stddev_samp(value).alias("sigma"), F.max(period).alias("last_period"), F.max_by(value, period).alias("x0")).where(F.col("n") >= least)
    ahead = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    centre = F.col("mu") + (F.col("x0") - F.col("mu")) * F.exp(-F.lit(theta) * F.col("h"))
    width = 1.96 * F.col("sigma") / F.sqrt(F.lit(2.0 * theta))
    clip = lambda c: F.least(F.greatest(c, F.lit(low)), F.lit(high))
    return ahead.select(*series, (F.col("last_period") + F.col("h")).alias(period), clip(centre).alias(value), clip(centre - width).alias("lo"), clip(centre + width).alias("hi"))


def recent_trend(df: DataFrame, series: list[str], horizon: int, window: int = 5, value: str = "value", period: str = "period") -> DataFrame:
    """The last value plus the mean step of the last ``window`` values; flat for a single value; not below 0."""
    newest = F.row_number().over(Window.partitionBy(*series).orderBy(F.desc(period)))
    rows = df.where(F.col(value).isNotNull()).withColumn("_r", newest).where(F.col("_r") <= window)
    fit = rows.groupBy(series).agg(F.count(F.lit(1)).alias("n"), F.max(period).alias("last_period"), F.max_by(value, period).alias("x0"), F.min_by(value, period).alias("x1"))
    step = F.when(F.col("n") > 1, (F.col("x0") - F.col("x1")) / (F.col("n") - 1)).otherwise(0.0)
    ahead = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    return ahead.select(*series, (F.col("last_period") + F.col("h")).alias(period), F.greatest(F.col("x0") + step * F.col("h"), F.lit(0.0)).alias(value))


def mean_growth(df: DataFrame, series: list[str], horizon: int, low: float = -0.02, high: float = 0.05, value: str = "value", period: str = "period") -> DataFrame:
    """The last value grown by the mean past growth, kept within bounds."""
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(period))
    rows = df.where(F.col(value).isNotNull()).withColumn("_g", F.when(before > 0, F.col(value) / before - 1))
    fit = rows.groupBy(series).agg(F.max(period).alias("last_period"), F.max_by(value, period).alias("x0"), F.least(F.greatest(F.coalesce(F.avg("_g"), F.lit(0.0)), F.lit(low)), F.lit(high)).alias("g"))
    ahead = fit.select("*", F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    return ahead.select(*series, (F.col("last_period") + F.col("h")).alias(period), (F.col("x0") * F.pow(1 + F.col("g"), F.col("h"))).alias(value))


def horizon_blend(first: Column, second: Column, horizon: Column, decay: float = 0.25) -> Column:
    """The first forecast near, the second far: weight exp(-decay * h) on the first."""
    w = F.exp(-F.lit(decay) * horizon)
    return w * first + (1 - w) * second


def information_weights(df: DataFrame, series: list[str], criterion: str = "aic") -> DataFrame:
    """weight of each model of a series: exp(-difference to the best / 2), adding up to 1."""
    w = Window.partitionBy(*series)
    raw = F.exp(-(F.col(criterion) - F.min(criterion).over(w)) / 2)
    return df.withColumn("_raw", raw).withColumn("weight", F.col("_raw") / F.sum("_raw").over(w)).drop("_raw")


def residual_interval(value: Column, sigma: Column, horizon: Column) -> tuple[Column, Column]:
    width = 1.96 * sigma * F.sqrt(horizon.cast("double"))
    return value - width, value + width


def from_logs(value: Column, sigma2: Column, is_log: Column) -> Column:
    """Back from logarithms, with the factor exp(sigma2 / 2) for the mean, where a series was transformed."""
    return F.when(is_log, F.exp(value + sigma2 / 2)).otherwise(value)


def break_dummies(df: DataFrame, breaks: list[tuple[str, int, str]], period: str = "period") -> DataFrame:
    """A column for each (name, first period, kind): a level step or a ramp from there on."""
    step = lambda p: (F.col(period) >= p).cast("double")
    return df.select("*", *[(step(p) if kind == "level" else F.greatest(F.col(period) - p + 1, F.lit(0)).cast("double")).alias(name) for name, p, kind in breaks])


def future_labels(df: DataFrame, series: list[str], frequency: str, horizon: int, last: str = "last_date") -> DataFrame:
    """label and h of the next periods after a date: A, Q, M or D."""
    unit = {"A": "interval 1 year", "Q": "interval 3 months", "M": "interval 1 month", "D": "interval 1 day"}[frequency]
    start = {"A": "YEAR", "Q": "QUARTER", "M": "MONTH", "D": "DAY"}[frequency]
    base = F.trunc(last, start) if frequency != "D" else F.col(last).cast("date")
    ahead = df.select(*series, base.alias("_base"), F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("h"))
    at = F.expr(f"_base + h * {unit}").cast("date")
    label = {"A": F.date_format(at, "yyyy"), "Q": F.concat(F.year(at), F.lit("-Q"), F.quarter(at)), "M": F.date_format(at, "yyyy-MM"), "D": F.date_format(at, "yyyy-MM-dd")}[frequency]
    return ahead.select(*series, "h", label.alias("label"))


def stepped_path(df: DataFrame, series: list[str], rate: str, step: str, terminal: str, steps: int = 20, months: int = 6) -> DataFrame:
    """month and rate: a cut every so many months until the terminal rate is reached."""
    ahead = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("k"))
    path = F.greatest(F.col(rate) - F.col("k") * F.col(step), F.col(terminal))
    done = F.col(rate) - (F.col("k") - 1) * F.col(step) <= F.col(terminal)
    return ahead.where((F.col("k") == 0) | ~done).select(*series, (F.col("k") * months).alias("month"), path.alias("rate"))


def deflator(df: DataFrame, keys: list[str], nominal: str, real: str, base: int, period: str = "period") -> DataFrame:
    """deflator: nominal over real, the base period being 100."""
    raw = F.col(nominal) / F.nullif(F.col(real), F.lit(0.0))
    at_base = F.max(F.when(F.col(period) == base, raw)).over(Window.partitionBy(*keys))
    return df.withColumn("deflator", 100.0 * raw / F.nullif(at_base, F.lit(0.0)))


def interval_quality(df: DataFrame, value: str = "value", low: str = "lo", high: str = "hi", method: str = "method") -> DataFrame:
    """mean_cv, median_cv, max_cv and n_methods of a set of forecasts."""
    cv = (F.col(high) - F.col(low)) / (2 * F.nullif(F.abs(value), F.lit(0.0)))
    return df.withColumn("_cv", cv).agg(F.avg("_cv").alias("mean_cv"), F.percentile("_cv", F.lit(0.5)).alias("median_cv"), F.max("_cv").alias("max_cv"), F.countDistinct(method).alias("n_methods"))


def last_complete_period(df: DataFrame, keys: list[str], run_year: int, run_month: int, lag_month: int, period: str = "period") -> DataFrame:
    """last_period of each key, not beyond the run's year, which itself counts only from ``lag_month`` on."""
    limit = run_year if run_month >= lag_month else run_year - 1
    return df.where(F.col(period) <= limit).groupBy(keys).agg(F.max(period).alias("last_period"))


def log_trend(df: DataFrame, series: list[str], horizon: int, value: str = "value", period: str = "period") -> DataFrame:
    """A trend in log space: the line's exponential with bounds of a new observation; a single value is carried on, without bounds.

    method is lintrend_log or flat_log; only positive values count.
    """
    logs = df.where(F.col(value) > 0).select(*series, period, F.log(value).alias(value))
    line = linear_trend(logs, series, horizon, value, period, "prediction")
    exp = lambda c: F.exp(c).alias(c)
    trend = line.select(*series, period, exp(value), exp("lo"), exp("hi"), F.lit("lintrend_log").alias("method"))
    alone = logs.groupBy(series).agg(F.count(F.lit(1)).alias("_n"), F.max(period).alias("_p"), F.max(value).alias(value)).where("_n = 1")
    none = F.lit(None).cast("double")
    flat = alone.withColumn("_h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).select(*series, (F.col("_p") + F.col("_h")).alias(period), exp(value), none.alias("lo"), none.alias("hi"), F.lit("flat_log").alias("method"))
    return trend.unionByName(flat)


def assumed_path(periods: DataFrame, steps: DataFrame, key: list[str], period: str = "period", value: str = "value", band: float = 0.25) -> DataFrame:
    """An assumed path: the value of each key's last step at or before a period, with a fixed band; null before the first.

    steps: key, period and value. The steps of a key are one map, as they are few.
    """
    curve = steps.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(period).alias("p"), F.col(value).alias("v")))).alias("_steps"))
    at = F.element_at(F.filter("_steps", lambda s: s["p"] <= F.col(period)), -1)
    out = periods.join(curve, key).withColumn(value, F.when(F.exists("_steps", lambda s: s["p"] <= F.col(period)), at["v"])).drop("_steps")
    return out.withColumn("lo", F.col(value) - band).withColumn("hi", F.col(value) + band).withColumn("method", F.lit("assumed"))


def history_quality(df: DataFrame, series: list[str], value: str = "value", period: str = "period") -> DataFrame:
    """n_series, n_gaps (steps of more than a period) and mean_history (values a series) of the rows that have a value."""
    w = Window.partitionBy(*series).orderBy(period)
    steps = df.where(F.col(value).isNotNull()).withColumn("_step", F.col(period) - F.lag(period).over(w))
    by_series = steps.groupBy(*series).agg(F.count_if(F.col("_step") > 1).alias("_gaps"), F.count(F.lit(1)).alias("_n"))
    return by_series.agg(F.count(F.lit(1)).alias("n_series"), F.coalesce(F.sum("_gaps"), F.lit(0)).alias("n_gaps"), F.avg("_n").alias("mean_history"))
