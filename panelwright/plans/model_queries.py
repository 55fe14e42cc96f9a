"""Queries for forecasts, derived metrics, checks, audits and fitted models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.operators import audit
from panelwright.operators import check_suite as cs
from panelwright.operators import checks, derived, forecast, hierarchy, models, ordered, panel, rollup
from panelwright.plans import fixtures as fx
from panelwright.plans.panel_queries import _ahead, _parents, r
from panelwright.plans.registry import query

_KEYS = ["entity", "metric"]

# forecasts in closed form


_T = "CASE d " + " ".join(f"WHEN {i + 1} THEN {t}" for i, t in enumerate(forecast.T_975)) + " END::DOUBLE"


@query(
    f"""+ x AS (SELECT *, row_number() OVER (PARTITION BY entity, metric ORDER BY period) - 1 AS x FROM panel),
    f AS (SELECT entity, metric, count(*) AS n, max(period) AS last, regr_slope(value, x) AS b, regr_intercept(value, x) AS a, avg(x) AS mx, regr_sxx(value, x) AS sxx, regr_syy(value, x) AS syy FROM x GROUP BY 1, 2),
    g AS (SELECT *, greatest(syy - b * b * sxx, 0) / (n - 2) AS s2, (n - 2)::INTEGER AS d, unnest(range(1, 6)) AS h FROM f),
    c AS (SELECT *, a + b * (n - 1 + h) AS v, {_T} * sqrt(s2 * (1.0::DOUBLE / n + pow(n - 1 + h - mx, 2) / sxx)) AS w FROM g)
    SELECT entity, metric, (last + h)::INTEGER AS period, round(v, 4) AS value, round(v - w, 4) AS lo, round(v + w, 4) AS hi FROM c"""
)
def linear_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.linear_trend(fx.panel(spark, sf_dir), _KEYS, 5).select(*_KEYS, "period", r("value"), r("lo"), r("hi"))


@query(
    f"""+ x AS (SELECT *, row_number() OVER (PARTITION BY entity, metric ORDER BY period) - 1 AS x FROM panel WHERE metric = 'orders'),
    f AS (SELECT entity, metric, count(*) AS n, max(period) AS last, regr_slope(value, x) AS b, regr_intercept(value, x) AS a, avg(x) AS mx, regr_sxx(value, x) AS sxx, regr_syy(value, x) AS syy FROM x GROUP BY 1, 2),
    g AS (SELECT *, greatest(syy - b * b * sxx, 0) / (n - 2) AS s2, (n - 2)::INTEGER AS d, unnest(range(1, 4)) AS h FROM f),
    c AS (SELECT *, a + b * (n - 1 + h) AS v, {_T} * sqrt(s2 * (1 + 1.0::DOUBLE / n + pow(n - 1 + h - mx, 2) / sxx)) AS w FROM g)
    SELECT entity, (last + h)::INTEGER AS period, round(v - w, 5) AS lo, round(v + w, 5) AS hi FROM c"""
)
def prediction_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).where("metric = 'orders'")
    return forecast.linear_trend(rows, _KEYS, 3, interval="prediction").select("entity", "period", r("lo", 5), r("hi", 5))


@query(
    """+ f AS (SELECT entity, count(*) AS n, avg(value) AS mu, stddev_samp(value) AS s, max(period) AS last, arg_max(value, period) AS x0 FROM rates GROUP BY 1 HAVING count(*) >= 5),
    g AS (SELECT *, unnest(range(1, 11)) AS h FROM f), c AS (SELECT *, mu + (x0 - mu) * exp(-0.1::DOUBLE * h) AS v, 1.96::DOUBLE * s / sqrt(2 * 0.1::DOUBLE) AS w FROM g)
    SELECT entity, (last + h)::INTEGER AS period, round(least(greatest(v, 0), 100), 6) AS value, round(least(greatest(v - w, 0), 100), 6) AS lo, round(least(greatest(v + w, 0), 100), 6) AS hi FROM c"""
)
def mean_reversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.mean_reverting(fx.rates(spark, sf_dir), ["entity"], 10).select("entity", "period", r("value", 6), r("lo", 6), r("hi", 6))


@query(
    """+ n AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period DESC) AS k FROM rates),
    f AS (SELECT entity, avg(CASE WHEN k <= 4 THEN value END) AS mu, max(period) AS last, arg_max(value, period) AS x0 FROM n GROUP BY 1), g AS (SELECT *, unnest(range(1, 6)) AS h FROM f)
    SELECT entity, (last + h)::INTEGER AS period, round(least(greatest(mu + (x0 - mu) * exp(-0.12::DOUBLE * h), 4.9), 5.1), 6) AS value FROM g"""
)
def recent_mean_reversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.mean_reverting(fx.rates(spark, sf_dir), ["entity"], 5, theta=0.12, recent=4, low=4.9, high=5.1).select("entity", "period", r("value", 6))


@query(
    """+ n AS (SELECT *, row_number() OVER (PARTITION BY entity, metric ORDER BY period DESC) AS k FROM panel),
    f AS (SELECT entity, metric, count(*) AS n, max(period) AS last, arg_max(value, period) AS x0, arg_min(value, period) AS x1 FROM n WHERE k <= 5 GROUP BY 1, 2), g AS (SELECT *, unnest(range(1, 4)) AS h FROM f)
    SELECT entity, metric, (last + h)::INTEGER AS period, round(greatest(x0 + CASE WHEN n > 1 THEN (x0 - x1) / (n - 1) ELSE 0 END * h, 0), 4) AS value FROM g"""
)
def recent_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.recent_trend(fx.panel(spark, sf_dir), _KEYS, 3).select(*_KEYS, "period", r("value"))


@query(
    """+ g AS (SELECT *, value / lag(value) OVER (PARTITION BY entity, metric ORDER BY period) - 1 AS g FROM panel),
    f AS (SELECT entity, metric, max(period) AS last, arg_max(value, period) AS x0, least(greatest(coalesce(avg(g), 0), -0.02), 0.05) AS g FROM g GROUP BY 1, 2), h AS (SELECT *, unnest(range(1, 4)) AS h FROM f)
    SELECT entity, metric, (last + h)::INTEGER AS period, round(x0 * pow(1 + g, h), 3) AS value FROM h"""
)
def mean_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.mean_growth(fx.panel(spark, sf_dir), _KEYS, 3).select(*_KEYS, "period", r("value", 3))


@query(
    """+ n AS (SELECT *, row_number() OVER (PARTITION BY entity, metric ORDER BY period DESC) AS k, row_number() OVER (PARTITION BY entity, metric ORDER BY period) - 1 AS x FROM panel),
    a AS (SELECT entity, metric, max(period) AS last, count(*) AS c, regr_slope(value, x) AS b, regr_intercept(value, x) AS i FROM n GROUP BY 1, 2),
    s AS (SELECT entity, metric, count(*) AS m, arg_max(value, period) AS x0, arg_min(value, period) AS x1 FROM n WHERE k <= 5 GROUP BY 1, 2),
    g AS (SELECT *, unnest(range(1, 6)) AS h FROM a JOIN s USING (entity, metric))
    SELECT entity, metric, (last + h)::INTEGER AS period, round(exp(-0.25::DOUBLE * h) * (i + b * (c - 1 + h)) + (1 - exp(-0.25::DOUBLE * h)) * greatest(x0 + (x0 - x1) / (m - 1) * h, 0), 3) AS value FROM g"""
)
def horizon_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir)
    a = forecast.linear_trend(rows, _KEYS, 5).select(*_KEYS, "period", F.col("value").alias("a"))
    b = forecast.recent_trend(rows, _KEYS, 5).select(*_KEYS, "period", F.col("value").alias("b"))
    last = ordered.last_known(rows, _KEYS)
    joined = a.join(b, [*_KEYS, "period"]).join(last, _KEYS)
    return joined.select(*_KEYS, "period", r(forecast.horizon_blend(F.col("a"), F.col("b"), F.col("period") - F.col("last_period")), 3).alias("value"))


@query(
    """+ f AS (SELECT entity, period, metric, value / sum(value) OVER (PARTITION BY entity, metric) * 10 AS aic FROM panel), g AS (SELECT *, exp(-(aic - min(aic) OVER (PARTITION BY entity, metric)) / 2) AS raw FROM f)
    SELECT entity, metric, period, round(raw / sum(raw) OVER (PARTITION BY entity, metric), 8) AS weight FROM g"""
)
def information_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    rows = fx.panel(spark, sf_dir).withColumn("aic", F.col("value") / F.sum("value").over(Window.partitionBy(*_KEYS)) * 10)
    return forecast.information_weights(rows, _KEYS).select(*_KEYS, "period", r("weight", 8))


@query(" SELECT entity, metric, count(*) AS n FROM panel WHERE NOT (contains(entity, '_1') AND period < 1998) GROUP BY 1, 2 HAVING count(*) >= CASE metric WHEN 'orders' THEN 4 ELSE 6 END")
def eligible_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).where("NOT (contains(entity, '_1') AND period < 1998)")
    return forecast.eligible(rows, _KEYS, F.when(F.col("metric") == "orders", 4).otherwise(6))


@query(" SELECT entity, period, round(CASE WHEN metric = 'revenue' THEN exp(ln(value) + 0.02::DOUBLE / 2) ELSE value END, 3) AS value, metric, (period >= 1998)::INTEGER::DOUBLE AS step, greatest(period - 2000 + 1, 0)::DOUBLE AS ramp, round(value - 1.96::DOUBLE * 2 * sqrt((period - 1994)::DOUBLE), 3) AS lo FROM panel")
def logs_and_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = forecast.break_dummies(fx.panel(spark, sf_dir), [("step", 1998, "level"), ("ramp", 2000, "trend")])
    low, _ = forecast.residual_interval(F.col("value"), F.lit(2.0), F.col("period") - 1994)
    is_log = F.col("metric") == "revenue"
    back = forecast.from_logs(F.when(is_log, F.log("value")).otherwise(F.col("value")), F.lit(0.02), is_log)
    return rows.select("entity", "metric", "period", r(back, 3).alias("value"), "step", "ramp", r(low, 3).alias("lo"))


@query(
    """+ l AS (SELECT o_orderpriority AS p, max(o_orderdate)::DATE AS d FROM orders GROUP BY 1), g AS (SELECT *, unnest(range(1, 7)) AS h FROM l)
    SELECT p, h::INTEGER AS h, 'Q' AS frequency, concat(year(date_trunc('quarter', d) + to_months((3 * h)::INTEGER)), '-Q', quarter(date_trunc('quarter', d) + to_months((3 * h)::INTEGER))) AS label FROM g
    UNION ALL SELECT p, h::INTEGER, 'M', strftime(date_trunc('month', d) + to_months(h::INTEGER), '%Y-%m') FROM g
    UNION ALL SELECT p, h::INTEGER, 'A', strftime(date_trunc('year', d) + to_years(h::INTEGER), '%Y') FROM g
    UNION ALL SELECT p, h::INTEGER, 'D', strftime(d + to_days(h::INTEGER), '%Y-%m-%d') FROM g"""
)
def future_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = fx.table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("p")).agg(F.max("o_orderdate").alias("last_date"))
    out = None
    for frequency in "QMAD":
        part = forecast.future_labels(last, ["p"], frequency, 6).withColumn("frequency", F.lit(frequency))
        out = part if out is None else out.unionByName(part)
    return out


@query(" SELECT * FROM (SELECT entity, (6 * k)::INTEGER AS month, round(greatest(rate - k * step, 3), 4) AS rate FROM (SELECT entity, 5.25::DOUBLE AS rate, CASE WHEN contains(entity, '_1') THEN 0.5 ELSE 0.25 END::DOUBLE AS step, unnest(range(0, 21)) AS k FROM geo) t WHERE k = 0 OR rate - (k - 1) * step > 3) u")
def stepped_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = fx.geography(spark, sf_dir).select("entity", F.lit(5.25).alias("rate"), F.when(F.contains("entity", F.lit("_1")), 0.5).otherwise(0.25).alias("step"), F.lit(3.0).alias("terminal"))
    return forecast.stepped_path(g, ["entity"], "rate", "step", "terminal").select("entity", "month", r("rate"))


@query(
    """+ w AS (SELECT entity, period, max(CASE WHEN metric = 'revenue' THEN value END) AS a, max(CASE WHEN metric = 'orders' THEN value END) AS b FROM panel GROUP BY 1, 2)
    SELECT entity, period, round(100 * (a / b) / max(CASE WHEN period = 1998 THEN a / b END) OVER (PARTITION BY entity), 6) AS deflator FROM w"""
)
def deflator(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = panel.by_metric(fx.panel(spark, sf_dir), ["entity", "period"], ["revenue", "orders"], ["value"])
    return forecast.deflator(wide, ["entity"], "revenue_value", "orders_value", 1998).select("entity", "period", r("deflator", 6))


@query(" SELECT round(avg((hi - lo) / (2 * value)), 8) AS mean_cv, round(quantile_cont((hi - lo) / (2 * value), 0.5), 8) AS median_cv, round(max((hi - lo) / (2 * value)), 8) AS max_cv, count(DISTINCT data_type) AS n_methods FROM split WHERE data_type = 'forecast'")
def interval_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).where("data_type = 'forecast'").withColumnRenamed("data_type", "method")
    return forecast.interval_quality(rows).select(r("mean_cv", 8), r("median_cv", 8), r("max_cv", 8), "n_methods")


@query(" SELECT entity, metric, max(period) AS last_period FROM panel WHERE period <= 1999 GROUP BY 1, 2")
def last_complete_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.last_complete_period(fx.panel(spark, sf_dir), _KEYS, 2000, 3, 9)


@query(" SELECT m.metric, count(DISTINCT p.entity) AS entities, 25 - count(DISTINCT p.entity) AS missing, min(p.period) AS first_period, max(p.period) AS last_period FROM (VALUES ('revenue'), ('orders')) m(metric) LEFT JOIN panel p ON p.metric = m.metric AND NOT (p.metric = 'orders' AND p.parent = 'ASIA') GROUP BY 1".replace("25 - count", "(SELECT count(*) FROM geo) - count"))
def coverage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).where("NOT (metric = 'orders' AND parent = 'ASIA')")
    total = fx.geography(spark, sf_dir).agg(F.count(F.lit(1)).alias("all"))
    found = rows.groupBy("metric").agg(F.countDistinct("entity").alias("entities"), F.min("period").alias("first_period"), F.max("period").alias("last_period"))
    return found.join(F.broadcast(total)).select("metric", "entities", (F.col("all") - F.col("entities")).alias("missing"), "first_period", "last_period")


# derived metrics


_WIDE = """w AS (SELECT entity, period, max(CASE WHEN metric = 'revenue' THEN value END) AS a, max(CASE WHEN metric = 'revenue' THEN lo END) AS al, max(CASE WHEN metric = 'revenue' THEN hi END) AS ah, max(CASE WHEN metric = 'revenue' THEN data_type END) AS t,
    max(CASE WHEN metric = 'orders' THEN value END) AS b, max(CASE WHEN metric = 'orders' THEN lo END) AS bl, max(CASE WHEN metric = 'orders' THEN hi END) AS bh FROM split GROUP BY 1, 2)"""


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.by_metric(fx.split(fx.panel(spark, sf_dir)), ["entity", "period"], ["revenue", "orders"], ["value", "lo", "hi", "data_type"])


@query(
    f"""+ {_WIDE} SELECT entity, period, round(a / b, 4) AS value, round(least(coalesce(al, a * 0.95) / coalesce(bh, b * 1.02), coalesce(ah, a * 1.05) / coalesce(bl, b * 0.98)), 4) AS lo,
    round(greatest(coalesce(al, a * 0.95) / coalesce(bh, b * 1.02), coalesce(ah, a * 1.05) / coalesce(bl, b * 0.98)), 4) AS hi, t AS data_type FROM w"""
)
def ratio_with_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = derived.ratio_with_bounds(_wide(spark, sf_dir), "average", "revenue", "orders")
    return out.select("entity", "period", r("value"), r("lo"), r("hi"), "data_type")


@query(f"+ {_WIDE} SELECT entity, period, round(a / b * (1 - 1.96::DOUBLE * 0.1::DOUBLE * (1 + 0.02::DOUBLE * (period - 1999))), 4) AS lo, round(a / b * (1 + 1.96::DOUBLE * 0.1::DOUBLE * (1 + 0.02::DOUBLE * (period - 1999))), 4) AS hi FROM w WHERE period >= 2000")
def horizon_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = _wide(spark, sf_dir).where("period >= 2000")
    low, high = derived.horizon_bounds(F.col("revenue_value") / F.col("orders_value"), F.col("period") - 1999, 0.1, 0.02)
    return wide.select("entity", "period", r(low).alias("lo"), r(high).alias("hi"))


@query(f"+ {_WIDE} SELECT entity, period, round(a / b - 1.96::DOUBLE * abs(a / b) * sqrt(pow(0.05::DOUBLE, 2) + pow(0.02::DOUBLE, 2) - 2 * 0.7::DOUBLE * 0.05::DOUBLE * 0.02::DOUBLE), 4) AS lo FROM w")
def delta_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("revenue_value"), F.col("orders_value")
    low, _ = derived.delta_bounds(a, a * 0.05, b, b * 0.02, 0.7)
    return _wide(spark, sf_dir).select("entity", "period", r(low).alias("lo"))


@query(" SELECT entity, metric, period, round(least(lo, hi), 4) AS lo, round(greatest(lo, hi), 4) AS hi, round(abs(hi - lo), 4) AS ci_width FROM (SELECT entity, metric, period, CASE WHEN period = 2000 THEN hi ELSE lo END AS lo, CASE WHEN period = 2000 THEN lo ELSE hi END AS hi FROM split WHERE data_type = 'forecast') t")
def interval_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).where("data_type = 'forecast'")
    swapped = rows.select(*_KEYS, "period", F.when(F.col("period") == 2000, F.col("hi")).otherwise(F.col("lo")).alias("lo"), F.when(F.col("period") == 2000, F.col("lo")).otherwise(F.col("hi")).alias("hi"))
    return derived.with_width(derived.ordered_bounds(swapped)).select(*_KEYS, "period", r("lo"), r("hi"), r("ci_width"))


@query(" SELECT entity, metric, period, round(lo * 1.2::DOUBLE, 4) AS lo, round(hi * 1.2::DOUBLE, 4) AS hi FROM split WHERE data_type = 'forecast'")
def rescaled_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).where("data_type = 'forecast'").withColumn("new", F.col("value") * 1.2)
    return derived.rescaled_bounds(rows, "value", "new").select(*_KEYS, "period", r("lo"), r("hi"))


@query(" SELECT entity, metric, period, round(1 - 0.05::DOUBLE / 0.1, 6) AS asymmetry FROM split WHERE data_type = 'forecast' AND period = 2001")
def asymmetric_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).where("data_type = 'forecast'").withColumn("hi", F.when(F.col("period") == 2001, F.col("value") * 1.1).otherwise(F.col("hi")))
    return derived.asymmetric(rows).select(*_KEYS, "period", r("asymmetry", 6))


@query()
def simulated_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("revenue_value"), F.col("orders_value")
    rows = _wide(spark, sf_dir).select("entity", "period", a.alias("a"), (a * 0.05).alias("sa"), b.alias("b"), (b * 0.02).alias("sb"))
    return derived.simulated_ratio(rows, ["entity", "period"], draws=5000, rho=0.7)


# fitted models


@query()
def model_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.ensemble(fx.panel(spark, sf_dir), horizon=5)


@query()
def vector_autoregression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.vector_ensemble(fx.panel(spark, sf_dir), ["revenue", "orders"], horizon=5)


@query(
    """+ x AS (SELECT entity, metric, period, value, (row_number() OVER (PARTITION BY entity, metric ORDER BY period) - 1)::DOUBLE AS x FROM panel), f AS (SELECT entity, metric, regr_slope(value, x) AS b, regr_intercept(value, x) AS a FROM x GROUP BY 1, 2),
    e AS (SELECT x.entity, x.metric, period, value - a - b * x AS e FROM x JOIN f USING (entity, metric)), l AS (SELECT *, e * lag(e, 1) OVER w AS p1, e * lag(e, 2) OVER w AS p2, e * lag(e, 3) OVER w AS p3 FROM e WINDOW w AS (PARTITION BY entity, metric ORDER BY period)),
    m AS (SELECT entity, metric, count(*)::DOUBLE AS n, avg(e * e) AS m2, avg(e * e * e) AS m3, avg(e * e * e * e) AS m4, sum(p1) AS p1, sum(p2) AS p2, sum(p3) AS p3 FROM l GROUP BY 1, 2)
    SELECT entity, metric, CASE WHEN n >= 6 THEN round(n * (n + 2) * (pow(p1 / (n * m2), 2) / (n - 1) + pow(p2 / (n * m2), 2) / (n - 2) + pow(p3 / (n * m2), 2) / (n - 3)), 6) END AS ljung_box,
           CASE WHEN n >= 6 THEN round(n / 6 * (m3 * m3 / pow(m2, 3) + pow(m4 / (m2 * m2) - 3, 2) / 4), 6) END AS jarque_bera FROM m"""
)
def residual_tests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.residual_tests(fx.panel(spark, sf_dir)).select(*_KEYS, r("ljung_box", 6), r("jarque_bera", 6))


# checks


@query(
    """+ parents AS (SELECT parent, metric, period, sum(value) * 1.05::DOUBLE AS pv FROM panel GROUP BY 1, 2, 3), dev AS (SELECT parent, metric, period, abs(sum(value) - max(pv)) / max(pv) AS d FROM panel JOIN parents USING (parent, metric, period) GROUP BY 1, 2, 3),
    lagged AS (SELECT *, 100 * (value / lag(value) OVER (PARTITION BY entity, metric ORDER BY period) - 1) AS c FROM panel),
    ends AS (SELECT entity, metric, arg_max(value, period) FILTER (WHERE data_type = 'historical') AS a, arg_min(value, period) FILTER (WHERE data_type = 'forecast') AS b FROM split GROUP BY 1, 2)
    SELECT "check", severity, count(*) AS n, round(max(measured), 4) AS worst FROM (
      SELECT 'coverage' AS "check", 'issue' AS severity, 0::DOUBLE AS measured UNION ALL
      SELECT 'reconciles', 'issue', d FROM dev WHERE d > 0.01 UNION ALL
      SELECT 'bounds', 'warning', value FROM rates WHERE value > 5.1 OR value < 4.9 UNION ALL
      SELECT 'yearly_change', 'warning', c FROM lagged WHERE c < -20 OR c > 20 UNION ALL
      SELECT 'continuity', 'issue', b / a - 1 FROM ends WHERE b / a - 1 > 0.2 OR b / a - 1 < -0.1 UNION ALL
      SELECT 'horizon', 'issue', max(period)::DOUBLE FROM panel GROUP BY entity, metric HAVING max(period) < 2050) t GROUP BY 1, 2"""
)
def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks of the panel, its parents' table and the expected metrics in one pass, and those of the rates in another."""
    rows = fx.split(fx.panel(spark, sf_dir))
    expected = spark.createDataFrame([("revenue",), ("orders",), ("profit",)], "metric string")
    parents = _parents(fx.panel(spark, sf_dir)).withColumnRenamed("parent_value", "total")
    every, series, present = cs.tagged(rows=rows, parents=parents, expected=expected), _KEYS, F.col("table") == "rows"
    s = cs.coverage(cs.Suite().step("last", ["table", *series], "period", F.col("value")), ["metric"], F.col("table") == "expected", present)
    s = s.group("nulls", series, {"n": cs.rows_of(present & F.col("value").isNull())}, lambda a: a["n"] > 0, lambda a: a["n"], 0)
    s = cs.negatives(cs.duplicates(s, [*series, "period"], present), series)
    s = cs.reconciles(s, ["parent", "metric", "period"], F.col("value"), F.col("total"), 0.01)
    s = cs.change(s, "yearly_change", [*series, "period"], F.col("value"), F.col("last"), -20, 20, scale=100.0, severity=checks.WARNING)
    s = cs.interval_order(cs.seam(s, series, -0.1, 0.2), series)
    s = cs.horizon(s, series, 2050, F.when(present, F.col("period")))
    s = cs.interval_width(s, ["metric"], 50.0, checks.WARNING)
    rates = cs.bounds(cs.Suite(), ["entity", "period"], F.col("value"), 4.9, 5.1, checks.WARNING)
    found = s.run(every).unionByName(rates.run(fx.rates(spark, sf_dir)))
    return found.groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("measured"), 4).alias("worst"))


@query(
    """+ s AS (SELECT *, value / sum(value) OVER (PARTITION BY parent, metric, period) AS share FROM panel), g AS (SELECT entity, metric, pow(max(CASE WHEN period = 2000 THEN value END) / max(CASE WHEN period = 1995 THEN value END), 0.2) - 1 AS c FROM panel GROUP BY 1, 2),
    w AS (SELECT entity, period, max(CASE WHEN metric = 'revenue' THEN value END) AS a, max(CASE WHEN metric = 'orders' THEN value END) AS b FROM panel GROUP BY 1, 2)
    SELECT "check", count(*) AS n FROM (
      SELECT 'constant_shares' AS "check" FROM s GROUP BY entity, metric HAVING stddev_samp(share) > 1e-10 UNION ALL
      SELECT 'growth_plausible' FROM g WHERE 100 * c < -1 OR 100 * c > 1 UNION ALL SELECT 'comovement' FROM w GROUP BY entity HAVING count(*) > 5 AND corr(a, b) < 0.9 UNION ALL
      SELECT 'ratio_identity' FROM w WHERE period = 1999 UNION ALL SELECT 'region_count' FROM panel WHERE parent <> 'ASIA' GROUP BY metric UNION ALL
      SELECT 'year_gaps' FROM panel WHERE period % 3 <> 0 GROUP BY entity, metric UNION ALL SELECT 'unmapped' FROM geo WHERE parent = 'ASIA') t GROUP BY 1"""
)
def structure_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rollup.shares(fx.panel(spark, sf_dir), ["parent", "metric", "period"])
    rows = rows.withColumn("orders", F.max(F.when(F.col("metric") == "orders", F.col("value"))).over(Window.partitionBy("entity", "period")))
    revenue = F.when(F.col("metric") == "revenue", F.col("value"))
    rows = rows.withColumn("revenue", revenue).withColumn("stored", revenue / F.col("orders") * F.when(F.col("period") == 1999, 1.5).otherwise(1.0))
    at = lambda year: F.when(F.col("period") == year, F.col("value"))
    cagr = lambda a: 100 * (F.pow(a["b"] / F.nullif(a["a"], F.lit(0.0)), F.lit(0.2)) - 1)
    error = F.abs(F.col("stored") - F.col("revenue") / F.nullif(F.col("orders"), F.lit(0.0))) / F.nullif(F.abs("stored"), F.lit(0.0))
    cell, share = ["entity", "period"], F.col("orders") / F.nullif(F.col("revenue"), F.lit(0.0))
    s = cs.Suite().group("constant_shares", _KEYS, {"s": (F.stddev_samp, F.col("share"))}, lambda a: a["s"] > 1e-10, lambda a: a["s"], 1e-10)
    s = s.group("growth_plausible", _KEYS, {"a": (F.max, at(1995)), "b": (F.max, at(2000))}, lambda a: (cagr(a) < -1) | (cagr(a) > 1), cagr, 1, checks.WARNING)
    s = cs.comovement(s, ["entity"], F.col("revenue"), F.when(revenue.isNotNull(), F.col("orders")), 0.9, checks.WARNING)
    s = s.row("ratio_identity", cell, error > 0.01, error, 0.01)
    s = s.row("part_over_whole", cell, F.col("orders") > F.col("revenue"), share, 1.0).row("part_of_whole", cell, (share < 0) | (share > 0.5), share, 0.5, checks.WARNING)
    s = s.group("region_count", ["metric"], {"n": (F.count_distinct, F.when(F.col("parent") != "ASIA", F.col("entity")))}, lambda a: a["n"] != 25, lambda a: a["n"], 25)
    s = cs.gaps(s, _KEYS, F.when(F.col("period") % 3 != 0, F.col("period")))
    names = fx.geography(spark, sf_dir).select("entity", F.col("parent").alias("name"))
    every = cs.tagged(used=names, known=names.where("name <> 'ASIA'").withColumnRenamed("name", "known"))
    there = {"n": cs.rows_of(F.col("table") == "used"), "k": (F.max, F.col("known")), "name": (F.max, F.col("name"))}
    m = cs.Suite().group("unmapped", ["entity"], there, lambda a: (a["n"] > 0) & a["k"].isNull(), lambda a: F.lit(0), None)
    m = m.group("name_differs", ["entity"], there, lambda a: a["name"] != a["k"], lambda a: F.lit(1), None, checks.WARNING)
    found = s.run(rows).unionByName(m.run(every))
    return found.groupBy("check").agg(F.count(F.lit(1)).alias("n"))


@query(
    """+ start AS (SELECT entity, metric, arg_max(value, period) AS start FROM panel WHERE period < 2000 GROUP BY 1, 2), ahead AS (SELECT p.*, start, row_number() OVER (PARTITION BY entity, metric ORDER BY p.period) AS i FROM panel p JOIN start USING (entity, metric) WHERE p.period >= 2000),
    one AS (SELECT entity, metric, greatest(least(value, start * 1.06::DOUBLE), start * 0.95::DOUBLE) AS a FROM ahead WHERE i = 1), two AS (SELECT n.entity, n.metric, one.a AS last, CASE WHEN n.entity LIKE '%2' THEN n.value ELSE greatest(least(n.value, one.a * 1.06::DOUBLE), one.a * 0.95::DOUBLE) END AS now FROM ahead n JOIN one USING (entity, metric) WHERE i = 2)
    SELECT count(*) FILTER (WHERE now / last - 1 > 0.061::DOUBLE OR now / last - 1 < -0.051::DOUBLE) AS issues, count(*) FILTER (WHERE now / last - 1 > 0.061::DOUBLE OR now / last - 1 < -0.051::DOUBLE) = 0 AS passed FROM two"""
)
def caps_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate on capped series, of which some got their last value back as it was before the cap."""
    rows = _ahead(spark, sf_dir).withColumn("low", F.lit(-0.05)).withColumn("high", F.lit(0.06))
    capped = ordered.growth_capped(rows, _KEYS, "start", "low", "high")
    faulty = capped.withColumn("adjusted", F.when(F.col("entity").like("%2") & (F.col("period") == 2001), F.col("value")).otherwise(F.col("adjusted")))
    return checks.gate(checks.caps_honoured(faulty, _KEYS, -0.05, 0.06)).select("issues", "passed")


@query(" SELECT data_type AS method, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (), 8) AS share FROM split GROUP BY 1")
def method_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.method_share(fx.split(fx.panel(spark, sf_dir)).withColumnRenamed("data_type", "method")).select("method", "n", r("share", 8))


# audits


@query(
    " SELECT * FROM (VALUES ('customer', 'UNCHANGED', 0::BIGINT, false, false), ('orders', 'MODIFIED', 0::BIGINT, true, false), ('panel', 'MODIFIED', -(SELECT count(*) FROM panel WHERE period = 2001)::BIGINT, true, false), ('nation', 'CREATED', 25::BIGINT, true, false), ('region', 'DROPPED', -5::BIGINT, true, false)) t(table_name, status, rows_delta, hash_changed, period_extended)"
)
def table_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).withColumn("value", F.round("value", 2))
    orders = fx.table(spark, sf_dir, "orders")
    customer = fx.table(spark, sf_dir, "customer")
    before = [audit.fingerprint(customer, "customer"), audit.fingerprint(orders, "orders"), audit.fingerprint(rows, "panel", "period"), audit.fingerprint(fx.table(spark, sf_dir, "region"), "region")]
    after = [audit.fingerprint(customer.repartition(5), "customer"), audit.fingerprint(orders.withColumn("o_orderstatus", F.lower("o_orderstatus")), "orders"), audit.fingerprint(rows.where("period <> 2001"), "panel", "period"), audit.fingerprint(fx.table(spark, sf_dir, "nation"), "nation")]
    return audit.table_diff(checks.all_of(*before), checks.all_of(*after))


@query(" SELECT o_orderkey, substr(sha256(concat(o_orderpriority, '|', o_orderstatus)), 1, 16) AS hash FROM orders")
def payload_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders").withColumn("payload", F.concat_ws("|", "o_orderpriority", "o_orderstatus"))
    return audit.payload_hash(orders, "o_orderkey", "payload")


@query(" SELECT entity, round(arg_max(value, period) FILTER (WHERE metric = 'revenue'), 3) AS revenue, arg_max(value, period) FILTER (WHERE metric = 'orders') AS orders FROM panel GROUP BY 1")
def latest_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.latest_matrix(fx.panel(spark, sf_dir), "entity", ["revenue", "orders"]).select("entity", r("revenue", 3), "orders")


@query(" SELECT * FROM (VALUES ('missing unit', 1::BIGINT), ('null parent', (SELECT count(*) FROM panel WHERE parent = 'ASIA')::BIGINT)) t(problem, n)")
def upload_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).withColumn("parent", F.nullif("parent", F.lit("ASIA")))
    return audit.upload_report(rows, ["entity", "unit"], ["parent", "entity", "metric", "period"])
