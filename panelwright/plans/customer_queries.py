"""Queries at customer grain, thousands of series each: folds with intervals, gaps in rates, coherence, mixed aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelwright.operators import check_suite as cs
from panelwright.operators import checks, derived, forecast, hierarchy, ordered, panel, rollup
from panelwright.plans import fixtures as fx
from panelwright.plans.panel_queries import _ahead, r
from panelwright.plans.registry import ORACLES, query

_KEYS = ["entity", "metric"]


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, parent, period, revenue, orders: a row per customer and year."""
    return panel.by_metric(fx.customer_panel(spark, sf_dir), ["entity", "parent", "period"], ["revenue", "orders"], ["value"]).withColumnsRenamed({"revenue_value": "revenue", "orders_value": "orders"})


_WIDE = "cwide AS (SELECT entity, parent, period, max(CASE WHEN metric = 'revenue' THEN value END) AS revenue, max(CASE WHEN metric = 'orders' THEN value END) AS orders FROM cpanel GROUP BY 1, 2, 3)"


@query(
    """+ hist AS (SELECT entity, metric, arg_max(value, period) AS start FROM cpanel WHERE period < 2000 GROUP BY 1, 2),
    vol AS (SELECT entity, metric, stddev_samp(g) AS volatility FROM (SELECT entity, metric, value / lag(value) OVER (PARTITION BY entity, metric ORDER BY period) - 1 AS g FROM cpanel WHERE period < 2000) t GROUP BY 1, 2),
    ahead AS (SELECT c.*, start, volatility, row_number() OVER (PARTITION BY entity, metric ORDER BY c.period) AS i FROM cpanel c JOIN hist USING (entity, metric) JOIN vol USING (entity, metric) WHERE c.period >= 2000),
    one AS (SELECT *, greatest(least(value, start * 1.06::DOUBLE), start * 0.95::DOUBLE) AS a FROM ahead WHERE i = 1),
    folded AS (SELECT * FROM one UNION ALL SELECT n.*, greatest(least(n.value, one.a * 1.06::DOUBLE), one.a * 0.95::DOUBLE) FROM ahead n JOIN one USING (entity, metric) WHERE n.i = 2),
    marked AS (SELECT *, max(CASE WHEN abs(a - value) > 1e-9::DOUBLE * abs(value) THEN 1 ELSE 0 END) OVER (PARTITION BY entity, metric) = 1 AND volatility > 0 AS capped FROM folded)
    SELECT entity, metric, period, round(a, 6) AS adjusted, round(CASE WHEN capped THEN greatest(a - 1.96::DOUBLE * a * volatility * sqrt(i), 0) ELSE value * 0.95::DOUBLE END, 4) AS lo,
           round(CASE WHEN capped THEN a + 1.96::DOUBLE * a * volatility * sqrt(i) ELSE value * 1.05::DOUBLE END, 4) AS hi FROM marked"""
)
def growth_cap_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.customer_panel(spark, sf_dir))
    past = rows.where("data_type = 'historical'")
    known = ordered.last_known(past, _KEYS).withColumnRenamed("last_value", "start").join(ordered.growth_volatility(past, _KEYS), _KEYS)
    ahead = rows.where("data_type = 'forecast'").join(known, _KEYS).withColumn("low", F.lit(-0.05)).withColumn("high", F.lit(0.06))
    out = ordered.capped_with_bounds(ahead, _KEYS, "start", "low", "high", "volatility")
    return out.select(*_KEYS, "period", r("adjusted", 6), r("lo"), r("hi"))


@query()
def growth_dampening_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ahead(spark, sf_dir).withColumn("low", F.lit(-0.05)).withColumn("high", F.lit(0.06)).withColumn("parent_growth", F.lit(0.02))
    out = ordered.growth_dampened(rows, _KEYS, "start", "last_period", "low", "high", "parent_growth", begin=1, full=4, weight=0.7)
    moved = ordered.bounds_moved(out.withColumn("lo", F.col("value") * 0.9).withColumn("hi", F.col("value") * 1.1))
    return moved.select(*_KEYS, "period", r("lo"), r("hi"))


ORACLES["growth_dampening_bounds"] = ORACLES["growth_dampening_fold"].replace(
    "SELECT entity, metric, period, round(adjusted, 4) AS adjusted FROM folded",
    "SELECT f.entity, f.metric, f.period, round(0.9::DOUBLE * a.value * f.adjusted / (a.value + 1e-10::DOUBLE), 4) AS lo, round(1.1::DOUBLE * a.value * f.adjusted / (a.value + 1e-10::DOUBLE), 4) AS hi FROM folded f JOIN ahead a USING (entity, metric, period)",
)


@query(
    f"""+ {_WIDE}, sides AS (SELECT entity, period, revenue AS a, orders AS b, period >= 1999 AS fa, period >= 2000 AS fb, CASE WHEN period >= 1999 THEN revenue * 0.2::DOUBLE / 3.92::DOUBLE ELSE revenue * 0.02::DOUBLE END AS sa,
      CASE WHEN period >= 2000 THEN orders * 0.3::DOUBLE / 3.92::DOUBLE ELSE orders * 0.02::DOUBLE END AS sb FROM cwide),
    w AS (SELECT *, a / b AS v, 1.96::DOUBLE * abs(a / b) * sqrt(pow(sa / a, 2) + pow(sb / b, 2)) AS w FROM sides)
    SELECT entity, period, round(v, 6) AS value, CASE WHEN fa OR fb THEN round(greatest(v - w, 0), 4) END AS lo, CASE WHEN fa OR fb THEN round(v + w, 4) END AS hi FROM w"""
)
def ratio_point_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    ahead = lambda c, at, by: F.when(F.col("period") >= at, F.col(c) * by)
    rows = _wide(spark, sf_dir).select(
        "entity", "period", F.col("revenue").alias("revenue_value"), F.col("orders").alias("orders_value"), ahead("revenue", 1999, 0.9).alias("revenue_lo"), ahead("revenue", 1999, 1.1).alias("revenue_hi"),
        ahead("orders", 2000, 0.85).alias("orders_lo"), ahead("orders", 2000, 1.15).alias("orders_hi"),
    )
    return derived.point_with_bounds(rows, "revenue", "orders").select("entity", "period", r("value", 6), r("lo"), r("hi"))


@query(
    """+ rows AS (SELECT entity, parent, period, value FROM cpanel WHERE metric = 'orders'), orig AS (SELECT * FROM rows WHERE (entity + period) % 3 <> 0 AND period <= 2000), ends AS (SELECT entity, max(period) AS e FROM orig GROUP BY 1),
    pv AS (SELECT parent, period, avg(value) AS pv FROM rows WHERE period <> 1996 GROUP BY 1, 2), grid AS (SELECT entity, parent, unnest(range(min(period), max(e) + 1)) AS period FROM rows JOIN ends USING (entity) WHERE period <= e GROUP BY 1, 2),
    near AS (SELECT g.entity, g.parent, g.period::INTEGER AS period, max(CASE WHEN o.period <= g.period THEN o.period END) AS p0, min(CASE WHEN o.period >= g.period THEN o.period END) AS p1 FROM grid g JOIN orig o ON o.entity = g.entity GROUP BY 1, 2, 3),
    line AS (SELECT n.*, CASE WHEN p0 = p1 THEN a.value ELSE a.value + (b.value - a.value) * (n.period - p0) / (p1 - p0) END AS line FROM near n LEFT JOIN orig a ON a.entity = n.entity AND a.period = p0 LEFT JOIN orig b ON b.entity = n.entity AND b.period = p1)
    SELECT entity, period, round(coalesce(line, pv), 4) AS value, CASE WHEN line IS NULL THEN 'parent' WHEN p0 = p1 THEN 'observed' ELSE 'interpolated' END AS data_quality FROM line LEFT JOIN pv USING (parent, period) WHERE coalesce(line, pv) IS NOT NULL"""
)
def rate_gap_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.customer_panel(spark, sf_dir).where("metric = 'orders'").drop("metric")
    parents = rows.where("period <> 1996").groupBy("parent", "period").agg(F.avg("value").alias("value"))
    out = hierarchy.rate_gaps_filled(rows, rows.where("(entity + period) % 3 <> 0 AND period <= 2000").select("entity", "period"), parents, ["entity"], "parent")
    return out.select("entity", F.col("period").cast("int").alias("period"), r("value"), "data_quality")


@query(
    """+ rows AS (SELECT entity, period, value, CASE WHEN entity % 2 = 0 THEN value * 0.9::DOUBLE END AS lo, CASE WHEN entity % 3 = 0 AND period % 2 = 0 THEN value * 1.1::DOUBLE END AS hi FROM cpanel WHERE metric = 'revenue'), win AS (SELECT * FROM rows WHERE period >= 1996),
    holes AS (SELECT entity, period FROM (SELECT entity, unnest(range(min(period), max(period) + 1)) AS period FROM win GROUP BY 1) g ANTI JOIN win USING (entity, period)),
    pick AS (SELECT h.entity, h.period, max(CASE WHEN w.period < h.period THEN w.period END) AS v0, min(CASE WHEN w.period > h.period THEN w.period END) AS v1, max(CASE WHEN w.period < h.period AND w.hi IS NOT NULL THEN w.period END) AS h0, min(CASE WHEN w.period > h.period AND w.hi IS NOT NULL THEN w.period END) AS h1,
      max(w.hi IS NOT NULL) AS any_hi FROM holes h JOIN win w ON w.entity = h.entity GROUP BY 1, 2),
    fine AS (SELECT p.entity, p.period, a.value + (b.value - a.value) * (p.period - v0) / (v1 - v0) AS value, CASE WHEN NOT any_hi THEN NULL WHEN h0 IS NULL OR h1 IS NULL THEN NULL ELSE c.hi + (d.hi - c.hi) * (p.period - h0) / (h1 - h0) END AS line_hi, any_hi, h0, h1, c.hi AS c_hi, d.hi AS d_hi
      FROM pick p JOIN win a ON a.entity = p.entity AND a.period = v0 JOIN win b ON b.entity = p.entity AND b.period = v1 LEFT JOIN win c ON c.entity = p.entity AND c.period = h0 LEFT JOIN win d ON d.entity = p.entity AND d.period = h1)
    SELECT entity, period::INTEGER AS period, round(value, 5) AS value, round(CASE WHEN entity % 2 = 0 THEN value * 0.9::DOUBLE ELSE value * 0.95::DOUBLE END, 5) AS lo, round(CASE WHEN NOT any_hi THEN value * 1.05::DOUBLE ELSE coalesce(line_hi, c_hi, d_hi) END, 5) AS hi, 'gap_fill_interpolate' AS method FROM fine
    UNION ALL SELECT entity, period, round(value, 5), round(lo, 5), round(hi, 5), NULL FROM rows"""
)
def inner_gap_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.customer_panel(spark, sf_dir).where("metric = 'revenue'").select("entity", "period", "value", F.when(F.col("entity") % 2 == 0, F.col("value") * 0.9).alias("lo"), F.expr("CASE WHEN entity % 3 = 0 AND period % 2 = 0 THEN value * 1.1D END").alias("hi"))
    out = hierarchy.inner_gaps_filled(rows, ["entity"], 1996)
    return out.select("entity", F.col("period").cast("int").alias("period"), r("value", 5), r("lo", 5), r("hi", 5), "method")


@query(
    f"""+ {_WIDE}, sides AS (SELECT *, orders + entity % 7 AS whole, 100 * orders / (orders + entity % 7) + CASE WHEN entity % 50 = 0 THEN 40 ELSE 0 END AS rate, revenue / orders * CASE WHEN entity % 100 = 0 THEN 1.02::DOUBLE ELSE 1 END AS stored FROM cwide),
    ends AS (SELECT entity, arg_max(100 * orders / whole, period) - arg_min(100 * orders / whole, period) AS drift, count(*) AS n FROM sides GROUP BY 1)
    SELECT "check", count(*) AS n, round(max(measured), 4) AS worst FROM (SELECT 'rate_against_count' AS "check", rate - 100 * orders / whole AS measured FROM sides WHERE abs(rate - 100 * orders / whole) > 30
      UNION ALL SELECT 'stored_stored', max(abs(100 * (stored - revenue / orders) / (revenue / orders))) FROM sides HAVING max(abs(100 * (stored - revenue / orders) / (revenue / orders))) > 1
      UNION ALL SELECT 'share_drift', drift FROM ends WHERE n >= 2 AND abs(drift) > 15) t GROUP BY 1"""
)
def coherence_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    sides = _wide(spark, sf_dir).withColumn("whole", F.expr("orders + entity % 7"))
    sides = sides.withColumn("rate", F.expr("100 * orders / whole + CASE WHEN entity % 50 = 0 THEN 40 ELSE 0 END")).withColumn("stored", F.expr("revenue / orders * CASE WHEN entity % 100 = 0 THEN 1.02D ELSE 1D END"))
    found = checks.all_of(
        checks.rate_against_count(sides, ["entity", "period"], "rate", "orders", "whole"), checks.stored_against_computed(sides, "stored", "revenue", "orders"), checks.share_drift(sides, ["entity"], "orders", "whole"),
    )
    return found.groupBy("check").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("measured"), 4).alias("worst"))


@query(" SELECT parent, metric, period, round(CASE metric WHEN 'orders' THEN avg(value) ELSE sum(value) END, 6) AS value, min(entity) AS entity FROM cpanel GROUP BY 1, 2, 3")
def mixed_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.by_class(fx.customer_panel(spark, sf_dir), ["parent", "metric", "period"], F.col("metric") == "orders", ["entity"]).select("parent", "metric", "period", r("value", 6), "entity")


@query(" SELECT parent, period, round(avg(value) FILTER (WHERE metric = 'revenue'), 6) AS revenue, round(avg(value) FILTER (WHERE metric = 'orders'), 6) AS orders FROM cpanel GROUP BY 1, 2")
def mean_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.by_metric_mean(fx.customer_panel(spark, sf_dir), ["parent", "period"], ["revenue", "orders"]).select("parent", "period", r("revenue", 6), r("orders", 6))


@query(
    f"""+ {_WIDE}, t AS (SELECT entity, period, revenue AS nominal, orders * 70001 AS real, 100 * revenue / (orders * 70001) * (1 + (entity % 5) * 0.015::DOUBLE) AS deflator FROM cwide), d AS (SELECT *, abs(nominal - real * deflator / 100) / nominal AS deviation FROM t)
    SELECT entity, period, round(deviation, 6) AS deviation, deviation > 0.02::DOUBLE AS violated, round(CASE WHEN deviation > 0.02::DOUBLE THEN nominal / real * 100 ELSE deflator END, 6) AS deflator FROM d"""
)
def identity_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _wide(spark, sf_dir).selectExpr("entity", "period", "revenue AS nominal", "orders * 70001 AS real", "100 * revenue / (orders * 70001) * (1 + (entity % 5) * 0.015D) AS deflator")
    return derived.identity_repaired(rows, "nominal", "real", "deflator", 0.02).select("entity", "period", r("deviation", 6), "violated", r("deflator", 6))


@query(
    """+ logs AS (SELECT entity, metric, period, ln(value) AS y, (row_number() OVER (PARTITION BY entity, metric ORDER BY period) - 1)::DOUBLE AS x FROM cpanel WHERE value > 0),
    fit AS (SELECT entity, metric, count(*) AS n, max(period) AS last, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, avg(x) AS mx, regr_sxx(y, x) AS sxx, regr_syy(y, x) AS syy, max(y) AS single FROM logs GROUP BY 1, 2),
    ahead AS (SELECT f.*, h, n - 1.0::DOUBLE + h AS xh, CASE WHEN n > 2 THEN greatest(syy - b * b * sxx, 0) / (n - 2) END AS s2, q FROM fit f CROSS JOIN (SELECT unnest([1, 2]) AS h) LEFT JOIN (VALUES (1, 12.7062::DOUBLE), (2, 4.3027), (3, 3.1824), (4, 2.7764), (5, 2.5706)) t(d, q) ON d = n - 2),
    w AS (SELECT *, a + b * xh AS c, q * sqrt(s2 * (1.0::DOUBLE / n + pow(xh - mx, 2) / sxx + 1)) AS w FROM ahead)
    SELECT entity, metric, (last + h)::INTEGER AS period, round(CASE WHEN n = 1 THEN single ELSE c END, 6) AS log_value, round(CASE WHEN n > 1 THEN c - w END, 6) AS log_lo, round(CASE WHEN n > 1 THEN c + w END, 6) AS log_hi, CASE WHEN n = 1 THEN 'flat_log' ELSE 'lintrend_log' END AS method FROM w"""
)
def log_trend_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = forecast.log_trend(fx.customer_panel(spark, sf_dir), _KEYS, 2)
    log = lambda c: F.round(F.log(c), 6).alias(f"log_{c}")
    return out.select(*_KEYS, F.col("period").cast("int").alias("period"), log("value"), log("lo"), log("hi"), "method")


@query(
    """+ steps AS (SELECT entity, period, value FROM cpanel WHERE metric = 'orders' AND period IN (1996, 1999)), grid AS (SELECT DISTINCT entity, unnest(range(1995, 2002))::INTEGER AS period FROM steps)
    SELECT g.entity, g.period, arg_max(s.value, s.period) AS value, arg_max(s.value, s.period) - 0.25::DOUBLE AS lo, arg_max(s.value, s.period) + 0.25::DOUBLE AS hi, 'assumed' AS method FROM grid g LEFT JOIN steps s ON s.entity = g.entity AND s.period <= g.period GROUP BY 1, 2"""
)
def assumed_policy_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = fx.customer_panel(spark, sf_dir).where("metric = 'orders' AND period IN (1996, 1999)").select("entity", "period", "value")
    grid = steps.select("entity").distinct().select("entity", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("period"))
    return forecast.assumed_path(grid, steps, ["entity"]).select("entity", "period", "value", "lo", "hi", "method")


@query(
    f"""+ {_WIDE}, base AS (SELECT entity, metric, period, CASE WHEN entity % 97 = 0 AND period = 1998 THEN NULL WHEN entity % 83 = 0 AND period = 1997 THEN -value ELSE value END AS value, CASE WHEN period >= 2000 THEN 'forecast' ELSE 'historical' END AS data_type,
      CASE WHEN period >= 2000 THEN value * CASE WHEN entity % 79 = 0 THEN 1.6::DOUBLE ELSE 0.4::DOUBLE END END AS lo, CASE WHEN period >= 2000 THEN value * CASE WHEN entity % 79 = 0 THEN 0.4::DOUBLE ELSE 1.6::DOUBLE END END AS hi FROM cpanel),
    rows AS (SELECT * FROM base UNION ALL SELECT * FROM base WHERE entity % 89 = 0 AND period = 1996),
    ends AS (SELECT entity, metric, max(period) FILTER (WHERE data_type = 'historical') AS a, min(period) FILTER (WHERE data_type = 'forecast') AS b FROM rows GROUP BY 1, 2),
    steps AS (SELECT value / nullif(lag(value) OVER (PARTITION BY entity, metric ORDER BY period), 0) - 1 AS g FROM cpanel), parts AS (SELECT orders * CASE WHEN entity % 73 = 0 THEN 1000000 ELSE 1 END AS part, revenue AS whole FROM cwide)
    SELECT "check", severity, count(*) AS n, round(max(measured), 4) AS worst FROM (
      SELECT 'nulls' AS "check", 'issue' AS severity, count(*)::DOUBLE AS measured FROM rows WHERE value IS NULL GROUP BY entity, metric UNION ALL
      SELECT 'duplicates', 'issue', count(*)::DOUBLE FROM rows GROUP BY entity, metric, period HAVING count(*) > 1 UNION ALL
      SELECT 'negatives', 'issue', value FROM rows WHERE value < 0 UNION ALL
      SELECT 'vintage_gap', 'issue', (b - a)::DOUBLE FROM ends WHERE b - a <> 1 UNION ALL
      SELECT 'interval_order', 'issue', value FROM rows WHERE lo > hi OR value < lo OR value > hi UNION ALL
      SELECT 'interval_width', 'warning', w FROM (SELECT quantile_cont(100 * (hi - lo) / abs(value), 0.9) AS w FROM rows GROUP BY metric) t WHERE w > 50 UNION ALL
      SELECT 'caps_honoured', 'issue', g FROM steps WHERE g > 0.061::DOUBLE OR g < -0.051::DOUBLE UNION ALL
      SELECT 'part_over_whole', 'issue', part / whole FROM parts WHERE part > whole UNION ALL
      SELECT 'part_of_whole', 'warning', part / whole FROM parts WHERE part / whole > 0.5) t GROUP BY 1, 2"""
)
def planted_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check on rows into which its fault was put, compiled into one pass."""
    ahead = lambda low, high: F.when(F.col("period") >= 2000, F.col("value") * F.when(F.col("entity") % 79 == 0, high).otherwise(low))
    # each row has its true value beside the faulty one, a revenue row its year's orders too; a repeated row is a copy without them
    part = F.max(F.when(F.col("metric") == "orders", F.col("value"))).over(Window.partitionBy("entity", "period"))
    rows = fx.customer_panel(spark, sf_dir).withColumn("part", part).select(
        "entity", "metric", "period", F.expr("CASE WHEN entity % 97 = 0 AND period = 1998 THEN NULL WHEN entity % 83 = 0 AND period = 1997 THEN -value ELSE value END AS value"),
        F.when(F.col("period") >= 2000, "forecast").otherwise("historical").alias("data_type"), ahead(0.4, 1.6).alias("lo"), ahead(1.6, 0.4).alias("hi"), F.col("value").alias("clean"),
        F.expr("CASE WHEN metric = 'revenue' THEN part * CASE WHEN entity % 73 = 0 THEN 1000000 ELSE 1 END END AS part"), F.explode(F.expr("sequence(0, CASE WHEN entity % 89 = 0 AND period = 1996 THEN 1 ELSE 0 END)")).alias("copy"),
    )
    only = lambda c: F.when(F.col("copy") == 0, F.col(c)).alias(c)
    rows = rows.select("entity", "metric", "period", "value", "data_type", "lo", "hi", only("clean"), only("part"), "copy")
    share, series, cell = F.col("part") / F.nullif(F.col("clean"), F.lit(0.0)), ["entity", "metric"], ["entity", "period"]
    s = cs.Suite().step("last", ["copy", *series], "period", F.col("clean"))
    s = cs.interval_order(cs.negatives(cs.duplicates(cs.nulls(s, series), [*series, "period"]), series), series)
    s = cs.interval_width(s, ["metric"], 50.0, checks.WARNING)
    s = s.group("vintage_gap", series, {"a": (F.max, F.when(F.col("data_type") == "historical", F.col("period"))), "b": (F.min, F.when(F.col("data_type") == "forecast", F.col("period")))}, lambda a: a["b"] - a["a"] != 1, lambda a: a["b"] - a["a"], 1)
    s = cs.change(s, "caps_honoured", [*series, "period"], F.col("clean"), F.col("last"), -0.05, 0.06, slack=0.001)
    s = s.row("part_over_whole", cell, F.col("part") > F.col("clean"), share, 1.0).row("part_of_whole", cell, (share < 0) | (share > 0.5), share, 0.5, checks.WARNING)
    found = s.run(rows)
    return found.groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("measured"), 4).alias("worst"))


@query(
    """+ n AS (SELECT parent AS entity, metric, period, sum(value) * CASE WHEN parent = 'NATION_3' THEN 1.01::DOUBLE ELSE 1 END AS v FROM cpanel GROUP BY 1, 2, 3), a AS (SELECT metric, period, sum(value) AS customers FROM cpanel GROUP BY 1, 2), b AS (SELECT metric, period, sum(v) AS nations FROM n GROUP BY 1, 2),
    c AS (SELECT metric, period, sum(v) AS regions FROM n JOIN geo USING (entity) GROUP BY 1, 2)
    SELECT metric, period, round(customers, 4) AS customers, round(nations, 4) AS nations, round(regions, 4) AS regions, round(greatest(abs(nations - customers), abs(regions - customers)) / abs(customers), 8) AS spread FROM a JOIN b USING (metric, period) JOIN c USING (metric, period)"""
)
def uneven_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three levels, each from its own table; one nation's total is off by a hundredth."""
    rows = fx.customer_panel(spark, sf_dir)
    nations = rollup.summed(rows, ["parent", "metric", "period"]).withColumn("value", F.col("value") * F.when(F.col("parent") == "NATION_3", 1.01).otherwise(1.0))
    regions = nations.withColumnRenamed("parent", "entity").join(fx.geography(spark, sf_dir), "entity")
    out = hierarchy.cascade([("customers", rows), ("nations", nations), ("regions", rollup.summed(regions, ["parent", "metric", "period"]))], ["metric", "period"])
    return out.select("metric", "period", r("customers"), r("nations"), r("regions"), r("spread", 8))


@query(
    """+ rows AS (SELECT *, value * 1.2::DOUBLE AS hi, CASE WHEN entity % 4 = 0 THEN value * 1.02::DOUBLE END AS cap FROM cpanel WHERE period >= 2000), pv AS (SELECT parent, metric, period, sum(value) * 1.1::DOUBLE AS pv FROM rows GROUP BY 1, 2, 3),
    one AS (SELECT r.* EXCLUDE (value, hi), pv, value * (pv / sum(value) OVER w) AS value, hi * (pv / sum(value) OVER w) AS hi FROM rows r JOIN pv USING (parent, metric, period) WINDOW w AS (PARTITION BY parent, metric, period)),
    two AS (SELECT * EXCLUDE (value, hi), CASE WHEN value > cap THEN cap ELSE value END AS value, CASE WHEN value > cap THEN least(hi, cap * 1.2::DOUBLE) ELSE hi END AS hi FROM one),
    three AS (SELECT *, coalesce(value >= cap, false) AS fixed, coalesce(sum(value) FILTER (WHERE value >= cap) OVER w, 0) AS held, coalesce(sum(value) FILTER (WHERE NOT coalesce(value >= cap, false)) OVER w, 0) AS free FROM two WINDOW w AS (PARTITION BY parent, metric, period)),
    done AS (SELECT *, CASE WHEN NOT fixed AND free > 0 AND pv - held > 0 THEN (pv - held) / free ELSE 1 END AS scale FROM three)
    SELECT entity, metric, period, round(value * scale, 4) AS value, round(hi * scale, 4) AS hi FROM done"""
)
def reconciled_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.customer_panel(spark, sf_dir).where("period >= 2000").withColumn("hi", F.col("value") * 1.2).withColumn("cap", F.when(F.col("entity") % 4 == 0, F.col("value") * 1.02))
    parents = rows.groupBy("parent", "metric", "period").agg((F.sum("value") * 1.1).alias("parent_value"))
    out = hierarchy.reconciled(rows, parents, ["parent", "metric", "period"], ["value", "hi"], "cap")
    return out.select(*_KEYS, "period", r("value"), r("hi"))


@query(
    """+ rows AS (SELECT entity, parent, period, value FROM cpanel WHERE metric = 'orders'), last AS (SELECT entity, parent, count(*) AS n, arg_max(value, period) AS value FROM rows GROUP BY 1, 2), pv AS (SELECT parent, avg(value) AS value FROM last GROUP BY 1),
    kids AS (SELECT entity, value + k AS value, (entity + k) % 4 AS weight FROM last, range(0, 3) t(k) WHERE entity % 3 = 0 AND k <= entity % 2), grown AS (SELECT entity, count(*) AS n, sum(value * weight) / sum(weight) AS value FROM kids WHERE weight > 0 GROUP BY 1)
    SELECT l.entity, round(CASE WHEN s.n IS NOT NULL THEN s.value WHEN l.n >= 6 THEN l.value ELSE pv.value END, 6) AS value, CASE WHEN s.n = 1 THEN 'copied' WHEN s.n > 1 THEN 'weighted' WHEN l.n >= 6 THEN 'own' ELSE 'inherited' END AS method
    FROM last l LEFT JOIN grown s USING (entity) JOIN pv ON pv.parent = l.parent"""
)
def rate_dispatching(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.customer_panel(spark, sf_dir).where("metric = 'orders'")
    last = rows.groupBy("entity", "parent").agg(F.count(F.lit(1)).alias("n"), F.max_by("value", "period").alias("value"))
    kids = last.where("entity % 3 = 0").select("entity", "value", F.explode(F.expr("sequence(0, cast(entity % 2 AS int))")).alias("k")).selectExpr("entity", "value + k AS value", "(entity + k) % 4 AS weight")
    parents = last.groupBy("parent").agg(F.avg("value").alias("value"))
    return hierarchy.rate_dispatch(last, kids, parents, "entity", "parent", least=6).select("entity", r("value", 6), "method")
