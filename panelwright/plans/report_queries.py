"""Queries for reports: what changed and who hears of it, histories' quality, units, plausibility, names, vintages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators import audit, derived, export, forecast, ordered, panel, rollup
from panelwright.operators import check_suite as cs
from panelwright.plans import fixtures as fx
from panelwright.plans.customer_queries import _WIDE, _wide
from panelwright.plans.panel_queries import r
from panelwright.plans.registry import query

_KEYS = ["entity", "metric"]


@query(
    """+ reg AS (SELECT parent AS source, metric || CASE WHEN entity LIKE '%4' THEN ' (all)' ELSE '' END AS indicator, sum(value) FILTER (WHERE period = 2000) AS now, sum(value) FILTER (WHERE period = 1999) AS before, max(period) FILTER (WHERE value > 0) AS max_period FROM panel GROUP BY 1, 2)
    SELECT replace(indicator, ' (all)', '') AS indicator, CASE source WHEN 'ASIA' THEN 'East' WHEN 'EUROPE' THEN 'West' ELSE 'Americas' END AS place, bool_or(now > before) AS changed, max(max_period) AS max_period FROM reg WHERE source IN ('ASIA', 'EUROPE', 'AMERICA') GROUP BY 1, 2"""
)
def indicator_overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which indicators changed where: a region's total of 2000 that is over that of 1999 stands for a new hash."""
    named = fx.panel(spark, sf_dir).withColumn("indicator", F.concat("metric", F.when(F.col("entity").like("%4"), " (all)").otherwise("")))
    of = lambda year: F.sum(F.when(F.col("period") == year, F.col("value")))
    sums = named.groupBy(F.col("parent").alias("source"), "indicator").agg(of(2000).alias("now"), of(1999).alias("before"), F.max(F.when(F.col("value") > 0, F.col("period"))).alias("max_period"))
    registry = sums.withColumn("hash", F.when(F.col("now") > F.col("before"), "new").otherwise("old")).withColumn("previous_hash", F.lit("old"))
    out = audit.change_overlay(registry, {"ASIA": "East", "EUROPE": "West", "AMERICA": "Americas"}, {"revenue (all)": "revenue", "orders (all)": "orders"})
    return out.select("indicator", "place", "changed", "max_period")


@query(" SELECT c_name FROM customer WHERE c_acctbal > 0 AND (c_mktsegment = 'BUILDING' OR c_mktsegment = 'MACHINERY')")
def report_recipients(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = fx.table(spark, sf_dir, "customer").selectExpr("c_name", "c_acctbal > 0 AS enabled", "c_mktsegment = 'BUILDING' AS weekly_report", "c_mktsegment = 'MACHINERY' AS failures_only")
    return audit.recipients(people, failed=True).select("c_name")


@query(
    """+ h AS (SELECT entity, metric, period, period - lag(period) OVER (PARTITION BY entity, metric ORDER BY period) AS step FROM cpanel WHERE (entity + period) % 4 <> 0), s AS (SELECT entity, metric, count(*) FILTER (WHERE step > 1) AS gaps, count(*) AS n FROM h GROUP BY 1, 2)
    SELECT count(*) AS n_series, sum(gaps)::BIGINT AS n_gaps, round(avg(n), 6) AS mean_history FROM s"""
)
def history_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.customer_panel(spark, sf_dir).where("(entity + period) % 4 <> 0")
    return forecast.history_quality(rows, _KEYS).select("n_series", "n_gaps", r("mean_history", 6))


@query(f"+ {_WIDE} SELECT entity, period, round(CASE WHEN revenue / orders < 100000 THEN revenue / orders * 1000 ELSE revenue / orders END, 4) AS value FROM cwide WHERE orders > 0")
def rescaled_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A ratio brought to one unit, with the unit's check."""
    ratio = derived.magnitude_rescaled(F.col("revenue") / F.col("orders"), 100_000, 1000)
    return _wide(spark, sf_dir).where("orders > 0").select("entity", "period", F.round(derived.unit_checked(ratio, 1e9), 4).alias("value"))


@query(
    f"""+ {_WIDE}, d AS (SELECT entity, parent, period, CASE WHEN entity % 41 = 0 THEN NULL WHEN entity % 43 = 0 THEN 'NaN'::DOUBLE WHEN entity % 47 = 0 THEN -1.0::DOUBLE ELSE revenue / orders END AS v, revenue, orders FROM cwide),
    n AS (SELECT parent, period, sum(revenue) / sum(orders) AS q FROM cwide GROUP BY 1, 2), g AS (SELECT 100 * (q / lag(q) OVER (PARTITION BY parent ORDER BY period) - 1) AS g FROM n), t AS (SELECT max(revenue) AS rev, max(orders) AS ord FROM cwide WHERE period = 2001)
    SELECT "check", count(*) AS n FROM (SELECT 'missing' AS "check" FROM d WHERE v IS NULL OR isnan(v) UNION ALL SELECT 'negative' FROM d WHERE v < 0 UNION ALL SELECT 'implausible' FROM d WHERE v IS NOT NULL AND NOT isnan(v) AND v >= 0 AND (v < 60000 OR v > 400000)
      UNION ALL SELECT 'ratio_growth' FROM g WHERE g < -5 OR g > 10 UNION ALL SELECT 'terminal_revenue' FROM t WHERE rev > 500000 UNION ALL SELECT 'terminal_orders' FROM t WHERE ord > 1e9) x GROUP BY 1"""
)
def derived_plausibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Derived values, growth of a ratio and the terminal year's largest values, faults planted, in one pass each."""
    wide = _wide(spark, sf_dir)
    rows = wide.withColumn("v", F.expr("CASE WHEN entity % 41 = 0 THEN NULL WHEN entity % 43 = 0 THEN double('NaN') WHEN entity % 47 = 0 THEN -1D ELSE revenue / orders END"))
    own = cs.plausible(cs.Suite(), ["entity", "period"], F.col("v"), 60_000.0, 400_000.0)
    nations = wide.groupBy("parent", "period").agg((F.sum("revenue") / F.sum("orders")).alias("q"))
    ratio = cs.growth_of_ratio(cs.Suite().step("last", ["parent"], "period", F.col("q")), ["parent", "period"], F.col("q"), F.col("last"))
    largest = cs.terminal(cs.Suite(), [], 2001, {"revenue": 500_000, "orders": 1e9})
    found = own.run(rows).unionByName(ratio.run(nations)).unionByName(largest.run(fx.customer_panel(spark, sf_dir)))
    return found.groupBy("check").agg(F.count(F.lit(1)).alias("n"))


@query(" SELECT c_custkey, c_nationkey, n_name AS name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 2")
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of known nations, with the nations' own names for whatever they were called."""
    rows = fx.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.concat(F.lit("nation "), F.col("c_nationkey")).alias("name"))
    names = fx.table(spark, sf_dir, "nation").where("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("name"))
    return panel.canonical(rows, names, "c_nationkey", "name")


@query(
    """+ f AS (SELECT entity, metric, period, value, DATE '2020-01-01' AS forecast_run_date FROM split WHERE period >= 2000 UNION ALL SELECT entity, metric, period, value * 1.01::DOUBLE, DATE '2021-01-01' FROM split WHERE period >= 2000)
    SELECT entity, metric, period, round(value, 5) AS value, NULL::DATE AS forecast_run_date FROM split WHERE period < 2000 UNION ALL SELECT entity, metric, period, round(value, 5), forecast_run_date FROM f"""
)
def all_vintages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History and the forecasts of two runs."""
    rows = fx.panel(spark, sf_dir).select("entity", "metric", "period", "value")
    ahead = rows.where("period >= 2000")
    runs = ahead.withColumn("forecast_run_date", F.lit("2020-01-01").cast("date")).unionByName(ahead.withColumn("value", F.col("value") * 1.01).withColumn("forecast_run_date", F.lit("2021-01-01").cast("date")))
    return export.vintages(rows.where("period < 2000"), runs).select("entity", "metric", "period", r("value", 5), "forecast_run_date")


@query(" SELECT parent, period, round(sum(value * (1 + entity % 9)) / sum(1 + entity % 9), 9) AS value FROM cpanel WHERE metric = 'orders' GROUP BY 1, 2")
def weighted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.customer_panel(spark, sf_dir).where("metric = 'orders'")
    return rows.groupBy("parent", "period").agg(F.round(rollup.weighted_mean(F.col("value"), 1 + F.col("entity") % 9), 9).alias("value"))


@query(
    """+ c AS (SELECT entity, metric, period, CASE metric WHEN 'orders' THEN value - lag(value) OVER w ELSE 100 * (value - lag(value) OVER w) / nullif(lag(value) OVER w, 0) END AS change FROM cpanel WINDOW w AS (PARTITION BY entity, metric ORDER BY period))
    SELECT entity, metric, period, round(change, 6) AS change FROM c WHERE change < -60 OR change > 250"""
)
def changes_out_of_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    changed = ordered.year_on_year(fx.customer_panel(spark, sf_dir), _KEYS, ["orders"])
    return ordered.outside(changed, "change", -60, 250).select(*_KEYS, "period", r("change", 6))


@query(
    """+ wide AS (SELECT entity, period, max(value) FILTER (WHERE metric = 'revenue') AS a, max(value) FILTER (WHERE metric = 'orders') AS b FROM panel GROUP BY 1, 2), u AS (SELECT entity, period, a, b, i, (('0x' || substr(md5(concat_ws(':', entity, period, 42, i, 1)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u1,
      (('0x' || substr(md5(concat_ws(':', entity, period, 42, i, 2)), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u2 FROM wide, range(1, 401) t(i)),
    n AS (SELECT *, sqrt(-2 * ln(u1)) * cos(2 * pi() * u2) AS x, sqrt(-2 * ln(u1)) * sin(2 * pi() * u2) AS y FROM u), d AS (SELECT entity, period, (a + a * 0.05::DOUBLE * x) AS top, b + b * 0.02::DOUBLE * (0.7::DOUBLE * x + sqrt(1 - 0.7::DOUBLE * 0.7::DOUBLE) * y) AS bottom FROM n),
    q AS (SELECT entity, period, top / bottom AS q FROM d WHERE top > 0 AND bottom > 0), s AS (SELECT *, avg(q) OVER w AS m, stddev_pop(q) OVER w AS s FROM q WINDOW w AS (PARTITION BY entity, period))
    SELECT entity, period, round(avg(q), 3) AS mc_value, round(quantile_cont(q, 0.025), 3) AS mc_lo, round(quantile_cont(q, 0.975), 3) AS mc_hi FROM s WHERE abs(q - m) <= 5 * s GROUP BY 1, 2"""
)
def drawn_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simulated ratios of correlated sides, from draws that SQL repeats."""
    of = lambda m: F.max(F.when(F.col("metric") == m, F.col("value")))
    wide = fx.panel(spark, sf_dir).groupBy("entity", "period").agg(of("revenue").alias("a"), of("orders").alias("b"))
    rows = wide.withColumn("sa", F.col("a") * 0.05).withColumn("sb", F.col("b") * 0.02)
    return derived.drawn_ratio(rows, ["entity", "period"], draws=400, rho=0.7).select("entity", "period", r("mc_value", 3), r("mc_lo", 3), r("mc_hi", 3))
