"""Queries over the driver's tables for the operators on panels, roll-ups, ordered series and hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions.scalars import clip, fiscal_year, parse_period, ratio, strip_prefix, to_number
from panelwright.operators import export, hierarchy, ordered, panel, rollup
from panelwright.plans import fixtures as fx
from panelwright.plans.registry import query
from panelwright.sources import tables


def r(c: str | Column, places: int = 4) -> Column:
    out = F.round(F.col(c) if isinstance(c, str) else c, places)
    return out.alias(c) if isinstance(c, str) else out


# sources


@query(" SELECT r_name AS code, {'n': n} AS attributes FROM (SELECT r_name, count(*)::VARCHAR AS n FROM geo JOIN region ON parent = r_name GROUP BY 1) t".replace("{'n': n} AS attributes", "n AS attributes"))
def geo_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = fx.geography(spark, sf_dir).groupBy(F.col("parent").alias("code")).agg(F.count(F.lit(1)).cast("string").alias("value")).withColumn("key", F.lit("n"))
    return tables.attribute_map(facts, "code", "key", "value").select("code", F.col("attributes")["n"].alias("attributes"))


@query(
    """ SELECT entity, metric, round(value, 4) AS value FROM panel JOIN (VALUES ('revenue', 'turnover'), ('orders', 'volume')) c(statistic, name) ON metric = statistic
    WHERE period IN (1996, 1997) AND entity <> 'NATION_0'""".replace("SELECT entity, metric,", "SELECT entity, name AS metric, period,")
)
def cube_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    cube = fx.panel(spark, sf_dir).withColumnRenamed("metric", "statistic")
    codes = spark.createDataFrame([("revenue", "turnover"), ("orders", "volume")], "statistic string, metric string")
    out = tables.read_cube(cube, {"period": [1996, 1997]}, F.broadcast(codes), "entity", "statistic", ("NATION_0",))
    return out.select("entity", "metric", "period", r("value"))


@query(" SELECT entity, period, round(value, 4) AS value FROM panel WHERE metric = 'revenue' AND period BETWEEN 1996 AND 1998")
def wide_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).where("metric = 'revenue'")
    wide = panel.by_period(rows, ["entity"], [1996, 1997, 1998])
    years = wide.toDF(*[c.removeprefix("y") if c != "entity" else c for c in wide.columns])
    return tables.wide_to_long(years, ["entity"]).select("entity", "period", r("value"))


@query(
    """+ new AS (SELECT entity, metric, period, value * 2 AS value FROM panel WHERE period = 2001)
    SELECT entity, metric, period, round(value, 4) AS value FROM panel WHERE period <> 2001 UNION ALL SELECT entity, metric, period, round(value, 4) FROM new"""
)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = fx.panel(spark, sf_dir).select("entity", "metric", "period", "value")
    new = old.where("period = 2001").withColumn("value", F.col("value") * 2)
    return tables.upserted(old, new, ["entity", "metric", "period"]).select("entity", "metric", "period", r("value"))


@query(" SELECT entity, metric, period, data_type FROM split WHERE data_type = 'forecast'")
def forecast_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables.forecast_view(fx.split(fx.panel(spark, sf_dir)), "panel_forecast_only")
    return spark.table("panel_forecast_only").select("entity", "metric", "period", "data_type")


@query(" SELECT entity, metric, period, round(value, 4) AS value FROM panel WHERE period = (SELECT max(period) FROM panel)")
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.latest_run(fx.panel(spark, sf_dir), "period").select("entity", "metric", "period", r("value"))


# cleaning


@query(
    """+ raw AS (SELECT entity AS code, concat(period, '-', lpad(((period + 1) % 100)::VARCHAR, 2, '0')) AS label, CASE WHEN period % 3 = 0 THEN '..' ELSE round(value, 2)::VARCHAR END AS obs FROM panel WHERE metric = 'revenue')
    SELECT code AS entity, substr(label, 1, 4)::INTEGER AS period, TRY_CAST(obs AS DOUBLE) AS value, 'GBP' AS unit FROM raw WHERE TRY_CAST(obs AS DOUBLE) IS NOT NULL"""
)
def tidy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).where("metric = 'revenue'")
    label = F.concat(F.col("period").cast("string"), F.lit("-"), F.lpad(((F.col("period") + 1) % 100).cast("string"), 2, "0"))
    raw = rows.select(F.col("entity").alias("GEOGRAPHY_CODE"), label.alias("DATE"), F.when(F.col("period") % 3 == 0, "..").otherwise(F.round("value", 2).cast("string")).alias("OBS_VALUE"))
    return panel.tidy(raw, ["code", "GEOGRAPHY_CODE"], ["DATE"], ["value", "OBS_VALUE"], {"unit": "GBP"})


@query(
    """+ raw AS (SELECT DISTINCT o_orderdate::DATE AS d FROM orders)
    SELECT d::VARCHAR AS d, strftime(d, '%Y-%m') AS m_period, 'M' AS m_freq, concat(year(d), '-Q', quarter(d)) AS q_period, 'Q' AS q_freq, year(d)::VARCHAR AS a_period, 'A' AS a_freq, strftime(d, '%Y-%m-%d') AS d_period, 'D' AS d_freq, 'n/a' AS u_period, 'U' AS u_freq,
           strftime(d, '%Y-%m') AS w_period, 'M3' AS w_freq FROM raw"""
)
def period_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = fx.table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    month = lambda c: F.upper(F.date_format(c, "MMM"))
    labels = {
        "m": F.concat(month("d"), F.lit(" "), F.date_format("d", "yy")), "q": F.concat(F.lit("Q"), F.quarter("d"), F.lit(" "), F.year("d")), "a": F.year("d").cast("string"), "d_": F.date_format("d", "yyyy-MM-dd"), "u": F.lit("n/a"),
        "w": F.concat(month(F.add_months("d", -1)), F.lit("-"), month(F.add_months("d", 1)), F.lit(" "), F.year("d")),
    }
    parsed = d.select("d", *[parse_period(v).alias(k) for k, v in labels.items()])
    return parsed.select(F.col("d").cast("string").alias("d"), *[F.col(f"{k}.{f}").alias(f"{k.strip('_')}_{f}") for k in labels for f in ("period", "freq")])


@query(" SELECT metric, count(*) AS n FROM panel WHERE metric = 'orders' OR value > 0 GROUP BY 1")
def plausible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.plausible(fx.panel(spark, sf_dir), ["orders"], "> 0").groupBy("metric").agg(F.count(F.lit(1)).alias("n"))


@query(" SELECT CASE entity WHEN 'NATION_1' THEN 'NATION_2' WHEN 'NATION_3' THEN 'NATION_4' ELSE entity END AS entity, metric, period, round(sum(value), 4) AS value FROM panel GROUP BY 1, 2, 3")
def recode(spark: SparkSession, sf_dir: str) -> DataFrame:
    map_ = spark.createDataFrame([("NATION_1", "NATION_2"), ("NATION_3", "NATION_4")], "old string, new string")
    return panel.recode(fx.panel(spark, sf_dir), map_, "entity", ["value"], ["entity", "metric", "period"]).select("entity", "metric", "period", r("value"))


@query(" SELECT count(*) AS n, count(*) FILTER (WHERE parent <> 'ASIA') AS matched, round(avg(CASE WHEN parent <> 'ASIA' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS rate FROM panel")
def match_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = fx.geography(spark, sf_dir).where("parent <> 'ASIA'").select("entity")
    return panel.match_rate(fx.panel(spark, sf_dir), codes, "entity").select("n", "matched", r("rate", 6))


@query(" SELECT entity, period FROM panel WHERE metric = 'orders' AND starts_with(entity, 'NATION_1') AND parent <> 'ASIA'")
def known_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).where("metric = 'orders'")
    codes = fx.geography(spark, sf_dir).where("parent <> 'ASIA'").select("entity")
    text = panel.filter_if_any(panel.filter_if_any(rows, F.col("entity").rlike("(?i)nation_1")), F.col("entity").contains("nothing like it"))
    return panel.known_codes(text, codes, "entity").select("entity", "period")


@query(
    """+ f AS (SELECT entity, metric, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM panel GROUP BY 1, 2)
    SELECT entity, metric, period, round(CASE WHEN n >= 5 AND q3 > q1 THEN least(greatest(value, q1 - 0.5 * (q3 - q1)), q3 + 0.5 * (q3 - q1)) ELSE value END, 4) AS value FROM panel JOIN f USING (entity, metric)"""
)
def winsorise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.winsorise(fx.panel(spark, sf_dir), ["entity", "metric"], k=0.5).select("entity", "metric", "period", r("value"))


@query(
    """ SELECT DISTINCT entity, CASE WHEN entity LIKE 'NATION\\_%' ESCAPE '\\' THEN substr(entity, 8) ELSE entity END AS short, TRY_CAST(substr(entity, 8) AS DOUBLE) AS number,
    CASE WHEN TRY_CAST(substr(entity, 8) AS DOUBLE) > 0 THEN 100 / TRY_CAST(substr(entity, 8) AS DOUBLE) END AS per, least(greatest(TRY_CAST(substr(entity, 8) AS DOUBLE), 2), 20) AS clipped FROM geo"""
)
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = strip_prefix(F.col("entity"), "NATION_")
    g = fx.geography(spark, sf_dir).select("entity", short.alias("short"), to_number(short).alias("number"))
    return g.select("entity", "short", "number", ratio(F.lit(100.0), F.col("number")).alias("per"), clip(F.col("number"), 2, 20).alias("clipped"))


# roll-ups


_ROLLUP = """+ sums2 AS (SELECT parent, period, sum(CASE WHEN metric = 'revenue' THEN value END) AS revenue, sum(CASE WHEN metric = 'orders' THEN value END) AS orders FROM panel GROUP BY 1, 2),
    rate AS (SELECT parent, period, sum(value * weight) / sum(weight) AS discount FROM rates GROUP BY 1, 2)
    SELECT parent, period, round(revenue, 2) AS revenue, orders, round(discount, 6) AS discount, round(CASE WHEN orders > 0 THEN revenue / orders END, 4) AS revenue_per_order FROM sums2 JOIN rate USING (parent, period)"""


@query(_ROLLUP)
def rollup_with_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: additive metrics summed, a rate weighted, and their ratio, by region and year."""
    sums = rollup.summed(fx.panel(spark, sf_dir), ["parent", "metric", "period"])
    wide = panel.by_metric(sums, ["parent", "period"], ["revenue", "orders"], ["value"])
    rate = rollup.weighted_rate(fx.rates(spark, sf_dir), ["parent", "period"]).withColumnRenamed("value", "discount")
    out = wide.join(rate, ["parent", "period"])
    return out.select("parent", "period", r("revenue_value", 2).alias("revenue"), F.col("orders_value").alias("orders"), r("discount", 6), r(ratio(F.col("revenue_value"), F.col("orders_value"))).alias("revenue_per_order"))


@query(
    """+ w AS (SELECT entity, period, weight FROM rates WHERE period BETWEEN 1997 AND 1999),
    j AS (SELECT r.parent, r.period, r.value, w.weight, CASE WHEN r.period % 2 = 0 THEN 'interpolated' ELSE 'ONS' END AS q FROM rates r LEFT JOIN w ON w.entity = r.entity AND w.period = least(greatest(r.period, 1997), 1999))
    SELECT parent, period, round(sum(value * weight) / nullif(sum(weight), 0), 6) AS value, CASE WHEN bool_or(q = 'interpolated') THEN 'interpolated' ELSE min(q) END AS data_quality FROM j WHERE weight IS NOT NULL GROUP BY 1, 2"""
)
def clamped_weighted_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = fx.rates(spark, sf_dir)
    weights = rates.where("period BETWEEN 1997 AND 1999").select("entity", "period", "weight")
    marked = rates.drop("weight").withColumn("data_quality", F.when(F.col("period") % 2 == 0, "interpolated").otherwise("ONS"))
    out = rollup.weighted_rate(rollup.clamped_weights(marked, weights), ["parent", "period"], quality="data_quality")
    return out.select("parent", "period", r("value", 6), "data_quality")


@query(
    """+ t AS (SELECT *, value / sum(value) OVER (PARTITION BY parent, metric, period) AS share, max(period) OVER () AS last FROM panel),
    s AS (SELECT parent, metric, entity, avg(share) AS m, stddev_samp(share) AS sd, count(share) AS n FROM t WHERE period > last - 5 GROUP BY 1, 2, 3)
    SELECT parent, metric, entity, round(m / sum(m) OVER (PARTITION BY parent, metric), 8) AS share, round(sd, 8) AS share_std, n AS share_years FROM s"""
)
def trailing_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = rollup.shares(fx.panel(spark, sf_dir), ["parent", "metric", "period"])
    stats = rollup.share_statistics(rollup.trailing(shares, 5, []), ["parent", "metric", "entity"])
    return rollup.normalised(stats, ["parent", "metric"]).select("parent", "metric", "entity", r("share", 8), r("share_std", 8), "share_years")


@query(" SELECT count(*) AS n, count(*) FILTER (WHERE lo IS NULL) AS null_lo, count(*) FILTER (WHERE value IS NULL) AS null_value FROM split")
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.null_counts(fx.split(fx.panel(spark, sf_dir)), ["lo", "value"])


@query(" SELECT parent, count(DISTINCT entity) AS entities, count(DISTINCT period) AS periods, max(entity) AS any_entity, max(period) AS last_period, count(*) AS n FROM panel GROUP BY 1")
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.panel(spark, sf_dir).groupBy("parent").agg(F.countDistinct("entity").alias("entities"), F.countDistinct("period").alias("periods"), F.max("entity").alias("any_entity"), F.max("period").alias("last_period"), F.count(F.lit(1)).alias("n"))


@query(" SELECT parent, min(entity) AS child FROM geo WHERE parent <> 'ASIA' OR entity = (SELECT min(entity) FROM geo WHERE parent = 'ASIA') GROUP BY 1 HAVING count(DISTINCT entity) = 1")
def only_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = fx.geography(spark, sf_dir)
    first = g.where("parent = 'ASIA'").agg(F.min("entity").alias("entity"))
    return rollup.only_children(g.where("parent <> 'ASIA'").unionByName(g.join(F.broadcast(first), "entity")), "parent", "entity")


@query(" SELECT metric, round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.9), 4) AS p90, round(avg(value), 4) AS mean, round(min(value), 4) AS low, round(max(value), 4) AS high FROM panel GROUP BY 1")
def quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = lambda q: F.round(F.percentile("value", F.lit(q)), 4)
    return fx.panel(spark, sf_dir).groupBy("metric").agg(p(0.5).alias("median"), p(0.9).alias("p90"), F.round(F.avg("value"), 4).alias("mean"), F.round(F.min("value"), 4).alias("low"), F.round(F.max("value"), 4).alias("high"))


@query(" SELECT a.entity, round(corr(a.value, b.value), 6) AS r FROM panel a JOIN panel b ON a.entity = b.entity AND a.period = b.period AND a.metric = 'revenue' AND b.metric = 'orders' GROUP BY 1 HAVING count(*) > 5")
def correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = panel.by_metric(fx.panel(spark, sf_dir), ["entity", "period"], ["revenue", "orders"], ["value"]).dropna()
    return wide.groupBy("entity").agg(F.round(F.corr("revenue_value", "orders_value"), 6).alias("r"), F.count(F.lit(1)).alias("n")).where("n > 5").select("entity", "r")


# pivots, duplicates and set operators


@query(" SELECT entity, metric, " + ", ".join(f"round(min(CASE WHEN period = {p} THEN value END), 4) AS y{p}" for p in range(1995, 2002)) + " FROM panel GROUP BY 1, 2")
def pivot_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = panel.by_period(fx.panel(spark, sf_dir), ["entity", "metric"], list(range(1995, 2002)))
    return wide.select("entity", "metric", *[r(f"y{p}") for p in range(1995, 2002)])


@query(" SELECT entity, period, round(max(CASE WHEN metric = 'revenue' THEN value END), 4) AS revenue_value, max(CASE WHEN metric = 'revenue' THEN data_type END) AS revenue_data_type, max(CASE WHEN metric = 'orders' THEN value END) AS orders_value, max(CASE WHEN metric = 'orders' THEN data_type END) AS orders_data_type FROM split GROUP BY 1, 2")
def pivot_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = panel.by_metric(fx.split(fx.panel(spark, sf_dir)), ["entity", "period"], ["revenue", "orders"], ["value", "data_type"])
    return wide.withColumn("revenue_value", F.round("revenue_value", 4))


@query(" SELECT entity, metric, period, round(value, 4) AS value FROM panel")
def unpivot_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = list(range(1995, 2002))
    wide = panel.by_period(fx.panel(spark, sf_dir), ["entity", "metric"], years)
    return panel.unpivoted(wide, ["entity", "metric"], years).select("entity", "metric", "period", r("value"))


@query(
    """+ stacked AS (SELECT entity, metric, period, value, data_type FROM split UNION ALL SELECT entity, metric, period, value * 1.1::DOUBLE, 'derived' FROM split WHERE period >= 1998)
    SELECT entity, metric, period, round(value, 4) AS value, data_type FROM (SELECT *, row_number() OVER (PARTITION BY entity, metric, period ORDER BY CASE data_type WHEN 'historical' THEN 0 WHEN 'forecast' THEN 1 WHEN 'derived' THEN 2 ELSE 3 END, value) AS n FROM stacked) t WHERE n = 1"""
)
def historical_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).select("entity", "metric", "period", "value", "data_type")
    more = rows.where("period >= 1998").withColumn("value", F.col("value") * 1.1).withColumn("data_type", F.lit("derived"))
    return panel.historical_wins(rows.unionByName(more), ["entity", "metric", "period"], ["value"]).select("entity", "metric", "period", r("value"), "data_type")


@query(" SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) t WHERE n = 1")
def keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.ranked_first(fx.table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select("o_custkey", "o_orderkey")


@query(" SELECT entity, metric, period, round(CASE WHEN period < 1998 THEN value ELSE value * 3 END, 4) AS value, CASE WHEN period >= 1998 THEN 'new' END AS source FROM panel")
def splice(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = fx.panel(spark, sf_dir)
    new = old.withColumn("value", F.col("value") * 3).withColumn("source", F.lit("new"))
    return panel.splice(old, new, 1998).select("entity", "metric", "period", r("value"), "source")


@query(" SELECT entity, metric, period, round(CASE WHEN metric = 'orders' THEN -value ELSE value END, 4) AS value FROM panel")
def replace_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir)
    new = rows.where("metric = 'orders'").withColumn("value", -F.col("value"))
    return panel.replace_slice(rows, new, ["orders"]).select("entity", "metric", "period", r("value"))


@query(" (SELECT entity, 'gone' AS side FROM panel WHERE period < 1998 EXCEPT SELECT entity, 'gone' FROM panel WHERE parent = 'ASIA') UNION ALL (SELECT entity, 'both' FROM panel WHERE period < 1998 INTERSECT SELECT entity, 'both' FROM panel WHERE parent = 'ASIA')")
def set_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir)
    a, b = rows.where("period < 1998").select("entity"), rows.where("parent = 'ASIA'").select("entity")
    return a.subtract(b).withColumn("side", F.lit("gone")).unionByName(a.intersect(b).withColumn("side", F.lit("both")))


# ordered series


@query(
    """+ lagged AS (SELECT *, lag(value) OVER (PARTITION BY entity, metric ORDER BY period) AS b FROM panel)
    SELECT entity, metric, period, round(CASE WHEN metric = 'orders' THEN value - b ELSE 100 * (value - b) / nullif(b, 0) END, 6) AS change FROM lagged"""
)
def year_on_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.year_on_year(fx.panel(spark, sf_dir), ["entity", "metric"], ["orders"]).select("entity", "metric", "period", r("change", 6))


@query(" SELECT entity, metric, max(period) AS last_period, round(arg_max(value, period), 4) AS last_value FROM split WHERE data_type = 'historical' GROUP BY 1, 2")
def last_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).where("data_type = 'historical'")
    return ordered.last_known(rows, ["entity", "metric"]).select("entity", "metric", "last_period", r("last_value"))


_GAPPED = "gapped AS (SELECT * FROM panel WHERE period % 3 <> 0)"


@query(
    f"""+ {_GAPPED}, grid AS (SELECT entity, metric, unnest(generate_series(min(period), max(period)))::INTEGER AS period FROM gapped GROUP BY 1, 2),
    f AS (SELECT g.*, v.value, last_value(v.value IGNORE NULLS) OVER b AS v0, last_value(v.period IGNORE NULLS) OVER b AS p0, first_value(v.value IGNORE NULLS) OVER a AS v1, first_value(v.period IGNORE NULLS) OVER a AS p1
      FROM grid g LEFT JOIN gapped v USING (entity, metric, period)
      WINDOW b AS (PARTITION BY entity, metric ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY entity, metric ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
    SELECT entity, metric, period, round(coalesce(value, v0 + (v1 - v0) * (period - p0) / (p1 - p0)), 4) AS value, CASE WHEN value IS NULL THEN 'interpolated' ELSE 'observed' END AS data_quality FROM f""".replace("g.*, v.value,", "g.entity, g.metric, g.period, v.value,").replace("OVER b AS p0", "OVER b AS p0").replace("v.period", "CASE WHEN v.value IS NOT NULL THEN period END")
)
def interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).where("period % 3 <> 0").select("entity", "metric", "period", "value")
    return panel.interpolated(rows, ["entity", "metric"]).select("entity", "metric", "period", r("value"), "data_quality")


@query(f"+ {_GAPPED} SELECT entity, metric, min(period) AS first_period, max(period) AS last_period, (max(period) - min(period) + 1 - count(DISTINCT period))::BIGINT AS missing FROM gapped GROUP BY 1, 2")
def year_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.with_gaps(fx.panel(spark, sf_dir).where("period % 3 <> 0"), ["entity", "metric"])


@query(" SELECT entity, metric, round(pow(max(CASE WHEN period = 2000 THEN value END) / max(CASE WHEN period = 1995 THEN value END), 1.0::DOUBLE / 5) - 1, 8) AS cagr FROM panel WHERE period IN (1995, 2000) GROUP BY 1, 2")
def growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.cagr(fx.panel(spark, sf_dir), ["entity", "metric"], 1995, 2000).select("entity", "metric", r("cagr", 8))


@query(" SELECT entity, metric, round(pow(max(CASE WHEN period = 1999 THEN value END) / max(CASE WHEN period = 1995 THEN value END), 1.0::DOUBLE / 5) - 1, 8) AS hist_cagr FROM split WHERE data_type = 'historical' GROUP BY 1, 2")
def lookback_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).where("data_type = 'historical'")
    return ordered.lookback_cagr(rows, ["entity", "metric"], 5).select("entity", "metric", r("hist_cagr", 8))


@query(" SELECT entity, metric, period, round(max(value) OVER (PARTITION BY entity, metric ORDER BY period), 4) AS value FROM panel")
def running_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.running_max(fx.panel(spark, sf_dir), ["entity", "metric"]).select("entity", "metric", "period", r("value"))


@query(" SELECT parent, period, entity, rank FROM (SELECT parent, period, entity, row_number() OVER (PARTITION BY parent, period ORDER BY value DESC, entity)::INTEGER AS rank FROM panel WHERE metric = 'revenue') t WHERE rank <= 3")
def top_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.top_of_each(fx.panel(spark, sf_dir).where("metric = 'revenue'"), ["parent", "period"], [F.desc("value"), F.col("entity")], 3).select("parent", "period", "entity", "rank")


@query(" SELECT event_type, date_trunc('month', ts) AS bucket, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2".replace("arg_max(value, (ts, event_id))", "arg_max(value, ts)"))
def month_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel.last_of(fx.table(spark, sf_dir, "events"), ["event_type"], "month", "ts", "value", "event_id")


_START = """start AS (SELECT entity, metric, arg_max(value, period) AS last FROM split WHERE data_type = 'historical' GROUP BY 1, 2),
    ahead AS (SELECT entity, metric, period, value * (1 + (period - 1999) * 0.1::DOUBLE) AS value, row_number() OVER (PARTITION BY entity, metric ORDER BY period) AS i FROM split WHERE data_type = 'forecast')"""


def _ahead(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir))
    start = ordered.last_known(rows.where("data_type = 'historical'"), ["entity", "metric"]).withColumnRenamed("last_value", "start")
    ahead = rows.where("data_type = 'forecast'").select("entity", "parent", "metric", "period", (F.col("value") * (1 + (F.col("period") - 1999) * 0.1)).alias("value"))
    return ahead.join(start, ["entity", "metric"])


@query(
    f"""+ {_START}, folded AS (
      SELECT a.entity, a.metric, a.period, a.i, CASE WHEN s.last <= 0 THEN a.value WHEN (a.value - s.last) / s.last > 0.06 THEN s.last * 1.06::DOUBLE WHEN (a.value - s.last) / s.last < -0.05 THEN s.last * 0.95::DOUBLE ELSE a.value END AS adjusted FROM ahead a JOIN start s USING (entity, metric) WHERE a.i = 1
      UNION ALL SELECT a.entity, a.metric, a.period, a.i, CASE WHEN f.adjusted <= 0 THEN a.value WHEN (a.value - f.adjusted) / f.adjusted > 0.06 THEN f.adjusted * 1.06::DOUBLE WHEN (a.value - f.adjusted) / f.adjusted < -0.05 THEN f.adjusted * 0.95::DOUBLE ELSE a.value END
      FROM folded f JOIN ahead a ON a.entity = f.entity AND a.metric = f.metric AND a.i = f.i + 1)
    SELECT entity, metric, period, round(adjusted, 4) AS adjusted FROM folded""",
    recursive=True,
)
def growth_cap_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ahead(spark, sf_dir).withColumn("low", F.lit(-0.05)).withColumn("high", F.lit(0.06))
    return ordered.growth_capped(rows, ["entity", "metric"], "start", "low", "high").select("entity", "metric", "period", r("adjusted"))


@query(
    f"""+ {_START}, g AS (SELECT *, least(greatest((value - prev) / prev, -0.05::DOUBLE), 0.06::DOUBLE) AS unused FROM (SELECT a.*, s.last AS prev FROM ahead a JOIN start s USING (entity, metric)) t),
    folded AS (
      SELECT a.entity, a.metric, a.period, a.i, CASE WHEN s.last <= 0 THEN a.value ELSE s.last * (1 + CASE WHEN a.period - 1999 > 1 THEN (1 - least(1, (a.period - 1999 - 1)::DOUBLE / 3) * 0.7::DOUBLE) * least(greatest((a.value - s.last) / s.last, -0.05::DOUBLE), 0.06::DOUBLE) + least(1, (a.period - 1999 - 1)::DOUBLE / 3) * 0.7::DOUBLE * 0.02::DOUBLE ELSE least(greatest((a.value - s.last) / s.last, -0.05::DOUBLE), 0.06::DOUBLE) END) END AS adjusted
      FROM ahead a JOIN start s USING (entity, metric) WHERE a.i = 1
      UNION ALL SELECT a.entity, a.metric, a.period, a.i, CASE WHEN s.adjusted <= 0 THEN a.value ELSE s.adjusted * (1 + CASE WHEN a.period - 1999 > 1 THEN (1 - least(1, (a.period - 1999 - 1)::DOUBLE / 3) * 0.7::DOUBLE) * least(greatest((a.value - s.adjusted) / s.adjusted, -0.05::DOUBLE), 0.06::DOUBLE) + least(1, (a.period - 1999 - 1)::DOUBLE / 3) * 0.7::DOUBLE * 0.02::DOUBLE ELSE least(greatest((a.value - s.adjusted) / s.adjusted, -0.05::DOUBLE), 0.06::DOUBLE) END) END
      FROM folded s JOIN ahead a ON a.entity = s.entity AND a.metric = s.metric AND a.i = s.i + 1)
    SELECT entity, metric, period, round(adjusted, 4) AS adjusted FROM folded""".replace(" g AS (SELECT *, least(greatest((value - prev) / prev, -0.05::DOUBLE), 0.06::DOUBLE) AS unused FROM (SELECT a.*, s.last AS prev FROM ahead a JOIN start s USING (entity, metric)) t),\n   ", ""),
    recursive=True,
)
def growth_dampening_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ahead(spark, sf_dir).withColumn("low", F.lit(-0.05)).withColumn("high", F.lit(0.06)).withColumn("parent_growth", F.lit(0.02))
    out = ordered.growth_dampened(rows, ["entity", "metric"], "start", "last_period", "low", "high", "parent_growth", begin=1, full=4, weight=0.7)
    return out.select("entity", "metric", "period", r("adjusted"))


@query(
    """+ g AS (SELECT entity, metric, value / lag(value) OVER (PARTITION BY entity, metric ORDER BY period) - 1 AS g FROM panel)
    SELECT entity, metric, round(CASE WHEN count(g) >= 6 THEN quantile_cont(g, 0.02) END, 8) AS low_growth, round(CASE WHEN count(g) >= 6 THEN quantile_cont(g, 0.98) END, 8) AS high_growth FROM g GROUP BY 1, 2"""
)
def growth_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.growth_percentiles(fx.panel(spark, sf_dir), ["entity", "metric"]).select("entity", "metric", r("low_growth", 8), r("high_growth", 8))


# hierarchies


_PARENTS = "parents AS (SELECT parent, metric, period, sum(value) * 1.05::DOUBLE AS parent_value FROM panel GROUP BY 1, 2, 3)"


def _parents(rows: DataFrame, by: float = 1.05) -> DataFrame:
    return rows.groupBy("parent", "metric", "period").agg((F.sum("value") * by).alias("parent_value"))


@query(
    f"""+ {_PARENTS}, t AS (SELECT *, sum(value) OVER (PARTITION BY parent, metric, period) AS total FROM split JOIN parents USING (parent, metric, period) WHERE data_type = 'forecast')
    SELECT entity, metric, period, round(value * (parent_value / total), 3) AS value, round(lo * (parent_value / total), 3) AS lo, round(hi * (parent_value / total), 3) AS hi, round(parent_value / total, 8) AS scale FROM t"""
)
def scale_to_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir))
    out = hierarchy.scaled_to_parent(rows.where("data_type = 'forecast'"), _parents(rows), ["parent", "metric", "period"], ["value", "lo", "hi"])
    return out.select("entity", "metric", "period", r("value", 3), r("lo", 3), r("hi", 3), r("scale", 8))


@query(
    f"""+ {_PARENTS}, caps AS (SELECT *, CASE WHEN metric = 'orders' THEN (SELECT quantile_cont(value, 0.8) FROM panel WHERE metric = 'orders') END AS cap FROM panel JOIN parents USING (parent, metric, period)),
    t AS (SELECT *, coalesce(cap IS NOT NULL AND value >= cap, false) AS fixed FROM caps),
    u AS (SELECT *, coalesce(sum(CASE WHEN fixed THEN value END) OVER w, 0) AS s, coalesce(sum(CASE WHEN NOT fixed THEN value END) OVER w, 0) AS f FROM t WINDOW w AS (PARTITION BY parent, metric, period))
    SELECT entity, metric, period, round(value * CASE WHEN NOT fixed AND f > 0 AND parent_value - s > 0 THEN (parent_value - s) / f ELSE 1 END, 4) AS value FROM u"""
)
def scale_below_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir)
    cap = rows.where("metric = 'orders'").agg(F.percentile("value", F.lit(0.8)).alias("cap"))
    capped = rows.join(F.broadcast(cap)).withColumn("cap", F.when(F.col("metric") == "orders", F.col("cap")))
    out = hierarchy.scaled_below_cap(capped, _parents(rows), ["parent", "metric", "period"], ["value"], "cap")
    return out.select("entity", "metric", "period", r("value"))


@query(" SELECT entity, metric, period, round(CASE WHEN metric = 'orders' AND value > 60 THEN 60 ELSE value END, 4) AS value, round(CASE WHEN metric = 'orders' AND value > 60 THEN least(hi, 60 * 1.2::DOUBLE) ELSE hi END, 4) AS hi FROM split")
def sanity_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).withColumn("cap", F.when(F.col("metric") == "orders", 60.0))
    return hierarchy.sanity_capped(rows, "cap").select("entity", "metric", "period", r("value"), F.when(F.col("hi").isNotNull() | ((F.col("metric") == "orders") & (F.col("value") >= 60.0) & F.col("hi").isNotNull()), F.round("hi", 4)).alias("hi"))


@query(
    """+ t AS (SELECT *, value / sum(value) OVER (PARTITION BY parent, metric, period) AS share FROM panel WHERE NOT (contains(entity, '_2') AND period < 2001) AND NOT ends_with(entity, '_4')),
    s AS (SELECT parent, metric, entity, avg(share) AS m, count(share) AS n FROM t GROUP BY 1, 2, 3),
    u AS (SELECT parent, m.metric, entity FROM geo, (VALUES ('revenue'), ('orders')) m(metric)),
    b AS (SELECT entity, 0.1::DOUBLE AS fallback_share FROM geo WHERE ends_with(entity, '_4') AND parent <> 'ASIA'),
    x AS (SELECT u.*, n, coalesce(m, fallback_share, 1.0::DOUBLE / count(*) OVER (PARTITION BY u.parent, u.metric)) AS share FROM u LEFT JOIN s USING (parent, metric, entity) LEFT JOIN b USING (entity))
    SELECT parent, metric, entity, round(share / sum(share) OVER (PARTITION BY parent, metric), 8) AS share, CASE WHEN n >= 3 THEN 'good' WHEN n >= 1 THEN 'fallback' ELSE 'imputed' END AS share_quality FROM x"""
)
def tiered_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).where("NOT (contains(entity, '_2') AND period < 2001) AND NOT endswith(entity, '_4')")
    stats = rollup.share_statistics(rollup.shares(rows, ["parent", "metric", "period"]), ["parent", "metric", "entity"])
    g = fx.geography(spark, sf_dir)
    universe = g.select("parent", "entity", F.explode(F.array(F.lit("revenue"), F.lit("orders"))).alias("metric"))
    fallback = g.where("endswith(entity, '_4') AND parent <> 'ASIA'").select("entity", F.lit(0.1).alias("fallback_share"))
    out = hierarchy.tiered_shares(stats, universe, F.broadcast(fallback), ["parent", "metric"], "entity")
    return out.select("parent", "metric", "entity", r("share", 8), "share_quality")


@query(
    """+ t AS (SELECT *, value / sum(value) OVER (PARTITION BY parent, metric, period) AS share FROM panel WHERE NOT (contains(entity, '_2') AND period < 2001)),
    s AS (SELECT parent, metric, entity, avg(share) AS m, count(share) AS n FROM t GROUP BY 1, 2, 3)
    SELECT parent, metric, entity, round(least(greatest(CASE WHEN n >= 3 THEN m ELSE coalesce(sum(CASE WHEN n >= 3 THEN m * n END) OVER w / nullif(sum(CASE WHEN n >= 3 THEN n END) OVER w, 0), 1.0::DOUBLE / count(*) OVER w) END, 0.0001), 0.9999), 8) AS share FROM s WINDOW w AS (PARTITION BY parent, metric)"""
)
def sparse_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir).where("NOT (contains(entity, '_2') AND period < 2001)")
    stats = rollup.share_statistics(rollup.shares(rows, ["parent", "metric", "period"]), ["parent", "metric", "entity"])
    return hierarchy.sparse_shares(stats, ["parent", "metric"], "entity").select("parent", "metric", "entity", r("share", 8))


_SHARES = """hist AS (SELECT *, value / sum(value) OVER (PARTITION BY parent, metric, period) AS share FROM panel WHERE period < 2000),
    m AS (SELECT parent, metric, entity, avg(share) AS m FROM hist GROUP BY 1, 2, 3),
    sh AS (SELECT parent, metric, entity, m / sum(m) OVER (PARTITION BY parent, metric) AS share FROM m),
    top AS (SELECT parent, metric, period, sum(value) AS value FROM panel GROUP BY 1, 2, 3)"""


def _allocation(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    past = rollup.shares(rows.where("period < 2000"), ["parent", "metric", "period"])
    shares = rollup.normalised(rollup.share_statistics(past, ["parent", "metric", "entity"]), ["parent", "metric"]).select("parent", "metric", "entity", "share")
    top = rollup.summed(rows, ["parent", "metric", "period"])
    return hierarchy.allocated(top, shares, ["parent", "metric"], ["value"]), top


@query(f"+ {_SHARES} SELECT entity, metric, period, round(value * share, 3) AS value FROM top JOIN sh USING (parent, metric)")
def allocate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _allocation(fx.panel(spark, sf_dir))[0].select("entity", "metric", "period", r("value", 3))


@query(
    f"""+ {_SHARES}, a AS (SELECT parent, metric, entity, period, value * share AS value, share FROM top JOIN sh USING (parent, metric)),
    c AS (SELECT entity, metric, arg_max(value, period) AS child_last FROM panel WHERE period < 2000 GROUP BY 1, 2), p AS (SELECT parent, metric, arg_max(value, period) AS parent_last FROM top WHERE period < 2000 GROUP BY 1, 2),
    f AS (SELECT *, child_last / (parent_last * share) AS raw FROM a JOIN c USING (entity, metric) JOIN p USING (parent, metric))
    SELECT entity, metric, period, round(value * CASE WHEN abs(raw - 1) > 0.001 AND period >= 2000 THEN raw ELSE 1 END, 3) AS value, round(CASE WHEN abs(raw - 1) > 0.001 AND period >= 2000 THEN raw ELSE 1 END, 6) AS factor FROM f"""
)
def continuity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir)
    allocation, top = _allocation(rows)
    marked = allocation.withColumn("data_type", F.when(F.col("period") >= 2000, "forecast").otherwise("historical"))
    child = ordered.last_known(rows.where("period < 2000"), ["entity", "metric"]).select("entity", "metric", F.col("last_value").alias("child_last_value"))
    parent = ordered.last_known(top.where("period < 2000"), ["parent", "metric"]).select("parent", "metric", F.col("last_value").alias("parent_last_value"))
    out = hierarchy.continuous(marked, child, parent, ["entity", "metric"], ["parent", "metric"], ["value"])
    return out.select("entity", "metric", "period", r("value", 3), r("factor", 6))


@query(f"+ {_PARENTS} SELECT metric, round(max(abs(s - parent_value) / abs(parent_value)), 8) AS worst FROM (SELECT parent, metric, period, sum(value) AS s FROM panel GROUP BY 1, 2, 3) t JOIN parents USING (parent, metric, period) GROUP BY 1")
def reconciliation_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir)
    found = hierarchy.deviation(rows, _parents(rows), ["parent", "metric", "period"])
    return found.groupBy("metric").agg(F.round(F.max("deviation"), 8).alias("worst"))


@query(
    f"""+ {_PARENTS}, d AS (SELECT metric, 100 * (s - parent_value) / parent_value AS x FROM (SELECT parent, metric, period, sum(value) AS s FROM panel WHERE period % 2 = 0 OR metric = 'orders' GROUP BY 1, 2, 3) t JOIN parents USING (parent, metric, period))
    SELECT metric, count(*) AS n, round(avg(x), 6) AS mean_diff, round(quantile_cont(x, 0.5), 6) AS median_diff, round(max(abs(x)), 6) AS max_diff FROM d GROUP BY 1"""
)
def bottom_up_vs_top_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.panel(spark, sf_dir)
    low = rollup.summed(rows.where("period % 2 = 0 OR metric = 'orders'"), ["parent", "metric", "period"])
    both = hierarchy.compared(low, _parents(rows).withColumnRenamed("parent_value", "value"), ["parent", "metric", "period"])
    return both.groupBy("metric").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("diff_pct"), 6).alias("mean_diff"), F.round(F.percentile("diff_pct", F.lit(0.5)), 6).alias("median_diff"), F.round(F.max(F.abs("diff_pct")), 6).alias("max_diff"))


@query(
    """+ own AS (SELECT * FROM rates WHERE period % 3 <> 0), up AS (SELECT parent, period, sum(value * weight) / sum(weight) AS pv FROM rates WHERE period % 2 = 0 GROUP BY 1, 2),
    grid AS (SELECT parent, entity, p::INTEGER AS period FROM geo, range(1995, 2002) t(p))
    SELECT entity, period, round(coalesce(o.value, pv), 6) AS value, CASE WHEN o.value IS NOT NULL THEN 'own' WHEN pv IS NOT NULL THEN 'parent' END AS source FROM grid g LEFT JOIN own o USING (entity, period) LEFT JOIN up u ON u.parent = g.parent AND u.period = g.period""".replace("SELECT entity, period,", "SELECT g.entity, g.period,").replace("own o USING (entity, period)", "own o ON o.entity = g.entity AND o.period = g.period")
)
def inherit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = fx.rates(spark, sf_dir)
    up = rollup.weighted_rate(rates.where("period % 2 = 0"), ["parent", "period"])
    grid = fx.geography(spark, sf_dir).select("parent", "entity", F.explode(F.sequence(F.lit(1995), F.lit(2001))).alias("period"))
    rows = grid.join(rates.where("period % 3 <> 0").select("entity", "period", "value"), ["entity", "period"], "left")
    return hierarchy.inherited(rows, [(up, "parent")], ["period"]).select("entity", "period", r("value", 6), "source")


@query(
    """+ up AS (SELECT parent, period, sum(value * weight) / sum(weight) AS pv FROM rates GROUP BY 1, 2), grid AS (SELECT parent, entity, p::INTEGER AS period FROM geo, range(1994, 2004) t(p))
    SELECT g.entity, g.period, round(coalesce(o.value, pv), 6) AS value, o.value IS NULL AND pv IS NOT NULL AS filled FROM grid g LEFT JOIN (SELECT * FROM rates WHERE period < 1999) o ON o.entity = g.entity AND o.period = g.period LEFT JOIN up ON up.parent = g.parent AND up.period = g.period"""
)
def fill_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = fx.rates(spark, sf_dir)
    up = rollup.weighted_rate(rates, ["parent", "period"]).withColumnRenamed("value", "parent_value")
    entities = fx.geography(spark, sf_dir).select("entity", "parent")
    return hierarchy.years_filled(rates.where("period < 1999"), up, entities, 1994, 2003, ["parent", "period"]).select("entity", "period", r("value", 6), "filled")


@query(
    """+ own AS (SELECT entity, avg(value) AS v FROM rates WHERE NOT contains(entity, '_2') GROUP BY 1), up AS (SELECT parent, avg(value) AS v FROM rates GROUP BY 1)
    SELECT g.entity, round(coalesce(own.v, up.v), 6) AS value, CASE WHEN own.v IS NOT NULL THEN 'own' ELSE 'parent' END AS method FROM geo g LEFT JOIN own USING (entity) LEFT JOIN up ON up.parent = g.parent"""
)
def rate_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = fx.rates(spark, sf_dir)
    own = rates.where("NOT contains(entity, '_2')").groupBy("entity").agg(F.avg("value").alias("value"))
    up = rates.groupBy("parent").agg(F.avg("value").alias("value")).join(F.broadcast(fx.geography(spark, sf_dir)), "parent").select("entity", "value")
    return hierarchy.by_priority([("own", own), ("parent", up)], ["entity"]).select("entity", r("value", 6), "method")


@query(
    """+ up AS (SELECT parent, period, sum(value * weight) / sum(weight) AS pv FROM rates GROUP BY 1, 2), l AS (SELECT entity, any_value(parent) AS parent, arg_max(value, period) AS x FROM rates WHERE period < 1998 GROUP BY 1)
    SELECT entity, period, round(exp(-ln(2) / 10 * (period - 1997)) * x + (1 - exp(-ln(2) / 10 * (period - 1997))) * pv, 6) AS value FROM l JOIN up USING (parent) WHERE period >= 1998"""
)
def decay_to_parent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = fx.rates(spark, sf_dir)
    up = rollup.weighted_rate(rates, ["parent", "period"]).withColumnRenamed("value", "pv").where("period >= 1998")
    last = ordered.last_known(rates.where("period < 1998"), ["entity", "parent"])
    out = last.join(up, "parent")
    return out.select("entity", "period", r(hierarchy.decay_blend(F.col("last_value"), F.col("pv"), F.col("period") - F.col("last_period")), 6).alias("value"))


@query(
    """+ up AS (SELECT parent, metric, period, sum(value) * CASE WHEN parent = 'ASIA' THEN 1.01::DOUBLE ELSE 1 END AS v FROM panel GROUP BY 1, 2, 3), a AS (SELECT metric, period, sum(value) AS entities FROM panel GROUP BY 1, 2), b AS (SELECT metric, period, sum(v) AS parents FROM up GROUP BY 1, 2)
    SELECT metric, period, round(entities, 2) AS entities, round(parents, 2) AS parents, round(abs(parents - entities) / abs(entities), 8) AS spread FROM a JOIN b USING (metric, period)"""
)
def full_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two levels from tables of their own; one parent's total is off by a hundredth."""
    rows = fx.panel(spark, sf_dir)
    up = rollup.summed(rows, ["parent", "metric", "period"]).withColumn("value", F.col("value") * F.when(F.col("parent") == "ASIA", 1.01).otherwise(1.0))
    out = hierarchy.cascade([("entities", rows), ("parents", up)], ["metric", "period"])
    return out.select("metric", "period", r("entities", 2), r("parents", 2), F.round(F.abs("spread"), 8).alias("spread"))


@query(
    """+ h AS (SELECT entity, metric, period, value, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi FROM split WHERE data_type = 'historical'), f AS (SELECT entity, metric, period, value * 2 AS value, lo, hi FROM split WHERE period >= 1998),
    d AS (SELECT a.entity, 'average' AS metric, a.period, a.value / b.value AS value, NULL::DOUBLE AS lo, NULL::DOUBLE AS hi FROM split a JOIN split b ON a.entity = b.entity AND a.period = b.period AND a.metric = 'revenue' AND b.metric = 'orders'),
    l AS (SELECT entity, metric, max(period) AS last FROM h GROUP BY 1, 2),
    every AS (SELECT *, 'historical' AS data_type, false AS is_calculated, 0 AS k FROM h UNION ALL SELECT f.*, 'forecast', false, 1 FROM f LEFT JOIN l USING (entity, metric) WHERE last IS NULL OR period > last UNION ALL SELECT *, 'derived', true, 2 FROM d),
    kept AS (SELECT *, row_number() OVER (PARTITION BY entity, metric, period ORDER BY k, value) AS n FROM every)
    SELECT entity, metric, period, round(value, 4) AS value, round(lo, 4) AS lo, round(hi, 4) AS hi, data_type, is_calculated, parent AS entity_name, CASE metric WHEN 'revenue' THEN 'GBP' WHEN 'orders' THEN 'count' END AS unit FROM kept LEFT JOIN geo USING (entity) WHERE n = 1"""
)
def export_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.split(fx.panel(spark, sf_dir)).select("entity", "metric", "period", "value", "lo", "hi", "data_type")
    keep = ["entity", "metric", "period", "value", "lo", "hi"]
    wide = panel.by_metric(rows, ["entity", "period"], ["revenue", "orders"], ["value"])
    derived = wide.select("entity", F.lit("average").alias("metric"), "period", ratio(F.col("revenue_value"), F.col("orders_value")).alias("value")).where("value IS NOT NULL")
    entities = fx.geography(spark, sf_dir).select("entity", F.col("parent").alias("entity_name"))
    metrics = spark.createDataFrame([("revenue", "GBP"), ("orders", "count")], "metric string, unit string")
    ahead = rows.where("period >= 1998").withColumn("value", F.col("value") * 2)
    out = export.export_table(rows.where("data_type = 'historical'").select(keep), ahead.select(keep), derived, entities, metrics)
    return out.select("entity", "metric", "period", r("value"), r("lo"), r("hi"), "data_type", "is_calculated", "entity_name", "unit")


@query(" SELECT entity, metric, count(*) FILTER (WHERE data_type = 'historical') AS n_past, count(*) FILTER (WHERE data_type = 'forecast') AS n_ahead, count(*) AS n, arg_min(period, period) FILTER (WHERE data_type = 'historical') AS first_period FROM split GROUP BY 1, 2")
def chart_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = export.chart_slices(fx.split(fx.panel(spark, sf_dir)))
    return out.select("entity", "metric", F.size("past").cast("long").alias("n_past"), F.size("ahead").cast("long").alias("n_ahead"), "n", F.col("past")[0]["period"].alias("first_period"))


@query(" SELECT substr(label, 1, 4)::INTEGER AS period, count(*) AS n FROM (SELECT concat(year(o_orderdate), '-', month(o_orderdate)) AS label FROM orders) t GROUP BY 1")
def fiscal_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat_ws("-", F.year("o_orderdate"), F.month("o_orderdate"))
    return fx.table(spark, sf_dir, "orders").groupBy(fiscal_year(label).alias("period")).agg(F.count(F.lit(1)).alias("n"))
