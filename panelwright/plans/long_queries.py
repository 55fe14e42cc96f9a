"""Queries over long series and large tables: chunked folds, levels of a hierarchy in one pass, exact selection, audits by range."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators import calendar, levels, ordered, regression, selection, versions
from panelwright.plans import fixtures as fx
from panelwright.plans.panel_queries import r
from panelwright.plans.registry import query
from panelwright.session import kept
from panelwright.sources import features, tables

_HOURLY = "hourly AS (SELECT event_type AS entity, (epoch(date_trunc('hour', ts)) // 3600)::BIGINT AS period, sum(CAST(round(value * 100) AS BIGINT))::DOUBLE / 100 AS value FROM events GROUP BY 1, 2)"


def _hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity (an event type), period (hours since 1970), value (its events' sum, in whole cents)."""
    events = fx.table(spark, sf_dir, "events").select(F.col("event_type").alias("entity"), F.floor(F.unix_timestamp("ts") / 3600).alias("period"), F.round(F.col("value") * 100).cast("long").alias("cents"))
    return events.groupBy("entity", "period").agg((F.sum("cents").cast("double") / 100).alias("value"))


_FIRST = "numbered AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY period) AS i, first_value(value) OVER (PARTITION BY entity ORDER BY period) AS start, min(period) OVER (PARTITION BY entity) AS base FROM hourly)"


def _from_first(rows: DataFrame) -> DataFrame:
    """The rows after each series' first, with its value as start and its period as base."""
    first = rows.groupBy("entity").agg(F.min_by("value", "period").alias("start"), F.min("period").alias("base"))
    return rows.join(first, "entity").where("period > base")


@query(
    f"""+ {_HOURLY}, {_FIRST}, folded AS (SELECT entity, period, i, value AS a FROM numbered WHERE i = 1
      UNION ALL SELECT n.entity, n.period, n.i, greatest(least(n.value, f.a * 1.1::DOUBLE), f.a * 0.92::DOUBLE) FROM folded f JOIN numbered n ON n.entity = f.entity AND n.i = f.i + 1)
    SELECT entity, period, round(a, 4) AS adjusted FROM folded WHERE i > 1""",
    recursive=True,
)
def hourly_growth_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly series capped day by day; the days are worked on apart."""
    rows = _from_first(_hourly(spark, sf_dir)).withColumn("low", F.lit(-0.08)).withColumn("high", F.lit(0.1))
    out = ordered.growth_capped_in_chunks(rows, ["entity"], "start", "low", "high", F.floor(F.col("period") / 24))
    return out.select("entity", "period", r("adjusted"))


@query(
    f"""+ {_HOURLY}, {_FIRST}, folded AS (SELECT entity, period, i, value AS a FROM numbered WHERE i = 1
      UNION ALL SELECT entity, period, i, a * (1 + CASE WHEN o > 24 THEN (1 - w) * g + w * 0.002::DOUBLE ELSE g END) FROM (
        SELECT n.entity, n.period, n.i, f.a, (n.period - n.base)::DOUBLE AS o, least(1, (n.period - n.base - 24)::DOUBLE / 216) * 0.7::DOUBLE AS w, least(greatest((n.value - f.a) / f.a, -0.08::DOUBLE), 0.1::DOUBLE) AS g
        FROM folded f JOIN numbered n ON n.entity = f.entity AND n.i = f.i + 1) t)
    SELECT entity, period, round(a, 4) AS adjusted FROM folded WHERE i > 1""",
    recursive=True,
)
def hourly_growth_dampening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _from_first(_hourly(spark, sf_dir)).withColumn("low", F.lit(-0.08)).withColumn("high", F.lit(0.1)).withColumn("parent_growth", F.lit(0.002))
    out = ordered.growth_dampened_in_chunks(rows, ["entity"], "start", "base", "low", "high", "parent_growth", F.floor(F.col("period") / 24), begin=24, full=240)
    return out.select("entity", "period", r("adjusted"))


# all levels at once

_LEAVES = "leaves AS (SELECT g.parent AS region, c.parent AS nation, c.entity AS customer, metric, period, value FROM cpanel c JOIN geo g ON c.parent = g.entity WHERE period >= 2000)"
#: Each level has forecasts of its own, which don't add up: nations 5 % over their customers but two, regions 10 % over those.
_OWN = "nations AS (SELECT region, nation, metric, period, sum(value) * CASE WHEN nation LIKE '%1' THEN 0.9::DOUBLE ELSE 1.05::DOUBLE END AS value FROM leaves GROUP BY 1, 2, 3, 4), regions AS (SELECT region, metric, period, sum(value) * 1.1::DOUBLE AS value FROM nations GROUP BY 1, 2, 3)"


def _leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.customer_panel(spark, sf_dir).where("period >= 2000").withColumnsRenamed({"parent": "nation", "entity": "customer"})
    return rows.join(F.broadcast(fx.geography(spark, sf_dir).select(F.col("entity").alias("nation"), F.col("parent").alias("region"))), "nation")


def _nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """path, metric, period, value of regions, nations and customers, each level with forecasts of its own."""
    leaves = _leaves(spark, sf_dir)
    nations = leaves.groupBy("region", "nation", "metric", "period").agg((F.sum("value")).alias("value")).withColumn("value", F.col("value") * F.when(F.col("nation").like("%1"), 0.9).otherwise(1.05))
    regions = nations.groupBy("region", "metric", "period").agg((F.sum("value") * 1.1).alias("value"))
    named = [(regions, ["region"]), (nations, ["region", "nation"]), (leaves, ["region", "nation", "customer"])]
    parts = [df.select(F.array(*[F.col(c).cast("string") for c in path]).alias("path"), "metric", "period", "value") for df, path in named]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    f"""+ {_LEAVES}, {_OWN}, n AS (SELECT n.*, n.value * r.value / sum(n.value) OVER (PARTITION BY region, metric, period) AS v FROM nations n JOIN regions r USING (region, metric, period)),
    l AS (SELECT l.*, l.value * n.v / sum(l.value) OVER (PARTITION BY l.region, l.nation, l.metric, l.period) AS v FROM leaves l JOIN n USING (region, nation, metric, period))
    SELECT region AS path, metric, period, round(value, 5) AS value, 1.0::DOUBLE AS scale FROM regions UNION ALL SELECT region || '/' || nation, metric, period, round(v, 5), round(v / value, 9) FROM n
    UNION ALL SELECT region || '/' || nation || '/' || customer, metric, period, round(v, 5), round(v / value, 9) FROM l"""
)
def reconciled_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions, nations and customers made to add up in one pass."""
    out = levels.reconciled_levels(_nodes(spark, sf_dir), ["metric", "period"], ["value"])
    return out.select(F.array_join("path", "/").alias("path"), "metric", "period", r("value", 5), r("scale", 9))


@query(
    f"""+ {_LEAVES}, {_OWN} SELECT 'nation' AS level, metric, period, round(max(abs(s - value) / value), 9) AS worst, count(*) AS n FROM nations JOIN (SELECT region, nation, metric, period, sum(value) AS s FROM leaves GROUP BY 1, 2, 3, 4) t USING (region, nation, metric, period) GROUP BY 2, 3
    UNION ALL SELECT 'region', metric, period, round(max(abs(s - value) / value), 9), count(*) FROM regions JOIN (SELECT region, metric, period, sum(value) AS s FROM nations GROUP BY 1, 2, 3) t USING (region, metric, period) GROUP BY 2, 3"""
)
def level_deviations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the children of each level are from their parents before they are reconciled."""
    found = levels.deviations(_nodes(spark, sf_dir), ["metric", "period"]).withColumn("level", F.element_at(F.array(F.lit("region"), F.lit("nation")), F.size("path")))
    return found.groupBy("level", "metric", "period").agg(F.round(F.max("deviation"), 9).alias("worst"), F.count(F.lit(1)).alias("n"))


@query(
    f"""+ {_LEAVES}, rows AS (SELECT nation, customer, metric, period, value, value * 1.2::DOUBLE AS hi, CASE WHEN customer % 3 <> 0 THEN value * exp((customer % 7) * 0.05::DOUBLE) END AS cap FROM leaves),
    targets AS (SELECT nation, metric, period, sum(value) * CASE WHEN metric = 'orders' THEN exp(0.27::DOUBLE) ELSE exp(0.11::DOUBLE) END AS t FROM rows GROUP BY 1, 2, 3),
    sorted AS (SELECT r.*, t, coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS filled, sum(value) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unfilled
      FROM rows r JOIN targets USING (nation, metric, period) WINDOW w AS (PARTITION BY nation, metric, period ORDER BY cap / value NULLS LAST, customer)),
    f AS (SELECT nation, metric, period, arg_min((t - filled) / unfilled, (coalesce(cap / value, 1e300::DOUBLE), customer)) AS f FROM sorted WHERE cap IS NULL OR filled + unfilled * cap / value >= t GROUP BY 1, 2, 3)
    SELECT r.nation, r.customer, r.metric, r.period, round(least(coalesce(f * value, cap), cap), 4) AS value, round(hi * least(coalesce(f * value, cap), cap) / value, 4) AS hi FROM rows r LEFT JOIN f USING (nation, metric, period)"""
)
def water_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers scaled to their nation's target, none above its cap."""
    rows = _leaves(spark, sf_dir).drop("region").withColumn("hi", F.col("value") * 1.2).withColumn("cap", F.expr("CASE WHEN customer % 3 <> 0 THEN value * exp((customer % 7) * 0.05D) END"))
    targets = rows.groupBy("nation", "metric", "period").agg((F.sum("value") * F.when(F.col("metric") == "orders", F.exp(F.lit(0.27))).otherwise(F.exp(F.lit(0.11)))).alias("target"))
    out = levels.filled_below_caps(rows, targets, ["nation", "metric", "period"], ["value", "hi"], "cap")
    return out.select("nation", "customer", "metric", "period", r("value"), r("hi"))


@query(
    """+ rows AS (SELECT g.parent AS region, c.parent AS nation, c.entity AS customer, period, revenue, orders, CASE WHEN c.entity % 11 = 0 THEN NULL ELSE round(revenue * 100) END AS weight, CASE WHEN c.entity % 50 = 0 THEN 'interpolated' ELSE 'observed' END AS q
      FROM (SELECT entity, parent, period, max(value) FILTER (WHERE metric = 'revenue') AS revenue, max(value) FILTER (WHERE metric = 'orders') AS orders FROM cpanel GROUP BY 1, 2, 3) c JOIN geo g ON g.entity = c.parent),
    every AS (SELECT 'customer' AS level, region, nation, customer, rows.* EXCLUDE (region, nation, customer) FROM rows UNION ALL SELECT 'nation', region, nation, NULL, rows.* EXCLUDE (region, nation, customer) FROM rows
      UNION ALL SELECT 'region', region, NULL, NULL, rows.* EXCLUDE (region, nation, customer) FROM rows UNION ALL SELECT 'all', NULL, NULL, NULL, rows.* EXCLUDE (region, nation, customer) FROM rows)
    SELECT level, region, nation, customer, period, round(sum(revenue), 2) AS revenue, round(sum(orders * weight) / nullif(sum(weight), 0), 9) AS rate, CASE WHEN bool_or(q = 'interpolated') THEN 'interpolated' ELSE 'observed' END AS quality FROM every GROUP BY 1, 2, 3, 4, 5"""
)
def every_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums, weighted rates and quality of customers, nations, regions and all, in one aggregation."""
    wide = _customers_wide(spark, sf_dir)
    rows = wide.join(F.broadcast(fx.geography(spark, sf_dir).select(F.col("entity").alias("nation"), F.col("parent").alias("region"))), "nation")
    weight = F.expr("CASE WHEN customer % 11 = 0 THEN NULL ELSE round(revenue * 100) END")
    path = {"customer": ["region", "nation", "customer"], "nation": ["region", "nation"], "region": ["region"], "all": []}
    out = levels.rolled_up(rows, path, ["period"], {"revenue": F.col("revenue")}, {"rate": (F.col("orders"), weight)}, F.expr("CASE WHEN customer % 50 = 0 THEN 'interpolated' ELSE 'observed' END"))
    return out.select("level", "region", "nation", "customer", "period", F.round("revenue", 2).alias("revenue"), r("rate", 9), "quality")


def _customers_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation, customer, period, revenue, orders."""
    rows = fx.customer_panel(spark, sf_dir).withColumnsRenamed({"parent": "nation", "entity": "customer"})
    of = lambda m: F.max(F.when(F.col("metric") == m, F.col("value"))).alias(m)
    return rows.groupBy("nation", "customer", "period").agg(of("revenue"), of("orders"))


# regressions from sums

_MONTHLY = "monthly AS (SELECT n_name AS entity, (year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 AS t, sum(CAST(round(o_totalprice * 100) AS BIGINT))::DOUBLE / 100 AS value FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)"


def _monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity (a nation), t (months since 1995), value."""
    orders = fx.table(spark, sf_dir, "orders").select("o_custkey", ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate") - 1).alias("t"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    sums = orders.groupBy("o_custkey", "t").agg(F.sum("cents").alias("cents")).join(fx.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    nations = sums.groupBy("c_nationkey", "t").agg((F.sum("cents").cast("double") / 100).alias("value"))
    return nations.join(F.broadcast(fx.geography(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey")).select("entity", "t", "value")


@query(
    f"""+ {_MONTHLY}, x AS (SELECT entity, t::DOUBLE AS t, value / 1e6::DOUBLE AS y, CASE WHEN t >= 30 THEN 1.0::DOUBLE ELSE 0 END AS s, greatest(t - 50, 0)::DOUBLE AS q FROM monthly),
    a AS (SELECT *, s - regr_intercept(s, t) OVER w - regr_slope(s, t) OVER w * t AS s1, q - regr_intercept(q, t) OVER w - regr_slope(q, t) OVER w * t AS q1, y - regr_intercept(y, t) OVER w - regr_slope(y, t) OVER w * t AS y1 FROM x WINDOW w AS (PARTITION BY entity)),
    b AS (SELECT *, q1 - regr_intercept(q1, s1) OVER w - regr_slope(q1, s1) OVER w * s1 AS q2, y1 - regr_intercept(y1, s1) OVER w - regr_slope(y1, s1) OVER w * s1 AS y2 FROM a WINDOW w AS (PARTITION BY entity)),
    c AS (SELECT *, regr_slope(y2, q2) OVER (PARTITION BY entity) AS bq FROM b), d AS (SELECT *, regr_slope(y1 - bq * q1, s1) OVER (PARTITION BY entity) AS bs FROM c),
    f AS (SELECT entity, any_value(bq) AS bq, any_value(bs) AS bs, regr_slope(y - bq * q - bs * s, t) AS bt, regr_intercept(y - bq * q - bs * s, t) AS bc, max(t) AS last FROM d GROUP BY 1)
    SELECT entity, h::INTEGER AS h, round(bc, 6) AS base, round(bt, 6) AS trend, round(bs, 6) AS step, round(bq, 6) AS ramp, round(bc + bt * (last + h) + bs * CASE WHEN last + h >= 30 THEN 1 ELSE 0 END + bq * greatest(last + h - 50, 0), 6) AS value FROM f, range(1, 4) r(h)""",
)
def break_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trend with a step and a change of slope for each nation's months, carried three months on."""
    rows = _monthly(spark, sf_dir)
    model = lambda t: {"base": F.lit(1.0), "trend": t} | regression.breaks(t, {"step": 30}, {"ramp": 50})
    fits = regression.fitted(rows, ["entity"], model(F.col("t")), F.col("value") / 1e6)
    ahead = rows.groupBy("entity").agg(F.max("t").alias("last")).select("entity", "last", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("h"))
    out = regression.extended(fits, ahead, ["entity"], model(F.col("last") + F.col("h")))
    return out.join(fits, "entity").select("entity", "h", r("base", 6), r("trend", 6), r("step", 6), r("ramp", 6), r("value", 6))


@query(
    f"""+ {_MONTHLY}, x AS (SELECT entity, t, value AS y, row_number() OVER w - 1.0::DOUBLE AS x, value / lag(value) OVER w - 1 AS g FROM monthly WINDOW w AS (PARTITION BY entity ORDER BY t)),
    f AS (SELECT *, count(*) OVER p AS n, regr_slope(y, x) OVER p * x + regr_intercept(y, x) OVER p AS linear, lag(y) OVER (PARTITION BY entity ORDER BY t) AS flat, lag(y) OVER (PARTITION BY entity ORDER BY t) * (1 + avg(g) OVER p) AS growth
      FROM x WINDOW p AS (PARTITION BY entity ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    e AS (SELECT entity, count(*) AS folds, 1 / greatest(avg(abs(linear - y) / (abs(linear) + abs(y))), 1e-6::DOUBLE) AS a, 1 / greatest(avg(abs(flat - y) / (abs(flat) + abs(y))), 1e-6::DOUBLE) AS b, 1 / greatest(avg(abs(growth - y) / (abs(growth) + abs(y))), 1e-6::DOUBLE) AS c FROM f WHERE n >= 12 GROUP BY 1)
    SELECT entity, folds, round(a / (a + b + c), 6) AS linear, round(b / (a + b + c), 6) AS flat, round(c / (a + b + c), 6) AS growth FROM e"""
)
def validation_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of three models from every expanding window of every nation's months."""
    errors = regression.expanding_errors(_monthly(spark, sf_dir), ["entity"], 12, period="t")
    return regression.inverse_error_weights(errors, ["entity"], ["linear", "flat", "growth"]).select("entity", "folds", r("linear", 6), r("flat", 6), r("growth", 6))


# exact selection


@query(
    """ SELECT l_returnflag, p, round(value, 6) AS value FROM (SELECT l_returnflag, unnest([0.02, 0.5, 0.9, 1.0])::DOUBLE AS p, unnest(quantile_cont(l_extendedprice, [0.02, 0.5, 0.9, 1.0])) AS value FROM lineitem GROUP BY 1) t"""
)
def price_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact quantiles of line prices; ranges of more than 4096 rows are narrowed first."""
    lines = fx.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice")
    return selection.exact_quantiles(lines, ["l_returnflag"], "l_extendedprice", [0.02, 0.5, 0.9, 1.0], direct_rows=4096).select("l_returnflag", "p", r("value", 6))


# versions

_EDITED = "edited AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 997 = 5 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 1499 <> 3 UNION ALL SELECT -o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 2999 = 8)"


def _edited(orders: DataFrame) -> DataFrame:
    """A later version: some orders changed, some gone, some new."""
    columns = orders.columns
    kept = orders.where("o_orderkey % 1499 <> 3").withColumn("o_orderstatus", F.expr("CASE WHEN o_orderkey % 997 = 5 THEN 'X' ELSE o_orderstatus END"))
    return kept.unionByName(orders.where("o_orderkey % 2999 = 8").withColumn("o_orderkey", -F.col("o_orderkey"))).select(*columns)


@query(
    f"""+ {_EDITED} SELECT coalesce(a.o_orderkey, b.o_orderkey) AS o_orderkey, CASE WHEN a.o_orderkey IS NULL THEN 'added' WHEN b.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS status, (a.o_orderkey IS NOT NULL)::BIGINT AS rows_before, (b.o_orderkey IS NOT NULL)::BIGINT AS rows_after
    FROM orders a FULL JOIN edited b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_orderstatus <> b.o_orderstatus"""
)
def changed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which orders differ between two versions; ranges of keys with equal fingerprints aren't compared row by row."""
    before = fx.table(spark, sf_dir, "orders")
    after = _edited(before)
    trees = [kept(versions.fingerprint_tree(t, "o_orderkey", leaf_keys=256, fanout=16)) for t in (before, after)]
    leaves = kept(versions.unequal_leaves(*trees, fanout=16))
    return versions.changed_keys(before, after, leaves, "o_orderkey", leaf_keys=256)


@query(
    """+ late AS (SELECT c_nationkey, year(o_orderdate)::INTEGER AS period, CAST(round(o_totalprice * 100) AS BIGINT) * CASE WHEN o_orderkey % 701 = 9 THEN 2 ELSE 1 END AS cents, (o_custkey % 5)::BIGINT AS weight
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE NOT (year(o_orderdate) = 1997 AND month(o_orderdate) = 3 AND o_orderkey % 3 = 0))
    SELECT c_nationkey, period, count(*) AS rows, sum(cents)::BIGINT AS cents, round(sum(cents * weight)::DOUBLE / nullif(sum(weight), 0), 6) AS rate FROM late GROUP BY 1, 2"""
)
def incremental_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums and a weighted rate by nation and year, brought up to date from the months whose fingerprints changed."""
    orders = fx.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.trunc("o_orderdate", "month").alias("month"), F.year("o_orderdate").alias("period"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    late = orders.where("NOT (month = DATE'1997-03-01' AND o_orderkey % 3 = 0)").withColumn("cents", F.expr("cents * CASE WHEN o_orderkey % 701 = 9 THEN 2 ELSE 1 END"))
    customer = fx.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    keys, weight = ["c_nationkey", "period"], F.col("o_custkey") % 5
    sums = {"cents": F.col("cents"), "weighted": F.col("cents") * weight, "weight": weight.cast("long")}
    before = versions.state(orders.join(customer, "o_custkey"), keys, sums)  # of the run before
    parts = versions.changed_parts(versions.part_hashes(orders, "month"), versions.part_hashes(late, "month"), "month")
    moved = versions.signed(*[t.join(F.broadcast(parts), "month", "left_semi") for t in (orders, late)])
    deltas = versions.state(moved.join(customer, "o_custkey"), keys, sums, F.col("sign"))
    now = versions.applied(before, deltas, keys)
    return now.select(*keys, "rows", "cents", F.round(F.col("weighted").cast("double") / F.nullif("weight", F.lit(0)), 6).alias("rate"))


# calendars and features

#: What the offsets of a period's later half of months add up to.
_HALF = {n: sum(d for d in ((j - (n - 1) / 2) / n for j in range(n)) if d > 0) for n in (3, 12)}
_PRIORITY = "po AS (SELECT o_orderpriority AS entity, year(o_orderdate) * 12 + month(o_orderdate) - 1 AS month, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)"


@query(
    f"""+ {_PRIORITY}, d AS (SELECT event_type AS entity, year(ts) * 12 + month(ts) - 1 AS month, arg_max(v, (day, v)) AS value FROM (SELECT event_type, ts, date_trunc('day', ts)::DATE AS day, value AS v FROM events) e GROUP BY 1, 2),
    m AS (SELECT entity, month, count(*)::DOUBLE AS value FROM po GROUP BY 1, 2),
    m3 AS (SELECT entity, month + 2 - month % 3 AS month, sum(cents)::DOUBLE / 100 AS value FROM po WHERE month % 36 >= 6 GROUP BY 1, 2), m3s AS (SELECT entity, unnest(range(min(month), max(month) + 1)) AS month FROM m3 GROUP BY 1),
    m3f AS (SELECT s.entity, s.month, max(m.month) AS seen, arg_max(m.value, m.month) AS value FROM m3s s LEFT JOIN m3 m ON m.entity = s.entity AND m.month <= s.month GROUP BY 1, 2),
    q AS (SELECT entity, month // 3 AS period, sum(cents)::DOUBLE / 100 AS value FROM po GROUP BY 1, 2), a AS (SELECT entity, month // 12 AS period, sum(cents)::DOUBLE / 100 AS value FROM po GROUP BY 1, 2),
    parts AS (SELECT 'Q' AS freq, 3 AS n, * FROM q UNION ALL SELECT 'A', 12, * FROM a),
    near AS (SELECT *, value / n AS mean, CASE WHEN lead(period) OVER w = period + 1 THEN lead(value) OVER w / n - value / n ELSE 0 END AS up, CASE WHEN lag(period) OVER w = period - 1 THEN value / n - lag(value) OVER w / n ELSE 0 END AS down FROM parts WINDOW w AS (PARTITION BY freq, entity ORDER BY period)),
    months AS (SELECT *, unnest(range(0, n)) AS j FROM near), lines AS (SELECT *, (j - (n - 1) / 2.0::DOUBLE) / n AS d, CASE n WHEN 12 THEN {-_HALF[12]!r}::DOUBLE ELSE {-_HALF[3]!r}::DOUBLE END * (up - down) / n AS shift FROM months),
    flows AS (SELECT freq, entity, period * n + j AS month, mean + CASE WHEN d > 0 THEN up ELSE down END * d + shift AS value FROM lines)
    SELECT entity, 'D' AS freq, month::BIGINT AS month, round(value, 3) AS value, 'observed' AS data_quality FROM d UNION ALL SELECT entity, 'M', month::BIGINT, value, 'observed' FROM m
    UNION ALL SELECT entity, 'M3', month::BIGINT, CASE WHEN month - seen <= 4 THEN round(value, 3) END, CASE WHEN seen = month THEN 'observed' WHEN month - seen <= 4 THEN 'carried' END FROM m3f UNION ALL SELECT entity, freq, month::BIGINT, round(value, 3), 'spread' FROM flows"""
)
def mixed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily, monthly, three-month, quarterly and yearly series on one calendar of months."""
    events = fx.table(spark, sf_dir, "events").select(F.col("event_type").alias("entity"), F.to_date("ts").alias("day"), "value")
    orders = fx.table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("entity"), calendar.month_of(F.col("o_orderdate")).alias("month"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    orders = orders.groupBy("entity", "month").agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).cast("double").alias("n"))
    total = (F.sum("cents").cast("double") / 100).alias("value")
    windows = orders.where("month % 36 >= 6").groupBy("entity", F.expr("month + 2 - month % 3").alias("month")).agg(total)
    spread = {f: calendar.spread_over_months(orders.groupBy("entity", F.floor(F.col("month") / n).alias("period")).agg(total), ["entity"], f).withColumn("data_quality", F.lit("spread")) for f, n in calendar.MONTHS.items()}
    parts = {"D": calendar.last_in_month(events, ["entity"], "day"), "M": orders.withColumnRenamed("n", "value"), "M3": calendar.carried(windows, ["entity"], 4), **spread}
    return calendar.on_months(parts, ["entity"]).select("entity", "freq", F.col("month").cast("long").alias("month"), F.round("value", 3).alias("value"), "data_quality")


@query(
    """ SELECT n.n_nationkey::VARCHAR AS code, k AS key, CASE k WHEN 'name' THEN n_name WHEN 'code' THEN n.n_nationkey::VARCHAR WHEN 'customers' THEN (CASE WHEN n.n_nationkey % 5 = 0 THEN NULL ELSE c.n END)::VARCHAR ELSE 'kept' END AS value, '[' || (n.n_nationkey * 2) || ',' || n.n_regionkey || ']' AS coordinates
    FROM nation n LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) c ON c_nationkey = n.n_nationkey, (SELECT unnest(['name', 'code', 'customers', 'note']) AS k) WHERE k <> 'customers' OR (c.n IS NOT NULL AND n.n_nationkey % 5 <> 0)"""
)
def feature_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a feature collection, their customers' counts written into it, and what reading that again gives."""
    nation = fx.table(spark, sf_dir, "nation")
    own = F.create_map(F.lit("name"), F.col("n_name").cast("variant"), F.lit("code"), F.col("n_nationkey").cast("variant"), F.lit("note"), F.lit("kept").cast("variant"))
    point = F.concat(F.lit('{"type":"Point","coordinates":['), F.col("n_nationkey") * 2, F.lit(","), F.col("n_regionkey"), F.lit("]}"))
    texts = features.as_json(nation.select(F.col("n_nationkey").cast("string").alias("id"), own.alias("properties"), F.parse_json(point).alias("geometry")))
    counts = fx.table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).cast("double").alias("n")).where("c_nationkey % 5 <> 0")
    attributes = tables.attribute_map(counts.withColumn("key", F.lit("customers")), "c_nationkey", "key", "n")
    written = features.as_json(features.with_attributes(features.parsed(texts, "value"), attributes, "code", "c_nationkey"))
    again = features.parsed(written, "value").select(features.property_text("code").alias("code"), F.explode("properties"), F.to_json("geometry").alias("g"))
    return again.select("code", "key", F.col("value").cast("string").alias("value"), F.get_json_object("g", "$.coordinates").alias("coordinates"))
