"""Panels made from the driver's tables: nations in regions, by order year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The period from which the panel's rows play the part of forecasts.
FORECAST_FROM = 2000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, parent and the nation's key: 25 rows."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("entity"), F.col("r_name").alias("parent"))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, parent, metric (revenue, orders), period, value. Cents are summed as whole numbers."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("period"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    by_customer = orders.groupBy("o_custkey", "period").agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    sums = by_customer.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_nationkey", "period").agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"))
    named = sums.join(F.broadcast(geography(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"))
    metrics = F.array(F.struct(F.lit("revenue").alias("metric"), (F.col("cents").cast("double") / 100).alias("value")), F.struct(F.lit("orders").alias("metric"), F.col("n").cast("double").alias("value")))
    return named.select("entity", "parent", "period", F.explode(metrics).alias("m")).select("entity", "parent", "m.metric", "period", "m.value")


def customer_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity (a customer's key), parent (its nation), metric (revenue, orders), period, value: thousands of series."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("period"), F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    sums = orders.groupBy("o_custkey", "period").agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    named = sums.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(geography(spark, sf_dir)).select("n_nationkey", F.col("entity").alias("parent")), F.col("c_nationkey") == F.col("n_nationkey"))
    metrics = F.array(F.struct(F.lit("revenue").alias("metric"), (F.col("cents").cast("double") / 100).alias("value")), F.struct(F.lit("orders").alias("metric"), F.col("n").cast("double").alias("value")))
    return named.select(F.col("c_custkey").cast("long").alias("entity"), "parent", "period", F.explode(metrics).alias("m")).select("entity", "parent", "m.metric", "period", "m.value")


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity, parent, period, value (mean discount in percent, weighted by quantity) and weight (the quantity)."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_quantity").cast("long").alias("q"), (F.round(F.col("l_discount") * 100).cast("long") * F.col("l_quantity").cast("long")).alias("d"))
    by_order = lines.groupBy("l_orderkey").agg(F.sum("q").alias("q"), F.sum("d").alias("d"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("period"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    joined = by_order.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey"))
    sums = joined.groupBy("c_nationkey", "period").agg(F.sum("q").alias("q"), F.sum("d").alias("d"))
    named = sums.join(F.broadcast(geography(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("entity", "parent", "period", (F.col("d").cast("double") / F.col("q")).alias("value"), F.col("q").cast("double").alias("weight"))


def split(df: DataFrame) -> DataFrame:
    """data_type by period, and bounds 5% around the forecasts."""
    ahead = F.col("period") >= FORECAST_FROM
    out = df.withColumn("data_type", F.when(ahead, "forecast").otherwise("historical"))
    return out.withColumn("lo", F.when(ahead, F.col("value") * 0.95)).withColumn("hi", F.when(ahead, F.col("value") * 1.05))


#: The same panels in DuckDB.
SQL = """
geo AS (SELECT n_nationkey, n_name AS entity, r_name AS parent FROM nation JOIN region ON n_regionkey = r_regionkey),
sums AS (
  SELECT c_nationkey, year(o_orderdate)::INTEGER AS period, sum(CAST(round(o_totalprice * 100) AS BIGINT))::DOUBLE / 100 AS revenue, count(*)::DOUBLE AS orders
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
),
panel AS (
  SELECT entity, parent, 'revenue' AS metric, period, revenue AS value FROM sums JOIN geo ON c_nationkey = n_nationkey
  UNION ALL SELECT entity, parent, 'orders', period, orders FROM sums JOIN geo ON c_nationkey = n_nationkey
),
csums AS (
  SELECT o_custkey, year(o_orderdate)::INTEGER AS period, sum(CAST(round(o_totalprice * 100) AS BIGINT))::DOUBLE / 100 AS revenue, count(*)::DOUBLE AS orders FROM orders GROUP BY 1, 2
),
cpanel AS (
  SELECT c_custkey::BIGINT AS entity, entity AS parent, 'revenue' AS metric, period, revenue AS value FROM csums JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey
  UNION ALL SELECT c_custkey::BIGINT, entity, 'orders', period, orders FROM csums JOIN customer ON o_custkey = c_custkey JOIN geo ON c_nationkey = n_nationkey
),
split AS (
  SELECT *, CASE WHEN period >= 2000 THEN 'forecast' ELSE 'historical' END AS data_type,
         CASE WHEN period >= 2000 THEN value * 0.95::DOUBLE END AS lo, CASE WHEN period >= 2000 THEN value * 1.05::DOUBLE END AS hi FROM panel
),
rates AS (
  SELECT entity, parent, period, d::DOUBLE / q::DOUBLE AS value, q::DOUBLE AS weight FROM (
    SELECT c_nationkey, year(o_orderdate)::INTEGER AS period, sum(l_quantity::BIGINT) AS q, sum(CAST(round(l_discount * 100) AS BIGINT) * l_quantity::BIGINT) AS d
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
  ) t JOIN geo ON c_nationkey = n_nationkey
)
"""
