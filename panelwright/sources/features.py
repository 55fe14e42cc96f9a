"""Collections of geographic features as JSON: read with an explicit schema, joined with attributes, written back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Properties keep their own types, and geometries of any kind stay as they are.
FEATURE = "struct<type:string,id:string,properties:map<string,variant>,geometry:variant>"
COLLECTION = f"struct<type:string,features:array<{FEATURE}>>"


def parsed(texts: DataFrame, text: str, *keep: str) -> DataFrame:
    """``keep``, id, properties and geometry of every feature of JSON texts, each a collection or a single feature.

    A text that is neither gives no rows, nor does a null one; a feature without properties has an empty map.
    """
    both = texts.select(*keep, F.from_json(text, COLLECTION).alias("_c"), F.from_json(text, FEATURE).alias("_f"))
    found = F.when(F.col("_c.type") == "FeatureCollection", F.col("_c.features")).when(F.col("_f.type") == "Feature", F.array("_f"))
    rows = both.select(*keep, F.explode(found).alias("f"))
    return rows.select(*keep, "f.id", F.coalesce("f.properties", F.create_map().cast("map<string,variant>")).alias("properties"), "f.geometry")


def read_features(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """id, properties, geometry of each feature of the files at ``path``.

    Files hold one collection each, which one task reads; with ``lines`` a feature a line, so that large ones are split.
    """
    return parsed(spark.read.text(path, wholetext=not lines), "value")


def property_text(name: str) -> Column:
    """A property as text; null if there is none."""
    return F.col("properties")[name].cast("string")


def with_attributes(features: DataFrame, attributes: DataFrame, code: str, key: str) -> DataFrame:
    """``features`` with the entries of ``attributes`` (key, attributes: map<string,double>) in their properties.

    They are joined by the property ``code``. Where both have an entry of a name, the attribute's counts; features without
    attributes stay as they are.
    """
    more = attributes.select(F.col(key).cast("string").alias("_code"), F.transform_values("attributes", lambda _, v: v.cast("variant")).alias("_more"))
    joined = features.withColumn("_code", property_text(code)).join(more, "_code", "left")
    own = F.map_filter("properties", lambda k, _: F.col("_more").isNull() | ~F.map_contains_key(F.col("_more"), k))
    new = F.when(F.col("_more").isNull(), F.col("properties")).otherwise(F.map_concat(own, F.coalesce("_more", F.create_map().cast("map<string,variant>"))))
    return joined.withColumn("properties", new).drop("_code", "_more")


def as_json(features: DataFrame) -> DataFrame:
    """value: each feature as a line of JSON."""
    feature = F.struct(F.lit("Feature").alias("type"), "id", "properties", "geometry")
    return features.select(F.to_json(feature).alias("value"))


def write_features(features: DataFrame, path: str) -> None:
    """A feature a line, in as many files as ``features`` has partitions."""
    as_json(features).write.mode("overwrite").text(path)
