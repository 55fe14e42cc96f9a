"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet and reads it again as the
next one's ``docs``. All but the last keep the columns of ``documents``; stages that change a text set n_chars anew, where
``docs`` has it.

A document that the quality rules reject goes; so does one whose lines were all removed as repeats, and all but one of
each class of near duplicates. Personal data is replaced by its kind. What is left is packed.

Defined results: a row is told apart by its doc_id, which may be null or repeated, and the hash of its text. Rows of one
id with different texts are documents each for itself. Of a class of near duplicates the row with the smallest id stays,
of equal ids that with the smallest hash, one without an id only if none has one; of equal rows one stays, the first by
its other columns. (Line deduplication takes a row without an id as earlier than those with one.) A null text or one without words fails the quality rules. An empty table runs through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.llm.line_dedup import dedup_lines
from panelwright.llm.near_dup import Bound, near_duplicates
from panelwright.llm.packing import pack
from panelwright.llm.pii import redact
from panelwright.llm.quality import quality
from panelwright.llm.scratch import cleared, discard, materialise

#: Rows to drop that may be broadcast; beyond it the same join shuffles.
BROADCAST_ROWS = 500_000


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _of(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """The rows of ``docs`` that are among ``rows`` (doc_id, digest), or with left_anti those that aren't."""
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.xxhash64("d.text") == F.col("r.digest"))
    return docs.alias("d").join(rows.alias("r"), same, how).select("d.*")


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rejected = materialise(quality(docs).where("not kept").select("doc_id", "digest").distinct(), "rejected")
    return _of(docs, _small(rejected), "left_anti")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(docs).where("n_removed = 0 or text <> ''")
    return _measured(cleaned.select(docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = near_duplicates(docs, bound=Bound(percent=80, n=5)).groupBy("doc_id", "digest").agg(F.min("first").alias("first"), F.count(F.lit(1)).alias("n"), F.max("n_shingles").alias("size"))
    marked = materialise(rows.where("size > 0 and (not first or n > 1)"), "marked")
    left = _of(docs, _small(marked), "left_anti")
    twice = _of(docs, _small(marked.where("first")), "left_semi")
    row = F.struct(*twice.columns)
    once = twice.groupBy("doc_id", F.xxhash64("text").alias("digest")).agg(F.min_by(row, F.to_json(row)).alias("row"))
    return left.unionByName(once.select("row.*"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(redact(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("ngram_jaccard_join", near_dedup), ("pii", pii), ("packing", packing)]

#: Posterior probabilities, trained spans and token ids aren't expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        with cleared() as made:
            docs = materialise(stage(spark, docs, sf_dir), name)
            made.remove(docs)
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
