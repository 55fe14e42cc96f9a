"""The registered queries of this subpackage, one per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df.select(*columns) if columns else df


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without the lines of repeated three-line windows."""
    from panelwright.llm.line_dedup import dedup_lines

    return dedup_lines(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    from panelwright.llm.toxicity import toxicity

    return toxicity(_read(spark, sf_dir, "documents", "doc_id", "text", "lang"), _read(spark, sf_dir, "labels", "doc_id", "toxic"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document in sequences of 1024 tokens, each window holding the sources' overall shares."""
    from panelwright.llm.packing import pack

    pieces = pack(_read(spark, sf_dir, "documents", "doc_id", "text", "source"), keep_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL: four rules, else the classifier."""
    from panelwright.llm.urls import Rule, judge

    rules = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]
    return judge(_read(spark, sf_dir, "pages", "page_id", "url"), rules)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every line of every document."""
    from panelwright.llm.token_counts import section_tokens

    return section_tokens(_read(spark, sf_dir, "documents", "doc_id", "text"))


def op6_sampled_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sampled segmentations of every whole document."""
    from panelwright.llm.segmentation import sample

    rows = sample(_read(spark, sf_dir, "documents", "doc_id", "text"), k=2, keep_ids=False)
    return rows.drop("ids")


def segmentation_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts of ``benchmark`` as two sampled segmentations of each decode."""
    from panelwright.llm.segmentation import decoded, sample

    rows = sample(_read(spark, sf_dir, "benchmark", "item_id", "text"), k=2, id_col="item_id")
    return rows.select(F.col("doc_id").alias("item_id"), "rank", decoded(F.col("ids")).alias("text"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts, the posterior probability of good quality and the verdict of every document."""
    from panelwright.llm.quality import quality

    rows = quality(_read(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and a digest of every document's base spans, and all its spans."""
    from panelwright.llm.pii import BASE_KINDS, detect, digest

    found = detect(_read(spark, sf_dir, "documents", "doc_id", "text"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(digest(F.col("base")), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's class of near duplicates: four-word shingles, Jaccard similarity of 0.85 or more."""
    from panelwright.llm.near_dup import Bound, near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents", "doc_id", "text"), bound=Bound(percent=85, n=4)).select("doc_id", "n_shingles", "component_id")


def op10_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best others of every vector whose id is divisible by 50."""
    from panelwright.llm.topk import top_k

    vectors = _read(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    from panelwright.llm.pages import main_text

    return main_text(_read(spark, sf_dir, "pages", "page_id", "url", "html"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents of every item of ``benchmark``."""
    from panelwright.llm.lexical import lexical_search

    return lexical_search(_read(spark, sf_dir, "documents", "doc_id", "text"), _read(spark, sf_dir, "benchmark", "item_id", "text"), k=20)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of the five positives of every hundredth vector."""
    from panelwright.llm.hard_negatives import hard_negatives

    vectors = _read(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    vectors = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith(("op", "segmentation_")) and name != "oracle_sql"}


def oracle_sql() -> dict[str, str]:
    from panelwright.llm import oracles

    return {name.lower(): text for name, text in vars(oracles).items() if name.isupper()}
