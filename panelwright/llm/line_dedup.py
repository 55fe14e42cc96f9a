"""Line deduplication by overlapping three-line windows.

Texts are split at line feeds. Every three consecutive lines that hold more than white space form a window, identified
by a 128-bit hash of its lines. A window's first occurrence is the one with the smallest (document id, text hash, line
number), null ids first; every later occurrence covers its lines, and covered lines go. Each line that goes is still there at an earlier place:
the same line of the window's first occurrence either stays or was covered by a window that began earlier still.

Defined results: a text of one or two such lines is one window of its own length, so that whole short copies are
found. Lines of white space alone are in no window and stay unless all others of their text go. A null text has no
windows and stays null; an empty text stays as it is. Rows are told apart by their id and the hash of their text: rows
that share only their id are documents of their own, and so are rows without an id; equal rows (same id and text) count
as one occurrence. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_LINES = 3
_INK = r"[^\x20\x09-\x0D]"


def _bind(value: Column, body) -> Column:
    """body(value) with value computed once; lambda variables aren't recomputed."""
    return F.transform(F.array(value), body)[0]


def line_windows(docs: DataFrame, id_col: str, text_col: str, lines: int = WINDOW_LINES) -> DataFrame:
    """doc_id, digest (of the text), first (index of its first line), last, w1, w2: a row for each window of each document."""
    split = F.split(F.col(text_col), "\n", -1)
    inked = F.filter(F.transform(split, lambda x, i: F.when(x.rlike(_INK), F.struct(i.alias("at"), F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b")))), lambda x: x.isNotNull())

    def windows(kept: Column) -> Column:
        n = F.size(kept)

        def window(i: Column) -> Column:
            part = F.slice(kept, i + 1, lines)
            return F.struct(part[0]["at"].alias("first"), F.element_at(part, -1)["at"].alias("last"), F.xxhash64(F.size(part), part["a"]).alias("w1"), F.xxhash64(F.size(part), part["b"]).alias("w2"))

        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - lines, F.lit(0))), window))

    return docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("digest"), F.explode(_bind(inked, windows)).alias("w")).select("doc_id", "digest", "w.*")


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = WINDOW_LINES) -> DataFrame:
    """doc_id, digest, covered: for each document that loses lines, the merged ranges (first, last) of line numbers.

    First occurrences are found by an aggregate that is combined before the shuffle, and only windows that occur more
    than once are joined back. A very frequent window is a skewed key of that join, which adaptive execution splits.
    """
    every = line_windows(docs, id_col, text_col, lines)
    place = F.struct("doc_id", "digest", "first")
    found = every.groupBy("w1", "w2").agg(F.min(place).alias("earliest"), F.max(place).alias("latest")).where(F.col("earliest") != F.col("latest"))
    later = every.join(found.select("w1", "w2", "earliest"), ["w1", "w2"]).where(place != F.col("earliest"))
    return later.groupBy("doc_id", "digest").agg(F.array_sort(F.collect_set(F.struct("first", "last"))).alias("covered"))


def _without(parts: Column) -> Column:
    """text, n_removed: parts.lines without the ranges in parts.covered."""
    lines = parts["lines"]
    gone = F.array_distinct(F.flatten(F.transform(parts["covered"], lambda r: F.sequence(r["first"], r["last"]))))
    stays = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone)
    kept = F.transform(stays, lambda i: lines[i])
    return _bind(
        kept,
        lambda x: F.struct(F.when(F.exists(x, lambda y: y.rlike(_INK)), F.array_join(x, "\n")).otherwise(F.lit("")).alias("text"), (F.size(lines) - F.size(x)).alias("n_removed")),
    )


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lines: int = WINDOW_LINES) -> DataFrame:
    """``docs`` with its text cleaned, and n_lines and n_removed (long) added; no row goes.

    A text whose lines with ink all go becomes empty. Columns of ``docs`` named n_lines or n_removed are replaced.
    """
    gone = removed_lines(docs, id_col, text_col, lines)
    text = F.col("row")[text_col]
    split = F.split(text, "\n", -1)
    whole = docs.select(F.struct(*docs.columns).alias("row"))
    out = whole.join(gone, F.col("row")[id_col].eqNullSafe(F.col("doc_id")) & (F.xxhash64(text) == F.col("digest")), "left")
    cleaned = _bind(F.struct(split.alias("lines"), F.col("covered").alias("covered")), _without)
    out = out.select("row", F.when(F.col("covered").isNotNull(), cleaned).alias("cleaned"))
    added = {
        "n_lines": F.when(text.isNull(), 0).otherwise(F.size(split)).cast("long"),
        "n_removed": F.coalesce(F.col("cleaned.n_removed"), F.lit(0)).cast("long"),
    }
    kept = [F.coalesce(F.col("cleaned.text"), text).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns if c not in added]
    return out.select(*kept, *[v.alias(k) for k, v in added.items()])
