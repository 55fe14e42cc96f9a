"""Token counts of a document's sections by offset-mapped attribution.

A whole document is encoded once. Tokens of a byte-level vocabulary concatenate to the text's bytes, so the sums of
their lengths are their spans, which are mapped to characters. The spans are then joined to the sections by interval:
both lists are sorted, and two binary searches give the first and last section that each token meets.

The rule for tokens that cross a boundary: a token belongs to the section that holds most of its characters, the
earlier one if several do. A token that holds no whole character belongs where its first byte lies. Each token is
counted once, so a document's counts add up to its tokens.

Sections are a text's lines, each with its line feed. Defined results: a null or empty text is one empty section with
no tokens; an empty line is a section that holds its line feed. Equal rows give equal results. An empty table gives no
rows. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.llm.packing import encoder
from panelwright.llm.textbytes import code_points

_COLUMNS = "doc_id long, section int, start int, end int, n_tokens int, n_crossing int"


def token_spans(text: str, lengths: np.ndarray) -> np.ndarray:
    """The byte offsets between a text's tokens, from 0 to its end; lengths: bytes of each id."""
    ids = encoder().ids(text)
    out = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(lengths[ids], out=out[1:])
    return out


def attribute(token_edges: np.ndarray, section_edges: np.ndarray, characters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each section, the tokens that belong to it, and those of them that cross into another.

    Edges are byte offsets; characters: for each byte offset, the characters that begin before it.
    """
    n = len(section_edges) - 1
    first = np.clip(np.searchsorted(section_edges, token_edges[:-1], side="right") - 1, 0, n - 1)
    last = np.clip(np.searchsorted(section_edges, token_edges[1:], side="left") - 1, 0, n - 1)
    owner = first.copy()
    for t in np.flatnonzero(last > first):  # one pass over the sections that a crossing token meets
        cuts = np.concatenate([[token_edges[t]], section_edges[first[t] + 1 : last[t] + 1], [token_edges[t + 1]]])
        owner[t] = first[t] + int(np.argmax(np.diff(characters[cuts])))
    return np.bincount(owner, minlength=n), np.bincount(owner[last > first], minlength=n)


def section_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, section (from 0), start, end (code points), n_tokens, n_crossing: a row for each section."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = encoder().ranks
        lengths = np.zeros(max(*ranks.values(), *encoder().added.values()) + 1, np.int64)
        lengths[list(ranks.values())] = [len(b) for b in ranks]
        for content, i in encoder().added.items():
            lengths[i] = len(content.encode())
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield rows(batch.slice(at, 256), lengths)

    def rows(batch: pa.RecordBatch, lengths: np.ndarray) -> pa.RecordBatch:
        parts: list[tuple[np.ndarray, ...]] = []
        for value in batch.column(1):
            text = value.as_py() or ""
            data = np.frombuffer(text.encode(), np.uint8)
            ends = np.flatnonzero(data == 10) + 1
            edges = np.concatenate([[0], ends if len(ends) and ends[-1] == len(data) else np.append(ends, len(data))])
            characters = code_points(data)
            counts, crossing = attribute(token_spans(text, lengths), edges, characters)
            places = characters[edges]
            parts.append((np.arange(len(counts)), places[:-1], places[1:], counts, crossing))
        ids = np.repeat(np.arange(len(parts)), [len(p[0]) for p in parts])
        columns = [batch.column(0).take(pa.array(ids))] + [pa.array(np.concatenate([p[k] for p in parts]).astype(np.int32)) for k in range(5)]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "section", "start", "end", "n_tokens", "n_crossing"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, _COLUMNS)
