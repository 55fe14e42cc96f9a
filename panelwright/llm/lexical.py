"""Ranked lexical search with Fagin's threshold algorithm.

Two passes over Spark partitions. The first counts every document's terms in numpy and writes a forward index: a row for
each document with its length and its counts of those terms that some item asks for. Lengths and document frequencies are
summed by Spark. The second turns runs of forward rows into inverted lists sorted by impact, and for every item reads its
lists round-robin. A document met for the first time is looked up in the forward index for its whole score. Reading stops
once the threshold, what a document not yet met could score at most, falls strictly below the item's kth score; that score
is carried from run to run within a task. Documents are never shuffled, only each task's k best of each item.

Items are taken in blocks of at most ``BLOCK_TERMS`` distinct pairs of item and term (one item alone may hold more), which
travel to the tasks; each block reads the documents once.

Defined results: a null text, of a document or an item, holds no term, and an item without terms, or whose terms no
document holds, gives no rows. Documents of equal ids are documents each for itself. A document without an id counts in the
statistics but isn't returned, and an item without an id isn't asked. Equal items are asked once; items of one id with
different texts are ranked each for itself, so that ranks repeat for that id. Equal scores rank by ascending doc_id. An
empty table on either side gives no rows. Other columns, whatever their names, aren't read. Terms are told apart by 64-bit
hashes. A text is worked on in pieces of 2 MB, so that a very long one needs no more memory than many short ones.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.scratch import discard, materialise
from panelwright.llm.textbytes import NOT_LETTERS, PIECE_BYTES, cuts, pieces, span_hashes, word_bounds

#: Pairs of item and term in a block of items.
BLOCK_TERMS = 1 << 18
#: A run of documents whose lists are built together ends at so many postings or documents.
RUN_POSTINGS, RUN_DOCUMENTS = 1 << 20, 1 << 17
#: Entries that the first round reads of each list; each round reads twice as many as the one before.
FIRST_ROUND = 64


def term_hashes(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(rows, row, hash) of each term, piece by piece; a long text comes in several pieces of which the last counts its row."""
    for _, n, data, offsets in pieces(column):
        if n == 1 and len(data) > PIECE_BYTES:
            parts = list(cuts(data))
            for k, (a, b) in enumerate(parts):
                start, end, row = word_bounds(data[a:b], np.array([0, b - a]), NOT_LETTERS)
                yield int(k == len(parts) - 1), row, span_hashes(data[a:b], start, end, lower=True)
        else:
            start, end, row = word_bounds(data, offsets, NOT_LETTERS)
            yield n, row, span_hashes(data, start, end, lower=True)


def _lists(row: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    ends = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def _counted(column: pa.Array, terms: np.ndarray | None) -> tuple[pa.Array, pa.Array, pa.Array]:
    """Each row's number of terms, and its distinct terms with their counts: those of ``terms`` by place there, or all by hash."""
    lengths, rows, found, counts, at = np.zeros(len(column), np.int64), [], [], [], 0
    for n, row, term in term_hashes(column):
        row = row + at
        lengths += np.bincount(row, minlength=len(column))
        at += n
        if terms is not None:
            place = np.searchsorted(terms, term)
            place[place == len(terms)] = 0
            known = terms[place] == term if len(terms) else np.zeros(len(term), bool)
            row, term = row[known], place[known]
        order = np.lexsort((term, row))
        row, term = row[order], term[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
        first = np.flatnonzero(first)
        rows.append(row[first]), found.append(term[first]), counts.append(np.diff(np.append(first, len(row))))
    row, term, count = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (rows, found, counts))
    if len(rows) > 1:  # pieces of one long text may share terms
        order = np.lexsort((term, row))
        row, term, count = row[order], term[order], count[order]
        first = np.ones(len(row), bool)
        first[1:] = (row[1:] != row[:-1]) | (term[1:] != term[:-1])
        first = np.flatnonzero(first)
        row, term, count = row[first], term[first], np.add.reduceat(count, first) if len(first) else count
    kind = pa.int64() if terms is None else pa.int32()
    values = term.view(np.int64) if terms is None else term.astype(np.int32)
    return pa.array(lengths), _lists(row, values, len(column), kind), _lists(row, count, len(column), pa.int64())


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, query, terms (distinct hashes), counts of each item that has a term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, terms, counts = _counted(b.column(2), None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), terms, counts], ["item_id", "query", "terms", "counts"])

    asked = items.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).distinct()
    return asked.select("item_id", F.xxhash64("text").alias("query"), "text").mapInArrow(run, "item_id long, query long, terms array<long>, counts array<long>").where(F.size("terms") > 0)


def forward_index(docs: DataFrame, terms: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (terms with repeats), terms (places in the sorted ``terms``), counts of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), *_counted(b.column(1), terms)], ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


class ImpactLists:
    """Inverted lists of a run of documents, each sorted by falling impact, and the forward index of the same documents."""

    def __init__(self, ids: np.ndarray, impacts: np.ndarray, terms: np.ndarray, starts: np.ndarray, n_terms: int):
        self.ids, self.impacts, self.terms, self.starts = ids, impacts, terms, starts
        order = np.lexsort((-impacts, terms))
        self.doc = np.repeat(np.arange(len(ids)), np.diff(starts))[order]
        self.falling = impacts[order]
        self.bounds = np.searchsorted(terms[order], np.arange(n_terms + 1))
        self.seen, self.times = np.zeros(len(ids), bool), np.zeros(n_terms, np.int64)

    def scores(self, docs: np.ndarray) -> np.ndarray:
        """Random lookups: the whole score of each of ``docs``, all of which hold a term."""
        sizes = self.starts[docs + 1] - self.starts[docs]
        begins = np.cumsum(sizes) - sizes
        at = np.arange(sizes.sum()) - np.repeat(begins - self.starts[docs], sizes)
        return np.add.reduceat(self.times[self.terms[at]] * self.impacts[at], begins)

    def search(self, terms: np.ndarray, counts: np.ndarray, k: int, best: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """``best``, the ids and scores of the k best so far, with this run's documents taken in."""
        self.times[terms] = counts
        first, last = self.bounds[terms], self.bounds[terms + 1]
        met, at, step = [], 0, FIRST_ROUND
        ids, scores = best
        while True:
            spans = [slice(a + at, min(a + at + step, b)) for a, b in zip(first, last, strict=True) if a + at < b]
            if not spans:
                break
            fresh = np.zeros(len(self.seen), bool)
            for s in spans:
                fresh[self.doc[s]] = True
            docs = np.flatnonzero(fresh & ~self.seen)
            if len(docs):
                self.seen[docs] = True
                met.append(docs)
                found = self.scores(docs)
                worth = found > 0
                ids, scores = np.append(ids, self.ids[docs][worth]), np.append(scores, found[worth])
                keep = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[keep], scores[keep]
            at += step
            step *= 2
            going = first + at < last
            threshold = int((counts[going] * self.falling[first[going] + at - 1]).sum())
            if len(ids) == k and threshold < scores[-1]:
                break
        for docs in met:
            self.seen[docs] = False
        self.times[terms] = 0
        return ids, scores


def _ranked_block(docs: DataFrame, asked: pa.Table, k: int, id_col: str, text_col: str) -> DataFrame:
    """The k best documents of each item of ``asked``: item_id, query, doc_id, score, rank."""
    flat, ends = asked["terms"].combine_chunks(), np.cumsum([0, *(len(x) for x in asked["terms"])])
    hashes = flat.flatten().to_numpy().view(np.uint64)
    terms, places = np.unique(hashes, return_inverse=True)
    counts = asked["counts"].combine_chunks().flatten().to_numpy()
    items = [(i, q, places[a:b], counts[a:b]) for i, q, a, b in zip(asked["item_id"].to_pylist(), asked["query"].to_pylist(), ends[:-1], ends[1:], strict=True)]
    index = materialise(forward_index(docs, terms, id_col, text_col), "forward_index")
    n_docs, n_terms = index.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(terms), np.int64)
    held = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).toArrow()
    for term, df in zip(held["term"].to_pylist(), held["df"].to_pylist(), strict=True):
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(items)
        waiting: list[tuple] = []

        def search() -> None:
            ids, n, sizes, places, tf = (np.concatenate(x) for x in zip(*waiting, strict=True))
            waiting.clear()
            m = 75 + 25 * n * n_docs // n_terms
            impacts = weights[places] * (1_000_000_000 * tf // (1000 * tf + 12 * np.repeat(m, sizes)))
            lists = ImpactLists(ids, impacts, places, np.append(0, np.cumsum(sizes)), len(terms))
            for j, (_, _, own, times) in enumerate(items):
                best[j] = lists.search(own, times, k, best[j])

        for b in batches:
            b = b.filter(pa.array([x is not None and y > 0 for x, y in zip(b.column(0).to_pylist(), b.column(2).value_lengths().to_pylist(), strict=True)], pa.bool_()))
            if not len(b):
                continue
            waiting.append((b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).value_lengths().to_numpy(), b.column(2).flatten().to_numpy(), b.column(3).flatten().to_numpy()))
            if sum(len(w[3]) for w in waiting) >= RUN_POSTINGS or sum(len(w[0]) for w in waiting) >= RUN_DOCUMENTS:
                search()
        if waiting:
            search()
        for (item, query, _, _), (ids, scores) in zip(items, best, strict=True):
            if len(ids):
                n = len(ids)
                yield pa.RecordBatch.from_arrays([pa.array([item] * n, pa.int64()), pa.array([query] * n, pa.int64()), pa.array(ids), pa.array(scores)], ["item_id", "query", "doc_id", "score"])

    hits = materialise(index.mapInArrow(run, "item_id long, query long, doc_id long, score long"), "hits")
    discard(index)
    order = Window.partitionBy("item_id", "query").orderBy(F.col("score").desc(), "doc_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def lexical_search(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: for each row of ``items`` its k best documents with a score above 0."""
    asked = materialise(item_terms(items, item_id_col, item_text_col), "items")
    pairs = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = max(1, -(-pairs // BLOCK_TERMS))
    out = None
    for i in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("item_id", "query"), F.lit(blocks)) == i).toArrow()
        ranked = _ranked_block(docs, block, k, id_col, text_col)
        out = ranked if out is None else out.unionByName(ranked)
    discard(asked)
    return out.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
