"""Toxicity scores by a convolutional text classifier, trained and applied in numpy inside tasks.

A word's embedding is the sum of hashed vectors of the word and of its beginnings, so that unseen forms of a known stem
are recognised. Filters of several widths slide over the words; each keeps its largest response over the whole text,
and a logistic layer turns those into a score. Only the winning windows carry gradient, so training is fast.

Training takes all labelled rows, dealt by hashes of their ids into shards of about ``rows`` texts. In each of a few
rounds every shard goes on from the same network, a text at a time; Spark then averages what the shards changed, a bucket's
vector over the shards that met the bucket. The changes are summed as whole numbers, so that neither partitions nor the
order of the sums matter. Four fifths of the rows fit the network, and the rest set the thresholds.

A score depends on the text alone. The language only chooses the threshold of the flag that comes with it, calibrated
on rows that the filters weren't fitted to.

Defined results: words are runs of bytes other than ASCII marks and white space, A-Z lower-cased. A null or empty text,
or one without words, gets the score of no response at all. Without labelled rows of both classes every score is the
smoothed share of toxic rows. Conflicting labels of a document are rows of their own. An empty table gives no rows.
Equal rows get equal results. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.llm.scratch import cleared, materialise
from panelwright.llm.textbytes import NOT_LETTERS, cuts, pieces, span_hashes, word_bounds

#: Hash buckets, dimensions of a word, widths of the filters and filters of each width.
BUCKETS, DIMENSIONS, WIDTHS, FILTERS = 1 << 17, 8, (1, 2, 3), 8
#: Bytes of the beginnings that are hashed beside the whole word, where the word is longer: a bare stem and a stem that
#: goes on then differ.
STEMS = (4, 6, 7)
#: Passes over the rows: this many at least, and as many more as few rows need for so many updates. Several shards share
#: them out among so many rounds.
PASSES, UPDATES, ROUNDS = 8, 30_000, 4
#: Texts, and bytes of text, of a shard: more rows make more shards.
SHARD_ROWS, SHARD_BYTES = 5000, 1 << 25
#: Labels that are broadcast at most to look up their texts; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: Changes are added up in units of 1 / SCALE.
SCALE = 2.0**32
PREDICT_FROM = 0.7
#: Cells of the logits (a unit has so many, at most CLIP to either side) by which held rows are counted for the thresholds.
CELLS, CLIP = 1024, 30
#: Words whose responses are worked out at once.
BLOCK_WORDS = 1 << 16

_PAD = BUCKETS  # its vector stays zero
# a filter and a place of its window, for every place that its width covers
_FILTER, _PLACE = np.array([(k * FILTERS + f, j) for j in range(max(WIDTHS)) for k, w in enumerate(WIDTHS) if w > j for f in range(FILTERS)]).T


def word_features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, heads) of consecutive texts: a row of hash buckets a word, each text followed by padding."""
    pad = max(WIDTHS) - 1
    for _, rows, data, offsets in pieces(column):
        parts = []
        for a, b in cuts(data) if rows == 1 else [(0, len(data))]:  # a long text's words, a part at a time
            start, end, row = word_bounds(data[a:b], np.array([0, b - a]) if rows == 1 else offsets, NOT_LETTERS)
            counts = np.bincount(row, minlength=rows)
            closing = pad if b == len(data) else 0
            out = np.full((len(start) + closing * rows, 1 + len(STEMS)), _PAD, np.int32)
            at = np.arange(len(start)) + pad * row
            for k, length in enumerate((None, *STEMS)):
                longer = slice(None) if length is None else np.flatnonzero(end - start > length)
                stop = end if length is None else start[longer] + length
                out[at[longer], k] = (span_hashes(data[a:b], start[longer], stop, lower=True) + np.uint64(k)) % np.uint64(BUCKETS)
            parts.append(out)
        yield (parts[0], np.cumsum(counts + pad) - (counts + pad)) if len(parts) == 1 else (np.concatenate(parts), np.zeros(1, np.int64))


@dataclass
class Network:
    """Vectors of the buckets, filters (filter, place, dimension; zero beyond their widths), and the layer over the responses."""

    vectors: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    weights: np.ndarray
    bias: float
    thresholds: dict[str | None, float] = field(default_factory=dict)

    def responses(self, features: np.ndarray) -> np.ndarray:
        """A row for each filter, a column for each place; below any response where no word begins."""
        found = self.vectors.take(features, axis=0)  # much faster than indexing
        x = found[:, 0] + found[:, 1]
        for k in range(2, features.shape[1]):
            x += found[:, k]
        projected = self.filters[_FILTER, _PLACE] @ x.T
        out, at = projected[: len(self.filters)] + self.offsets[:, None], len(self.filters)
        for j in range(1, max(WIDTHS)):
            n = FILTERS * sum(w > j for w in WIDTHS)  # the last ones reach so far
            out[-n:, : max(len(x) - j, 0)] += projected[at : at + n, j:]
            at += n
        out[:, np.flatnonzero(features[:, 0] == _PAD)] = -1e9
        return out

    def best(self, features: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """The largest response of each filter over each text, 0 at least; words are taken a block at a time."""
        out = np.zeros((len(heads), FILTERS * len(WIDTHS)), np.float32)
        for first in range(0, len(features), BLOCK_WORDS):
            last = min(first + BLOCK_WORDS, len(features))
            found = self.responses(features[first : last + max(WIDTHS) - 1])[:, : last - first]
            a, b = np.searchsorted(heads, first, side="right") - 1, np.searchsorted(heads, last)
            out[a:b] = np.maximum(out[a:b], np.maximum.reduceat(found, np.maximum(heads[a:b] - first, 0), axis=1).T)
        return out

    def logits(self, features: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return np.clip(self.best(features, heads) @ self.weights + self.bias, -CLIP, CLIP)

    def scores(self, features: np.ndarray, heads: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.logits(features, heads)))

    def rows(self) -> np.ndarray:
        """All numbers, ``DIMENSIONS`` to a row: a row for each bucket, then the others."""
        rest = np.concatenate([self.filters.ravel(), self.offsets, self.weights, [self.bias]])
        return np.concatenate([self.vectors, np.pad(rest, (0, -len(rest) % DIMENSIONS)).reshape(-1, DIMENSIONS)]).astype(np.float32)


def from_rows(rows: np.ndarray) -> Network:
    """The network of these ``rows``; nothing is shared with them."""
    n, rest = FILTERS * len(WIDTHS), rows[BUCKETS + 1 :].ravel()
    filters, offsets, weights, bias = np.split(rest, np.cumsum([n * max(WIDTHS) * DIMENSIONS, n, n]))
    return Network(rows[: BUCKETS + 1].copy(), filters.reshape(n, max(WIDTHS), DIMENSIONS).copy(), offsets.copy(), weights.copy(), float(bias[0]))


def fresh(seed: int, bias: float = -2.0) -> Network:
    r = np.random.default_rng(seed)
    vectors = r.normal(0, 0.06, (BUCKETS + 1, DIMENSIONS)).astype(np.float32)  # small: words that training never met hardly respond
    vectors[_PAD] = 0
    filters = np.zeros((FILTERS * len(WIDTHS), max(WIDTHS), DIMENSIONS), np.float32)
    for k, w in enumerate(WIDTHS):
        filters[k * FILTERS : (k + 1) * FILTERS, :w] = r.normal(0, 0.5 / np.sqrt(w), (w, DIMENSIONS, FILTERS)).transpose(2, 0, 1)
    return Network(vectors, filters, np.zeros(len(filters), np.float32), r.normal(0, 0.3, len(filters)).astype(np.float32), bias)


def start(seed: int) -> np.ndarray:
    """Rows of a fresh network, beside them those of AdaGrad's sums of squares."""
    rows = fresh(seed, 0.0).rows()
    return np.concatenate([rows, np.full(rows.shape, 1e-2, np.float32)], axis=1)


def fit(net: Network, squares: Network, texts: list[tuple[np.ndarray, float]], passes: int, r: np.random.Generator, rate: float = 0.05) -> None:
    """AdaGrad over (features, label) from where ``net`` and ``squares`` are, a text at a time; heads of a single text are [0]."""
    vectors, sums, each_place = net.vectors.reshape(-1), squares.vectors.reshape(-1), np.arange(DIMENSIONS)
    for _ in range(passes):
        for i in r.permutation(len(texts)):
            features, label = texts[i]
            response = net.responses(features)
            where = response.argmax(axis=1)
            best = np.maximum(response[np.arange(len(where)), where], 0)
            error = float(label - 1 / (1 + np.exp(-np.clip(best @ net.weights + net.bias, -30, 30))))
            back = error * net.weights * (best > 0)
            g = error * best - 1e-5 * net.weights
            squares.weights += g * g
            squares.bias += error * error
            net.weights += rate * g / np.sqrt(squares.weights)
            net.bias += rate * error / np.sqrt(squares.bias)
            live = np.flatnonzero(back[_FILTER])
            if not len(live):
                continue
            which, place = _FILTER[live], _PLACE[live]
            d = back[which][:, None]
            buckets = features[where[which] + place]  # of the winning windows' words; padding follows every text
            gradient, to_words = d * net.vectors.take(buckets, axis=0).sum(axis=1), d * net.filters[which, place]
            squares.filters[which, place] += gradient * gradient
            net.filters[which, place] += rate * gradient / np.sqrt(squares.filters[which, place])
            squares.offsets += back * back
            net.offsets += rate * back / np.sqrt(squares.offsets)
            flat = (buckets.reshape(-1, 1).astype(np.int64) * DIMENSIONS + each_place).reshape(-1)
            each = np.repeat(to_words, buckets.shape[1], axis=0).reshape(-1)
            np.add.at(sums, flat, each * each)
            np.add.at(vectors, flat, rate * each / np.sqrt(sums.take(flat)))
            net.vectors[_PAD] = 0


def best_threshold(scores: np.ndarray, labels: np.ndarray, counts: np.ndarray | None = None, ends: tuple[float, float] = (0.0, 1.0)) -> float:
    """Midway between the neighbouring scores at which the fewest rows are on the wrong side; ``counts``: rows of each entry."""
    order = np.argsort(-scores, kind="stable")
    s, y = scores[order], labels[order]
    n = np.ones(len(s), np.int64) if counts is None else counts[order]
    wrong = np.concatenate([[0], np.cumsum((1 - y) * n)]) + (y * n).sum() - np.concatenate([[0], np.cumsum(y * n)])
    wrong[1:-1][s[1:] == s[:-1]] = n.sum() + 1
    k = int(np.argmin(wrong))
    return float((s[k - 1] if k else ends[1]) + (s[k] if k < len(s) else ends[0])) / 2


def dealt(rows: DataFrame, shards: int) -> DataFrame:
    """shard, texts: a row for each shard, with its (y, order, text, lang) in that order."""
    row = F.struct("y", "order", "text", "lang")
    by_shard = rows.select(F.pmod(F.xxhash64("order", F.lit(31)), F.lit(shards)).alias("shard"), row.alias("row"))
    return by_shard.repartition(shards, "shard").groupBy("shard").agg(F.sort_array(F.collect_list("row")).alias("texts"))


def _texts(batch: pa.RecordBatch, held: bool) -> Iterator[tuple[int, pa.StructArray, list[np.ndarray]]]:
    """(shard, rows, features of each) of the rows that thresholds take, or of the others."""
    for shard, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        rows = rows.values
        rows = rows.filter(pa.array((rows.field("order").to_numpy() % 5 == 0) == held))
        found = [x for features, heads in word_features(rows.field("text")) for x in np.split(features, heads[1:])]
        yield shard, rows, found


def one_round(shards: DataFrame, state: np.ndarray, passes: int, seed: int) -> np.ndarray:
    """``state`` after every shard has gone ``passes`` times over its texts: the mean change of each row where it changed."""
    columns = [f"c{i}" for i in range(state.shape[1])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, rows, found in _texts(batch, held=False):
                net, squares = from_rows(state[:, :DIMENSIONS]), from_rows(state[:, DIMENSIONS:])
                fit(net, squares, list(zip(found, rows.field("y").to_numpy().astype(float), strict=True)), passes, np.random.default_rng(seed + shard))
                after = np.concatenate([net.rows(), squares.rows()], axis=1)
                where = np.flatnonzero((after != state).any(axis=1))
                whole = np.rint((after[where].astype(np.float64) - state[where]) * SCALE).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(where), *(pa.array(c) for c in np.ascontiguousarray(whole.T))], ["row", *columns])

    changes = shards.mapInArrow(run, ", ".join(f"{c} long" for c in ["row", *columns]))
    means = changes.groupBy("row").agg(F.count("*").alias("n"), *(F.sum(c).alias(c) for c in columns)).toArrow()
    out = state.astype(np.float64)
    if means.num_rows:
        total = np.stack([means[c].to_numpy() for c in columns], axis=1)
        out[means["row"].to_numpy()] += total / SCALE / means["n"].to_numpy()[:, None]
    return out.astype(np.float32)


def thresholds(shards: DataFrame, net: Network) -> dict[str | None, float]:
    """Of each language with at least 10 held rows of either class, and of all rows under None."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, rows, found in _texts(batch, held=True):
                logits = np.array([net.logits(x, np.array([0]))[0] for x in found], np.float64)
                yield pa.RecordBatch.from_arrays([rows.field("lang"), rows.field("y"), pa.array(np.rint(logits * CELLS).astype(np.int32))], ["lang", "y", "cell"])

    def best(rows: list) -> float:
        cells, labels, counts = (np.array([r[c] for r in rows], np.int64) for c in ("cell", "y", "n"))
        middle = best_threshold(cells, labels, counts, ends=(-(CLIP + 1) * CELLS, (CLIP + 1) * CELLS))
        return float(1 / (1 + np.exp(-middle / CELLS)))

    counted = materialise(shards.mapInArrow(run, "lang string, y int, cell int").groupBy("lang", "y", "cell").agg(F.count("*").alias("n")), "cells")
    every = counted.groupBy("y", "cell").agg(F.sum("n").alias("n")).collect()
    out: dict[str | None, float] = {None: best(every) if every else PREDICT_FROM}
    enough = counted.groupBy("lang").agg(F.sum(F.col("y") * F.col("n")).alias("ones"), F.sum((1 - F.col("y")) * F.col("n")).alias("zeros")).where(F.least("ones", "zeros") >= 10).select("lang")
    by_language: dict[str, list] = {}
    for r in counted.join(enough, "lang").collect():
        by_language.setdefault(r["lang"], []).append(r)
    return out | {language: best(by_language[language]) for language in sorted(by_language)}


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "toxic", lang_col: str = "lang", order_col: str = "order", rows: int = SHARD_ROWS, seed: int = 3, shares: dict[int, int] | None = None) -> Network:
    """Fit on four fifths of all labelled rows, correct the bias by the classes' shares, and set thresholds on the rest.

    ``labelled`` also has the length of each text in a column bytes, so that counting needs no text.
    ``shares``: how many rows each class has, where some have no text; else they are counted. ``rows``: texts of a shard.
    A language with fewer than 10 held rows of either class takes the threshold of all rows, under the key None.
    """
    label = F.col(label_col).cast("int")
    usable = labelled.where(label.isin(0, 1)).select(label.alias("y"), F.col(order_col).cast("long").alias("order"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"), "bytes")
    found = usable.groupBy("y").agg(F.count("*").alias("n"), F.count_if(F.col("order") % 5 != 0).alias("fitted"), F.sum("bytes").alias("bytes")).collect()
    taken = {y: sum(r["n"] for r in found if r["y"] == y) for y in (0, 1)}
    counts = shares if shares is not None else taken
    odds = np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 9))
    if not taken[0] or not taken[1]:
        net = fresh(seed, float(odds))
        net.weights[:] = 0
        net.thresholds = {None: 1.0}
        return net
    count = max(-(-sum(taken.values()) // rows), -(-sum(r["bytes"] for r in found) // SHARD_BYTES))
    passes = max(PASSES, -(-UPDATES // max(sum(r["fitted"] for r in found), 1)))
    rounds = 1 if count == 1 else ROUNDS
    with cleared():
        shards = materialise(dealt(usable, count), "shards")
        state = start(seed)
        for i in range(rounds):
            state = one_round(shards, state, -(-passes // rounds), seed + i * count)
        net = from_rows(state[:, :DIMENSIONS])
        net.bias += float(odds - np.log(taken[1] / taken[0]))
        net.thresholds = thresholds(shards, net)
    return net


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training never sees."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, score, predicted (from 0.7 on), threshold (of the language) and flagged (from there on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [net.scores(features, heads) for features, heads in word_features(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.concatenate(found).astype(np.float64) if found else [], pa.float64())], ["doc_id", "lang", "score"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    threshold = F.lit(net.thresholds[None])
    for language, value in net.thresholds.items():
        if language is not None:
            threshold = F.when(F.coalesce("lang", F.lit("")) == language, F.lit(value)).otherwise(threshold)
    scored = chosen.mapInArrow(run, "doc_id long, lang string, score double")
    return scored.select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= PREDICT_FROM).cast("int").alias("predicted"), threshold.alias("threshold"), (F.col("score") >= threshold).alias("flagged")
    )


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", rows: int = SHARD_ROWS) -> DataFrame:
    """Train on all labelled rows that aren't held out, in shards of about ``rows``, then ``score`` every row."""
    usable = labels.where(~held_out(id_col) & F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic"), F.abs(F.xxhash64(F.col(id_col), F.lit(29)) % 1_000_003).alias("order"))
    shares = {r[0]: r[1] for r in usable.groupBy("toxic").count().collect()}
    text = F.col(text_col).cast("string")
    texts = docs.where(~held_out(id_col)).select(F.col(id_col).alias("_id"), text.alias("text"), F.col(lang_col).alias("lang"), F.octet_length(F.coalesce(text, F.lit(""))).alias("bytes"))
    few = sum(shares.values()) <= BROADCAST_ROWS
    labelled = texts.join(F.broadcast(usable) if few else usable, "_id").select("text", "lang", "toxic", "order", "bytes")
    net = train(labelled, rows=rows, shares=shares)
    return score(docs, net, id_col, text_col, lang_col)
