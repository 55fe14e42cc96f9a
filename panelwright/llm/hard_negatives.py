"""Hard-negative mining with a pivot table.

An inner product isn't a metric, so each vector x gets one more component, sqrt(M**2 - |x|**2) with M the largest norm in
the table, and an anchor q gets 0 there. Then |q - x|**2 = |q|**2 + M**2 - 2 * (q . x): a high score is a short distance.
Spark stores every row's distances to a few pivots, a table of bounded width per row. For an anchor, whose distances to the
pivots are known, the triangle inequality brackets the distance of every row, hence its score, without reading the row's
vector; only rows whose bracket reaches what is still wanted are scored exactly.

Two rounds over the stored table: the best same-label rows of each anchor, then for each such score the best different-label
rows within the band that it sets. Anchors travel to the tasks in blocks of at most ``BLOCK_ANCHORS`` on average; a task
carries its bars from one run of rows to the next, and emits no more than its own best rows for each anchor. The table itself
is never shuffled. The pivots come from a sample of ``SAMPLE_ROWS`` rows and decide only how many rows are scored, never which
rows are returned.

Scores are exact whole numbers. Rows whose norm is 2**26 or more are outside the table's brackets and are scored with
unbounded integers; a score that 64 bits can't hold counts as the largest, or smallest, number that they can.

Defined results: rows without an id or a label, with a null vector, or with a null or non-finite component (also after
scaling) take no part, as anchors or otherwise. A row of the anchor's own id is neither its positive nor its negative. Rows
of equal ids are candidates each for itself; equal anchors are worked on once, anchors of one id with different vectors or
labels each for itself. Vectors of unequal length are compared as if padded with zeros. An anchor without positives, or
whose bands hold no row (always so below a positive score of 0), gives no rows; an empty table gives none. Other columns,
whatever their names, aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.scratch import discard, materialise
from panelwright.llm.topk import usable

PIVOTS, SAMPLE_ROWS = 16, 4096
#: Anchors in a block, on average, and rows that a task brackets together.
BLOCK_ANCHORS, RUN_ROWS = 8_192, 32_768
#: Norms from here on are scored with unbounded integers: below, every partial sum of products is below 2**53.
LARGE = float(1 << 26)
#: By how much, relative to the norms, distances may be off: they are stored as 32-bit floats, and differences cancel.
SLACK = 2.0**-20
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

_TABLE = "id long, label long, whole array<int>, wide array<double>, norm2 double"


def _matrix(column: pa.ListArray, width: int = 0) -> np.ndarray:
    """Rows of a list column as doubles, padded with zeros to the longest, or to ``width``."""
    sizes = column.value_lengths().fill_null(0).to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(sizes), max(width, sizes.max(initial=0))))
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _quantised(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    for b in batches:
        vectors = b.column(2)
        flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
        ends = np.append(0, np.cumsum(vectors.value_lengths().to_numpy())).astype(np.int64)
        with np.errstate(over="ignore"):
            sums = np.append(0.0, np.cumsum(np.minimum(flat * flat, 1e300)))  # only a first look at the size
        small = sums[ends[1:]] - sums[ends[:-1]] < LARGE**2 / 4 if sums[-1] < 1e15 else None
        whole, wide, norms = [], [], []
        for i, (x, y) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
            v = flat[x:y]
            with np.errstate(over="ignore"):
                norms.append(float(np.dot(v, v)))
            fits = bool(small[i]) if small is not None else norms[-1] < LARGE**2
            whole.append(v.astype(np.int32) if fits else None), wide.append(None if fits else v)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(whole, pa.list_(pa.int32())), pa.array(wide, pa.list_(pa.float64())), pa.array(norms)], ["id", "label", "whole", "wide", "norm2"])


def farthest_pivots(sample: np.ndarray, top2: float, pivots: int = PIVOTS) -> np.ndarray:
    """Rows of ``sample``, augmented, each the farthest from those before it."""
    raised = np.column_stack([np.sqrt(np.maximum(0.0, top2 - (sample**2).sum(axis=1))), sample])
    chosen, gap = [0], ((raised - raised[0]) ** 2).sum(axis=1)
    while len(chosen) < min(pivots, len(raised)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((raised - raised[chosen[-1]]) ** 2).sum(axis=1))
    return raised[chosen]


def pivot_distances(vectors: np.ndarray, extra: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each row, whose additional component is ``extra``, to each pivot."""
    width = min(vectors.shape[1], pivots.shape[1] - 1)
    products = vectors[:, :width] @ pivots[:, 1 : 1 + width].T + np.outer(extra, pivots[:, 0])
    squares = ((vectors**2).sum(axis=1) + extra**2)[:, None] + (pivots**2).sum(axis=1)[None, :] - 2 * products
    return np.sqrt(np.maximum(0.0, squares))


class Run:
    """Rows of the pivot table that a task brackets together."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, distances: np.ndarray, large: np.ndarray, top2: float):
        self.ids, self.labels, self.vectors, self.large, self.top2 = ids, labels, vectors, large, top2
        self.distances = np.ascontiguousarray(distances.T)
        self.bracketed = np.flatnonzero(~large)
        self.beyond = np.flatnonzero(large)
        self.scored = 0

    def between(self, anchor: Anchor, low: float, high: float) -> np.ndarray:
        """Rows whose bracket meets scores from ``low`` to ``high``; those out of the table always do."""
        base = anchor.norm2 + self.top2
        slack = SLACK * (self.top2**0.5 + anchor.norm2**0.5)
        most, least = base - 2 * low, base - 2 * high
        if most < -slack * slack:
            return self.beyond
        far, near = max(0.0, most) ** 0.5 + slack, max(0.0, least) ** 0.5 - slack
        rows = self.bracketed
        for p, d in enumerate(anchor.distances):
            own = self.distances[p, rows]
            rows = rows[(np.abs(own - d) <= far) & (own + d >= near)]
        return np.append(rows, self.beyond) if len(self.beyond) else rows

    def scores(self, anchor: Anchor, rows: np.ndarray) -> np.ndarray:
        """The exact scores of ``rows``."""
        self.scored += len(rows)
        width = min(self.vectors.shape[1], len(anchor.vector))
        these, v = self.vectors[rows, :width], anchor.vector[:width]
        if anchor.large or self.large[rows].any():
            out, q = [], [int(x) for x in v]
            for row in these:
                out.append(min(_MOST, max(_LEAST, sum(int(a) * b for a, b in zip(row, q, strict=True)))))
            return np.array(out, np.int64)
        return (these @ v).astype(np.int64)

    def best(self, anchor: Anchor, rows: np.ndarray, held: tuple[np.ndarray, np.ndarray], k: int, low: int = _LEAST, high: int = _MOST) -> tuple[np.ndarray, np.ndarray]:
        """``held``, ids and scores of the best so far, with those of ``rows`` that score from ``low`` to ``high``."""
        found = self.scores(anchor, rows)
        return _merged(held, self.ids[rows], found, k, low, high)


def _merged(held: tuple[np.ndarray, np.ndarray], ids: np.ndarray, scores: np.ndarray, k: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    fine = (scores >= low) & (scores <= high)
    ids, scores = np.append(held[0], ids[fine]), np.append(held[1], scores[fine])
    keep = np.lexsort((ids, -(scores.astype(object)) if len(scores) and scores.min() == _LEAST else -scores))[:k]
    return ids[keep], scores[keep]


_NONE = (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Anchor:
    """An anchor of a block: its vector, its distances to the pivots, and the bands that its positives set."""

    def __init__(self, place: int, own: int, label: int, vector: np.ndarray, pivots: np.ndarray):
        self.place, self.id, self.label, self.vector = place, own, label, vector
        with np.errstate(over="ignore"):
            self.norm2 = float(vector @ vector)
        self.large = not self.norm2 < LARGE**2
        if self.large:  # every row is scored
            self.norm2, self.distances = 0.0, np.zeros(0)
        else:
            self.distances = pivot_distances(vector[None, :], np.zeros(1), pivots)[0] if len(pivots) else np.zeros(0)
        self.bands: list[tuple[int, int, int]] = []


def _positives(run: Run, anchors: list[Anchor], held: list, k: int) -> None:
    for a in anchors:
        same = (run.labels == a.label) & (run.ids != a.id)
        if not same.any():
            continue
        own = held[a.place]
        met = np.zeros(0, np.int64)
        if len(own[0]) < k and len(a.distances):  # a first bar: the rows that the first pivot puts nearest
            near = run.bracketed[same[run.bracketed]]
            gap = np.abs(run.distances[0, near] - a.distances[0])
            met = near[np.argpartition(gap, 4 * k)[: 4 * k]] if len(near) > 4 * k else near
            own = run.best(a, met, own, k)
        low = float(own[1][-1]) if len(own[0]) == k else -np.inf
        rows = run.between(a, low, np.inf) if np.isfinite(low) and not a.large else np.arange(len(run.ids))
        rows = np.setdiff1d(rows[same[rows]], met, assume_unique=True)
        held[a.place] = run.best(a, rows, own, k)


def _negatives(run: Run, anchors: list[Anchor], held: list, k: int) -> None:
    for a in anchors:
        if not a.bands:
            continue
        own = held[a.place]
        bars = [max(low, int(best[1][-1])) if len(best[0]) == k else low for (_, low, _), best in zip(a.bands, own, strict=True)]
        rows = np.arange(len(run.ids)) if a.large else run.between(a, float(min(bars)), float(max(high for _, _, high in a.bands)))
        rows = rows[run.labels[rows] != a.label]
        rows = rows[run.ids[rows] != a.id]
        if len(rows):
            found = run.scores(a, rows)
            for i, (_, _, high) in enumerate(a.bands):
                own[i] = _merged(own[i], run.ids[rows], found, k, bars[i], high)


def _runs(batches: Iterator[pa.RecordBatch], top2: float) -> Iterator[Run]:
    def made(waiting: list[pa.RecordBatch]) -> Run:
        t = pa.Table.from_batches(waiting).combine_chunks()
        whole, wide, distances = (t[c].chunk(0) for c in ("whole", "wide", "distances"))
        width = max(int(x.value_lengths().fill_null(0).to_numpy().max(initial=0)) for x in (whole, wide))
        vectors = _matrix(whole, width)
        large = np.flatnonzero(wide.is_valid().to_numpy(zero_copy_only=False))
        if len(large):
            vectors[large] = _matrix(wide.take(pa.array(large)), width)
        mask = np.zeros(t.num_rows, bool)
        mask[large] = True
        return Run(t["id"].to_numpy(), t["label"].to_numpy(), vectors, _matrix(distances), mask, top2)

    waiting, n = [], 0
    for b in batches:
        if len(b):
            waiting.append(b)
            n += len(b)
        if n >= RUN_ROWS:
            yield made(waiting)
            waiting, n = [], 0
    if waiting:
        yield made(waiting)


def pivot_table(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float, pivots: int = PIVOTS) -> tuple[DataFrame, np.ndarray, float]:
    """The stored table (id, label, whole or wide components, norm2, distances), the pivots, and the largest norm, squared."""
    taken = vectors.where(usable(vector_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.forall(vector_col, lambda x: F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(float("inf"))))
    rows = taken.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"))
    whole = materialise(rows.mapInArrow(lambda b: _quantised(b, float(scale)), _TABLE), "whole")
    top2 = whole.where(F.col("whole").isNotNull()).agg(F.coalesce(F.max("norm2"), F.lit(0.0))).first()[0]
    sample = whole.where(F.col("whole").isNotNull()).select("whole", F.xxhash64("id", "whole").alias("order")).orderBy("order", "whole").limit(SAMPLE_ROWS).toArrow()
    chosen = farthest_pivots(_matrix(sample["whole"].combine_chunks()), top2, pivots) if len(sample) else np.zeros((0, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = _matrix(b.column(2))
            d = pivot_distances(v, np.sqrt(np.maximum(0.0, top2 - (v**2).sum(axis=1))), chosen).astype(np.float32) if len(chosen) else np.zeros((len(b), 0), np.float32)
            ends = pa.array(np.arange(len(b) + 1, dtype=np.int32) * d.shape[1])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(d.ravel()))], [*b.schema.names, "distances"])

    table = materialise(whole.mapInArrow(run, _TABLE + ", distances array<float>"), "pivot_table")
    discard(whole)
    return table, chosen, top2


def hard_negatives(
    vectors: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 10, percent: tuple[int, int] = (30, 90),
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", scale: float = 256, pivots: int = PIVOTS,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Each row of ``anchors``, of the form of ``vectors`` and usually of the same table, has its ``n_positives`` best
    same-label rows of ``vectors`` as positives, and for each of them the ``n_negatives`` best different-label rows whose
    score lies within ``percent`` of the positive's.
    """
    table, chosen, top2 = pivot_table(vectors, id_col, vector_col, label_col, scale, pivots)
    taken = anchors.where(usable(vector_col) & F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    asked = taken.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).alias("v"))
    asked = materialise(asked.mapInArrow(lambda b: _quantised(b, float(scale)), _TABLE).drop("norm2").distinct(), "anchors")
    blocks = max(1, -(-asked.count() // BLOCK_ANCHORS))
    low_pc, high_pc = percent
    out = None
    for i in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id", "label", "whole", "wide"), F.lit(blocks)) == i).orderBy("id", "label", "whole", "wide").toArrow().to_pylist()
        block = [Anchor(n, r["id"], r["label"], np.array(r["whole"] if r["whole"] is not None else r["wide"], np.float64), chosen) for n, r in enumerate(rows)]
        if not block:
            continue

        def first(batches: Iterator[pa.RecordBatch], block: list[Anchor] = block) -> Iterator[pa.RecordBatch]:
            held = [_NONE] * len(block)
            for run in _runs(batches, top2):
                _positives(run, block, held, n_positives)
            n = [len(x[0]) for x in held]
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(np.arange(len(block)), n)), pa.array(np.repeat([a.id for a in block], n)), *(pa.array(np.concatenate([x[j] for x in held])) for j in (0, 1))], ["place", "anchor_id", "positive_id", "positive_score"])

        found = table.mapInArrow(first, "place long, anchor_id long, positive_id long, positive_score long")
        order = Window.partitionBy("place").orderBy(F.col("positive_score").desc(), "positive_id")
        positives = materialise(found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= n_positives).drop("r"), "positives")
        for a in block:
            a.bands = []
        for r in positives.where(F.col("positive_score") >= 0).select("place", "positive_score").distinct().orderBy("place", "positive_score").collect():
            p = r["positive_score"]
            block[r["place"]].bands.append((p, -(-low_pc * p // 100), high_pc * p // 100))

        def second(batches: Iterator[pa.RecordBatch], block: list[Anchor] = block) -> Iterator[pa.RecordBatch]:
            held = [[_NONE] * len(a.bands) for a in block]
            for run in _runs(batches, top2):
                _negatives(run, block, held, n_negatives)
            for a in block:
                n = [len(x[0]) for x in held[a.place]]
                if sum(n):
                    yield pa.RecordBatch.from_arrays([pa.array([a.place] * sum(n), pa.int64()), pa.array(np.repeat(np.array([b[0] for b in a.bands], np.int64), n)), *(pa.array(np.concatenate([x[j] for x in held[a.place]])) for j in (0, 1))], ["place", "positive_score", "negative_id", "negative_score"])

        hits = table.mapInArrow(second, "place long, positive_score long, negative_id long, negative_score long")
        order = Window.partitionBy("place", "positive_score").orderBy(F.col("negative_score").desc(), "negative_id")
        ranked = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n_negatives)
        mined = materialise(positives.join(ranked, ["place", "positive_score"]), "mined")
        discard(positives)
        out = mined if out is None else out.unionByName(mined)
    if out is None:
        out = table.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    discard(table, asked)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
