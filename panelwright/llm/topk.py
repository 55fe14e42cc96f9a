"""Exact top-k inner product search with KD-trees per shard.

The top levels of one KD-tree, whose median splits come from a sample of ``SAMPLE_ROWS`` vectors, cut the table into cells:
near vectors share one. Spark finds each cell's tight box over all its vectors; cells that hold more than a task should are
dealt out in parts. Each part is a shard: its vectors are split at medians of their widest dimension into leaves, every node
with its tight box. A query walks a shard's tree best first: the bound of a box is the largest inner product any point in it
could have, and a node is opened only while its bound can still beat the query's kth score.

The search runs in two Spark rounds. Each query first meets a part of its own cell, and the kth score found there is its bar.
It is then sent to those shards only whose cell's box reaches the bar, with the bar to start from. The sample decides how
much is searched, never what is found.

A shard's vectors and then its queries stream through one task, so a tree is built once a round and only its own shard is
held. A query's hits are cut to the k best of each task before they are shuffled. The driver holds the boxes of ``MOST_CELLS``
cells at most.

Scores are exact whole numbers. Where the norms keep all sums below 2**53 they are worked out in floating point, below 2**62
in 64-bit integers; vectors whose norm is 2**31 or more are kept apart from the trees, and they, or all vectors for such a
query, are scored with unbounded integers. A score that 64 bits can't hold counts as the largest, or smallest, number that
they can. Bounds allow for rounding.

Defined results: vectors that are null, or that hold a null or non-finite component (also after scaling), take no part; nor
do rows without an id. Fewer than k candidates give fewer rows; ties go to the smaller id; rows of equal ids or vectors are
candidates each for itself, but no row with the query's own id is. Equal query rows give their rows once; queries of one id
with different vectors are ranked each for itself, so that ranks repeat for that id. An empty table gives no rows. Vectors of
unequal length are compared as if padded with zeros. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.scratch import discard, materialise

#: Vectors in a shard at most, on average, and vectors in a leaf of a tree. Tables of fewer vectors are dealt out over the
#: session's cores, down to ``LEAST_ROWS``.
SHARD_ROWS, LEAF_ROWS, LEAST_ROWS = 131_072, 128, 8_192
#: Cells at most, and vectors in the sample that they are made from.
MOST_CELLS, SAMPLE_ROWS = 4_096, 65_536
#: Norms from here on are kept apart; below, sums of products are below 2**62.
WIDE = float(1 << 31)
#: The cell of vectors that are kept apart.
APART = -1
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1

_HITS = "query_id long, query long, vec_id long, score long"
_ROWS = "id long, v array<long>, wide array<double>"


def usable(vector: str = "embedding") -> Column:
    """True for a vector that takes part."""
    fine = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.col(vector).isNotNull() & F.coalesce(fine, F.lit(False))


def box_bounds(low: np.ndarray, high: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The largest inner product that a point of each box could have with ``q``, not less for rounding."""
    up, down = high * np.maximum(q, 0.0), low * np.minimum(q, 0.0)
    slack = (np.abs(up) + np.abs(down)).sum(axis=1) * 2.0**-44
    total = up.sum(axis=1) + down.sum(axis=1)
    return np.where(slack > 2.0**-12, total + slack, np.round(total))  # whole numbers, where rounding can't reach the next


class KDTree:
    """Median splits over integer vectors, with tight boxes; nodes hold ranges of ``order``."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS):
        self.order = np.arange(len(ids))
        self.low, self.high, self.least, self.span, self.children = [], [], [], [], []
        stack = [(0, len(ids), -1, 0)]
        while stack:
            first, last, parent, side = stack.pop()
            node, rows = len(self.low), self.order[first:last]
            low, high = vectors[rows].min(axis=0), vectors[rows].max(axis=0)
            for to, x in ((self.low, low), (self.high, high), (self.least, ids[rows].min()), (self.span, (first, last))):
                to.append(x)
            self.children.append([-1, -1])
            if parent >= 0:
                self.children[parent][side] = node
            if last - first > leaf and (high > low).any():
                middle = (last - first) // 2
                rows = rows[np.argpartition(vectors[rows, np.argmax(high - low)], middle)]
                self.order[first:last] = rows
                stack += [(first + middle, last, node, 1), (first, first + middle, node, 0)]
        self.vectors, self.ids = vectors[self.order], ids[self.order]
        self.real = self.vectors.astype(np.float64)
        self.peak = float(np.sqrt((self.real**2).sum(axis=1).max(initial=0.0))) * (1 + 1e-9)
        self.low, self.high = np.array(self.low, np.float64), np.array(self.high, np.float64)
        self.least = np.array(self.least, np.int64)
        self.leaves, self.opened = sum(c[0] < 0 for c in self.children), 0

    def search(self, query: np.ndarray, own: int, k: int, bar: int | None) -> tuple[list[int], list[int]]:
        """The ids and scores of the k best but ``own``, leaving out what scores below ``bar``; for norms below ``WIDE``."""
        q = query.astype(np.float64)
        most = self.peak * float(np.sqrt(q @ q)) * (1 + 1e-9)  # no sum is larger
        exact = most < 1 << 53
        bounds = box_bounds(self.low, self.high, q)
        best: list[tuple[int, int]] = []  # (score, -id): the worst first
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            bound = -bound
            if (bar is not None and bound < bar) or (len(best) == k and bound < best[0][0]):
                break
            if len(best) == k and bound == best[0][0] and -self.least[node] < best[0][1]:
                continue
            left, right = self.children[node]
            if left >= 0:
                for child in (left, right):
                    if bar is None or bounds[child] >= bar:
                        heapq.heappush(heap, (-bounds[child], child))
                continue
            first, last = self.span[node]
            self.opened += 1
            scores = (self.real[first:last] @ q).astype(np.int64) if exact else (self.vectors[first:last] * query).sum(axis=1)
            floor = best[0][0] if len(best) == k else bar
            if bar is not None and len(best) == k:
                floor = max(floor, bar)
            for i in range(len(scores)) if floor is None else np.flatnonzero(scores >= floor):
                who = int(self.ids[first + i])
                if who == own:
                    continue
                entry = (int(scores[i]), -who)
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [-x[1] for x in best], [x[0] for x in best]


def _stack(column: pa.ListArray) -> list[np.ndarray]:
    flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum([0, *column.value_lengths().fill_null(0).to_pylist()])
    return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _padded(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : min(len(v), width)] = v[:width]
    return out


def _quantised(batches: Iterator[pa.RecordBatch], scale: float) -> Iterator[pa.RecordBatch]:
    """floor(scale * x) of each component, taken as double: whole numbers, or doubles for the vectors that are kept apart."""
    for b in batches:
        whole, wide = [], []
        for x in _stack(b.column(1)):
            y = np.floor(x.astype(np.float64) * scale)
            fits = bool((np.abs(y) < WIDE).all()) and float(y @ y) < WIDE**2
            whole.append(y.astype(np.int64) if fits else None), wide.append(None if fits else y)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(whole, pa.list_(pa.int64())), pa.array(wide, pa.list_(pa.float64()))], ["id", "v", "wide"])


class Cells:
    """The top levels of a KD-tree over a sample: median splits of the widest dimension into about equal parts."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.splits: list[tuple[int, int, int, int]] = []  # dimension, the right side's least value, and the two sides: a split, or ~cell
        self.n = 0
        self.width = sample.shape[1]
        self.root = self._cut(sample, max(1, cells))

    def _cut(self, rows: np.ndarray, cells: int) -> int:
        spread = rows.max(axis=0) - rows.min(axis=0) if len(rows) and self.width else np.zeros(1)
        if cells < 2 or not spread.max() > 0:
            self.n += 1
            return ~(self.n - 1)
        d = int(spread.argmax())
        values = np.sort(rows[:, d])
        at = int(values[len(values) * (cells // 2) // cells])
        at = at if at > values[0] else int(values[np.searchsorted(values, values[0], "right")])
        mine = len(self.splits)
        self.splits.append((d, at, 0, 0))
        right = rows[:, d] >= at
        sides = self._cut(rows[~right], cells // 2), self._cut(rows[right], cells - cells // 2)
        self.splits[mine] = (d, at, *sides)
        return mine

    def place(self, vectors: list[np.ndarray]) -> np.ndarray:
        """The cell of each vector."""
        out, x = np.zeros(len(vectors), np.int64), _padded(vectors, self.width)
        todo = [(self.root, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if node < 0:
                out[rows] = ~node
            elif len(rows):
                d, at, left, right = self.splits[node]
                over = x[rows, d] >= at
                todo += [(left, rows[~over]), (right, rows[over])]
        return out


def _boxes(batches: Iterator[pa.RecordBatch], merging: bool) -> Iterator[pa.RecordBatch]:
    """cell, n, low, high: the boxes of a task's vectors (cell, v), or of boxes."""
    held: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for b in batches:
        cells = b.column(0).to_numpy()
        if merging:
            parts = [(int(c), int(n), low, high) for c, n, low, high in zip(cells, b.column(1).to_numpy(), _stack(b.column(2)), _stack(b.column(3)), strict=True)]
        else:
            x = _stack(b.column(1))
            wide = _padded(x, max(map(len, x), default=0))
            parts = [(int(c), int((cells == c).sum()), wide[cells == c].min(axis=0), wide[cells == c].max(axis=0)) for c in np.unique(cells)]
        for c, n, low, high in parts:
            if c in held:
                m, a, z = held[c]
                width = max(len(a), len(low))
                a, z, low, high = (np.pad(y, (0, width - len(y))) for y in (a, z, low, high))
                n, low, high = n + m, np.minimum(a, low), np.maximum(z, high)
            held[c] = (n, low, high)
    kind = pa.list_(pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array([x[0] for x in held.values()], pa.int64()), pa.array([x[1] for x in held.values()], kind), pa.array([x[2] for x in held.values()], kind)], ["cell", "n", "low", "high"])


def _whole_scores(query: np.ndarray, rows: list[np.ndarray]) -> list[int]:
    q = [int(x) for x in query]
    return [min(_MOST, max(_LEAST, sum(a * int(b) for a, b in zip(q, row, strict=False)))) for row in rows]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Hits of rows (shard, query_id, query, id, v, wide, bar) sorted by shard, vectors before queries (query is null for vectors)."""
    shard, tree, held, ids, width, copies, apart = None, None, [], [], 0, Counter(), []
    for batch in batches:
        hits: tuple[list, list, list, list] = ([], [], [], [])
        narrow = batch.column(4).is_valid().to_pylist()
        for at, query_id, query, vec_id, is_narrow, v, wide, bar in zip(*(batch.column(i).to_pylist() for i in range(4)), narrow, _stack(batch.column(4)), _stack(batch.column(5)), batch.column(6).to_pylist(), strict=True):
            if at != shard:
                shard, tree, held, ids, width, copies, apart = at, None, [], [], 0, Counter(), []
            if query is None:
                key = vec_id, (v if is_narrow else wide).tobytes()
                if copies[key] < k:  # no more of a repeated row's copies can be among the k best
                    copies[key] += 1
                    if is_narrow:
                        held.append(v), ids.append(vec_id)
                    else:
                        apart.append((vec_id, wide))
                continue
            if tree is None and held:
                width = max(map(len, held))
                tree, held = KDTree(_padded(held, width), np.array(ids, np.int64)), []
                copies.clear()
            if is_narrow:
                found, scores = tree.search(_padded([v], width)[0], query_id, k, bar) if tree is not None else ([], [])
                others = [x for x in apart if x[0] != query_id]
            else:
                found, scores = [], []
                others = [x for x in (*apart, *(zip(tree.ids.tolist(), tree.vectors, strict=True) if tree is not None else ())) if x[0] != query_id]
            if others:
                more = sorted(zip((-s for s in _whole_scores(v if is_narrow else wide, [x[1] for x in others])), (x[0] for x in others), strict=True))[:k]
                found, scores = found + [x[1] for x in more], scores + [-x[0] for x in more]
            for to, x in zip(hits, ([query_id] * len(found), [query] * len(found), found, scores), strict=True):
                to += x
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in hits], ["query_id", "query", "vec_id", "score"])


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    """``hits`` with a rank, the k best of each query; Spark cuts each task's rows to k a query before it shuffles them."""
    best = Window.partitionBy("query_id", "query").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


class Table:
    """A searchable table: its cells with their boxes, and how many shards each is dealt out in."""

    def __init__(self, base: DataFrame, shard_rows: int):
        spark = base.sparkSession
        rows, cores = base.count(), spark.sparkContext.defaultParallelism
        wanted = min(MOST_CELLS, max(1, -(-rows // shard_rows), min(cores, rows // LEAST_ROWS)))
        some = base.where(F.col("v").isNotNull()).select("v", F.xxhash64("id", "v").alias("order"))
        sample = _stack(some.orderBy("order", "v").limit(SAMPLE_ROWS if wanted > 1 else 0).toArrow()["v"].combine_chunks()) if wanted > 1 else []
        self.cells = cells = Cells(_padded(sample, max(map(len, sample), default=0)), wanted)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                cell = np.where(b.column(1).is_valid().to_numpy(zero_copy_only=False), cells.place(_stack(b.column(1))), APART)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], ["id", "v", "wide", "cell"])

        self.rows = materialise(base.mapInArrow(placed, f"{_ROWS}, cell long"), "placed")
        schema = "cell long, n long, low array<long>, high array<long>"
        partly = self.rows.where(F.col("cell") != APART).select("cell", "v").mapInArrow(partial(_boxes, merging=False), schema)
        boxes = partly.repartition("cell").mapInArrow(partial(_boxes, merging=True), schema).toArrow()
        apart = self.rows.where(F.col("cell") == APART).count()
        self.parts = dict(zip(boxes["cell"].to_pylist(), [-(-n // shard_rows) for n in boxes["n"].to_pylist()], strict=True))
        if apart:
            self.parts[APART] = -(-apart // shard_rows)
        self.boxed = np.array(boxes["cell"].to_pylist(), np.int64)
        low, high = (_stack(boxes[c].combine_chunks()) if len(boxes) else [] for c in ("low", "high"))
        self.width = max(map(len, low), default=0)
        self.low, self.high = _padded(low, self.width).astype(np.float64), _padded(high, self.width).astype(np.float64)
        # shards are numbered through, cell by cell
        order = sorted(self.parts)
        first = np.cumsum([0, *(self.parts[c] for c in order)])
        self.first, self.shards = {c: int(f) for c, f in zip(order, first[:-1], strict=True)}, int(first[-1])
        self.dealt = spark.createDataFrame([(c, self.first[c], self.parts[c]) for c in order], "cell long, first long, parts long")

    def shard_of_rows(self) -> DataFrame:
        """shard, id, v, wide of every vector."""
        rows = self.rows.join(F.broadcast(self.dealt), "cell")  # one row a cell
        return rows.select((F.col("first") + F.pmod(F.xxhash64("id", "v", "wide"), F.col("parts"))).alias("shard"), "id", "v", "wide")

    def homes(self, vectors: list[np.ndarray | None], keys: list[int]) -> list[int | None]:
        """The shard that each query meets first: a part of its own cell if that holds vectors, else of any."""
        if not self.parts:
            return [None] * len(keys)
        some = int(self.boxed[0]) if len(self.boxed) else APART
        own = self.cells.place([np.zeros(0, np.int64) if v is None else v for v in vectors]).tolist()
        found = [c if v is not None and c in self.parts else some for c, v in zip(own, vectors, strict=True)]
        return [self.first[c] + k % self.parts[c] for c, k in zip(found, keys, strict=True)]

    def open(self, vector: np.ndarray | None, bar: int | None) -> list[int]:
        """The shards that can hold what scores at least ``bar``: all for a query that is kept apart."""
        cells = self.boxed
        if vector is not None and bar is not None and len(cells):
            q = _padded([vector], self.width)[0].astype(np.float64)
            cells = cells[box_bounds(self.low, self.high, q) >= bar]
        cells = [*cells.tolist(), *([APART] if APART in self.parts else [])]
        return [s for c in cells for s in range(self.first[c], self.first[c] + self.parts[c])]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row of ``queries`` the k best others of ``vectors``.

    ``queries`` are rows of the same form, usually of the same table; a candidate with the query's own id is left out.
    """

    def form(df: DataFrame, name: str) -> DataFrame:
        fits = F.forall(vector_col, lambda x: F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(float("inf")))
        rows = df.where(usable(vector_col) & F.col(id_col).isNotNull() & fits).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
        return materialise(rows.mapInArrow(lambda b: _quantised(b, float(scale)), _ROWS), name)

    base, asked = form(vectors, "vectors"), form(queries, "queries")
    table = Table(base, SHARD_ROWS)
    discard(base)
    asked = asked.distinct().select(F.col("id").alias("query_id"), F.xxhash64("v", "wide").alias("query"), "v", "wide")
    search = "shard long, query_id long, query long, id long, v array<long>, wide array<double>, bar long"
    none = F.lit(None).cast("long")
    rows = table.shard_of_rows().select("shard", none.alias("query_id"), none.alias("query"), "id", "v", "wide", none.alias("bar"))
    # what tasks need of the table, without its DataFrames
    find = Table.__new__(Table)
    find.__dict__ = {n: x for n, x in vars(table).items() if not isinstance(x, DataFrame)}

    def sent(batches: Iterator[pa.RecordBatch], later: bool) -> Iterator[pa.RecordBatch]:
        """The rows (query_id, query, v, wide, bar) for each shard they go to: the first, or with ``later`` all others that can hold a hit."""
        for b in batches:
            own, keys = [v if ok else None for ok, v in zip(b.column(2).is_valid().to_pylist(), _stack(b.column(2)), strict=True)], b.column(1).to_pylist()
            homes = find.homes(own, keys)
            bars = b.column(4).to_pylist()
            goes = [[s for s in find.open(v, bar) if s != home] if later else [home] if home is not None else [] for v, bar, home in zip(own, bars, homes, strict=True)]
            at = pa.array(np.repeat(np.arange(len(goes)), [len(g) for g in goes]))
            shards = pa.array([s for g in goes for s in g], pa.int64())
            take = lambda i: b.column(i).take(at)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([shards, take(0), take(1), pa.nulls(len(shards), pa.int64()), take(2), take(3), take(4)], ["shard", "query_id", "query", "id", "v", "wide", "bar"])

    def meet(these: DataFrame, later: bool) -> DataFrame:
        going = these.select("query_id", "query", "v", "wide", "bar").mapInArrow(partial(sent, later=later), search)
        dealt = rows.unionByName(going).repartition(max(1, table.shards), "shard").sortWithinPartitions("shard", F.col("query").isNotNull())
        return dealt.mapInArrow(lambda b: _search(b, k), _HITS)

    hits = meet(asked.withColumn("bar", none), later=False)
    if table.shards > 1:
        hits = materialise(hits, "home_hits")
        bars = _ranked(hits, k).where(F.col("rank") == k).select("query_id", "query", F.col("score").alias("bar"))
        hits = hits.unionByName(meet(asked.join(bars, ["query_id", "query"], "left"), later=True))
    return _ranked(hits, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
