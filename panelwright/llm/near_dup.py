"""Near-duplicate classes by an n-gram Jaccard join with PartEnum signatures.

A text's set holds its distinct word shingles. Sets of similar size fall into bands, and neighbouring bands share
groups of signatures: two sets whose Jaccard similarity reaches the bound differ in at most K elements, K depending on
the group alone. PartEnum in two levels: the feature domain is cut by hash into parts, and each part into three
subparts. K differences put two or more into K // 2 parts at most; in any other part the sets agree on some two of the
three subparts. So every subset of two subparts of every part is a signature, and a pair that reaches the bound shares
one. A few parts more than needed are made, so that as many more signatures agree; each set leaves out that many, those
that hold least (ordered by size and content, which are the same on both sides where the sets agree).

From there the join is exact without emitting the pairs of a group. Equal sets count as one node. Each node is first
compared with its leader, the node that most others share signatures with, and what is linked is one component. Many of
the signatures that still join several components lie within a passage that otherwise unlike texts share. Sets that reach
the bound also share one of the rarest elements of either: all elements but as many as the bound keeps in common, ordered by
how many nodes in doubt hold them, those of a single component first. Nodes that such elements connect are a cluster, and a
signature's nodes of different clusters are groups of their own. What is left is few; all nodes of a group meet one hub b.
Let D(x) hold
what x and b don't share. Linked sets x and y of different components aren't both linked to b, say x isn't. As y differs
from x in |D(x)| + |D(y)| - 2 |D(x) & D(y)| elements, the bounds for (x, y) and (x, b) leave D(x) and D(y) at least

    ((100 - p) (|b| - |y|) + 1 + (100 + p) |D(y)|) / (2 (100 + p))   and   ((100 + p) |D(x)| - (100 - p) (|x| + |b|)) / (2 (100 + p))

elements in common (p: the bound in percent), and all of D(y) but the (100 - p) |y| / p that sets which reach the bound
can differ in. Elements are ordered by how many nodes of the hub hold them, the rarest
first, and a set is entered under as many of them as those counts leave in doubt: then linked sets meet under one.
These prefix groups, mostly empty, are compared directly if they hold no more pairs than a few times the elements that
sets were entered under; else they are treated as signatures are, their hub being one of their members, which is in none
of the groups that follow, so that this ends. Whether a pair reaches the bound is always decided on the whole sets.

Defined results: A-Z are lower-cased; words are runs of characters other than ASCII white space. A text with fewer
words than a shingle has the whole sequence as its only shingle. A null or empty text, or one of white space alone,
has an empty set and is linked with nothing. Rows with equal texts are linked. Every row gives a row, also where ids
repeat; a row without an id gets the smallest id of its class, null if there is none. An empty table gives no rows.
Other columns, whatever their names, aren't read. Shingles and whole sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from tempfile import SpooledTemporaryFile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.graph import components, joined
from panelwright.llm.scratch import discard, materialise
from panelwright.llm.textbytes import cuts, mix, pieces, span_hashes, word_bounds

#: Signatures in a partition of the shuffle, and those sorted at once in a task.
PARTITION_ROWS, SORT_ROWS = 1_000_000, 500_000
#: Subparts of a part; a signature leaves one of them out.
SUBPARTS = 3
#: Members of a hub that are compared with it in a row; a hub of more is dealt out in parts.
HUB_MEMBERS = 64
#: Pairs that prefix groups may hold, for each entry of a node under an element, to be compared directly.
DIRECT_PAIRS = 4
#: Rows of nodes that may be broadcast; beyond it the same join shuffles.
BROADCAST_NODES = 200_000


@dataclass(frozen=True)
class Bound:
    """Two sets link when 100 * intersection >= percent * union; n words make a shingle."""

    percent: int = 80
    n: int = 5

    def linked(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)


@lru_cache(maxsize=64)
def bands(percent: int, largest: int) -> np.ndarray:
    """Upper sizes of the bands: sets that can reach the bound lie in the same or in neighbouring bands."""
    out = [0, 1]
    while out[-1] < largest:
        out.append(max(out[-1] + 1, out[-1] * 100 // percent))
    return np.array(out, np.int64)


def differing(percent: int, tops: np.ndarray, group: int) -> int:
    """How many elements two sets of bands group - 1 and group, or both of group - 1, can differ in."""
    return int(tops[group - 1] + tops[group]) * (100 - percent) // (100 + percent)


def shingles(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a column, in order."""
    coefficients = mix(np.arange(1, n + 1, dtype=np.uint64), 11) | np.uint64(1)
    for _, rows, data, offsets in pieces(column):
        found = []
        for a, b in cuts(data) if rows == 1 else [(0, len(data))]:
            start, end, row = word_bounds(data[a:b], np.array([0, b - a]) if rows == 1 else offsets)
            found.append(span_hashes(data[a:b], start, end, lower=True))
        words = found[0] if len(found) == 1 else np.concatenate(found)
        edges = np.array([0, len(words)]) if rows == 1 else np.searchsorted(row, np.arange(rows + 1))
        joined = np.zeros(len(words), np.uint64)
        for j in range(n):
            joined[: len(words) - j] += words[j:] * coefficients[j]
        joined = mix(joined, n)
        for i in range(rows):
            first, last = edges[i], edges[i + 1]
            if last - first >= n:
                yield np.unique(joined[first : last - n + 1])
            elif last > first:
                few = words[first:last]
                yield mix(np.array([(few * coefficients[: len(few)]).sum()], np.uint64), len(few))
            else:
                yield np.zeros(0, np.uint64)


def set_key(s: np.ndarray) -> int:
    """A signed 64-bit hash of a set."""
    total = mix(s, 3).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(mix(np.array([total], np.uint64), 4).view(np.int64)[0])


def signatures(s: np.ndarray, percent: int) -> np.ndarray:
    """The signatures of a set that isn't empty, for the two groups of its band."""
    size = len(s)
    tops = bands(percent, 1 << max(4, size.bit_length() + 1))
    band = int(np.searchsorted(tops, size))
    hashed = mix(s, 6)
    out = []
    for group in (band, band + 1):
        k = differing(percent, tops, group)
        salt = 1000 * group
        if k == 0:
            out.append(mix(np.array([mix(s, 5).sum(dtype=np.uint64)]), salt))
            continue
        spare = 1 + k // 16
        parts = k // 2 + 1 + spare
        where = mix(s, salt + 1)
        cell = ((where >> np.uint64(33)) % np.uint64(parts) * np.uint64(SUBPARTS) + (where & np.uint64(0xFFFFFFFF)) % np.uint64(SUBPARTS)).astype(np.int64)
        counts = np.bincount(cell, minlength=parts * SUBPARTS)
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(hashed[np.argsort(cell, kind="stable")], out=sums[1:])
        ends = np.cumsum(counts)
        content = (sums[ends] - sums[ends - counts]).reshape(parts, SUBPARTS)
        counts = counts.reshape(parts, SUBPARTS)
        content = (content.sum(axis=1, keepdims=True, dtype=np.uint64) - content).ravel()
        counts = (counts.sum(axis=1, keepdims=True) - counts).ravel()
        label = np.arange(parts * SUBPARTS, dtype=np.uint64)
        kept = np.lexsort((label, content, counts))[spare:]
        out.append(mix(mix(content[kept], salt + 2) + label[kept], salt))
    return np.concatenate(out)


def document_sets(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, digest, n_shingles, node of (doc_id, text): digest is the text's hash, node the set's, null if it's empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), set_key(s) if len(s) else None) for s in shingles(batch.column(2), n)]
            columns = [batch.column(0), batch.column(1), pa.array([x[0] for x in sets], pa.int64()), pa.array([x[1] for x in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "n_shingles", "node"])

    return docs.select("doc_id", F.xxhash64("text").alias("digest"), "text").mapInArrow(run, "doc_id long, digest long, n_shingles long, node long")


def _packed_signatures(docs: DataFrame, bound: Bound, buckets: int, elements: bool = False) -> DataFrame:
    """bucket, packed: (signature, node) of a batch of texts, by bucket; copies within a batch once.

    With ``elements`` a set's own elements stand in the place of its signatures.
    """
    n, percent = bound.n, bound.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        nodes: list[tuple[int, int]] = []
        seen: set[int] = set()

        def flush() -> Iterator[pa.RecordBatch]:
            signature = np.concatenate(held)
            times, keys = (np.array(x, np.int64) for x in zip(*nodes, strict=True))
            bucket = (signature % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows = np.stack([signature, np.repeat(keys, times).view(np.uint64)], axis=1)[order]
            ends = np.cumsum(np.bincount(bucket, minlength=buckets))
            used = np.flatnonzero(np.diff(ends, prepend=0))
            packed = [rows[(ends[i - 1] if i else 0) : ends[i]].tobytes() for i in used]
            held.clear(), nodes.clear(), seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(packed, pa.binary())], ["bucket", "packed"])

        size = 0
        for batch in batches:
            for s in shingles(batch.column(0), n):
                if not len(s) or (key := set_key(s)) in seen:
                    continue
                seen.add(key)
                held.append(s if elements else signatures(s, percent))
                nodes.append((len(held[-1]), key))
                size += len(held[-1])
                if size >= SORT_ROWS:
                    yield from flush()
                    size = 0
        if size:
            yield from flush()

    return docs.mapInArrow(run, "bucket long, packed binary")


def _shared(batches: Iterator[pa.RecordBatch], piece: int | None = None) -> Iterator[pa.RecordBatch]:
    """signature, node: the rows of signatures that several nodes have.

    A partition is read twice, piece by piece: the first pass finds those signatures, the second gives their rows.
    Between the passes the rows lie in a file, or in memory if they are but one piece.
    """
    piece = piece or SORT_ROWS
    known, least, several = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool)

    def merged(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = np.concatenate(held)
        signature, node = np.concatenate([known, rows[:, 0]]), np.concatenate([least, rows[:, 1].view(np.int64)])
        flag = np.concatenate([several, np.zeros(len(rows), bool)])
        order = np.argsort(signature, kind="stable")
        signature, node, flag = signature[order], node[order], flag[order]
        heads = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1]]))
        low = np.minimum.reduceat(node, heads)
        return signature[heads], low, np.logical_or.reduceat(flag, heads) | (low != np.maximum.reduceat(node, heads))

    held, size = [], 0
    with SpooledTemporaryFile(max_size=16 * piece, dir=os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None) as spool:
        for batch in batches:
            for packed in batch.column(0):
                spool.write(packed.as_buffer())
                held.append(np.frombuffer(packed.as_buffer(), np.uint64).reshape(-1, 2).copy())
                size += len(held[-1])
                if size >= piece:
                    known, least, several = merged(held)
                    held, size = [], 0
        if size:
            known, least, several = merged(held)
        held, least = [], least[:0]
        known = known[several]
        spool.seek(0)
        while len(known) and (data := spool.read(16 * piece)):
            rows = np.frombuffer(data, np.uint64).reshape(-1, 2)
            at = np.minimum(np.searchsorted(known, rows[:, 0]), len(known) - 1)
            found = np.unique(rows[known[at] == rows[:, 0]].view(np.int64), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["signature", "node"])


def shared_signatures(texts: DataFrame, bound: Bound, expected: int, elements: bool = False) -> DataFrame:
    """Distinct signature, node. ``expected``: about how many signatures there are; it only sets how finely they are dealt."""
    partitions = max(12, -(-expected // PARTITION_ROWS))
    packed = _packed_signatures(texts, bound, 8 * partitions, elements)
    piece = SORT_ROWS
    return packed.repartition(partitions, "bucket").select("packed").mapInArrow(lambda b: _shared(b, piece), "signature long, node long").distinct()


def _few(df: DataFrame) -> DataFrame:
    """``df``, a written table, to be broadcast if its rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_NODES else df


def compared(pairs: DataFrame, texts: DataFrame, bound: Bound, differences: bool = True) -> DataFrame:
    """hub, node, linked, size, hub_size, diff for distinct pairs (hub, node); texts: (node, text).

    diff holds the elements of one set alone, those that the node lacks inverted; null without ``differences``. The
    members of a hub stream past it, in parts of ``HUB_MEMBERS`` at most on average.
    """
    parts = materialise(pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / HUB_MEMBERS).cast("int").alias("parts")), "parts")
    part = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int").alias("part")
    members = pairs.join(_few(parts), "hub").select("hub", "node", part).join(texts, "node").select("hub", "part", "node", "text")
    hubs = parts.select(F.col("hub").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(texts, "node")
    both = members.unionByName(hubs.select(F.col("node").alias("hub"), "part", F.lit(None).cast("long").alias("node"), "text"))
    both = both.repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("node").asc_nulls_first()).select("hub", "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = np.zeros(0, np.uint64)
        for batch in batches:
            rows, diffs, held = [], [], 0
            for h, node, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), shingles(batch.column(2), bound.n), strict=True):
                if node is None:
                    hub = x
                    continue
                common = np.isin(x, hub, assume_unique=True)
                count = int(np.count_nonzero(common))
                rows.append((h, node, bound.linked(count, len(hub), len(x)), len(x), len(hub)))
                if differences:
                    diffs.append(np.concatenate([x[~common], ~hub[~np.isin(hub, x, assume_unique=True)]]))
                    held += len(diffs[-1])
                if held > SORT_ROWS:
                    yield _checked(rows, diffs)
                    rows, diffs, held = [], [], 0
            if rows:
                yield _checked(rows, diffs)

    return both.mapInArrow(run, "hub long, node long, linked boolean, size int, hub_size int, diff array<long>")


def _checked(rows: list[tuple], diffs: list[np.ndarray]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32())
    columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    if diffs:
        ends = np.cumsum([0, *map(len, diffs)])
        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(diffs).view(np.int64))))
    else:
        columns.append(pa.nulls(len(rows), pa.list_(pa.int64())))
    return pa.RecordBatch.from_arrays(columns, ["hub", "node", "linked", "size", "hub_size", "diff"])


def _leaders(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """node, weight, leader: how many others a node meets by signature, and the weightiest node that it meets."""
    often = members.groupBy("signature").agg(F.count(F.lit(1)).alias("n"))
    weight = materialise(members.join(often, "signature").groupBy("node").agg(F.sum("n").alias("weight")), "weight")
    tops = members.join(_few(weight), "node").groupBy("signature").agg(F.max(F.struct("weight", "node")).alias("top"))
    leaders = members.join(tops, "signature").groupBy("node").agg(F.max("top").alias("top")).select("node", F.col("top.weight").alias("weight"), F.col("top.node").alias("leader"))
    return weight, leaders


def _unresolved(members: DataFrame, label: DataFrame | None) -> DataFrame:
    """The rows of ``members`` (signature, node, ...) whose signature joins several components, with component added."""
    if label is None:
        out = members.withColumn("component", F.col("node"))
    else:
        out = members.join(_few(label), "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = out.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("signature")
    return out.join(several, "signature", "left_semi")


def _clustered(rows: DataFrame, texts: DataFrame, label: DataFrame, bound: Bound) -> DataFrame:
    """``rows`` (signature, node, component), a signature now standing for a signature and a cluster, where several components are left."""
    nodes = materialise(rows.select("node", "component").distinct(), "nodes")
    chosen = texts.join(_few(nodes), "node")
    total = chosen.agg(F.sum("size")).first()[0] or 0
    shared = materialise(shared_signatures(chosen.select("text"), bound, total, elements=True).withColumnRenamed("signature", "element"), "shared")
    held = shared.join(_few(nodes), "node")
    often = held.groupBy("element").agg(F.count(F.lit(1)).alias("times"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("element", "times")
    own = Window.partitionBy("node")
    rank, common = F.row_number().over(own.orderBy("times", "element")), F.count(F.lit(1)).over(own)
    # elements that one component holds come first: no pair in question shares them
    ranked = shared.join(often, "element").withColumn("common", common).withColumn("rank", rank).join(texts.select("node", "size"), "node")
    within = ranked.where(F.col("size") - F.col("common") + F.col("rank") <= F.floor((100 - bound.percent) * F.col("size") / 100) + 1)
    rarest = materialise(within.select("element", "node"), "rarest")
    first = rarest.groupBy("element").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last").select("element", "first")
    edges = rarest.join(first, "element").where("first <> node").select("first", "node")
    clusters = components(edges, "first", "node").withColumnRenamed("component", "cluster")
    split = rows.join(_few(clusters), "node").select(F.xxhash64("signature", "cluster").alias("signature"), "node")
    out = materialise(_unresolved(split, label).drop("component"), "clustered")
    discard(nodes, shared, rarest)
    return out


def _prefixes(checked: DataFrame, bound: Bound) -> DataFrame:
    """hub, signature, node, component, size, far, near of (hub, node, linked, size, hub_size, diff, component).

    A signature stands for a hub and an element. far: not linked to the hub; near: within the prefix for partners that
    are far, which all rows that aren't far are.
    """
    p = bound.percent
    full = F.size("diff")
    most = F.floor((100 - p) * F.col("size") / p) + 1
    near = full - F.ceil(((100 - p) * (F.col("hub_size") - F.col("size")) + 1 + (100 + p) * full) / (2.0 * (100 + p))) + 1
    reach = full - F.greatest(F.lit(1), F.ceil(((100 + p) * full - (100 - p) * (F.col("hub_size") + F.col("size"))) / (2.0 * (100 + p)))) + 1
    narrow = checked.select("hub", "node", "component", "size", (~F.col("linked")).alias("far"), full.alias("full"), F.least(near, most).alias("near_to"), F.least(F.when(F.col("linked"), near).otherwise(reach), most).alias("reach"))
    rows = checked.select("hub", "node", "component", F.explode("diff").alias("element"))
    often = rows.groupBy("hub", "element").agg(F.count(F.lit(1)).alias("times"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").drop("low", "high")
    own = Window.partitionBy("hub", "node")
    rank, common = F.row_number().over(own.orderBy("times", "element")), F.count(F.lit(1)).over(own)
    # elements that one component holds come first: no pair in question shares them
    rows = rows.drop("component").join(often, ["hub", "element"]).withColumn("common", common).withColumn("rank", rank).join(narrow, ["hub", "node"])
    place = F.col("full") - F.col("common") + F.col("rank")
    rows = rows.where(place <= F.col("reach")).select("hub", F.xxhash64("hub", "element").alias("signature"), "node", "component", "size", "far", (place <= F.least("near_to", "reach")).alias("near"))
    return rows


def _held(rows: DataFrame, by: list[str], key: str) -> DataFrame:
    """``by``, who, n, pairs of the groups of (hub, signature) or hubs that hold pairs of different components; pairs: how many."""
    count = lambda c: F.sum(c.cast("double"))
    linked, near, far = ~F.col("far"), F.col("far") & F.col("near"), F.col("far")
    parts = rows.groupBy(*by, "component").agg(count(linked).alias("a"), count(near).alias("s"), count(far).alias("t"), F.bit_xor(F.xxhash64("node", "near")).alias("who"))
    pairs = F.sum("a") * F.sum("t") - F.sum(F.col("a") * F.col("t")) + (F.sum("s") * F.sum("s") - F.sum(F.col("s") * F.col("s"))) / 2
    return parts.groupBy(*by).agg(pairs.alias(key), F.bit_xor("who").alias("who"), (F.sum("a") + F.sum("t")).alias("n")).where(f"{key} > 0")


def _met(rows: DataFrame) -> tuple[DataFrame, float]:
    """The rows of the prefix groups that hold pairs of different components, and how many pairs.

    Where a hub's groups hold more pairs, counted in each, than its nodes in doubt make at all, these are one group.
    """
    groups = _held(rows, ["hub", "signature"], "pairs").groupBy("hub", "who", "n", "pairs").agg(F.min("signature").alias("signature"))  # groups of the same members are one
    groups = materialise(groups.select("hub", "signature", "pairs"), "groups")
    met = materialise(rows.join(_few(groups).select("hub", "signature"), ["hub", "signature"], "left_semi"), "met")
    nodes = met.groupBy("hub", "node", "component", "size", "far").agg(F.lit(True).alias("near"))
    whole = _held(nodes, ["hub"], "most").select("hub", "most")
    total = groups.groupBy("hub").agg(F.sum("pairs").alias("pairs")).join(whole, "hub")
    total = materialise(total.select("hub", F.least("pairs", "most").alias("pairs"), (F.col("most") < F.col("pairs")).alias("as_one")), "total")
    split = lambda df, one: df.join(_few(total).where(F.col("as_one") == one).select("hub"), "hub", "left_semi")
    columns = ["signature", "node", "component", "size", "far", "near"]
    out = split(met, False).select(*columns).unionByName(split(nodes, True).withColumn("signature", F.xxhash64("hub")).select(*columns))
    out = materialise(out, "rows")
    pairs = total.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0]
    discard(groups, met, total)
    return out, pairs


def _crossing(rows: DataFrame, bound: Bound) -> DataFrame:
    """hub, node: the pairs of different components that prefix groups hold."""
    left, right = (rows.select("signature", *[F.col(c).alias(f"{c}_{s}") for c in ("node", "component", "size", "far", "near")]) for s in "ab")
    both = left.where("near_a").join(right.where("far_b"), "signature").where("component_a <> component_b AND (NOT far_a OR near_b AND node_a < node_b)")
    both = both.where((F.col("size_a") * 100 >= F.col("size_b") * bound.percent) & (F.col("size_b") * 100 >= F.col("size_a") * bound.percent))
    return both.select(F.least("node_a", "node_b").alias("hub"), F.greatest("node_a", "node_b").alias("node")).distinct()


def _links(members: DataFrame, texts: DataFrame, bound: Bound) -> tuple[DataFrame | None, DataFrame | None]:
    """Verified links (hub, node) and node, component of what they join; None without a shared signature."""
    if members.isEmpty():
        return None, None
    weight, leaders = _leaders(members)
    leaders = materialise(leaders, "leaders")
    done = compared(leaders.where("leader <> node").select(F.col("leader").alias("hub"), "node"), texts, bound, differences=False)
    links = [materialise(done.where("linked").select("hub", "node"), "links")]
    label = joined(None, links[0], "hub", "node")
    doubtful = materialise(_unresolved(members, label), "unresolved")
    rows = _clustered(doubtful, texts, label, bound)
    discard(doubtful, weight, leaders)
    weight, leaders = _leaders(rows)
    leaders = materialise(leaders, "leaders")
    hubs = rows.join(_few(leaders), "node").groupBy("signature").agg(F.max(F.struct("weight", "leader")).alias("top")).select("signature", F.col("top.leader").alias("hub"))

    while not rows.isEmpty():
        placed = materialise(rows.join(hubs, "signature").where("hub <> node").select("signature", "hub", "node"), "placed")
        checked = materialise(compared(placed.select("hub", "node").distinct(), texts, bound), "checked")
        links.append(materialise(checked.where("linked").select("hub", "node"), "links"))
        label = joined(label, links[-1], "hub", "node")
        doubtful = materialise(_unresolved(placed, label).select("hub", "node", "component").distinct(), "doubtful")
        prefixes = materialise(_prefixes(checked.join(_few(doubtful), ["hub", "node"]), bound), "prefixes")
        discard(rows, placed, checked, doubtful)
        rows, pairs = _met(prefixes)
        entered = prefixes.count()
        discard(prefixes)
        if pairs <= DIRECT_PAIRS * entered:
            if pairs:
                done = compared(_crossing(rows, bound), texts, bound, differences=False)
                links.append(materialise(done.where("linked").select("hub", "node"), "links"))
                label = joined(label, links[-1], "hub", "node")
            break
        hubs = rows.join(_few(weight), "node").groupBy("signature").agg(F.max(F.struct("weight", "node")).alias("top")).select("signature", F.col("top.node").alias("hub"))
    every = links[0]
    for more in links[1:]:
        every = every.unionByName(more)
    return every, label


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: Bound = Bound()) -> DataFrame:
    """doc_id, digest, n_shingles, component_id (the smallest doc_id reachable by links), n_links, first: a row for each row.

    digest is the hash of the text, which tells rows of one id apart. first is true for one (doc_id, digest) of each class:
    the smallest doc_id, null only if no row of the class has one, and of these the smallest digest.
    n_links counts the links of the document's set with other sets that the join needed to verify; copies aren't
    expanded into pairs, nor are pairs that are in one component already.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = materialise(document_sets(plain, bound.n), "sets")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    rate = SUBPARTS * 2 * (100 - bound.percent) / (100 + bound.percent)
    members = materialise(shared_signatures(plain.select("text"), bound, int(total * rate * 1.2) + 1), "members")
    texts = materialise(_texts(plain, sets, members), "texts")
    links, label = _links(members, texts, bound)
    discard(members, texts)
    nodes = sets.where(F.col("node").isNotNull()).groupBy("node").agg(F.min(_place()).alias("least"))
    if links is None:
        return _classes(sets, nodes.withColumn("component", F.col("node")).withColumn("n_links", F.lit(0)))
    degree = links.distinct().select(F.explode(F.array("hub", "node")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    classes = nodes.join(label, "node", "left").join(degree, "node", "left")
    return _classes(sets, classes.withColumn("component", F.coalesce("component", "node")))


def _texts(plain: DataFrame, sets: DataFrame, members: DataFrame) -> DataFrame:
    """node, size, text: a text of each node of ``members``, that of the row with the smallest id and hash."""
    wanted = materialise(members.select("node").distinct(), "wanted")
    owner = F.min(F.struct("doc_id", "digest")).alias("owner")
    owners = materialise(sets.join(_few(wanted), "node", "left_semi").groupBy("node").agg(owner, F.max("n_shingles").alias("size")).select("node", "size", "owner.*"), "owners")
    same: Column = F.col("p.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("p.digest") == F.col("o.digest"))
    found = plain.withColumn("digest", F.xxhash64("text")).alias("p").join(_few(owners).alias("o"), same).select("node", "size", "text")
    return found.dropDuplicates(["node"])


def _place() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "digest")


def _classes(sets: DataFrame, nodes: DataFrame) -> DataFrame:
    """The documents of ``sets`` with the smallest document of their node's component."""
    least = nodes.groupBy("component").agg(F.min("least").alias("of_class"))
    classes = nodes.join(least, "component").select("node", "of_class", "n_links")
    first = F.col("of_class").isNull() | (_place() == F.col("of_class"))
    return sets.join(classes, "node", "left").select(
        "doc_id", "digest", "n_shingles", F.coalesce("of_class.doc_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), first.alias("first")
    )
