"""Mixture-controlled packing of tokenised documents into fixed-length sequences.

Every source is a queue of tokens. A window of ``window`` sequences takes from each queue what its target share
entitles it to, in deficit round-robin: a queue's deficit (its share of everything packed so far, less what it got)
never exceeds a token or so, and is carried from window to window and across partitions. The allotments have a closed
form: token t of a queue that gives n tokens to a phase is due at time (t + 1/2) / n, and a window takes the next
tokens by due time. A task therefore works out any window's allotment by itself, from the queues' totals alone. When
a queue with an explicit target runs dry, a new phase shares its part among the others.

Documents are cut freely at window, sequence and phase boundaries; each token lies in exactly one piece, sequences are
gapless, and only the last one is shorter than ``length``.

Where there are more sources than ``MAX_SOURCES``, so that the driver shouldn't hold their totals, those without a target
are one queue whose tokens are interleaved by the same due times, in Spark: a slot holds the tokens due in about a sequence's
worth of the queue, which one it is follows from a source's total alone, and running sums over the slots, and within a slot
by source, give a token's place. So every window holds each source's share to within that of a sequence or two, however many
sources there are, and the driver holds none of their totals.

Defined results: a null text counts as an empty one, which is the end token alone; null sources are one queue. Equal
rows are packed each for itself. An empty table gives no pieces. Sources without a positive target come last, in the
proportions that they have. Other columns, whatever their names, aren't read.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.llm.scratch import discard, materialise

#: Tokens in a sequence, sequences in a window, and the id that ends each document.
LENGTH, WINDOW, END_ID = 1024, 64, 0
#: Queue totals by partition that may be broadcast; beyond it the same join shuffles.
BROADCAST_TOTALS = 200_000
#: Sources whose totals the driver holds; where there are more, those without a target of their own are interleaved by Spark.
MAX_SOURCES = 10_000
#: The queue of the sources that Spark interleaves, and its slots whose sizes are summed in one task.
REST, BLOCK = "rest\0", 4096

#: Texts of these characters alone are encoded by tiktoken, several times faster from the same vocabulary.
_PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa1-ɏ]")


class Encoder:
    """Token ids of whole texts as ``tokenizers`` gives them; a special string of the text is its token."""

    def __init__(self, name: str = "byte_bpe_50k"):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import base64

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
        self.added = {t.content: i for i, t in self.full.get_added_tokens_decoder().items()}
        self.special = re.compile("|".join(map(re.escape, self.added)) or r"(?!)")
        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.ranks = ranks

    def ids(self, text: str) -> np.ndarray:
        if _PLAIN.search(text) is None and self.special.search(text) is None:
            return self.fast.encode_to_numpy(text, disallowed_special=())
        return np.array(self.full.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=2)
def encoder(name: str = "byte_bpe_50k") -> Encoder:
    return Encoder(name)


def encoded(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """part, doc_id, source, at, n, ids: at is where the document begins within its partition's part of its queue.

    Ids are packed as 16-bit numbers, or 32-bit ones where a partition's batch needs them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, given, encode = TaskContext.get().partitionId(), {}, encoder()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                piece = batch.slice(first, 256)
                at, count, ids = [], [], []
                for text, source in zip(piece.column(1), piece.column(2).to_pylist(), strict=True):
                    found = np.append(encode.ids(text.as_py() or ""), END_ID)
                    at.append(given.get(source, 0))
                    given[source] = at[-1] + len(found)
                    count.append(len(found))
                    ids.append(found.astype("<u2" if found.max() < 65536 else "<u4").tobytes())
                columns = [pa.array([part] * len(at), pa.int32()), piece.column(0), piece.column(2), pa.array(at, pa.int64()), pa.array(count, pa.int64()), pa.array(ids, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["part", "doc_id", "source", "at", "n", "ids"])

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"))
    return chosen.mapInArrow(run, "part int, doc_id long, source string, at long, n long, ids binary")


@dataclass(frozen=True)
class Phase:
    """From token ``start`` of the whole on: begins[i] is queue i's position, takes[i] what it gives."""

    start: int
    begins: tuple[int, ...]
    takes: tuple[int, ...]


def plan_phases(totals: list[int], targets: list[float] | None) -> list[Phase]:
    """The phases in which queues of these totals run dry; without targets each queue's share is its own part."""
    left, begins, start, out = list(totals), [0] * len(totals), 0, []
    weights = list(targets) if targets is not None else [float(t) for t in totals]
    while any(left):
        live = [i for i, n in enumerate(left) if n and weights[i] > 0]
        if not live:
            weights = [float(n) for n in left]
            continue
        ends_first = min(live, key=lambda i: (left[i] / weights[i], i))
        rounds = left[ends_first] / weights[ends_first]
        takes = [min(left[i], round(rounds * weights[i])) if i in live else 0 for i in range(len(left))]
        takes[ends_first] = left[ends_first]
        out.append(Phase(start, tuple(begins), tuple(takes)))
        start += sum(takes)
        begins = [b + t for b, t in zip(begins, takes, strict=True)]
        left = [n - t for n, t in zip(left, takes, strict=True)]
    return out


class Allotment:
    """What the queues of a phase have given when its first m tokens are packed."""

    def __init__(self, takes: tuple[int, ...]):
        self.takes = takes
        self.total = sum(takes)

    def given(self, m: int) -> tuple[int, ...]:
        """The m tokens with the earliest due times (2 t + 1) / (2 n), ties to the first queue; in whole numbers."""
        takes, total = self.takes, self.total
        if m >= total:
            return takes
        out = [min(n, (2 * n * m + total) // (2 * total)) for n in takes]  # those due by m / total
        short = m - sum(out)
        while short > 0:
            i = min((j for j, n in enumerate(takes) if out[j] < n), key=lambda j: ((2 * out[j] + 1) / takes[j], j))
            out[i] += 1
            short -= 1
        while short < 0:
            i = max((j for j in range(len(takes)) if out[j]), key=lambda j: ((2 * out[j] - 1) / takes[j], j))
            out[i] -= 1
            short += 1
        return tuple(out)


class Layout:
    """Where each queue's tokens go in the whole packed stream."""

    def __init__(self, phases: list[Phase], tokens: int):
        self.phases, self.tokens = phases, tokens
        self.allotments = [Allotment(p.takes) for p in phases]
        self.starts = list(zip(*[p.begins for p in phases], strict=True)) if phases else []
        self.boundary = lru_cache(maxsize=4096)(lambda k, w: self.allotments[k].given(w * tokens))

    def runs(self, queue: int, first: int, count: int) -> Iterator[tuple[int, int, int]]:
        """(offset in the range, length, position in the stream) of the runs that tokens first.. of a queue go to."""
        done = 0
        while done < count:
            at = first + done
            k = bisect_right(self.starts[queue], at) - 1
            while not self.phases[k].takes[queue]:
                k -= 1
            phase, whole = self.phases[k], self.allotments[k]
            t = at - phase.begins[queue]
            w = int((2 * t + 1) * whole.total // (2 * phase.takes[queue])) // self.tokens
            while self.boundary(k, w)[queue] > t:
                w -= 1
            while self.boundary(k, w + 1)[queue] <= t:
                w += 1
            before, after = self.boundary(k, w), self.boundary(k, w + 1)
            length = min(count - done, after[queue] - t)
            inner = sum(after[:queue]) - sum(before[:queue]) + t - before[queue]
            yield done, length, phase.start + w * self.tokens + inner
            done += length


def slotted(rows: DataFrame, total: int, size: int) -> DataFrame:
    """doc_id, source, first, count, ids, skip, doc_tokens: the pieces of (doc_id, source, t, of, n, ids) in their queue's order.

    t is where a document begins among the ``of`` tokens of its source. Token t of a source is due at (2 t + 1) / (2 of) of the
    queue's ``total`` tokens, and in the slot of ``size`` that this falls in; a document is cut where its tokens' slot changes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = tuple([] for _ in range(8))
            for doc_id, source, t, of, n, ids in zip(*(batch.column(i).to_pylist() for i in range(6)), strict=True):
                width, at = len(ids) // n, 0
                while at < n:
                    slot = (2 * (t + at) + 1) * total // (2 * of * size)
                    end = min(n, -((total - 2 * of * size * (slot + 1)) // (2 * total)) - t)  # the first token of the next slot
                    for to, x in zip(out, (slot, doc_id, source, t + at, end - at, at, n, ids[at * width : end * width]), strict=True):
                        to.append(x)
                    at = end
            kinds = [pa.int64(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds, strict=True)], ["slot", "doc_id", "source", "t", "count", "skip", "doc_tokens", "ids"])

    schema = "slot long, doc_id long, source string, t long, count long, skip long, doc_tokens long, ids binary"
    cut = materialise(rows.select("doc_id", "source", "t", "of", "n", "ids").mapInArrow(run, schema), "slotted")
    sizes = materialise(cut.groupBy("slot").agg(F.sum("count").alias("size")).withColumn("block", F.floor(F.col("slot") / BLOCK)), "sizes")
    before = lambda w: F.coalesce(F.sum("size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = sizes.groupBy("block").agg(F.sum("size").alias("size")).select("block", before(Window.orderBy("block")).alias("blocks"))
    begins = sizes.withColumn("inner", before(Window.partitionBy("block").orderBy("slot"))).join(F.broadcast(blocks), "block").select("slot", (F.col("blocks") + F.col("inner")).alias("begin"))
    within = Window.partitionBy("slot").orderBy("source", "t")
    placed = cut.withColumn("inner", F.sum("count").over(within) - F.col("count")).join(begins, "slot")
    return placed.select("doc_id", "source", (F.col("begin") + F.col("inner")).alias("first"), "count", "ids", "skip", "doc_tokens")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", targets: dict[str, float] | None = None, length: int = LENGTH, window: int = WINDOW, keep_ids: bool = True) -> DataFrame:
    """doc_id, source, start, length, ids (array of int), ids_crc32, doc_tokens, sequence_id, offset: a row per piece.

    ``targets`` maps sources to shares of each window's tokens; without it, each source's share of all tokens.
    Without ``keep_ids`` the column ids is null; ids_crc32 is taken from the piece's ids all the same.
    """
    tokens = materialise(encoded(docs, id_col, text_col, source_col), "tokens")
    parts = tokens.groupBy("part", "source").agg(F.sum("n").alias("total"))
    parts = materialise(parts, "parts")
    many, wanted = parts.select("source").distinct().count() > MAX_SOURCES, list(targets or ())
    queue = F.when(F.col("source").isin(wanted), F.col("source")).otherwise(F.lit(REST)) if many else F.col("source")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    summed = parts.withColumn("queue", queue).withColumn("begin", F.coalesce(F.sum("total").over(before), F.lit(0))).withColumn("of", F.sum("total").over(Window.partitionBy("source")))
    begins = materialise(summed, "begins")
    discard(parts)
    queues = begins.groupBy("queue").agg(F.sum("total").alias("total")).orderBy("queue").collect()  # MAX_SOURCES, or the targets and one more, at most
    rank = {r["queue"]: i for i, r in enumerate(queues)}
    phases = plan_phases([r["total"] for r in queues], None if targets is None else [float(targets.get(r["queue"], 0)) for r in queues])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = Layout(phases, length * window)
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                yield from cut(batch.slice(first, 1024), layout)

    def cut(batch: pa.RecordBatch, layout: Layout) -> Iterator[pa.RecordBatch]:
        rows = {k: [] for k in ("doc_id", "source", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
        for *row, packed in zip(*(batch.column(i).to_pylist() for i in range(7)), batch.column(7), strict=True):
            doc_id, source, name, at, n, skip, doc_tokens = row
            data = packed.as_buffer()
            ids = np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")
            for start, size, position in layout.runs(rank[name], at, n):
                while size:
                    part = min(size, length - position % length)
                    piece = ids[start : start + part]
                    rows["doc_id"].append(doc_id)
                    rows["source"].append(source)
                    rows["start"].append(skip + start)
                    rows["length"].append(part)
                    rows["ids"].append(piece if keep_ids else piece[:0])
                    rows["ids_crc32"].append(zlib.crc32(piece.tobytes()))
                    rows["doc_tokens"].append(doc_tokens)
                    rows["sequence_id"].append(position // length)
                    rows["offset"].append(position % length)
                    start, size, position = start + part, size - part, position + part
        kinds = {"source": pa.string()}
        flat = np.concatenate(rows["ids"]) if rows["ids"] else np.zeros(0, "<u4")
        ends = np.cumsum([0, *map(len, rows["ids"])])
        columns = [pa.nulls(len(rows["ids"]), pa.list_(pa.int32())) if k == "ids" and not keep_ids else pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.astype(np.int32))) if k == "ids" else pa.array(v, kinds.get(k, pa.int64())) for k, v in rows.items()]
        yield pa.RecordBatch.from_arrays(columns, list(rows))

    small = begins.count() <= BROADCAST_TOTALS
    side = begins.select("part", "source", "queue", "begin", "of")
    met = tokens.join(F.broadcast(side) if small else side, ["part", "source"]).withColumn("t", F.col("begin") + F.col("at"))
    columns = ["doc_id", "source", "queue", "first", "count", "skip", "doc_tokens", "ids"]
    placed = met.where(F.col("queue") != REST).select("doc_id", "source", "queue", F.col("t").alias("first"), F.col("n").alias("count"), F.lit(0).cast("long").alias("skip"), F.col("n").alias("doc_tokens"), "ids")
    if many and REST in rank:
        placed = placed.unionByName(slotted(met.where(F.col("queue") == REST), queues[rank[REST]]["total"], length).withColumn("queue", F.lit(REST)).select(columns))
    schema = "doc_id long, source string, start long, length long, ids array<int>, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return placed.mapInArrow(run, schema)
