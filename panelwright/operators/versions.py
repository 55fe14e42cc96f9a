"""Two versions of a table: where they differ, found from fingerprints by key range, and aggregates brought up to date from that."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.audit import VOLATILE

#: Keys in a leaf's range, and nodes under one of the next level.
LEAF_KEYS, FANOUT = 4096, 64
#: Ranges that may be broadcast; beyond it the same join shuffles.
BROADCAST_RANGES = 100_000


def _marks(columns: list[str]) -> list[Column]:
    """n, x, s: what tells multisets of rows apart, whatever their order; each can be combined further."""
    row = F.xxhash64(*columns)
    return [F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"), F.sum(F.pmod(row, F.lit(1 << 31))).alias("s")]


def fingerprint_tree(df: DataFrame, key: str, leaf_keys: int = LEAF_KEYS, fanout: int = FANOUT, depth: int = 3, ignore: tuple[str, ...] = VOLATILE) -> DataFrame:
    """level (0: leaves), node, n, x, s: order-independent fingerprints of the rows of each range of a whole-number key.

    One scan gives the leaves, a row for each range that holds keys; levels above are combined from them. Rows whose key is
    null are the leaf whose node is null. The tree is small against its table and is what a run keeps of a version.
    """
    columns = sorted(c for c in df.columns if c not in ignore)
    leaves = df.groupBy(F.floor(F.col(key) / leaf_keys).alias("_leaf")).agg(*_marks(columns))
    up = F.explode(F.array(*[F.struct(F.lit(i).alias("level"), F.floor(F.col("_leaf") / fanout**i).alias("node")) for i in range(depth + 1)])).alias("at")
    nodes = leaves.select(up, "n", "x", "s").select("at.*", "n", "x", "s")
    return nodes.groupBy("level", "node").agg(F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.sum("s").alias("s"))


def unequal_leaves(before: DataFrame, after: DataFrame, fanout: int = FANOUT, depth: int = 3) -> DataFrame:
    """node of each leaf whose fingerprints differ, from two trees of the same shape; only unequal nodes are descended into."""
    suspects = None
    for level in range(depth, -1, -1):
        a, b = (t.where(F.col("level") == level).drop("level") for t in (before, after))
        if suspects is not None:
            up = F.floor(F.col("node") / fanout).alias("_up")
            a, b = (t.join(suspects.withColumnRenamed("node", "_up"), up.eqNullSafe(F.col("_up")), "left_semi") for t in (a, b))
        a, b = a.alias("a"), b.alias("b")
        differ = F.col("a.n").isNull() | F.col("b.n").isNull() | (F.col("a.n") != F.col("b.n")) | (F.col("a.x") != F.col("b.x")) | (F.col("a.s") != F.col("b.s"))
        found = a.join(b, F.col("a.node").eqNullSafe(F.col("b.node")), "full").where(differ)
        suspects = found.select(F.coalesce("a.node", "b.node").alias("node"))
    return suspects


def within_leaves(df: DataFrame, leaves: DataFrame, key: str, leaf_keys: int = LEAF_KEYS) -> DataFrame:
    """The rows of ``df`` in the ranges of ``leaves``; the scan gets the keys' ends to skip by, the join the ranges themselves."""
    n, first, last, unkeyed = leaves.agg(F.count(F.lit(1)), F.min("node"), F.max("node"), F.count_if(F.col("node").isNull())).first()
    if not n:
        return df.limit(0)
    near = (F.col(key) >= first * leaf_keys) & (F.col(key) < (last + 1) * leaf_keys) if first is not None else F.lit(False)
    own = leaves.select(F.col("node").alias("_node"))
    found = df.where(near | F.col(key).isNull() if unkeyed else near)
    return found.join(F.broadcast(own) if n <= BROADCAST_RANGES else own, F.floor(F.col(key) / leaf_keys).eqNullSafe(F.col("_node")), "left_semi")


def changed_keys(before: DataFrame, after: DataFrame, leaves: DataFrame, key: str, leaf_keys: int = LEAF_KEYS, ignore: tuple[str, ...] = VOLATILE) -> DataFrame:
    """key, status (added, removed, changed), rows_before, rows_after of each key whose rows differ.

    Only the ranges of ``leaves`` are read again. Keys may be repeated: their rows are compared as multisets.
    """
    columns = sorted(c for c in before.columns if c not in ignore)
    a, b = (within_leaves(t, leaves, key, leaf_keys).groupBy(key).agg(*_marks(columns)).alias(name) for t, name in ((before, "a"), (after, "b")))
    joined = a.join(b, F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")), "full")
    status = F.when(F.col("a.n").isNull(), "added").when(F.col("b.n").isNull(), "removed").when((F.col("a.n") != F.col("b.n")) | (F.col("a.x") != F.col("b.x")) | (F.col("a.s") != F.col("b.s")), "changed")
    out = joined.select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), status.alias("status"), F.coalesce("a.n", F.lit(0)).alias("rows_before"), F.coalesce("b.n", F.lit(0)).alias("rows_after"))
    return out.where(F.col("status").isNotNull())


# aggregates brought up to date


def part_hashes(df: DataFrame, part: str, ignore: tuple[str, ...] = VOLATILE) -> DataFrame:
    """part, n, x, s: the fingerprint of each part, as a registry of versions keeps it."""
    return df.groupBy(part).agg(*_marks(sorted(c for c in df.columns if c not in ignore)))


def changed_parts(registry: DataFrame, current: DataFrame, part: str) -> DataFrame:
    """part of every part that is new, gone, or whose fingerprint isn't the registry's."""
    a, b = registry.alias("a"), current.alias("b")
    same = (F.col("a.n") == F.col("b.n")) & (F.col("a.x") == F.col("b.x")) & (F.col("a.s") == F.col("b.s"))
    joined = a.join(b, F.col(f"a.{part}").eqNullSafe(F.col(f"b.{part}")), "full")
    return joined.where(~F.coalesce(same, F.lit(False))).select(F.coalesce(f"a.{part}", f"b.{part}").alias(part))


def signed(before: DataFrame, after: DataFrame) -> DataFrame:
    """The rows to retract (sign -1) and those to add (sign 1)."""
    return before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)))


def state(df: DataFrame, keys: list[str], sums: dict[str, Column], sign: Column | None = None) -> DataFrame:
    """keys, rows and sums: what is kept of an aggregate. Whole-number columns retract exactly, doubles to rounding."""
    by = F.lit(1) if sign is None else sign
    return df.groupBy(*keys).agg(F.sum(by).cast("long").alias("rows"), *[F.sum(v * by).alias(name) for name, v in sums.items()])


def applied(kept: DataFrame, deltas: DataFrame, keys: list[str]) -> DataFrame:
    """``kept`` with ``deltas`` added, without the groups that have no rows left.

    Only the groups of the deltas are added up again; the others are taken over as they are.
    """
    touched = deltas.select(*keys).distinct()
    same = reduce(lambda x, y: x & y, [F.col(f"k.{c}").eqNullSafe(F.col(f"t.{c}")) for c in keys])
    t = touched.alias("t")
    rest, old = (kept.alias("k").join(t, same, how).select("k.*") for how in ("left_anti", "left_semi"))
    sums = [c for c in kept.columns if c not in keys]
    new = old.unionByName(deltas).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums]).where("rows <> 0")
    return rest.unionByName(new.select(*kept.columns))
