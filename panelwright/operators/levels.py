"""All levels of a hierarchy at once: roll-ups, reconciliation along paths, exact scaling below caps.

A node is named by its path, the array of its ancestors' names from the top, ending in its own. All levels are rows of one
table, so that an operation takes the same few steps whatever the number of levels.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolled_up(
    df: DataFrame, levels: dict[str, list[str]], keys: list[str], sums: dict[str, Column], rates: dict[str, tuple[Column, Column]] | None = None, quality: Column | None = None,
) -> DataFrame:
    """level, the columns of all ``levels`` (null where a level doesn't have them), ``keys``, and what is asked for.

    levels names the columns that make up each level, none for the whole. sums are totals; rates are (value, weight), their
    weighted means over the rows that have both; quality is a label of which any 'interpolated' marks the whole. One
    aggregation with grouping sets: a row is combined for every level before the one shuffle.
    """
    columns = list(dict.fromkeys(c for own in levels.values() for c in own))
    order = [*keys, *columns]
    out = [F.sum(v).alias(name) for name, v in sums.items()]
    for name, (value, weight) in (rates or {}).items():
        both = value.isNotNull() & weight.isNotNull()
        out.append((F.sum(F.when(both, value * weight)) / F.nullif(F.sum(F.when(both, weight)), F.lit(0.0))).alias(name))
    if quality is not None:
        out.append(F.when(F.max(F.when(quality == "interpolated", 1).otherwise(0)) == 1, "interpolated").otherwise(F.min(quality)).alias("quality"))
    numbers = {sum(1 << (len(order) - 1 - i) for i, c in enumerate(order) if c not in keys and c not in own): name for name, own in levels.items()}
    grouped = df.groupingSets([[*keys, *own] for own in levels.values()], *order).agg(F.grouping_id().alias("_id"), *out)
    level = reduce(lambda acc, n: acc.when(F.col("_id") == n, numbers[n]), list(numbers)[1:], F.when(F.col("_id") == list(numbers)[0], numbers[list(numbers)[0]]))
    return grouped.select(level.alias("level"), *[c for c in grouped.columns if c != "_id"])


def child_sums(nodes: DataFrame, keys: list[str], value: str = "value", path: str = "path") -> DataFrame:
    """keys, path and total: for every node with children the sum of theirs, of all levels in one aggregation."""
    up = F.slice(F.col(path), F.lit(1), F.size(path) - 1)
    return nodes.where(F.size(path) > 1).groupBy(*keys, up.alias(path)).agg(F.sum(value).alias("total"))


def deviations(nodes: DataFrame, keys: list[str], value: str = "value", path: str = "path") -> DataFrame:
    """keys, path, value, total and deviation (relative to the node) of every node with children."""
    own = nodes.select(*keys, path, value).join(child_sums(nodes, keys, value, path), [*keys, path])
    return own.withColumn("deviation", F.abs(F.col("total") - F.col(value)) / F.nullif(F.abs(value), F.lit(0.0)))


def reconciled_levels(nodes: DataFrame, keys: list[str], columns: list[str], value: str = "value", path: str = "path") -> DataFrame:
    """``nodes`` of all levels, scaled so that every node's children add up to it; the top level stays.

    What a node's children need is its value over their sum; a node's own factor is the product of that along its ancestors.
    The products are made over the nodes that have children, which are few, and meet the leaves once. ``columns`` are scaled
    along (the value and its bounds). Children without a positive sum, or whose parent has no row, keep their proportions to
    what is above them: a factor of 1 takes the place of the one that is missing.
    """
    needed = deviations(nodes, keys, value, path).select(*keys, path, F.when((F.col("total") > 0) & F.col(value).isNotNull(), F.col(value) / F.col("total")).otherwise(1.0).alias("_by"))
    inner = child_sums(nodes, keys, value, path).select(*keys, path)  # all that have children, with or without a row
    ancestors = inner.select(*keys, path, F.explode(F.transform(F.sequence(F.lit(1), F.size(path)), lambda n: F.slice(F.col(path), F.lit(1), n))).alias("_up"))
    factors = ancestors.join(needed.withColumnRenamed(path, "_up"), [*keys, "_up"], "left").groupBy(*keys, path).agg(F.array_sort(F.collect_list(F.struct(F.size("_up").alias("depth"), F.coalesce("_by", F.lit(1.0)).alias("by")))).alias("_along"))
    product = factors.select(*keys, F.col(path).alias("_parent"), F.aggregate("_along", F.lit(1.0), lambda acc, x: acc * x["by"]).alias("_factor"))
    with_parent = nodes.withColumn("_parent", F.slice(F.col(path), F.lit(1), F.greatest(F.size(path) - 1, F.lit(0))))
    out = with_parent.join(product, [*keys, "_parent"], "left").withColumn("scale", F.coalesce("_factor", F.lit(1.0)))
    return out.select(*[(F.col(c) * F.col("scale")).alias(c) if c in columns else F.col(c) for c in nodes.columns], "scale")


#: Buckets of breakpoints a doubling of their size.
_PER_DOUBLING = 64


def filled_below_caps(rows: DataFrame, targets: DataFrame, keys: list[str], columns: list[str], cap: str, value: str = "value", target: str = "target") -> DataFrame:
    """``rows`` scaled by one factor per group and cut at their caps, so that each group adds up to its target.

    The factor f solves sum(min(f * value, cap)) = target, exactly: rows fill up in the order of cap / value, and running sums
    over those breakpoints say where it lies. A null cap is none. Where even all caps don't reach the target, every row is at
    its cap (rows without one take what is left). Groups without a positive target and rows without a positive value are left
    as they are, the latter counting towards the target. ``columns`` are scaled along with the value.

    The sums are first made for buckets of breakpoints, map-side, and only the bucket that holds the factor is looked at
    value by value, so that no group's rows meet in a task.
    """
    takes = (F.col(value) > 0) & (F.col(cap).isNull() | (F.col(cap) >= 0))
    point = F.when(F.col(cap).isNotNull(), F.col(cap) / F.col(value))
    some = rows.where(takes).select(*keys, F.col(value).cast("double").alias("_v"), F.col(cap).cast("double").alias("_c"), point.alias("_at"))
    some = some.withColumn("_bucket", F.when(F.col("_at") > 0, F.floor(F.log2("_at") * _PER_DOUBLING)).when(F.col("_at") == 0, F.lit(-(1 << 40))))
    held = rows.where(~F.coalesce(takes, F.lit(False))).groupBy(*keys).agg(F.sum(value).alias("_held"))
    wanted = targets.select(*keys, F.col(target).cast("double").alias("_t")).where("_t > 0").join(held, keys, "left").select(*keys, (F.col("_t") - F.coalesce("_held", F.lit(0.0))).alias("_t"))

    buckets = some.groupBy(*keys, "_bucket").agg(F.sum("_v").alias("_v"), F.sum("_c").alias("_c"), F.max("_at").alias("_last"))
    # with f at a bucket's last breakpoint, the rows up to it are at their caps and the others at f times their value
    along = Window.partitionBy(*keys).orderBy(F.col("_bucket").asc_nulls_last())
    full, free = F.coalesce(F.sum("_c").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), F.sum("_v").over(along.rowsBetween(0, Window.unboundedFollowing))
    reached = buckets.withColumn("_full", full).withColumn("_free", free).join(wanted, keys).withColumn("_upto", F.col("_full") + F.coalesce("_c", F.lit(0.0)) + F.col("_last") * (F.col("_free") - F.col("_v")))
    mine = reached.where(F.col("_bucket").isNull() | (F.col("_upto") >= F.col("_t"))).groupBy(*keys).agg(F.min_by(F.struct("_bucket", "_full", F.col("_free").alias("_rest"), "_t"), F.coalesce("_bucket", F.lit(1 << 40))).alias("m")).select(*keys, "m.*")
    mine = mine.withColumnRenamed("_bucket", "_own")
    near = some.join(mine.select(*keys, "_own"), keys).where(F.col("_bucket") == F.col("_own")).groupBy(*keys, "_at").agg(F.sum("_v").alias("_v"), F.sum("_c").alias("_c"))
    w = Window.partitionBy(*keys).orderBy("_at")
    inside = near.join(mine, keys).withColumn("_before", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))).withColumn("_gone", F.coalesce(F.sum("_v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    factor = (F.col("_t") - F.col("_full") - F.col("_before")) / (F.col("_rest") - F.col("_gone"))
    # the first breakpoint at which the target is reached: before it nothing more fills up
    fine = inside.where(F.col("_full") + F.col("_before") + F.col("_at") * (F.col("_rest") - F.col("_gone")) >= F.col("_t")).groupBy(*keys).agg(F.min_by(factor, F.col("_at")).alias("_f"))
    rest = mine.where(F.col("_own").isNull() & (F.col("_rest") > 0)).select(*keys, ((F.col("_t") - F.col("_full")) / F.col("_rest")).alias("_f"))
    every = wanted.join(fine.unionByName(rest), keys, "left").select(*keys, F.greatest(F.coalesce("_f", F.lit(float("inf"))), F.lit(0.0)).alias("_f"))
    joined = rows.join(every, keys, "left")
    new = F.when(takes & F.col("_f").isNotNull(), F.least(F.col("_f") * F.col(value), F.col(cap))).otherwise(F.col(value))  # least passes over nulls
    scaled = joined.withColumn("_new", F.when(new == float("inf"), F.col(value)).otherwise(new)).withColumn("scale", F.when(F.col(value) > 0, F.col("_new") / F.col(value)).otherwise(1.0))
    return scaled.select(*[F.col("_new").alias(c) if c == value else (F.col(c) * F.col("scale")).alias(c) if c in columns else F.col(c) for c in rows.columns], "scale")
