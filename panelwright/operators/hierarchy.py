"""Keeping levels of a hierarchy consistent: scaling, allocation, continuity, inheritance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.panel import interpolated


def scaled_to_parent(children: DataFrame, parents: DataFrame, keys: list[str], columns: list[str], value: str = "value", target: str = "parent_value") -> DataFrame:
    """Forecast rows multiplied so that each group adds up to its parent; unchanged without parent or positive sum.

    The sum is that of the whole group; columns name what is scaled along (the value and its bounds).
    """
    total = F.sum(value).over(Window.partitionBy(*keys))
    joined = children.join(parents.select(*keys, target), keys, "left").withColumn("scale", F.when((total > 0) & F.col(target).isNotNull(), F.col(target) / total).otherwise(1.0))
    return joined.select(*[(F.col(c) * F.col("scale")).alias(c) if c in columns else F.col(c) for c in children.columns], "scale")


def scaled_below_cap(children: DataFrame, parents: DataFrame, keys: list[str], columns: list[str], cap: str, value: str = "value", target: str = "parent_value") -> DataFrame:
    """As ``scaled_to_parent``, but rows at or above their cap stay, and the free ones share what is left."""
    at_cap = F.col(cap).isNotNull() & (F.col(value) >= F.col(cap))
    w = Window.partitionBy(*keys)
    fixed, free = (F.coalesce(F.sum(F.when(c, F.col(value))).over(w), F.lit(0.0)) for c in (at_cap, ~at_cap))
    rest = F.col(target) - fixed
    joined = children.join(parents.select(*keys, target), keys, "left").withColumn("scale", F.when(~at_cap & (free > 0) & (rest > 0), rest / free).otherwise(1.0))
    return joined.select(*[(F.col(c) * F.col("scale")).alias(c) if c in columns else F.col(c) for c in children.columns], "scale")


def sanity_capped(df: DataFrame, cap: str, value: str = "value", upper: str = "hi", slack: float = 1.2) -> DataFrame:
    """Values above their cap are set to it, and their upper bounds to no more than ``slack`` times it."""
    over = F.col(cap).isNotNull() & (F.col(value) > F.col(cap))
    capped = df.withColumn("_over", over).withColumn(value, F.when(over, F.col(cap)).otherwise(F.col(value)))
    return capped.withColumn(upper, F.when(F.col("_over"), F.least(upper, F.col(cap) * slack)).otherwise(F.col(upper))).drop("_over")


def tiered_shares(statistics: DataFrame, universe: DataFrame, fallback: DataFrame, within: list[str], child: str, enough: int = 3) -> DataFrame:
    """A share for each row of ``universe`` and its share_quality, adding up to 1 within a group.

    good with at least ``enough`` years, fallback with fewer, imputed from ``fallback`` (child, fallback_share) or, where
    that has none, an equal part.
    """
    keys = [*within, child]
    out = universe.join(statistics.select(*keys, "share", "share_years"), keys, "left").join(fallback, child, "left")
    equal = F.lit(1.0) / F.count(F.lit(1)).over(Window.partitionBy(*within))
    quality = F.when(F.col("share_years") >= enough, "good").when(F.col("share_years") >= 1, "fallback").otherwise("imputed")
    out = out.withColumn("share_quality", quality).withColumn("share", F.coalesce(F.when(F.col("share_years") >= 1, F.col("share")), "fallback_share", equal))
    total = F.sum("share").over(Window.partitionBy(*within))
    return out.withColumn("share", F.when(total > 0, F.col("share") / total).otherwise(equal)).drop("fallback_share")


def sparse_shares(statistics: DataFrame, within: list[str], child: str, enough: int = 3, low: float = 1e-4, high: float = 0.9999) -> DataFrame:
    """Shares seen fewer than ``enough`` times become the group's mean weighted by observations, else an equal part."""
    w = Window.partitionBy(*within)
    seen = F.col("share_years") >= enough
    mean = F.sum(F.when(seen, F.col("share") * F.col("share_years"))).over(w) / F.nullif(F.sum(F.when(seen, F.col("share_years"))).over(w), F.lit(0))
    filled = F.when(seen, F.col("share")).otherwise(F.coalesce(mean, 1.0 / F.count(F.lit(1)).over(w)))
    return statistics.withColumn("share", F.least(F.greatest(filled, F.lit(low)), F.lit(high)))


def allocated(parents: DataFrame, shares: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A row for each parent row and child: the parent's columns times the child's share."""
    joined = parents.join(shares, keys)
    return joined.select(*[(F.col(c) * F.col("share")).alias(c) if c in columns else F.col(c) for c in joined.columns if c != "share"], "share")


def continuous(allocation: DataFrame, child_last: DataFrame, parent_last: DataFrame, child_keys: list[str], parent_keys: list[str], columns: list[str], tolerance: float = 1e-3, data_type: str = "data_type") -> DataFrame:
    """Forecast rows shifted by the factor between a child's last value and what its share of the parent's would be.

    child_last: keys and child_last_value; parent_last: keys and parent_last_value. Factors within tolerance of 1 are left out.
    """
    joined = allocation.join(child_last, child_keys, "left").join(parent_last, parent_keys, "left")
    expected = F.col("parent_last_value") * F.col("share")
    factor = F.when((expected > 0) & (F.col("child_last_value") > 0), F.col("child_last_value") / expected)
    joined = joined.withColumn("factor", F.when((F.abs(factor - 1) > tolerance) & (F.col(data_type) == "forecast"), factor).otherwise(1.0))
    return joined.select(*[(F.col(c) * F.col("factor")).alias(c) if c in columns else F.col(c) for c in allocation.columns], "factor")


def deviation(children: DataFrame, parents: DataFrame, keys: list[str], value: str = "value", target: str = "parent_value") -> DataFrame:
    """deviation: how far each group's sum is from its parent, as a part of the parent."""
    sums = children.groupBy(keys).agg(F.sum(value).alias("child_sum")).join(parents.select(*keys, target), keys)
    return sums.withColumn("deviation", F.abs(F.col("child_sum") - F.col(target)) / F.nullif(F.abs(target), F.lit(0.0)))


def compared(a: DataFrame, b: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """value_a, value_b, diff_pct for keys that both have."""
    both = a.select(*keys, F.col(value).alias("value_a")).join(b.select(*keys, F.col(value).alias("value_b")), keys)
    return both.withColumn("diff_pct", 100.0 * (F.col("value_a") - F.col("value_b")) / F.nullif(F.col("value_b"), F.lit(0.0)))


def inherited(df: DataFrame, parents: list[tuple[DataFrame, str]], keys: list[str], value: str = "value") -> DataFrame:
    """Missing values taken from the first parent level that has one; source names the level.

    parents: (table with keys, the parent's code and value; name of the code column), nearest level first.
    """
    out, candidates, source = df, [F.col(value)], F.when(F.col(value).isNotNull(), "own")
    for i, (table, code) in enumerate(parents):
        out = out.join(table.select(code, *keys, F.col(value).alias(f"_from{i}")), [code, *keys], "left")
        candidates.append(F.col(f"_from{i}"))
        source = source.when(F.col(f"_from{i}").isNotNull(), code)
    out = out.withColumn("source", source).withColumn(value, F.coalesce(*candidates))
    return out.drop(*[f"_from{i}" for i in range(len(parents))])


def years_filled(df: DataFrame, parents: DataFrame, entities: DataFrame, first: int, last: int, keys: list[str], value: str = "value", period: str = "period", target: str = "parent_value") -> DataFrame:
    """Every entity and period of the range: its own value, else its parent's."""
    grid = entities.select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias(period))
    out = grid.join(df.select(*entities.columns, period, value), [*entities.columns, period], "left").join(parents.select(*keys, target), keys, "left")
    return out.withColumn("filled", F.col(value).isNull() & F.col(target).isNotNull()).withColumn(value, F.coalesce(value, target)).drop(target)


def by_priority(candidates: list[tuple[str, DataFrame]], keys: list[str], value: str = "value") -> DataFrame:
    """For each key the value of the first method that has one, and the method's name."""
    out = None
    for i, (method, df) in enumerate(candidates):
        part = df.where(F.col(value).isNotNull()).select(*keys, F.struct(F.lit(i).alias("rank"), F.lit(method).alias("method"), F.col(value).alias("v")).alias("c"))
        out = part if out is None else out.unionByName(part)
    return out.groupBy(keys).agg(F.min("c").alias("c")).select(*keys, F.col("c.v").alias(value), F.col("c.method").alias("method"))


def decay_blend(last: Column, parent: Column, horizon: Column, half_life: float = 10.0) -> Column:
    """From the last value towards the parent's, half way at ``half_life``."""
    w = F.exp(-F.log(F.lit(2.0)) / half_life * horizon)
    return w * last + (1 - w) * parent


def cascade(levels: list[tuple[str, DataFrame]], keys: list[str], value: str = "value") -> DataFrame:
    """keys, a column per level, and spread: the largest difference of a level's sum from the first one's, relative."""
    out = None
    for name, df in levels:
        part = df.groupBy(keys).agg(F.sum(value).alias(name))
        out = part if out is None else out.join(part, keys)
    top = F.col(levels[0][0])
    return out.withColumn("spread", F.greatest(*[F.abs(F.col(n) - top) for n, _ in levels[1:]], F.lit(0.0)) / F.nullif(F.abs(top), F.lit(0.0)))


def rate_gaps_filled(df: DataFrame, original: DataFrame, parents: DataFrame, series: list[str], code: str, value: str = "value", period: str = "period") -> DataFrame:
    """Rates from a series' first to its last original period: its own, the line between its neighbours, else its parent's.

    original: the periods (series, period) that the source really holds; what lies beyond the last of them was
    extrapolated and goes, to be forecast later. parents: code, period and value. data_quality is observed, interpolated
    or the code column's name.
    """
    ends = original.groupBy(series).agg(F.max(period).alias("_end"))
    known = df.join(original.select(*series, period).distinct(), [*series, period], "left_semi")
    kept = df.join(ends, series).where(F.col(period) <= F.col("_end"))
    grid = kept.groupBy(*series, code).agg(F.explode(F.sequence(F.min(period), F.max("_end"))).alias(period))
    line = interpolated(known.select(*series, period, value), series, value, period).withColumnRenamed(value, "_line")
    out = grid.join(line, [*series, period], "left").join(parents.select(code, period, F.col(value).alias("_parent")), [code, period], "left")
    quality = F.when(F.col("_line").isNotNull(), F.col("data_quality")).otherwise(F.lit(code))
    return out.withColumn("data_quality", quality).withColumn(value, F.coalesce("_line", "_parent")).drop("_line", "_parent").where(F.col(value).isNotNull())


def inner_gaps_filled(df: DataFrame, series: list[str], first: int, columns: tuple[str, ...] = ("value", "lo", "hi"), period: str = "period", slack: float = 0.05) -> DataFrame:
    """Missing periods between existing ones, from ``first`` on, on the straight line: forecast rows of method gap_fill_interpolate.

    columns: the value and its bounds. A series without any bound gets them ``slack`` of the value away. Rows that exist stay.
    """
    value, low, high = columns
    inside = df.where(F.col(period) >= first)
    parts = [interpolated(inside.select(*series, period, c).where(F.col(c).isNotNull()), series, c, period).select(*series, period, c) for c in columns]
    out = parts[0].join(parts[1], [*series, period], "left").join(parts[2], [*series, period], "left")
    any_of = lambda c: F.count(c).over(Window.partitionBy(*series)) > 0
    back, ahead = (Window.partitionBy(*series).orderBy(period).rowsBetween(*w) for w in ((Window.unboundedPreceding, 0), (0, Window.unboundedFollowing)))
    near = lambda c: F.coalesce(F.last(c, True).over(back), F.first(c, True).over(ahead))
    bounds = {low: F.when(any_of(low), near(low)).otherwise(F.col(value) * (1 - slack)), high: F.when(any_of(high), near(high)).otherwise(F.col(value) * (1 + slack))}
    filled = out.select(*series, period, value, *[v.alias(k) for k, v in bounds.items()]).join(df.select(*series, period), [*series, period], "left_anti")
    return df.unionByName(filled.withColumn("data_type", F.lit("forecast")).withColumn("method", F.lit("gap_fill_interpolate")), allowMissingColumns=True)


def reconciled(children: DataFrame, parents: DataFrame, keys: list[str], columns: list[str], cap: str, value: str = "value", upper: str = "hi", target: str = "parent_value") -> DataFrame:
    """The three steps in order: scaled to the parent, set to the caps, and what that took shared among the free rows."""
    scaled = scaled_to_parent(children, parents, keys, columns, value, target).drop("scale")
    return scaled_below_cap(sanity_capped(scaled, cap, value, upper), parents, keys, columns, cap, value, target)


def rate_dispatch(last: DataFrame, children: DataFrame, parents: DataFrame, entity: str, parent: str, value: str = "value", weight: str = "weight", least: int = 8) -> DataFrame:
    """A rate for each entity and the method it comes from, the first that applies.

    copied from an only child, weighted mean of the children, the entity's own last value where it has ``least`` values,
    else inherited from the parent. last: entity, parent, n and value; children: entity, value and weight, a row per child;
    parents: parent and value.
    """
    some = children.where(F.col(value).isNotNull() & (F.col(weight) > 0)).groupBy(entity).agg(F.count(F.lit(1)).alias("_n"), (F.sum(F.col(value) * F.col(weight)) / F.sum(weight)).alias(value))
    up = last.select(entity, parent).join(parents.select(parent, value), parent).select(entity, value)
    steps = [("copied", some.where("_n = 1").select(entity, value)), ("weighted", some.where("_n > 1").select(entity, value)), ("own", last.where(F.col("n") >= least).select(entity, value)), ("inherited", up)]
    return by_priority(steps, [entity], value)
