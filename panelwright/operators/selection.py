"""Quantiles of large groups: exact ones by narrowing ranges, and a sketch with a stated error."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.session import kept

#: Rows that a range may hold to be looked at value by value, cells that a larger one is cut into,
#: and the sketch's accuracy, which is far finer than a cell.
DIRECT_ROWS, CELLS, ACCURACY = 1_000_000, 256, 10_000
#: Ranges that may be broadcast; beyond it the same join shuffles.
BROADCAST_RANGES = 100_000


def sketched_quantiles(df: DataFrame, groups: list[str], value: str, probabilities: list[float], accuracy: int = ACCURACY) -> DataFrame:
    """groups, p, approximate: a value whose rank is off by n / accuracy at most; one pass, merged map-side, of bounded size."""
    found = df.groupBy(*groups).agg(F.percentile_approx(value, F.array(*map(F.lit, probabilities)), accuracy).alias("_q"))
    return found.select(*groups, F.explode(F.arrays_zip(F.array(*map(F.lit, probabilities)).alias("p"), F.col("_q").alias("approximate"))).alias("_z")).select(*groups, "_z.p", "_z.approximate")


def exact_quantiles(df: DataFrame, groups: list[str], value: str, probabilities: list[float], direct_rows: int = DIRECT_ROWS, cells: int = CELLS) -> DataFrame:
    """groups, p, value: exact quantiles, linear between ranks, of values that are neither null nor NaN.

    Each wanted rank starts with its group's whole range. While a range holds more than ``direct_rows`` rows, a sketch of its
    rows says between which two values the rank must lie, three of ``cells`` apart, and counting the rows below and between
    them makes that the next range. Rows of the last ranges are counted value by value. Counts and sketches are made map-side;
    no task gets a group's rows, only those of equal values count as one. A group without values gives no row.
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*groups, F.col(value).cast("double").alias("_v"))
    sizes = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    at = sizes.select(*groups, "_n", F.explode(F.array(*map(F.lit, probabilities))).alias("p")).withColumn("_pos", F.col("p") * (F.col("_n") - 1))
    both = F.array_distinct(F.array(F.floor("_pos"), F.least(F.floor("_pos") + 1, F.col("_n") - 1)))
    low, high = F.lit(float("-inf")), F.lit(float("inf"))
    ranges = at.select(*groups, F.explode(both).alias("_rank0"), F.col("_n").alias("_m")).distinct()
    ranges = kept(ranges.select(*groups, "_rank0", F.col("_rank0").alias("_rank"), low.alias("_low"), high.alias("_high"), "_m"))

    def inside(of: DataFrame, *columns: str) -> DataFrame:
        """The rows of each of the ranges, which are (groups, _low, _high, columns), both ends included."""
        held = of.select(*groups, "_low", "_high", *columns)
        met = rows.join(F.broadcast(held) if held.count() <= BROADCAST_RANGES else held, groups)
        return met.where((F.col("_v") >= F.col("_low")) & (F.col("_v") <= F.col("_high")))

    while not (wide := ranges.where(F.col("_m") > direct_rows)).isEmpty():
        key = [*groups, "_low", "_high"]
        grid = F.array(*[F.lit(i / cells) for i in range(cells + 1)])
        borders = inside(wide.select(*key).distinct()).groupBy(*key).agg(F.percentile_approx("_v", grid, ACCURACY).alias("_b"))
        cell = F.floor(F.col("_rank") / F.col("_m") * cells).cast("int")
        aimed = wide.join(borders, key).withColumn("_to", F.get("_b", F.least(cell + 2, F.lit(cells)))).withColumn("_from", F.when(cell > 1, F.get("_b", cell - 1)).otherwise(F.col("_low")))
        aimed = kept(aimed.select(*key, "_rank0", "_rank", "_m", "_from", F.when(cell + 2 >= cells, F.col("_high")).otherwise(F.col("_to")).alias("_to")))
        counted = inside(aimed, "_rank0", "_from", "_to").groupBy(*groups, "_rank0").agg(F.count_if(F.col("_v") < F.col("_from")).alias("_below"), F.count_if((F.col("_v") >= F.col("_from")) & (F.col("_v") <= F.col("_to"))).alias("_in"))
        found = aimed.join(counted, [*groups, "_rank0"]).withColumn("_new", F.col("_rank") - F.col("_below"))
        fits = (F.col("_new") >= 0) & (F.col("_new") < F.col("_in"))
        # a range of one value, or one that doesn't shrink any more, is looked at as it is
        size = F.when(fits & (F.col("_from") < F.col("_to")) & (F.col("_in") < F.col("_m")), F.col("_in")).otherwise(F.lit(0))
        pick = lambda a, b: F.when(fits, F.col(a)).otherwise(F.col(b)).alias(b)
        narrowed = found.select(*groups, "_rank0", pick("_new", "_rank"), pick("_from", "_low"), pick("_to", "_high"), size.alias("_m"))
        ranges = kept(ranges.where(F.col("_m") <= direct_rows).unionByName(narrowed))

    key = [*groups, "_rank0"]
    values = inside(ranges, "_rank0", "_rank").groupBy(*key, "_rank", "_v").agg(F.count(F.lit(1)).alias("_c"))
    run = values.withColumn("_before", F.sum("_c").over(Window.partitionBy(*key).orderBy("_v")) - F.col("_c"))
    found = run.where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_c"))).select(*groups, "_rank0", "_v")
    lower = found.select(*groups, F.col("_rank0").alias("_a"), F.col("_v").alias("_va"))
    upper = found.select(*groups, F.col("_rank0").alias("_z"), F.col("_v").alias("_vz"))
    ranks = at.withColumn("_a", F.floor("_pos")).withColumn("_z", F.least(F.floor("_pos") + 1, F.col("_n") - 1))
    out = ranks.join(lower, [*groups, "_a"]).join(upper, [*groups, "_z"])
    return out.select(*groups, "p", (F.col("_va") + (F.col("_vz") - F.col("_va")) * (F.col("_pos") - F.col("_a"))).alias("value"))
