"""Operators that need a series in order: lags, gaps, growth, and folds whose state is their own last output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def year_on_year(df: DataFrame, series: list[str], rates: list[str], value: str = "value", period: str = "period", metric: str = "metric") -> DataFrame:
    """change: percent against the row before, or percentage points for rates; null where that row is 0 or missing."""
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(period))
    percent = 100.0 * (F.col(value) - before) / F.nullif(before, F.lit(0.0))
    return df.withColumn("change", F.when(F.col(metric).isin(*rates), F.col(value) - before).otherwise(percent))


def outside(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where((F.col(column) < low) | (F.col(column) > high))


def last_known(df: DataFrame, series: list[str], value: str = "value", period: str = "period") -> DataFrame:
    """last_period and last_value of each series."""
    return df.groupBy(series).agg(F.max(period).alias("last_period"), F.max_by(value, period).alias("last_value"))


def with_gaps(df: DataFrame, series: list[str], period: str = "period") -> DataFrame:
    """Series that lack a period between their first and last: first_period, last_period, missing."""
    spans = df.groupBy(series).agg(F.min(period).alias("first_period"), F.max(period).alias("last_period"), F.countDistinct(period).alias("_n"))
    return spans.withColumn("missing", F.col("last_period") - F.col("first_period") + 1 - F.col("_n")).where("missing > 0").drop("_n")


def cagr(df: DataFrame, series: list[str], first: int, last: int, value: str = "value", period: str = "period") -> DataFrame:
    """cagr between two periods; null unless both values are positive."""
    at = lambda p: F.max(F.when(F.col(period) == p, F.col(value)))
    ends = df.where(F.col(period).isin(first, last)).groupBy(series).agg(at(first).alias("_a"), at(last).alias("_b"))
    grown = F.when((F.col("_a") > 0) & (F.col("_b") > 0), F.pow(F.col("_b") / F.col("_a"), F.lit(1.0 / (last - first))) - 1)
    return ends.select(*series, grown.alias("cagr"))


def lookback_cagr(df: DataFrame, series: list[str], lookback: int, value: str = "value", period: str = "period") -> DataFrame:
    """hist_cagr over the last ``lookback`` rows, as the root of ``lookback`` of their ratio; null for shorter series."""
    recent = F.row_number().over(Window.partitionBy(*series).orderBy(F.desc(period)))
    rows = df.withColumn("_r", recent).where(F.col("_r") <= lookback)
    ends = rows.groupBy(series).agg(F.count(F.lit(1)).alias("_n"), F.min_by(value, period).alias("_a"), F.max_by(value, period).alias("_b"))
    grown = F.when((F.col("_n") == lookback) & (F.col("_a") > 0) & (F.col("_b") > 0), F.pow(F.col("_b") / F.col("_a"), F.lit(1.0 / lookback)) - 1)
    return ends.select(*series, grown.alias("hist_cagr"))


def running_max(df: DataFrame, series: list[str], value: str = "value", period: str = "period") -> DataFrame:
    w = Window.partitionBy(*series).orderBy(period).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(value, F.max(value).over(w))


def top_of_each(df: DataFrame, within: list[str], order: list[Column], k: int) -> DataFrame:
    """rank from 1 to k within each group."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*within).orderBy(*order))).where(F.col("rank") <= k)


def _folded(df: DataFrame, series: list[str], period: str, fields: list[str], start: Column, step) -> DataFrame:
    """Each series' rows in order, folded: step(previous output, row) gives a row's output.

    A series is one array; a fold can't be split, and its length is its number of periods.
    """
    rows = F.array_sort(F.collect_list(F.struct(period, *fields)))
    grouped = df.groupBy(series).agg(rows.alias("_rows"), F.first(start).alias("_start"))
    empty = F.array().cast("array<double>")
    out = F.aggregate("_rows", F.struct(F.col("_start").cast("double").alias("last"), empty.alias("out")), lambda acc, r: _append(acc, step(acc["last"], r)), lambda acc: acc["out"])
    return grouped.withColumn("_out", out).select(*series, F.explode(F.arrays_zip("_rows", "_out")).alias("_r")).select(*series, "_r._rows.*", F.col("_r._out").alias("adjusted"))


def _append(acc: Column, value: Column) -> Column:
    # bound once: acc and value are used twice
    return F.transform(F.array(value.cast("double")), lambda v: F.struct(v.alias("last"), F.concat(acc["out"], F.array(v)).alias("out")))[0]


def growth_capped(df: DataFrame, series: list[str], start: str, low: str, high: str, value: str = "value", period: str = "period") -> DataFrame:
    """adjusted: each step's growth over the adjusted value before is kept within the series' bounds.

    start, low and high are columns that are constant within a series; a value that isn't positive is passed over.
    """

    def step(last: Column, r: Column) -> Column:
        growth = (r[value] - last) / F.nullif(last, F.lit(0.0))
        return F.when(last <= 0, r[value]).when(growth > r[high], last * (1 + r[high])).when(growth < r[low], last * (1 + r[low])).otherwise(r[value])

    return _folded(df, series, period, [value, low, high], F.col(start), step).drop(low, high)


def growth_dampened(df: DataFrame, series: list[str], start: str, base_period: str, low: str, high: str, parent_growth: str, value: str = "value", period: str = "period", begin: int = 5, full: int = 15, weight: float = 0.7) -> DataFrame:
    """adjusted: growth capped, then drawn towards the parent's from ``begin`` periods out, fully from ``full`` on."""

    def step(last: Column, r: Column) -> Column:
        growth = F.least(F.greatest((r[value] - last) / F.nullif(last, F.lit(0.0)), r[low]), r[high])
        out = (r[period] - r[base_period]).cast("double")
        blend = F.least(F.lit(1.0), (out - begin) / float(full - begin)) * weight
        drawn = F.when(r[parent_growth].isNotNull() & (out > begin), (1 - blend) * growth + blend * r[parent_growth]).otherwise(growth)
        return F.when(last <= 0, r[value]).otherwise(last * (1 + drawn))

    return _folded(df, series, period, [value, low, high, parent_growth, base_period], F.col(start), step).drop(low, high, parent_growth, base_period)


def _advanced(acc: Column, r: Column) -> Column:
    """acc, a map of the value before a chunk, followed by one step of the fold.

    A step is x -> a * clamp(v, l * x, h * x) + b * x for a positive x, else v. Such steps are increasing and piecewise
    linear, and so is what follows from several of them: pieces says on which ranges it is slope * x + base. A step adds two
    borders at most.
    """

    def parts(g: Column) -> Column:
        at = lambda x: F.when(g["slope"] > 0, (x - g["base"]) / F.nullif(g["slope"], F.lit(0.0))).when(g["base"] < x, float("inf")).otherwise(float("-inf"))

        def cut(t: Column) -> Column:
            up, down = r["a"] * r["h"] + r["b"], r["a"] * r["l"] + r["b"]
            return F.array(
                F.struct(g["from"].alias("from"), F.least(g["upto"], t["one"]).alias("upto"), (up * g["slope"]).alias("slope"), (up * g["base"]).alias("base")),
                F.struct(F.greatest(g["from"], t["one"]).alias("from"), F.least(g["upto"], t["two"]).alias("upto"), (r["b"] * g["slope"]).alias("slope"), (r["a"] * r["v"] + r["b"] * g["base"]).alias("base")),
                F.struct(F.greatest(g["from"], t["two"]).alias("from"), g["upto"].alias("upto"), (down * g["slope"]).alias("slope"), (down * g["base"]).alias("base")),
            )

        return F.filter(_bound(F.struct(at(r["v"] / r["h"]).alias("one"), at(r["v"] / r["l"]).alias("two")), cut), lambda p: p["from"] < p["upto"])

    return F.struct(_stepped(acc["other"], r).alias("other"), F.flatten(F.transform(acc["pieces"], parts)).alias("pieces"))


def _bound(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def _stepped(x: Column, r: Column) -> Column:
    return F.when(x <= 0, r["v"]).otherwise(r["a"] * F.greatest(F.least(r["v"], r["h"] * x), r["l"] * x) + r["b"] * x)


def _through(x: Column, chunk: Column) -> Column:
    """The value at a chunk's end, from that before it."""
    piece = F.filter(chunk["pieces"], lambda p: x < p["upto"])
    return F.when(x <= 0, chunk["other"]).otherwise(_bound(piece, lambda p: p[0]["slope"] * x + p[0]["base"]))


def _scanned(df: DataFrame, series: list[str], period: str, start: Column, chunk: Column, v: Column, low: Column, high: Column, a: Column, b: Column) -> DataFrame:
    """``df`` with ``adjusted``, each series folded in chunks that are worked on apart.

    First every chunk gives the map from the value before it to the value at its end, then a series' few maps give the value
    before each chunk, then the chunks are folded. Rows without a value are left out. Growth bounds are above -1.
    """
    step = F.struct(F.col(period).alias("at"), v.cast("double").alias("v"), (1 + low).cast("double").alias("l"), (1 + high).cast("double").alias("h"), a.cast("double").alias("a"), b.cast("double").alias("b"), F.struct(*df.columns).alias("row"))
    whole = F.array(F.struct(F.lit(0.0).alias("from"), F.lit(float("inf")).alias("upto"), F.lit(1.0).alias("slope"), F.lit(0.0).alias("base")))
    chunks = df.where(v.isNotNull()).groupBy(*series, chunk.alias("_chunk")).agg(F.array_sort(F.collect_list(step), lambda x, y: F.when(x["at"] < y["at"], -1).when(x["at"] > y["at"], 1).otherwise(0)).alias("_rows"), F.min(start).cast("double").alias("_start"))
    maps = chunks.select(*series, "_start", F.col("_chunk"), F.aggregate("_rows", F.struct(F.lit(-1.0).alias("other"), whole.alias("pieces")), _advanced).alias("_map"))
    ordered = F.array_sort(F.collect_list(F.struct("_chunk", "_map")))
    along = maps.groupBy(*series).agg(ordered.alias("_maps"), F.min("_start").alias("_start"))
    none = F.array().cast("array<double>")
    before = F.aggregate("_maps", F.struct(F.col("_start").alias("x"), none.alias("seen")), lambda acc, m: F.struct(_through(acc["x"], m["_map"]).alias("x"), F.concat(acc["seen"], F.array(acc["x"])).alias("seen")), lambda acc: acc["seen"])
    begins = along.select(*series, F.explode(F.arrays_zip(F.transform("_maps", lambda m: m["_chunk"]).alias("_chunk"), before.alias("_begin"))).alias("_z")).select(*series, "_z._chunk", "_z._begin")
    out = F.aggregate("_rows", F.struct(F.col("_begin").alias("last"), none.alias("out")), lambda acc, r: _append(acc, _stepped(acc["last"], r)), lambda acc: acc["out"])
    folded = chunks.join(begins, [*series, "_chunk"]).select(F.explode(F.arrays_zip(F.col("_rows"), out.alias("_out"))).alias("_r"))
    return folded.select("_r._rows.row.*", F.col("_r._out").alias("adjusted"))


def growth_capped_in_chunks(df: DataFrame, series: list[str], start: str, low: str, high: str, chunk: Column, value: str = "value", period: str = "period") -> DataFrame:
    """``growth_capped`` for long series: no array holds more rows than a chunk, and a series' chunks are worked on in parallel.

    ``chunk`` grows with the period, for example the year and quarter of a day. Rows without a value are left out.
    """
    out = _scanned(df, series, period, F.col(start), chunk, F.col(value), F.col(low), F.col(high), F.lit(1.0), F.lit(0.0))
    return out.drop(start, low, high)


def growth_dampened_in_chunks(df: DataFrame, series: list[str], start: str, base_period: str, low: str, high: str, parent_growth: str, chunk: Column, value: str = "value", period: str = "period", begin: int = 5, full: int = 15, weight: float = 0.7) -> DataFrame:
    """``growth_dampened`` for long series, as ``growth_capped_in_chunks``."""
    out = (F.col(period) - F.col(base_period)).cast("double")
    blend = F.when(F.col(parent_growth).isNotNull() & (out > begin), F.least(F.lit(1.0), (out - begin) / float(full - begin)) * weight).otherwise(0.0)
    drawn = _scanned(df, series, period, F.col(start), chunk, F.col(value), F.col(low), F.col(high), 1 - blend, blend * (1 + F.coalesce(parent_growth, F.lit(0.0))))
    return drawn.drop(start, low, high, parent_growth, base_period)


def growth_percentiles(df: DataFrame, series: list[str], value: str = "value", period: str = "period", low: float = 0.02, high: float = 0.98, least: int = 6) -> DataFrame:
    """low_growth and high_growth: percentiles of each series' past growth, null with fewer than ``least`` steps."""
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(period))
    growth = df.withColumn("_g", F.when(before > 0, F.col(value) / before - 1))
    enough = lambda p: F.when(F.count("_g") >= least, F.percentile("_g", F.lit(p)))
    return growth.groupBy(series).agg(enough(low).alias("low_growth"), enough(high).alias("high_growth"))


def capped_with_bounds(df: DataFrame, series: list[str], start: str, low: str, high: str, volatility: str, value: str = "value", period: str = "period", lower: str = "lo", upper: str = "hi") -> DataFrame:
    """``growth_capped`` with its bounds: a series of which any step was capped gets adjusted -/+ 1.96 * volatility * sqrt(h).

    h counts a series' rows from 1; volatility, the standard deviation of past growth, is relative and constant within a
    series. Lower bounds don't go below 0. Series without a capped step or a positive volatility keep their bounds.
    """
    folded = growth_capped(df, series, start, low, high, value, period).join(df.select(*series, period, volatility, lower, upper), [*series, period])
    step = F.row_number().over(Window.partitionBy(*series).orderBy(period))
    capped = F.max(F.abs(F.col("adjusted") - F.col(value)) > 1e-9 * F.abs(value)).over(Window.partitionBy(*series)) & (F.col(volatility) > 0)
    width = 1.96 * F.col("adjusted") * F.col(volatility) * F.sqrt(step)
    out = folded.withColumn("_width", F.when(capped, width))
    out = out.withColumn(lower, F.when(F.col("_width").isNotNull(), F.greatest(F.col("adjusted") - F.col("_width"), F.lit(0.0))).otherwise(F.col(lower)))
    return out.withColumn(upper, F.when(F.col("_width").isNotNull(), F.col("adjusted") + F.col("_width")).otherwise(F.col(upper))).drop("_width", volatility)


def bounds_moved(df: DataFrame, adjusted: str = "adjusted", value: str = "value", lower: str = "lo", upper: str = "hi") -> DataFrame:
    """Bounds scaled by adjusted / value; left where the value is next to 0."""
    by = F.when(F.abs(value) > 1e-10, F.col(adjusted) / (F.col(value) + 1e-10)).otherwise(1.0)
    return df.withColumn(lower, F.col(lower) * by).withColumn(upper, F.col(upper) * by)


def growth_volatility(df: DataFrame, series: list[str], value: str = "value", period: str = "period") -> DataFrame:
    """volatility: the sample deviation of each series' relative steps."""
    before = F.lag(value).over(Window.partitionBy(*series).orderBy(period))
    return df.withColumn("_g", F.when(before != 0, F.col(value) / before - 1)).groupBy(series).agg(F.stddev_samp("_g").alias("volatility"))
