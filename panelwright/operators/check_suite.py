"""Many checks of one table compiled into one pass.

Row checks become one array of violations a row. Group checks name their keys and aggregates; those with equal keys share a
group. A row is dealt to each set of keys, and its violations travel along, so that however many checks there are, the table
is read once, shuffled once after map-side aggregation, and no check meets another's rows. Checks that look back need their
series in order: they add the one exchange of a window, shared by all checks of the same series.

Where a check compares tables (children and parents, or values expected and present), the tables are put together with
``tagged`` first: a check looks at its own tag's columns, and an input is still read once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.operators.checks import ISSUE

_VIOLATION = "struct<check:string,severity:string,key:string,measured:double,threshold:double>"
Over = Callable[[dict[str, Column]], Column]


def tagged(**tables: DataFrame) -> DataFrame:
    """The rows of all tables with their name in a column ``table``; columns that a table lacks are null."""
    out = None
    for name, df in tables.items():
        rows = df.withColumn("table", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _violation(check: str, severity: str, key: list[str], measured: Column, threshold: Column) -> Column:
    name = F.concat_ws("/", *[F.col(k).cast("string") for k in key]) if key else F.lit("all")
    return F.struct(F.lit(check).alias("check"), F.lit(severity).alias("severity"), name.alias("key"), measured.cast("double").alias("measured"), threshold.cast("double").alias("threshold"))


def _bar(threshold: float | Column | None) -> Column:
    return threshold if isinstance(threshold, Column) else F.lit(threshold)


@dataclass
class Suite:
    """Checks in the order in which they were added; ``run`` gives their violations."""

    rows: list[tuple[Column, Column]] = field(default_factory=list)
    before: dict[str, tuple[tuple[str, ...], str, Column]] = field(default_factory=dict)
    groups: list[tuple[tuple[str, ...], dict[str, tuple], Over, Over, dict]] = field(default_factory=list)

    def row(self, check: str, key: list[str], fails: Column, measured: Column, threshold: float | Column | None = None, severity: str = ISSUE) -> Suite:
        """A violation of every row for which ``fails`` holds; null counts as false."""
        self.rows.append((fails, _violation(check, severity, key, measured, _bar(threshold))))
        return self

    def step(self, name: str, series: list[str], order: str, value: Column) -> Suite:
        """A column ``name`` for later checks: ``value`` of the row before in the series."""
        self.before[name] = (tuple(series), order, value)
        return self

    def group(self, check: str, by: list[str], aggregates: dict[str, tuple], fails: Over, measured: Over, threshold: float | None = None, severity: str = ISSUE) -> Suite:
        """A violation of every group of ``by`` for which ``fails`` holds.

        ``aggregates`` holds (function, column) or (function, columns) by name; they are worked out for the groups of this
        check alone. fails and measured get their values by name.
        """
        self.groups.append((tuple(by), aggregates, fails, measured, {"check": check, "severity": severity, "key": list(by), "threshold": threshold}))
        return self

    def run(self, df: DataFrame) -> DataFrame:
        """check, severity, key, measured, threshold of all violations."""
        for name, (series, order, value) in self.before.items():
            df = df.withColumn(name, F.lag(value).over(Window.partitionBy(*series).orderBy(order)))
        sets = list(dict.fromkeys(g[0] for g in self.groups))
        keys = list(dict.fromkeys(k for s in sets for k in s))
        none = F.lit(None).cast(_VIOLATION)
        found = F.filter(F.array(*[F.when(fails, v) for fails, v in self.rows]), lambda v: v.isNotNull()) if self.rows else F.array().cast(f"array<{_VIOLATION}>")
        entries = F.concat(F.transform(found, lambda v: F.struct(F.lit(-1).alias("set"), v.alias("v"))), F.array(*[F.struct(F.lit(i).alias("set"), none.alias("v")) for i in range(len(sets))]))
        dealt = df.withColumn("_e", F.explode(entries))
        own = [F.when(F.col("_e.set").isin(*[i for i, s in enumerate(sets) if k in s]), F.col(k)).alias(f"_k{n}") for n, k in enumerate(keys)]
        combined, outcome = [F.count_if(F.col("_e.set") == -1).alias("_n")], [F.array_repeat("_v", F.col("_n").cast("int"))]
        for j, (by, aggregates, fails, measured, told) in enumerate(self.groups):
            at = sets.index(by)
            for name, (combine, column) in aggregates.items():
                combined.append(combine(*[F.when(F.col("_e.set") == at, c) for c in (column if isinstance(column, tuple) else (column,))]).alias(f"_a{j}_{name}"))
            values = {name: F.col(f"_a{j}_{name}") for name in aggregates}
            named = _violation(told["check"], told["severity"], [f"_k{keys.index(k)}" for k in by], measured(values), _bar(told["threshold"]))
            outcome.append(F.when((F.col("_set") == at) & fails(values), F.array(named)).otherwise(F.array().cast(f"array<{_VIOLATION}>")))
        grouped = dealt.groupBy(F.col("_e.set").alias("_set"), *own, F.col("_e.v").alias("_v")).agg(*combined)
        return grouped.select(F.explode(F.concat(*outcome)).alias("v")).select("v.*")


def rows_of(only: Column | None = None) -> tuple[Callable, Column]:
    """For ``aggregates``: the number of rows, of those for which ``only`` holds."""
    return F.count, F.lit(1) if only is None else F.when(only, F.lit(1))


# checks as they are most often wanted


def nulls(suite: Suite, by: list[str], value: str = "value") -> Suite:
    return suite.group("nulls", by, {"n": rows_of(F.col(value).isNull())}, lambda a: a["n"] > 0, lambda a: a["n"], 0)


def duplicates(suite: Suite, by: list[str], only: Column | None = None) -> Suite:
    return suite.group("duplicates", by, {"n": rows_of(only)}, lambda a: a["n"] > 1, lambda a: a["n"], 1)


def negatives(suite: Suite, key: list[str], value: str = "value") -> Suite:
    return suite.row("negatives", key, F.col(value) < 0, F.col(value), 0)


def coverage(suite: Suite, by: list[str], expected: Column, present: Column) -> Suite:
    """Groups that are expected but hold no row."""
    return suite.group("coverage", by, {"expected": rows_of(expected), "n": rows_of(present)}, lambda a: (a["expected"] > 0) & (a["n"] == 0), lambda a: a["n"], None)


def reconciles(suite: Suite, by: list[str], child: Column, parent: Column, tolerance: float) -> Suite:
    """Sums of ``child`` against those of ``parent``, which are null in each other's rows."""
    deviation = lambda a: F.abs(a["c"] - a["p"]) / F.nullif(F.abs(a["p"]), F.lit(0.0))
    return suite.group("reconciles", by, {"c": (F.sum, child), "p": (F.sum, parent)}, lambda a: deviation(a) > tolerance, deviation, tolerance)


def bounds(suite: Suite, key: list[str], value: Column, low: float, high: float, severity: str = ISSUE) -> Suite:
    return suite.row("bounds", key, (value > high) | (value < low), value, F.when(value > high, F.lit(high)).otherwise(F.lit(low)), severity)


def interval_order(suite: Suite, key: list[str], value: str = "value", low: str = "lo", high: str = "hi") -> Suite:
    wrong = (F.col(low) > F.col(high)) | (F.col(value) < F.col(low)) | (F.col(value) > F.col(high))
    return suite.row("interval_order", key, wrong, F.col(value))


def interval_width(suite: Suite, by: list[str], limit: float, severity: str, only: Column | None = None, value: str = "value", low: str = "lo", high: str = "hi") -> Suite:
    """The 90th percentile of the widths, in percent of the value."""
    width = 100.0 * (F.col(high) - F.col(low)) / F.nullif(F.abs(value), F.lit(0.0))
    return suite.group("interval_width", by, {"p": (lambda c: F.percentile(c, F.lit(0.9)), width if only is None else F.when(only, width))}, lambda a: a["p"] > limit, lambda a: a["p"], limit, severity)


def change(suite: Suite, check: str, key: list[str], now: Column, last: Column, low: float, high: float, scale: float = 1.0, slack: float = 0.0, severity: str = ISSUE) -> Suite:
    """Growth over the row before, times ``scale``, outside low and high."""
    growth = scale * (now / F.nullif(last, F.lit(0.0)) - 1)
    return suite.row(check, key, (growth > high + slack) | (growth < low - slack), growth, high, severity)


def seam(suite: Suite, by: list[str], down: float, up: float, value: str = "value", period: str = "period", data_type: str = "data_type") -> Suite:
    """continuity and vintage_gap: the step and the distance from each series' last historical to its first forecast row."""
    past, ahead = (F.when(F.col(data_type) == t, F.col(period)) for t in ("historical", "forecast"))
    jump = lambda a: a["b"] / F.nullif(a["a"], F.lit(0.0)) - 1
    suite.group("continuity", by, {"a": (F.max_by, (F.col(value), past)), "b": (F.min_by, (F.col(value), ahead))}, lambda a: (jump(a) > up) | (jump(a) < down), jump, up)
    return suite.group("vintage_gap", by, {"a": (F.max, past), "b": (F.min, ahead)}, lambda a: a["b"] - a["a"] != 1, lambda a: a["b"] - a["a"], 1)


def horizon(suite: Suite, by: list[str], last: int, period: Column) -> Suite:
    return suite.group("horizon", by, {"p": (F.max, period)}, lambda a: a["p"] < last, lambda a: a["p"], last)


def gaps(suite: Suite, by: list[str], period: Column) -> Suite:
    """Periods missing between a series' first and last; its rows have different periods."""
    missing = lambda a: a["b"] - a["a"] + 1 - a["n"]
    return suite.group("year_gaps", by, {"a": (F.min, period), "b": (F.max, period), "n": (F.count, period)}, lambda a: missing(a) > 0, missing, 0)


def comovement(suite: Suite, by: list[str], a: Column, b: Column, least: float, severity: str, rows: int = 5) -> Suite:
    return suite.group("comovement", by, {"r": (F.corr, (a, b)), "n": (F.count, a)}, lambda x: (x["n"] > rows) & (x["r"] < least), lambda x: x["r"], least, severity)


def plausible(suite: Suite, key: list[str], value: Column, low: float, high: float) -> Suite:
    """Derived values that are missing or NaN, negative, or outside their plausible range: warnings all."""
    missing = value.isNull() | F.isnan(value)
    suite.row("missing", key, missing, value, None, "warning").row("negative", key, (value < 0) & ~missing, value, 0, "warning")
    return suite.row("implausible", key, ~missing & (value >= 0) & ((value < low) | (value > high)), value, F.when(value > high, F.lit(high)).otherwise(F.lit(low)), "warning")


def terminal(suite: Suite, by: list[str], last: int, most: dict[str, float], metric: str = "metric", value: str = "value", period: str = "period") -> Suite:
    """The largest value of each metric in the last period, where it is over what ``most`` says."""
    for name, limit in most.items():
        at = F.when((F.col(metric) == name) & (F.col(period) == last), F.col(value))
        suite.group(f"terminal_{name}", by, {"m": (F.max, at)}, lambda a, limit=limit: a["m"] > limit, lambda a: a["m"], limit, "warning")
    return suite


def growth_of_ratio(suite: Suite, key: list[str], now: Column, last: Column, low: float = -5.0, high: float = 10.0) -> Suite:
    """A ratio of two metrics, such as output per job, that grows by less than ``low`` or more than ``high`` percent."""
    return change(suite, "ratio_growth", key, now, last, low, high, scale=100.0, severity="warning")
