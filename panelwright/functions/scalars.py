"""Column expressions for cleaning labels and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Month abbreviations as they appear in period labels.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")


def to_number(c: Column) -> Column:
    """A double, null for text that isn't one and for values that aren't finite."""
    x = F.trim(c.cast("string")).try_cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.lit(None)).otherwise(x)


def fiscal_year(c: Column) -> Column:
    """The first year of a label such as 2005-06, or the year itself."""
    return F.substring(c.cast("string"), 1, 4).try_cast("int")


def _month(name: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, MONTHS)), F.upper(name))


def _full_year(c: Column, pivot: int) -> Column:
    y = c.try_cast("int")
    return F.when(F.length(c) == 4, y).when(y >= pivot + 1, 1900 + y).otherwise(2000 + y)


def parse_period(label: Column, pivot: int = 50) -> Column:
    """period and freq (M3, M, Q, A, D or U) of a label; two-digit years up to ``pivot`` count from 2000.

    A window of three months is named by its middle month. What isn't recognised stays as it is, with U.
    """
    s = F.upper(F.trim(label))
    part = lambda p, i: F.regexp_extract(s, p, i)
    month = "|".join(MONTHS)
    window, month_year, year_month = rf"^({month})-({month}) (\d{{4}}|\d{{2}})$", rf"^({month})[ -](\d{{4}}|\d{{2}})$", rf"^(\d{{4}})[ -]({month})$"
    year_quarter, quarter_year = r"^(\d{4})[ -]?Q([1-4])$", r"^Q([1-4])[ -]?(\d{4})$"
    months = lambda y, m: F.format_string("%04d-%02d", y, m.cast("int"))
    first, year = _month(part(window, 1)), _full_year(part(window, 3), pivot)
    made = lambda p, f: F.struct(p.alias("period"), F.lit(f).alias("freq"))
    return (
        F.when(s.rlike(window), made(months(year, first % 12 + 1), "M3"))
        .when(s.rlike(month_year), made(months(_full_year(part(month_year, 2), pivot), _month(part(month_year, 1))), "M"))
        .when(s.rlike(year_month), made(months(part(year_month, 1).try_cast("int"), _month(part(year_month, 2))), "M"))
        .when(s.rlike(year_quarter), made(F.concat(part(year_quarter, 1), F.lit("-Q"), part(year_quarter, 2)), "Q"))
        .when(s.rlike(quarter_year), made(F.concat(part(quarter_year, 2), F.lit("-Q"), part(quarter_year, 1)), "Q"))
        .when(s.rlike(r"^\d{4}$"), made(s, "A"))
        .when(s.rlike(r"^\d{4}-\d{2}$"), made(s, "M"))
        .when(s.rlike(r"^\d{4}-\d{2}-\d{2}$"), made(s, "D"))
        .otherwise(made(label, "U"))
    )


def strip_prefix(c: Column, prefix: str) -> Column:
    return F.when(F.startswith(c, F.lit(prefix)), F.substring(c, len(prefix) + 1, 1 << 20)).otherwise(c)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b isn't positive."""
    return F.when(b > 0, a / b)


def clip(c: Column, low: float | Column, high: float | Column) -> Column:
    """Null stays null."""
    as_column = lambda x: x if isinstance(x, Column) else F.lit(float(x))
    return F.when(c.isNotNull(), F.least(F.greatest(c, as_column(low)), as_column(high)))
