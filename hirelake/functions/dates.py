"""Date functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnOrName, _c


def pad2(c: ColumnOrName) -> Column:
    """H5: left-pad to two characters (lpad also truncates to two)."""
    return F.lpad(_c(c).cast("string"), 2, "0")


def date_str(year: ColumnOrName, month: ColumnOrName, day: ColumnOrName) -> Column:
    """H6: year-MM-DD text; any NULL part gives NULL."""
    return F.concat(_c(year).cast("string"), F.lit("-"), pad2(month), F.lit("-"), pad2(day))


def to_date_lenient(c: ColumnOrName) -> Column:
    """String -> DATE, NULL for text that is not a date (ANSI-safe)."""
    return _try_cast_date(_c(c))


def _try_cast_date(c: Column) -> Column:
    return c.try_cast("date")


def as_date(value) -> Column:
    """A DATE literal from a date, a 'YYYY-MM-DD' string or a Column."""
    if isinstance(value, Column):
        return value.cast("date")
    if isinstance(value, (_dt.date, _dt.datetime)):
        value = value.strftime("%Y-%m-%d")
    return F.to_date(F.lit(value))


def within_days(c: ColumnOrName, as_of, days: int) -> Column:
    """H15 + B7 predicate: as_of <= date(c) <= as_of + days, both ends inclusive."""
    d = _try_cast_date(_c(c))
    start = as_date(as_of)
    return (d >= start) & (d <= F.date_add(start, days))


def reformat_dotted(c: ColumnOrName, src: str = "yyyy.MM.dd", dst: str = "yyyy-MM-dd") -> Column:
    """H16: 'yyyy.MM.dd' -> 'yyyy-MM-dd'; unparsable text gives NULL."""
    return F.date_format(F.try_to_date(_c(c), src), dst)


def day_parts(ts: ColumnOrName, padded: bool = False) -> dict[str, Column]:
    """Year, month, day of a date/timestamp as strings."""
    t = _c(ts)
    month = F.month(t).cast("string")
    day = F.dayofmonth(t).cast("string")
    if padded:
        month, day = pad2(month), pad2(day)
    return {"year": F.year(t).cast("string"), "month": month, "day": day}


def hms(seconds: ColumnOrName) -> Column:
    """H18: '{h}h {m}m {s}s' from whole seconds (divmod by 3600, then 60)."""
    s = _c(seconds).cast("bigint")
    hours = int_div(s, F.lit(3600))
    minutes = int_div(s % 3600, F.lit(60))
    secs = (s % 60).cast("bigint")
    return F.format_string("%dh %dm %ds", hours, minutes, secs)


def int_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Floor division of integers, exact at every size (``div`` cuts
    towards zero: a quotient of unlike signs with a remainder is one less)."""
    x, y = _c(a).cast("bigint"), _c(b).cast("bigint")
    cut = F.call_function("div", x, y)
    return cut - F.when((x % y != 0) & ((x < 0) != (y < 0)), 1).otherwise(0)
