"""Date/time column expressions over text fields (ANSI-safe: bad input
gives null, never an error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month abbreviations as they appear in the
# fixed-width ``created_at`` field, and their two-digit month numbers.
MONTHS = (("Jan", "01"), ("Feb", "02"), ("Mar", "03"), ("Apr", "04"), ("May", "05"), ("Jun", "06"),
          ("Jul", "07"), ("Aug", "08"), ("Sep", "09"), ("Oct", "10"), ("Nov", "11"), ("Dec", "12"))

# Fixed-width layout of ``created_at``, e.g. ``Tue Aug 25 09:08:07 +0000 2015``:
# (1-based start, length) of each field.
CREATED_AT_FIELDS = {"weekday_month_day": (1, 10), "month": (5, 3), "day": (9, 2),
                     "time": (12, 8), "year": (27, 4)}


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_number(abbrev: Column | str) -> Column:
    """'Jan' -> '01' ... 'Dec' -> '12'; anything else -> null."""
    a = _c(abbrev)
    expr = None
    for name, num in MONTHS:
        expr = F.when(a == name, num) if expr is None else expr.when(a == name, num)
    return expr


def created_at_field(created_at: Column | str, field: str) -> Column:
    start, length = CREATED_AT_FIELDS[field]
    return F.substring(_c(created_at), start, length)


def created_at_parts(created_at: Column | str) -> dict[str, Column]:
    c = _c(created_at)
    return {
        "created_at_date": F.concat(created_at_field(c, "weekday_month_day"), F.lit(" "),
                                    created_at_field(c, "year")),
        "created_at_year": created_at_field(c, "year"),
        "created_at_month": month_number(created_at_field(c, "month")),
        "created_at_day": created_at_field(c, "day"),
        "created_at_time": created_at_field(c, "time"),
    }


def sortable_timestamp(year: Column, month: Column, day: Column, time: Column) -> Column:
    """'yyyy MM dd HH:mm:ss' text; null if any part is null."""
    sp = F.lit(" ")
    return F.concat(year, sp, month, sp, day, sp, time)


def timestamp_of(sortable: Column | str) -> Column:
    """The sortable text as a timestamp without time zone; null if it is none."""
    return F.try_to_timestamp(_c(sortable), F.lit("yyyy MM dd HH:mm:ss")).cast("timestamp_ntz")


def date_parts(date_text: Column | str) -> dict[str, Column]:
    """year / month / day of a date given as text; unparsable -> null."""
    d = _c(date_text).try_cast("date")
    return {"year": F.year(d), "month": F.month(d), "day": F.dayofmonth(d)}
