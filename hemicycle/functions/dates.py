"""Date parsing and truncation. Nothing here depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DAY_FIRST = r"^\s*(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})(.*)$"


def iso_timestamp(text: Column) -> Column:
    """ISO date or timestamp; anything else gives null."""
    return text.try_cast("timestamp_ntz")


def day_first_timestamp(text: Column) -> Column:
    """`dd/MM/yyyy` with an optional time. ISO text keeps its own order of month and day."""
    return F.regexp_replace(text, _DAY_FIRST, "$3-$2-$1$4").try_cast("timestamp_ntz")


def day_first_with_time(day: Column, time: Column) -> Column:
    """Day-first date joined with an optional separate `HH:mm` column."""
    clock = F.when(F.coalesce(time, F.lit("")) != "", F.concat(F.lit(" "), time)).otherwise(F.lit(""))
    return F.when(day != "", day_first_timestamp(F.concat(day, clock)))


def as_date(value: Column) -> Column:
    return value.try_cast("date")


def month_of(value: Column) -> Column:
    """`yyyy-MM`, null for a null date."""
    return F.date_format(as_date(value), "yyyy-MM")


def utc_now_text() -> Column:
    """Current instant as ISO-8601 text in UTC, whatever the session zone is."""
    now = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))
    return F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
