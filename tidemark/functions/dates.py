"""Date and time expressions on zone-less timestamps."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F


def moment(value: datetime | None = None) -> Column:
    """A zone-less timestamp literal; the present in UTC where no value is given.

    Going through text keeps the literal independent of the session time zone.
    """
    if value is None:
        value = datetime.now(timezone.utc).replace(tzinfo=None)
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def days_between(start: Column, end: Column) -> Column:
    """Whole days from the date of ``start`` to the date of ``end``."""
    return F.date_diff(end.cast("date"), start.cast("date"))


def plus_days(value: Column, days: int) -> Column:
    """``value`` moved by ``days``; a timestamp keeps its time of day."""
    return value + F.expr(f"INTERVAL {int(days)} DAYS")


def minus_hours(value: Column, hours: int) -> Column:
    return value - F.expr(f"INTERVAL {int(hours)} HOURS")


def month_start(value: Column) -> Column:
    return F.trunc(value.cast("date"), "MM")


def second_text(value: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``. Cut from the text, as formatting a zone-less timestamp would
    take it through the session time zone."""
    return F.substring(value.cast("string"), 1, 19)


def minute_text(value: Column) -> Column:
    return F.substring(value.cast("string"), 1, 16)
