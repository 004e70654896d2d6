"""Day and hour expressions. All built-in, all in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day_of(ts: str | Column) -> Column:
    return F.to_date(_col(ts))


def hour_start(ts: str | Column) -> Column:
    return F.date_trunc("hour", _col(ts))


def hour_end(ts: str | Column) -> Column:
    return hour_start(ts) + F.expr("INTERVAL 1 HOUR")


def slice_path(ts: str | Column) -> Column:
    """Folder label of the hour a row belongs to."""
    return F.date_format(hour_start(ts), "yyyy-MM-dd/HH-mm-ss")


def iso_day(day: str | Column) -> Column:
    return F.date_format(_col(day), "yyyy-MM-dd")


def previous_day(day: str | Column) -> Column:
    return F.date_sub(_col(day), 1)
