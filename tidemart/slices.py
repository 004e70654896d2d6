"""Time slices: an hour [H, H+1), a calendar day, or everything since a day."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Fixed value: the folders of a landing slice.
LANDING_FOLDER = "%Y-%m-%d/%H-%M-%S"


def _utc(value: datetime) -> datetime:
    """A time without zone is UTC already."""
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value


def _as_day(value: date | datetime | str) -> date:
    if isinstance(value, str):
        return date.fromisoformat(value)
    return _utc(value).date() if isinstance(value, datetime) else value


@dataclass(frozen=True)
class Slice:
    kind: str
    start: datetime

    @classmethod
    def hour(cls, at: datetime) -> Slice:
        return cls("hour", _utc(at).replace(minute=0, second=0, microsecond=0))

    @classmethod
    def day(cls, day: date | datetime | str) -> Slice:
        return cls("day", datetime.combine(_as_day(day), time()))

    @classmethod
    def since(cls, day: date | datetime | str) -> Slice:
        return cls("since", datetime.combine(_as_day(day), time()))

    @property
    def end(self) -> datetime | None:
        """First instant after the slice; None when open-ended."""
        if self.kind == "hour":
            return self.start + timedelta(hours=1)
        if self.kind == "day":
            return self.start + timedelta(days=1)
        return None

    @property
    def date(self) -> date:
        return self.start.date()

    def bounds(self, kind: T.DataType) -> tuple[datetime | date, datetime | date | None]:
        """First value in the slice and first one after it, in the audit column's own type.

        A date is the midnight it starts with: the first hour of a day has its rows, the others none.
        """
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            return self.start, self.end
        if not isinstance(kind, T.DateType):
            raise ValueError(f"an audit column must be a timestamp or a date, not {kind.simpleString()}")
        return tuple(None if at is None else (at + timedelta(days=1) - timedelta.resolution).date() for at in (self.start, self.end))

    def of(self, df: DataFrame, audit: str, partition: str | None = None) -> Column:
        """``predicate`` for a column of ``df``, by its type; an error for types that are no times."""
        kind = next((f.dataType for f in df.schema.fields if f.name.lower() == audit.lower()), None)
        if kind is None:
            raise ValueError(f"no column {audit!r}")
        return self.predicate(audit, partition, kind)

    def predicate(self, audit: str | Column, partition: str | Column | None = None, kind: T.DataType = T.TimestampType()) -> Column:
        """Rows of the slice. Bounds are plain comparisons on the column, so they reach the scan.

        Times are string literals: the analyzer folds them to the column's own timestamp
        type (with or without zone) instead of casting the column. A date column needs its
        ``kind``, or its values would be compared with shortened bounds. ``partition`` names a day
        column the table is partitioned by; it prunes directories, which a predicate on the
        audit column alone cannot do.
        """
        column = F.col(f"`{audit}`") if isinstance(audit, str) else audit
        first, after = (F.lit(b.isoformat(sep=" ") if isinstance(b, datetime) else b) for b in self.bounds(kind))
        keep = column >= first
        if self.end is not None:
            keep = keep & (column < after)
        if partition is not None:
            day = F.col(partition) if isinstance(partition, str) else partition
            mark = F.lit(self.date)
            keep = (day >= mark if self.kind == "since" else day == mark) & keep
        return keep

    def label(self) -> str:
        """Name of the slice inside an append log."""
        return f"{self.kind}-{self.start:%Y-%m-%d-%H}"

    def path(self, database: str, table: str, init: bool = False) -> str:
        """Landing folder of the slice, relative to the landing root."""
        middle = "init_load/" if init else ""
        return f"{database}/{table}/{middle}{self.start.strftime(LANDING_FOLDER)}"


def resolve_slice(
    *,
    full_refresh: bool,
    execution_date: date | str | None,
    target_exists: bool,
    today: date,
    since: date | str,
) -> Slice:
    """Which slice an incremental model builds.

    A full refresh wins over an explicit date, which wins over yesterday; yesterday only
    applies once the target exists. A first run with neither has no slice and is an error.
    """
    if full_refresh:
        return Slice.since(since)
    if execution_date:
        return Slice.day(execution_date)
    if target_exists:
        return Slice.day(today - timedelta(days=1))
    raise ValueError("first run of a model needs a full refresh or an execution date")
