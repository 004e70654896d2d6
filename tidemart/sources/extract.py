"""Reading source tables: whole, or one time slice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemart.registry import TableSpec
from tidemart.slices import Slice


@dataclass(frozen=True)
class FileSource:
    """Tables kept as files, one path per table: ``root/<table><suffix>``."""

    root: str
    format: str = "parquet"
    suffix: str = ""

    def scan(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format(self.format).load(f"{self.root}/{table}{self.suffix}")


# How a connection is set to UTC.
ZONE_STATEMENTS = {
    "postgresql": "SET TIME ZONE 'UTC'",
    "mysql": "SET time_zone = '+00:00'",
    "mariadb": "SET time_zone = '+00:00'",
}


@dataclass(frozen=True)
class JdbcSource:
    """A relational database. ``fetch_rows`` bounds the rows a reader holds at a time.

    Times without zone are read as such, so the zone of the JVM cannot shift them. Connections to
    databases whose zone can be set by ``SET TIME ZONE`` run in UTC, so bounds without a zone mean UTC;
    ``sessionInitStatement`` in the properties replaces that statement. ``histogram_bins`` is how finely the
    database counts keys before a table is read in parallel; 0 cuts the keys into equal steps uncounted.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    fetch_rows: int = 10_000
    histogram_bins: int = 1_024

    def options(self) -> dict[str, str]:
        defaults = {"fetchsize": str(self.fetch_rows), "preferTimestampNTZ": "true"}
        statement = next((s for name, s in ZONE_STATEMENTS.items() if self.url.startswith(f"jdbc:{name}:")), None)
        if statement:
            defaults["sessionInitStatement"] = statement
        return {**defaults, **self.properties, "url": self.url}

    def ranges(self, spark: SparkSession, table: str, predicates: list[str]) -> DataFrame:
        """One reader per predicate, each filtered by the database."""
        properties = {k: v for k, v in self.options().items() if k != "url"}
        return spark.read.jdbc(self.url, table, predicates=predicates, properties=properties)

    def scan(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.format("jdbc").options(**self.options(), dbtable=table).load()

    def bounds(self, spark: SparkSession, table: str, column: str) -> tuple:
        """Smallest and largest value, computed by the database."""
        query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
        row = spark.read.format("jdbc").options(**self.options(), query=query).load().first()
        return row[0], row[1]

    def _counts(self, spark: SparkSession, query: str) -> list[tuple]:
        rows = spark.read.format("jdbc").options(**self.options(), query=query).load().collect()
        return sorted((r[0], int(r[1])) for r in rows if r[0] is not None)

    def days(self, spark: SparkSession, table: str, column: str) -> list[tuple[date, int]]:
        """Rows by day of a time, counted by the database: at most the calendar."""
        day = f"CAST({column} AS DATE)"
        return self._counts(spark, f"SELECT {day} AS bin, COUNT(*) AS n FROM {table} GROUP BY {day}")

    def bins(self, spark: SparkSession, table: str, column: str, lo: int, after: int, fine: int) -> list[tuple[int, int, int]]:
        """(first key, first key after, rows) of the bins of [lo, after) that have rows, counted by the database.

        Bins with more than ``fine`` rows are counted again in smaller ones, until none is that large or a bin is one key.
        """
        width = -(-(after - lo) // self.histogram_bins)
        bin_of = f"FLOOR(({column} - ({lo})) / {width})"
        where = f"{column} >= {lo} AND {column} < {after}"
        counts = self._counts(spark, f"SELECT {bin_of} AS bin, COUNT(*) AS n FROM {table} WHERE {where} GROUP BY {bin_of}")
        found = []
        for number, rows in counts:
            first = lo + int(number) * width
            last = min(first + width, after)
            found += self.bins(spark, table, column, first, last, fine) if rows > fine and last - first > 1 else [(first, last, rows)]
        return found


Source = FileSource | JdbcSource


def split_column(schema: T.StructType, spec: TableSpec) -> str | None:
    """The column a JDBC read is split by: a numeric first key, else the audit time, else none."""
    kinds = {f.name.lower(): f.dataType for f in schema.fields}
    if isinstance(kinds.get(spec.keys[0].lower()), T.NumericType):
        return spec.keys[0]
    if isinstance(kinds.get(spec.audit.lower()), (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return spec.audit
    return None


def _literal(value) -> str:
    if isinstance(value, datetime):
        return f"'{value.isoformat(sep=' ')}'"
    return f"'{value.isoformat()}'" if isinstance(value, date) else str(value)


def predicates_at(column: str, edges: Sequence) -> list[str]:
    """SQL ranges cut at ascending edges that together cover every row: open at both ends, NULLs with the first."""
    if not edges:
        return []
    text = [_literal(e) for e in edges]
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(text, text[1:])]
    return [f"{column} < {text[0]} OR {column} IS NULL", *inner, f"{column} >= {text[-1]}"]


def range_predicates(column: str, lo, hi, num_partitions: int) -> list[str]:
    """Ranges of equal steps between the smallest and the largest value."""
    if not isinstance(lo, date):
        lo, hi = int(lo), int(hi)
    span = hi - lo
    # Whole steps for numbers and days, exact ones for times; a short span has fewer edges.
    return predicates_at(column, sorted({lo + (i * span) // num_partitions for i in range(1, num_partitions)} - {lo}))


def even_edges(bins: Sequence[tuple], num_partitions: int) -> list:
    """Where to cut ascending (first value, rows) bins for parts of like many rows: a part is closed as soon as it has its
    share, so none has more than that and one bin."""
    total, done, edges = sum(n for _, n in bins), 0, []
    for (_, rows), (following, _) in zip(bins, bins[1:]):
        done += rows
        if done * num_partitions >= total * (len(edges) + 1):
            edges.append(following)
    return edges[: num_partitions - 1]


def balanced_predicates(spark: SparkSession, source: JdbcSource, table: str, column: str, num_partitions: int) -> list[str]:
    """Ranges of like many rows, however the keys lie; [] for a table without keys.

    The database counts the rows, in bins of a number or by day of a time. Numbers are counted more finely where they
    crowd, so no range of unique keys has over one and a half times its share; a day is not cut.
    """
    lo, hi = source.bounds(spark, table, column)
    if lo is None:
        return []
    if not source.histogram_bins:
        return range_predicates(column, lo, hi, num_partitions)
    if isinstance(lo, date):
        return predicates_at(column, even_edges(source.days(spark, table, column), num_partitions))
    # A first, coarse count gives the table's rows, and with them how many a bin may have.
    lo, after = int(lo // 1), int(hi // 1) + 1
    coarse = source.bins(spark, table, column, lo, after, fine=1 << 62)
    fine = max(1, sum(n for *_, n in coarse) // (2 * num_partitions))
    bins = []
    for first, last, rows in coarse:
        bins += source.bins(spark, table, column, first, last, fine) if rows > fine and last - first > 1 else [(first, last, rows)]
    return predicates_at(column, even_edges([(first, rows) for first, _, rows in bins], num_partitions))


def window_predicates(audit: str, window: Slice, num_partitions: int, kind: T.DataType = T.TimestampType()) -> list[str]:
    """Half-open SQL ranges that together cover the slice, one per reader; one for a column of dates."""
    first, after = window.bounds(kind)
    if after is None:
        return [f"{audit} >= {_literal(first)}"]
    if isinstance(kind, T.DateType):
        return [f"{audit} >= {_literal(first)} AND {audit} < {_literal(after)}"]
    step = (after - first) / num_partitions
    text = [_literal(first + i * step) for i in range(num_partitions)] + [_literal(after)]
    return [f"{audit} >= {a} AND {audit} < {b}" for a, b in zip(text, text[1:])]


def read_snapshot(spark: SparkSession, source: Source, spec: TableSpec, num_partitions: int = 8) -> DataFrame:
    """All rows and columns of a source table. A JDBC table is read by parallel scans of ranges with like many rows."""
    table = source.scan(spark, spec.name)
    if isinstance(source, FileSource) or num_partitions <= 1:
        return table
    column = split_column(table.schema, spec)
    if column is None:
        return table
    predicates = balanced_predicates(spark, source, spec.name, column, num_partitions)
    return source.ranges(spark, spec.name, predicates) if predicates else table


def read_window(
    spark: SparkSession, source: Source, spec: TableSpec, window: Slice, num_partitions: int = 4
) -> DataFrame:
    """All columns of the rows whose audit time lies in the slice; the range runs in the source."""
    table = source.scan(spark, spec.name)
    keep = window.of(table, spec.audit)
    if isinstance(source, FileSource):
        return table.filter(keep)
    kind = next(f.dataType for f in table.schema.fields if f.name.lower() == spec.audit.lower())
    return source.ranges(spark, spec.name, window_predicates(spec.audit, window, num_partitions, kind))
