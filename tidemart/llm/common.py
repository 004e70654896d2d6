"""What the operators share: written intermediates, vocabulary files, Arrow rows."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.functions import unused as unused_name
from tidemart.session import prepare, scratch
from tidemart.sources.storage import delete

#: Texts of one step in a Python task: enough to share work between words, little beside a task's memory.
STEP_BYTES = 1_000_000


#: Rows of an Arrow batch. Spark's default suits narrow rows; texts take memory on both sides of the pipe.
BATCH_ROWS = "1000"


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings for these operators; batch rows only where the user has not chosen any."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(rows) == "10000":
        spark.conf.set(rows, BATCH_ROWS)
    return prepare(spark)


#: Where ``written`` notes its tables while somebody collects them.
_COLLECTED: ContextVar[list[str] | None] = ContextVar("collected", default=None)


@contextmanager
def collected() -> Iterator[list[str]]:
    """The folders of the tables that ``written`` makes meanwhile."""
    paths: list[str] = []
    token = _COLLECTED.set(paths)
    try:
        yield paths
    finally:
        _COLLECTED.reset(token)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Deletes written tables that nothing will read again, and lets Spark drop the shuffle files behind them."""
    for path in paths:
        delete(spark, path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, cut off from their lineage by a table in the shared folder."""
    path = scratch(spark, purpose)
    if (paths := _COLLECTED.get()) is not None:
        paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The column of salts that ``salted`` adds.
SALT = "salt_"


def salted(df: DataFrame) -> DataFrame:
    """The rows with a random salt each, as many salts as a shuffle has partitions. Write them before they are read twice."""
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn(SALT, F.floor(F.rand() * salts).cast("int"))


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """The rows with a salt each by a hash of the columns, the same whenever it is computed."""
    salts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumn(SALT, F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int"))


def lookup(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``dealt``, or written ``salted``, rows with the columns of ``found``, which has each key once (null where it has none).
    A found row goes once to each salt that its key has, so rows of one key meet it in many tasks."""
    wanted = rows.select(key, SALT).distinct()
    return rows.join(wanted.join(found, key), [key, SALT], "left").drop(SALT)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The columns (doc_id, text) alone, whatever else the table has; a null text is empty."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    )


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until the table has no such column."""
    return unused_name(df.columns, name)


def vocabulary(path: str) -> bytes:
    """A vocabulary file as bytes, to be broadcast: its size is that of the file, whatever the corpus."""
    return Path(path).read_bytes()


#: What this Python process keeps from one task to the next: one object at a time.
_RESIDENT: dict = {}


def trim() -> None:
    """Gives freed memory back to the system, where the C library can. Workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def resident(key, make: Callable[[], object] = object):
    """The object that ``make`` gives, kept by the process until a task asks for another key."""
    if key not in _RESIDENT:
        _RESIDENT.clear()
        gc.collect()
        trim()
        _RESIDENT[key] = make()
    return _RESIDENT[key]


def steps(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about STEP_BYTES of text, at least one row each."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text)).to_pylist()
        start = held = 0
        for i, n in enumerate(lengths):
            if held and held + n > STEP_BYTES:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < len(lengths):
            yield batch.slice(start)
    trim()


def utf8(batch: pa.RecordBatch, text: str = "text") -> list[bytes]:
    """The texts as bytes, without decoding them."""
    return batch.column(text).cast(pa.binary()).to_pylist()
