"""Landing folders: CSV parts with a header, and the schema they must be read with beside them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.functions import unused
from tidemart.sources import storage

# Fixed value: a part has at most so many bytes, or one row.
PART_BYTES = 19_000_000
# No number, date, time or truth value is longer as text, its separator included.
PLAIN_BYTES = 48

# Spark's CSV defaults cut microseconds, trim blanks and rewrite line ends; these keep values whole.
CSV_OPTIONS = {
    "header": "true",
    "nullValue": "\\N",
    "escape": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "dateFormat": "yyyy-MM-dd",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Quoted line breaks make a part unsplittable, so writers keep parts small.
# They lie in the folder of a slice or in folders below it.
CSV_READ_OPTIONS = {**CSV_OPTIONS, "multiLine": "true", "mode": "FAILFAST", "enforceSchema": "true", "recursiveFileLookup": "true"}
# The folder of a part: its size class, and its number in the task that wrote it.
PART = "part"


def _marked(column: Column, pattern: str, replacement: str) -> Column:
    """Only texts with a leading backslash can look like the NULL mark; the rest skip the pattern."""
    changed = F.regexp_replace(column, pattern, replacement)
    return F.when(column.startswith("\\"), changed).otherwise(column)


def _to_text(column: Column, kind: T.DataType) -> Column:
    """Bytes as base64; a text that looks like the NULL mark gets one more backslash."""
    if isinstance(kind, T.BinaryType):
        return F.base64(column)
    return _marked(column, r"^(\\+N)$", r"\\$1") if isinstance(kind, T.StringType) else column


def _from_text(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.unbase64(column)
    return _marked(column, r"^\\(\\+N)$", "$1") if isinstance(kind, T.StringType) else column


def file_schema(schema: T.StructType) -> T.StructType:
    """The schema the parts are parsed with: bytes are text there."""
    kinds = [(f.name, T.StringType() if isinstance(f.dataType, T.BinaryType) else f.dataType) for f in schema.fields]
    return T.StructType([T.StructField(name, kind) for name, kind in kinds])


def restore(parsed: DataFrame, schema: T.StructType, *more: Column) -> DataFrame:
    """Rows as they were written, from rows parsed with ``file_schema``; and further columns."""
    return parsed.select(*[_from_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema.fields], *more)


def _row_bytes(schema: T.StructType) -> Column:
    """No less than the bytes a row takes in a part: texts in quotes, with quotes in them doubled."""
    size = F.lit(1)
    for field in schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            quotes = F.length(column) - F.length(F.replace(column, F.lit('"'), F.lit("")))
            size = size + F.coalesce(F.octet_length(column) + quotes, F.lit(0)) + 4
        else:
            size = size + PLAIN_BYTES
    return size


def write_landing(
    df: DataFrame, path: str, max_records_per_file: int = 250_000, max_bytes_per_file: int = PART_BYTES
) -> None:
    """Write ``path/data/part=.../*.csv`` and then ``path/schema.json``; a re-run replaces the slice.

    One job, without a shuffle or a copy. Each task sorts its rows by size class (below 64, 256, 1024, ...
    bytes) and numbers them. A class has a fixed number of rows that are sure to fit a part, so a row's number divided by
    it is the part it goes to: no part holds more rows of its class than fit. Parts of like rows are at least a quarter
    full but for a task's first and last of each class, and only a row larger than the bound makes a larger part.

    The schema is the proof that all parts are there: it goes first and comes last, and a folder
    without it is not read.
    """
    nested = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    if nested:
        raise ValueError(f"landing files are flat; nested columns: {', '.join(nested)}")
    if PART.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"column name reserved for folders: {PART}")
    spark = df.sparkSession
    text = df.select(*[_to_text(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])
    storage.delete(spark, f"{path}/schema.json")
    size = unused(df.columns, "size")
    sized = text.withColumn(size, F.greatest(F.lit(3), F.ceil(F.log(4.0, _row_bytes(text.schema)))).cast("int"))
    number = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the row's place in its task
    fitting = F.greatest(F.lit(1), F.least(F.lit(max_records_per_file), F.floor(F.lit(max_bytes_per_file) / F.pow(F.lit(4), F.col(size)))))
    part = F.concat_ws("-", F.col(size), F.floor(number / fitting))
    cut = sized.sortWithinPartitions(size).withColumn(PART, part).drop(size)
    cut.write.mode("overwrite").options(**CSV_OPTIONS).partitionBy(PART).csv(f"{path}/data")
    storage.write_schema(spark, f"{path}/schema.json", df.schema)


def landed_schema(spark: SparkSession, path: str) -> T.StructType:
    """The recorded schema of a finished landing folder; an error for any other."""
    if not storage.exists(spark, f"{path}/schema.json"):
        raise ValueError(f"landing folder without a schema, so not finished: {path}")
    return storage.read_schema(spark, f"{path}/schema.json")


def _shape(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f["name"], f["type"]) for f in schema.jsonValue()["fields"]]


def slice_states(spark: SparkSession, parents: Sequence[str], schema: T.StructType) -> DataFrame:
    """The finished landing folders below ``parents``, a row each: ``folder``, and ``fits``, whether its recorded schema has
    the columns of ``schema``. Folders are listed and schemas read by tasks, however many there are."""
    found = spark.read.options(wholetext="true", recursiveFileLookup="true", pathGlobFilter="schema.json").text(list(parents))
    recorded = F.from_json("value", "struct<fields:array<struct<name:string,type:string>>>")["fields"]
    columns = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type")) for name, kind in _shape(schema)])
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/schema.json$", 1)
    return found.select(folder.alias("folder"), F.coalesce(recorded == columns, F.lit(False)).alias("fits"))


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """All parts of one landing slice under its recorded schema; one bad record fails the read."""
    schema = landed_schema(spark, path)
    parsed = spark.read.schema(file_schema(schema)).options(**CSV_READ_OPTIONS).csv(f"{path}/data")
    return restore(parsed, schema)
