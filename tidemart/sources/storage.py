"""Small file-system calls through the Hadoop client Spark already uses (any scheme it can reach)."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    """Only a missing path is False; access or network errors propagate."""
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def files_below(spark: SparkSession, path: str) -> dict[str, set[str]]:
    """Names of the files in each folder at or below a path, marks and hidden files left out."""
    fs, hadoop_path = _open(spark, path)
    found: dict[str, set[str]] = {}
    if fs.exists(hadoop_path):
        listing = fs.listFiles(hadoop_path, True)
        while listing.hasNext():
            file = listing.next().getPath()
            if not file.getName().startswith(("_", ".")):
                found.setdefault(file.getParent().toString(), set()).add(file.getName())
    return found


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    fs, hadoop_path = _open(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def same_shape(one: StructType, other: StructType) -> bool:
    """Same columns, types and order."""
    shapes = [[(f.name, f.dataType.simpleString()) for f in schema.fields] for schema in (one, other)]
    return shapes[0] == shapes[1]


def read_json(spark: SparkSession, path: str) -> dict:
    fs, hadoop_path = _open(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def put_json(spark: SparkSession, path: str, content: dict) -> None:
    """A new file that is whole as soon as it is seen; an error if it is there already."""
    fs, hadoop_path = _open(spark, path)
    folder, _, name = path.rpartition("/")
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}-{uuid.uuid4().hex[:12]}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(content), "utf-8"))
    finally:
        stream.close()
    if fs.exists(hadoop_path) or not fs.rename(draft, hadoop_path):
        fs.delete(draft, False)
        raise FileExistsError(f"another writer has put {path}")


def write_schema(spark: SparkSession, path: str, schema: StructType) -> None:
    fs, hadoop_path = _open(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(schema.json(), "utf-8"))
    finally:
        stream.close()


def read_schema(spark: SparkSession, path: str) -> StructType:
    return StructType.fromJson(read_json(spark, path))
