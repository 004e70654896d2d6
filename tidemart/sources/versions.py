"""Numbered manifests of a stored table. The newest one says what the table is; one rename puts it in place.

Files that no manifest names are not part of the table, so a writer that fails, or is still at work, changes
nothing for readers, and a reader that started on an older manifest finds its files until they expire.
One writer at a time is assumed; a second one that takes the same number is refused.
"""

from __future__ import annotations

import re

from pyspark.sql import SparkSession

from tidemart.sources import storage

FOLDER = "_versions"
_NAME = re.compile(r"(\d+)\.json$")


def numbers(spark: SparkSession, path: str) -> list[int]:
    """The versions that are there, oldest first."""
    names = storage.child_names(spark, f"{path}/{FOLDER}")
    return sorted(int(m[1]) for m in map(_NAME.match, names) if m)


def _file(path: str, number: int) -> str:
    return f"{path}/{FOLDER}/{number:06d}.json"


def load(spark: SparkSession, path: str, number: int) -> dict:
    return storage.read_json(spark, _file(path, number))


def newest(spark: SparkSession, path: str) -> tuple[int, dict] | None:
    found = numbers(spark, path)
    return (found[-1], load(spark, path, found[-1])) if found else None


def commit(spark: SparkSession, path: str, number: int, manifest: dict) -> int:
    storage.put_json(spark, _file(path, number), manifest)
    return number


def append(spark: SparkSession, path: str, entry: dict) -> int:
    """A manifest under the next free number, for journals that several writers add to."""
    while True:
        number = max(numbers(spark, path), default=0) + 1
        try:
            return commit(spark, path, number, entry)
        except FileExistsError:
            continue


def drop(spark: SparkSession, path: str, number: int) -> None:
    storage.delete(spark, _file(path, number))
