"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark: SparkSession, texts: list, ids: list | None = None, **extra) -> DataFrame:
    """Documents with the given texts, and constant extra columns."""
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "src", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in extra.items()}) if extra else df


def awkward(spark: SparkSession, **extra) -> DataFrame:
    """Nulls in every column, empty and very long texts, repeated rows, one id for two texts."""
    rows = [
        (0, "One two three, four five six seven. é\nOne two three.", "en", "a", 50),
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (3, " \t\n ", "en", "a", 4),
        (4, "long " * 30_000, "en", "a", 150_000),
        (5, "word", "de", "b", 4),
        (5, "another text of the same id", "de", "b", 27),
        (6, "twice the same row", "fr", "c", 18),
        (6, "twice the same row", "fr", "c", 18),
        (None, "a text without an id", "en", "a", 20),
        (7, "\x00\x01 \U0001f600 ſtrange ß İ Σ", None, "a", 18),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    return df.withColumns({k: F.lit(v) for k, v in extra.items()}) if extra else df


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def tuples(df: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
