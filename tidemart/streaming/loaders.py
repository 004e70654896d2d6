"""Micro-batch forms of the load and the merge. Each run takes what is new and stops."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemart.operators import latest_per_key
from tidemart.registry import TableSpec
from tidemart.sources import appendlog, landing, snapshots, storage

# Spark leaves out files much older than the newest one seen, seven days by default. Backfills and
# restored files are older than that, so the bound lies beyond any archive.
READ_OPTIONS = {"maxFileAge": "36500d"}
# Fixed value: the columns of files read as such.
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def landing_stream(
    spark: SparkSession,
    landing_glob: str,
    schema: StructType,
    delta: str,
    audit: str,
    checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """Load new landing files (``.../<table>/*/*/data``) into the append log.

    New files say which landing slices have changed; each of those is read whole and replaces its
    slice in the log, ``landing-<table>-<day>-<time>``. So a slice that is landed again, or a batch
    that is retried, changes nothing. A batch that meets an unfinished slice fails and is
    taken again by the next run.

    New files are only named, not parsed, until their slices are known. Whether these are finished and have the
    stream's schema is a join with the table of slice states, which tasks read; the driver holds names.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).options(**READ_OPTIONS)
    reader = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
    reader = reader.option("ignoreMissingFiles", "true")  # parts of a slice that was landed again since
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        changed = batch.select("folder").distinct()
        folders = sorted(r.folder for r in changed.collect())
        if not folders:
            return
        states = landing.slice_states(session, sorted({unquote(f).rpartition("/")[0] for f in folders}), schema)
        asked = session.createDataFrame([(f,) for f in folders], "folder string")
        wrong = asked.join(states, "folder", "left").filter("not coalesce(fits, false)").first()
        if wrong:
            why = "schema of the landing slice differs from the stream's" if wrong.fits is False else "landing folder without a schema, so not finished"
            raise ValueError(f"{why}: {unquote(wrong.folder)}")
        folders = [unquote(f) for f in folders]
        names = ["landing-" + "-".join(folder.split("/")[-3:]) for folder in folders]
        parsed = session.read.schema(landing.file_schema(schema)).options(**landing.CSV_READ_OPTIONS)
        parsed = parsed.csv([f"{folder}/data" for folder in folders]).select("*", _folder("_metadata.file_path").alias(appendlog.SLICE))
        place = F.concat(F.lit("landing-"), F.array_join(F.slice(F.split(appendlog.SLICE, "/"), -3, 3), "-"))
        rows = landing.restore(parsed, schema, place.alias(appendlog.SLICE))
        appendlog.store_slices(rows, delta, names, audit)

    return (
        reader.load(landing_glob)
        .select(_folder("_metadata.file_path").alias("folder"))
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _folder(path: str) -> Column:
    """The landing folder of a part."""
    return F.regexp_extract(path, r"^(.*)/data/(?:[^/]*/)?[^/]*$", 1)


def stream_upsert(
    spark: SparkSession,
    delta: str,
    main: str,
    spec: TableSpec,
    checkpoint: str,
    buckets: int | None = None,
    max_files: int | None = None,
    keep_versions: int = 2,
    catalog_table: str | None = None,
) -> StreamingQuery:
    """Merge new rows of the append log into the main table.

    A retried batch merges rows that are already there, which the merge guard makes harmless.
    Every batch writes one version of the table, so let one batch take all that is new
    (the default) unless the backlog must be split. With ``catalog_table`` the changes go to that
    table by native MERGE instead.
    """
    schema = appendlog.recorded_schema(spark, delta)
    reader = spark.readStream.schema(appendlog.log_schema(schema)).options(**READ_OPTIONS)
    reader = reader.option("ignoreMissingFiles", "true")  # parts of a slice that was replaced since
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def merge(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        changes = latest_per_key(batch.select(*[F.col(f"`{c}`") for c in schema.names]), spec.keys, spec.audit)
        if catalog_table:
            snapshots.merge_into_table(session, catalog_table, changes, spec.keys, spec.audit)
            return
        first = None if snapshots.current_version(session, main) else storage.size(session, delta)
        snapshots.merge_snapshot(session, main, changes, spec.keys, spec.audit, buckets, first)
        snapshots.expire_snapshots(session, main, keep_versions)

    return (
        reader.parquet(delta)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
