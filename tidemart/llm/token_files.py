"""Token ids of a corpus as flat binary files that can be memory-mapped (operator 1).

A folder holds for each part ``part-N.ids`` (the ids of its documents in a row, unsigned, 16 bits wide where
the vocabulary fits and 32 bits elsewhere), ``part-N.offsets`` (documents + 1 ends, unsigned 64 bits, from the part's first id), ``part-N.docs``
(document ids, signed 64 bits) and one ``manifest.json`` with each part's bases: the documents and ids
in all parts before it, which are prefix sums of the parts' counts. All numbers are little-endian.
"""

from __future__ import annotations

import json
import mmap
import os
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import id_and_text, steps, utf8
from tidemart.llm.tokens import WordEncoder, word_encoder
from tidemart.session import scratch

#: Stands for a document without an id in ``part-N.docs``.
NO_ID = -(2**63)
#: Documents per batch when the files are read back.
READ_ROWS = 10_000


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


class _Output:
    """A file that gets its name when it is whole, so a lost or repeated task leaves no half file."""

    def __init__(self, folder: str, name: str):
        self.fs, base = _place(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.draft = f"{base}/{name}", f"{base}/.{name}.{uuid.uuid4().hex}"
        self.stream = self.fs.open_output_stream(self.draft)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        self.fs.move(self.draft, self.path)


def _mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    """A file's numbers: memory-mapped where the folder is mounted, else read."""
    place, base = _place(folder)
    path = f"{base}/{name}"
    if not isinstance(place, fs.LocalFileSystem):
        return np.frombuffer(place.open_input_stream(path).read(), dtype=dtype)
    if os.path.getsize(path) == 0:
        return np.empty(0, dtype=dtype)
    with open(path, "rb") as file:
        return np.frombuffer(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ), dtype=dtype)


@dataclass(frozen=True)
class Part:
    """One part and its bases: the documents and ids of all parts before it."""

    number: int
    docs: int
    tokens: int
    doc_base: int
    token_base: int


class TokenFiles:
    """A written folder. ``ids(i)`` is the i-th document's ids without reading any others."""

    def __init__(self, folder: str):
        self.folder = folder
        place, base = _place(folder)
        with place.open_input_stream(f"{base}/manifest.json") as stream:
            manifest = json.loads(stream.read())
        self.id_type, self.parts = manifest["id_type"], [Part(*row) for row in manifest["parts"]]

    def __len__(self) -> int:
        return sum(p.docs for p in self.parts)

    def ids(self, i: int) -> np.ndarray:
        at = int(np.searchsorted([p.doc_base + p.docs for p in self.parts], i, side="right"))
        part = self.parts[at]
        ends = _mapped(self.folder, f"part-{part.number:06d}.offsets", "<u8")
        start, end = (int(ends[i - part.doc_base + k]) for k in (0, 1))
        return _mapped(self.folder, f"part-{part.number:06d}.ids", self.id_type)[start:end]

    def read(self, spark: SparkSession) -> DataFrame:
        """One row per document from the files: doc_id, start, n_tokens, ids_crc32. A task reads one part."""
        folder, id_type, parts = self.folder, self.id_type, self.parts
        schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
        if not parts:
            return spark.createDataFrame([], schema)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in batch.column(0).to_pylist():
                    yield from _rows(folder, id_type, parts[at])

        return spark.range(0, len(parts), 1, len(parts)).mapInArrow(read, schema)


def _rows(folder: str, id_type: str, part: Part) -> Iterator[pa.RecordBatch]:
    ids, ends, docs = (
        _mapped(folder, f"part-{part.number:06d}.{kind}", dtype)
        for kind, dtype in (("ids", id_type), ("offsets", "<u8"), ("docs", "<i8"))
    )
    for first in range(0, part.docs, READ_ROWS):
        last = min(first + READ_ROWS, part.docs)
        bounds = ends[first : last + 1].astype(np.int64)
        crcs = [zlib.crc32(ids[s:e].astype("<u4")) for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
        doc_ids = np.array(docs[first:last])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(doc_ids, mask=doc_ids == NO_ID),
                pa.array(bounds[:-1] + part.token_base),
                pa.array(np.diff(bounds)),
                pa.array(crcs, pa.int64()),
            ],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def write_token_files(
    df: DataFrame, vocab: bytes, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1
) -> TokenFiles:
    """Encodes every document and writes the files of this module in ascending id order.

    Documents are dealt out by ranges of (id, text hash), so parts are in order, and equal ids can still
    be spread unless their texts are equal too. Each task encodes and writes its part as it reads it.
    A null text has the end id alone; documents without an id come first; rows with equal ids are kept,
    in the order of their text hashes; an empty table writes no part. ``folder`` must be one that all
    executors see; by default a new one under ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    folder = folder or scratch(spark, "token-files")
    spec = spark.sparkContext.broadcast(vocab)
    id_type = "<u2" if max(end_id + 1, WordEncoder(vocab).size) <= 65536 else "<u4"
    docs = id_and_text(df, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    ordered = docs.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").drop("tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(spec.value)
        end = np.array([end_id], dtype=id_type).tobytes()
        number, files, n_docs, n_tokens = TaskContext.get().partitionId(), {}, 0, 0
        for batch in steps(batches):
            if not files:
                files = {k: _Output(folder, f"part-{number:06d}.{k}") for k in ("ids", "offsets", "docs")}
                files["offsets"].write(np.zeros(1, dtype="<u8").tobytes())
            found = encoder.encode(utf8(batch))
            sizes = np.array([len(x) // 4 + 1 for x in found], dtype=np.int64)
            files["ids"].write(b"".join(np.frombuffer(x, dtype="<u4").astype(id_type).tobytes() + end for x in found))
            files["offsets"].write((np.cumsum(sizes) + n_tokens).astype("<u8").tobytes())
            files["docs"].write(batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
            n_docs, n_tokens = n_docs + len(sizes), n_tokens + int(sizes.sum())
        if files:
            for file in files.values():
                file.close()
            yield pa.RecordBatch.from_pydict({"part": [number], "docs": [n_docs], "tokens": [n_tokens]})

    counts = ordered.mapInArrow(write, "part long, docs long, tokens long").collect()  # a row per part
    counts = sorted((r.part, r.docs, r.tokens) for r in counts)
    doc_bases, token_bases = ([0, *accumulate(c[k] for c in counts)] for k in (1, 2))
    parts = [Part(*c, d, t) for c, d, t in zip(counts, doc_bases, token_bases, strict=False)]
    manifest = _Output(folder, "manifest.json")
    rows = [[p.number, p.docs, p.tokens, p.doc_base, p.token_base] for p in parts]
    manifest.write(json.dumps({"id_type": id_type, "offset_type": "<u8", "end_id": end_id, "parts": rows}).encode())
    manifest.close()
    return TokenFiles(folder)
