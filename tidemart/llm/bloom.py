"""A Bloom filter of fixed size over 64-bit numbers, to drop most rows before an exact step."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.shingles import mix

#: Bits of a filter, whatever goes into it: 8 MB. A full one lets more through, never less.
BITS = 1 << 26
#: It is built in so many pieces, each by one task from numbers that no other has.
PIECES = 256
HASHES = 4


def _places(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each number its piece, and HASHES bits within it (one row per hash)."""
    mixed = mix(values.astype(np.int64).view(np.uint64))
    piece = (mixed >> np.uint64(56)).astype(np.int64)
    second = mix(mixed + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    steps = np.arange(HASHES, dtype=np.uint64)[:, None]
    return piece, ((mixed + steps * second) % np.uint64(BITS // PIECES)).astype(np.int64)


class BloomFilter:
    def __init__(self, pieces: dict[int, bytes]):
        empty = bytes(BITS // PIECES // 8)
        self.bits = np.frombuffer(b"".join(pieces.get(i, empty) for i in range(PIECES)), dtype=np.uint8)

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        piece, places = _places(values)
        places = places + piece * (BITS // PIECES)
        return ((self.bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=0)


def first_column(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).drop_null().to_numpy(zero_copy_only=False).astype(np.int64)


def bloom_filter(rows: DataFrame, number: Callable[[pa.RecordBatch], np.ndarray] = first_column) -> BloomFilter:
    """The filter of the numbers that ``number`` gives for the rows, by default their first column.

    Repeats and nulls do no harm. The driver gets at most BITS bits.
    """

    def piece_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.unique(number(batch))
            yield pa.RecordBatch.from_arrays([pa.array(_places(values)[0]), pa.array(values)], ["piece", "value"])

    def build(group: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(BITS // PIECES, dtype=bool)
        bits[_places(group["value"].to_numpy())[1].ravel()] = True
        return pd.DataFrame({"piece": group["piece"].iloc[:1], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    dealt = rows.mapInArrow(piece_of, "piece long, value long")
    built = dealt.groupBy("piece").applyInPandas(build, "piece long, bits binary")
    return BloomFilter({r.piece: bytes(r.bits) for r in built.select(F.col("piece"), F.col("bits")).collect()})
