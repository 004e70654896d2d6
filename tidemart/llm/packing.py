"""Packing documents into sequences of fixed capacity (operator 4).

Documents are cut into pieces no longer than a sequence. The histogram of piece lengths, which has at most
``capacity`` bars whatever the corpus, decides everything: patterns of a few lengths that fill a sequence are
enumerated, a non-negative least-squares fit says how often to repeat each, the counts are rounded down, and
what is left over is packed best-fit, longest first, into open sequences. The plan is then read by rank: the
k-th piece of a length has one place in one sequence.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.common import id_and_text, steps, utf8, written
from tidemart.llm.tokens import word_encoder

CAPACITY = 4096
#: Lengths whose pairs are completed to patterns of three; the most frequent ones.
TRIPLE_LENGTHS = 192
#: A pattern may leave so many tokens of a sequence free.
PATTERN_WASTE = 4
#: Rounds of coordinate descent over all patterns.
SWEEPS = 12

Run = tuple[int, int]  # a length and how many pieces of it a sequence holds


def cut_documents(
    df: DataFrame, vocab: bytes, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", end_id: int = 1
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    A document is its ids and ``end_id``; only one longer than ``capacity`` is cut, into whole pieces of it
    and a last one that may be shorter. A null or empty text is one piece, the end id. Rows with equal ids
    are cut apart; a null id stays null.
    """
    spec = df.sparkSession.sparkContext.broadcast(vocab)
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(spec.value)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in steps(batches):
            rows = []
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(utf8(batch)), strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            columns = zip(*rows, strict=True)
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return id_and_text(df, id_col, text_col).mapInArrow(run, schema)


# The plan: histograms in, patterns and their repeat counts out.


def _largest(lengths: np.ndarray, most: np.ndarray) -> np.ndarray:
    """The largest of the sorted ``lengths`` that is at most each of ``most``, 0 where there is none."""
    at = np.searchsorted(lengths, most, side="right") - 1
    return np.where(at >= 0, lengths[np.maximum(at, 0)], 0)


def enumerate_patterns(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Rows of up to three lengths (0: none) that fill a sequence but for PATTERN_WASTE tokens."""
    lengths = np.array(sorted(counts), dtype=np.int64)
    pairs = np.stack([lengths, _largest(lengths, capacity - lengths), np.zeros_like(lengths)], axis=1)
    frequent = np.array(sorted(counts, key=lambda n: (-counts[n], n))[:TRIPLE_LENGTHS], dtype=np.int64)
    first, second = (frequent[i] for i in np.triu_indices(len(frequent)))
    triples = np.stack([first, second, _largest(lengths, capacity - first - second)], axis=1)
    found = np.concatenate([pairs, triples])
    free = capacity - found.sum(axis=1)
    return np.unique(np.sort(found[(free >= 0) & (free <= PATTERN_WASTE)], axis=1), axis=0)


def fit_counts(patterns: np.ndarray, counts: dict[int, int], capacity: int) -> np.ndarray:
    """Non-negative repeat counts x that bring the pieces used, A x, nearest to the histogram.

    Minimises sum over lengths n of n * ((A x)[n] - counts[n])^2, so that long pieces, which are hardest
    to place afterwards, are fitted best. Cyclic coordinate descent, each step cut off at zero.
    """
    weight = np.arange(capacity + 1, dtype=np.float64)
    left = np.zeros(capacity + 1)
    for length, n in counts.items():
        left[length] = n
    weight, left = weight.tolist(), left.tolist()
    columns = []
    for row in patterns.tolist():
        used: dict[int, int] = {}
        for length in row:
            if length:
                used[length] = used.get(length, 0) + 1
        columns.append((list(used.items()), sum(weight[n] * k * k for n, k in used.items())))
    x = [0.0] * len(columns)
    for _ in range(SWEEPS):
        for i, (used, norm) in enumerate(columns):
            step = max(sum(weight[n] * k * left[n] for n, k in used) / norm, -x[i])
            if step:
                x[i] += step
                for n, k in used:
                    left[n] -= step * k
    return np.array(x)


def pack_residuals(groups: list[tuple[list[Run], int]], counts: dict[int, int], capacity: int) -> list[tuple[list[Run], int]]:
    """Places what is left, longest first, each piece in the fullest open sequence that can take it.

    Sequences with equal contents are one group, so the work follows the number of lengths and groups.
    """
    done: list[tuple[list[Run], int]] = []
    open_: dict[int, list[tuple[list[Run], int]]] = {}
    rooms: list[int] = []  # sorted keys of open_

    def put(runs: list[Run], copies: int, room: int) -> None:
        if not room:
            done.append((runs, copies))
            return
        if room not in open_:
            open_[room] = []
            rooms.insert(bisect_left(rooms, room), room)
        open_[room].append((runs, copies))

    for runs, copies in groups:
        put(runs, copies, capacity - sum(n * k for n, k in runs))
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                fit = capacity // length
                if left >= fit:
                    put([(length, fit)], left // fit, capacity - fit * length)
                if left % fit:
                    put([(length, left % fit)], 1, capacity - left % fit * length)
                break
            room = rooms[at]
            runs, copies = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(at)
            fit = min(room // length, left)
            taken = min(copies, left // fit)
            if copies > taken:
                put(runs, copies - taken, room)
            put([*runs, (length, fit)], taken, room - fit * length)
            left -= taken * fit
    return done + [group for room in rooms for group in open_[room]]


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[Run], int]]:
    """The contents of sequences and how many have each; every piece of the histogram is in one."""
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError("a piece must have from 1 token to as many as a sequence")
    left = {n: k for n, k in counts.items() if k}
    groups = []
    if left:
        patterns = enumerate_patterns(left, capacity)
        wanted = np.floor(fit_counts(patterns, left, capacity)).astype(np.int64)
        for i in np.argsort(-wanted, kind="stable"):
            lengths = [n for n in patterns[i].tolist() if n]
            runs = [(n, lengths.count(n)) for n in sorted(set(lengths), reverse=True)]
            copies = min(int(wanted[i]), *(left.get(n, 0) // k for n, k in runs)) if runs else 0
            if copies > 0:
                groups.append((runs, copies))
                for n, k in runs:
                    left[n] -= copies * k
    return pack_residuals(groups, {n: k for n, k in left.items() if k}, capacity)


@dataclass
class Places:
    """The plan by rank. Ranks of all lengths are in one row: those of length n from ``first[n]`` on."""

    first: np.ndarray
    begin: np.ndarray  # of each stretch of ranks, ascending
    per: np.ndarray  # pieces of the length in one sequence
    length: np.ndarray
    sequence: np.ndarray  # the first sequence of the stretch
    offset: np.ndarray

    @classmethod
    def of(cls, groups: list[tuple[list[Run], int]], counts: dict[int, int], capacity: int) -> Places:
        first = np.zeros(capacity + 2, dtype=np.int64)
        for length, n in counts.items():
            first[length + 1] = n
        first = np.cumsum(first)
        rows, sequence = [], 0
        following = first.copy()
        for runs, copies in groups:
            offset = 0
            for length, per in runs:
                rows.append((following[length], per, length, sequence, offset))
                following[length] += per * copies
                offset += per * length
            sequence += copies
        rows.sort()
        columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
        return cls(first, *columns)

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence_id, offset) of the pieces with these ranks within their lengths."""
        row = self.first[length] + rank
        at = np.searchsorted(self.begin, row, side="right") - 1
        copy, slot = np.divmod(row - self.begin[at], self.per[at])
        return self.sequence[at] + copy, self.offset[at] + slot * self.length[at]


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    Sequences are filled from 0 without gaps and hold at most ``capacity`` tokens; a piece is in one
    sequence whole. Sequence ids run from 0 without gaps. Equal rows are packed apart; an empty table
    gives no rows. Pieces are numbered within their length: a length is dealt over many buckets, however
    many pieces it has, and a bucket's numbers start after the buckets before it. Only the histogram, at
    most ``capacity`` rows, reaches the driver, and the plan made from it goes to the tasks.
    """
    spark = pieces.sparkSession
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets))
    pieces = written(spark, pieces.select(*columns).withColumn("bucket", bucket), "pieces")
    sizes = pieces.groupBy("length", "bucket").count()
    counts = {r.length: r.pieces for r in sizes.groupBy("length").agg(F.sum("count").alias("pieces")).collect()}
    places = spark.sparkContext.broadcast(Places.of(plan_sequences(counts, capacity), counts, capacity))

    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = pieces.withColumn("place", F.row_number().over(own)).join(bases, ["length", "bucket"])
    ranked = numbered.select(*columns, (F.col("base") + F.col("place") - 1).alias("rank"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            found = [pa.array(x, pa.int64()) for x in places.value.find(length, rank)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), *found], [*columns, "sequence_id", "offset"])

    return ranked.mapInArrow(find, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
