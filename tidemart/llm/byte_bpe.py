"""Byte-level BPE encoding and decoding on Spark (operator 6).

A text is split by a pattern. A pre-token that is a vocabulary entry itself is found by a minimal perfect
hash over the vocabulary; any other is merged, lowest rank first, by a heap over linked bytes.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from tidemart.llm.common import id_and_text, resident, steps

#: Pre-tokens kept by one Python process.
MEMORY = 250_000


def read_ranks(spec: bytes) -> list[bytes]:
    """The entries of a rank file, in order of rank; ranks must run from 0 without gaps."""
    pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, spec.splitlines()))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("the ranks of a vocabulary must run from 0 without gaps")
    return [token for _, token in pairs]


class PerfectHash:
    """A minimal perfect hash: n keys to n slots without a free one, by hash and displace.

    Keys are dealt to buckets by one half of a 128-bit hash. The largest bucket first, each gets the first
    displacement that moves all its keys to free slots; buckets of one key take the slots left over.
    ``find`` gives a key's place in the list it was built from, -1 for any other.
    """

    def __init__(self, keys: list[bytes]):
        self.n = max(1, len(keys))
        self.shift = [0] * self.n
        self.keys: list[bytes | None] = [None] * self.n
        self.places = [-1] * self.n
        buckets: dict[int, list[int]] = {}
        hashes = [self._halves(key) for key in keys]
        for place, (low, _) in enumerate(hashes):
            buckets.setdefault(low % self.n, []).append(place)
        alone = []
        for bucket, members in sorted(buckets.items(), key=lambda b: (-len(b[1]), b[0])):
            if len(members) == 1:
                alone.append((bucket, members[0]))
                continue
            shift = 0
            while True:
                slots = {self._slot(hashes[m][1], shift) for m in members}
                if len(slots) == len(members) and all(self.places[s] < 0 for s in slots):
                    break
                shift += 1
            self.shift[bucket] = shift
            for m in members:
                self._put(self._slot(hashes[m][1], shift), keys[m], m)
        free = (s for s in range(self.n) if self.places[s] < 0)
        for (bucket, member), slot in zip(alone, free, strict=False):
            self.shift[bucket] = -slot - 1
            self._put(slot, keys[member], member)

    @staticmethod
    def _halves(key: bytes) -> tuple[int, int]:
        value = xxhash.xxh3_128_intdigest(key)
        return value & 0xFFFFFFFFFFFFFFFF, value >> 64

    def _slot(self, high: int, shift: int) -> int:
        return (high + shift * ((high >> 32) | 1)) % self.n

    def _put(self, slot: int, key: bytes, place: int) -> None:
        self.keys[slot], self.places[slot] = key, place

    def find(self, key: bytes) -> int:
        value = xxhash.xxh3_128_intdigest(key)
        shift = self.shift[(value & 0xFFFFFFFFFFFFFFFF) % self.n]
        slot = -shift - 1 if shift < 0 else self._slot(value >> 64, shift)
        return self.places[slot] if self.keys[slot] == key else -1


class ByteBpe:
    """Encodes pre-tokens and decodes ids for one vocabulary and pattern."""

    def __init__(self, spec: bytes, pattern: str):
        self.tokens = read_ranks(spec)
        self.ranks = {token: rank for rank, token in enumerate(self.tokens)}
        self.whole = PerfectHash(self.tokens)
        self.split = regex.compile(pattern).findall
        sizes = np.array([len(t) for t in self.tokens], dtype=np.int64)
        self.sizes, self.starts = sizes, np.cumsum(sizes) - sizes
        self.flat = np.frombuffer(b"".join(self.tokens), dtype=np.uint8)
        self.known: dict[str, bytes] = {}

    def merge(self, word: bytes) -> list[int]:
        """Ids of a pre-token: always the pair of lowest rank is merged, the leftmost of equal ones."""
        n = len(word)
        rank_of = self.ranks.get
        end = list(range(1, n + 1))  # end[i]: where the piece starting at i ends, 0 once it is part of another
        before = list(range(-1, n))  # before[i]: the start of the piece left of i
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := rank_of(word[i : i + 2])) is not None]
        heapify(heap)
        while heap:
            _, i, j = heappop(heap)
            middle = end[i]
            if not middle or middle >= j or end[middle] != j:  # one of its pieces has changed since
                continue
            end[i], end[middle] = j, 0
            if j < n:
                before[j] = i
                if (rank := rank_of(word[i : end[j]])) is not None:
                    heappush(heap, (rank, i, end[j]))
            if (left := before[i]) >= 0 and (rank := rank_of(word[left:j])) is not None:
                heappush(heap, (rank, left, j))
        ids, i = [], 0
        while i < n:
            ids.append(self.ranks[word[i : end[i]]])
            i = end[i]
        return ids

    def encode_pretoken(self, word: bytes) -> list[int]:
        found = self.whole.find(word)
        return [found] if found >= 0 else self.merge(word)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers."""
        split = [self.split(text) for text in texts]
        new = set().union(*split).difference(self.known)
        if len(self.known) + len(new) > MEMORY:
            self.known = {}
            new = set().union(*split)
        for word in new:
            self.known[word] = np.array(self.encode_pretoken(word.encode("utf-8")), dtype="<u4").tobytes()
        known = self.known.__getitem__
        return [b"".join(map(known, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        which = np.frombuffer(ids, dtype="<u4")
        sizes = self.sizes[which]
        shifts = self.starts[which] - (np.cumsum(sizes) - sizes)
        return self.flat[np.repeat(shifts, sizes) + np.arange(int(sizes.sum()))].tobytes()


def byte_bpe(spec: bytes, pattern: str) -> ByteBpe:
    """The coder of this process."""
    return resident(("bytes", spec, pattern), lambda: ByteBpe(spec, pattern))


def encode_bytes(df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids binary) for every row; ids are little-endian unsigned 32-bit integers.

    No row meets another, so nothing is shuffled. Null and empty texts have no ids; rows with equal ids
    and texts are all kept; a null id stays null.
    """
    spec = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(spec.value, pattern)
        for batch in steps(batches):
            ids = coder.encode(batch.column("text").to_pylist())
            counts = pa.array([len(x) // 4 for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), counts, pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])

    return id_and_text(df, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids binary")


def decode_bytes(df: DataFrame, ranks: bytes, pattern: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the bytes that each row's ``ids`` stand for. Null ids: no bytes."""
    spec = df.sparkSession.sparkContext.broadcast(ranks)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(spec.value, pattern)
        for batch in batches:
            decoded = [coder.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(decoded, pa.binary())], [*keep, "decoded"])

    return df.select(*keep, *([] if "ids" in keep else ["ids"])).mapInArrow(run, f"{schema}, decoded binary")


def round_trip_digests(
    df: DataFrame, ranks: bytes, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): what encoding and then decoding gives, by its hashes.

    Both directions in one pass over each batch, so that no ids leave the task. Rows as in encode_bytes.
    """
    spec = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = byte_bpe(spec.value, pattern)
        for batch in steps(batches):
            ids = coder.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(coder.decode(x)).hexdigest() for x in ids], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return id_and_text(df, id_col, text_col).mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
