"""Removing passages that occur again anywhere in the corpus, to the byte (operator 5).

A passage repeats where a string of ``length`` bytes starts at two places. Each such window has an anchor: the
64 bytes in it with the least hash. Equal windows have equal anchors, so windows are brought together by their
anchor's hash, and neighbouring windows with one anchor travel as one segment. Segments whose anchor occurs
once are dropped before any text moves. Equal segments are counted; segments that differ but share an anchor
meet in one task, whose suffix order gives the longest previous factor of each position.

An anchor shared by very many different segments is split: each segment falls into narrower ones that are told
apart by all bytes that their windows have in common, down to single windows, which need no comparing.

Passages may also be measured in words: a text is then a row of 64-bit symbols, one for each two neighbouring
words, and windows, anchors and places are counted in symbols where this says bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.bloom import bloom_filter
from tidemart.llm.common import id_and_text, resident, steps, trim, unused, utf8, written
from tidemart.llm.shingles import mix
from tidemart.llm.suffix_order import repeats

GRAM = 64
#: Symbols of an anchor where passages are measured in words.
WORD_GRAM = 8
#: Text whose windows are looked at together, at most; longer documents are cut into overlapping stretches.
STRETCH = 1_000_000
#: Different segments of one anchor that one task compares; an anchor with more is split.
MANY = 1500
#: Bytes of segments that one suffix order is built over, about.
CHUNK = 1_000_000
#: Windows per segment, step by step, where an anchor is split.
NARROWER = (32, 8, 1)
#: Stands for a document without an id.
NO_ID = -(2**63)

_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_TWIST = mix(np.arange(1000, 1064, dtype=np.uint64)) | np.uint64(1)
_PLACE = np.uint64((1 << 24) - 1)


#: Words, and the marks at their ends, which are no part of a passage that begins or ends there.
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MARKS = bytes(c for c in range(0x21, 0x7F) if not chr(c).isalnum())
#: Different words that a task remembers the hashes of.
_KNOWN_WORDS = 100_000


def _word_hashes(word: bytes) -> tuple[int, int]:
    """Of the word without the marks before it, and without those after it."""
    return tuple(xxhash.xxh3_64_intdigest(x or word) for x in (word.lstrip(_MARKS), word.rstrip(_MARKS)))


def word_pairs(texts: list[bytes]) -> list[bytes]:
    """Each text as symbols of 8 bytes, one for each two neighbouring words. Equal runs of n symbols are equal
    runs of n + 1 words, but for the marks before the first and after the last, and for the white space."""
    known: dict[bytes, tuple[int, int]] = {}
    out = []
    for text in texts:
        words = text.split()
        if len(known) > _KNOWN_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = _word_hashes(word)
        hashes = np.array([known[w] for w in words], dtype=np.uint64).reshape(-1, 2)
        out.append(mix(hashes[:-1, 0] * _TWIST[0] + hashes[1:, 1]).tobytes())
    return out


@dataclass(frozen=True)
class Measure:
    """What a window is: ``length`` symbols of ``width`` bytes, ``gram`` of them in an anchor, and how texts become symbols."""

    length: int
    width: int = 1
    gram: int = GRAM
    symbols: Callable[[list[bytes]], list[bytes]] = list


def in_words(words: int) -> Measure:
    """Windows of so many words."""
    return Measure(words - 1, 8, WORD_GRAM, word_pairs)


def _grams(data: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """A hash of the ``gram`` symbols from each position."""
    hashes, width = _BYTE[data] if data.dtype == np.uint8 else data, 1
    while width < gram:
        hashes = hashes[:-width] * _TWIST[width] + hashes[width:]
        width *= 2
    return mix(hashes)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours."""
    step = 1
    while 2 * step <= width:
        values = np.minimum(values[:-step], values[step:])
        step *= 2
    return np.minimum(values[: len(values) - (width - step)], values[width - step :])


class Segments:
    """Runs of neighbouring windows with one anchor, over many texts: owner is the text's place in the list,
    low and high the first and last start in it, anchor where the anchor is, key its hash."""

    def __init__(self, texts: list[bytes], measure: Measure | int):
        measure = Measure(measure) if isinstance(measure, int) else measure
        texts, length, width = measure.symbols(texts), measure.length, measure.width
        pieces, owners, offsets = [], [], []
        for i, text in enumerate(texts):
            for at in range(0, max(len(text) // width - length + 1, 0), STRETCH):
                pieces.append(text[at * width : (at + STRETCH + length - 1) * width])
                owners.append(i)
                offsets.append(at)
        found = [self._of(*part, measure) for part in _batches(pieces, owners, offsets)]
        none = [np.empty(0, dtype=np.int64)] * 4 + [np.empty(0, dtype=np.uint64)]
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else none
        self.owner, self.low, self.high, self.anchor, key = columns
        self.key = key.view(np.int64)
        self.texts, self.length, self.width = texts, length, width

    @staticmethod
    def _of(pieces: list[bytes], owners: list[int], offsets: list[int], measure: Measure) -> tuple[np.ndarray, ...]:
        length = measure.length
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8 if measure.width == 1 else np.uint64)
        sizes = np.array([len(p) // measure.width for p in pieces])
        first = np.cumsum(sizes) - sizes
        grams = _grams(data, measure.gram)
        places = np.arange(len(grams), dtype=np.uint64)
        # The least hash, the leftmost of equal ones; its place comes with it.
        anchors = (_least((grams & ~_PLACE) | places, length - measure.gram + 1) & _PLACE).astype(np.int64)
        edges = np.zeros(len(anchors) + 1, dtype=np.int64)
        np.add.at(edges, first, 1)
        np.add.at(edges, np.minimum(first + sizes - length + 1, len(anchors)), -1)
        starts = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        own = anchors[starts]
        piece = np.searchsorted(first, starts, side="right") - 1
        new = np.concatenate([[True], (own[1:] != own[:-1]) | (piece[1:] != piece[:-1])])
        head = np.flatnonzero(new)
        tail = np.concatenate([head[1:], [len(starts)]]) - 1
        where = piece[head]
        shift = np.array(offsets, dtype=np.int64)[where] - first[where]
        key = grams[own[head]]
        return np.array(owners)[where], starts[head] + shift, starts[tail] + shift, own[head] + shift, key

    def text(self, i: int) -> bytes:
        return self.texts[self.owner[i]][self.low[i] * self.width : (self.high[i] + self.length) * self.width]

    def digest(self, i: int) -> int:
        """A hash of the segment's bytes and of where the anchor is in them."""
        return _signed(xxhash.xxh3_64_intdigest(self.text(i), seed=int(self.anchor[i] - self.low[i])))


def _batches(pieces: list[bytes], owners: list[int], offsets: list[int]) -> Iterator[tuple[list, list, list]]:
    start = held = 0
    for i, piece in enumerate(pieces):
        if held and held + len(piece) > STRETCH:
            yield pieces[start:i], owners[start:i], offsets[start:i]
            start, held = i, 0
        held += len(piece)
    if pieces:
        yield pieces[start:], owners[start:], offsets[start:]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _owners(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """What tells a document: its id, and a hash of its text for ids that stand for several."""
    ids = batch.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, batch.column("hash").to_numpy()


def _fingerprint(*columns: np.ndarray) -> np.ndarray:
    """One 64-bit number for several."""
    out = np.zeros(len(columns[0]), dtype=np.uint64)
    for c in columns:
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.int64).view(np.uint64) + np.uint64(1))
    return out.view(np.int64)


def _batch(columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


_OCCURRENCE = "key long, digest long, id long, hash long, low long, high long"
_SEGMENT = "key long, id long, hash long, low long, high long, anchor long, bytes binary"
_FIELDS = ["key", "digest", "id", "hash", "low", "high"]


def _repeated_keys(docs: DataFrame, measure: Measure) -> DataFrame:
    """(key) of anchors that occur more than once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident("anchors")
        for batch in steps(batches):
            keys, n = np.unique(Segments(utf8(batch), measure).key, return_counts=True)
            yield _batch({"key": keys, "n": np.minimum(n, 2)})

    counted = docs.select("text").mapInArrow(count, "key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n")).filter("n > 1").select("key")


def _occurrences(docs: DataFrame, keys, measure: Measure) -> DataFrame:
    """Segments whose anchor may occur more than once."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = utf8(batch)
            ids, hashes = _owners(batch)
            segments = Segments(texts, measure)
            at = np.flatnonzero(keys.value.may_hold(segments.key))
            owner = segments.owner[at]
            digests = np.array([segments.digest(i) for i in at.tolist()], dtype=np.int64)
            columns = (segments.key[at], digests, ids[owner], hashes[owner], segments.low[at], segments.high[at])
            yield _batch(dict(zip(_FIELDS, columns, strict=True)))

    return docs.mapInArrow(find, _OCCURRENCE)


def _texts_of(docs: DataFrame, wanted, measure: Measure) -> DataFrame:
    """The wanted occurrences with their bytes; a few others may come along, which changes nothing."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            texts = utf8(batch)
            ids, hashes = _owners(batch)
            segments = Segments(texts, measure)
            owner = segments.owner
            marks = _fingerprint(segments.key, ids[owner], hashes[owner], segments.low)
            at = np.flatnonzero(wanted.value.may_hold(marks))
            columns = (segments.key[at], ids[owner[at]], hashes[owner[at]], segments.low[at], segments.high[at], segments.anchor[at])
            out = dict(zip(["key", "id", "hash", "low", "high", "anchor"], columns, strict=True))
            yield _batch(out | {"bytes": pa.array([segments.text(i) for i in at.tolist()], pa.binary())})

    return docs.mapInArrow(find, _SEGMENT)


def _groups(occurrences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per (key, digest): n and the first occurrence; and per key with several digests, how many."""
    first = F.min(F.struct("id", "hash", "low", "high")).alias("first")
    groups = occurrences.groupBy("key", "digest").agg(F.count("*").alias("n"), first)
    groups = written(occurrences.sparkSession, groups, "segment-groups")
    several = groups.groupBy("key").agg(F.count("*").alias("kinds")).filter("kinds > 1")
    return groups, written(occurrences.sparkSession, several, "segment-kinds")


def _settled(occurrences: DataFrame, groups: DataFrame, keep_first: bool) -> DataFrame:
    """(id, hash, low, high): window starts of whole segments that repeat; with keep_first, but for the first."""
    again = groups.filter("n > 1").select("key", "digest", F.col("first.id").alias("id0"), F.col("first.hash").alias("hash0"), F.col("first.low").alias("low0"))
    met = occurrences.join(again, ["key", "digest"])
    if keep_first:
        met = met.filter("not (id = id0 and hash = hash0 and low = low0)")
    return met.select("id", "hash", "low", "high")


def _compared(segments: DataFrame, measure: Measure, keep_first: bool) -> DataFrame:
    """(id, hash, low, high) of window starts that another segment of the same anchor has too (an earlier one)."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "id", "hash", "low", "bytes")), strict=True):
                if size >= CHUNK and row[0] != rows[-1][0]:
                    yield rows
                    rows, size = [], 0
                rows.append(row)
                size += len(row[4])
        if rows:
            yield rows
        trim()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches):
            strings = [r[4] for r in rows]
            earlier, anywhere = repeats(strings, measure.length * measure.width, measure.width)
            marked = (earlier if keep_first else anywhere)[:: measure.width]
            edge = np.diff(np.concatenate([[False], marked, [False]]).astype(np.int8))
            first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
            sizes = np.array([len(s) // measure.width for s in strings])
            offsets = np.cumsum(sizes) - sizes
            owner = np.searchsorted(offsets, first, side="right") - 1
            low = np.array([r[3] for r in rows], dtype=np.int64)[owner] + first - offsets[owner]
            columns = [np.array([r[k] for r in rows], dtype=np.int64)[owner] for k in (1, 2)]
            yield _batch({"id": columns[0], "hash": columns[1], "low": low, "high": low + last - first})

    # Dealt by a hash, not by the key: a join by key before would stand in for this exchange, and its rows stay in the tasks
    # that wrote them (or are split) where it turns into a broadcast (or is skewed) while it runs.
    ordered = segments.repartition(F.xxhash64("key")).sortWithinPartitions("key", "id", "hash", "low")
    return ordered.select("key", "id", "hash", "low", "bytes").mapInArrow(compare, "id long, hash long, low long, high long")


def _narrowed(segments: DataFrame, windows: int, measure: Measure) -> DataFrame:
    """Segments of at most ``windows`` windows. Their key has all bytes that the windows share, and which windows they are."""

    length, width = measure.length, measure.width

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in [*_FIELDS, "bytes"]}
            for key, anchor, id_, hash_, low, high, data in zip(*(batch.column(c).to_pylist() for c in ("key", "anchor", "id", "hash", "low", "high", "bytes")), strict=True):
                # Blocks of windows lie at fixed distances from the anchor, so equal windows are in equal blocks.
                at = low
                while at <= high:
                    block = (anchor - at) // windows
                    last = min(high, anchor - block * windows)
                    core = data[(anchor - block * windows - low) * width : (anchor - (block + 1) * windows + 1 - low + length) * width]
                    own = data[(at - low) * width : (last - low + length) * width]
                    out["key"].append(_signed(xxhash.xxh3_64_intdigest(core, seed=(key ^ (block * 0x9E3779B97F4A7C15)) & 0xFFFFFFFFFFFFFFFF)))
                    out["digest"].append(_signed(xxhash.xxh3_64_intdigest(own, seed=anchor - at)))
                    for name, value in (("id", id_), ("hash", hash_), ("low", at), ("high", last), ("bytes", own)):
                        out[name].append(value)
                    out.setdefault("anchor", []).append(anchor)
                    at = last + 1
            out.setdefault("anchor", [])
            types = {k: pa.binary() if k == "bytes" else pa.int64() for k in out}
            yield _batch({k: pa.array(v, types[k]) for k, v in out.items()})

    return segments.mapInArrow(cut, f"{_OCCURRENCE}, bytes binary, anchor long")


def _firsts(groups: DataFrame, several: DataFrame) -> DataFrame:
    """The first occurrence of each of the different segments of an anchor: key, digest, id, hash, low, kinds."""
    return groups.join(several, "key").select("key", "digest", "first.id", "first.hash", "first.low", "kinds")


def _mark(batch: pa.RecordBatch) -> np.ndarray:
    """The fingerprint of each occurrence (key, id, hash, low)."""
    return _fingerprint(*(batch.column(c).to_numpy() for c in ("key", "id", "hash", "low")))


def repeated_starts(docs: DataFrame, measure: Measure, keep_first: bool) -> DataFrame:
    """(id, hash, starts): for each document that has any, the ranges (low, high) of window starts that repeat.

    docs: (doc_id, text, hash). The text is read three times, and only segments that need comparing are moved.
    """
    spark = docs.sparkSession
    share = spark.sparkContext.broadcast
    keys = written(spark, _repeated_keys(docs, measure), "anchors")
    occurrences = written(spark, _occurrences(docs, share(bloom_filter(keys)), measure), "occurrences")
    groups, several = _groups(occurrences)
    ranges = _settled(occurrences, groups, keep_first)
    firsts = written(spark, _firsts(groups, several), "firsts")
    segments = written(spark, _texts_of(docs, share(bloom_filter(firsts, _mark)), measure), "segments")
    # Each of them stands for more than MANY segments of text, so they are few beside it; broadcast, they leave the texts in place.
    hot = F.broadcast(several.filter(F.col("kinds") > MANY).select("key"))
    ranges = ranges.unionByName(_compared(segments.join(hot, "key", "left_anti"), measure, keep_first))
    left = segments.join(hot, "key", "left_semi")
    for windows in NARROWER if not hot.isEmpty() else ():
        narrow = written(spark, _narrowed(left, windows, measure), "narrow-segments")
        groups, several = _groups(narrow)
        ranges = ranges.unionByName(_settled(narrow, groups, keep_first))
        apart = written(spark, narrow.join(_firsts(groups, several), ["key", "digest", "id", "hash", "low"]), "narrow-firsts")
        ranges = ranges.unionByName(_compared(apart.filter(F.col("kinds") <= MANY), measure, keep_first))
        left = apart.filter(F.col("kinds") > MANY)
    ranges = ranges.groupBy("id", "hash").agg(F.collect_list(F.struct("low", "high")).alias("starts"))
    return written(spark, ranges, "repeats")


def _spans(starts: list[dict] | None, length: int) -> list[tuple[int, int]]:
    """The byte spans covered by windows that start in the ranges, merged."""
    spans: list[tuple[int, int]] = []
    for low, high in sorted((r["low"], r["high"] + length) for r in starts or ()):
        if spans and low <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(spans[-1][1], high))
        else:
            spans.append((low, high))
    return spans


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def _with_starts(df: DataFrame, measure: Measure, keep_first: bool, id_col: str, text_col: str) -> tuple[DataFrame, str, str]:
    """``df`` with its text as UTF-8 and the ranges of repeated starts (null for none), and the names of these two columns."""
    names = [unused(df, name) for name in ("repeat_id", "repeat_hash", "repeat_text", "repeat_starts")]
    id_, hash_, text, starts = names
    plain = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    own = df.withColumns({text: plain.cast("binary"), hash_: F.xxhash64(plain), id_: F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))})
    docs = id_and_text(df, id_col, text_col).withColumn("hash", F.xxhash64("text"))
    found = repeated_starts(docs, measure, keep_first)
    found = found.select(F.col("id").alias(id_), F.col("hash").alias(hash_), F.col("starts").alias(starts))
    return own.join(found, [id_, hash_], "left").select(*(f"`{c}`" for c in df.columns), text, starts), text, starts


def repeat_digests(df: DataFrame, length: int = 400, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, for what ``remove_repeats`` takes away.

    Texts are bytes here: a removed span may begin or end inside a character. A null or empty text has no
    bytes. Rows with one id and different texts are different documents; rows equal in both are places of
    their own, so each repeats the other (with ``keep_first`` all of them are the first, and stay).
    """
    docs = id_and_text(df, id_col, text_col)
    found, text, starts = _with_starts(docs, Measure(length), keep_first, "doc_id", "text")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            texts = batch.column(text).to_pylist()
            spans = [_spans(s, length) for s in batch.column(starts).to_pylist()]
            kept = [_without(t, s) for t, s in zip(texts, spans, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
                    pa.array([len(s) for s in spans], pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
            )

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return found.select("doc_id", text, starts).mapInArrow(digest, schema)


def remove_repeats(df: DataFrame, length: int = 400, keep_first: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with repeated passages cut out of their texts; all columns and rows stay.

    A byte goes if a string of ``length`` bytes over it also starts at an earlier place (any other place
    without ``keep_first``), by the order of ids and positions. Characters are cut whole: one that a span
    covers in part stays. A null text stays null. Other cases as in ``repeat_digests``.
    """

    def spans(data: bytes, ranges: list[dict] | None) -> list[tuple[int, int]]:
        return [_whole_characters(data, *span) for span in _spans(ranges, length)]

    return _cut(df, Measure(length), spans, keep_first, id_col, text_col)


def remove_repeated_words(df: DataFrame, words: int, keep_first: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with repeated passages of ``words`` words or more cut out, however few bytes they have.

    A word (what lies between white space) goes if a run of ``words`` words over it also starts at an earlier
    place (any other place without ``keep_first``). White space may differ, and so may ASCII marks before the
    first word of the run and after its last. A word goes with its marks and the white space after it.
    Other cases as in ``remove_repeats``. Runs have more words than WORD_GRAM.
    """
    if words <= max(WORD_GRAM, *NARROWER):
        raise ValueError("passages of so few words are not looked for")

    def spans(data: bytes, ranges: list[dict] | None) -> list[tuple[int, int]]:
        if not ranges:
            return []
        starts = [*(m.start() for m in _WORD.finditer(data)), len(data)]
        return [(starts[low], starts[high]) for low, high in _spans(ranges, words)]

    return _cut(df, in_words(words), spans, keep_first, id_col, text_col)


def _cut(df: DataFrame, measure: Measure, spans_of: Callable, keep_first: bool, id_col: str, text_col: str) -> DataFrame:
    """``df`` without the spans of its texts that ``spans_of`` gives for a text and its ranges of repeated starts."""
    found, text, starts = _with_starts(df, measure, keep_first, id_col, text_col)
    names = df.columns
    at = [n.lower() for n in names].index(text_col.lower())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text):
            out = []
            for was, data, ranges in zip(batch.column(at).to_pylist(), batch.column(text).to_pylist(), batch.column(starts).to_pylist(), strict=True):
                spans = spans_of(data, ranges)
                out.append(was if not spans else _without(data, spans).decode("utf-8"))
            columns = [batch.column(n) for n in range(len(names))]
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return found.select(*(f"`{n}`" for n in names), text, starts).mapInArrow(cut, df.schema)


def _whole_characters(data: bytes, low: int, high: int) -> tuple[int, int]:
    """The span without the bytes of characters that it holds only in part."""
    while low < high and data[low] & 0xC0 == 0x80:
        low += 1
    while high > low and high < len(data) and data[high] & 0xC0 == 0x80:
        high -= 1
    return low, high
