"""Near-duplicate documents by MinHash (operator 7).

Each distinct shingle set gets many universal hash minima, cut into bands; sets that agree on a band are
candidates. A band bucket links its members to its smallest one, so buckets of any size give as many edges
as members, and all that could be linked ends up in one candidate cluster. In a cluster, pairs whose
signatures come near the threshold are confirmed on the full sets, and the confirmed links give the
components. Large clusters are compared in blocks, so no task gets more than two blocks of one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import id_and_text, resident, steps, unused, utf8, written
from tidemart.llm.components import connected_components
from tidemart.llm.shingles import mix, shingle_sets

#: Chance that a pair exactly at the threshold agrees on no band.
MISS = 1e-7
#: Signatures may fall so many standard deviations below the threshold before a pair is given up.
SPREAD = 5.0
#: Sets of one cluster compared in one task are at most two blocks, each of about so many sets and shingles.
BLOCK = 1024
BLOCK_SHINGLES = 2_000_000
#: Shingles in more sets of a block pair than this are counted by a matrix product, others pair by pair.
COMMON = 16


@dataclass(frozen=True)
class MinHash:
    """Shingles of ``width`` words; linked if 100 * intersection >= ``percent`` * union."""

    width: int = 5
    percent: int = 80
    rows: int = 5

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MISS) / math.log(1 - (self.percent / 100) ** self.rows))

    @property
    def size(self) -> int:
        return self.rows * self.bands

    @property
    def least_equal(self) -> int:
        """Equal minima below which a pair is given up."""
        s = self.percent / 100
        return math.floor(self.size * s - SPREAD * math.sqrt(self.size * s * (1 - s)))

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        """The upper halves of the minima of ``size`` multiply-add hashes."""
        odd = mix(np.arange(1, self.size + 1, dtype=np.uint64)) | np.uint64(1)
        add = mix(np.arange(self.size + 1, 2 * self.size + 1, dtype=np.uint64))
        least = np.full(self.size, np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(shingles), 4096):
            hashed = odd[:, None] * shingles[None, at : at + 4096] + add[:, None]
            np.minimum(least, hashed.min(axis=1), out=least)
        return (least >> np.uint64(32)).astype(np.uint32)

    def band_keys(self, signatures: np.ndarray) -> np.ndarray:
        """A 64-bit key for each signature (row) and band (column); the band is part of it."""
        salts = mix(np.arange(7, 7 + self.rows, dtype=np.uint64)) | np.uint64(1)
        values = signatures.reshape(len(signatures), self.bands, self.rows).astype(np.uint64) + np.uint64(1)
        band = mix(np.arange(1, self.bands + 1, dtype=np.uint64))
        return mix((mix(values) * salts).sum(axis=2, dtype=np.uint64) + band).view(np.int64)


def _signed(df: DataFrame, how: MinHash) -> DataFrame:
    """(doc_id, text_hash, n_shingles, set_id, signature) of documents; the last two are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resident("shingles")
        for batch in steps(batches):
            sets = shingle_sets(utf8(batch), how.width)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s) if len(s) else None for s in sets], pa.binary()),
                    pa.array([how.signature(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["doc_id", "text_hash", "n_shingles", "set_id", "signature"],
            )

    hashed = df.withColumn("text_hash", F.xxhash64("text"))
    return hashed.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, set_id binary, signature binary")


def _bands(sets: DataFrame, how: MinHash) -> DataFrame:
    """(key, node) for every set and band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = b"".join(batch.column("signature").to_pylist())
            keys = how.band_keys(np.frombuffer(raw, dtype=np.uint32).reshape(-1, how.size))
            nodes = np.repeat(batch.column("node").to_numpy(), how.bands)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(nodes)], ["key", "node"])

    return sets.select("node", "signature").mapInArrow(run, "key long, node long")


def _candidate_edges(bands: DataFrame) -> DataFrame:
    """(node, leader): each member of a bucket and the bucket's smallest."""
    shared = bands.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).filter("leader < last")
    return bands.join(shared.select("key", "leader"), "key").filter("node > leader").select("node", "leader")


class _Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


def _near(signatures: np.ndarray, first: np.ndarray, second: np.ndarray, least: int) -> np.ndarray:
    """Which sets have a partner between the two index lists whose signature agrees at ``least`` places or more."""
    found = np.zeros(len(signatures), dtype=bool)
    other = signatures[second]
    for i in first:
        hit = second[((other == signatures[i]).sum(axis=1) >= least) & (second != i)]
        if len(hit):
            found[i] = True
            found[hit] = True
    return found


def _intersections(sets: list[np.ndarray], n_first: int) -> np.ndarray:
    """Sizes of the intersections of the first ``n_first`` sets (rows) with all sets (columns)."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    counts = np.diff(np.concatenate([starts, [len(values)]]))
    sizes = np.zeros((n_first, len(sets)), dtype=np.float32)
    for k in range(2, min(COMMON, len(sets)) + 1):  # shingles in exactly k sets: all pairs of their owners
        at = starts[counts == k]
        for step in range(0, len(at), 10_000):
            owners = owner[at[step : step + 10_000, None] + np.arange(k)]
            left, right = np.repeat(owners, k, axis=1).ravel(), np.tile(owners, (1, k)).ravel()
            mine = left < n_first
            np.add.at(sizes, (left[mine], right[mine]), 1)
    often = np.flatnonzero(counts > COMMON)
    for step in range(0, len(often), 2048):
        chosen = often[step : step + 2048]
        holds = np.zeros((len(sets), len(chosen)), dtype=np.float32)
        rows = np.concatenate([owner[starts[c] : starts[c] + counts[c]] for c in chosen])
        holds[rows, np.repeat(np.arange(len(chosen)), counts[chosen])] = 1
        sizes += holds[:n_first] @ holds.T
    return sizes


def _confirmed(group: pd.DataFrame, how: MinHash) -> list[tuple[int, int]]:
    """Links that span what is linked between the two blocks of a group, or within its only one."""
    group = group.sort_values(["block", "node"], ignore_index=True)
    blocks = group["block"].to_numpy()
    one = blocks[0] == blocks[-1]
    first = np.flatnonzero(blocks == blocks[0])
    second = first if one else np.flatnonzero(blocks != blocks[0])
    signatures = np.frombuffer(b"".join(group["signature"]), dtype=np.uint32).reshape(-1, how.size)
    near = np.flatnonzero(_near(signatures, first, second, how.least_equal))
    if not len(near):
        return []
    sets = [np.frombuffer(group["shingles"].iat[i], dtype=np.uint64) for i in near]
    n_first = len(near) if one else int((blocks[near] == blocks[0]).sum())
    inter = _intersections(sets, n_first).astype(np.float64)
    n = np.array([len(s) for s in sets], dtype=np.float64)
    linked = 100 * inter >= how.percent * (n[:n_first, None] + n[None, :] - inter)
    nodes, forest, links = group["node"].to_numpy()[near], _Forest(len(near)), []
    for i, j in zip(*np.nonzero(linked), strict=True):
        if (i < j if one else j >= n_first) and forest.join(int(i), int(j)):
            links.append((int(nodes[i]), int(nodes[j])))
    return links


def _links(docs: DataFrame, members: DataFrame, how: MinHash) -> DataFrame:
    """(u, v): confirmed links that span every component. members: (node, doc_id, set_id, n_shingles, signature, cluster)."""
    blocks = F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") / BLOCK_SHINGLES)
    sizes = members.groupBy("cluster").agg(F.ceil(blocks).cast("int").alias("blocks"))
    dealt = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    keep = ["node", "cluster", "block", "blocks", "signature"]
    texts = docs.join(dealt.select("doc_id", "set_id", *keep), "doc_id").select("text", "set_id", *keep)

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            sets = shingle_sets(utf8(batch), how.width)
            # An id may stand for several texts; the one meant has this set.
            meant = [xxhash.xxh3_128_digest(s) == i for s, i in zip(sets, batch.column("set_id").to_pylist(), strict=True)]
            shingles = pa.array([s.tobytes() for s in sets], pa.binary())
            rows = pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), shingles], [*keep, "shingles"])
            yield rows.filter(pa.array(meant, pa.bool_()))

    schema = "node long, cluster long, block int, blocks int, signature binary, shingles binary"
    # Each block meets itself and every other block of its cluster once.
    met = texts.mapInArrow(shingle, schema).withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumns({"low": F.least("block", "partner"), "high": F.greatest("block", "partner")})

    def confirm(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_confirmed(group.drop_duplicates("node"), how), columns=["u", "v"], dtype="int64")

    found = met.select("cluster", "low", "high", "block", "node", "signature", "shingles")
    return found.groupBy("cluster", "low", "high").applyInPandas(confirm, "u long, v long")


def near_duplicates(df: DataFrame, how: MinHash = MinHash(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash (Spark's xxhash64), n_shingles, component_id, kept.

    ``component_id`` is the smallest id reachable over links, and a document is kept if it is its own.
    Documents with equal sets are linked and travel as one. A null or empty text, or one without words,
    is linked with nothing. Rows with equal ids are separate documents; a row without an id is linked with
    nothing, has no component and is kept. An empty table gives no rows.
    """
    spark = df.sparkSession
    docs = id_and_text(df, id_col, text_col)
    signed = written(spark, _signed(docs, how), "signatures")
    known = signed.filter("doc_id is not null and set_id is not null")
    first = [F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")]
    # The numbers are fixed by being written: distinct, whatever order the rows came in.
    sets = written(spark, known.groupBy("set_id").agg(*first).withColumn("node", F.monotonically_increasing_id()), "sets")
    clusters = connected_components(_candidate_edges(_bands(sets, how))).withColumnRenamed("component", "cluster")
    members = written(spark, sets.join(clusters, "node"), "clusters")
    components = connected_components(_links(docs, members, how))
    rooted = sets.select("set_id", "doc_id", "node").join(components, "node", "left")
    rooted = written(spark, rooted.select("set_id", "doc_id", F.coalesce("component", "node").alias("root")), "roots")
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    labelled = rooted.join(least, "root").select("set_id", "component_id")
    out = signed.join(labelled, "set_id", "left")
    own = F.when(F.col("set_id").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    out = out.select("doc_id", "text_hash", "n_shingles", own.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(df: DataFrame, how: MinHash = MinHash(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` with all their columns, but of each group of near-duplicates only the smallest id.

    Of rows equal in id and text one stays. Rows without an id all stay.
    """
    text = unused(df, "text_hash")
    hashed = df.withColumn(text, F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))))
    kept = near_duplicates(df, how, id_col, text_col).filter("kept and doc_id is not null")
    kept = kept.select(F.col("doc_id").alias(id_col), F.col("text_hash").alias(text)).distinct()
    one = hashed.join(kept, [id_col, text], "left_semi").dropDuplicates([id_col, text])
    return one.unionByName(hashed.filter(F.col(f"`{id_col}`").isNull())).drop(text)
