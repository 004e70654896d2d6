"""A Merkle manifest of a table, kept as append logs in postorder, with proofs for every row.

Rows are hashed where they lie; only digests are ordered. Within a group the leaves are numbered by ranges and
prefix sums. A builder takes an aligned run of ``FAN ** height`` neighbours and appends the nodes of its subtree
in the order in which they are complete, children before parents. Where a node stands in the log of its tree
follows from the sizes of the subtrees before it, so builders need no word from each other, and a reader finds a
sibling by computing its position. Roots of subtrees are the leaves of the next tier, until one is left; the
roots of the groups are the leaves of one more tree.

Proofs are read from the top down: a task holds the nodes of one aligned subtree, computes the positions of the
siblings on each row's way up, and adds the way that the subtree's root has from there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.functions import named
from tidemart.llm.common import written

FAN = 3
#: Levels of a builder's subtree: 6,561 leaves, some 630 KB of digests.
HEIGHT = 8
#: Rows of an Arrow batch of proofs or nodes.
EMIT_ROWS = 2000

NODES = "tree string, n long, level int, index long, position long, digest binary"
STEP = "struct<slot:int,siblings:array<binary>>"


def level_sizes(n: int) -> list[int]:
    """How many nodes a tree of n leaves has on each level, up to its root."""
    sizes = [n]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // FAN))
    return sizes


def position(level: int, index: int, sizes: Sequence[int]) -> int:
    """Where a node stands in the postorder of its tree: the nodes complete before it. These are all that end at
    its last leaf or earlier on its level and below, and on higher levels all that end before its first leaf."""
    width = FAN**level
    last = min((index + 1) * width, sizes[0]) - 1
    before = sum(last // FAN**k + 1 for k in range(level + 1)) - 1
    while index and level + 1 < len(sizes):
        index //= FAN
        level += 1
        before += index
    return before


def combined(digests: Sequence[bytes]) -> bytes:
    """The digest of a node: of its children's digests as hexadecimal text."""
    return hashlib.sha256("".join(d.hex() for d in digests).encode()).digest()


def subtree(level: int, first: int, digests: Sequence[bytes], sizes: Sequence[int], height: int) -> Iterator[tuple[int, int, bytes]]:
    """(level, index, digest) in order of completion, for neighbours on ``level`` from ``first`` on and the up to
    ``height`` levels above them. The given nodes come too on level 0; above, the tier below has written them."""
    open_runs: list[list[bytes]] = [[] for _ in range(height + 1)]
    for at, digest in enumerate(digests, first):
        up, index = 0, at
        if level == 0:
            yield 0, index, digest
        open_runs[0].append(digest)
        while up < height and sizes[level + up] > 1 and (index % FAN == FAN - 1 or index == sizes[level + up] - 1):
            digest, open_runs[up] = combined(open_runs[up]), []
            up, index = up + 1, index // FAN
            open_runs[up].append(digest)
            yield level + up, index, digest


def proof_steps(level: int, index: int, sizes: Sequence[int], height: int, node) -> Iterator[dict]:
    """The steps from a node over up to ``height`` levels: its place in its run and its siblings, as ``node`` gives
    them by their position."""
    for k in range(level, min(level + height, len(sizes) - 1)):
        run = range(index - index % FAN, min(index - index % FAN + FAN, sizes[k]))
        yield {"slot": index % FAN, "siblings": [node(position(k, i, sizes)) for i in run if i != index]}
        index //= FAN


def _height(n: Column) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    return F.size(F.filter(F.array(*[F.lit(FAN**k) for k in range(39)]), lambda x: x < n))


def numbered(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows``, which have a column ``tree``, with ``index``, their place by ``keys`` in their tree, and ``n``, the
    tree's rows. Ranges of (tree, keys) are sorted apart, and each range gets the count of those before it, so
    a tree of any size is spread. Rows with equal keys are spread too and come in any order."""
    spark = rows.sparkSession
    order = ["tree", *keys, "tie"]
    ranges = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    placed = ranges.drop("tie").withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    placed = written(spark, placed, "ranges")
    counts = placed.groupBy("tree", "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    tree = Window.partitionBy("tree")
    before = F.sum("rows").over(tree.orderBy("part")) - F.col("rows")
    bases = counts.select("tree", "part", (before - F.col("first")).alias("base"), F.sum("rows").over(tree).alias("n"))
    return placed.join(bases, ["tree", "part"]).withColumn("index", F.col("at") + F.col("base")).drop("part", "at", "base")


def _emitted(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == EMIT_ROWS:
            yield batch()
            held = []
    if held:
        yield batch()


def _tier(nodes: DataFrame, level: int, height: int) -> DataFrame:
    """What the builders of one tier append for the nodes (tree, n, index, digest) on ``level``."""
    runs = nodes.select("tree", "n", "index", "digest", F.expr(f"index div {FAN**height}").alias("segment"))
    runs = runs.repartition("tree", "segment").sortWithinPartitions("tree", "segment", "index")
    schema = pa.schema(
        [("tree", pa.string()), ("n", pa.int64()), ("level", pa.int32()), ("index", pa.int64()), ("position", pa.int64()), ("digest", pa.binary())]
    )

    def built(tree: str, n: int, first: int, digests: list[bytes]) -> Iterator[tuple]:
        sizes = level_sizes(n)
        for at, index, digest in subtree(level, first, digests, sizes, height):
            yield tree, n, at, index, position(at, index, sizes), digest

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        run, digests = None, []
        for batch in batches:
            for tree, n, index, digest, segment in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if run is None or run[:2] != (tree, segment):
                    if run:
                        yield from built(tree=run[0], n=run[2], first=run[3], digests=digests)
                    run, digests = (tree, segment, n, index), []
                digests.append(digest)
        if run:
            yield from built(tree=run[0], n=run[2], first=run[3], digests=digests)

    return runs.mapInArrow(lambda batches: _emitted(rows(batches), schema), NODES)


def write_log(leaves: DataFrame, height: int = HEIGHT) -> MerkleLog:
    """The logs of the trees whose leaves are (tree, n, index, digest), as ``numbered`` gives them."""
    spark = leaves.sparkSession
    most = leaves.agg(F.max("n")).first()[0] or 0
    log, nodes = MerkleLog(spark, height), leaves
    for level in range(0, max(1, len(level_sizes(most)) - 1), height):
        log.tiers.append(written(spark, _tier(nodes, level, height), "merkle-log"))
        nodes = log.tiers[-1].filter((F.col("level") == level + height) & (F.col("level") < _height(F.col("n"))))
    return log


@dataclass
class MerkleLog:
    """The written logs of any number of trees: one table per tier, each with the nodes its builders appended."""

    spark: SparkSession
    height: int
    tiers: list[DataFrame] = field(default_factory=list)

    @property
    def nodes(self) -> DataFrame:
        """Every node once: tree, n, level, index, position, digest."""
        return reduce(DataFrame.unionByName, self.tiers)

    def roots(self) -> DataFrame:
        """The root of each tree: tree, n, digest."""
        return self.nodes.filter(F.col("level") == _height(F.col("n"))).select("tree", "n", "digest")

    def prove(self, leaves: DataFrame, above: DataFrame) -> DataFrame:
        """The rows of ``leaves`` (tree, n, index and any others) with ``tree_root``, the root of their tree, and
        ``proof``: the steps from leaf to root, followed by those that ``above`` (tree, proof) has for the tree.
        A step is the node's slot in its run and the digests of the others."""
        carried = [c for c in leaves.columns if c not in ("tree", "n", "index")]
        asked = leaves.select("tree", "n", "index", F.struct(*map(named, carried)).alias("carried"))
        last_tier = F.expr("greatest(0, height - 1)") / F.lit(self.height)
        tops = self.roots().withColumn("height", _height(F.col("n"))).withColumn("tier", F.floor(last_tier)).join(above, "tree")
        proofs = None
        for tier in reversed(range(len(self.tiers))):
            heads = tops.filter(F.col("tier") == tier)
            heads = heads.select("tree", F.lit(0).cast("long").alias("segment"), "digest", "proof")
            level = tier * self.height
            if proofs is not None:
                heads = heads.unionByName(proofs.select("tree", F.col("index").alias("segment"), F.col("tree_root").alias("digest"), "proof"))
            if tier:
                inner = self.nodes.filter((F.col("level") == level) & (F.col("level") < _height(F.col("n"))))
                proofs = written(self.spark, self._tier_proofs(tier, inner.select("tree", "n", "index"), heads), "proofs")
        proofs = self._tier_proofs(0, asked, heads)
        return proofs.select("tree", "n", "index", *[F.col("carried")[c].alias(c) for c in carried], "tree_root", "proof")

    def _tier_proofs(self, tier: int, asked: DataFrame, heads: DataFrame) -> DataFrame:
        """``asked`` nodes on the lowest level of a tier with the steps inside it, followed by those of ``heads``, which
        has the root of each segment."""
        level, height = tier * self.height, self.height
        top = level + height
        segment = f"index div bigint(pow({FAN}, {top} - level))"
        inside = self.nodes.filter(F.col("level").between(level, top - 1))
        rows = [
            heads.select("tree", "segment", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("index"), "digest", "proof"),
            inside.select("tree", F.expr(segment).alias("segment"), F.lit(1).alias("kind"), F.col("position").alias("index"), "digest"),
            asked.withColumns({"segment": F.expr(f"index div {FAN**height}"), "kind": F.lit(2)}),
        ]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
        rows = rows.repartition("tree", "segment").sortWithinPartitions("tree", "segment", "kind", "index")
        kept = [c for c in rows.columns if c not in ("segment", "kind", "digest", "proof")]
        shape = rows.select(*kept, F.col("digest").alias("tree_root"), "proof").schema
        steps = pa.list_(pa.struct([("slot", pa.int32()), ("siblings", pa.list_(pa.binary()))]))

        def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            here, nodes, root, head = None, {}, None, []
            for batch in batches:
                found, roots, proofs = [], [], []
                columns = ("tree", "segment", "kind", "index", "n", "digest", "proof")
                values = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in columns)
                for row, (tree, part, kind, index, n, digest, proof) in enumerate(zip(*values, strict=True)):
                    if here != (tree, part):
                        here, nodes = (tree, part), {}
                    if kind == 0:
                        root, head = digest, proof
                    elif kind == 1:
                        nodes[index] = digest
                    else:
                        found.append(row)
                        roots.append(root)
                        proofs.append([*proof_steps(level, index, level_sizes(n), height, nodes.__getitem__), *head])
                if found:
                    out = pa.Table.from_batches([batch]).select(kept).take(found)
                    out = out.append_column("tree_root", pa.array(roots, pa.binary()))
                    yield from out.append_column("proof", pa.array(proofs, steps)).to_batches()

        return rows.mapInArrow(prove, shape)


def _hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, _hex), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root, as hexadecimal text, that a leaf's digest and its proof lead to."""

    def step(digest: Column, at: Column) -> Column:
        before, after = F.slice(at["siblings"], F.lit(1), at["slot"]), F.slice(at["siblings"], at["slot"] + 1, F.lit(FAN))
        return F.sha2(F.concat(_joined(before), digest, _joined(after)), 256)

    return F.aggregate(proof, _hex(leaf), step)


def row_digest(*values: Column) -> Column:
    """The digest of a row: of each value's length in bytes, a colon and the value as text, or ``-`` for a null."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.unhex(F.sha2(F.concat(*parts), 256))


@dataclass
class Manifest:
    """The logs of a table's groups, the log of the tree over their roots, and the root of all."""

    leaves: DataFrame
    log: MerkleLog
    tops: DataFrame
    top_log: MerkleLog
    root: str | None

    def proofs(self) -> DataFrame:
        """Every row with ``tree_root`` and ``proof``, its steps to the root of all."""
        start = self.tops.sparkSession.createDataFrame([("", [])], f"tree string, proof array<{STEP}>")
        above = self.top_log.prove(self.tops, start).select(F.col("name").alias("tree"), "proof")
        return self.log.prove(self.leaves, above)


def build_manifest(rows: DataFrame, group: Column, keys: Sequence[str], digest: Column, height: int = HEIGHT) -> Manifest:
    """The manifest of a table: within a group rows ascend by ``keys``, then by digest; groups ascend by name, null first,
    bytewise.

    Nulls in keys come first. Repeated rows are leaves of their own. A group of one row has that row's digest as
    its root; an empty table has no root and no proofs. All columns of ``rows`` but those that the digest needs
    can be dropped before; each is carried along, so leave texts out (``row_digest`` them first).
    """
    # names in order: nulls are the empty text, others are marked
    named_rows = rows.withColumns({"tree": F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("")), "digest": digest})
    leaves = numbered(named_rows, [*keys, "digest"])
    log = write_log(leaves, height)
    tops = numbered(log.roots().select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"])
    top_log = write_log(tops, height)
    root = top_log.roots().first()
    return Manifest(leaves, log, tops, top_log, root.digest.hex() if root else None)


def manifest_digests(documents: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per document its leaf, the roots above it, a digest of its proof, and whether the proof still holds for a text
    that may have been tampered with: documents whose id has an even CRC-32 lose their line breaks."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    plain, text = [F.col(c) for c in columns[:-1]], F.col("text")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.regexp_replace(text, "\n", "")).otherwise(text)
    rows = documents.select("doc_id", "source", row_digest(*plain, text).alias("leaf"), row_digest(*plain, tampered).alias("tampered"))
    manifest = build_manifest(rows, F.col("source"), ["doc_id"], F.col("leaf"), height)
    proof, root = F.col("proof"), F.lit(manifest.root).cast("string")
    siblings = F.flatten(F.transform(proof, lambda step: step["siblings"]))
    return (
        manifest.proofs()
        .withColumn("folded_root", folded(F.col("tampered"), proof))
        .select(
            "doc_id",
            _hex(F.col("leaf")).alias("leaf"),
            _hex(F.col("tree_root")).alias("subroot"),
            root.alias("root"),
            F.sha2(_joined(siblings), 256).alias("proof_sha256"),
            "folded_root",
            F.col("folded_root").eqNullSafe(root).alias("verified"),
        )
    )
