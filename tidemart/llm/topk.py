"""Exact top-k by inner product without random access (operator 8).

Every dimension of a block of candidates is a list sorted by that component, read from the top by queries
with a positive weight there and from the bottom by the others. Reading goes on in runs. What a query has
read of a candidate is a lower bound of its score once the worst end of every unread list is added, an upper
bound with the next entry of every such list. When the upper bound of all but few candidates is below the k-th lower
bound, or below the k-th score of blocks read before, the rest of the lists is not read; the scores of those few are resolved.

Components are integers. Bounds are computed in floating point and widened by what that can be off; the scores of those
that qualify are computed in 64-bit integers, so scores, ranks and ties are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.common import written

#: Candidates in one block, blocks that a task reads one after another, and queries that meet them at a time.
CANDIDATES, BLOCKS, QUERIES = 4096, 4, 256
#: Shares of every list that have been read after each run. Queries still open then have their scores resolved.
RUNS = (0.02, 0.08, 0.2)


class Lists:
    """The sorted lists of one block of candidates: ``places[d]`` orders dimension d, largest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.exact, self.n = ids, vectors, len(ids)
        # Equal values by id, so that reading is repeatable.
        self.places = np.lexsort((np.broadcast_to(ids, vectors.T.shape), -vectors.T), axis=1)
        self.sorted = np.take_along_axis(vectors.T, self.places, axis=1).astype(np.float64)

    def slack(self, queries: np.ndarray) -> float:
        """How far a bound can be off: nothing while all sums are exact in a float. An error if a score can leave 64 bits."""
        largest = [max(int(a.max(initial=0)), -int(a.min(initial=0))) for a in (queries, self.exact)]
        dim = queries.shape[1]
        most = dim * largest[0] * largest[1]
        if most >= 1 << 63:
            raise OverflowError(f"scores can leave 64 bits: components up to {largest[1]} and {largest[0]} in {dim} dimensions")
        return 0.0 if most < 1 << 50 else most * (dim * (2 * len(RUNS) + 4) + 8) * 2.0**-51

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[pd.DataFrame, int]:
        """Each query's k best candidates of the block other than itself, as (row, vec_id, score) with the query's row, and how many
        list entries were read for that. Candidates below ``floor``, a score for each query, may be left out."""
        slack = self.slack(queries)
        floor = np.full(len(queries), -np.inf) if floor is None else floor
        # A block whose list heads together stay below the floor is not read at all.
        reading = Reading(self, queries.astype(np.float64))
        open_ = np.flatnonzero(reading.upper.max(axis=0, initial=-np.inf) + slack >= floor)
        reading.keep(open_)
        found = []
        for share in (*RUNS, None):
            if not len(open_):
                break
            if share is not None:
                reading.to(min(self.n, max(k + 1, int(share * self.n))))
            own = self.ids[:, None] == query_ids[None, open_]
            lower = np.where(own, -np.inf, reading.lower)
            kth = np.partition(lower, self.n - k, axis=0)[self.n - k] if self.n > k else np.full(len(open_), -np.inf)
            qualify = (reading.upper + slack >= np.maximum(kth - slack, floor[open_])) & ~own
            # Few enough are left to resolve their scores: the others cannot reach the k-th.
            enough = qualify.sum(axis=0) <= max(4 * k, self.n // 64) if share is not None else np.ones(len(open_), dtype=bool)
            for column in np.flatnonzero(enough):
                cols = np.flatnonzero(qualify[:, column])
                scores = self.exact[cols] @ queries[open_[column]]
                best = np.lexsort((self.ids[cols], -scores))[:k]
                found.append((np.full(len(best), open_[column]), self.ids[cols[best]], scores[best]))
            open_ = open_[~enough]
            reading.keep(np.flatnonzero(~enough))
        parts = [np.concatenate(p) for p in zip(*found, strict=True)] if found else [np.empty(0, dtype=np.int64)] * 3
        return pd.DataFrame(dict(zip(("row", "vec_id", "score"), parts, strict=True))).astype("int64"), reading.entries


class Reading:
    """Bounds of the scores (candidates x queries) as far as the lists have been read; only entries read are touched."""

    def __init__(self, lists: Lists, queries: np.ndarray):
        self.lists, self.read, self.entries = lists, 0, 0
        self.up, self.down = np.maximum(queries, 0), np.minimum(queries, 0)
        s, n = lists.sorted, lists.n
        tops, ends = (s[:, 0], s[:, -1]) if n else (np.zeros(len(s)), np.zeros(len(s)))
        self.upper = np.repeat((self.up @ tops + self.down @ ends)[None, :], n, axis=0)
        self.lower = np.repeat((self.up @ ends + self.down @ tops)[None, :], n, axis=0)

    def keep(self, columns: np.ndarray) -> None:
        """Goes on with some of the queries."""
        if len(columns) < self.up.shape[0]:
            self.up, self.down = self.up[columns], self.down[columns]
            self.upper, self.lower = self.upper[:, columns], self.lower[:, columns]

    def to(self, read: int) -> None:
        """Reads on until ``read`` entries of each list are read, from the top or the bottom as the weight's sign asks."""
        for weights, places, values in ((self.up, self.lists.places, self.lists.sorted), (self.down, self.lists.places[:, ::-1], self.lists.sorted[:, ::-1])):
            before, n = self.read, self.lists.n
            new_bound = values[:, min(read, n - 1)]  # no unread entry is better than the next one
            old_bound = values[:, before]
            self.upper += (weights @ (new_bound - old_bound))[None, :]
            for d in np.flatnonzero(weights.any(axis=0)):
                weight = weights[:, d][None, :]
                if before and new_bound[d] != old_bound[d]:  # what was read before is no bound any more
                    self.upper[places[d, :before]] -= (new_bound[d] - old_bound[d]) * weight
                run = places[d, before:read]
                self.upper[run] += (values[d, before:read] - new_bound[d])[:, None] * weight
                self.lower[run] += (values[d, before:read] - values[d, -1])[:, None] * weight
                self.entries += len(run) * int(np.count_nonzero(weight))
        self.read = read


class Best:
    """Queries' best scores over the blocks of one task: the k-th of them is where the next block's reading may stop."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.found = pd.DataFrame({"row": [], "vec_id": [], "score": []}, dtype="int64")

    def floor(self) -> np.ndarray:
        out = np.full(len(self.ids), -np.inf)
        full = self.found[self.found.groupby("row").cumcount() == self.k - 1]
        scores = full["score"].to_numpy()
        rounded = scores.astype(np.float64)
        out[full["row"].to_numpy()] = np.where(np.abs(scores) < 1 << 53, rounded, np.nextafter(rounded, -np.inf))
        return out

    def add(self, more: pd.DataFrame) -> None:
        both = pd.concat([self.found, more]).sort_values(["row", "score", "vec_id"], ascending=[True, False, True])
        self.found = both[both.groupby("row").cumcount() < self.k]

    def rows(self) -> pd.DataFrame:
        at = self.found["row"].to_numpy()
        return pd.DataFrame({"query_id": self.ids[at], "vec_id": self.found["vec_id"].to_numpy(), "score": self.found["score"].to_numpy()})


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """(vec_id, vector): floor(scale * component) of vectors without null or non-finite components, and with an id."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    whole = vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    grid = F.transform(vector, lambda x: F.floor(x * F.lit(scale)).cast("long"))
    own = F.col(f"`{id_col}`").cast("long").alias("vec_id")
    return df.filter(whole & F.col(f"`{id_col}`").isNotNull()).select(own, grid.alias("vector"))


def _blocks(spark: SparkSession, vectors: DataFrame, size: int) -> DataFrame:
    """(dim, block, ids, vectors): vectors of one length in blocks of about ``size``, as bytes in the order of ids."""
    vectors = written(spark, vectors.withColumn("dim", F.size("vector").cast("long")), "vectors")
    counts = vectors.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("long").alias("blocks"))
    dealt = vectors.join(written(spark, counts, "counts"), "dim").withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks"))

    def gather(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("vec_id", kind="stable")
        ids = group["vec_id"].to_numpy(dtype=np.int64).tobytes()
        body = np.array(group["vector"].to_list(), dtype=np.int64).tobytes()
        return pd.DataFrame([[group["dim"].iat[0], group["block"].iat[0], ids, body]], columns=["dim", "block", "ids", "vectors"])

    packed = dealt.select("dim", "block", "vec_id", "vector").groupBy("dim", "block")
    return written(spark, packed.applyInPandas(gather, "dim long, block long, ids binary, vectors binary"), "blocks")


def top_k(
    df: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best rows of ``df`` by integer inner product, never itself.

    Equal scores go to the smaller id. Vectors that are null or have a null or non-finite component, and
    rows without an id, take no part; only vectors of the query's own length are compared. A row that is
    in the table twice is two candidates with the same id; a query id that is there twice gets the best of
    both its vectors. Components whose products could leave 64 bits are an error. With fewer than ``k`` candidates all are given;
    with none, or an empty table, no rows.

    Candidates are dealt to blocks by a hash of their ids, queries too, and every block of queries is sent
    to every BLOCKS blocks of candidates: a stated query set against all rows. A task keeps these blocks
    and takes the blocks of queries one after another; what a query has found in one block bounds its reading of the next. It
    returns at most ``k`` rows a query, of which the best of all tasks are ranked.
    """
    spark = df.sparkSession
    left = _blocks(spark, quantised(df, id_col, vector_col), CANDIDATES)
    right = _blocks(spark, quantised(queries, id_col, vector_col), QUERIES)
    left = left.withColumn("to", F.floor(F.col("block") / BLOCKS).cast("long"))
    sizes = written(spark, left.groupBy("dim").agg(F.max("to").alias("last"), F.count_distinct("to").alias("n")), "sizes")
    tasks = max(1, sizes.agg(F.sum("n")).first()[0] or 1)
    sent = right.join(sizes, "dim").withColumn("to", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    columns = ["dim", "to", "is_query", "block", "ids", "vectors"]
    both = left.withColumn("is_query", F.lit(0)).select(*columns)
    both = both.unionByName(sent.withColumn("is_query", F.lit(1)).select(*columns))
    met = both.repartition(tasks, "dim", "to").sortWithinPartitions("dim", "to", "is_query", "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, lists = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                dim, to, is_query, _, ids, body = (c[row].as_py() for c in batch.columns)
                ids = np.frombuffer(ids, dtype=np.int64)
                body = np.frombuffer(body, dtype=np.int64).reshape(len(ids), dim)
                if at != (dim, to):
                    at, lists = (dim, to), []
                if not is_query:
                    lists.append(Lists(ids, body))
                    continue
                best = Best(ids, k)
                for block in lists:
                    best.add(block.best(ids, body, k, best.floor())[0])
                yield pa.RecordBatch.from_pandas(best.rows(), preserve_index=False)

    found = met.mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
