"""Approximate nearest neighbours by a forest of hash prefixes.

Every vector gets one long bit string per tree: the signs of its projections on
random directions. Rows are dealt into shards of bounded size; a shard holds,
for each tree, the sorted array of its rows' strings. Queries, in blocks, visit
every shard. There, a query finds in each tree the longest prefix that it
shares with any row, and then all trees ascend together, one bit at a time,
until the rows whose prefixes match in some tree are ``share`` of the shard, or
``least`` rows if that is more. These candidates are compared with the query
exactly, and the best of all shards stay.

Every row is indexed. ``share`` is what recall depends on: vectors without any
structure, which are the hardest, need about half of the rows for nineteen in twenty
neighbours; clustered ones find theirs in the first, long prefixes whatever the
share.

Defined results: null and zero vectors, and vectors with null or non-finite
components, take no part; vectors of another length than a query's are no
neighbours of it; ties go to the smaller id; repeated rows are candidates each,
but rows of the query's own id are not; of query rows with one id, the one
whose vector sorts first asks; with fewer candidates than asked for,
all are returned; without queries or rows the result is empty. Other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tables import saved
from millrace.session import scratch_path

#: Trees, bits of a string, and the seed of their directions.
TREES, BITS, SEED = 64, 24, 20240607
#: Rows of a shard and queries of a block, on average.
SHARD_ROWS, BLOCK_QUERIES = 16384, 16384
#: Candidates a query compares with in a shard: this share of its rows, and this many at least.
SHARE, LEAST = 0.5, 64

NEIGHBOURS = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Whether a vector can take part."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def strings(vectors: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """The bit strings of vectors, one row for each tree."""
    directions = np.random.default_rng(SEED).standard_normal((vectors.shape[1], trees * bits))
    signs = (vectors @ directions > 0).reshape(len(vectors), trees, bits)
    weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
    return np.ascontiguousarray((signs @ weights).T)


class Forest:
    """The sorted arrays of one shard's strings."""

    def __init__(self, vectors: np.ndarray, trees: int, bits: int):
        self.size, self.trees, self.bits = len(vectors), trees, bits
        own = strings(vectors, trees, bits)
        self.order = np.argsort(own, axis=1, kind="stable")
        self.sorted = np.take_along_axis(own, self.order, axis=1)

    def ranges(self, query: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """For each tree, the rows that share ``depth`` bits with a query's strings."""
        shift = self.bits - depth
        low = query >> shift << shift
        high = low + (1 << shift)
        return (
            np.array([np.searchsorted(s, x) for s, x in zip(self.sorted, low)]),
            np.array([np.searchsorted(s, x) for s, x in zip(self.sorted, high)]),
        )

    def candidates(self, query: np.ndarray, wanted: int) -> np.ndarray:
        """Rows that share the longest prefixes with a query, ``wanted`` or all."""
        if wanted >= self.size:
            return np.arange(self.size)
        # The first depth, from the longest match upwards, at which the trees have enough rows
        # together; a row counts once for each tree, so this is where ascending may begin to stop.
        low, high = 0, self.bits
        while low < high:
            middle = (low + high + 1) // 2
            start, end = self.ranges(query, middle)
            low, high = (middle, high) if (end - start).sum() >= wanted else (low, middle - 1)
        for depth in range(low, -1, -1):
            start, end = self.ranges(query, depth)
            found = np.zeros(self.size, bool)
            for tree, (a, b) in enumerate(zip(start, end)):
                found[self.order[tree, a:b]] = True
            if found.sum() >= wanted:
                return np.flatnonzero(found)
        return np.arange(self.size)


def nearest(
    queries: pd.DataFrame, rows: pd.DataFrame, k: int, share: float, least: int, trees: int, bits: int
) -> pd.DataFrame:
    """The k best candidates of a shard for each query of a block."""
    found = []
    for width, own in rows.groupby(rows["vector"].map(len)):
        asked = queries[queries["vector"].map(len) == width]
        if not len(asked):
            continue
        vectors = np.array(own["vector"].tolist(), np.float64)
        ids = own["id"].to_numpy()
        forest = Forest(vectors, trees, bits)
        at = np.array(asked["vector"].tolist(), np.float64)
        wanted = max(least, k + 1, int(np.ceil(share * len(own))))
        for number, query, marks in zip(asked["id"], at, strings(at, trees, bits).T):
            some = forest.candidates(marks, wanted)
            some = some[ids[some] != number]
            score = np.sqrt(((vectors[some] - query) ** 2).sum(axis=1))
            best = some[np.lexsort((ids[some], score))[:k]] if len(some) else some
            score = np.sqrt(((vectors[best] - query) ** 2).sum(axis=1))
            found.append(pd.DataFrame({"query_id": number, "vec_id": ids[best], "score": score}))
    empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
    return pd.concat(found or [empty]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    share: float = SHARE,
    least: int = LEAST,
    trees: int = TREES,
    bits: int = BITS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score, the Euclidean distance."""
    spark = vectors.sparkSession

    def chosen(df: DataFrame) -> DataFrame:
        return df.where(F.col(vec_id).isNotNull()).select(
            F.col(vec_id).cast("long").alias("id"),
            F.col(vector).cast(T.ArrayType(T.DoubleType())).alias("vector"),
        ).where(usable(F.col("vector")))

    folder = scratch_path(spark, "ann")
    rows = saved(chosen(vectors), f"{folder}/rows")
    one_each = chosen(queries).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = saved(one_each, f"{folder}/queries")
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    # Repeated ids are spread too: rows are dealt by all they hold.
    sharded = rows.withColumn("shard", F.pmod(F.xxhash64("id", "vector"), F.lit(shards)))
    visits = asked.withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks))).withColumn(
        "shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>"))
    )

    def visit(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return nearest(left, right, k, share, least, trees, bits)

    # Each block of queries meets each shard of rows once; both are of bounded size.
    held = sharded.withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>"))
    )
    found = (
        visits.groupBy("shard", "block")
        .cogroup(held.groupBy("shard", "block"))
        .applyInPandas(visit, NEIGHBOURS)
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
