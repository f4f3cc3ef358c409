"""Exact top-k search by inner product with block-at-a-time pruning.

Vectors are lists of integer weights, one for each term (a place in the vector).
Rows are sorted by their strongest terms and dealt into shards, ranges of that
order; a shard is a run of blocks, and a block keeps its rows' weights as a
forward index, with the largest and smallest weight of each term in it. From these
comes the most that any row of a block can score for a query: the sum over terms
of the greater of weight times largest and weight times smallest.

Each query first visits the shard with the highest bound, which gives it a k-th
score to beat, and then only those other shards whose bounds reach that score.
In a shard it takes the blocks in the order of their bounds, a few and then
twice as many each time, and stops at the first whose bound falls below the k-th score
found so far. A bound equal to it goes on, as a row with a smaller id may
tie. The scores are exact, so the result is that of comparing all rows.

Queries go in blocks, and a block of queries meets a shard once; both have
bounded size. On vectors without any structure the bounds hold few blocks back, and
the work is that of comparing all, a block of rows by a block of queries at a time.

Defined results: vectors that are null or hold null or non-finite components take
no part. A shorter vector has no weight for the terms it lacks; empty and zero
vectors score 0. Rows of the query's own id are no candidates; of query rows with
one id, the one whose vector sorts first asks. Ties go to the smaller id, rows
with a null id come after all others that tie; repeated rows are candidates
each. With fewer candidates than asked for, all are returned; without queries or
rows the result is empty. Weights that no long holds are the nearest long. Scores
are decimals, as a long may not hold them. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tables import saved
from millrace.session import scratch_path

#: Rows of a block; rows of a shard, queries of a block and shards of a pack, on average.
BLOCK_ROWS, SHARD_ROWS, BLOCK_QUERIES, PACK_SHARDS = 64, 8192, 4096, 2048

SCALE = 1024
SCORE = T.DecimalType(38, 0)
#: Beyond this, scores are capped; two vectors of longs get there with a dozen components.
MOST = 10**38 - 1

BLOCKS = "shard int, ids array<long>, known array<boolean>, weights array<long>, high array<long>, low array<long>"
FOUND = "query_id long, id long, known boolean, score decimal(38,0)"


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def quantised(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector.cast(T.ArrayType(T.DoubleType())), lambda c: F.floor(c * scale).cast("long"))


def exact(queries: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """The matrices in a type in which the products of ``queries`` with the others are exact."""
    first, *rest = (float(np.abs(m.astype(np.float64)).max(initial=0)) + 1 for m in (queries, *others))
    most = first * max(rest) * max(queries.shape[1], 1)
    kind = np.float64 if most < 1 << 53 else np.int64 if most < 1 << 62 else object
    return tuple(m.astype(kind) for m in (queries, *others))


def bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The most a row between ``low`` and ``high`` can score, by query and block."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


def padded(lists: list, width: int) -> np.ndarray:
    """Vectors as a matrix; missing terms have no weight."""
    whole = np.zeros((len(lists), width), np.int64)
    for row, values in zip(whole, lists):
        row[: len(values)] = values[:width]
    return whole


def blocks(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """A shard's sorted rows as blocks; vectors of one length follow each other."""

    def block(shard: int, held: list[tuple]) -> pa.RecordBatch:
        ids, known, vectors = zip(*held)
        x = np.array(vectors, np.int64).reshape(len(held), -1)
        columns = [[shard], [list(ids)], [list(known)], [x.ravel()], [x.max(axis=0)], [x.min(axis=0)]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW
        )

    held: list[tuple] = []
    shard = 0
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("shard", "id", "known", "x"))
        for at, number, known, vector in zip(*columns):
            if held and (len(held) == rows or len(held[-1][2]) != len(vector)):
                yield block(shard, held)
                held = []
            shard = at
            held.append((number, known, vector))
    if held:
        yield block(shard, held)


LONGS = pa.list_(pa.int64())
ARROW = pa.schema(
    [("shard", pa.int32()), ("ids", LONGS), ("known", pa.list_(pa.bool_())), ("weights", LONGS), ("high", LONGS), ("low", LONGS)]
)


def empty(*columns: str) -> pd.DataFrame:
    return pd.DataFrame({c: [] for c in columns}, dtype=object)


class Best:
    """The k best rows of each query so far, and the score that the next must reach."""

    def __init__(self, beat: np.ndarray, k: int):
        self.k, self.beat = k, beat
        self.rows = empty("query", "id", "known", "score")

    def add(self, found: list[pd.DataFrame]) -> None:
        if not found:
            return
        # the frame is empty at first, and empty columns have no kind yet
        rows = pd.concat([self.rows, *found] if len(self.rows) else found, ignore_index=True)
        rows = rows.sort_values(
            ["query", "score", "known", "id"], ascending=[True, False, False, True], kind="stable"
        )
        place = rows.groupby("query").cumcount()
        self.rows = rows[place < self.k]
        last = self.rows[place[place < self.k] == self.k - 1]
        for query, score in zip(last["query"].astype(int), last["score"]):
            if self.beat[query] is None or score > self.beat[query]:
                self.beat[query] = score

    def reached(self, who: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """Which of the scores (a row for each of the queries ``who``) may be among the best."""
        few = np.array([self.beat[q] is None for q in who], bool)
        # what no score of this type reaches may not fit in it
        least = [0 if self.beat[q] is None else max(-(1 << 62), min(1 << 62, self.beat[q]))
                 if scores.dtype == np.int64 else self.beat[q] for q in who]
        return (scores >= np.array(least, scores.dtype)[:, None]).astype(bool) | few[:, None]


def thresholds(beat: pd.Series) -> np.ndarray:
    return np.array([None if b is None or b != b else int(b) for b in beat], object)


def visit(queries: pd.DataFrame, index: pd.DataFrame, k: int) -> tuple[pd.DataFrame, int]:
    """The best rows of one shard for a block of queries, and how many blocks all queries scored."""
    width = max(map(len, index["high"]))
    numbers = queries["query_id"].to_numpy()
    tops = [padded(list(index[c]), width) for c in ("high", "low")]
    asked, high, low = exact(padded(list(queries["x"]), width), *tops)
    best = Best(thresholds(queries["beat"]), k)
    limit = bounds(asked, high, low)
    order = np.argsort(-limit, axis=1, kind="stable")
    forward = [np.asarray(w, np.int64).reshape(len(i), -1).astype(asked.dtype) for w, i in zip(index["weights"], index["ids"])]
    ids = [np.asarray(i, np.int64) for i in index["ids"]]
    known = [np.asarray(i, bool) for i in index["known"]]
    active, done, step, scored = np.arange(len(numbers)), 0, 1, 0
    while done < len(index) and len(active):
        chosen = order[active, done : done + step]
        wanted = best.reached(active, np.take_along_axis(limit[active], chosen, axis=1))
        # bounds fall along a row, so a query whose next one is out of reach has finished
        found = []
        for block in np.unique(chosen[wanted]):
            who = active[((chosen == block) & wanted).any(axis=1)]
            rows = forward[block]
            scores = asked[who][:, : rows.shape[1]] @ rows.T
            scored += len(who)
            own = known[block][None, :] & (ids[block][None, :] == numbers[who][:, None])
            q, r = np.nonzero(best.reached(who, scores) & ~own)
            found.append(pd.DataFrame({
                "query": who[q], "id": ids[block][r], "known": known[block][r], "score": scores[q, r],
            }))
        best.add([f for f in found if len(f)])
        active = active[wanted[:, 0]]
        done += step
        step *= 2
    return best.rows, scored


def by_shard(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """The best rows for each query in each shard it visits."""

    def pair(queries: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(index):
            return empty("query_id", "id", "known", "score")
        rows, _ = visit(queries, index, k)
        at = rows["query"].astype(int).to_numpy()
        return pd.DataFrame({
            "query_id": queries["query_id"].to_numpy()[at],
            "id": rows["id"].astype("int64"),
            "known": rows["known"].astype(bool),
            "score": [decimal(s) for s in rows["score"]],
        })

    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInPandas(pair, FOUND)


def decimal(score) -> Decimal:
    return Decimal(max(-MOST, min(MOST, int(score))))


def reach(asked: DataFrame, summary: DataFrame, packs: int, rest: bool) -> DataFrame:
    """The shard of the highest bound in each pack, or (``rest``) all others that reach ``beat``."""

    def pair(queries: pd.DataFrame, shards: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(shards):
            return empty("query_id", "shard", "bound")
        shards = shards.sort_values("shard")
        width = max(map(len, shards["high"]))
        high, low = (padded(list(shards[c]), width) for c in ("high", "low"))
        x, high, low = exact(padded(list(queries["x"]), width), high, low)
        limit = bounds(x, high, low)
        numbers, names = queries["query_id"].to_numpy(), shards["shard"].to_numpy()
        if rest:
            open_ = Best(thresholds(queries["beat"]), 1).reached(np.arange(len(numbers)), limit)
            q, s = np.nonzero(open_ & (names[None, :] != queries["first"].to_numpy()[:, None]))
        else:
            q, s = np.arange(len(numbers)), limit.argmax(axis=1)
        return pd.DataFrame({"query_id": numbers[q], "shard": names[s], "bound": [decimal(b) for b in limit[q, s]]})

    def in_packs(df: DataFrame) -> DataFrame:
        return df.withColumn("pack", F.explode(F.sequence(F.lit(0), F.lit(packs - 1))))

    return (
        in_packs(asked).groupBy("block", "pack")
        .cogroup(summary.groupBy("block", "pack"))
        .applyInPandas(pair, "query_id long, shard int, bound decimal(38,0)")
    )


def search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score, the inner product of the floors of ``scale`` times the components."""
    spark = vectors.sparkSession
    folder = scratch_path(spark, "topk")

    def chosen(df: DataFrame) -> DataFrame:
        number = F.col(vec_id).cast("long")
        return df.where(usable(F.col(vector))).select(
            F.coalesce(number, F.lit(0)).alias("id"),
            number.isNotNull().alias("known"),
            quantised(F.col(vector), scale).alias("x"),
        )

    # -- the index: rows in the order of their strongest terms, as blocks of shards
    rows = saved(chosen(vectors), f"{folder}/rows")
    shards = max(1, -(-rows.count() // shard_rows))
    terms = {
        "_width": F.size("x"),
        "_most": F.array_position("x", F.array_max("x")),
        "_least": F.array_position("x", F.array_min("x")),
        "_stored": F.monotonically_increasing_id(),  # parts equal rows
    }
    keys = [*list(terms)[:3], "known", "id", "_stored"]
    ranged = rows.withColumns(terms).repartitionByRange(shards, *keys).sortWithinPartitions(*keys)
    ranged = ranged.select(F.spark_partition_id().alias("shard"), "id", "known", "x")
    index = saved(ranged.mapInArrow(lambda b: blocks(b, block_rows), BLOCKS), f"{folder}/index")

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        # a term that some vector lacks has weight 0 there
        width = max(map(len, pdf["high"]))
        high, low = (padded(list(pdf[c]), width) for c in ("high", "low"))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "high": [high.max(axis=0)], "low": [low.min(axis=0)]})

    summary = index.select("shard", "high", "low").groupBy("shard").applyInPandas(
        summed, "shard int, high array<long>, low array<long>"
    )
    summary = saved(summary, f"{folder}/summary")

    # -- the queries, in blocks
    one_each = chosen(queries).where("known").groupBy("id").agg(F.min("x").alias("x"))
    asked = saved(one_each.withColumnRenamed("id", "query_id"), f"{folder}/queries")
    many = max(1, -(-asked.count() // block_queries))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(many)).cast("int"))
    packs = max(1, -(-summary.count() // PACK_SHARDS))
    held = summary.withColumns(
        {"pack": F.pmod(F.xxhash64("shard"), F.lit(packs)).cast("int"), "block": F.explode(F.sequence(F.lit(0), F.lit(many - 1)))}
    )

    def of_visits(visits: DataFrame, path: str) -> DataFrame:
        saved(visits, path)
        pairs = spark.read.schema(visits.schema).parquet(path).select("shard", "block").distinct()
        return by_shard(spark.read.schema(visits.schema).parquet(path), index.join(pairs, "shard"), k)

    # -- first visits, to the most promising shard of all
    top = reach(asked, held, packs, rest=False).groupBy("query_id").agg(
        F.min_by("shard", F.struct((-F.col("bound")).alias("bound"), "shard")).alias("shard")
    )
    top = saved(top, f"{folder}/first")
    none = F.lit(None).cast(SCORE)
    first = asked.join(top, "query_id").withColumn("beat", none)
    found = saved(of_visits(first, f"{folder}/visits-first"), f"{folder}/found-first")

    # -- then those that can still hold better rows
    by_score = F.sort_array(F.collect_list("score"), asc=False)
    beat = found.groupBy("query_id").agg(F.get(by_score, F.lit(k - 1)).alias("beat"))
    asked = asked.join(top.withColumnRenamed("shard", "first"), "query_id").join(beat, "query_id", "left")
    asked = saved(asked, f"{folder}/thresholds")
    others = reach(asked, held, packs, rest=True).select("query_id", "shard")
    others = asked.join(others, "query_id")
    whole = found.unionByName(of_visits(others, f"{folder}/visits-others"))

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("known"), "id")
    ranked = whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.when(F.col("known"), F.col("id")).alias("vec_id"), "score")
