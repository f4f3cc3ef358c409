"""Toxicity by maximum-scoring segments of token log-odds.

A token is a word; its features are the word itself and its first few bytes,
so that compounds share evidence. For every feature, hashed to a bounded number
of buckets, the log-odds between toxic and other texts are estimated with an
informative Dirichlet prior, and lowered by their standard error. A text
counts once for each of its features, and of texts with one label that agree in
all of ``MINIMA`` smallest hashes of three words, which are copies, one is
counted; texts of fewer words are copies if they are equal. A token
scores the most that any of its features is surely worth; a token without
evidence costs a fixed amount, so that chance segments of clean text score
below zero on average.

A linear-time scan finds all maximal scoring segments of a text. Under the
extreme-value law of such scores, a segment of score S in a text of n tokens is
worth lambda S - ln(K n): lambda solves the moment equation over clean tokens,
K follows from the clean texts' best scores. Segments worth more than
``SIGNIFICANT`` are toxic passages. A text's score is a logistic function of
what they are worth together, fitted on either half of the labelled texts with
weights from the other.

Defined results: null and empty texts have no passages and get the score of
none; without labelled rows of both kinds every score is the share of toxic
ones (0 without any); very long texts are scanned whole; repeated rows are
scored once each, and of a labelled id's texts one teaches; a document labelled twice is toxic if one label says so;
null ids and labels teach nothing; an empty table gives no rows. Columns other
than id and text are no input of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.tables import saved, slices
from millrace.llm.words import mixed, word_hashes
from millrace.session import scratch_path

#: Labelled rows the model is fitted on, at most: one text of each of the ids that hash lowest.
SAMPLE_ROWS = 20_000
#: Buckets of features, a power of two; bytes of a word's heads.
BUCKETS, HEADS = 1 << 22, (4, 5, 6, 8)
#: Weight of the prior as a share of all counts, and standard errors taken off.
PRIOR, ERRORS = 0.1, 1.5
#: What a token without evidence costs, and what a segment must be worth.
COST, SIGNIFICANT = 0.25, 1.0
EULER = 0.5772156649
#: Independent orders of three-word runs, in which copies have the same smallest one.
MINIMA = 8
GAPS = np.ones(256, bool)
GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
PASSAGES = "array<struct<start:int,end:int,worth:double>>"


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # per bucket, 0 where nothing speaks for toxicity
    scale: float
    factor: float  # K
    slope: float
    offset: float
    constant: float | None = None


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every token's features, and the number of its text."""
    whole, doc, *heads = word_hashes(texts, GAPS, HEADS)
    rows = np.stack([whole, *heads])
    return (rows & np.uint64(BUCKETS - 1)).astype(np.int64), doc


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments: start, end (exclusive) and score, in order.

    Only tokens above zero can begin or end one, so the scan steps from one to
    the next. Each candidate keeps the place of the last one whose sum before
    it is lower; following these links makes the scan linear.
    """
    places = np.flatnonzero(scores > 0)
    if not len(places):
        return []
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, before, after, link
    for at in places.tolist():
        start, end, low, high = at, at + 1, float(sums[at]), float(sums[at + 1])
        while True:
            link = len(stack) - 1
            while link >= 0 and stack[link][2] >= low:
                link = stack[link][4]
            if link < 0 or stack[link][3] >= high:
                stack.append((start, end, low, high, link))
                break
            start, low = stack[link][0], stack[link][2]
            del stack[link:]
    return [(start, end, high - low) for start, end, low, high, _ in stack]


def judged(buckets: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float]]:
    """The maximal segments of a text, from its tokens' features."""
    if not buckets.shape[1]:
        return []
    best = weights[buckets].max(axis=0).astype(np.float64)
    return segments(np.where(best > 0, best, -COST))


def worth(tokens: int, found: list, scale: float, factor: float) -> list[float]:
    base = np.log(factor * max(tokens, 1))
    return [scale * score - base for _, _, score in found]


def together(values: list[float]) -> float:
    return float(np.log1p(sum(v for v in values if v > SIGNIFICANT)))


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, toxic, half (0 or 1) and text of a bounded sample of the labelled documents."""
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(SAMPLE_ROWS)
    )  # SAMPLE_ROWS short rows, which bounds the broadcast
    texts = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    half = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int")
    one_each = (
        texts.join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("first"))
    )  # combined before the shuffle, whatever rows an id has
    return one_each.select("doc_id", "toxic", half.alias("half"), "first.text")


def by_text(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The features of each text of a batch."""
    buckets, doc = features(batch.column("text"))
    edges = np.searchsorted(doc, np.arange(batch.num_rows + 1))
    for start, end in zip(edges[:-1], edges[1:]):
        yield buckets[:, start:end]


def copy_key(words: np.ndarray) -> int:
    """What copies have in common: their smallest three-word hashes in ``MINIMA`` orders."""
    words = words.astype(np.uint64)
    if len(words) < 3:
        found = words
    else:
        runs = mixed((words[:-2] << np.uint64(42)) ^ (words[1:-1] << np.uint64(21)) ^ words[2:])
        orders = mixed(np.arange(1, MINIMA + 1, dtype=np.uint64))
        found = np.array([mixed(runs ^ order).min() for order in orders])
    key = np.full(1, len(found), np.uint64)
    for value in found:
        key = mixed(key ^ value)
    return int(key[0] >> np.uint64(1))


def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, toxic and the key that copies share."""
    for batch in slices(batches, "text"):
        keys = [copy_key(own[0]) for own in by_text(batch)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("toxic"), pa.array(keys, pa.int64())],
            ["doc_id", "toxic", "key"],
        )


COUNTS = ("toxic0", "other0", "toxic1", "other1")


def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts that have a feature, by bucket, half and label."""
    totals = np.zeros((4, BUCKETS), np.int32)
    for batch in slices(batches, "text"):
        kinds = zip(batch.column("half").to_pylist(), batch.column("toxic").to_pylist())
        for own, (half, toxic) in zip(by_text(batch), kinds):
            totals[2 * half + (not toxic), np.unique(own)] += 1
    some = np.flatnonzero(totals.any(axis=0))
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), *(pa.array(row[some].astype(np.int64)) for row in totals)],
        ["bucket", *COUNTS],
    )


def log_odds(toxic: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Log-odds of features with an informative Dirichlet prior, less their standard error."""
    prior = PRIOR * (toxic + other)
    mine, theirs = toxic + prior, other + prior
    used = toxic + other > 0
    mine, theirs = np.where(used, mine, 1.0), np.where(used, theirs, 1.0)
    ratio = np.log(mine / (mine.sum() - mine)) - np.log(theirs / (theirs.sum() - theirs))
    sure = ratio - ERRORS * np.sqrt(1 / mine + 1 / theirs)
    return np.where(used & (sure > 0), sure, 0.0).astype(np.float32)


def scale_of(hits: np.ndarray, misses: int) -> float:
    """The positive solution of mean(exp(lambda s)) = 1 over clean tokens' scores.

    These are those of ``hits``, and ``-COST`` for each of the ``misses``.
    """
    low, high = 1e-6, 1.0
    mean = lambda x: (
        np.exp(np.minimum(x * hits, 700)).sum() + misses * np.exp(-x * COST)
    ) / (len(hits) + misses)
    while mean(high) < 1 and high < 256:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if mean(middle) < 1 else (low, middle)
    return (low + high) / 2


def logistic(values: np.ndarray, toxic: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a ridge-bound logistic fit, by Newton's method."""
    x = np.stack([values, np.ones(len(values))], axis=1)
    theta = np.zeros(2)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve(
            x.T @ (x * (p * (1 - p))[:, None]) + 0.05 * np.eye(2), x.T @ (toxic - p) - 0.05 * theta
        )
        theta += step
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), float(theta[1])


def train(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text"
) -> Model:
    """A model from ``labels`` (doc_id and toxic) of ``docs``."""
    spark = docs.sparkSession
    rows = saved(sample(docs, labels, doc_id, text), scratch_path(spark, "toxicity"))
    shares = rows.agg(F.count("*"), F.sum(F.col("toxic").cast("int"))).first()
    if not shares[0] or not shares[1] or shares[0] == shares[1]:
        nothing = np.zeros(BUCKETS, np.float32)
        return Model(nothing, 1.0, 1.0, 0.0, 0.0, (shares[1] or 0) / max(shares[0], 1))
    keyed = rows.select("doc_id", "toxic", "text").mapInArrow(
        copies, "doc_id long, toxic boolean, key long"
    )
    one_each = keyed.groupBy("key", "toxic").agg(F.min("doc_id").alias("doc_id"))
    counted = (
        rows.join(F.broadcast(one_each.select("doc_id").distinct()), "doc_id")  # of SAMPLE_ROWS
        .select("toxic", "half", "text")
        .mapInArrow(count, "bucket long, " + ", ".join(f"{name} long" for name in COUNTS))
        .groupBy("bucket")
        .agg(*(F.sum(name).alias(name) for name in COUNTS))
        .toArrow()
    )  # BUCKETS rows at most
    totals = np.zeros((4, BUCKETS))
    at = counted.column("bucket").to_numpy()
    for n, name in enumerate(COUNTS):
        totals[n, at] = counted.column(name).to_numpy()
    weights = log_odds(totals[0] + totals[2], totals[1] + totals[3])
    # texts of one half are judged by the other
    shared = spark.sparkContext.broadcast((log_odds(totals[2], totals[3]), log_odds(totals[0], totals[1])))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for own, half in zip(by_text(batch), batch.column("half").to_pylist()):
                rows.append((own.shape[1], judged(own, shared.value[half])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("toxic"),
                    pa.array([n for n, _ in rows], pa.int64()),
                    pa.array([sum(e - s for s, e, _ in f) for _, f in rows], pa.int64()),
                    pa.array([[s for _, _, s in f] for _, f in rows], pa.list_(pa.float64())),
                ],
                ["toxic", "tokens", "inside", "scores"],
            )

    seen = rows.select("toxic", "half", "text").mapInArrow(
        found, "toxic boolean, tokens long, inside long, scores array<double>"
    ).collect()  # SAMPLE_ROWS at most
    clean = [r for r in seen if not r["toxic"]]
    # One unseen token of the mean weight keeps lambda finite where clean text has no evidence at all.
    hits = [s for r in clean for s in r["scores"]] + [float(weights[weights > 0].mean()) if (weights > 0).any() else 1.0]
    misses = max(sum(r["tokens"] - r["inside"] for r in clean), 1)
    scale = scale_of(np.array(hits), misses)
    best = [scale * max(r["scores"], default=0.0) - np.log(max(r["tokens"], 1)) for r in clean]
    factor = float(np.exp(np.mean(best) - EULER)) if best else 1.0
    values = np.array(
        [together(worth(r["tokens"], [(0, 0, s) for s in r["scores"]], scale, factor)) for r in seen]
    )
    slope, offset = logistic(values, np.array([float(r["toxic"]) for r in seen]))
    return Model(weights, scale, factor, slope, offset)


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, score (0 to 1) and passages (first and end word, worth)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("worth", pa.float64())]))
        for batch in slices(batches, "text"):
            scores, shown = [], []
            for buckets in by_text(batch):
                tokens, found = buckets.shape[1], judged(buckets, own.weights)
                values = worth(tokens, found, own.scale, own.factor)
                shown.append(
                    [
                        {"start": s, "end": e, "worth": v}
                        for (s, e, _), v in zip(found, values)
                        if v > SIGNIFICANT
                    ]
                )
                x = own.slope * together(values) + own.offset
                scores.append(1 / (1 + np.exp(-np.clip(x, -30, 30))) if own.constant is None else own.constant)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(shown, kind)],
                ["doc_id", "score", "passages"],
            )

    chosen = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return chosen.mapInArrow(run, f"doc_id long, score double, passages {PASSAGES}")
