"""Interpolated modified Kneser-Ney bigram model, and the texts' log probabilities under it.

Words, and the end of a text, are counted in Spark: tasks send sorted counts of
their own, by ranges of a hash, and each range is merged and written as sorted
arrays to the shared folder. Workers map the arrays into memory and look up
sorted batches, so that a lookup reads neighbouring pages.

- words: sorted hashes and their counts. A word's number is its place.
- bigrams: sorted pairs of word numbers and their counts, in parts by the first
  word. A first word with more than ``HOT`` occurrences is spread over all
  parts by the second.
- contexts: for each word, how many different words follow it once, twice and
  more often, and how many different words precede it.

p(w|v) = (c(vw) - D(c(vw))) / c(v) + g(v) p(w), where p(w) is the same
over the numbers of different words before w, and at last uniform over all
known words and one for all unknown ones. D are the discounts of the modified
method, from the counts of counts.

Defined results: a null or empty text is one token, its end; unknown words have
the probability of the one unknown word; after an unknown word the lower order
alone counts; very long texts are scored whole; repeated rows count and are
scored once each; without training texts every token is the unknown word; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import mapped, put
from millrace.llm.tables import slices
from millrace.llm.words import mixed, word_hashes
from millrace.session import scratch_path

#: Tokens a task gathers before it hands their counts on, and tokens of a part.
CHUNK, PART = 1 << 20, 1 << 21
#: Occurrences from which a first word's bigrams are spread over all parts.
HOT = 1 << 17
END, START = np.uint64(0xE17A1465), np.uint64(0x57A27)
UNKNOWN = np.int64(-1)
ADDED = 0.1  # of the base score
DEFAULT_DISCOUNTS = (0.5, 1.0, 1.5)


def parted(hashes: np.ndarray, parts: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def rows_of(part: np.ndarray, parts: int, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Columns, sorted by part, as a row of bytes for each part.

    Bytes of one place lie together, which packs sorted numbers well.
    """
    edges = np.searchsorted(part, np.arange(parts + 1))
    used = np.flatnonzero(np.diff(edges))
    arrays = [pa.array(used, pa.int32())]
    for column in columns.values():
        planes = column.view(np.uint8).reshape(len(column), -1)
        arrays.append(pa.array([planes[edges[n] : edges[n + 1]].T.tobytes() for n in used], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["part", *columns])


def unpacked(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def joined(frame: pd.DataFrame, name: str, kind: type) -> np.ndarray:
    return np.concatenate([unpacked(data, kind) for data in frame[name]])


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return keys, *(c.astype(np.int64) for c in counts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[starts], *(np.add.reduceat(c[order].astype(np.int64), starts) for c in counts)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The words and the end of every text, in order, and where each text begins, with the end."""
    words, doc = word_hashes(texts)
    count = np.bincount(doc, minlength=len(texts)).astype(np.int64)
    edges = np.r_[0, np.cumsum(count + 1)]
    found = np.full(edges[-1], END, np.uint64)
    found[np.arange(len(words)) + doc] = words
    return found, edges


def gathered(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple]:
    """Batches of about CHUNK tokens: tokens, edges of texts, and the record batches."""
    held, found, n = [], [], 0
    for batch in slices(batches, text):
        own, edges = tokens(batch.column(text))
        held.append(batch)
        found.append((own, edges))
        n += len(own)
        if n > CHUNK:
            yield together(found, held)
            held, found, n = [], [], 0
    if held:
        yield together(found, held)


def together(found: list[tuple], held: list[pa.RecordBatch]) -> tuple:
    sizes = np.concatenate([np.diff(edges) for _, edges in found])
    return np.concatenate([own for own, _ in found]), np.r_[0, np.cumsum(sizes)], held


def before(values: np.ndarray, edges: np.ndarray, first) -> np.ndarray:
    """For each token the one before it; ``first`` for a text's first."""
    found = np.empty_like(values)
    found[1:] = values[:-1]
    found[edges[:-1]] = first
    return found


def count_words(batches: Iterator[pa.RecordBatch], parts: int) -> Iterator[pa.RecordBatch]:
    for found, _, _ in gathered(batches, "text"):
        word, n = np.unique(found, return_counts=True)
        yield rows_of(parted(word, parts), parts, {"word": word, "n": n.astype(np.uint32)})


@dataclass(frozen=True)
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    folder: str
    word_parts: tuple[int, ...]  # words before each part, and all
    pair_parts: int
    tokens: int
    texts: int
    discounts: tuple[float, float, float] = DEFAULT_DISCOUNTS
    lower_discounts: tuple[float, float, float] = DEFAULT_DISCOUNTS
    before_total: int = 0
    lower_rest: float = 1.0
    hot: int = HOT

    @property
    def parts(self) -> int:
        return len(self.word_parts) - 1

    @property
    def words(self) -> int:
        return self.word_parts[-1]

    @cached_property
    def arrays(self) -> dict[tuple[str, int], np.ndarray]:
        return {}

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "arrays"}

    def array(self, name: str, part: int, kind: type) -> np.ndarray:
        key = (name, part)
        if key not in self.arrays:
            self.arrays[key] = mapped(f"{self.folder}/{name}", str(part), kind)
        return self.arrays[key]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The numbers of words, given by sorted hashes."""
        found = np.full(len(hashes), UNKNOWN)
        edges = np.searchsorted(parted(hashes, self.parts), np.arange(self.parts + 1))
        for part in np.flatnonzero(np.diff(edges)):
            own, have = hashes[edges[part] : edges[part + 1]], self.array("words", part, np.uint64)
            at = np.searchsorted(have, own)
            hit = at < len(have)
            hit[hit] = have[at[hit]] == own[hit]
            found[edges[part] : edges[part + 1]][hit] = at[hit] + self.word_parts[part]
        return found

    def of_words(self, name: str, numbers: np.ndarray, kind: type = np.uint32) -> np.ndarray:
        """A figure of words, given by sorted numbers; zero for unknown ones."""
        found = np.zeros(len(numbers), np.int64)
        edges = np.searchsorted(numbers, self.word_parts)
        for part in np.flatnonzero(np.diff(edges)):
            own = numbers[edges[part] : edges[part + 1]] - self.word_parts[part]
            found[edges[part] : edges[part + 1]] = self.array(name, part, kind)[own]
        return found

    def pair_part(self, pairs: np.ndarray, count: np.ndarray) -> np.ndarray:
        """The part of pairs, from the counts of their first words."""
        first = pairs >> np.uint64(32)
        return parted(mixed(np.where(count > self.hot, pairs, first)), self.pair_parts)

    def pair_counts(self, pairs: np.ndarray, count: np.ndarray) -> np.ndarray:
        part = self.pair_part(pairs, count)
        order = np.lexsort((pairs, part))
        edges = np.searchsorted(part[order], np.arange(self.pair_parts + 1))
        found = np.zeros(len(pairs), np.int64)
        for n in np.flatnonzero(np.diff(edges)):
            own = order[edges[n] : edges[n + 1]]
            have = self.array("pairs", n, np.uint64)
            at = np.searchsorted(have, pairs[own])
            hit = at < len(have)
            hit[hit] = have[at[hit]] == pairs[own[hit]]
            found[own[hit]] = self.array("pair-counts", n, np.uint32)[at[hit]]
        return found


#: The start of a text as a context: a number no word has.
START_NUMBER = np.int64((1 << 32) - 1)


def numbered(model: Model, found: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct tokens' numbers and counts, and the place of each token among them."""
    word, place = np.unique(found, return_inverse=True)
    number = model.numbers(word)
    order = np.argsort(number, kind="stable")
    count = np.empty(len(number), np.int64)
    count[order] = model.of_words("counts", number[order])
    return number, count, place


def count_pairs(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for found, edges, _ in gathered(batches, "text"):
        number, count, place = numbered(model, found)
        first = before(number[place], edges, START_NUMBER)
        often = before(count[place], edges, model.texts)
        pair = first.astype(np.uint64) << np.uint64(32) | number[place].astype(np.uint64)
        order = np.argsort(pair, kind="stable")
        pair, often = pair[order], often[order]
        starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]])
        n = np.diff(np.r_[starts, len(pair)]).astype(np.uint32)
        pair, part = pair[starts], model.pair_part(pair[starts], often[starts])
        order = np.argsort(part, kind="stable")
        yield rows_of(part[order], model.pair_parts, {"pair": pair[order], "n": n[order]})


def merge_pairs(frame: pd.DataFrame, model: Model) -> pd.DataFrame:
    """Writes one part's pairs; gives what they say of first and of second words."""
    part = int(frame["part"].iloc[0])
    pair, n = summed(joined(frame, "pair", np.uint64), joined(frame, "n", np.uint32))
    put(f"{model.folder}/pairs", str(part), pair)
    put(f"{model.folder}/pair-counts", str(part), n.astype(np.uint32))
    first, second = (pair >> np.uint64(32)).astype(np.int64), (pair & np.uint64(0xFFFFFFFF)).astype(np.int64)
    one, two, more = (n == 1), (n == 2), (n > 2)
    context = summed(first, one, two, more)
    ended = summed(second, np.ones(len(second)))
    rows = []
    for keys, figures in ((context[0], context[1:]), (ended[0], (*ended[1:],))):
        kind = "first" if len(figures) == 3 else "second"
        at_start = keys == START_NUMBER
        part_of = np.searchsorted(model.word_parts, keys, side="right") - 1
        part_of[at_start] = model.parts
        edges = np.searchsorted(part_of, np.arange(model.parts + 2))
        for p in np.flatnonzero(np.diff(edges)):
            own = slice(edges[p], edges[p + 1])
            packed = [f[own].astype(np.uint32).tobytes() for f in figures]
            rows.append((p, kind, keys[own].tobytes(), *packed, *[b""] * (3 - len(packed)), 0, 0, 0, 0))
    counts = [int((n == k).sum()) for k in (1, 2, 3, 4)]
    rows.append((-1, "pairs", b"", b"", b"", b"", *counts))
    return pd.DataFrame(rows, columns=FIGURES)


FIGURES = ["part", "kind", "keys", "f1", "f2", "f3", "n1", "n2", "n3", "n4"]
FIGURE_TYPES = "part int, kind string, keys binary, f1 binary, f2 binary, f3 binary, n1 long, n2 long, n3 long, n4 long"


def merge_figures(frame: pd.DataFrame, model: Model) -> pd.DataFrame:
    """Writes the figures of one part's words; gives sums over them."""
    part = int(frame["part"].iloc[0])
    if part == -1:
        return pd.DataFrame([("pairs", *(int(frame[f"n{k}"].sum()) for k in (1, 2, 3, 4)), 0)], columns=SUMS)
    low, high = (START_NUMBER, START_NUMBER + 1) if part == model.parts else model.word_parts[part : part + 2]
    size = int(high - low)
    figures = {name: np.zeros(size, np.int64) for name in ("once", "twice", "often", "before")}
    for row in frame.itertuples(index=False):
        at = np.frombuffer(row.keys, np.int64) - low
        names = ("once", "twice", "often") if row.kind == "first" else ("before",)
        for name, data in zip(names, (row.f1, row.f2, row.f3)):
            figures[name][at] += np.frombuffer(data, np.uint32)
    for name, values in figures.items():
        put(f"{model.folder}/{name}", str(part), values.astype(np.uint32))
    own = figures["before"]
    return pd.DataFrame([("words", *(int((own == k).sum()) for k in (1, 2, 3, 4)), int(own.sum()))], columns=SUMS)


SUMS = ["kind", "n1", "n2", "n3", "n4", "total"]


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Discounts of counts of one, two, and three or more, from the counts of counts.

    Where there are too few counts for the formula, fixed ones are taken.
    """
    if not (n1 and n2 and n3):
        return DEFAULT_DISCOUNTS
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(d if 0 < d <= k else default for k, d, default in zip((1, 2, 3), found, DEFAULT_DISCOUNTS))


def train(
    texts: DataFrame, text: str = "text", folder: str | None = None, hot: int = HOT
) -> Model:
    """Count ``texts`` and write the model's arrays to ``folder``, by default a scratch folder."""
    spark = texts.sparkSession
    folder = folder or scratch_path(spark, "lm")
    texts = texts.select(F.col(text).cast("string").alias("text"))
    # Bytes of text bound the tokens; parts are sized by them, not capped.
    size = texts.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    parts = max(8, -(-(size[0] or 0) // (6 * PART)))

    def merge_words(frame: pd.DataFrame) -> pd.DataFrame:
        word, n = summed(joined(frame, "word", np.uint64), joined(frame, "n", np.uint32))
        part = int(frame["part"].iloc[0])
        put(f"{folder}/words", str(part), word)
        put(f"{folder}/counts", str(part), n.astype(np.uint32))
        return pd.DataFrame({"part": [part], "words": [len(word)], "tokens": [int(n.sum())]})

    counted = texts.mapInArrow(partial(count_words, parts=parts), "part int, word binary, n binary")
    merged = counted.groupBy("part").applyInPandas(merge_words, "part int, words long, tokens long").collect()
    sizes = np.zeros(parts, np.int64)
    for row in merged:  # one row a part
        sizes[row["part"]] = row["words"]
    places = tuple(int(n) for n in np.r_[0, np.cumsum(sizes)])
    model = Model(folder, places, parts, sum(row["tokens"] for row in merged), size[1], hot=hot)
    if not model.texts:
        return model

    pairs = texts.mapInArrow(partial(count_pairs, model=model), "part int, pair binary, n binary")
    figures = pairs.groupBy("part").applyInPandas(lambda frame: merge_pairs(frame, model), FIGURE_TYPES)
    sums = (
        figures.groupBy("part")
        .applyInPandas(lambda frame: merge_figures(frame, model), "kind string, n1 long, n2 long, n3 long, n4 long, total long")
        .groupBy("kind")
        .agg(*(F.sum(name).alias(name) for name in SUMS[1:]))
        .collect()
    )
    by_kind = {row["kind"]: row for row in sums}
    pair, word = by_kind["pairs"], by_kind["words"]
    lower = discounts(*(word[f"n{k}"] for k in (1, 2, 3, 4)))
    kinds = (word["n1"], word["n2"], model.words - word["n1"] - word["n2"])
    return Model(
        folder, places, parts, model.tokens, model.texts,
        discounts(*(pair[f"n{k}"] for k in (1, 2, 3, 4))), lower, word["total"],
        sum(d * n for d, n in zip(lower, kinds)) / word["total"], hot,
    )


def discounted(count: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.maximum(count - np.r_[0.0, by][np.minimum(count, 3)], 0.0)


def probabilities(model: Model, found: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probability of each token, and its count in training."""
    number, count, place = numbered(model, found)
    order = np.argsort(number, kind="stable")

    def figure(name: str) -> np.ndarray:
        values = np.empty(len(number), np.int64)
        values[order] = model.of_words(name, number[order])
        return values

    if not model.texts:
        return np.ones(len(found)), count[place]
    lower = discounted(figure("before"), model.lower_discounts) / model.before_total
    lower = (lower + model.lower_rest / (model.words + 1))[place]
    at_start = {name: model.array(name, model.parts, np.uint32)[0] for name in ("once", "twice", "often")}
    once, twice, often = (
        before(figure(name)[place], edges, at_start[name]) for name in ("once", "twice", "often")
    )
    first = before(number[place], edges, START_NUMBER)
    total = before(count[place], edges, model.texts)
    both = np.zeros(len(found), np.int64)
    known = (first >= 0) & (number[place] >= 0)
    pair = first[known].astype(np.uint64) << np.uint64(32) | number[place][known].astype(np.uint64)
    unique, index, back = np.unique(pair, return_index=True, return_inverse=True)
    both[known] = model.pair_counts(unique, total[known][index])[back]
    d1, d2, d3 = model.discounts
    seen = np.maximum(total, 1)
    rest = np.where(total > 0, (d1 * once + d2 * twice + d3 * often) / seen, 1.0)
    return discounted(both, model.discounts) / seen + rest * lower, count[place]


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_tokens, n_known, base_score and score, both sums of log10."""
    kinds = "doc_id long, n_tokens long, n_known long, base_score double, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found, edges, held in gathered(batches, "text"):
            chance, count = probabilities(model, found, edges)
            base = np.log10((count + ADDED) / (model.tokens + ADDED * (model.words + 1)))
            starts = edges[:-1]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([batch.column(0) for batch in held]),
                    pa.array(np.diff(edges)),
                    pa.array(np.add.reduceat((count > 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(base, starts)),
                    pa.array(np.add.reduceat(np.log10(chance), starts)),
                ],
                [field.split()[0] for field in kinds.split(", ")],
            )

    chosen = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")
    )
    return chosen.mapInArrow(run, kinds)
