"""Language models, toxicity and nearest neighbours against plain versions."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm import ann, lm, toxicity

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


# --- language model


class Plain:
    """The same model with dictionaries."""

    def __init__(self, texts):
        rows = [self.tokens(t) for t in texts]
        self.words = Counter(w for row in rows for w in row)
        self.pairs = Counter(p for row in rows for p in zip([None, *row], row))
        self.total, self.after, self.ahead = Counter(), defaultdict(lambda: [0, 0, 0]), Counter()
        for (v, w), n in self.pairs.items():
            self.total[v] += n
            self.after[v][min(n, 3) - 1] += 1
            self.ahead[w] += 1
        self.by, self.lower_by = self.discounts(self.pairs), self.discounts(self.ahead)
        self.rest = sum(self.lower_by[min(n, 3) - 1] for n in self.ahead.values())

    @staticmethod
    def tokens(text):
        return [*WORDS.findall((text or "").translate(LOWER)), ("end",)]

    @staticmethod
    def discounts(counts):
        n = [sum(c == k for c in counts.values()) for k in range(5)]
        return lm.discounts(*n[1:])

    def lower(self, w):
        kinds = sum(self.ahead.values())
        own = max(self.ahead[w] - (0, *self.lower_by)[min(self.ahead[w], 3)], 0)
        return own / kinds + self.rest / kinds / (len(self.words) + 1)

    def chance(self, v, w):
        if not self.total[v]:
            return self.lower(w)
        n = self.pairs[v, w]
        own = max(n - (0, *self.by)[min(n, 3)], 0)
        rest = sum(d * k for d, k in zip(self.by, self.after[v]))
        return (own + rest * self.lower(w)) / self.total[v]

    def score(self, text):
        row = self.tokens(text)
        size = sum(self.words.values()) + 0.1 * (len(self.words) + 1)
        return (
            len(row),
            sum(self.words[w] > 0 for w in row),
            sum(math.log10((self.words[w] + 0.1) / size) for w in row),
            sum(math.log10(self.chance(v, w)) for v, w in zip([None, *row], row)),
        )


def corpus():
    r = random.Random(3)
    words = [f"w{n}" for n in range(60)]
    texts = [" ".join(r.choices(words, range(60, 0, -1), k=r.randrange(40))) for _ in range(120)]
    return [*texts, None, "", "A a\tA", "A a\tA", "x" * 50_000]


@pytest.mark.parametrize("hot", [lm.HOT, 20])
def test_scores_equal_dictionaries(spark, hot):
    texts = corpus()
    frame = spark.createDataFrame([(n, t, "x") for n, t in enumerate(texts)], "doc_id long, text string, score string")
    model = lm.train(frame.repartition(4), hot=hot)
    plain = Plain(texts)
    asked = [*texts[:40], "unseen words w1 w2", None, "w1 unseen w1"]
    rows = lm.score(spark.createDataFrame(list(enumerate(asked)), "doc_id long, text string"), model).collect()
    assert len(rows) == len(asked)
    for row in rows:
        n, known, base, score = plain.score(asked[row["doc_id"]])
        assert (row["n_tokens"], row["n_known"]) == (n, known)
        assert row["base_score"] == pytest.approx(base, rel=1e-12)
        assert row["score"] == pytest.approx(score, rel=1e-12)
    everything = [*plain.words, "unknown"]
    for v in [None, "w0", "w59", "unknown"]:
        assert sum(plain.chance(v, w) for w in everything) == pytest.approx(1)


def test_model_without_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    model = lm.train(empty)
    assert lm.score(empty, model).count() == 0
    row = lm.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), model).first()
    assert (row["n_tokens"], row["n_known"], row["score"]) == (3, 0, 0.0)


def test_arrays_of_a_remote_store_are_copied(tmp_path, monkeypatch):
    from millrace.llm import arrays

    arrays.put(str(tmp_path), "a", np.arange(5))
    monkeypatch.setattr(arrays.fs, "LocalFileSystem", type("Other", (arrays.fs.SubTreeFileSystem,), {}))
    monkeypatch.setattr(arrays, "opened", lambda folder: (arrays.fs.FileSystem.from_uri("file:///")[0], folder))
    assert arrays.mapped(str(tmp_path), "a", np.int64).tolist() == [0, 1, 2, 3, 4]


# --- toxicity


def plain_segments(scores):
    """Maximal scoring segments by their definition: the best one, then left and right of it."""

    def below(low, high):
        best = max(
            ((sum(scores[a:b]), -(b - a), -a, a, b) for a in range(low, high) for b in range(a + 1, high + 1)),
            default=(0,),
        )
        if best[0] <= 0:
            return []
        _, _, _, a, b = best
        return [*below(low, a), (a, b, best[0]), *below(b, high)]

    return below(0, len(scores))


def test_segments_equal_their_definition():
    r = random.Random(5)
    for _ in range(400):
        # no partial sums are equal, so that the definition leaves no choice
        scores = [r.randrange(-4, 5) + r.random() / 100 for _ in range(r.randrange(12))]
        found = [(a, b) for a, b, _ in toxicity.segments(np.array(scores))]
        assert found == [(a, b) for a, b, _ in plain_segments(scores)]


def tables(spark):
    r = random.Random(2)
    clean = [f"word{n}" for n in range(200)]
    docs, labels = [], []
    for n in range(400):
        words = r.choices(clean, k=40)
        toxic = n % 5 == 0
        if toxic:
            words[10:10] = r.choices(["rottenfish,", "Rottenegg", "vilething"], k=3)
        docs.append((n, " ".join(words)))
        if n % 4:
            labels.append((n, int(toxic)))
    docs += [(900, None), (901, ""), (902, "rottenbanana vilething " * 3000), (None, "word1")]
    labels += [(None, 1), (1, None), (5, 0)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1.5 as score"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


def test_toxic_texts_are_found(spark):
    docs, labels = tables(spark)
    rows = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert len(rows) == docs.count()
    wrong = [n for n in range(400) if (rows[n]["score"] >= 0.3) != (n % 5 == 0)]
    assert len(wrong) <= 4
    assert rows[902]["score"] > 0.9 and rows[902]["passages"]
    assert rows[900]["score"] == rows[901]["score"] < 0.3
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    passage = rows[0]["passages"][0]
    assert 10 <= passage["start"] < passage["end"] <= 13


def test_scale_follows_the_share_of_hits_at_any_size():
    for hits in (50_000, 400_000, 1_000_000):  # 20 misses for each
        scale = toxicity.scale_of(np.ones(hits), 20 * hits)
        assert abs((np.exp(scale) + 20 * np.exp(-scale * toxicity.COST)) / 21 - 1) < 1e-9
        assert abs(scale - toxicity.scale_of(np.ones(1000), 20_000)) < 1e-9


def test_texts_with_a_shared_passage_are_no_copies(spark):
    r = random.Random(3)
    shared = " ".join(f"boiler{n}" for n in range(60))
    rows = [(n, n % 2, shared + " " + " ".join(f"own{r.randrange(10**6)}" for _ in range(40))) for n in range(30)]
    rows += [(100, 0, rows[0][2]), (101, 1, rows[0][2]), (102, 0, rows[0][2]), (200, 1, "vilething"), (201, 0, "vilething"), (202, 1, "vilething"), (203, 1, "two words")]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["doc_id", "toxic", "text"])
    keys = {}
    for found in toxicity.copies(iter([batch])):
        for row in found.to_pylist():
            keys.setdefault((row["key"], row["toxic"]), []).append(row["doc_id"])
    alike = [ids for ids in keys.values() if len(ids) > 1]
    assert sorted(alike) == [[0, 100, 102], [200, 202]]
    table = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, k) for i, k, _ in rows], "doc_id long, toxic int")
    short = table.where("doc_id >= 200"), labels.where("doc_id >= 200")
    assert (toxicity.train(*short).constant) is None


def test_the_sample_has_one_text_of_an_id(spark):
    docs = spark.range(5000).selectExpr("id % 3 * (id % 2) as doc_id", "concat('text ', id) as text")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (7, 1)], "doc_id long, toxic int")
    found = toxicity.sample(docs, labels, "doc_id", "text").collect()
    assert sorted(r["doc_id"] for r in found) == [0, 1, 2]
    again = toxicity.sample(docs.repartition(5), labels, "doc_id", "text").collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))


def test_toxicity_without_labels_of_both_kinds(spark):
    docs, labels = tables(spark)
    none = toxicity.score(docs, toxicity.train(docs, labels.limit(0)))
    assert {r["score"] for r in none.collect()} == {0.0}
    one = toxicity.score(docs.limit(3), toxicity.train(docs, labels.where("toxic = 1")))
    assert {r["score"] for r in one.collect()} == {1.0}
    assert toxicity.score(docs.limit(0), toxicity.train(docs, labels)).count() == 0


# --- nearest neighbours


def exact(rows, query, k):
    own = np.array(query[1])
    scored = sorted(
        (math.sqrt(((np.array(v) - own) ** 2).sum()), n) for n, v in rows if n != query[0] and len(v) == len(own)
    )
    return scored[:k]


def test_recall_against_brute_force(spark):
    r = np.random.default_rng(4)
    rows = [(n, v.tolist()) for n, v in enumerate(r.standard_normal((1500, 32)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' as score")
    found = {}
    for row in ann.search(table, table.where("vec_id % 50 = 0")).collect():
        found.setdefault(row["query_id"], []).append((row["rank"], row["score"], row["vec_id"]))
    hits = 0
    for n in range(0, 1500, 50):
        got = sorted(found[n])
        assert [g[0] for g in got] == list(range(1, 11))
        assert [g[1:] for g in got] == sorted(g[1:] for g in got)
        hits += len({g[2] for g in got} & {x for _, x in exact(rows, rows[n], 10)})
    assert hits >= 0.9 * 300


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [1.0, 1.0]), (5, [1.0, 1.0]), (6, [inf, 0.0]),
        (7, [1.0, None]), (100, [0.5, 0.5, 0.5]), (None, [1.0, 2.0]), (5, [1.0, 1.0]), (0, [9.0, 9.0]), (8, []),
    ]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.search(table, table.where("vec_id % 100 = 0")).orderBy("rank").collect()
    assert [tuple(r) for r in found] == [(0, 1, 4, 1.0), (0, 2, 5, 1.0), (0, 3, 5, 1.0)]
    assert ann.search(table.limit(0), table.limit(0)).count() == 0


def test_many_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 100)
    monkeypatch.setattr(ann, "BLOCK_QUERIES", 10)
    rows = [(n, [float(n), 1.0]) for n in range(600)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = ann.search(table, table.where("vec_id % 20 = 0"), k=2, share=1.0).collect()
    assert len(found) == 60
    assert all(abs(r["vec_id"] - r["query_id"]) == 1 for r in found if 0 < r["query_id"] < 599)
