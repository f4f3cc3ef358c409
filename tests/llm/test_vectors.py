"""Whitening, exact top-k search and Merkle manifests against plain versions."""

import hashlib
import math
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import merkle, queries, topk, whitening

VECTORS = "vec_id long, embedding array<double>, note string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- the solver


def orthogonal(rng, n):
    return np.linalg.qr(rng.standard_normal((n, n)))[0]


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 0.1, 40),
        np.r_[np.ones(5), np.linspace(0.9, 0.1, 35)],
        np.logspace(0, -14, 40),
        np.r_[1, 1 - 3e-12, 1 - 1e-9, 1 - 2e-9, np.full(36, 0.5)],
        np.ones(40),
        np.r_[np.ones(2), np.zeros(38)],
        np.r_[3.0, np.zeros(39)],
    ],
)
def test_solver_finds_values_and_directions(values):
    rng = np.random.default_rng(3)
    factor = np.linalg.qr(orthogonal(rng, 40) @ np.diag(values) @ orthogonal(rng, 40), mode="r")
    diagonal, above, right = whitening.bidiagonal(factor)
    assert np.abs(right.T @ right - np.eye(40)).max() < 1e-13
    found = np.sqrt(whitening.dqds(diagonal, above))
    assert np.abs(found - values).max() < 1e-13 * values[0]
    squares, rows = whitening.directions(factor, 4)
    assert len(squares) == min(4, (values > 1e-12).sum())
    assert np.abs(rows @ rows.T - np.eye(len(rows))).max() < 1e-12
    assert np.abs(factor.T @ (factor @ rows.T) - rows.T * squares).max() < 1e-12


def test_dqds_is_accurate_for_small_values():
    # a graded bidiagonal with known values: the product of them is that of its diagonal
    diagonal, above = 10.0 ** -np.arange(12.0), 10.0 ** -(np.arange(11.0) + 1)
    found = whitening.dqds(diagonal, above)
    assert math.isclose(np.log(found).sum() / 2, np.log(diagonal).sum(), rel_tol=1e-13)
    assert (whitening.dqds(np.zeros(3), np.zeros(2)) == 0).all()
    assert whitening.dqds(np.zeros(0), np.zeros(0)).tolist() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 12), st.integers(0, 2**32 - 1), st.sampled_from([1, 3, 1000]))
def test_solver_on_small_integers(n, seed, most):
    rng = np.random.default_rng(seed)
    rows = rng.integers(-most, most + 1, (rng.integers(1, 20), n)).astype(float)
    factor = whitening.triangle(rows, n)
    want = np.linalg.svd(factor, compute_uv=False)
    found, directions = whitening.directions(factor, n)
    assert np.abs(np.sqrt(found) - want[: len(found)]).max(initial=0) <= 1e-12 * max(want[0], 1)
    assert (want[len(found) :] <= 1e-11 * max(want[0], 1)).all()
    assert np.abs(directions @ directions.T - np.eye(len(found))).max(initial=0) < 1e-10


# --- whitening


def plain_whitening(vectors):
    """Rows by (vec_id, component) from numpy's symmetric solver."""
    rows = [(i, np.floor(256 * np.array(v, float)).astype(object)) for i, v in vectors]
    fit = np.array(sorted({tuple(int(c) for c in x) for _, x in rows}), object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums).astype(float) / n
    covariance = centred.T @ centred / n
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1], columns[:, ::-1]
    found = {}
    for number, x in rows:
        off = np.array([n * int(c) for c in x], object) - sums
        for c in range(min(4, int((values > 1e-9 * values[0]).sum()))):
            whitened = (off.astype(float) / n) @ columns[:, c] / math.sqrt(values[c])
            found[number, c + 1] = n, sum(int(d) ** 2 for d in off), whitened, values[c] / np.trace(covariance)
    return found


def compare_whitening(spark, vectors, more=()):
    df = spark.createDataFrame([(i, v, "x") for i, v in [*vectors, *more]], VECTORS)
    found = whitening.whiten(df.repartition(5)).collect()
    want = plain_whitening(vectors)
    repeated = len(vectors) - len(dict(vectors))
    assert len(found) == len(want) + repeated * max(c for _, c in want)
    signs = defaultdict(set)
    for r in found:
        n, deviation, whitened, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert math.isclose(abs(r["whitened"]), abs(whitened), rel_tol=1e-7, abs_tol=1e-7)
        assert math.isclose(r["explained"], explained, rel_tol=1e-9)
        assert r["identity_error"] < 1e-10
        if abs(whitened) > 1e-6:
            signs[r["component"]].add(r["whitened"] * whitened > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_equals_a_symmetric_solver(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 7)) @ np.diag([5, 4, 3, 2, 1, 0.5, 0.1]) + 10
    vectors = [(n, row.tolist()) for n, row in enumerate(x)]
    vectors += [(1000 + n, vectors[0][1]) for n in range(200)]  # a hot vector counts once
    inf = float("inf")
    dropped = [(-1, None), (-2, [None] * 7), (-3, [float("nan")] * 7), (-4, [inf] * 7), (-5, [1.0] * 6 + [-inf])]
    compare_whitening(spark, vectors, dropped)


def test_whitening_of_few_and_of_large_vectors(spark):
    compare_whitening(spark, [(1, [1.0, 2.0, 3.0]), (2, [2.0, -0.0, 3.5]), (2, [2.0, 0.0, 3.5])])
    # sums of squares beyond the range in which doubles are exact
    compare_whitening(spark, [(n, [1.0e5 * n, -1.0e4 * n * n, 1.0e4 * (n % 4)]) for n in range(9)])


def test_whitening_without_variance_rows_or_one_length(spark):
    def rows(vectors):
        df = spark.createDataFrame([(n, v, None) for n, v in enumerate(vectors)], VECTORS)
        return whitening.whiten(df).collect()

    assert rows([]) == []
    assert rows([[1.0, 2.0]] * 3) == []
    assert rows([[], []]) == []
    # each length by itself
    mixed = rows([[1.0], [2.0], [1.0, 1.0], [2.0, 3.0], None])
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in mixed) == [(n, 1, 2) for n in range(4)]
    # what no long holds is null, and does not stop the others
    huge = rows([[1e300, 0.0], [-1e300, 0.0], [0.0, 1.0]])
    assert {r["deviation"] for r in huge} == {None, 1 + 512**2} and len(huge) >= 3


# --- exact top-k search


def plain_topk(vectors, queries, k):
    def quantised(v):
        return [math.floor(1024 * float(c)) for c in v]

    usable = [(i, quantised(v)) for i, v in vectors if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    asked = {}
    for i, v in queries:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            asked[i] = min(asked.get(i, quantised(v)), quantised(v))
    found = []
    for i, q in asked.items():
        rows = [(-sum(a * b for a, b in zip(q, x)), number is None, number) for number, x in usable if number != i]
        rows.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        found += [(i, n, number, -score) for n, (score, _, number) in enumerate(rows[:k], 1)]
    return sorted(found)


def compare_topk(spark, vectors, k=5, every=7, **sizes):
    df = spark.createDataFrame([(i, v, "x") for i, v in vectors], VECTORS).repartition(4)
    asked = df.where(F.col("vec_id") % every == 0)
    found = topk.search(df, asked, k, **sizes)
    rows = sorted((r["query_id"], r["rank"], r["vec_id"], int(r["score"])) for r in found.collect())
    assert rows == plain_topk(vectors, [(i, v) for i, v in vectors if i is not None and i % every == 0], k)


def test_topk_equals_comparing_all_rows(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.standard_normal((600, 6)), 1)  # rounded: many ties
    vectors = [(n, row.tolist()) for n, row in enumerate(x)]
    vectors += [(2000 + n, vectors[7][1]) for n in range(200)]  # a hot vector
    inf = float("inf")
    vectors += [(7000, None), (7007, [None, 1.0]), (7014, [inf] * 6), (None, [9.0] * 6), (None, None)]
    vectors += [(14, [5.0] * 6), (14, [-5.0] * 6), (21, vectors[21][1])]  # repeated ids
    vectors += [(7021, []), (7028, [1.0]), (7035, [1.0] * 9), (7042, [0.0] * 6)]  # other lengths, zero
    compare_topk(spark, vectors, shard_rows=100, block_rows=16, block_queries=40)


def test_topk_of_huge_components_few_rows_and_none(spark):
    compare_topk(spark, [(0, [1.0, 2.0]), (7, [-3.0, 0.5])])
    compare_topk(spark, [(n, [5.0e14 * (n - 3), 1.0e15, float(n)]) for n in range(15)], k=3)
    compare_topk(spark, [(n, [3.0e6 * (n - 3), 1.0e6, float(n)]) for n in range(15)], k=3, block_rows=2)
    empty = spark.createDataFrame([], VECTORS)
    some = spark.createDataFrame([(1, [1.0], "")], VECTORS)
    assert topk.search(empty, empty).count() == 0
    assert topk.search(some, empty).count() == 0
    assert topk.search(empty, some).count() == 0
    assert topk.search(some, some).count() == 0


def test_bounds_leave_blocks_and_shards_out(spark):
    """Rows in groups of common terms: a query visits those of its own terms only."""
    rng = np.random.default_rng(6)
    groups = [np.eye(8)[g] * 5 + np.abs(rng.standard_normal((64, 8))) * 0.05 for g in range(8)]
    index = pd.DataFrame({
        "ids": [np.arange(64) + 64 * g for g in range(8)],
        "known": [np.ones(64, bool)] * 8,
        "weights": [(x * 1024).astype(np.int64).ravel() for x in groups],
        "high": [(x * 1024).astype(np.int64).max(axis=0) for x in groups],
        "low": [(x * 1024).astype(np.int64).min(axis=0) for x in groups],
    })
    asked = pd.DataFrame({
        "query_id": np.arange(8) * 64,
        "x": [(x[0] * 1024).astype(np.int64).tolist() for x in groups],
        "beat": [None] * 8,
    })
    best, scored = topk.visit(asked, index, 5)
    assert len(best) == 40 and scored == 8
    assert (best["id"] // 64 == best["query"]).all()
    # a score to beat that no block reaches leaves nothing to score
    asked["beat"] = [10**9] * 8
    assert topk.visit(asked, index, 5)[1] == 0


# --- Merkle manifests


def plain_field(value):
    text = None if value is None else str(value)
    return "-" if text is None else f"{len(text.encode())}:{text}"


def plain_tree(leaves):
    """All levels of a tree, and the siblings of every leaf."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        level = levels[-1]
        levels.append([digest("".join(level[n : n + 2])) for n in range(0, len(level), 2)])
    paths = [
        [(level[i - 1], "") if (i := n >> at) % 2 else ("", level[i + 1] if i + 1 < len(level) else "")
         for at, level in enumerate(levels[:-1])]
        for n in range(len(leaves))
    ]
    return levels[-1][0], paths


def plain_proofs(rows):
    """Sorted (id, leaf, path, subroot, root) of (id, group, text) rows."""
    groups = defaultdict(list)
    for number, group, text in rows:
        leaf = digest("".join(map(plain_field, (number, group, text))))
        groups[group].append((number is not None, number or 0, leaf, number))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([leaf for *_, leaf, _ in sorted(groups[g], key=lambda r: r[:3])]) for g in names}
    root, above = plain_tree([trees[g][0] for g in names]) if names else (None, [])
    found = []
    for g, up in zip(names, above):
        for (_, _, leaf, number), path in zip(sorted(groups[g], key=lambda r: r[:3]), trees[g][1]):
            found.append((str(number), leaf, tuple(path + up), trees[g][0], root))
    return sorted(found)


@pytest.mark.parametrize("stride", [1, 3, 8])
def test_proofs_equal_whole_trees(spark, stride):
    rows = [(n, "en", f"text {n % 10}") for n in range(133)]
    rows += [(n, "de", "é" * n) for n in range(64)] + [(n, None, None) for n in range(9)]
    rows += [(5, "x", "alone"), (None, "en", None), (None, None, ""), (7, "en", "other text of this id")]
    rows += [(8, "", "")] * 3 + [(9, "=", "-"), (10, "é", "z")]  # equal rows, odd names
    df = spark.createDataFrame(rows, "id long, group string, text string").repartition(6)
    manifest = merkle.build(df, [F.col(c) for c in df.columns], "group", "id", [F.col("id")], stride)
    proofs = manifest.prove().withColumn("folded", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    found = sorted(
        (str(r["kept"]["id"]), r["leaf"], tuple(map(tuple, r["path"])), r["subroot"], r["root"]) for r in proofs
    )
    assert found == plain_proofs(rows)
    assert all(r["folded"] == r["root"] == manifest.root() for r in proofs)
    # what is stored: every stride-th level, not those between
    heights = [math.ceil(math.log2(135)), 6, math.ceil(math.log2(10))]
    assert len(manifest.groups) == 1 + math.ceil(max(heights) / stride)


def test_one_leaf_one_group_and_none(spark):
    def proofs(rows):
        df = spark.createDataFrame(rows, "id long, group string, text string, kept string, tree string, pos string")
        manifest = merkle.build(df, [F.col(c) for c in ("id", "group", "text")], "group", "id")
        return manifest, manifest.prove().collect()

    manifest, rows = proofs([(1, "en", "only", "a", "b", "c")])
    (row,) = rows
    assert row["path"] == [] and row["leaf"] == row["subroot"] == row["root"] == manifest.root()
    manifest, rows = proofs([])
    assert rows == [] and manifest.root() is None
    long = "word " * 200_000
    _, rows = proofs([(n, "en", long, None, None, None) for n in range(3)])
    assert sorted(r["leaf"] for r in rows) == sorted(
        digest(f"1:{n}2:en{len(long)}:{long}") for n in range(3)
    )


def test_tampering_is_seen_and_nulls_stay(spark, tmp_path):
    rows = [(n, "s", "en" if n % 3 else None, None if n % 5 == 0 else n, f"t{n}") for n in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.proofs(spark, str(tmp_path)).collect()
    import zlib

    for r in found:
        tampered = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["doc_id"] % 5 != 0
        assert r["verified"] == (not tampered) == (r["folded_root"] == r["root"])
    assert any(not r["verified"] for r in found)
