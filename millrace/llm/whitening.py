"""Embedding whitening by a bidiagonal qd solver.

The fit list holds every distinct vector once. Each task centres its rows and
reduces them, block by block, to the triangular factor of a QR decomposition;
the factors are stacked and reduced again, a few at a time, until one is left.
Its squared singular values over n are the eigenvalues of the covariance, and
its right singular vectors the directions. They are found without forming the
covariance, which would square the condition:

1. Householder reflections bring the factor to upper bidiagonal form;
2. dqds, the differential quotient-difference algorithm with shifts, finds all
   singular values of the bidiagonal to high relative accuracy;
3. twisted factorisations of the shifted tridiagonal give the directions, each
   from the place where its twist is smallest; directions of close values are made
   orthogonal by inverse iteration; the reflections carry them back.

Counts and sums are exact integers. Memory is bounded by a block of rows and a
few square matrices of the vectors' length, in tasks as well as in the solver.

Defined results: rows whose vector is null or holds null or non-finite entries
are left out; vectors of different lengths are fitted apart, each length by
itself; an empty vector has no components. Components of no variance (one
distinct vector, or fewer of them than components) are not returned. Repeated
rows count once in the fit and have their rows in the result each. The sign of a
direction is that which makes its largest entry positive. A deviation that no long
holds is null. A null id stays null. Without rows the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.tables import saved
from millrace.session import scratch_path

#: Entries become the floor of this many times their value.
SCALE = 256
#: Directions returned at most.
COMPONENTS = 4
#: Rows of a block in units of their length, and factors that one task stacks.
BLOCK, FAN_IN = 8, 8
#: Singular values under this share of the largest are zero.
NOTHING = 1e-12
#: Values closer than this, relatively, have their directions made orthogonal.
CLOSE = 1e-3

EPS = float(np.finfo(np.float64).eps)
#: Squared entries under this share of their neighbour are as good as zero.
SMALL = (8 * EPS) ** 2
LONG = 1 << 63

FACTOR = "width int, factor array<double>"


# -- the solver


def bidiagonal(factor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U' R V, and V."""
    a = np.array(factor, np.float64)
    n = len(a)
    right = []

    def reflection(x: np.ndarray) -> np.ndarray | None:
        length = np.linalg.norm(x)
        if length == 0:
            return None
        v = x.copy()
        v[0] += np.copysign(length, x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        if (v := reflection(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2 and (v := reflection(a[k, k + 1 :])) is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            right.append((k + 1, v))
    whole = np.eye(n)
    for start, v in reversed(right):
        whole[start:, :] -= 2 * np.outer(v, v @ whole[start:, :])
    return np.diag(a).copy(), np.diag(a, 1).copy(), whole


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """The squared singular values of a bidiagonal, largest first.

    Shifts stay below the smallest value: a transform that turns negative is
    thrown away and tried again with less, at last with none, which cannot fail.
    """
    q = [float(x) ** 2 for x in diagonal]
    e = [float(x) ** 2 for x in above]
    most = max(q + e, default=0.0)
    if most == 0:
        return np.zeros(len(q))
    found: list[float] = []
    blocks = [(q, e, 0.0)]
    while blocks:
        q, e, shifted = blocks.pop()
        guess = 0.0
        while q:
            n = len(q)
            if n == 1:
                found.append(q[0] + shifted)
                break
            cut = next((i for i in range(n - 1) if e[i] <= SMALL * (q[i] + shifted)), None)
            if cut is not None:
                blocks.append((q[: cut + 1], e[:cut], shifted))
                q, e, guess = q[cut + 1 :], e[cut + 1 :], 0.0
                continue
            tried, tries = guess, 0
            while True:
                new_q, new_e, d = [], [], q[0] - tried
                low = d
                for i in range(n - 1):
                    if d < 0 and tried:
                        break
                    pivot = d + e[i]
                    ratio = q[i + 1] / pivot if pivot else 0.0
                    new_q.append(pivot)
                    new_e.append(e[i] * ratio)
                    d = d * ratio - tried if pivot else q[i + 1] - tried
                    low = min(low, d)
                if low >= 0 or not tried:
                    break
                # all but the last stayed positive: then this is a bound, and close
                late = len(new_q) == n - 1 and tries == 0
                tries += 1
                tried = max(0.0, tried + d if late else tried / 4) if tries < 8 else 0.0
            new_q.append(d)
            q, e, shifted = new_q, new_e, shifted + tried
            # the smallest intermediate value bounds the smallest value from above
            guess = max(0.0, low * (1 - 4 * EPS)) if low < q[-1] else max(0.0, q[-1] - np.sqrt(q[-1] * e[-1]))
            if e[-1] <= SMALL * (q[-1] + shifted) or q[-1] + e[-1] + shifted <= EPS * EPS * most:
                found.append(q[-1] + shifted)
                q, e = q[:-1], e[:-1]
    return np.array(sorted(found, reverse=True))


def twisted(
    diagonal: np.ndarray, above: np.ndarray, value: float, aim: np.ndarray | None = None
) -> np.ndarray:
    """The unit eigenvector of B'B next to ``value`` by its twisted factorisation.

    With ``aim``, one step of inverse iteration from there instead.
    """
    n = len(diagonal)
    d, w = diagonal**2, np.append(diagonal[:-1] * above, 0.0)  # of L D L', and its off-diagonal
    main = d + np.append(0.0, above**2)
    tiny = EPS * max(float(main.max()), value)
    plus, minus = np.empty(n), np.empty(n)
    plus[0], minus[-1] = main[0] - value, main[-1] - value
    s = -value
    for i in range(n - 1):
        plus[i] = s + d[i]
        plus[i] = plus[i] if abs(plus[i]) > tiny * EPS else tiny * EPS
        s = s * above[i] ** 2 / plus[i] - value
    plus[-1] = s + d[-1]
    p = d[-1] - value
    progressive = np.empty(n)
    progressive[-1] = p
    for i in range(n - 2, -1, -1):
        minus[i + 1] = above[i] ** 2 + p
        minus[i + 1] = minus[i + 1] if abs(minus[i + 1]) > tiny * EPS else tiny * EPS
        p = p * d[i] / minus[i + 1] - value
        progressive[i] = p
    stationary = plus - d
    gamma = stationary + progressive + value
    at = int(np.argmin(np.abs(gamma)))
    if aim is None:
        z = np.zeros(n)
        z[at] = 1.0
        for i in range(at - 1, -1, -1):
            z[i] = -w[i] / plus[i] * z[i + 1]
        for i in range(at, n - 1):
            z[i + 1] = -w[i] / minus[i + 1] * z[i]
        return z / np.linalg.norm(z)
    # Solve N (twist) N' z = aim.
    y = aim.copy()
    for i in range(at):
        y[i + 1] -= w[i] / plus[i] * y[i]
    for i in range(n - 2, at - 1, -1):
        y[i] -= w[i] / minus[i + 1] * y[i + 1]
    z = np.empty(n)
    top = gamma[at] if abs(gamma[at]) > tiny * EPS else tiny * EPS
    z[at] = y[at] / top
    for i in range(at - 1, -1, -1):
        z[i] = (y[i] - w[i] * z[i + 1]) / plus[i]
    for i in range(at, n - 1):
        z[i + 1] = (y[i + 1] - w[i] * z[i]) / minus[i + 1]
    return z / np.linalg.norm(z)


def split(above: np.ndarray, diagonal: np.ndarray) -> list[slice]:
    """The parts of a bidiagonal between negligible entries above the diagonal."""
    size = np.abs(diagonal)
    cuts = np.flatnonzero(np.abs(above) <= EPS * np.sqrt(size[:-1] * size[1:])) + 1
    edges = [0, *cuts.tolist(), len(diagonal)]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def directions(factor: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of a square factor, and their right vectors as rows."""
    diagonal, above, right = bidiagonal(factor)
    size = max(np.abs(diagonal).max(initial=0.0), np.abs(above).max(initial=0.0))
    if size == 0:
        return np.zeros(0), np.zeros((0, len(factor)))
    # an exact zero on the diagonal has no L D L'; far below rounding it does no harm
    diagonal = np.where(np.abs(diagonal) < size * EPS * EPS, size * EPS * EPS, diagonal)
    ranked = sorted(
        ((value, part) for part in split(above, diagonal)
         for value in dqds(diagonal[part], above[part.start : part.stop - 1])),
        key=lambda found: -found[0],
    )
    least = NOTHING**2 * ranked[0][0]
    ranked = [found for found in ranked[:most] if found[0] > least]
    values, rows = [], []
    for value, part in ranked:
        own = diagonal[part], above[part.start : part.stop - 1]
        z = np.zeros(len(diagonal))
        z[part] = twisted(*own, value)
        near = [r for v, r in zip(values, rows) if v - value <= CLOSE * v]
        if near and max(abs(r @ z) for r in near) > EPS * len(z):
            # orthogonal to the others of the cluster, and still in its space
            for _ in range(3):
                for r in (*near, *near):
                    z -= (r @ z) * r
                if (length := np.linalg.norm(z)) < 1e-3:
                    z = np.zeros(len(z))
                    z[part] = np.random.default_rng(len(rows)).standard_normal(len(own[0]))
                else:
                    z /= length
                z[part] = twisted(*own, value, z[part])
            for r in (*near, *near):
                z -= (r @ z) * r
            z /= np.linalg.norm(z)
        values.append(value)
        rows.append(z)
    found = np.array(rows) @ right.T
    found *= np.sign(np.take_along_axis(found, np.abs(found).argmax(axis=1)[:, None], 1))
    return np.array(values), found / np.linalg.norm(found, axis=1, keepdims=True)


# -- rows to one factor


def triangle(rows: np.ndarray, width: int) -> np.ndarray:
    """The square triangular factor of rows."""
    factor = np.linalg.qr(rows, mode="r") if len(rows) else np.zeros((0, width))
    return np.vstack([factor, np.zeros((width - len(factor), width))])


def by_width(batch: pa.RecordBatch, column: str = "x") -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Vectors of a batch as matrices, with the rows they came from; empty ones are left out."""
    lists = batch.column(column)
    flat = np.asarray(lists.flatten())
    lengths = np.asarray(lists.value_lengths())
    starts = np.cumsum(lengths) - lengths
    for width in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == width)
        yield int(width), at, flat[starts[at][:, None] + np.arange(width)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exactly: as longs where they fit, else as Python's integers."""
    largest = max(int(np.abs(x.astype(np.float64)).max(initial=0)) + 1, max(map(abs, sums), default=0) // n + 1)
    if 2 * n * largest < LONG // 2:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


@dataclass(frozen=True)
class Centre:
    """What the vectors of one length have in common."""

    n: int
    sums: list[int]

    def of(self, x: np.ndarray) -> np.ndarray:
        """Vectors without their mean, rounded once."""
        return deviations(x, self.n, self.sums).astype(np.float64) / self.n


@dataclass(frozen=True)
class Whitening:
    """A fitted model of vectors of one length."""

    centre: Centre
    #: Eigenvalues, falling, their directions as rows, and the share of the trace of each.
    values: np.ndarray
    rows: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centre.of(x) @ self.rows.T / np.sqrt(self.values)


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """A vector's entries as longs."""
    return F.transform(vector.cast(T.ArrayType(T.DoubleType())), lambda c: F.floor(c * scale).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its entries are finite numbers."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def centres(fit: DataFrame) -> dict[int, Centre]:
    """Exact counts and sums of each length: one sum a task and length, then one a dimension."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, at, x in by_width(batch):
                low = x & 0xFFFFFFFF  # halves, whose sums over a batch fit in longs
                own = (((x - low) >> 32).sum(axis=0).astype(object) << 32) + low.sum(axis=0).astype(object)
                n[width] = n.get(width, 0) + len(at)
                total[width] = total.get(width, 0) + own
        rows = [(w, n[w], d, str(s)) for w in n for d, s in enumerate(total[w])]
        table = pd.DataFrame(rows, columns=["width", "n", "dimension", "sum"])
        yield pa.RecordBatch.from_pandas(
            table,
            pa.schema([("width", pa.int32()), ("n", pa.int64()), ("dimension", pa.int32()), ("sum", pa.string())]),
            preserve_index=False,
        )

    found = (
        fit.mapInArrow(sums, "width int, n long, dimension int, sum string")
        .groupBy("width", "dimension")
        .agg(F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).cast("string").alias("sum"))
        .collect()
    )
    lists: dict[int, list] = {}
    for row in sorted(found, key=lambda r: (r["width"], r["dimension"])):
        lists.setdefault(row["width"], []).append((row["n"], int(row["sum"])))
    return {width: Centre(rows[0][0], [s for _, s in rows]) for width, rows in lists.items()}


def factors(fit: DataFrame, known: dict[int, Centre]) -> DataFrame:
    """One triangular factor for each task and length."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in by_width(batch):
                step = max(256, BLOCK * width)
                for start in range(0, len(x), step):
                    rows = known[width].of(x[start : start + step])
                    held[width] = triangle(np.vstack([held.get(width, rows[:0]), rows]), width)
        for width, factor in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([width], pa.int32()), pa.array([factor.ravel()], pa.list_(pa.float64()))],
                ["width", "factor"],
            )

    return fit.mapInArrow(reduce, FACTOR)


def one_factor(parts: DataFrame, folder: str) -> dict[int, np.ndarray]:
    """The factors of each length stacked and reduced, ``FAN_IN`` at a time, until one is left."""

    def stacked(pdf: pd.DataFrame) -> pd.DataFrame:
        width = int(pdf["width"].iloc[0])
        factor = np.zeros((0, width))
        for part in pdf.sort_values("slot")["factor"]:
            factor = triangle(np.vstack([factor, np.reshape(part, (width, width))]), width)
        slot = int(pdf["slot"].iloc[0]) // FAN_IN
        return pd.DataFrame({"width": [width], "factor": [factor.ravel()], "slot": [slot]})

    # a task has one factor of a length, so its number tells them apart
    held, level = saved(parts.withColumn("slot", F.spark_partition_id()), f"{folder}/factors-0"), 0
    while held.agg(F.max("slot")).first()[0]:
        level += 1
        groups = held.groupBy("width", F.floor(F.col("slot") / FAN_IN))
        held = saved(groups.applyInPandas(stacked, f"{FACTOR}, slot int"), f"{folder}/factors-{level}")
    return {r["width"]: np.reshape(r["factor"], (r["width"],) * 2) for r in held.collect()}


def identity_errors(fit: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """How far the covariance of each length's whitened fit list is from the identity."""
    schema = "width int, a int, b int, product double"

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in by_width(batch):
                y = models[width].whitened(x)
                total[width] = total.get(width, 0) + y.T @ y
        rows = [(w, a, b, float(m[a, b])) for w, m in total.items() for a in range(len(m)) for b in range(len(m))]
        columns = zip(*rows) if rows else [[], [], [], []]
        kinds = [pa.int32(), pa.int32(), pa.int32(), pa.float64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(columns, kinds)], ["width", "a", "b", "product"]
        )

    sums = fit.mapInArrow(products, schema).groupBy("width", "a", "b").agg(F.sum("product").alias("product"))
    worst: dict[int, float] = {}
    for r in sums.collect():
        error = abs(r["product"] / models[r["width"]].centre.n - (r["a"] == r["b"]))
        worst[r["width"]] = max(worst.get(r["width"], 0.0), error)
    return worst


def fitted(fit: DataFrame, folder: str, components: int) -> dict[int, Whitening]:
    """The model of each length of the distinct vectors of a fit list."""
    known = centres(fit)
    models = {}
    for width, factor in one_factor(factors(fit, known), folder).items():
        values, rows = directions(factor, components)
        trace = float((factor**2).sum())
        n = known[width].n
        share = np.minimum(values / trace, 1.0) if trace else values
        models[width] = Whitening(known[width], values / n, rows, share)
    errors = identity_errors(fit, models)
    return {w: replace(m, identity_error=errors.get(w, 0.0)) for w, m in models.items()}


def whiten(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """A row per vector and component: vec_id, component (from 1), n, deviation, whitened,
    explained and identity_error.

    ``deviation`` is the exact sum over dimensions of (n x - S) squared.
    """
    folder = scratch_path(vectors.sparkSession, "whitening")
    rows = vectors.where(usable(F.col(vector))).select(
        F.col(vec_id).alias("vec_id"), quantised(F.col(vector), scale).alias("x")
    )
    rows = saved(rows, f"{folder}/rows")
    fit = saved(rows.select("x").distinct(), f"{folder}/fit")
    models = fitted(fit, folder, components)

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, at, x in by_width(batch):
                model = models[width]
                many = len(model.values)
                if not many:
                    continue
                off = deviations(x, model.centre.n, model.centre.sums)
                if off.dtype != object and float(np.abs(off).max(initial=0)) ** 2 * width >= LONG // 2:
                    off = off.astype(object)
                squares = (off * off).sum(axis=1)
                if off.dtype == object:
                    squares = [s if s < LONG else None for s in squares]
                each = np.repeat(at, many)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, many + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(each), model.centre.n)),
                        pa.array(squares, pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), many))),
                        pa.array(model.whitened(x).ravel()),
                        pa.array(np.tile(model.explained, len(at))),
                        pa.array(np.full(len(each), model.identity_error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(
        projected,
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double",
    )
