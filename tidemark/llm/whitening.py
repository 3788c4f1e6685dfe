"""Whitening of embeddings from an incremental eigendecomposition.

Each partition keeps the spectrum (count, mean, eigenvalues, eigenvectors of the centred scatter)
of the rows it has seen and turns every row into a centred rank-one update: poles that coincide are
rotated into one and components without weight are left alone (deflation), the rest moves to the
roots of the secular equation, and the eigenvectors come from the weights that make those roots
exact, so they stay orthogonal. A partition runs several such spectra side by side, one row to each
at a time, because one update is too small a piece of work for an array library.

Spectra combine in the same way: the eigenpairs of one, and the difference of the means, are
successive rank-one updates of the other. Groups of a fixed number of spectra meet in one task,
round by round, until one is left. Last comes a Rayleigh-Ritz step over all rows: their covariance
in the basis found is summed by partition and its eigenvectors turn the basis, so the result does
not depend on how rows were dealt out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import store

UNIT = 64
SHIFT = 1_000_000
COMPONENTS = 32
# Spectra that run side by side in a partition, and that meet in one task.
LANES = 16
MEET = 8
# Entries beyond this size have no exact place among the integers.
LARGEST = 2.0 ** 45
ROUNDS = 60
EPS = np.finfo(float).eps
ROWS_AT_ONCE = 4_096


def _with_equal_poles_turned(poles, weight, basis):
    """Deflation, in place: of equal poles only one keeps weight (a reflection of their basis)."""
    size = np.maximum(np.abs(poles).max(axis=1), (weight ** 2).sum(axis=1))
    near = np.diff(poles, axis=1) <= 8 * EPS * size[:, None]
    for lane in np.flatnonzero(near.any(axis=1)):
        edges = np.flatnonzero(~near[lane]) + 1
        for first, end in zip([0, *edges], [*edges, poles.shape[1]]):
            part = weight[lane, first:end]
            length = np.linalg.norm(part)
            if end - first < 2 or length == 0:
                continue
            mirror = part.copy()
            sign = 1.0 if part[-1] <= 0 else -1.0
            mirror[-1] -= sign * length
            mirror /= np.linalg.norm(mirror)
            turned = basis[lane][:, first:end]
            basis[lane][:, first:end] = turned - 2 * np.outer(turned @ mirror, mirror)
            weight[lane, first:end] = 0
            weight[lane, end - 1] = sign * length


def _roots(poles, squares, active):
    """Roots of 1 + sum squares / (poles - x), one right of every active pole: (origin, offset).

    A root is given by its offset from the nearer of the two poles around it, so that differences
    of roots and poles keep their digits. Bracketed: Newton steps on the equation times the
    X
    """
    lanes, d = poles.shape
    total = squares.sum(axis=1, keepdims=True)
    following = np.where(active, poles, np.inf)[:, ::-1]
    following = np.minimum.accumulate(following, axis=1)[:, ::-1]
    following = np.hstack([following[:, 1:], np.full((lanes, 1), np.inf)])
    last = np.isinf(following)
    following = np.where(last, poles + total, following)
    width = following - poles
    place = np.broadcast_to(np.arange(d), (lanes, d))
    # Which pole each root is measured from: the sign in the middle tells the nearer one.
    middle = poles + width / 2
    gap = poles[:, None, :] - middle[:, :, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        value = 1 + np.where(active[:, None, :], squares[:, None, :] / gap, 0).sum(axis=2)
    nearer_right = (value < 0) & ~last
    next_place = np.where(active, place, d)[:, ::-1]
    next_place = np.minimum.accumulate(next_place, axis=1)[:, ::-1]
    next_place = np.hstack([next_place[:, 1:], np.full((lanes, 1), d)])
    origin = np.where(nearer_right, np.minimum(next_place, d - 1), place)
    base = np.take_along_axis(poles, origin, axis=1)
    low = np.where(nearer_right, -width / 2, np.where(last & (value < 0), width / 2, 0))
    high = np.where(nearer_right, 0, np.where(last & (value < 0), width, width / 2))
    out = np.zeros_like(poles)
    # From here on a row per root that is still sought.
    lane, row = np.nonzero(active)
    offsets = poles[lane] - base[lane, row][:, None]
    weights, left_side = squares[lane], np.arange(d)[None, :] <= row[:, None]
    low, high, last = low[lane, row], high[lane, row], last[lane, row]
    left = (poles - base)[lane, row]
    right = left + width[lane, row]
    x = (low + high) / 2
    for _ in range(ROUNDS):
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            apart = offsets - x[:, None]
            term = weights / apart
            f = 1 + term.sum(axis=1)
            noise = 8 * EPS * (1 + np.abs(term).sum(axis=1))
            slopes = term / apart
            slope = slopes.sum(axis=1)
            before = np.where(left_side, slopes, 0).sum(axis=1)
            # The sums left and right of the root become one pole each, of the same slope.
            to_left, to_right = left - x, right - x
            rest = f - to_left * before - to_right * (slope - before)
            both = (to_left + to_right) * f - to_left * to_right * slope
            product = to_left * to_right * f
            root = np.sqrt(np.maximum(both ** 2 - 4 * product * rest, 0))
            two = np.where(both <= 0, (both - root) / (2 * rest), 2 * product / (both + root))
            one = to_left + to_left ** 2 * slope / (f - to_left * slope)
            step = x + np.where(last, one, two)
        low = np.where(f < 0, x, low)
        high = np.where(f >= 0, x, high)
        new = np.where((step > low) & (step < high), step, (low + high) / 2)
        done = (np.abs(f) <= noise) | (np.abs(new - x) <= EPS * np.abs(new))
        out[lane[done], row[done]] = x[done]
        if done.all():
            return origin, out
        left_over = ~done
        lane, row, x, low, high, last, left, right = (
            part[left_over] for part in (lane, row, new, low, high, last, left, right)
        )
        offsets, weights, left_side = offsets[left_over], weights[left_over], left_side[left_over]
    out[lane, row] = x
    return origin, out


class Spectra:
    """Eigendecompositions of centred scatters, one per lane: count, mean, poles, basis, sums.

    `basis[lane] @ diag(poles[lane]) @ basis[lane].T` is the scatter (not divided by the count).
    """

    def __init__(self, lanes: int, d: int):
        self.count = np.zeros(lanes)
        self.mean = np.zeros((lanes, d))
        self.poles = np.zeros((lanes, d))
        self.basis = np.broadcast_to(np.eye(d), (lanes, d, d)).copy()

    def add_direction(self, v: np.ndarray, rho: np.ndarray) -> None:
        """Add rho v v' to the scatter of every lane; rho 0 leaves a lane as it is."""
        rho = np.maximum(rho, 0.0)
        weight = np.matmul(v[:, None, :], self.basis)[:, 0] * np.sqrt(rho)[:, None]
        _with_equal_poles_turned(self.poles, weight, self.basis)
        squares = weight ** 2
        total = squares.sum(axis=1, keepdims=True)
        size = np.maximum(self.poles.max(axis=1, keepdims=True), total)
        # A weight moves no pole by more than |weight| times the length of all weights.
        active = np.abs(weight) * np.sqrt(total) > EPS * size
        if not active.any():
            return
        squares = np.where(active, squares, 0.0)
        origin, offset = _roots(self.poles, squares, active)
        base = np.take_along_axis(self.poles, origin, axis=1)
        # root of row i less pole of column j
        apart = (base[:, :, None] - self.poles[:, None, :]) + offset[:, :, None]
        both = active[:, :, None] & active[:, None, :]
        d = self.poles.shape[1]
        own = np.eye(d, dtype=bool)
        between = self.poles[:, :, None] - self.poles[:, None, :]
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(both & ~own, apart / between, 1.0)
            ratio = np.where(own, np.where(active, np.diagonal(apart, axis1=1, axis2=2), 0.0)[:, :, None], ratio)
            exact = np.sqrt(np.maximum(np.prod(ratio, axis=1), 0.0)) * np.where(weight < 0, -1.0, 1.0)
            vectors = np.where(both, exact[:, None, :] / -apart, 0.0)
        vectors = np.where(active[:, :, None], vectors, own[None])
        vectors /= np.linalg.norm(vectors, axis=2, keepdims=True)
        moved = np.where(active, base + offset, self.poles)
        order = np.argsort(moved, axis=1, kind="stable")
        vectors = np.take_along_axis(vectors, order[:, :, None], axis=1)
        self.poles = np.take_along_axis(moved, order, axis=1)
        self.basis = np.matmul(self.basis, vectors.transpose(0, 2, 1))

    def add_rows(self, x: np.ndarray, times: np.ndarray) -> None:
        """One row per lane, counted `times` times (0: no row): the centred rank-one update."""
        apart = x - self.mean
        after = self.count + times
        share = np.divide(times, after, out=np.zeros_like(after), where=after > 0)
        self.add_direction(apart, self.count * share)
        self.mean += apart * share[:, None]
        self.count = after

    def lane(self, k: int) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        return self.count[k], self.mean[k], self.poles[k], self.basis[k]


def combined(parts: list[tuple]) -> Spectra:
    """One spectrum of several (count, mean, poles, basis): pairs meet side by side.

    Each eigenpair of one is a rank-one update of the other, then the difference of the means is.
    """
    while len(parts) > 1:
        pairs = len(parts) // 2
        into = Spectra(pairs, len(parts[0][1]))
        for k in range(pairs):
            into.count[k], into.mean[k], into.poles[k], into.basis[k] = parts[2 * k]
        other = parts[1:2 * pairs:2]
        for j in range(into.mean.shape[1]):
            into.add_direction(np.stack([p[3][:, j] for p in other]), np.array([p[2][j] for p in other]))
        into.add_rows(np.stack([p[1] for p in other]), np.array([p[0] for p in other], float))
        parts = [into.lane(k) for k in range(pairs)] + parts[2 * pairs:]
    out = Spectra(1, len(parts[0][1]))
    out.count[0], out.mean[0], out.poles[0], out.basis[0] = parts[0]
    return out


def spectrum_of(blocks: Iterator[np.ndarray], d: int) -> tuple:
    """(count, mean, poles, basis) of rows that come in blocks; equal rows of a block count once."""
    lanes = Spectra(LANES, d)
    for block in blocks:
        rows, times = np.unique(block, axis=0, return_counts=True)
        for at in range(0, len(rows), LANES):
            part = rows[at:at + LANES]
            short = LANES - len(part)
            lanes.add_rows(
                np.vstack([part, np.zeros((short, d))]),
                np.append(times[at:at + LANES], np.zeros(short)).astype(float),
            )
    held = [lanes.lane(k) for k in range(LANES) if lanes.count[k]]
    return combined(held).lane(0) if held else None


@dataclass
class Whitener:
    """Mean and components, as sent to the tasks."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact; Python integers where 64 bits don't hold them."""
        largest = self.n * int(np.abs(x).max(initial=0)) + max(map(abs, self.sums), default=0)
        kind = np.int64 if largest < 2 ** 62 else object
        return self.n * x.astype(kind) - np.array(self.sums, dtype=kind)

    def whiten(self, apart: np.ndarray) -> np.ndarray:
        """(x - mean) on the components over the root of their eigenvalues; 0 without variance."""
        held = self.values > 0
        scale = np.where(held, 1 / np.sqrt(np.where(held, self.values, 1)), 0.0)
        return (apart.astype(float) / self.n) @ self.vectors * scale


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): entries as floor(64 c) + 1000000.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out, and so are
    those with an entry beyond 2**45 in size, which has no exact integer, and those that lack (or
    exceed) an entry of the commonest length, which is the space. Null and repeated ids stay.
    """
    v = F.col(vector_col).cast("array<double>")
    good = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))  # NaN is above all numbers
    rows = df.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v")).where(
        (F.size("v") > 0) & good
    ).select("vec_id", F.transform("v", lambda c: F.floor(c * UNIT) + F.lit(SHIFT)).alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.where(F.size("x") == (sizes.d if sizes else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


SPECTRUM = "count double, mean array<double>, poles array<double>, basis array<double>"


def _spectrum_row(spectrum: tuple) -> dict:
    count, mean, poles, basis = spectrum
    return {"count": [count], "mean": [mean], "poles": [poles], "basis": [basis.ravel()]}


def _partition_spectra(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One spectrum per partition that has rows."""
    def blocks():
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                yield _matrix(batch.column(0).slice(at, ROWS_AT_ONCE))

    source = (b for b in blocks() if len(b))
    first = next(source, None)
    if first is None:
        return

    def again():
        yield first
        yield from source

    row = _spectrum_row(spectrum_of(again(), first.shape[1]))
    yield pa.RecordBatch.from_pydict({k: [v.tolist() if k != "count" else v for v in row[k]] for k in row})


def _meet(rows: pd.DataFrame) -> pd.DataFrame:
    """Combine the spectra of one group, at most MEET of them."""
    parts = [
        (r.count_, np.asarray(r.mean), np.asarray(r.poles),
         np.asarray(r.basis).reshape(len(r.mean), -1))
        for r in rows.rename(columns={"count": "count_"}).itertuples()
    ]
    return pd.DataFrame(_spectrum_row(combined(parts).lane(0)))


def incremental_basis(vectors: DataFrame) -> np.ndarray | None:
    """Eigenvectors (columns) of the scatter of all rows, by falling eigenvalue; None without rows."""
    spectra = vectors.select("x").mapInArrow(_partition_spectra, SPECTRUM)
    spectra = store(spectra.withColumn("place", F.spark_partition_id()), "spectra")
    left = spectra.count()
    while left > 1:
        # Places are dense or not: a group holds at most MEET of them either way.
        group = F.floor(F.col("place") / MEET).cast("int")
        spectra = spectra.withColumn("group", group).groupBy("group").applyInPandas(
            lambda key, rows: _meet(rows).assign(place=key[0]), f"{SPECTRUM}, place int"
        )
        spectra = store(spectra, "spectra")
        left = spectra.count()
    row = spectra.first()
    return np.asarray(row.basis).reshape(len(row.mean), -1)[:, ::-1] if row else None


def _summed(partials: DataFrame) -> np.ndarray:
    """Sum of one flat array per partition, place by place."""
    cells = partials.select(F.posexplode("cells").alias("place", "cell")).groupBy("place").agg(
        F.sum("cell").alias("cell")
    ).orderBy("place")
    return np.array([r.cell for r in cells.collect()])


def _moments(vectors: DataFrame, project) -> np.ndarray:
    """Sum over all rows of p p' for p = project(x), in partial sums per partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                p = project(_matrix(batch.column(0).slice(at, ROWS_AT_ONCE)))
                total = p.T @ p + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"cells": [total.ravel().tolist()]})

    flat = _summed(vectors.select("x").mapInArrow(run, "cells array<double>"))
    d = int(round(len(flat) ** 0.5))
    return flat.reshape(d, d)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Components of all rows of (vec_id, x); None without rows."""
    sums = vectors.select(F.posexplode("x").alias("place", "x")).groupBy("place").agg(
        F.sum(F.col("x").cast("decimal(20,0)")).alias("s"), F.count(F.lit(1)).alias("n")
    ).orderBy("place").collect()
    if not sums:
        return None
    n, totals = sums[0].n, [int(r.s) for r in sums]
    basis = incremental_basis(vectors)
    basis, _ = np.linalg.qr(basis)
    plain = Whitener(n, totals, basis, np.ones(basis.shape[1]), 0.0)
    ritz = _moments(vectors, lambda x: plain.whiten(plain.apart(x))) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    trace = float(np.trace(ritz))
    held = basis @ turn
    # The sign is that of the largest entry, so that runs agree.
    held *= np.where(held[np.abs(held).argmax(axis=0), np.arange(held.shape[1])] < 0, -1.0, 1.0)
    none = values <= len(values) * EPS * max(values[0], 0.0)
    return Whitener(
        n, totals, held[:, :components], np.where(none, 0.0, values)[:components], trace
    )


def identity_error(vectors: DataFrame, model: Whitener) -> float:
    """Largest entry, in size, of the covariance of whitened rows less the identity.

    Components without variance have nothing to be scaled and are not counted.
    """
    held = model.values > 0
    if not held.any():
        return 0.0
    found = _moments(vectors, lambda x: model.whiten(model.apart(x))) / model.n
    return float(np.abs(found - np.eye(len(found)))[np.ix_(held, held)].max())


ROWS = "vec_id bigint, deviation decimal(38,0), whitened array<double>"


def whitened_rows(vectors: DataFrame, model: Whitener) -> DataFrame:
    """(vec_id, deviation, whitened) with one array of all components per row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(at, ROWS_AT_ONCE)
                apart = model.apart(_matrix(some.column(1)))
                largest = int(np.abs(apart).max(initial=0))
                fits = apart.dtype != object and largest ** 2 * apart.shape[1] < 2 ** 63
                exact = apart if fits else apart.astype(object)
                squares = pa.array([int(s) for s in (exact ** 2).sum(axis=1)], pa.decimal128(38, 0))
                w = model.whiten(apart)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), squares, pa.array(list(w), pa.list_(pa.float64()))],
                    ["vec_id", "deviation", "whitened"],
                )

    return vectors.select("vec_id", "x").mapInArrow(run, ROWS)


def whitening(df: DataFrame, components: int = COMPONENTS, id_col="vec_id", vector_col="embedding"):
    """(vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact).

    One row per remaining row and component, repeated rows and null ids included. A component
    without variance has whitened 0 and explained 0. `deviation` is null where 64 bits don't hold
    it (from about ten million rows on); `deviation_exact` has it always. A table without a
    remaining row gives no rows.
    """
    vectors = store(integer_vectors(df, id_col, vector_col), "integer-vectors")
    model = fit(vectors, components)
    if model is None:
        return df.sparkSession.createDataFrame(
            [], "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                "explained double, identity_error double, deviation_exact decimal(38,0)"
        )
    error = identity_error(vectors, model)
    trace = model.trace or 1.0
    explained = F.array(*[F.lit(float(e / trace)) for e in model.values])
    rows = whitened_rows(vectors, model)
    return rows.select(
        "vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened")
    ).select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("bigint").alias("n"),
        F.expr("try_cast(deviation AS bigint)").alias("deviation"), "whitened",
        F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).alias("identity_error"), F.col("deviation").alias("deviation_exact"),
    )
