"""Quality scores: random Fourier features, ridge by partition-summed sums, isotonic calibration.

A document becomes a vector of statistics (stats.FULL). cos(w x + b) with Gaussian w approximates
a Gaussian kernel over these, so ridge regression on the features is kernel ridge regression whose
normal equations have a fixed size. Each partition sums its own, the sums meet in a tree, and
nothing else leaves the executors. A part of the labelled rows that the ridge has not seen gives
label counts on a grid of raw scores, from which pooling of adjacent violators makes a monotone
map to a probability.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import stats
from tidemark.llm.common import by_merge, id_and_text, store, text_slices

FEATURES = 192
RIDGE = 1e-3
SEED = 17
GRID = 400
# Of ten parts of the labelled rows, those kept for calibration.
CALIBRATION_PARTS = 2
ROWS_AT_ONCE = 4096


@dataclass
class Model:
    """All a scorer needs: a few small arrays."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    calibrated: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale) @ self.directions + self.phases
        return np.column_stack([np.cos(z) * np.sqrt(2 / z.shape[1]), np.ones(len(x))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, 0, 1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), np.linspace(0, 1, GRID + 1), self.calibrated)


def statistics(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, x): the statistics of every row's whole text; zeros for empty and null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            x, _ = stats.vectors(part.column(1))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])
            yield pa.record_batch(
                [part.column(0), rows.cast(pa.list_(pa.float64()))], ["doc_id", "x"]
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, x array<double>")


def _summed(rows: DataFrame, partial: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum of partial(x, y) over the rows (x, y); one fixed-size array per partition and tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                piece = batch.slice(at, ROWS_AT_ONCE)
                x = np.array(piece.column(0).flatten()).reshape(piece.num_rows, -1)
                add = partial(x, piece.column(1).to_numpy())
                total = add if total is None else total + add
        if total is not None:
            packed = io.BytesIO()
            np.save(packed, total)
            yield pa.record_batch([pa.array([packed.getvalue()], pa.binary())], ["part"])

    parts = rows.select("x", F.col("y").cast("double")).mapInArrow(run, "part binary")
    arrays = parts.rdd.map(lambda row: np.load(io.BytesIO(bytes(row[0]))))
    # The zero stands for the sums of no rows.
    return arrays.union(rows.sparkSession.sparkContext.parallelize([0.0], 1)).treeReduce(
        lambda a, b: a + b
    )


def _pooled(ones: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Isotonic means of the cells of the grid, by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for a, b in zip(ones, rows):
        blocks.append([a, b, 1])
        while len(blocks) > 1 and (
            blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]
        ):
            last = blocks.pop()
            blocks[-1] = [u + v for u, v in zip(blocks[-1], last)]
    return np.concatenate([np.full(int(k), a / b) for a, b, k in blocks])


def fit(x: DataFrame, labels: DataFrame, label_col: str = "quality") -> Model:
    """Learn from the rows of `labels` (doc_id, label 0 or 1) that have statistics in `x`.

    Rows without a label or id teach nothing, repeated labels count each time. Without any label
    the score of every document is 0.5.
    """
    known = labels.select("doc_id", F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    rows = store(x.join(by_merge(known), "doc_id"), "quality-train")
    part = F.pmod(F.xxhash64("doc_id"), F.lit(10))
    n_stats = len(stats.FULL)
    moments = _summed(rows, lambda v, _: np.stack([v ** 0, v, v * v]).sum(axis=1))
    if np.ndim(moments) == 0:
        moments = np.ones((3, n_stats))
    mean = moments[1] / moments[0]
    scale = np.sqrt(np.maximum(moments[2] / moments[0] - mean ** 2, 0))
    random = np.random.default_rng(SEED)
    model = Model(
        mean, np.where(scale > 1e-9, scale, 1.0),
        # Width of the kernel: the usual distance of two standardised vectors.
        random.normal(size=(n_stats, FEATURES)) / np.sqrt(n_stats),
        random.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1), np.full(GRID + 1, 0.5),
    )

    def normal_equations(v: np.ndarray, y: np.ndarray) -> np.ndarray:
        phi = model.features(v)
        return phi.T @ np.column_stack([phi, y])

    sums = _summed(rows.where(part >= CALIBRATION_PARTS), normal_equations)
    if np.ndim(sums) == 0:
        return model
    n = sums[-1, -2]
    model.weights = np.linalg.solve(
        sums[:, :-1] / n + RIDGE * np.eye(FEATURES + 1), sums[:, -1] / n
    )

    def on_grid(v: np.ndarray, y: np.ndarray) -> np.ndarray:
        cell = np.rint(model.raw(v) * GRID).astype(int)
        return np.stack([
            np.bincount(cell, weights=y, minlength=GRID + 1),
            np.bincount(cell, minlength=GRID + 1),
        ])

    counts = _summed(rows.where(part < CALIBRATION_PARTS), on_grid)
    share = sums[-1, -1] / n
    ones, seen = counts if np.ndim(counts) else np.zeros((2, GRID + 1))
    # A trace of the raw score in every cell keeps empty cells defined and ties apart.
    trace = 1e-3
    raw = np.linspace(0, 1, GRID + 1)
    prior = raw if 0 < share < 1 else np.full(GRID + 1, share)
    model.calibrated = _pooled(ones + trace * prior, seen + trace)
    return model


def scored(x: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) for rows of statistics."""

    @F.pandas_udf("double")
    def score(v: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(v.to_numpy())) if len(v) else [], dtype="float64")

    return x.select("doc_id", score("x").alias("score"))


def text_score(model: Model, text: Column) -> Column:
    """The score of a text itself, for a filter that must not move the rows."""

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for series in texts:
            batch = pa.record_batch([pa.array(series, pa.large_string(), from_pandas=True)], ["t"])
            parts = [
                model.score(stats.vectors(piece.column(0))[0])
                for piece in text_slices(iter([batch]), 0)
            ]
            yield pd.Series(np.concatenate(parts) if parts else [], dtype="float64")

    return score(text)
