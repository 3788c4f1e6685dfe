"""Mixing by soft membership: document rates whose expected token totals per domain meet targets.

A softmax classifier fitted on labelled rows gives every document a posterior over the domains,
from its statistics (each also cut at quantiles) and from its most telling words. A document of n
tokens kept at rate r adds r * n * p_k expected tokens to domain k. Rates between 0 and `max_rate`
are fitted by projected gradient on the squared distance to the targets, scaled by the moments of
the rows that can still move: a step is one small vector, applied to every row by its posterior
and followed by the projection, and the gradient and the distances that several step lengths reach
are sums over all rows. Executors replay the steps so far from the stored rates, and rates are
stored anew every few steps. The fit ends when the targets are met, or when no row can move so as
to come nearer (the largest violation of the optimality conditions is the measure).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import stats
from tidemark.llm.common import by_merge, id_and_text, store, text_slices

# Documented bound of the labelled rows that the classifier is fitted on.
LABELLED_ROWS = 6_000
BUCKETS = 1 << 16
TELLING = 3
QUANTILES = 11
DECAY = 1e-3
ROUNDS = 100
STORED_EVERY = 8
# Step lengths tried, each with the scale of the moments and, where few rows move, nearer to none.
SIZES = (1.0, 0.5, 2.0 ** -3, 2.0 ** -6)
DAMPED = (0.0, 1e-2, 10.0)
# Shares are met to this, optimality conditions to this; less progress than this is none.
TOLERANCE = 1e-9
PROGRESS = 1e-6
SEED = 29


def _words(column: pa.Array):
    """Statistics; distinct words of each text as (text, bucket); words per text."""
    full, (owner, place, distinct) = stats.vectors(column)
    # Punctuation around a word does not make it another one.
    bare = pc.ascii_trim(distinct, characters=".,;:!?\\\"'()").to_numpy(zero_copy_only=False)
    bucket = (pd.util.hash_array(bare, categorize=False) % BUCKETS).astype(np.int64)
    n_words = np.bincount(owner, minlength=len(column))
    pairs = np.unique(owner * BUCKETS + (bucket[place] if len(place) else place))
    return full, (pairs // BUCKETS, pairs % BUCKETS), n_words


def _telling(text: np.ndarray, bucket: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Per text and domain the TELLING largest weights of its words; 0 for words that are missing.

    `text` is in rising order.
    """
    out = np.zeros((n, weights.shape[1], TELLING))
    if not len(text):
        return out.reshape(n, -1)
    starts = np.flatnonzero(np.diff(text, prepend=-1))
    holder, number = text[starts], np.cumsum(np.diff(text, prepend=-1) > 0) - 1
    for k in range(weights.shape[1]):
        left = weights[bucket, k]
        for rank in range(TELLING):
            top = np.maximum.reduceat(left, starts)
            out[holder, k, rank] = np.maximum(top, 0)
            # One word that has the largest weight leaves.
            at = np.flatnonzero(left == top[number])
            left[at[np.flatnonzero(np.diff(number[at], prepend=-1))]] = -1
    return out.reshape(n, -1)


def _word_weights(text: np.ndarray, bucket: np.ndarray, domain: np.ndarray, k: int) -> np.ndarray:
    """Per bucket and domain, how many standard errors its share of the domain's texts stands above
    its share of the other texts (log scale, 0 where below)."""
    held = np.zeros((BUCKETS, k))
    np.add.at(held, (bucket, domain[text]), 1)
    size = np.bincount(domain, minlength=k)
    rest, others = held.sum(axis=1, keepdims=True) - held, len(domain) - size
    both = (held + rest + 1) / (len(domain) + 2)
    error = np.sqrt(both * (1 - both) * (1 / np.maximum(size, 1) + 1 / np.maximum(others, 1)))
    apart = held / np.maximum(size, 1) - rest / np.maximum(others, 1)
    return np.log1p(np.maximum(apart / error, 0))


@dataclass
class Classifier:
    """Softmax over statistics and telling words; `names` are the domains in order."""

    names: list[str]
    word_weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray
    edges: np.ndarray
    weights: np.ndarray

    def inputs(self, full: np.ndarray, telling: np.ndarray) -> np.ndarray:
        x = np.hstack([full, telling])
        above = (x[:, :, None] > self.edges[None]).reshape(len(x), -1)
        return np.hstack([(x - self.mean) / self.scale, above, np.ones((len(x), 1))])

    def posterior(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Posteriors, and tokens per text."""
        full, (text, bucket), n_words = _words(column)
        telling = _telling(text, bucket, self.word_weights, len(full))
        return _odds(self.inputs(full, telling) @ self.weights), n_words


def _odds(logits: np.ndarray) -> np.ndarray:
    odds = np.exp(logits - logits.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def fit_classifier(
    docs: DataFrame, labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rows: int = LABELLED_ROWS,
) -> Classifier:
    """Fit on at most `rows` labelled documents, drawn by a hash of their id.

    `labelled` is (doc_id, domain); rows without either are not used, null texts count as empty and
    repeated ids count each. Without any labelled document there is one domain, "all". Word weights
    that a document is fitted with come from the half of the documents that it is not in.
    """
    drawn = (
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"))
        .join(by_merge(labelled.where("doc_id IS NOT NULL AND domain IS NOT NULL")), "doc_id")
        .select("doc_id", "domain").distinct()
        .orderBy(F.xxhash64("doc_id", F.lit(SEED)), "domain").limit(rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            full, (text, bucket), _ = _words(part.column(1))
            edges = np.searchsorted(text, np.arange(1, len(full)))
            yield pa.record_batch([
                part.column(0), part.column(2),
                pa.array([row.tobytes() for row in full.astype("<f8")]),
                pa.array([b.tobytes() for b in np.split(bucket.astype("<u2"), edges)][:len(full)]),
            ], ["doc_id", "domain", "x", "buckets"])

    # At most `rows` rows, and at most BUCKETS numbers a row, so the result is bounded.
    texts = id_and_text(docs, id_col, text_col).join(F.broadcast(drawn), "doc_id")
    found = texts.mapInArrow(run, "doc_id bigint, domain string, x binary, buckets binary").collect()
    found.sort(key=lambda r: (r.domain, r.doc_id, bytes(r.x)))
    names = sorted({r.domain for r in found}) or ["all"]
    k, size = len(names), len(stats.FULL)
    full = np.stack([np.frombuffer(r.x, "<f8") for r in found]) if found else np.zeros((1, size))
    words = [np.frombuffer(r.buckets, "<u2").astype(np.int64) for r in found] or [np.zeros(0, np.int64)]
    text, bucket = np.repeat(np.arange(len(full)), [len(w) for w in words]), np.concatenate(words)
    domain = np.array([names.index(r.domain) for r in found] or [0])
    telling = np.zeros((len(full), k * TELLING))
    half = np.arange(len(full)) % 2
    for own in (0, 1):
        other = half != own
        number = np.cumsum(other) - 1
        learnt = other[text]
        weights = _word_weights(number[text[learnt]], bucket[learnt], domain[other], k)
        part = _telling(text[~learnt], bucket[~learnt], weights, len(full))
        telling[~other] = part[~other]
    x = np.hstack([full, telling])
    scale = x.std(axis=0)
    edges = np.quantile(x, np.linspace(0, 1, QUANTILES + 2)[1:-1], axis=0).T
    model = Classifier(
        names, _word_weights(text, bucket, domain, k), x.mean(axis=0),
        np.where(scale > 1e-6, scale, 1), edges, np.zeros(0),
    )
    model.weights = _softmax_fit(model.inputs(full, telling), np.eye(k)[domain])
    return model


def _softmax_fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps on the penalised likelihood, until its gradient is nothing.

    A step that does not lower the loss is halved; the loss is strictly convex, so this ends.
    """
    n, d = x.shape
    k = y.shape[1]
    weights = np.zeros((d, k))

    def loss(w: np.ndarray) -> float:
        logits = x @ w
        top = logits.max(axis=1)
        sums = top + np.log(np.exp(logits - top[:, None]).sum(axis=1))
        return (sums - (logits * y).sum(axis=1)).mean() + DECAY / 2 * (w ** 2).sum()

    now = loss(weights)
    for _ in range(ROUNDS):
        odds = _odds(x @ weights)
        slope = x.T @ (odds - y) / n + DECAY * weights
        if np.abs(slope).max() < 1e-9:
            break
        curve = np.empty((k, d, k, d))
        for a in range(k):
            for b in range(a, k):
                share = odds[:, a] * ((a == b) - odds[:, b]) / n
                curve[a, :, b] = curve[b, :, a] = x.T @ (share[:, None] * x)
        step = np.linalg.solve(
            curve.reshape(k * d, k * d) + DECAY * np.eye(k * d), slope.T.ravel()
        ).reshape(k, d).T
        size = 1.0
        while (new := loss(weights - size * step)) > now and size > 1e-6:
            size /= 2
        weights, now = weights - size * step, new
    return weights


def memberships(docs: DataFrame, model: Classifier, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, n_tokens, posterior) of every row, over whole texts.

    Null and empty texts have no tokens and the posterior of an empty text; repeated rows and null
    ids stay. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            p, n_words = model.posterior(part.column(1))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(p.ravel()), p.shape[1])
            yield pa.record_batch([
                part.column(0), pa.array(n_words, pa.int64()), rows.cast(pa.list_(pa.float64()))
            ], ["doc_id", "n_tokens", "posterior"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, n_tokens bigint, posterior array<double>"
    )


def _dot(p: Column, v: Column | np.ndarray, k: int) -> Column:
    terms = [F.get(p, F.lit(j)) * (v[j] if isinstance(v, Column) else F.lit(float(v[j]))) for j in range(k)]
    return sum(terms[1:], terms[0])


def _held_back(rate: Column, uphill: Column, max_rate: float) -> Column:
    """At an end of its range, and coming nearer to the targets only beyond it."""
    return ((rate <= 0) & (uphill > 0)) | ((rate >= max_rate) & (uphill < 0))


def _stepped(rate: Column, step: Column, error: Column, k: int, max_rate: float) -> Column:
    """One projected step; rows that are held back stay."""
    p = F.col("posterior")
    moved = F.least(F.lit(float(max_rate)), F.greatest(F.lit(0.0), rate - _dot(p, step, k)))
    return F.when(_held_back(rate, _dot(p, error, k), max_rate), rate).otherwise(moved)


def _replayed(steps: list[tuple[np.ndarray, np.ndarray]], k: int, max_rate: float) -> Column:
    """The rate after some projected steps, each a step and the error it was made from."""
    if not steps:
        return F.col("rate")
    made = F.array(*[
        F.struct(
            F.array(*[F.lit(float(v)) for v in step]).alias("step"),
            F.array(*[F.lit(float(v)) for v in error]).alias("error"),
        ) for step, error in steps
    ])
    return F.aggregate(
        made, F.col("rate"), lambda r, s: _stepped(r, s["step"], s["error"], k, max_rate)
    )


def _sums(rows: DataFrame, columns: list[Column], extra: list[Column] = ()) -> np.ndarray:
    found = rows.agg(*[F.sum(c) for c in columns], *extra).first()
    return np.array([v or 0.0 for v in found])


def fit_rates(
    members: DataFrame, names: list[str], targets: Mapping[str, float], anchor: str,
    max_rate: float = float("inf"),
) -> DataFrame:
    """`members` with the `rate` of each row.

    `targets` are the wanted shares of expected tokens per domain (missing ones 0); the total is
    set so that the `anchor` domain keeps the tokens it has. Rows without tokens, or with null
    tokens, keep rate 1. If no rates meet the targets, these are the nearest they allow. Repeated
    rows count each; an empty table gives no rows.
    """
    k = len(names)
    rows = store(members.withColumn("rate", F.lit(float(min(1.0, max_rate)))), "mixing")
    n, p = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("double"), F.col("posterior")
    one = [F.get(p, F.lit(j)) for j in range(k)]
    has = _sums(rows, [n * q for q in one])
    share = np.array([max(targets.get(name, 0.0), 0.0) for name in names])
    total = has.sum()
    if share.sum() <= 0 or total <= 0:
        return rows
    share /= share.sum()
    at = names.index(anchor) if anchor in names and share[names.index(anchor)] > 0 else None
    want = share * (has[at] / share[at] if at is not None else total)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    error = _sums(rows, [F.col("rate") * n * q for q in one]) - want
    while np.abs(error).max() > TOLERANCE * total:
        now = rows.withColumn("now", _replayed(steps, k, max_rate))
        # Rows that can move, and how far they are from where the plain gradient would put them.
        uphill = _dot(p, error / total, k)
        free = n * F.when(_held_back(F.col("now"), uphill, max_rate), 0.0).otherwise(1.0)
        wish = F.least(F.lit(float(max_rate)), F.greatest(F.lit(0.0), F.col("now") - uphill))
        found = _sums(
            now, [free * a * b for a in one for b in one],
            [F.max(F.when(n > 0, F.abs(F.col("now") - wish)).otherwise(0.0))],
        )
        if found[-1] <= TOLERANCE:
            break
        moments = found[:-1].reshape(k, k)
        options = [
            size * np.linalg.pinv(moments + damp * np.trace(moments) * np.eye(k), hermitian=True) @ error
            for damp in DAMPED for size in SIZES
        ]
        ahead = now.select(p, *[
            (_stepped(F.col("now"), _literal(step), _literal(error), k, max_rate) * n).alias(f"at{i}")
            for i, step in enumerate(options)
        ])
        reached = _sums(ahead, [F.col(f"at{i}") * q for i in range(len(options)) for q in one])
        reached = reached.reshape(len(options), k) - want
        best = int(np.square(reached).sum(axis=1).argmin())
        if np.square(reached[best]).sum() >= (1 - PROGRESS) * np.square(error).sum():
            break
        steps.append((options[best], error))
        error = reached[best]
        if len(steps) == STORED_EVERY:
            rows = store(rows.withColumn("rate", _replayed(steps, k, max_rate)), "mixing")
            steps = []
    return rows.withColumn("rate", F.when(n == 0, F.lit(1.0)).otherwise(_replayed(steps, k, max_rate)))


def _literal(v: np.ndarray) -> Column:
    return F.array(*[F.lit(float(x)) for x in v])


def copies(rate: Column, key: Column) -> Column:
    """Whole copies of expected number `rate`: its floor, and one more by a hash of the key."""
    unit = F.pmod(F.xxhash64(key, F.lit(SEED)), F.lit(1 << 32)) / F.lit(float(1 << 32))
    whole = F.floor(rate)
    return (whole + (unit < rate - whole).cast("bigint")).cast("int")


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the label table: junk, toxic or clean; unknown where a label is null."""
    return labels.select(
        "doc_id",
        F.when(F.col("quality") == 0, "junk").when(F.col("toxic") == 1, "toxic")
        .when((F.col("quality") == 1) & (F.col("toxic") == 0), "clean").alias("domain"),
    )
