"""Ratios, clips, logit and sigmoid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio_change(recent: Column, prior: Column) -> Column:
    """(recent - prior) / prior where prior is positive, else 0; rounded to 4 places.

    An empty recent window counts as 0, so activity that stopped gives -1.
    """
    r = F.coalesce(recent, F.lit(0.0))
    return F.round(F.when(prior > 0, (r - prior) / prior).otherwise(F.lit(0.0)), 4)


def floored_diff(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), a - b).cast("int")


def safe_rate(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator, null where the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def logit(p: Column) -> Column:
    clipped = F.least(F.lit(1.0 - 1e-5), F.greatest(F.lit(1e-5), p))
    return F.ln(clipped / (1.0 - clipped))


def sigmoid(x: Column) -> Column:
    """Logistic function that never evaluates exp of a large positive number."""
    e = F.exp(-F.abs(x))
    return F.when(x >= 0, 1.0 / (1.0 + e)).otherwise(e / (1.0 + e))


def clip_score(score: Column, low: int, high: int) -> Column:
    """Round half to even, then clamp."""
    return F.least(F.lit(high), F.greatest(F.lit(low), F.bround(score).cast("int"))).cast("int")
