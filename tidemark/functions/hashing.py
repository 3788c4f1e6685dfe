"""Seeded uniform numbers from a strong hash of seed and key.

The same key and seed give the same number in every run, on every executor and in every SQL
engine, so sampling does not depend on row order or partitioning. Numbers of different seeds are
independent.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = 1_000_000
# Hex digits that fit a bigint.
DIGITS = 15


def uniform_millionths(key: Column, seed: int) -> Column:
    """An integer in [0, 1_000_000) for each key."""
    text = F.concat(F.lit(f"{seed}:"), key.cast("bigint").cast("string"))
    digits = F.substring(F.md5(text.cast("binary")), 1, DIGITS)
    return (F.conv(digits, 16, 10).cast("bigint") % UNIT).cast("int")


def weighted_choice(key: Column, seed: int, weights: list[tuple[object, int]]) -> Column:
    """Pick a value with probability proportional to its integer weight."""
    total = sum(w for _, w in weights)
    draw = uniform_millionths(key, seed).cast("bigint") * total
    choice, reached = None, 0
    for value, weight in weights:
        reached += weight
        hit = draw < reached * UNIT
        choice = F.when(hit, F.lit(value)) if choice is None else choice.when(hit, F.lit(value))
    return choice
