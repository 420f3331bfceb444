"""Seeded, repeatable picks.

A pick depends only on the seed, its label and the row's own id, never on where the
row is computed, so a task that runs again after a lost executor gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hex digits are 60 bits: they fit a BIGINT and leave the modulus unbiased for
# dimensions of any size in practice.
DIGITS = 15


def draw(seed: int, label: str, *ids: Column) -> Column:
    """A uniform BIGINT in [0, 2^60)."""
    text = F.concat_ws("|", F.lit(str(seed)), F.lit(label), *[i.cast("string") for i in ids])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("bigint")


def pick(size: Column | int, seed: int, label: str, *ids: Column) -> Column:
    """A uniform BIGINT in [0, size)."""
    bound = F.lit(size) if isinstance(size, int) else size
    return draw(seed, label, *ids) % bound


def weighted_pick(choices: list[tuple[Column, int]], seed: int, label: str, *ids: Column) -> Column:
    """One of ``choices`` (value, whole-number weight) with chance weight / total."""
    point = pick(sum(weight for _, weight in choices), seed, label, *ids)
    upper, result = 0, None
    for value, weight in choices:
        upper += weight
        branch = point < upper
        result = F.when(branch, value) if result is None else result.when(branch, value)
    return result
