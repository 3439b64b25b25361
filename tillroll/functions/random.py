"""Random numbers that depend only on a seed, a purpose and row keys.

They are the same however rows are spread over tasks and however often a task runs again, and any engine with md5 can
state them: a number is the first 13 hexadecimal digits of the digest of "seed|purpose|key|…", over 2^52.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_DIGITS = 13


def uniform(seed: int, purpose: str, *keys: Column) -> Column:
    """Number in [0, 1)."""
    text = F.concat_ws("|", F.lit(f"{seed}|{purpose}"), *[key.cast("string") for key in keys])
    bits = F.conv(F.substring(F.md5(text), 1, _DIGITS), 16, 10).cast("bigint")
    return bits.cast("double") / float(1 << (4 * _DIGITS))


def below(limit: Column, seed: int, purpose: str, *keys: Column) -> Column:
    """Whole number in [0, limit)."""
    return F.floor(uniform(seed, purpose, *keys) * limit)


def log_normal(mean: Column | float, sigma: float, seed: int, purpose: str, *keys: Column) -> Column:
    """exp(mean + sigma·z) with z from two uniform numbers by the Box-Muller formula."""
    radius = F.sqrt(F.log(F.lit(1.0) - uniform(seed, purpose + "-radius", *keys)) * -2.0)
    z = radius * F.cos(uniform(seed, purpose + "-angle", *keys) * (2 * math.pi))
    return F.exp(z * sigma + mean)


def pick(choices: Column, u: Column) -> Column:
    """First entry of an array of structs whose running share `upto` exceeds `u`, else the last."""
    # One-element transform: binds the number once instead of computing it for every entry.
    beyond = F.transform(F.array(u), lambda bound: F.get(F.filter(choices, lambda entry: entry["upto"] > bound), F.lit(0)))[0]
    return F.coalesce(beyond, F.element_at(choices, -1))


def running_shares(entries: Column, weight: str) -> Column:
    """Array of structs with `upto`: share of the weights up to and including each entry."""
    total = F.aggregate(entries, F.lit(0.0), lambda a, e: a + e[weight])
    return F.transform(
        entries,
        lambda entry, at: entry.withField(
            "upto", F.aggregate(F.slice(entries, F.lit(1), at + 1), F.lit(0.0), lambda a, e: a + e[weight]) / total
        ),
    )
