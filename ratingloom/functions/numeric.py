"""Number expressions shared by every ranking."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Scores are published and ranked on this grid, so that the order in which a
# shuffle happened to add the terms cannot change a rank.
GRID = 1e6


def snap(x: Column) -> Column:
    """Round a double half-up to six decimals."""
    return F.floor(x * F.lit(GRID) + F.lit(0.5)).cast("double") / F.lit(GRID)


# Fixed values of the seeded hash: a Weyl step for each id, the modulus and a
# multiplier of the minimal-standard generator.
USER_STEP = 1103515245
ITEM_STEP = 1327217885
MODULUS = 2147483647
MULTIPLIER = 48271


def next_prime(n: int) -> int:
    """The least prime that is not below ``n``."""
    p = max(2, n)
    while any(p % d == 0 for d in range(2, math.isqrt(p) + 1)):
        p += 1
    return p


def seeded_hash(user: Column, item: Column, seed: Column | int) -> Column:
    """A bigint in [0, 2^31-1) that depends on the two ids and the seed only.

    Arithmetic rather than ``rand()``: the value does not depend on partitioning,
    so a lost executor recomputes the same sample. Written as mod/multiply steps
    that stay below 2^63, so any SQL engine gives the same numbers.
    """
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    m = F.lit(MODULUS).cast("bigint")

    def step(x: Column, by: int) -> Column:
        return (F.pmod(x.cast("bigint"), m) * F.lit(by).cast("bigint")) % m

    mixed = (step(user, USER_STEP) + step(item, ITEM_STEP) + step(seed + F.lit(1), MULTIPLIER)) % m
    squared = (mixed * mixed + F.lit(1).cast("bigint")) % m
    return ((squared * F.lit(MULTIPLIER).cast("bigint")) % m + mixed) % m
