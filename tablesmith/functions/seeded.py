"""Reproducible randomness from keys.

The reference draws from generators whose stream depends on row order. A distributed table
has no row order, so a draw here is a function of the row's key and a seed: the same row
gets the same number in any partitioning, after any retry, and in plain SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MODULUS = 2 ** 31

# Fixed values (own choice): odd multipliers below 2^31, and shifts, of three mixing rounds.
ROUNDS = [(15, 0x5BD1E995), (13, 0x2C1B3C6D), (16, 0x297A2D39)]
LAST_SHIFT = 14
# What a seed adds before each round: (seed * multiplier + increment) modulo 2^31.
SEED_STEPS = [(0x3504F333, 0x1B873593), (0x27D4EB2F, 0x165667B1), (0x19660D01, 0x3C6EF35F)]
# How the key's bits 31-61 and 62-63 enter the second round.
HIGH_BITS = (0x2545F491, 0x1F123BB5)


def scramble(key: Column, seed: int | Column = 0) -> Column:
    """Integer in [0, 2^31) from all 64 bits of the key; null for a null key.

    Each round is xor with a shift, multiplication, and a number of the seed's own: seeds enter
    between non-linear steps, so their orders have nothing to do with each other. For one seed
    it is a bijection of the low 31 bits. All products stay in the range of a long.
    """
    key = key.cast("long")
    seed = seed.cast("long") if isinstance(seed, Column) else F.lit(int(seed)).cast("long")
    low_seed = F.pmod(seed, F.lit(MODULUS))
    mask = F.lit(MODULUS - 1)
    high = (F.shiftright(key, 31).bitwiseAND(mask) * F.lit(HIGH_BITS[0])
            + F.shiftright(key, 62).bitwiseAND(F.lit(3)) * F.lit(HIGH_BITS[1])).bitwiseAND(mask)
    x = key.bitwiseAND(mask)
    for i, ((shift, factor), (step, start)) in enumerate(zip(ROUNDS, SEED_STEPS)):
        own = (low_seed * F.lit(step) + F.lit(start)).bitwiseAND(mask)
        x = (x + own + high).bitwiseAND(mask) if i == 1 else (x + own).bitwiseAND(mask)
        x = (x.bitwiseXOR(F.shiftright(x, shift)) * F.lit(factor)).bitwiseAND(mask)
    return x.bitwiseXOR(F.shiftright(x, LAST_SHIFT))


def uniform(key: Column, seed: int | Column = 0) -> Column:
    """Number in [0, 1) for each key."""
    return scramble(key, seed) / F.lit(float(MODULUS))


def uniform_int(key: Column, low: Column, high: Column, seed: int = 0) -> Column:
    """Integer in [low, high) with float bounds truncated toward zero."""
    first = low.cast("long")
    return first + F.floor(uniform(key, seed) * (high.cast("long") - first)).cast("long")
