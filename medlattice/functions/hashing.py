"""Integer hashes that any SQL engine can reproduce.

A row's hash depends on its key and a seed only, never on partitioning, so splits, samples and
shuffles stay the same when data is repartitioned or a task is retried.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: prime 2^31 - 1: the square of a residue still fits a signed 64-bit integer
MODULUS = 2147483647

#: modulus of the fixture draws
DRAW_MODULUS = 1000003


def _long(value: int) -> Column:
    return F.lit(value).cast("bigint")


def key_hash(key: Column | str, seed: Column | int = 42) -> Column:
    """Hash of an integer key in ``[0, MODULUS)``: linear step, squaring step, linear step.

    The squaring step breaks the lattice a purely linear hash leaves on consecutive keys.
    """
    key = F.col(key) if isinstance(key, str) else key
    seed = _long(seed) if isinstance(seed, int) else seed.cast("bigint")
    modulus = _long(MODULUS)
    first = F.pmod(F.pmod(key.cast("bigint"), modulus) * _long(48271) + seed * _long(16807) + _long(11), modulus)
    second = F.pmod(first * first + first * _long(3) + seed, modulus)
    return F.pmod(second * _long(69621) + _long(7), modulus)


def draw(key: Column | str, multiplier: int, offset: int) -> Column:
    """Linear draw ``(key * multiplier + offset) mod 1000003``, reduced first so that it cannot
    overflow for any 64-bit key."""
    key = F.col(key) if isinstance(key, str) else key
    modulus = _long(DRAW_MODULUS)
    return F.pmod(F.pmod(key.cast("bigint"), modulus) * _long(multiplier) + _long(offset), modulus)


def uniform(key: Column | str, seed: int, stream: int) -> Column:
    """Uniform double in (0, 1) for (key, seed, stream); 53 random bits."""
    key = F.col(key) if isinstance(key, str) else key
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed), F.lit(stream)), 11)
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(2**53))


def normal(key: Column | str, seed: int, stream: int) -> Column:
    """Standard normal draw by the Box-Muller transform on two uniforms."""
    radius = F.sqrt(F.lit(-2.0) * F.log(uniform(key, seed, 2 * stream)))
    return radius * F.cos(F.lit(6.283185307179586) * uniform(key, seed, 2 * stream + 1))
