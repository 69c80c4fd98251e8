"""Counter-based random numbers: a pure function of seed, tag and key, equal under any partitioning and in any SQL engine with md5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(seed: int, tag: str, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(tag), *[k.cast("string") for k in keys]))


def head(seed: int, tag: str, *keys: Column) -> Column:
    """What a digest's text begins with; its last key follows."""
    return F.concat_ws("|", F.lit(str(seed)), F.lit(tag), *[k.cast("string") for k in keys], F.lit(""))


def number(seed: int, tag: str, *keys: Column) -> Column:
    """A whole number of 52 random bits."""
    return _bits(digest(seed, tag, *keys), 1)


def _bits(digest: Column, at: int) -> Column:
    return F.conv(F.substring(digest, at, 13), 16, 10).cast("bigint")


def unit(digest: Column) -> Column:
    """A number in [0, 1) from a digest."""
    return _bits(digest, 1) / F.lit(float(1 << 52))


def second(digest: Column) -> Column:
    """A whole number of 52 bits from a digest, independent of ``unit``."""
    return _bits(digest, 14)


def uniform(seed: int, tag: str, *keys: Column) -> Column:
    """A number in [0, 1)."""
    return number(seed, tag, *keys) / F.lit(float(1 << 52))


def below(n: int, seed: int, tag: str, *keys: Column) -> Column:
    """A whole number in [0, n)."""
    return number(seed, tag, *keys) % F.lit(n)


def order_key(seed: int, *keys: Column) -> Column:
    """Sort key of a seeded shuffle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys]))


def bernoulli(p: float, seed: int, tag: str, *keys: Column) -> Column:
    return uniform(seed, tag, *keys) < p
