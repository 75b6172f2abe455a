"""Column expressions; all of them stay inside generated JVM code."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def clip(value: Column | str, lo: float = 0.5, hi: float = 5.0) -> Column:
    """Clamp to the rating scale; nulls stay null."""
    value = _col(value)
    return F.when(value.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), value)))


def sq_err(actual: Column | str, predicted: Column | str) -> Column:
    gap = _col(actual) - _col(predicted)
    return gap * gap


def relu(value: Column | str) -> Column:
    return F.greatest(F.lit(0.0), _col(value))


def presence(value: Column | str) -> Column:
    """1 for a non-zero cell, 0 for a zero or absent one (the literal missing-value mask)."""
    value = _col(value)
    return F.when(value.isNull() | (value == 0), F.lit(0)).otherwise(F.lit(1))


def pair_key(user: Column | str, item: Column | str, seed: int) -> Column:
    """Seeded md5 text of a (user, item) pair: a reproducible random order."""
    return F.md5(
        F.concat(F.lit(f"{seed}:"), _col(user).cast("string"), F.lit(":"), _col(item).cast("string"))
    )


def pair_hash(user: Column | str, item: Column | str, seed: int) -> Column:
    """First 32 bits of :func:`pair_key` as a non-negative long."""
    return F.conv(F.substring(pair_key(user, item, seed), 1, 8), 16, 10).cast("long")


def dot(left: Column | str, right: Column | str, width: int) -> Column:
    """Inner product of two arrays of known width, unrolled so it compiles to plain arithmetic."""
    left, right = _col(left), _col(right)
    return reduce(lambda a, b: a + b, (left[f] * right[f] for f in range(width)))


def formula_value(ident: Column | str, position: Column | int, table: int) -> Column:
    """Reproducible parameter value for (row, position, table), the same in any engine.

    Fixed values: multipliers 31, 17 and 13, modulus 101, shift 50, scale 100.
    """
    ident = _col(ident)
    position = F.lit(position) if isinstance(position, int) else position
    return (((ident * 31 + position * 17 + table * 13) % 101) - 50) / F.lit(100.0)
