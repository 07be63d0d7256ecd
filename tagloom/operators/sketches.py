"""Distinct counts that add up: sketches per group, stored as columns and merged for any range of groups."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Logarithm of the registers of a sketch.
REGISTERS = 12


def error_bound(registers: int = REGISTERS, deviations: float = 3.0) -> float:
    """The relative error that an estimate keeps within, at so many standard deviations."""
    return deviations * 1.04 / math.sqrt(1 << registers)


def sketches(df: DataFrame, groups: list[str], registers: int = REGISTERS, **columns: str) -> DataFrame:
    """``<groups>`` and a sketch of the distinct values of each column, named by its keyword; nulls do not count.

    A sketch has at most ``2 ** registers`` registers, however many values there are, and is made before the shuffle.
    """
    return df.groupBy(*groups).agg(*[F.hll_sketch_agg(column, registers).alias(name) for name, column in columns.items()])


def merged(stored: DataFrame, groups: list[str], *names: str) -> DataFrame:
    """Estimated distinct values over all stored sketches of each group; no row is read again."""
    return stored.groupBy(*groups).agg(*[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in names])
