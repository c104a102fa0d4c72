"""Distinct counts that are stored and added up: one sketch per group, united later.

A sketch of 2^k registers estimates the number of distinct values with a standard error of 1.04 / sqrt(2^k),
whatever their number, and the union of sketches is the sketch of the union. So counts by day, stored once, give
counts by month or in all without a second look at the rows. Nulls are not counted. Few values are counted exactly
or nearly so.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Log2 of the registers: 16 KiB a sketch, standard error 0.8 %.
REGISTERS = 14


def standard_error(registers: int = REGISTERS) -> float:
    return 1.04 / math.sqrt(1 << registers)


def distinct_sketches(
    df: DataFrame, by: Sequence[str], columns: Sequence[str], registers: int = REGISTERS
) -> DataFrame:
    """One row per group with a sketch of each column; built in the tasks, united in the shuffle."""
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c), F.lit(registers)).alias(c) for c in columns])


def united(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups."""
    return sketches.groupBy(*by).agg(*[F.hll_union_agg(c).alias(c) for c in columns])


def estimates(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The sketches replaced by the numbers of distinct values they stand for."""
    return sketches.withColumns({c: F.hll_sketch_estimate(c) for c in columns})


def count_distinct_stored(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return estimates(united(sketches, by, columns), columns)


def within(estimate: Column, exact: Column, registers: int = REGISTERS, errors: float = 4.0) -> Column:
    """Whether an estimate lies within some standard errors of the exact number, and a half."""
    return F.abs(estimate - exact) <= exact * (errors * standard_error(registers)) + 0.5


def overlap(sketches: DataFrame, pairs: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """By inclusion and exclusion, how many values both sketches of a pair hold; the error is that of their union."""

    def shared(a: Column, b: Column) -> Column:
        both = F.hll_sketch_estimate(a) + F.hll_sketch_estimate(b) - F.hll_sketch_estimate(F.hll_union(a, b))
        return F.greatest(both, F.lit(0))

    return sketches.withColumns({name: shared(a, b) for name, (a, b) in pairs.items()})
