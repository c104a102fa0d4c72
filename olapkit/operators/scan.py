"""Scans in order, top rows, unions and whole-table differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


#: Copies of a row that one array stands for.
COPIES = 4096


def by_position(df: DataFrame, positions: Sequence[int]) -> DataFrame:
    return df.select(*[df.columns[i] for i in positions])


def scan_ordered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows in key order: a range shuffle, then a sort inside each task."""
    return df.orderBy(*keys)


def top_rows(df: DataFrame, k: int, *order: str | Column) -> DataFrame:
    """The first ``k`` rows; each task keeps only ``k``."""
    return df.orderBy(*order).limit(k)


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of all inputs; a column one of them lacks is null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def count_distinct(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """Distinct values of each column in one row; the approximate form keeps a small sketch
    per column instead of the values."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(c) for c in columns])


def table_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, with multiplicity, that only one side has; empty when the tables are equal.

    Each side is counted per distinct row before the shuffle, so a row that
    repeats many times is one row per task. Extra copies come back as rows.
    """
    columns = left.columns
    if sorted(columns) != sorted(right.columns):
        raise ValueError("the tables have different columns")
    signed = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    balance = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    side = F.when(F.col("_n") > 0, "left").otherwise("right")
    # Copies come back in runs of bounded length, dealt out before they are made.
    runs = balance.select(
        side.alias("side"),
        *columns,
        F.abs("_n").alias("_n"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.abs("_n") - 1) / COPIES))).alias("_run"),
    )
    most = F.least(F.lit(COPIES).cast("long"), F.col("_n") - F.col("_run") * COPIES)
    return runs.select("side", *columns, F.explode(F.sequence(F.lit(1).cast("long"), most)).alias("_copy")).drop("_copy")
