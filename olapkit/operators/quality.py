"""Rejecting rows, carrying rejections to child tables, and checking keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def reject(df: DataFrame, predicate: Column, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows kept, keys of the rows that meet the predicate); null counts as not met."""
    met = F.coalesce(predicate, F.lit(False))
    return df.filter(~met), df.filter(met).select(*key).distinct()


def cascade(
    rejected: DataFrame, child: DataFrame, foreign_key: str, child_key: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """(children kept, keys of the children whose parent was rejected).

    ``rejected`` has one column, the parent's key, each value once.
    """
    parent = rejected.select(F.col(rejected.columns[0]).alias(foreign_key))
    kept = child.join(parent, foreign_key, "left_anti")
    # Only key columns of the child are read for the lost ones.
    narrow = child.select(*dict.fromkeys([foreign_key, *child_key]))
    lost = narrow.join(parent, foreign_key, "left_semi").select(*child_key).distinct()
    return kept, lost


def primary_key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that repeat or hold a null, with their number of rows."""
    empty = F.lit(False)
    for k in keys:
        empty = empty | F.col(k).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    reason = F.when(empty, "null").otherwise("duplicate")
    return counted.filter(empty | (F.col("rows") > 1)).withColumn("reason", reason)


def foreign_key_violations(
    child: DataFrame, foreign_key: str, parent: DataFrame, primary_key: str
) -> DataFrame:
    """Values without a parent, with their number of child rows; nulls are allowed.

    Child rows are counted per value first, so a value that owns a large share of
    the rows joins as one row.
    """
    used = (
        child.filter(F.col(foreign_key).isNotNull())
        .groupBy(foreign_key)
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    known = parent.select(F.col(primary_key).alias("_known"))
    return used.join(known, F.col(foreign_key) == F.col("_known"), "left_anti")


def clean_report(table: str, child: DataFrame, foreign_key: str, rejected: DataFrame) -> DataFrame:
    """Rows before, after and removed when children of the rejected parents go."""
    parent = rejected.select(F.col(rejected.columns[0]).alias("_parent"))
    per_key = child.groupBy(foreign_key).agg(F.count(F.lit(1)).alias("_n"))
    marked = per_key.join(parent, F.col(foreign_key) == F.col("_parent"), "left")
    removed = F.coalesce(F.sum(F.when(F.col("_parent").isNotNull(), F.col("_n"))), F.lit(0))
    before = F.coalesce(F.sum("_n"), F.lit(0))
    return marked.agg(
        before.alias("rows_before"),
        (before - removed).alias("rows_after"),
        removed.alias("rows_removed"),
    ).select(F.lit(table).alias("table_name"), "*")
