"""Predicates that Parquet can prune with, and a Bloom prefilter."""

from __future__ import annotations

import json
import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_COMPARE = {
    "=": operator.eq,
    ">": operator.gt,
    ">=": operator.ge,
    "<": operator.lt,
    "<=": operator.le,
}


def all_of(*predicates: Column) -> Column:
    return reduce(operator.and_, predicates, F.lit(True))


def json_predicate(df: DataFrame, spec: str | list) -> Column:
    """A column from ``["AND", [op, column, value], ["IN", column, [..]], ["NULL", column], ..]``."""
    node = json.loads(spec) if isinstance(spec, str) else spec
    if not isinstance(node, list) or not node:
        raise ValueError(f"not a predicate: {node!r}")
    kind = str(node[0]).upper()
    if kind == "AND":
        return all_of(*[json_predicate(df, part) for part in node[1:]])
    if len(node) < 2 or node[1] not in df.columns:
        raise ValueError(f"unknown column in {node!r}")
    column, kind_of = F.col(node[1]), df.schema[node[1]].dataType
    if kind in ("NULL", "NOTNULL") and len(node) == 2:
        return column.isNull() if kind == "NULL" else column.isNotNull()
    if len(node) != 3:
        raise ValueError(f"not a predicate: {node!r}")
    if kind == "IN":
        return column.isin(*[F.lit(v).cast(kind_of) for v in node[2]])
    if kind in _COMPARE:
        return _COMPARE[kind](column, F.lit(node[2]).cast(kind_of))
    raise ValueError(f"unknown predicate {node[0]!r}")


def filter_json(df: DataFrame, spec: str | list) -> DataFrame:
    return df.filter(json_predicate(df, spec))


def key_range(
    df: DataFrame,
    keys: Sequence[str],
    lower: Sequence | None = None,
    upper: Sequence | None = None,
) -> DataFrame:
    """Rows whose key tuple is in ``[lower, upper)``; the first column also prunes files."""

    def bound(values):
        if len(values) != len(keys):
            raise ValueError("a bound needs one value per key column")
        cells = [F.lit(v).cast(df.schema[k].dataType).alias(k) for k, v in zip(keys, values)]
        return F.struct(*cells), F.lit(values[0]).cast(df.schema[keys[0]].dataType)

    row, first = F.struct(*keys), F.col(keys[0])
    if lower is not None:
        low, low_first = bound(lower)
        df = df.filter((first >= low_first) & (row >= low))
    if upper is not None:
        high, high_first = bound(upper)
        df = df.filter((first <= high_first) & (row < high))
    return df


def bloom_words(keys: DataFrame, column: str, bits: int = 1 << 20, hashes: int = 3) -> DataFrame:
    """A Bloom filter of ``column`` as at most ``bits / 64`` rows (word, mask)."""
    positions = [F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(bits)) for i in range(hashes)]
    return (
        keys.filter(F.col(column).isNotNull())
        .select(F.explode(F.array(*positions)).alias("position"))
        .groupBy(F.floor(F.col("position") / 64).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(position % 64 AS INT))")).alias("mask"))
    )


def might_contain(
    df: DataFrame, column: str, words: DataFrame, bits: int = 1 << 20, hashes: int = 3
) -> DataFrame:
    """Rows whose value may be in the filter: no false negatives, few false positives.

    ``words`` has at most ``bits / 64`` rows, so it is broadcast; the large side
    does not move. Follow with an exact ``left_semi`` join.
    """
    if bits > 1 << 27:
        raise ValueError("the filter is broadcast: use at most 2^27 bits (2M words)")
    words = F.broadcast(words)
    for i in range(hashes):
        position = F.pmod(F.xxhash64(F.col(column), F.lit(i)), F.lit(bits))
        hit = words.select(F.col("word").alias("_word"), F.col("mask").alias("_mask"))
        probe = df.withColumn("_position", position)
        bit = (F.col("_position") % 64).cast("int")
        df = probe.join(
            hit,
            (F.floor(F.col("_position") / 64) == F.col("_word"))
            & (F.call_function("getbit", F.col("_mask"), bit) == 1),
            "left_semi",
        ).drop("_position")
    return df


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows; the job fails on a null in one of ``columns``."""
    checks = all_of(
        *[
            F.assert_true(F.col(c).isNotNull(), F.lit(f"null in {c}")).isNull()
            for c in columns
        ]
    )
    return df.filter(checks)
