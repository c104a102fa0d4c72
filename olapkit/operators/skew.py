"""A join whose large side may hold one key very often."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

_SALT, _HOT = "_salt", "_hot"
HOT_ROWS = 1_000_000


def hot_keys(many: DataFrame, on: Sequence[str], rows: int | None = None) -> DataFrame:
    """Keys with more than ``rows`` rows: at most ``count(many) / rows`` of them."""
    counted = many.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    return counted.filter(F.col("_n") > (rows or HOT_ROWS)).select(*on)


def salted_join(
    many: DataFrame,
    unique: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot: DataFrame | None = None,
    salts: int = 16,
) -> DataFrame:
    """Join ``many`` rows with at most one row per key, spreading hot keys over tasks.

    Rows of ``many`` with a hot key get a salt from their content, and the partner of
    a hot key is copied to every salt, so a key that owns a large share of the rows
    meets its partner in ``salts`` tasks. Adaptive skew handling covers joins of two
    plain shuffles; this is for the others: a side that is itself aggregated, or a
    grouping by more columns right after the join, which would inherit the skewed
    partitions.

    ``hot`` is the result of ``hot_keys``, few enough to broadcast. Without it every
    key is salted, which suits a small ``unique`` side. ``how`` is inner, left,
    left_semi or left_anti. Rows of ``many`` should differ in some column, as equal
    rows share a salt.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    on = list(on)
    salt = F.pmod(F.xxhash64(*many.columns), F.lit(salts)).cast("int")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is None:
        spread = many.withColumn(_SALT, salt)
        copies = unique.select("*", F.explode(every).alias(_SALT))
    else:
        marked = F.broadcast(hot.withColumn(_HOT, F.lit(True)))
        spread = many.join(marked, on, "left").withColumn(
            _SALT, F.when(F.col(_HOT), salt).otherwise(0)
        )
        copies = unique.join(marked, on, "left").withColumn(
            _SALT, F.explode(F.when(F.col(_HOT), every).otherwise(F.array(F.lit(0))))
        )
        spread, copies = spread.drop(_HOT), copies.drop(_HOT)
    return spread.join(copies, [*on, _SALT], how).drop(_SALT)
