"""Exact consecutive numbers without putting a group into one task.

Rows are range-partitioned and sorted, so each task holds a run of the final
order, whatever the size of a group. The position inside a run comes from
``monotonically_increasing_id`` (task number in the high bits, position in the
low 33), and the runs are joined with the number of rows before them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from olapkit.workspace import materialize

_PLACE, _RUN, _TIE = "_place", "_run", "_tie"


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "row_id",
    within: Sequence[str] = (),
    start: int = 1,
) -> DataFrame:
    """Add ``name`` = start, start+1, ... in the given order, per ``within`` group.

    Rows that tie keep their input order; the tie-breaker also lets a single
    repeated value spread over many tasks.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    sort = [*[F.col(c) for c in within], *order, F.col(_TIE)]
    placed = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .drop(_TIE)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    rows = materialize(placed, "numbered").withColumn(_RUN, F.shiftright(_PLACE, 33))
    # One row per task and group: the group's first place in that task, and its size there.
    runs = rows.groupBy(_RUN, *within).agg(
        F.min(_PLACE).alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    earlier = Window.partitionBy(*within).orderBy(_RUN).rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(
        F.col(_RUN).alias("_run2"),
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(within)],
        (F.coalesce(F.sum("_size").over(earlier), F.lit(0)) - F.col("_first") + start).alias(
            "_shift"
        ),
    )
    match = F.col(_RUN) == F.col("_run2")
    for i, c in enumerate(within):
        match = match & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(offsets, match).select(
        *df.columns, (F.col(_PLACE) + F.col("_shift")).alias(name)
    )


def unique_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """A unique number per row in no particular order, without a shuffle."""
    return df.withColumn(name, F.monotonically_increasing_id())


def split_batches(df: DataFrame, size: int, order_by: Sequence[str | Column]) -> DataFrame:
    """Add ``batch`` = 0, 1, ...: every batch but the last has ``size`` rows."""
    if size < 1:
        raise ValueError("a batch holds at least one row")
    numbered = number_rows(df, order_by, "_n", start=0)
    return numbered.select(*df.columns, F.floor(F.col("_n") / size).alias("batch"))
