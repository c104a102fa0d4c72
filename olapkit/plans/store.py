"""Queries on the keyed line item table, whose dates are ISO strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def store_line_item(lineitem: DataFrame) -> DataFrame:
    """Key columns first, whole quantities, dates as text."""
    texts = [c for c in ("l_shipdate", "l_commitdate", "l_receiptdate") if c in lineitem.columns]
    typed = lineitem.withColumns(
        {
            "l_quantity": F.col("l_quantity").cast("int"),
            **{c: F.date_format(c, "yyyy-MM-dd") for c in texts},
        }
    )
    keys = ["l_orderkey", "l_linenumber"]
    return typed.select(*keys, *[c for c in lineitem.columns if c not in keys])


def pricing(store: DataFrame, until: str = "1998-09-02", *extra: Column) -> DataFrame:
    kept = store.filter(F.col("l_shipdate") <= until)
    for condition in extra:
        kept = kept.filter(condition)
    return kept.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"),
        F.sum("l_extendedprice").alias("sum_base_price"),
        F.avg("l_quantity").alias("avg_qty"),
        F.avg("l_extendedprice").alias("avg_price"),
        F.avg("l_discount").alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"),
    )


def pricing_of_orders(store: DataFrame, first: int, last: int) -> DataFrame:
    """The same over the order keys first..last, both included."""
    return pricing(store, "1998-09-02", F.col("l_orderkey").between(first, last))


def matching_rows(summary: DataFrame) -> DataFrame:
    return summary.agg(F.sum("count_order").alias("matching_rows"))
