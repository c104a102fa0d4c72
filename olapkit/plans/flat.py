"""The five queries as written for wide rows; their rules differ from the snowflake ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from olapkit.plans.sales import charge, day, net_price


def pricing_by_flag(flat: DataFrame) -> DataFrame:
    """Totals by return flag only, to two decimals, averages as sum over count."""
    n = F.count(F.lit(1))
    return (
        flat.filter(F.col("l_shipdate") <= F.date_sub(day("1998-12-01"), 90))
        .groupBy("l_returnflag")
        .agg(
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"),
            F.round(F.sum(net_price()), 2).alias("sum_disc_price"),
            F.round(F.sum(charge()), 2).alias("sum_charge"),
            F.round(F.sum("l_quantity") / n, 2).alias("avg_qty"),
            F.round(F.sum("l_extendedprice") / n, 2).alias("avg_price"),
            F.round(F.sum("l_discount") / n, 2).alias("avg_disc"),
            n.alias("count_order"),
        )
        .orderBy("l_returnflag")
    )


def revenue_by_order(flat: DataFrame) -> DataFrame:
    """Revenue by order, every market segment, highest first."""
    return (
        flat.filter(
            (F.col("l_shipdate") > day("1990-08-29")) & (F.col("o_orderdate") < day("2000-08-29"))
        )
        .groupBy("o_orderkey")
        .agg(
            F.sum(net_price()).alias("revenue"),
            F.min("o_orderdate").alias("o_orderdate"),
            F.min("o_shippriority").alias("o_shippriority"),
        )
        .orderBy(F.desc("revenue"))
    )


def late_lines_by_priority(flat: DataFrame) -> DataFrame:
    """Late lines (not orders) by priority."""
    return (
        flat.filter(
            (F.col("o_orderdate") >= day("1990-01-01"))
            & (F.col("o_orderdate") < day("1996-05-04"))
            & (F.col("l_commitdate") < F.col("l_receiptdate"))
        )
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .orderBy("o_orderpriority")
    )


def revenue_by_supplier_nation(flat: DataFrame) -> DataFrame:
    """Revenue by supplier nation, every region; the key reads ``nation:<name>``."""
    return (
        flat.filter(
            (F.col("o_orderdate") >= day("1992-01-01")) & (F.col("o_orderdate") < day("1998-04-02"))
        )
        .groupBy("s_nationname")
        .agg(F.sum(net_price()).alias("revenue"))
        .select(F.concat(F.lit("nation:"), "s_nationname").alias("nation"), "revenue")
        .orderBy(F.desc("revenue"))
    )


def discount_revenue(flat: DataFrame) -> DataFrame:
    """Discount money on small lines; a comparison with a missing field drops the row."""
    return flat.filter(
        (F.col("l_shipdate") >= day("1990-01-01"))
        & (F.col("l_shipdate") < day("1996-08-09"))
        & F.col("l_discount").between(0.04, 0.06)
        & (F.col("l_quantity") < 40)
    ).agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("revenue"))
