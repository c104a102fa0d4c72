"""The five decision-support queries on the snowflake tables.

Each groups before it joins where that shrinks the shuffle: a key that owns a
large share of the rows is then one row per map task, not one oversized reducer.
No join carries a broadcast hint; Spark broadcasts a side when its size allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def day(text: str) -> Column:
    return F.to_date(F.lit(text))


def net_price() -> Column:
    return F.col("l_extendedprice") * (1 - F.col("l_discount"))


def charge() -> Column:
    return net_price() * (1 + F.col("l_tax"))


def pricing_summary(lineitem: DataFrame, until: str = "1998-12-01", days: int = 90) -> DataFrame:
    """Totals and averages of lines shipped at least ``days`` before ``until``."""
    return (
        lineitem.filter(F.col("l_shipdate") <= F.date_sub(day(until), days))
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.sum("l_extendedprice").alias("sum_base_price"),
            F.sum(net_price()).alias("sum_disc_price"),
            F.sum(charge()).alias("sum_charge"),
            F.avg("l_quantity").alias("avg_qty"),
            F.avg("l_extendedprice").alias("avg_price"),
            F.avg("l_discount").alias("avg_disc"),
            F.count(F.lit(1)).alias("count_order"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


def order_revenue(
    customer: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    segment: str = "HOUSEHOLD",
    ordered_before: str = "2000-08-29",
    shipped_after: str = "1990-08-29",
) -> DataFrame:
    """Revenue of each order of one market segment, highest first."""
    revenue = (
        lineitem.filter(F.col("l_shipdate") > day(shipped_after))
        .groupBy("l_orderkey")
        .agg(F.sum(net_price()).alias("revenue"))
    )
    buyers = customer.filter(F.col("c_mktsegment") == segment).select("c_custkey")
    wanted = (
        orders.filter(F.col("o_orderdate") < day(ordered_before))
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_shippriority")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"), "left_semi")
    )
    return (
        wanted.join(revenue, F.col("o_orderkey") == F.col("l_orderkey"))
        .select("l_orderkey", "revenue", "o_orderdate", "o_shippriority")
        .orderBy(F.desc("revenue"), "o_orderdate")
    )


def late_lines(lineitem: DataFrame) -> DataFrame:
    """Keys of the orders with a line received after its commit date."""
    return (
        lineitem.filter(F.col("l_commitdate") < F.col("l_receiptdate"))
        .select("l_orderkey")
        .distinct()
    )


def priority_count(
    orders: DataFrame,
    lineitem: DataFrame,
    start: str = "1990-01-01",
    end: str = "1996-05-04",
    months: int = 3,
) -> DataFrame:
    """Orders with a late line, counted by priority."""
    return (
        orders.filter(
            (F.col("o_orderdate") >= day(start))
            & (F.col("o_orderdate") < F.add_months(day(end), months))
        )
        .join(late_lines(lineitem), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")
        .groupBy("o_orderpriority")
        .agg(F.count(F.lit(1)).alias("order_count"))
        .orderBy("o_orderpriority")
    )


def local_supplier_volume(
    customer: DataFrame,
    orders: DataFrame,
    lineitem: DataFrame,
    supplier: DataFrame,
    nation: DataFrame,
    region: DataFrame,
    region_name: str = "AMERICA",
    start: str = "1992-01-01",
    end: str = "1998-04-02",
    years: int = 1,
) -> DataFrame:
    """Revenue by nation where customer and supplier share that nation.

    Both sides are cut to the region first. Revenue is summed per supplier and
    nation before the supplier join, so that join sees each pair once.
    """
    nations = nation.join(
        region.filter(F.col("r_name") == region_name),
        F.col("n_regionkey") == F.col("r_regionkey"),
    ).select("n_nationkey", "n_name")
    buyers = customer.join(
        nations, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi"
    ).select("c_custkey", "c_nationkey")
    sellers = supplier.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", "s_nationkey", "n_name"
    )
    bought = (
        orders.filter(
            (F.col("o_orderdate") >= day(start))
            & (F.col("o_orderdate") < F.add_months(day(end), 12 * years))
        )
        .select("o_orderkey", "o_custkey")
        .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "c_nationkey")
    )
    by_supplier = (
        lineitem.select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount")
        .join(sellers, F.col("l_suppkey") == F.col("s_suppkey"), "left_semi")
        .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey", "c_nationkey")
        .agg(F.sum(net_price()).alias("part_revenue"))
    )
    return (
        by_supplier.join(
            sellers,
            (F.col("l_suppkey") == F.col("s_suppkey"))
            & (F.col("c_nationkey") == F.col("s_nationkey")),
        )
        .groupBy("n_name")
        .agg(F.sum("part_revenue").alias("revenue"))
        .orderBy(F.desc("revenue"))
    )


def forecast_revenue(
    lineitem: DataFrame,
    start: str = "1990-01-01",
    end: str = "1996-08-09",
    years: int = 1,
    low: float = 0.04,
    high: float = 0.06,
    quantity: int = 40,
) -> DataFrame:
    """Discount money on small lines shipped in a period."""
    return lineitem.filter(
        (F.col("l_shipdate") >= day(start))
        & (F.col("l_shipdate") < F.add_months(day(end), 12 * years))
        & F.col("l_discount").between(low, high)
        & (F.col("l_quantity") < quantity)
    ).agg(F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("revenue"))
