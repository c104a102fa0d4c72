"""Star, flat and sparse shapes of the snowflake tables, and generator rules.

Inputs may lack optional columns (addresses, phones, comments); each shape keeps
the listed columns that exist.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Columns of each shape, in order.
STAR_LINE = [
    "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_receiptdate", "l_shipinstruct", "l_shipmode",
    "l_comment",
]
FLAT_LINE = [
    "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus", "l_shipdate", "l_commitdate", "l_receiptdate", "l_shipinstruct",
    "l_shipmode",
]
FLAT_ORDER_PART = [
    "o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "o_shippriority",
]
FLAT_CUSTOMER = [
    "c_custkey", "c_name", "c_address", "c_phone", "c_mktsegment", "c_nationname",
    "c_regionname",
]
FLAT_PART = [
    "p_partkey", "p_name", "p_mfgr", "p_brand", "p_type", "p_size", "p_container",
    "p_retailprice",
]
FLAT_SUPPLIER = [
    "s_suppkey", "s_name", "s_address", "s_phone", "s_nationname", "s_regionname",
]
FLAT = [*FLAT_LINE, *FLAT_ORDER_PART, *FLAT_CUSTOMER, *FLAT_PART, *FLAT_SUPPLIER]
STAR_CUSTOMER = [
    "c_custkey", "c_name", "c_address", "c_nationname", "c_regionname", "c_phone", "c_acctbal",
    "c_mktsegment",
]
STAR_SUPPLIER = [
    "s_suppkey", "s_name", "s_address", "s_nationname", "s_regionname", "s_phone", "s_acctbal",
    "s_comment",
]
ORDER_OF_FLAT_ORDER = [
    "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "o_clerk",
    "o_shippriority",
]
CUSTOMER_OF_FLAT_ORDER = [
    "c_name", "c_address", "c_nationkey", "c_phone", "c_acctbal", "c_mktsegment",
    "c_nationname", "c_regionname",
]


def existing(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def with_geography(df: DataFrame, prefix: str, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Add ``<prefix>nationname`` and ``<prefix>regionname`` by ``<prefix>nationkey``."""
    places = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("_nationkey"),
        F.col("n_name").alias(f"{prefix}nationname"),
        F.col("r_name").alias(f"{prefix}regionname"),
    )
    return df.join(places, F.col(f"{prefix}nationkey") == F.col("_nationkey")).drop("_nationkey")


def star_line_item(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Line items carrying the customer key of their order."""
    buyers = orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    joined = lineitem.join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(*existing(lineitem, STAR_LINE), "c_custkey")


def star_customer(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    wide = with_geography(customer, "c_", nation, region)
    return wide.select(*existing(wide, STAR_CUSTOMER))


def star_supplier(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    wide = with_geography(supplier, "s_", nation, region)
    return wide.select(*existing(wide, STAR_SUPPLIER))


def part_supplier_links(part: DataFrame, supplier_count: int, suppliers: int = 4) -> DataFrame:
    """The suppliers of each part by formula: (ps_partkey, ps_suppkey), one row per offer."""
    key, total = "p_partkey", int(supplier_count)
    step = f"({total // suppliers} + ({key} - 1) div {total})"
    return part.select(
        F.col(key).alias("ps_partkey"),
        F.explode(F.sequence(F.lit(0), F.lit(suppliers - 1))).alias("_offer"),
        F.col(key),
    ).select("ps_partkey", F.expr(f"({key} + _offer * {step}) % {total} + 1").alias("ps_suppkey"))


def part_supplier_star(
    part: DataFrame, links: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """Each offer with its part and its supplier, geography folded in."""
    seller = star_supplier(supplier, nation, region)
    wide = links.join(part, F.col("ps_partkey") == F.col("p_partkey")).join(
        seller, F.col("ps_suppkey") == F.col("s_suppkey")
    )
    seller_columns = [c for c in STAR_SUPPLIER if c != "s_comment"]
    return wide.select(
        *existing(wide, [*FLAT_PART, *seller_columns, "ps_availqty", "ps_supplycost"])
    )


def flat_order(
    orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    buyer = with_geography(customer, "c_", nation, region)
    wide = orders.join(buyer, F.col("o_custkey") == F.col("c_custkey"))
    return wide.select(*existing(wide, [*ORDER_OF_FLAT_ORDER, *CUSTOMER_OF_FLAT_ORDER]))


def flat_line_item(
    lineitem: DataFrame,
    orders: DataFrame,
    customer: DataFrame,
    part: DataFrame,
    supplier: DataFrame,
    nation: DataFrame,
    region: DataFrame,
) -> DataFrame:
    """One wide row per line item.

    Customers are folded into the smaller orders first, and those come last, so that the line items shuffle
    while they are narrow and the lines of an order end up together. Names of places are looked up at the end.
    """
    sale = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    wide = (
        lineitem.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(sale, F.col("l_orderkey") == F.col("o_orderkey"))
    )
    for prefix in ("c_", "s_"):
        wide = with_geography(wide, prefix, nation, region)
    return wide.select(*existing(wide, FLAT))


def date_dim(spark: SparkSession, start: str = "1992-01-01", days: int = 2557) -> DataFrame:
    """A calendar row per day, keyed 1..days."""
    day = F.col("date")
    return (
        spark.range(days)
        .select(
            (F.col("id") + 1).alias("dateKey"),
            F.date_add(F.to_date(F.lit(start)), F.col("id").cast("int")).alias("date"),
        )
        .withColumns(
            {
                "month": F.month(day),
                "year": F.year(day),
                "yearMonthNum": F.concat_ws("-", F.year(day), F.month(day)),
                "yearMonth": F.concat_ws("-", F.year(day), F.month(day)),
                "dayNumInWeek": F.dayofweek(day),
                "dayNumInMonth": F.dayofmonth(day),
                "dayNumInYear": F.dayofyear(day),
                "monthNumInYear": F.month(day),
                "weekNumInYear": F.weekofyear(day),
            }
        )
    )


def sparse_order(
    lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """One row for each order: its columns, its customer's, and a map ``part_<key>`` to quantity.

    A part that repeats in an order is summed before the map is made. An order without lines has an empty map.
    """
    cells = lineitem.groupBy("l_orderkey", "l_partkey").agg(F.sum("l_quantity").alias("quantity"))
    cell = F.struct(
        F.concat(F.lit("part_"), F.col("l_partkey").cast("string")).alias("key"),
        F.col("quantity").alias("value"),
    )
    maps = cells.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(cell)).alias("quantities"))
    wide = flat_order(orders, customer, nation, region)
    empty = F.create_map().cast("map<string,double>")
    return (
        wide.join(maps, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .drop("l_orderkey")
        .withColumn("quantities", F.coalesce(F.col("quantities"), empty))
    )


def sparsify(
    df: DataFrame,
    key: Sequence[str],
    filters: Sequence[tuple[float, Sequence[str]]],
    seed: int = 0,
) -> DataFrame:
    """Blank columns at random, repeatably: ``filters`` are (chance in percent, kept columns).

    A row draws at most one filter and loses the columns that filter does not
    keep. The key is always kept. Chances may not add up to more than 100.
    """
    if sum(chance for chance, _ in filters) > 100:
        raise ValueError("chances add up to more than 100 percent")
    draw = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(10_000))
    drawn: Column = F.lit(None).cast("int")
    top = 100.0
    for i in reversed(range(len(filters))):
        top = sum(chance for chance, _ in filters[: i + 1])
        drawn = F.when(draw < int(round(top * 100)), F.lit(i)).otherwise(drawn)
    out = df.withColumn("_filter", drawn)
    blanked = {}
    for c in df.columns:
        loses = [i for i, (_, kept) in enumerate(filters) if c not in kept]
        if c not in key and loses:
            keeps = ~F.coalesce(F.col("_filter").isin(loses), F.lit(False))
            blanked[c] = F.when(keeps, F.col(c))
    return out.withColumns(blanked).drop("_filter")


def order_rollup(lineitem: DataFrame, cutoff: str) -> DataFrame:
    """Order total in cents and status: F all lines shipped, P some, O none."""
    net = "CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(100 - round(l_discount * 100) AS BIGINT)"
    total = F.expr(f"(({net}) div 100) * CAST(100 + round(l_tax * 100) AS BIGINT) div 100")
    shipped = F.to_date("l_shipdate") <= F.to_date(F.lit(cutoff))
    sums = lineitem.groupBy("l_orderkey").agg(
        F.sum(total).alias("total_cents"),
        F.count(F.lit(1)).alias("lines"),
        F.count_if(shipped).alias("shipped"),
    )
    status = (
        F.when(F.col("shipped") == F.col("lines"), "F")
        .when(F.col("shipped") > 0, "P")
        .otherwise("O")
    )
    return sums.select("l_orderkey", "total_cents", "lines", status.alias("orderstatus"))


def line_status(lineitem: DataFrame, cutoff: str) -> DataFrame:
    """Status F if shipped by the cutoff, else O; return flag N if received after it."""
    end = F.to_date(F.lit(cutoff))
    return lineitem.withColumns(
        {
            "l_linestatus": F.when(F.to_date("l_shipdate") <= end, "F").otherwise("O"),
            "l_returnflag": F.when(F.col("l_receiptdate") <= end, F.col("l_returnflag")).otherwise(
                "N"
            ),
        }
    )
