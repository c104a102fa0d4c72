"""Partition layouts."""

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from olapkit.operators import partitions as parts
from olapkit.operators.partitions import Bound, HashLevel, PartitionSpec
from olapkit.registry.base import query
from olapkit.sources.keyed_table import KeyedTable
from olapkit.workspace import new_path

BY_YEAR = PartitionSpec(
    range_column="o_orderdate",
    bounds=tuple(Bound(dt.datetime(y, 1, 1), dt.datetime(y + 1, 1, 1)) for y in range(1996, 2000)),
)
# The largest bucket of a good hash lies close to the mean.
EVEN = 1.5


def orders(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


@query("hash_partition", "SELECT 8 AS partitions, count(*) AS rows, true AS even FROM orders")
def hash_partition(t):
    spec = PartitionSpec(hash=(HashLevel(("o_orderkey",), 8, seed=3),))
    stats = parts.skew(parts.partition_stats(orders(t), spec))
    return stats.select("partitions", "rows", (F.col("skew") < EVEN).alias("even"))


RANGE_SQL = """
CASE WHEN o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '2000-01-01'
     THEN year(o_orderdate)::INT - 1996 END
"""


@query("range_partition", f"SELECT o_orderkey, {RANGE_SQL} AS _range FROM orders")
def range_partition(t):
    return parts.with_partition(orders(t), BY_YEAR).select("o_orderkey", "_range")


@query(
    "multilevel",
    """
    SELECT CASE WHEN o_totalprice < 100000 THEN 0 WHEN o_totalprice < 300000 THEN 1 ELSE 2 END AS _range,
           8 AS partitions, count(*) AS rows FROM orders GROUP BY 1
    """,
)
def multilevel(t):
    spec = PartitionSpec(
        hash=(HashLevel(("o_orderkey",), 4), HashLevel(("o_custkey",), 2, seed=1)),
        range_column="o_totalprice",
        bounds=parts.split_points([100000.0, 300000.0]),
    )
    stats = parts.partition_stats(orders(t), spec)
    return stats.groupBy("_range").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows")
    )


@query(
    "custom_hash",
    """
    SELECT CASE WHEN o_orderkey < 300 THEN 0 WHEN o_orderkey < 900 THEN 1 ELSE 2 END AS _range,
           CASE WHEN o_orderkey < 300 THEN 2 WHEN o_orderkey < 900 THEN 3 ELSE 4 END AS partitions,
           count(*) AS rows FROM orders GROUP BY 1, 2
    """,
)
def custom_hash(t):
    spec = PartitionSpec(
        hash=(HashLevel(("o_orderkey",), 4),),
        range_column="o_orderkey",
        bounds=(Bound(None, 300, (2,)), Bound(300, 900, (3,)), Bound(900, None)),
    )
    stats = parts.partition_stats(orders(t), spec)
    return stats.groupBy("_range").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows")
    )


@query(
    "partition_cover",
    f"SELECT ({RANGE_SQL}) IS NOT NULL AS covered, count(*) AS rows FROM orders GROUP BY 1",
)
def partition_cover(t):
    return (
        orders(t)
        .groupBy(parts.covered(BY_YEAR).alias("covered"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "drop_range",
    f"""
    SELECT o_orderkey, {RANGE_SQL} - CASE WHEN year(o_orderdate) > 1997 THEN 1 ELSE 0 END AS _range
    FROM orders WHERE o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '2000-01-01'
      AND NOT (year(o_orderdate) = 1997)
    """,
)
def drop_range(t):
    stored, _ = parts.split_covered(orders(t), BY_YEAR)
    rest, spec = parts.drop_range(stored, BY_YEAR, BY_YEAR.bounds[1])
    return parts.with_partition(rest, spec).select("o_orderkey", "_range")


LAYOUT = PartitionSpec(
    hash=(HashLevel(("o_custkey",), 4),),
    range_column="o_orderdate",
    bounds=parts.split_points([dt.datetime(1997, 1, 1), dt.datetime(1999, 1, 1)]),
)


@query(
    "partition_sorted_write",
    """
    SELECT CASE WHEN o_orderdate < DATE '1997-01-01' THEN 0 WHEN o_orderdate < DATE '1999-01-01' THEN 1 ELSE 2 END AS _range,
           count(*) AS rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM orders GROUP BY 1
    """,
)
def partition_sorted_write(t):
    path = new_path(t.spark, "partitioned")
    parts.write_partitioned(orders(t), LAYOUT, ["o_orderkey"], path)
    return (
        t.spark.read.parquet(path)
        .groupBy("_range")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("o_orderkey").alias("first_key"),
            F.max("o_orderkey").alias("last_key"),
        )
    )


@query(
    "partition_stats",
    f"SELECT {RANGE_SQL} AS _range, count(*) AS rows FROM orders GROUP BY 1",
)
def partition_stats(t):
    return parts.partition_stats(orders(t), BY_YEAR)


@query(
    "pruned_scan",
    """
    SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
    WHERE o_custkey = 7 AND o_orderdate >= DATE '1997-06-01'
    """,
)
def pruned_scan(t):
    path = new_path(t.spark, "partitioned")
    parts.write_partitioned(orders(t), LAYOUT, ["o_orderkey"], path)
    return parts.pruned_scan(
        t.spark, path, LAYOUT, equals={"o_custkey": 7}, lower=dt.datetime(1997, 6, 1)
    )


@query(
    "scan_of_log",
    """
    SELECT o_custkey, o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN 'H' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
    FROM orders WHERE o_custkey % 50 = 7 AND o_orderkey >= 300 AND NOT (o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')
    """,
)
def scan_of_log(t):
    # Three commits, none folded: each scan opens the folders of its bucket and ranges only.
    spec = PartitionSpec(hash=(HashLevel(("o_custkey",), 8),), range_column="o_orderkey", bounds=parts.split_points([300, 9000]))
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    table = KeyedTable.create_as(
        rows.drop("o_orderpriority"), new_path(t.spark, "table"), ["o_custkey", "o_orderkey"], partition=spec
    )
    high = rows.filter(F.col("o_orderpriority") == "2-HIGH").drop("o_orderpriority")
    table.write("upsert", high.withColumn("o_orderstatus", F.lit("H")))
    gone = rows.filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F"))
    table.write("delete", gone.select("o_custkey", "o_orderkey"))
    customers = [r[0] for r in t.customer.filter(F.col("c_custkey") % 50 == 7).select("c_custkey").limit(3).collect()]
    some = reduce(DataFrame.unionAll, [table.scan({"o_custkey": c}, lower=300) for c in customers])
    rest = table.scan({}, lower=300).filter((F.col("o_custkey") % 50 == 7) & ~F.col("o_custkey").isin(customers))
    return some.unionAll(rest)


@query(
    "partition_sorted_files",
    """
    SELECT CASE WHEN o_orderdate < DATE '1997-01-01' THEN 0 WHEN o_orderdate < DATE '1999-01-01' THEN 1 ELSE 2 END AS _range,
           count(*) AS rows, 0 AS misplaced, 0 AS unsorted FROM orders GROUP BY 1
    """,
)
def partition_sorted_files(t):
    # Where each row stands in its file: in the folder of its partition, after the smaller keys.
    path = new_path(t.spark, "partitioned")
    parts.write_partitioned(orders(t), LAYOUT, ["o_orderkey"], path)
    stored = t.spark.read.parquet(path).select(
        "*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at")
    )
    names = [F.col(c).alias(f"folder{c}") for c in LAYOUT.columns]
    rows = parts.with_partition(stored.select("o_orderkey", "o_custkey", "o_orderdate", "file", "at", *names), LAYOUT)
    placed = reduce(Column.__and__, [F.col(c) == F.col(f"folder{c}") for c in LAYOUT.columns])
    # Files are split at row groups, so a file is a bounded group.
    before = F.lag("o_orderkey").over(Window.partitionBy("file").orderBy("at"))
    return (
        rows.select("_range", placed.alias("placed"), (before > F.col("o_orderkey")).alias("falls"))
        .groupBy("_range")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(~F.col("placed")).alias("misplaced"),
            F.count_if("falls").alias("unsorted"),
        )
    )
