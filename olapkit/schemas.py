"""Column types of delimited line items as their loader declares them."""

from __future__ import annotations

from pyspark.sql.types import DateType, FloatType, IntegerType, StringType, StructField, StructType

# The layout of the file.
LINEITEM = StructType(
    [
        StructField("l_orderkey", IntegerType()),
        StructField("l_partkey", IntegerType()),
        StructField("l_suppkey", IntegerType()),
        StructField("l_linenumber", IntegerType()),
        StructField("l_quantity", IntegerType()),
        StructField("l_extendedprice", FloatType()),
        StructField("l_discount", FloatType()),
        StructField("l_tax", FloatType()),
        StructField("l_returnflag", StringType()),
        StructField("l_linestatus", StringType()),
        StructField("l_shipdate", DateType()),
        StructField("l_commitdate", DateType()),
        StructField("l_receiptdate", DateType()),
        StructField("l_shipinstruct", StringType()),
        StructField("l_shipmode", StringType()),
        StructField("l_comment", StringType()),
    ]
)
