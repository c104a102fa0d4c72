"""The sales tables, with the columns the test data lacks derived by rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


# The seven shipping modes.
SHIP_MODES = ["REG AIR", "AIR", "RAIL", "SHIP", "TRUCK", "MAIL", "FOB"]


# Schemas by path, so that footers are read once per process.
_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """Reads ``<folder>/<table>.parquet`` on attribute access."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        path = self.path(name)
        known = _SCHEMAS.get(path)
        if known is None:
            known = _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(known).parquet(path)

    @property
    def lineitem_dates(self) -> DataFrame:
        return with_line_dates(self.lineitem)

    @property
    def orders_priority(self) -> DataFrame:
        return with_ship_priority(self.orders)


def with_line_dates(lineitem: DataFrame, part: str = "l_partkey", supplier: str = "l_suppkey") -> DataFrame:
    """Commit date, receipt date and ship mode from the keys; ship date as a date."""
    ship = F.to_date("l_shipdate")
    modes = F.array(*[F.lit(m) for m in SHIP_MODES])
    return lineitem.withColumns(
        {
            "l_shipdate": ship,
            "l_commitdate": F.date_add(ship, (F.col(part) % 61 - 30).cast("int")),
            "l_receiptdate": F.date_add(ship, (F.col(supplier) % 30 + 1).cast("int")),
            "l_shipmode": F.get(modes, (F.col(part) % 7).cast("int")),
        }
    )


def with_ship_priority(orders: DataFrame) -> DataFrame:
    return orders.withColumns(
        {"o_orderdate": F.to_date("o_orderdate"), "o_shippriority": F.lit(0)}
    )


# The same derived columns for the SQL side.
LINEITEM_DATES_SQL = """
SELECT * REPLACE (CAST(l_shipdate AS DATE) AS l_shipdate),
       CAST(l_shipdate AS DATE) + CAST(l_partkey % 61 - 30 AS INTEGER) AS l_commitdate,
       CAST(l_shipdate AS DATE) + CAST(l_suppkey % 30 + 1 AS INTEGER) AS l_receiptdate,
       ['REG AIR','AIR','RAIL','SHIP','TRUCK','MAIL','FOB'][CAST(l_partkey % 7 AS INTEGER) + 1] AS l_shipmode
FROM lineitem
"""

ORDERS_PRIORITY_SQL = """
SELECT * REPLACE (CAST(o_orderdate AS DATE) AS o_orderdate), 0 AS o_shippriority FROM orders
"""
