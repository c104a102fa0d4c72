"""Delimited files in and out, clustered and batched writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from olapkit.operators.numbering import split_batches
from olapkit.schemas import LINEITEM

SAVE_MODES = ("append", "overwrite", "errorifexists", "ignore")


def read_delimited(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    infer: bool = False,
) -> DataFrame:
    """Rows of delimited text: typed by ``schema``, inferred, or all strings.

    ``infer`` reads the files twice; name the schema for large inputs.
    """
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def write_delimited(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    df.write.option("header", header).option("sep", sep).csv(path)


def repair_header(
    spark: SparkSession, path: str, names: Sequence[str], has_header: bool, sep: str = ","
) -> DataFrame:
    """String columns under the given names; an existing first line per file is replaced."""
    schema = StructType([StructField(n, StringType()) for n in names])
    reader = spark.read.option("header", has_header).option("sep", sep)
    return reader.option("enforceSchema", True).schema(schema).csv(path)


def read_tbl(spark: SparkSession, path: str, schema: StructType = LINEITEM) -> DataFrame:
    """Pipe-separated lines that end in a pipe; the line item key columns come first."""
    ended = StructType([*schema.fields, StructField("_end", StringType())])
    rows = spark.read.schema(ended).option("sep", "|").csv(path).drop("_end")
    keys = [c for c in ("l_orderkey", "l_linenumber") if c in rows.columns]
    return rows.select(*keys, *[c for c in rows.columns if c not in keys])


def write_tbl(df: DataFrame, path: str) -> None:
    df.withColumn("_end", F.lit(None).cast("string")).write.option("sep", "|").csv(path)


def clustered_write(df: DataFrame, columns: Sequence[str], n: int, path: str) -> None:
    """About ``n`` files with equal column values together.

    A rebalance: a value that owns a large share of the rows is spread over
    several tasks and files, small ones share a file.
    """
    df.hint("rebalance", n, *[F.col(c) for c in columns]).write.parquet(path)


def write_batches(df: DataFrame, size: int, order_by: Sequence[str], path: str) -> None:
    """One folder per batch of ``size`` consecutive rows."""
    batches = split_batches(df, size, order_by)
    batches.hint("rebalance", F.col("batch")).write.partitionBy("batch").parquet(path)


def save(df: DataFrame, path: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    if mode not in SAVE_MODES:
        raise ValueError(f"mode must be one of {SAVE_MODES}")
    df.write.mode(mode).format(fmt).save(path)
