"""Rows placed into exactly n buckets by the hash of some columns, one file a bucket, and joins that rely on it.

Two tables placed by the same columns into the same number of buckets join, and are grouped, without a
shuffle: bucket i of one meets bucket i of the other. The placement is written beside the rows
(``<path>/_placement``), so that any session can read the folder as placed.

A bucket is read by one task. A key with a large share of the rows makes its bucket as large, so ``write_bucketed``
measures the buckets it wrote; ``max_share`` refuses a placement whose largest bucket holds more than that share of the rows.
For such keys leave the table unplaced: a shuffled join splits them at run time.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def bucket_of(columns: Sequence[str], n: int):
    """The bucket of a row, as Spark places it."""
    return F.pmod(F.hash(*columns), F.lit(n))


def write_bucketed(df: DataFrame, path: str, columns: Sequence[str], n: int, max_share: float = 1.0) -> None:
    """Write rows into ``n`` buckets; a bucket without rows has no file. Rows of a file are sorted by the columns."""
    if n < 1 or not columns:
        raise ValueError("placing needs columns and at least one bucket")
    spark, columns = df.sparkSession, list(columns)
    rows = df.repartition(n, *columns)
    name = f"placing_{uuid.uuid4().hex}"
    rows.write.format("parquet").bucketBy(n, *columns).sortBy(*columns).option("path", path).saveAsTable(name)
    # The rows stay; the name was only needed to write them.
    spark.sql(f"DROP TABLE {name}")
    told = {"columns": columns, "buckets": n, "schema": df.schema.jsonValue()}
    if max_share < 1:
        largest, total = bucket_layout(spark.read.schema(df.schema).parquet(path), columns, n).agg(F.max("rows"), F.sum("rows")).first()
        if total and largest > max_share * total:
            raise ValueError(f"a bucket holds {largest} of {total} rows")
    spark.range(1).select(F.lit(json.dumps(told)).alias("value")).write.text(f"{path}/_placement")


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The rows with their placement known to Spark."""
    told = json.loads(spark.read.text(f"{path}/_placement").first()["value"])
    schema = StructType.fromJson(told["schema"])
    name = f"placed_{hashlib.sha256(path.encode()).hexdigest()[:24]}"
    cells = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(f"`{c}`" for c in told["columns"])
    where = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({cells}) USING parquet "
        f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {told['buckets']} BUCKETS LOCATION '{where}'"
    )
    return spark.table(name)


def bucket_layout(stored: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """(bucket, files, rows, misplaced): what the files hold against what their names say."""
    named = F.regexp_extract(F.col("_metadata.file_name"), r"_(\d+)(?:\.c\d+)?\.", 1).cast("int")
    rows = stored.select(
        F.col("_metadata.file_name").alias("file"), named.alias("bucket"), bucket_of(columns, n).alias("of_key")
    )
    # One row per file first: a hot bucket is counted in the tasks.
    files = rows.groupBy("bucket", "file").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("of_key") != F.col("bucket")).alias("misplaced")
    )
    return files.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.sum("misplaced").alias("misplaced")
    )
