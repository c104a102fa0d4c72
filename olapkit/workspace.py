"""Shared folder for intermediate tables, and the session used by tests and bench."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

CHECKPOINT_SETTING = "spark.checkpoint.dir"
_own_roots: dict[str, str] = {}


def local_session(cores: str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster job brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("olapkit")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configured(spark)


def configured(spark: SparkSession) -> SparkSession:
    """Split oversized join partitions even where that costs one more shuffle, and read times as UTC.

    For sessions of one's own; the library changes no setting of a session it is given.
    """
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by the session. Only a local session may fall back to its own, one for an application."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    # The setting is fixed once a session runs, so the folder is remembered here.
    application = spark.sparkContext.applicationId
    if application not in _own_roots:
        _own_roots[application] = tempfile.mkdtemp(prefix="olapkit-")
    return _own_roots[application]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/olapkit/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts lineage and survives lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """As ``materialize``, with the number of rows counted while they are written."""
    seen = Observation()
    stored = materialize(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return stored, seen.get["rows"]
