"""Shapes that are written once for each version of their inputs, and then read like any table.

A wide or nested shape costs several joins, but many queries read a few of its columns. A store keeps the
rows as Parquet under a key made of the shape's name, its revision, and what the input files are now: their
paths, sizes and times of change. Equal inputs find the stored rows; a changed file gives another key, so a stale
shape is never read. The scan of a stored shape prunes columns and pushes filters down.

``<root>/<name>/<key>/data-<id>`` holds the rows, ``<root>/<name>/<key>/document`` one JSON document,
written last: a shape without document does not exist. Of two sessions that build the same shape, the
first to finish is read by both.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

#: A shape is written once and read often; maps of fields get a sixth smaller than at the default level.
COMPRESSION = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9"}


def files_version(spark: SparkSession, paths: Sequence[str]) -> str:
    """A text that changes with the files under the paths: their number, their bytes, and a sum of hashes
    of path, size and time. Only the listing is read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n, size, marks = files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(mark)).first()
    return f"{n}:{size or 0}:{marks or 0}"


@dataclass(frozen=True)
class Shape:
    """What a shape is made of. ``revision`` is to be raised when ``build`` comes to mean something else.

    ``sort_by`` orders the rows inside each file, so that a filter on it skips row groups.
    """

    name: str
    inputs: tuple[str, ...]
    build: Callable[[], DataFrame]
    revision: int = 1
    sort_by: tuple[str, ...] = ()


class ShapeStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def folder(self, shape: Shape) -> str:
        """Where the shape lies for the inputs as they are now."""
        version = files_version(self.spark, shape.inputs)
        told = json.dumps([shape.name, shape.revision, shape.sort_by, shape.inputs, version])
        return f"{self.root}/{shape.name}/{hashlib.sha256(told.encode()).hexdigest()[:32]}"

    def _document(self, folder: str) -> dict | None:
        try:
            return json.loads(self.spark.read.text(f"{folder}/document").first()["value"])
        except AnalysisException:
            return None

    def _stored(self, shape: Shape) -> dict:
        """The document of the shape, written first if need be."""
        folder = self.folder(shape)
        document = self._document(folder)
        if document is not None:
            return document
        rows, path = shape.build(), f"{folder}/data-{uuid.uuid4().hex[:8]}"
        if shape.sort_by:
            rows = rows.sortWithinPartitions(*shape.sort_by)
        rows.write.options(**COMPRESSION).parquet(path)
        body = {"name": shape.name, "path": path, "schema": rows.schema.jsonValue()}
        try:
            told = self.spark.range(1).select(F.lit(json.dumps(body)).alias("value"))
            told.write.mode("errorifexists").text(f"{folder}/document")
        except AnalysisException:
            # Another session was first; its rows count.
            body = self._document(folder)
        return body

    def load(self, shape: Shape) -> str:
        """Write the shape unless it is stored for these inputs; the path of its rows."""
        return self._stored(shape)["path"]

    def read(self, shape: Shape) -> DataFrame:
        """The stored rows, written first if need be."""
        document = self._stored(shape)
        return self.spark.read.schema(StructType.fromJson(document["schema"])).parquet(document["path"])
