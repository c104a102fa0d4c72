"""Streams into keyed tables, and a running pricing summary."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from olapkit.operators import rowops
from olapkit.operators.metrics import parse_metric_lines
from olapkit.plans import sales
from olapkit.sources import variants
from olapkit.sources.encode import json_fields
from olapkit.sources.keyed_table import KeyedTable


def file_stream(
    spark: SparkSession, path: str, schema, fmt: str = "parquet", per_trigger: int | None = None
) -> DataFrame:
    """A stream over the files that arrive in a folder, or of one file."""
    reader = spark.readStream.schema(schema).format(fmt)
    if per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    # A pattern matches a single file as well as a folder of files.
    path = path.rstrip("/")
    return reader.load(f"{path[:-1]}[{path[-1]}]")


def upsert_stream(
    stream: DataFrame,
    table: KeyedTable,
    name: str,
    checkpoint: str,
    op: str = "upsert",
    seq: str | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    every: str | None = None,
    drift: bool = False,
) -> StreamingQuery:
    """Write each micro-batch with ``op``; a replayed batch changes nothing.

    Without ``seq`` the changes of a micro-batch to one key count in the order in which they stand in
    their files, so that a batch that is read again comes to the same rows. ``drift`` adds
    columns that the table doesn't know yet, at the micro-batch that first brings them.
    The table records the last batch number under ``name``, which must stay the
    same for the same checkpoint. Runs until the available input is used up, or for good, with a
    micro-batch ``every`` so often (``"10 seconds"``).
    """
    trigger = {"processingTime": every} if every else {"availableNow": True}

    place = rowops.file_position(stream) if seq is None else None
    if place is not None:
        stream = stream.withColumn(rowops.ARRIVAL, place)

    def apply(batch: DataFrame, number: int) -> None:
        rows = prepare(batch) if prepare else batch
        table.write(op, rows, seq=seq, source=(name, number), drift=drift)

    return (
        stream.writeStream.foreachBatch(apply)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def metric_stream(
    lines: DataFrame, table: KeyedTable, name: str, checkpoint: str
) -> StreamingQuery:
    """Metric lines into a table keyed by host, metric and time; repeats are ignored.

    A point may be as late as it likes: the insert knows all stored keys, and of repeats in a
    micro-batch takes the first, so the stream keeps no state.
    """
    points, _ = parse_metric_lines(lines, "value")
    return upsert_stream(points, table, name, checkpoint, op="insert_ignore")


def json_stream(
    payloads: DataFrame, column: str, types: dict[str, str], table: KeyedTable, name: str, checkpoint: str
) -> StreamingQuery:
    """JSON array payloads, split into records of the named fields, as upserts.

    Of records with one key in a batch, the last to arrive is kept.
    """
    records = json_fields(payloads.select(column), column, types)
    return upsert_stream(records, table, name, checkpoint)


def document_stream(
    documents: DataFrame, column: str, table: KeyedTable, name: str, checkpoint: str, op: str = "upsert"
) -> StreamingQuery:
    """JSON documents whose fields aren't known beforehand into a table, which gets a column for each new field.

    A field the table knows is taken as the table's type, null where that can't be; a new one gets the type that
    holds all its values in the micro-batch that first brings it (see ``variants.storable``). Documents without the key
    columns, and text that is no JSON object, are left out.
    """

    def fields(batch: DataFrame) -> DataFrame:
        parsed = variants.to_variants(batch, column)
        known = {f.name: f.dataType for f in table.schema}
        met = {f.name: known.get(f.name, f.dataType) for f in variants.common_schema(parsed, column)}
        keys = {k: known[k] for k in table.meta()["keys"]}
        return variants.typed_fields(parsed, column, keys | met).dropna(subset=list(keys))

    return upsert_stream(documents.select(column), table, name, checkpoint, op, prepare=fields, drift=True)


def pricing_stream(lineitem: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """The pricing summary of all rows so far, rewritten after each micro-batch.

    Batch ``n`` is the folder ``<path>/batch=n``. Rows are summed per task before they get to the
    state, which has one row for each group.
    """

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        sales.pricing_summary(lineitem)
        .writeStream.foreachBatch(keep)
        .outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def newest_batch(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.parquet(path)
    newest = rows.agg(F.max("batch").alias("_newest"))
    return rows.join(newest, F.col("batch") == F.col("_newest")).drop("batch", "_newest")
