"""Rows as documents, XML, pipe lines and key-value records, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType


def to_documents(df: DataFrame, name: str = "document") -> DataFrame:
    """One JSON object per row."""
    return df.select(F.to_json(F.struct("*")).alias(name))


def from_documents(df: DataFrame, schema: StructType | str, name: str = "document") -> DataFrame:
    return df.select(F.from_json(F.col(name), schema).alias("_row")).select("_row.*")


def to_bulk_json(df: DataFrame, index: str, id_column: str) -> DataFrame:
    """Two lines per row in one string: an index action, then the document."""
    action = F.to_json(
        F.struct(
            F.struct(
                F.lit(index).alias("_index"), F.col(id_column).cast("string").alias("_id")
            ).alias("index")
        )
    )
    return df.select(F.concat_ws("\n", action, F.to_json(F.struct("*"))).alias("bulk"))


def from_bulk_json(df: DataFrame, schema: StructType | str) -> DataFrame:
    """The parts of bulk rows: index, id and the document's columns."""
    lines = df.select(
        F.substring_index("bulk", "\n", 1).alias("_action"),
        F.from_json(F.substring_index("bulk", "\n", -1), schema).alias("_row"),
    )
    return lines.select(
        F.get_json_object("_action", "$.index._index").alias("_index"),
        F.get_json_object("_action", "$.index._id").alias("_id"),
        "_row.*",
    )


def to_xml_rows(df: DataFrame, tag: str) -> DataFrame:
    """One well-formed XML element per row."""
    return df.select(F.to_xml(F.struct("*"), {"rowTag": tag}).alias("xml"))


def from_xml_rows(df: DataFrame, schema: StructType | str, tag: str) -> DataFrame:
    return df.select(F.from_xml("xml", schema, {"rowTag": tag}).alias("_row")).select("_row.*")


def to_pipe_lines(df: DataFrame) -> DataFrame:
    """Columns joined by ``|``; a null is an empty field."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws("|", *fields).alias("line"))


def record_key(*parts: str) -> Column:
    return F.concat_ws("_", *[F.col(p).cast("string") for p in parts])


def to_hash_records(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key, fields): the key columns joined by ``_``, all others as a map of strings."""
    pairs = []
    for c in df.columns:
        if c not in key:
            pairs += [F.lit(c), F.col(c).cast("string")]
    return df.select(record_key(*key).alias("key"), F.create_map(*pairs).alias("fields"))


def from_hash_records(
    records: DataFrame, types: Mapping[str, str], required: Sequence[str] = ()
) -> DataFrame:
    """Typed columns out of the field map; rows without a required field are skipped."""
    typed = records.select(
        "key", *[F.col("fields")[n].try_cast(t).alias(n) for n, t in types.items()]
    )
    for name in required:
        typed = typed.filter(F.col(name).isNotNull())
    return typed


def json_fields(df: DataFrame, column: str, types: Mapping[str, str]) -> DataFrame:
    """Split a column holding a JSON array (or one object) into records of the named fields.

    Other columns are kept; a payload that does not parse gives no record.
    """
    record = ", ".join(f"`{n}`: {t}" for n, t in types.items())
    payload = F.trim(F.col(column))
    listed = F.when(payload.startswith("["), payload).otherwise(
        F.concat(F.lit("["), payload, F.lit("]"))
    )
    parsed = F.from_json(listed, f"array<struct<{record}>>")
    rest = [c for c in df.columns if c != column]
    return (
        df.select(*rest, F.explode(parsed).alias("_record"))
        .filter(F.col("_record").isNotNull())
        .select(*rest, "_record.*")
    )
