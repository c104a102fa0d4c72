"""Documents of varying shape, as Spark's VARIANT: parsed once, asked for fields later.

The schema need not be known, a field may be missing, and may have another type in another document. A document that
is not JSON is null. Fields are named as in JSON; names are taken as they are, whatever characters they hold.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DecimalType,
    DoubleType,
    LongType,
    NullType,
    StringType,
    StructType,
    VariantType,
)


def to_variants(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """``column`` of JSON text as a VARIANT, in its place or under ``name``."""
    return df.withColumn(name or column, F.try_parse_json(F.col(column)))


def path_of(name: str) -> str | None:
    """The path of a top-level field; None for a name that no path can hold."""
    for quote in ("'", '"'):
        if name and quote not in name and "?" not in name:
            return f"$[{quote}{name}{quote}]"
    return None


def field(column: str, name: str, kind: str | DataType) -> Column:
    """A field as a type; null where it is missing or can't be had as that type."""
    text = kind if isinstance(kind, str) else kind.simpleString()
    path = path_of(name)
    if path is not None:
        return F.try_variant_get(F.col(column), path, text)
    fields = F.try_variant_get(F.col(column), "$", "map<string,variant>")
    return F.try_variant_get(F.try_element_at(fields, F.lit(name)), "$", text)


def typed_fields(df: DataFrame, column: str, types: Mapping[str, str | DataType]) -> DataFrame:
    """The other columns, and the named fields as columns."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, *[field(column, n, k).alias(n) for n, k in types.items()])


def observed_fields(df: DataFrame, column: str) -> DataFrame:
    """(field, type, rows): the top-level fields of all documents by the types they come in."""
    fields = df.select(column).lateralJoin(df.sparkSession.tvf.variant_explode(F.col(column).outer()))
    kind = F.schema_of_variant("value")
    # The inside of objects and lists, and the digits of decimals, are not part of a field's kind.
    plain = F.regexp_extract(kind, "^[A-Z]+", 0)
    return (
        fields.filter(F.col("key").isNotNull())
        .select(F.col("key").alias("field"), plain.alias("type"))
        .groupBy("field", "type")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def storable(kind: DataType) -> DataType | None:
    """The column type for what a field holds: numbers widened, all that has no one type as text.

    None for a field that was null wherever it was seen.
    """
    if isinstance(kind, NullType):
        return None
    if isinstance(kind, (LongType, DoubleType, BooleanType, StringType)):
        return kind
    if isinstance(kind, DecimalType):
        return DoubleType()
    if isinstance(kind, (StructType, ArrayType, VariantType)):
        return StringType()
    return kind


def common_schema(df: DataFrame, column: str) -> StructType:
    """The top-level fields of all documents with types that hold all their values, by name.

    One aggregate over the documents, whose result grows with the distinct fields.
    """
    objects = df.filter(F.schema_of_variant(column).startswith("OBJECT"))
    told = objects.agg(F.schema_of_variant_agg(column)).first()[0] or "VOID"
    if not told.startswith("OBJECT<"):
        return StructType()
    merged = DataType.fromDDL(told.replace("OBJECT<", "STRUCT<"))
    out = StructType()
    for f in sorted(merged, key=lambda f: f.name):
        kind = storable(f.dataType)
        if kind is not None:
            out = out.add(f.name, kind)
    return out
