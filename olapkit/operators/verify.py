"""Link checks, checksums and generated rows for verifying tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def verify_links(nodes: DataFrame, key: Sequence[str], previous: Sequence[str]) -> DataFrame:
    """Counts over a table whose rows point to the key of another row.

    referenced: pointed to once; extra: more than once; unreferenced: never;
    undefined: pointed to but absent.
    """
    names = [f"_k{i}" for i in range(len(key))]
    # Pointers are counted per target before the join: a popular target is one row per task.
    pointed = (
        nodes.select(*[F.col(p).alias(n) for p, n in zip(previous, names)])
        .na.drop("any")
        .groupBy(*names)
        .agg(F.count(F.lit(1)).alias("_refs"))
    )
    defined = nodes.select(*[F.col(k).alias(n) for k, n in zip(key, names)]).withColumn(
        "_defined", F.lit(True)
    )
    refs, known = F.coalesce("_refs", F.lit(0)), F.col("_defined").isNotNull()
    return defined.join(pointed, names, "full_outer").agg(
        F.count_if(known & (refs == 1)).alias("referenced"),
        F.count_if(known & (refs > 1)).alias("extra"),
        F.count_if(known & (refs == 0)).alias("unreferenced"),
        F.count_if(~known).alias("undefined"),
    )


def generate_links(lists: DataFrame, list_id: str, nodes: int, seed: int = 0) -> DataFrame:
    """A ring of ``nodes`` rows per list: (key1, key2, prev1, prev2, row_id, list id)."""

    def keys(i: Column, a: str, b: str):
        return [
            F.xxhash64(list_id, i, F.lit(seed)).alias(a),
            F.xxhash64(list_id, i, F.lit(seed + 1)).alias(b),
        ]

    rows = lists.select(list_id, F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))).alias("row_id"))
    before = F.pmod(F.col("row_id") - 1, F.lit(nodes))
    return rows.select(
        *keys(F.col("row_id"), "key1", "key2"), *keys(before, "prev1", "prev2"), "row_id", list_id
    )


def checksum(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, sum and xor of row hashes, per group: equal content gives equal numbers."""
    columns = sorted(c for c in df.columns if c not in by)
    row = F.xxhash64(*columns, *[F.col(c).isNull() for c in columns])
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row.cast("decimal(38,0)")).alias("hash_sum"),
        F.bit_xor(row).alias("hash_xor"),
    )


def plain_text(df: DataFrame, columns: Sequence[str], digits: int = 4) -> Column:
    """A row as text that other engines can write too: columns in the given order, between bars, null as ``\\N``.

    Numbers with fractions are rounded to ``digits`` decimals, times are shown to the second; in strings
    a backslash is doubled and a bar becomes ``\\p``, so that no two rows look alike.
    """

    def shown(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, (FloatType, DoubleType, DecimalType)):
            return F.col(c).cast(f"decimal(38,{digits})").cast("string")
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        if isinstance(kind, StringType):
            return F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\p"))
        return F.col(c).cast("string")

    return F.concat_ws("|", *[F.coalesce(shown(c), F.lit("\\N")) for c in columns])


def portable_checksum(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows and the sum of the first 60 bits of their md5, per group: any engine with md5 gets the same numbers.

    The sum doesn't depend on order, and repeated rows count each.
    """
    bits = F.conv(F.substring(F.md5(plain_text(df, columns)), 1, 15), 16, 10).cast("decimal(38,0)")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(bits).alias("md5_sum"))


def checksum_equal(left: DataFrame, right: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per group whether both sides have the same checksum."""
    both = checksum(left, by).select(*by, F.lit(1).alias("_side"), "rows", "hash_sum", "hash_xor")
    both = both.unionByName(
        checksum(right, by).select(*by, F.lit(2).alias("_side"), "rows", "hash_sum", "hash_xor")
    )

    def same(c):
        return F.min(c).eqNullSafe(F.max(c))

    equal = same("rows") & same("hash_sum") & same("hash_xor") & (F.count(F.lit(1)) == 2)
    return both.groupBy(*by).agg(equal.alias("equal"), F.max("rows").alias("rows"))


def _value(kind: DataType, draw: Column) -> Column:
    """A value of a type from a 64-bit draw."""
    if isinstance(kind, BooleanType):
        return draw % 2 == 0
    if isinstance(kind, (ByteType, ShortType, IntegerType)):
        bits = {"byte": 8, "short": 16, "integer": 32}[kind.typeName()]
        return (F.pmod(draw, F.lit(1 << bits)) - (1 << (bits - 1))).cast(kind)
    if isinstance(kind, LongType):
        return draw
    if isinstance(kind, (FloatType, DoubleType)):
        return (draw / F.lit(float(1 << 40))).cast(kind)
    if isinstance(kind, DecimalType):
        digits = min(kind.precision, 18)
        unscaled = F.pmod(draw, F.lit(10**digits)).cast(f"decimal({digits},0)")
        scale = F.lit(10**kind.scale).cast("decimal(38,0)")
        return (unscaled / scale).cast(kind) if kind.scale else unscaled.cast(kind)
    if isinstance(kind, StringType):
        return F.hex(draw)
    if isinstance(kind, BinaryType):
        return F.unhex(F.lpad(F.hex(draw), 16, "0"))
    if isinstance(kind, DateType):
        return F.date_add(F.lit("1970-01-01").cast("date"), F.pmod(draw, F.lit(36_500)).cast("int"))
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.timestamp_micros(F.pmod(draw, F.lit(4 * 10**15))).cast(kind)
    raise TypeError(f"no generator for {kind.simpleString()}")


def random_rows(
    spark: SparkSession,
    schema: StructType,
    n: int,
    seed: int = 0,
    null_rate: float = 0.1,
    defaults: dict[str, object] | None = None,
    default_rate: float = 0.1,
    sequential: Sequence[str] = (),
) -> DataFrame:
    """``n`` repeatable rows: each cell depends only on its row, column and the seed.

    Nullable columns are null at ``null_rate``, columns with a default take it at
    ``default_rate``; ``sequential`` columns count 0, 1, ....
    """
    defaults = defaults or {}
    cells = []
    for i, f in enumerate(schema.fields):
        if f.name in sequential:
            cells.append(F.col("id").cast(f.dataType).alias(f.name))
            continue
        cell = _value(f.dataType, F.xxhash64("id", F.lit(i), F.lit(seed)))
        fate = F.pmod(F.xxhash64("id", F.lit(i), F.lit(seed + 1)), F.lit(10_000))
        nulls = int(null_rate * 10_000) if f.nullable else 0
        if f.name in defaults:
            given = F.lit(defaults[f.name]).cast(f.dataType)
            cell = F.when(fate < nulls + int(default_rate * 10_000), given).otherwise(cell)
        if nulls:
            cell = F.when(fate >= nulls, cell)
        cells.append(cell.alias(f.name))
    return spark.range(n).select(*cells)
