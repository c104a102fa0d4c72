"""Hash and range partitions of keyed rows, as columns Spark can prune on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

RANGE = "_range"


def next_value(value):
    """The smallest value above ``value``; turns a closed end into an open one."""
    if isinstance(value, bool) or value is None:
        raise TypeError("a bound is a number, a string, a date or a timestamp")
    if isinstance(value, int):
        return value + 1
    if isinstance(value, str):
        return value + "\0"
    if isinstance(value, dt.datetime):
        return value + dt.timedelta(microseconds=1)
    if isinstance(value, dt.date):
        return value + dt.timedelta(days=1)
    raise TypeError(f"cannot close a bound of type {type(value).__name__}")


def literal(value) -> Column:
    """A literal that does not depend on the session time zone."""
    if isinstance(value, dt.datetime):
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)


@dataclass(frozen=True)
class HashLevel:
    columns: tuple[str, ...]
    buckets: int
    seed: int = 0


@dataclass(frozen=True)
class Bound:
    """One range: lower included, upper excluded; None is unbounded.

    ``buckets`` replaces the bucket counts of the hash levels in this range.
    """

    lower: object = None
    upper: object = None
    buckets: tuple[int, ...] | None = None

    @classmethod
    def of(cls, lower=None, upper=None, lower_included=True, upper_included=False, buckets=None):
        low = lower if lower is None or lower_included else next_value(lower)
        high = next_value(upper) if upper is not None and upper_included else upper
        return cls(low, high, buckets)

    @classmethod
    def single(cls, value, buckets=None):
        return cls(value, next_value(value), buckets)

    def holds(self, column: Column) -> Column:
        inside = column.isNotNull()
        if self.lower is not None:
            inside = inside & (column >= literal(self.lower))
        if self.upper is not None:
            inside = inside & (column < literal(self.upper))
        return inside

    def overlaps(self, other: "Bound") -> bool:
        below = self.upper is not None and other.lower is not None and self.upper <= other.lower
        above = other.upper is not None and self.lower is not None and other.upper <= self.lower
        return not (below or above)


@dataclass(frozen=True)
class PartitionSpec:
    """Hash levels, then ranges of one column. Without bounds every row is covered."""

    hash: tuple[HashLevel, ...] = ()
    range_column: str | None = None
    bounds: tuple[Bound, ...] = field(default=())

    def __post_init__(self):
        used = [c for level in self.hash for c in level.columns]
        if len(used) != len(set(used)):
            raise ValueError("hash levels may not share columns")
        if any(level.buckets < 2 for level in self.hash):
            raise ValueError("a hash level has at least two buckets")
        if bool(self.bounds) and self.range_column is None:
            raise ValueError("bounds need a range column")
        for i, a in enumerate(self.bounds):
            if a.lower is not None and a.upper is not None and a.lower >= a.upper:
                raise ValueError(f"empty range {a}")
            if a.buckets is not None and len(a.buckets) != len(self.hash):
                raise ValueError("a range names one bucket count per hash level")
            for b in self.bounds[i + 1 :]:
                if a.overlaps(b):
                    raise ValueError(f"ranges overlap: {a} and {b}")

    @property
    def columns(self) -> list[str]:
        ranged = [RANGE] if self.bounds else []
        return [*ranged, *[f"_bucket{i}" for i in range(len(self.hash))]]

    def with_range(self, bound: Bound) -> "PartitionSpec":
        return PartitionSpec(self.hash, self.range_column, (*self.bounds, bound))

    def without_range(self, bound: Bound) -> "PartitionSpec":
        rest = tuple(b for b in self.bounds if (b.lower, b.upper) != (bound.lower, bound.upper))
        if len(rest) == len(self.bounds):
            raise ValueError(f"no such range: {bound}")
        return PartitionSpec(self.hash, self.range_column, rest)

    def to_json(self) -> dict:
        return {
            "hash": [[list(h.columns), h.buckets, h.seed] for h in self.hash],
            "range_column": self.range_column,
            "bounds": [[b.lower, b.upper, b.buckets] for b in self.bounds],
        }

    @classmethod
    def from_json(cls, value: dict) -> "PartitionSpec":
        return cls(
            tuple(HashLevel(tuple(c), n, seed) for c, n, seed in value["hash"]),
            value["range_column"],
            tuple(Bound(a, b, tuple(n) if n else None) for a, b, n in value["bounds"]),
        )

    def count(self) -> int:
        """Number of partitions: the product of the levels, range by range."""
        total = 0
        for bound in self.bounds or (Bound(),):
            buckets = bound.buckets or tuple(level.buckets for level in self.hash)
            n = 1
            for b in buckets:
                n *= b
            total += n
        return total


def split_points(values: Sequence) -> tuple[Bound, ...]:
    """Ranges that cover everything, cut at the given values."""
    edges = [None, *sorted(values), None]
    return tuple(Bound(a, b) for a, b in zip(edges, edges[1:]))


def bucket(columns: Sequence[str | Column], buckets: int | Column, seed: int = 0) -> Column:
    """A stable bucket number of the columns."""
    n = F.lit(buckets) if isinstance(buckets, int) else buckets
    return F.pmod(F.xxhash64(*columns, F.lit(seed)), n).cast("int")


def range_number(spec: PartitionSpec) -> Column:
    """Position of the row's range in the spec; null where no range holds the row."""
    number = F.lit(None).cast("int")
    for i in reversed(range(len(spec.bounds))):
        number = F.when(spec.bounds[i].holds(F.col(spec.range_column)), i).otherwise(number)
    return number


def _level_buckets(spec: PartitionSpec, level: int) -> Column:
    """Bucket count of a level; a range may bring its own."""
    default = spec.hash[level].buckets
    count = F.lit(default)
    for i, bound in enumerate(spec.bounds):
        if bound.buckets is not None and bound.buckets[level] != default:
            count = F.when(F.col(RANGE) == i, bound.buckets[level]).otherwise(count)
    return count


def with_partition(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Add the partition columns ``_range``, ``_bucket0``, ..."""
    if spec.bounds:
        df = df.withColumn(RANGE, range_number(spec))
    for i, level in enumerate(spec.hash):
        df = df.withColumn(f"_bucket{i}", bucket(level.columns, _level_buckets(spec, i), level.seed))
    return df


def covered(spec: PartitionSpec) -> Column:
    """Whether a range holds the row; rows outside every range cannot be stored."""
    return range_number(spec).isNotNull() if spec.bounds else F.lit(True)


def split_covered(df: DataFrame, spec: PartitionSpec) -> tuple[DataFrame, DataFrame]:
    return df.filter(covered(spec)), df.filter(~covered(spec))


def drop_range(df: DataFrame, spec: PartitionSpec, bound: Bound) -> tuple[DataFrame, PartitionSpec]:
    """The table and spec without one range; its rows go with it."""
    smaller = spec.without_range(bound)
    return df.filter(~F.coalesce(bound.holds(F.col(spec.range_column)), F.lit(False))), smaller


def clustered(df: DataFrame, spec: PartitionSpec, keys: Sequence[str]) -> DataFrame:
    """Rows grouped by target partition and sorted by key inside it.

    A rebalance, so an oversized partition is spread over several tasks instead
    of growing one.
    """
    placed = with_partition(df, spec)
    return placed.hint("rebalance", *[F.col(c) for c in spec.columns]).sortWithinPartitions(
        *spec.columns, *keys
    )


def write_partitioned(df: DataFrame, spec: PartitionSpec, keys: Sequence[str], path: str) -> None:
    """One folder per partition, files sorted by key so row groups prune too."""
    clustered(df, spec, keys).write.partitionBy(*spec.columns).parquet(path)


def partition_predicate(
    spec: PartitionSpec,
    schema: StructType,
    equals: Mapping[str, object],
    lower: object = None,
    upper: object = None,
) -> Column:
    """What ``equals`` and the range ``[lower, upper)`` say about the partition columns."""
    wanted, predicate = Bound(lower, upper), F.lit(True)
    if spec.bounds:
        if spec.range_column in equals:
            wanted = Bound.single(equals[spec.range_column])
        hits = [i for i, b in enumerate(spec.bounds) if b.overlaps(wanted)]
        predicate = predicate & F.col(RANGE).isin(hits)
    for i, level in enumerate(spec.hash):
        if set(level.columns) <= set(equals):
            values = [literal(equals[c]).cast(schema[c].dataType) for c in level.columns]
            number = bucket(values, _level_buckets(spec, i), level.seed)
            predicate = predicate & (F.col(f"_bucket{i}") == number)
    return predicate


def row_predicate(
    spec: PartitionSpec, equals: Mapping[str, object], lower: object = None, upper: object = None
) -> Column:
    """The same about the rows themselves."""
    predicate = F.lit(True)
    for c, v in equals.items():
        predicate = predicate & (F.col(c) == literal(v))
    if lower is not None or upper is not None:
        predicate = predicate & Bound(lower, upper).holds(F.col(spec.range_column))
    return predicate


def pruned_scan(
    spark: SparkSession,
    path: str,
    spec: PartitionSpec,
    equals: Mapping[str, object] | None = None,
    lower: object = None,
    upper: object = None,
) -> DataFrame:
    """Rows with ``equals`` values and the range column in ``[lower, upper)``.

    Adds the partition predicate these imply, so only matching folders are read.
    """
    equals = dict(equals or {})
    df = spark.read.parquet(path)
    return (
        df.filter(partition_predicate(spec, df.schema, equals, lower, upper))
        .filter(row_predicate(spec, equals, lower, upper))
        .drop(*spec.columns)
    )


def partition_stats(df: DataFrame, spec: PartitionSpec) -> DataFrame:
    """Rows per partition."""
    return with_partition(df, spec).groupBy(*spec.columns).agg(F.count(F.lit(1)).alias("rows"))


def skew(stats: DataFrame) -> DataFrame:
    """Partitions, rows, and the largest partition against the mean."""
    return stats.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("rows").alias("rows"),
        (F.max("rows") / F.avg("rows")).alias("skew"),
    )
