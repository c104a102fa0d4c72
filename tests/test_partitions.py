import datetime as dt

import pytest
from pyspark.sql import functions as F

from olapkit.operators import partitions as parts
from olapkit.operators.partitions import Bound, HashLevel, PartitionSpec
from olapkit.workspace import new_path


def test_specs_are_checked():
    with pytest.raises(ValueError):
        PartitionSpec(hash=(HashLevel(("a",), 2), HashLevel(("a",), 3)))
    with pytest.raises(ValueError):
        PartitionSpec(range_column="a", bounds=(Bound(0, 10), Bound(9, 20)))
    with pytest.raises(ValueError):
        PartitionSpec(range_column="a", bounds=(Bound(5, 5),))
    with pytest.raises(ValueError):
        PartitionSpec(hash=(HashLevel(("a",), 1),))
    spec = PartitionSpec(range_column="a", bounds=(Bound(None, 10), Bound(20, None)))
    with pytest.raises(ValueError):
        spec.with_range(Bound(15, 21))
    assert len(spec.with_range(Bound(10, 20)).bounds) == 3


def test_partition_counts():
    levels = (HashLevel(("a",), 4), HashLevel(("b",), 2))
    assert PartitionSpec(hash=levels).count() == 8
    ranged = PartitionSpec(levels, "c", (Bound(0, 1), Bound(1, 2, (3, 1))))
    assert ranged.count() == 11


def test_open_and_closed_ends(spark):
    spec = PartitionSpec(
        range_column="k",
        bounds=(
            Bound.of(0, 5, lower_included=False, upper_included=True),
            Bound.single(9),
            Bound(20, None),
        ),
    )
    got = dict(
        spark.range(-1, 22).select(F.col("id").alias("k")).select("k", parts.range_number(spec)).collect()
    )
    want = {k: 0 if 1 <= k <= 5 else 1 if k == 9 else 2 if k >= 20 else None for k in range(-1, 22)}
    assert got == want
    assert Bound.single("ab").upper == "ab\0"
    assert Bound.of(upper=dt.date(2020, 1, 31), upper_included=True).upper == dt.date(2020, 2, 1)


def test_null_is_in_no_range(spark):
    spec = PartitionSpec(range_column="k", bounds=parts.split_points([5]))
    df = spark.createDataFrame([(None,), (1,), (7,)], "k INT")
    inside, outside = parts.split_covered(df, spec)
    assert inside.count() == 2 and outside.count() == 1


def test_only_matching_folders_are_read(spark):
    spec = PartitionSpec(
        hash=(HashLevel(("a",), 4),),
        range_column="k",
        bounds=(Bound(None, 100), Bound(100, 200, (2,)), Bound(200, None)),
    )
    df = spark.range(400).select((F.col("id") % 10).alias("a"), F.col("id").alias("k"))
    path = new_path(spark, "parts")
    parts.write_partitioned(df, spec, ["k"], path)
    scan = parts.pruned_scan(spark, path, spec, equals={"a": 3}, lower=150)
    assert {r["k"] for r in scan.collect()} == {k for k in range(150, 400) if k % 10 == 3}
    # inputFiles ignores predicates, so ask the rows where they come from.
    files = spark.read.parquet(path).select("_range", "_bucket0").distinct().count()
    assert files == 10
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_range" in plan.split("PartitionFilters: [")[1]
    read = scan.select(F.input_file_name()).distinct().count()
    assert read <= 2
    by_key = parts.pruned_scan(spark, path, spec, equals={"k": 250})
    assert [r["k"] for r in by_key.collect()] == [250]


def test_hot_partition_is_complete_and_sorted(spark):
    """A third of the rows share one value; none is lost and files are sorted by key."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("a"), F.col("id").alias("k")
    )
    spec = PartitionSpec(hash=(HashLevel(("a",), 8),))
    path = new_path(spark, "parts")
    parts.write_partitioned(df, spec, ["k"], path)
    back = spark.read.parquet(path)
    assert back.count() == 30_000
    assert back.agg(F.count_distinct("k")).first()[0] == 30_000
    stats = parts.skew(parts.partition_stats(df, spec)).first()
    assert stats["partitions"] == 8 and stats["skew"] > 2


def test_dropped_range_frees_its_place(spark):
    spec = PartitionSpec(range_column="k", bounds=(Bound(0, 10), Bound(10, 20)))
    df = spark.range(20).select(F.col("id").alias("k"))
    rest, smaller = parts.drop_range(df, spec, Bound(0, 10))
    assert rest.count() == 10
    assert smaller.with_range(Bound(0, 5)).bounds == (Bound(10, 20), Bound(0, 5))
    with pytest.raises(ValueError):
        parts.drop_range(df, smaller, Bound(0, 10))
