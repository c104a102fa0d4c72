"""Predicates, quality checks, shapes and encodings on small frames."""

import random

import pytest
from pyspark.sql import functions as F

from olapkit.functions import scalars
from olapkit.functions.predicates import (
    bloom_words,
    filter_json,
    key_range,
    might_contain,
    require_not_null,
)
from olapkit.operators import models, quality, scan
from olapkit.plans import flat
from olapkit.sources import encode, files
from olapkit.workspace import new_path


def test_json_predicates(spark):
    df = spark.createDataFrame([(i, None if i % 2 else f"s{i}") for i in range(10)], "i INT, s STRING")

    def kept(spec):
        return [r["i"] for r in filter_json(df, spec).orderBy("i").collect()]

    assert kept('["AND", [">=", "i", 3], ["<", "i", 6]]') == [3, 4, 5]
    assert kept('["IN", "i", [1, 8, 99]]') == [1, 8]
    assert kept('["AND", ["NOTNULL", "s"], [">", "s", "s4"]]') == [6, 8]
    assert kept('["AND", ["NULL", "s"], ["=", "i", 4]]') == []
    assert kept('["AND"]') == list(range(10))
    for bad in ('["OR", ["NULL", "s"]]', '["=", "zz", 1]', '["=", "i"]', "{}"):
        with pytest.raises(ValueError):
            kept(bad)


def test_key_range(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(4), rng.randrange(4), f"c{rng.randrange(4)}") for _ in range(200)]
    df = spark.createDataFrame(rows, "a INT, b INT, c STRING")
    low, high = (1, 2, "c1"), (3, 0, "c2")
    got = sorted(tuple(r) for r in key_range(df, ["a", "b", "c"], low, high).collect())
    assert got == sorted(r for r in rows if low <= r < high)
    got = key_range(df, ["a", "b", "c"], upper=high).count()
    assert got == sum(r < high for r in rows)
    with pytest.raises(ValueError):
        key_range(df, ["a", "b"], (1,))


def test_bloom_keeps_every_match_and_prunes(spark):
    keys = spark.range(0, 20_000, 20).select(F.col("id").alias("k"))
    rows = spark.range(20_000).select(F.col("id").alias("x"))
    words = bloom_words(keys, "k", bits=1 << 16)
    assert words.count() <= (1 << 16) / 64
    hits = {r["x"] for r in might_contain(rows, "x", words, bits=1 << 16).collect()}
    assert set(range(0, 20_000, 20)) <= hits
    assert len(hits) < 1500
    plan = might_contain(rows, "x", words, bits=1 << 16)._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan


def test_not_null_fails_the_job(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "i INT, s STRING")
    assert require_not_null(df, "i").count() == 2
    with pytest.raises(Exception, match="null in s"):
        require_not_null(df, "i", "s").collect()


def test_difference_counts_copies(spark):
    a = spark.createDataFrame([(1,), (1,), (1,), (2,), (None,)], "x INT")
    b = spark.createDataFrame([(1,), (3,), (None,)], "x INT")
    got = sorted(tuple(r) for r in scan.table_difference(a, b).collect())
    assert got == [("left", 1), ("left", 1), ("left", 2), ("right", 3)]
    assert scan.table_difference(a, a).isEmpty()
    left = scan.table_difference(a, b).filter("side = 'left'").select("x")
    assert left.exceptAll(a.exceptAll(b)).isEmpty()


def test_quality_checks(spark):
    parents = spark.createDataFrame([(1, "long enough"), (2, "ab"), (3, None)], "id INT, address STRING")
    children = spark.createDataFrame([(10, 1), (11, 2), (12, 2), (13, None)], "c INT, fk INT")
    kept, lost = quality.reject(parents, F.length("address") < 5, ["id"])
    assert sorted(r["id"] for r in kept.collect()) == [1, 3]
    left, gone = quality.cascade(lost, children, "fk", ["c"])
    assert sorted(r["c"] for r in left.collect()) == [10, 13]
    assert sorted(r["c"] for r in gone.collect()) == [11, 12]
    assert quality.clean_report("children", children, "fk", lost).first()[1:] == (4, 2, 2)
    orphans = quality.foreign_key_violations(children, "fk", kept, "id").collect()
    assert [tuple(r) for r in orphans] == [(2, 2)]
    keys = spark.createDataFrame([(1, 1), (1, 1), (2, 1), (None, 3)], "a INT, b INT")
    bad = quality.primary_key_violations(keys, ["a", "b"]).collect()
    assert sorted((r["rows"], r["reason"]) for r in bad) == [(1, "null"), (2, "duplicate")]


def test_sparse_orders_have_one_row_of_any_width(spark):
    lines = spark.range(1000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("l_orderkey"),
        (F.col("id") % 500).alias("l_partkey"),
        F.lit(1.0).alias("l_quantity"),
    )
    orders = lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct().withColumn("o_custkey", F.lit(1))
    orders = orders.unionByName(spark.createDataFrame([(-5, 1)], "o_orderkey BIGINT, o_custkey INT"))
    customer = spark.createDataFrame([(1, "c", 2)], "c_custkey INT, c_name STRING, c_nationkey INT")
    nation = spark.createDataFrame([(2, "n", 3)], "n_nationkey INT, n_name STRING, n_regionkey INT")
    region = spark.createDataFrame([(3, "r")], "r_regionkey INT, r_name STRING")
    rows = models.sparse_order(lines, orders, customer, nation, region)
    assert rows.count() == rows.select("o_orderkey").distinct().count() == orders.count()
    wide = rows.filter("o_orderkey = 1").select(F.explode("quantities").alias("part", "n"))
    assert wide.agg(F.sum("n")).first()[0] == lines.filter("l_orderkey = 1").count()
    assert [tuple(r) for r in rows.filter("o_orderkey = -5").select("c_regionname", F.size("quantities")).collect()] == [("r", 0)]


def test_sparsify_draws_by_chance(spark):
    df = spark.range(20_000).select("id", F.lit("a").alias("x"), F.lit("b").alias("y"))
    thin = models.sparsify(df, ["id"], [(10, ["x"]), (30, [])], seed=1)
    n = thin.agg(F.count("id"), F.count("x"), F.count("y")).first()
    assert n[0] == 20_000
    assert abs(n[1] - 14_000) < 400 and abs(n[2] - 12_000) < 400
    assert thin.exceptAll(models.sparsify(df, ["id"], [(10, ["x"]), (30, [])], seed=1)).isEmpty()
    with pytest.raises(ValueError):
        models.sparsify(df, ["id"], [(60, []), (50, [])])


def test_calendar(spark):
    days = {str(r["date"]): r for r in models.date_dim(spark).collect()}
    assert len(days) == 2557 and "1998-12-31" in days
    leap = days["1992-02-29"]
    assert (leap["dayNumInYear"], leap["dayNumInWeek"], leap["yearMonth"]) == (60, 7, "1992-2")
    assert days["1992-01-01"]["dateKey"] == 1


def test_scalars(spark):
    df = spark.createDataFrame([(17, "abcdef", 123.456)], "n LONG, s STRING, d DOUBLE")
    got = df.select(
        scalars.part_price_cents(F.col("n")),
        scalars.sparse_order_key(F.col("n")),
        scalars.clerk_label(F.col("n")),
        scalars.varchar(F.col("s"), 3),
        scalars.decimal_or_null(F.col("d"), 5, 2).cast("double"),
        scalars.decimal_or_null(F.col("d"), 4, 2),
        scalars.us_timestamp(F.lit("02/30/2020 00:00:00")),
        scalars.iso_date(F.lit("2020-13-01")),
    ).first()
    assert tuple(got) == (91701, 65, "Clerk#000000017", "abc", 123.46, None, None, None)
    with pytest.raises(ValueError):
        scalars.varchar(F.col("s"), 0)


def test_records_skip_missing_fields(spark):
    df = spark.createDataFrame(
        [(1, "AIR", 5.0, "1995-01-01"), (2, "AIR", None, "1995-01-02"), (3, "MAIL", 1.0, "bad")],
        "id INT, mode STRING, price DOUBLE, day STRING",
    )
    records = encode.to_hash_records(df, ["mode", "id"])
    assert {r["key"] for r in records.collect()} == {"AIR_1", "AIR_2", "MAIL_3"}
    types = {"price": "double", "day": "date", "absent": "int"}
    back = {r["key"]: r for r in encode.from_hash_records(records, types, ["price"]).collect()}
    assert set(back) == {"AIR_1", "MAIL_3"}
    assert back["MAIL_3"]["day"] is None and back["AIR_1"]["absent"] is None


def test_json_payloads(spark):
    payloads = [
        '[{"a": 1, "b": "x", "c": 0}, {"a": 2}]',
        '{"a": 3, "b": "y"}',
        "[]",
        "not json",
        None,
    ]
    df = spark.createDataFrame(list(enumerate(payloads)), "id INT, p STRING")
    got = encode.json_fields(df, "p", {"a": "int", "b": "string"}).collect()
    rows = [(r["id"], r["a"], r["b"]) for r in got if r["a"] is not None]
    assert sorted(rows) == [(0, 1, "x"), (0, 2, None), (1, 3, "y")]


def test_pipe_lines_keep_empty_fields(spark):
    df = spark.createDataFrame([(1, None, "c"), (2, "b", None)], "a INT, b STRING, c STRING")
    assert sorted(r[0] for r in encode.to_pipe_lines(df).collect()) == ["1||c", "2|b|"]


def test_batched_and_clustered_files(spark):
    path = new_path(spark, "batches")
    files.write_batches(spark.range(25), 10, ["id"], path)
    got = spark.read.parquet(path).groupBy("batch").agg(F.min("id"), F.max("id")).collect()
    assert sorted(tuple(r) for r in got) == [(0, 0, 9), (1, 10, 19), (2, 20, 24)]
    path = new_path(spark, "clustered")
    df = spark.range(1000).select((F.col("id") % 5).alias("k"), "id")
    files.clustered_write(df, ["k"], 4, path)
    assert spark.read.parquet(path).exceptAll(df).isEmpty()
    with pytest.raises(ValueError):
        files.save(df, path, "truncate")


def test_flat_discount_skips_missing_fields(spark):
    rows = [("1995-01-01", 0.05, 100.0, 1.0), ("1995-01-01", None, 100.0, 1.0), (None, 0.05, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "d STRING, l_discount DOUBLE, l_extendedprice DOUBLE, l_quantity DOUBLE")
    df = df.withColumn("l_shipdate", F.to_date("d"))
    assert flat.discount_revenue(df).first()["revenue"] == 5.0
