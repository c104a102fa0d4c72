"""Stored sketches, placed tables, documents of varying shape, and checksums other engines can repeat."""

import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from olapkit.operators import sketches, verify
from olapkit.sources import bucketed, variants
from olapkit.sources.keyed_table import KeyedTable
from olapkit.streaming import upsert as streams

# Sketches


def test_united_sketches_are_those_of_the_union(spark):
    rows = spark.range(60_000).selectExpr("id % 12 month", "id % 7 g", "id * 7919 % 41011 v", "CAST(NULL AS BIGINT) none")
    months = sketches.distinct_sketches(rows, ["month"], ["v", "none"])
    whole = sketches.count_distinct_stored(months, [], ["v", "none"]).first()
    direct = sketches.estimates(sketches.distinct_sketches(rows, [], ["v"]), ["v"]).first()
    # The union has no order of arrival to go by, so it may differ a little from the direct sketch.
    bound = 4 * sketches.standard_error()
    assert abs(whole["v"] - 41011) <= bound * 41011 and abs(direct["v"] - 41011) <= bound * 41011
    assert whole["none"] == 0
    again = sketches.united(sketches.united(months, ["month"], ["v"]), [], ["v"])
    assert sketches.estimates(again, ["v"]).first()["v"] == whole["v"]


@pytest.mark.parametrize("n", [0, 1, 5, 100, 3000])
def test_few_values_are_nearly_exact(spark, n):
    rows = spark.range(n * 3).selectExpr(f"id % {max(n, 1)} v")
    got = sketches.estimates(sketches.distinct_sketches(rows, [], ["v"]), ["v"])
    assert got.select(sketches.within(F.col("v"), F.lit(n))).first()[0]


def test_overlap_of_two_groups(spark):
    a, b = spark.range(0, 20_000), spark.range(15_000, 40_000)
    one, other = (sketches.distinct_sketches(x, [], ["id"]).first()["id"] for x in (a, b))
    frame = spark.createDataFrame([(one, other)], "a binary, b binary")
    got = sketches.overlap(frame, {"both": (F.col("a"), F.col("b"))}).first()["both"]
    assert abs(got - 5000) <= 4 * sketches.standard_error() * 40_000


# Placed tables


def test_placed_tables_join_without_a_shuffle(spark, tmp_path):
    left = spark.range(5000).selectExpr("id % 700 k", "id a")
    right = spark.range(900).selectExpr("id k", "id * 2 b")
    for name, df in (("left", left), ("right", right)):
        bucketed.write_bucketed(df, str(tmp_path / name), ["k"], 6)
    l, r = (bucketed.read_bucketed(spark, str(tmp_path / n)) for n in ("left", "right"))
    joined = l.join(r.hint("merge"), "k").groupBy("k").agg(F.count("*").alias("n"), F.sum("b").alias("b"))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan, plan
    want = left.join(right, "k").groupBy("k").agg(F.count("*").alias("n"), F.sum("b").alias("b"))
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("n", [1, 3, 16])
def test_each_bucket_is_one_file_and_holds_its_keys(spark, tmp_path, n):
    path = str(tmp_path / "rows")
    rows = spark.range(2000).selectExpr("CAST(id % 100 AS INT) k", "concat('s', id % 5) s", "id v").repartition(9)
    bucketed.write_bucketed(rows, path, ["k", "s"], n)
    layout = bucketed.bucket_layout(spark.read.parquet(path), ["k", "s"], n).collect()
    assert len(layout) == n and all((r["files"], r["misplaced"]) == (1, 0) for r in layout)
    assert sum(r["rows"] for r in layout) == 2000
    # Readable as plain files, and by any number of readers as placed.
    assert spark.read.parquet(path).count() == 2000
    assert bucketed.read_bucketed(spark, path).count() == bucketed.read_bucketed(spark, path).count() == 2000


def test_misplaced_rows_and_hot_keys_are_seen(spark, tmp_path):
    path = str(tmp_path / "rows")
    rows = spark.range(1000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END k")
    bucketed.write_bucketed(rows, path, ["k"], 4)
    wrong = bucketed.bucket_layout(spark.read.parquet(path).withColumn("k", F.col("k") + 1), ["k"], 4)
    assert wrong.agg(F.sum("misplaced")).first()[0] > 0
    with pytest.raises(ValueError, match="of 1000 rows"):
        bucketed.write_bucketed(rows, str(tmp_path / "hot"), ["k"], 16, max_share=0.2)
    with pytest.raises(ValueError):
        bucketed.write_bucketed(rows, str(tmp_path / "none"), [], 4)


# Documents of varying shape

TEXTS = [
    '{"id": 1, "a": 1, "it\'s \\\\ odd": "x", "n": {"z": 1.5}, "why\'s \\"it\\"?": 4}',
    '{"id": 2, "a": "2", "list": [1, 2], "void": null, "d": 1e3}',
    '{"id": 3, "a": true}',
    "{bad",
    "[1]",
    '"text"',
    None,
    "{}",
]


@pytest.fixture(scope="module")
def documents(spark):
    return variants.to_variants(spark.createDataFrame([(t,) for t in TEXTS], "t string"), "t", "v").drop("t")


def test_fields_are_null_where_they_are_missing_or_of_another_kind(spark, documents):
    got = variants.typed_fields(documents, "v", {"id": "int", "a": "int", "it's \\ odd": "string", "d": "double", "gone": "string"})
    assert got.first() is not None
    odd = documents.select(variants.field("v", 'why\'s "it"?', "int").alias("odd"))
    assert sorted(str(r["odd"]) for r in odd.collect()) == ["4", *["None"] * 7]
    rows = {tuple(r) for r in got.collect()}
    assert rows == {
        (1, 1, "x", None, None),
        (2, 2, None, 1000.0, None),
        (3, 1, None, None, None),
        (None, None, None, None, None),
    }


def test_observed_fields_and_their_common_schema(spark, documents):
    objects = documents.filter(F.schema_of_variant("v").startswith("OBJECT"))
    seen = {(r["field"], r["type"]): r["rows"] for r in variants.observed_fields(objects, "v").collect()}
    assert seen[("a", "BIGINT")] == seen[("a", "STRING")] == seen[("a", "BOOLEAN")] == 1
    assert seen[("id", "BIGINT")] == 3 and seen[("n", "OBJECT")] == 1 and seen[("void", "VOID")] == 1
    schema = {f.name: f.dataType.simpleString() for f in variants.common_schema(documents, "v")}
    assert schema == {
        "id": "bigint", "a": "string", "it's \\ odd": "string", "n": "string", "list": "string", "d": "double",
        'why\'s "it"?': "bigint",
    }
    assert variants.common_schema(documents.limit(0), "v").names == []


def test_a_stream_of_documents_widens_its_table(spark, tmp_path):
    files = ['{"id": 1, "a": 1}\n{bad\n[3]\n{"a": 5}', '{"id": 1, "a": "7", "b": {"c": 1}}\n{"id": 2, "e": null}', '{"id": 3, "a": "x", "e": 2.5}']
    path = tmp_path / "in"
    path.mkdir()
    table = KeyedTable.create(spark, str(tmp_path / "t"), spark.createDataFrame([], "id BIGINT").schema, ["id"])
    for i, text in enumerate(files):
        (path / f"{i}.json").write_text(text)
        stream = streams.file_stream(spark, str(path), "value STRING", "text", per_trigger=1)
        streams.document_stream(stream, "value", table, "docs", str(tmp_path / "progress")).awaitTermination()
    got = {r["id"]: (r["a"], r["b"], r["e"]) for r in table.latest().select("id", "a", "b", "e").collect()}
    # The table's type of a field stays that of its first batch.
    assert got == {1: (7, '{"c":1}', None), 2: (None, None, None), 3: (None, None, 2.5)}


# Checksums


def test_checksum_is_the_sum_of_md5_beginnings(spark):
    rows = [(1, "a|b", 0.1), (2, None, 2.0), (2, None, 2.0), (3, "\\N", -1.23456)]
    df = spark.createDataFrame(rows, "k int, s string, x double").repartition(3)
    texts = ["1|a\\pb|0.1000", "2|\\N|2.0000", "2|\\N|2.0000", "3|\\\\N|-1.2346"]
    want = sum(int(hashlib.md5(t.encode()).hexdigest()[:15], 16) for t in texts)
    got = verify.portable_checksum(df, ["k", "s", "x"]).first()
    assert (got["rows"], got["md5_sum"]) == (4, Decimal(want))
    other = verify.portable_checksum(df.replace("a|b", "a", "s"), ["k", "s", "x"]).first()
    assert other["md5_sum"] != got["md5_sum"]
