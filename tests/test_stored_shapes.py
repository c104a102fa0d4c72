"""Shapes stored by the version of their inputs."""

import re

import pytest
from pyspark.sql import functions as F

from olapkit.operators import models
from olapkit.plans.tables import Tables
from olapkit.registry import QUERIES
from olapkit.registry.shapes import flat, flat_shape, record_shape, shape_store
from olapkit.sources.stored_shapes import Shape, ShapeStore, files_version

SMALL = "/root/testdata/sf0.001"


def counted(spark, path, built):
    def build():
        built.append(1)
        return spark.read.parquet(path).groupBy("g").agg(F.sum("n").alias("n"))

    return Shape("sums", (path,), build, sort_by=("g",))


def test_a_shape_is_built_once_for_the_same_files(spark, tmp_path):
    path, built = str(tmp_path / "in"), []
    spark.range(10).selectExpr("id % 3 g", "id n").write.parquet(path)
    store = ShapeStore(spark, str(tmp_path / "store"))
    shape = counted(spark, path, built)
    want = {(0, 18), (1, 12), (2, 15)}
    for _ in range(3):
        assert {tuple(r) for r in store.read(shape).collect()} == want
    assert built == [1]
    # Another store object finds it too; another revision doesn't.
    assert ShapeStore(spark, str(tmp_path / "store")).load(shape) == store.load(shape)
    store.load(Shape("sums", shape.inputs, shape.build, revision=2))
    assert built == [1, 1]


def test_a_changed_file_gives_a_new_version(spark, tmp_path):
    path, built = str(tmp_path / "in"), []
    spark.range(10).selectExpr("id % 3 g", "id n").write.parquet(path)
    store, before = ShapeStore(spark, str(tmp_path / "store")), files_version(spark, [path])
    shape = counted(spark, path, built)
    old = store.read(shape)
    spark.range(1).selectExpr("id g", "100L n").write.mode("append").parquet(path)
    assert files_version(spark, [path]) != before
    assert (0, 118) in {tuple(r) for r in store.read(shape).collect()}
    assert (0, 18) in {tuple(r) for r in old.collect()}
    assert built == [1, 1]


def test_a_shape_without_document_does_not_exist(spark, tmp_path):
    path, built = str(tmp_path / "in"), []
    spark.range(3).selectExpr("id g", "id n").write.parquet(path)
    store = ShapeStore(spark, str(tmp_path / "store"))
    shape = counted(spark, path, built)
    # Rows of a session that died before its document.
    spark.range(5).write.parquet(f"{store.folder(shape)}/data-dead")
    assert store.read(shape).count() == 3 and built == [1]


@pytest.mark.parametrize("name, used", [("flat_q1", 6), ("flat_q4", 4), ("flat_q5", 4)])
def test_a_wide_query_scans_one_table_and_its_columns(spark, name, used):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 1 and "Join" not in plan
    assert scans[0].split("ReadSchema: struct<")[1].count(":") == used


def test_stored_rows_are_sorted_in_their_files(spark):
    store = shape_store(Tables(spark, SMALL))
    rows = spark.read.parquet(store.load(flat_shape(Tables(spark, SMALL))))
    seen = rows.select("_metadata.file_path", "_metadata.row_index", "l_shipdate").orderBy("file_path", "row_index").collect()
    assert all(a["l_shipdate"] <= b["l_shipdate"] for a, b in zip(seen, seen[1:]) if a["file_path"] == b["file_path"])


def test_records_follow_their_shape(spark):
    assert QUERIES["kv_q5"](spark, SMALL).collect() == QUERIES["flat_q5"](spark, SMALL).collect()


def exchanged(df):
    """The columns of each shuffle of a plan."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    inputs = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    return [{c.split("#")[0] for c in columns.split(", ")} for columns in inputs]


def test_line_items_are_shuffled_while_they_are_narrow(spark):
    n = spark.range(100_000)
    key = "id % 1000"
    lineitem = n.selectExpr(f"{key} l_orderkey", f"{key} l_partkey", f"{key} l_suppkey", "id l_quantity")
    orders = n.selectExpr("id o_orderkey", f"{key} o_custkey", "'x' || id o_orderstatus")
    customer = n.selectExpr("id c_custkey", "'c' || id c_name", "1L c_nationkey")
    part = n.selectExpr("id p_partkey", "'p' || id p_name")
    supplier = n.selectExpr("id s_suppkey", "'s' || id s_name", "1L s_nationkey")
    nation = spark.createDataFrame([(1, "n", 1)], "n_nationkey BIGINT, n_name STRING, n_regionkey BIGINT")
    region = spark.createDataFrame([(1, "r")], "r_regionkey BIGINT, r_name STRING")
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.set(name, "1000")
        wide = models.flat_line_item(lineitem, orders, customer, part, supplier, nation, region)
        moved = exchanged(wide)
        assert wide.agg(F.count("s_regionname"), F.sum("l_quantity")).first() == (100_000, 4_999_950_000)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    lines = [columns for columns in moved if "l_quantity" in columns]
    assert len(lines) == 3 and not any(columns & {"c_name", "o_orderstatus"} for columns in lines), lines
    assert not any(c.endswith(("nationname", "regionname")) for columns in moved for c in columns)


def test_no_shuffle_carries_what_follows_from_the_keys(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "-1")
        moved = exchanged(flat(Tables(spark, SMALL)))
    finally:
        spark.conf.set(name, before)
    assert moved and not any(columns & {"l_commitdate", "l_receiptdate", "l_shipmode"} for columns in moved)


def test_stored_shapes_are_packed(spark):
    t = Tables(spark, SMALL)
    for shape in (flat_shape(t), record_shape(t)):
        files = spark.read.parquet(shape_store(t).load(shape)).inputFiles()
        assert files and all(".zstd." in f for f in files)
