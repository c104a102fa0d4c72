"""Metric series, numbering, links and generated rows against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from olapkit.operators import metrics, verify
from olapkit.operators.numbering import number_rows, split_batches, unique_ids
from olapkit.operators.scan import table_difference
from olapkit.operators.skew import hot_keys, salted_join
from olapkit.registry import series as registered

ALL_TYPES = (
    "key INT, c_bool BOOLEAN, c_byte TINYINT, c_short SMALLINT, c_int INT, c_long BIGINT, c_float FLOAT,"
    " c_double DOUBLE, c_decimal DECIMAL(20,4), c_string STRING, c_binary BINARY, c_time TIMESTAMP, c_date DATE"
)


def series(spark, data):
    rows = [(h, "m", t, float(v)) for h, points in data.items() for t, v in points.items()]
    return spark.createDataFrame(rows, "host STRING, metric STRING, timestamp INT, value DOUBLE")


def random_series(seed):
    rng = random.Random(seed)
    return {
        # One host owns most points, over several days and with gaps at day borders.
        "hot": {t: t % 97 for t in rng.sample(range(1_000_000, 1_400_000), 600)},
        "cold": {t * 7: t for t in rng.sample(range(1000), 20)},
        "one": {500: 3},
        "edge": {86_399: 1, 86_400: 2, 200_000: 5},
    }


def step_of(points):
    times = sorted(points)
    gaps = [b - a for a, b in zip(times, times[1:])]
    return max(min(gaps, default=1), 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_step(spark, seed):
    data = random_series(seed)
    got = {r["host"]: r["step"] for r in metrics.infer_step(series(spark, data)).collect()}
    assert got == {h: step_of(p) for h, p in data.items()}


@pytest.mark.parametrize("step", [1, 60, 3601])
def test_resample(spark, step, monkeypatch):
    monkeypatch.setattr(metrics, "GRID_CHUNK", 1000)
    data = random_series(3)
    if step == 1:
        data = {h: data[h] for h in ("cold", "one")}
    points = series(spark, data)
    steps = metrics.metric_ids(points).withColumn("step", F.lit(step).cast("long"))
    grids = [metrics.resample(points, s).collect() for s in (steps, step)]
    got, same = ({(r["host"], r["timestamp"]): r["value"] for r in rows} for rows in grids)
    assert got == same
    want = {}
    for host, values in data.items():
        first, last, used = min(values), max(values), -1
        for i in range(math.ceil((last - first) / step) + 1):
            now = first + i * step
            newest = max(t for t in values if t <= now)
            want[host, now] = float(values[newest]) if newest > used else None
            used = max(used, newest)
    assert got == want


def test_parse_lines(spark):
    lines = [
        "host.example.com/.cpuload.avg1 2.27 1435788059",
        "host/.a.b x 1",
        "host/.a 1.0",
        "host-a 1.0 5",
        "host/.a 1.0 5.5",
        "host/.a 1.0 5 6",
        "",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "line STRING")
    good, bad = metrics.parse_metric_lines(df)
    assert [tuple(r) for r in good.collect()] == [
        ("host.example.com", "cpuload.avg1", 1435788059, 2.27)
    ]
    assert sorted(r["line"] for r in bad.collect()) == sorted(lines[1:])


def test_find_and_tree(spark):
    ids = spark.createDataFrame(
        [("web1.com", "cpu/load"), ("web2.com", "cpu"), ("db.com", "cpu.load"), ("web1x.com", "cpu")],
        "host STRING, metric STRING",
    )

    def find(pattern):
        return {(r["path"], r["is_leaf"]) for r in metrics.find(ids, pattern).collect()}

    assert find("web*") == {("web1", False), ("web2", False), ("web1x", False)}
    assert find("web{1,2}.com.cpu") == {("web1.com.cpu", False), ("web2.com.cpu", True)}
    assert find("*.com.cpu.load") == {("web1.com.cpu.load", True), ("db.com.cpu.load", True)}
    assert find("w.b1") == set()
    tree = {r["path"]: (r["is_leaf"], r["children"]) for r in metrics.metric_tree(ids).collect()}
    assert tree["web1"] == (False, 1) and tree["web1.com.cpu.load"] == (True, 0)
    assert len(tree) == 14


def test_stat_lines(spark):
    lines = ['"usr","sys"', "1.5, 2", "1,2,3", "x,1", "  3,4 "]
    df = spark.createDataFrame([(x,) for x in lines], "line STRING")
    got = metrics.parse_stat_lines(df, ["usr", "sys"], F.lit(9).cast("long")).collect()
    assert sorted(tuple(r) for r in got) == [(9, 1.5, 2.0), (9, 3.0, 4.0)]


def test_numbers_are_consecutive_with_ties_and_a_hot_group(spark):
    df = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("g"),
        (F.col("id") % 4).alias("tie"),
    )
    rows = number_rows(df, ["tie"], "n").collect()
    assert sorted(r["n"] for r in rows) == list(range(1, 9001))
    by_number = sorted(rows, key=lambda r: r["n"])
    assert [r["tie"] for r in by_number] == sorted(r["tie"] for r in rows)
    groups = {}
    for r in number_rows(df, ["tie"], "n", within=["g"]).collect():
        groups.setdefault(r["g"], []).append((r["n"], r["tie"]))
    for members in groups.values():
        members.sort()
        assert [n for n, _ in members] == list(range(1, len(members) + 1))
        assert [t for _, t in members] == sorted(t for _, t in members)


def test_numbering_spreads_one_value_over_tasks(spark):
    """A single repeated value must not end in one task."""
    df = spark.range(80_000, numPartitions=8).select(F.lit(1).alias("x"), "id")
    rows = number_rows(df, ["x"], "n")
    assert rows.agg(F.max("n"), F.count_distinct("n")).first()[:] == (80_000, 80_000)
    placed = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(8, "x", "_tie")
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 80_000 / 4


def test_batches(spark):
    got = split_batches(spark.range(25), 10, ["id"]).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in got} == {0: 10, 1: 10, 2: 5}
    ids = unique_ids(spark.range(100).repartition(7))
    assert ids.select(F.count_distinct("id")).first()[0] == 100


def test_verify_links_golden(spark):
    """Rings plus three bad nodes: one extra, two unreferenced, one undefined."""
    lists = spark.range(4).select(F.col("id").alias("list"))
    links = verify.generate_links(lists, "list", nodes=500)
    bad = spark.createDataFrame(
        [(0, 0, -1, -1), (0, 1, 0, 0), (0, 2, 0, 0)], "key1 LONG, key2 LONG, prev1 LONG, prev2 LONG"
    )
    nodes = links.select("key1", "key2", "prev1", "prev2").unionByName(bad)
    got = verify.verify_links(nodes, ["key1", "key2"], ["prev1", "prev2"]).first()
    assert tuple(got) == (2000, 1, 2, 1)


def test_checksum_ignores_order_and_sees_changes(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 2 == 0, F.col("id")).alias("x"))
    same = verify.checksum_equal(df, df.repartition(3).orderBy(F.desc("id"))).first()
    assert same["equal"] and same["rows"] == 100
    moved = df.select("id", F.when(F.col("id") % 2 == 1, F.col("id")).alias("x"))
    assert not verify.checksum_equal(df, moved).first()["equal"]
    assert not verify.checksum_equal(df, df.limit(99)).first()["equal"]


def test_random_rows(spark):
    schema = StructType.fromDDL(ALL_TYPES)

    def rows(seed):
        return verify.random_rows(
            spark, schema, 2000, seed, null_rate=0.2, defaults={"c_int": 7}, sequential=["key"]
        )

    a, b = rows(1), rows(1).repartition(5)
    assert verify.checksum_equal(a, b).first()["equal"]
    assert not verify.checksum_equal(a, rows(2)).first()["equal"]
    stats = a.agg(
        F.count_distinct("key").alias("keys"),
        *[F.count(c).alias(c) for c in schema.names[1:]],
        F.count_if(F.col("c_int") == 7).alias("sevens"),
    ).first()
    assert stats["keys"] == 2000
    assert all(1500 < stats[c] < 1700 for c in schema.names[1:])
    assert 150 < stats["sevens"] < 250
    assert a.dtypes == spark.createDataFrame([], schema).dtypes


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_answers_like_a_plain_one(spark, how):
    many = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k")
    )
    unique = spark.range(0, 40, 3).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    if how in ("left_semi", "left_anti"):
        unique = unique.select("k")
    want = many.join(unique, "k", how)
    hot = hot_keys(many, ["k"], 100)
    assert [r["k"] for r in hot.collect()] == [0]
    for got in (salted_join(many, unique, ["k"], how), salted_join(many, unique, ["k"], how, hot)):
        assert table_difference(got, want.select(*got.columns)).isEmpty()


def test_salted_join_spreads_a_hot_key(spark):
    many = spark.range(32_000).select("id", F.lit(1).alias("k"))
    unique = spark.createDataFrame([(1, "x")], "k INT, v STRING")
    saved = {
        c: spark.conf.get(c)
        for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = hot_keys(many, ["k"], 1000)
        joined = salted_join(many, unique, ["k"], hot=hot, salts=64)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in saved.items():
            spark.conf.set(c, v)
    assert sum(sizes) == 32_000 and max(sizes) < 16_000


def test_files_of_arrivals_stay_small(spark, tables, monkeypatch):
    monkeypatch.setattr(registered, "ROWS_PER_FILE", 10)
    path, files = registered.staged(tables, spark.range(100))
    counts = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert files == 4 and len(counts) == 12 and max(r["count"] for r in counts) <= 20
    assert spark.read.parquet(path).distinct().count() == 100
    assert registered.staged(tables, spark.range(0))[1] == 1


def test_a_stream_sees_three_parts(spark, tables, monkeypatch):
    monkeypatch.setattr(registered, "ROWS_PER_FILE", 500)
    seen, stream = [], registered.streams.file_stream
    monkeypatch.setattr(registered.streams, "file_stream", lambda *a, **k: seen.append(k["per_trigger"]) or stream(*a, **k))
    registered.stream_q1(tables)
    assert seen == [-(-tables.lineitem.count() // 1500)] and seen[0] > 1
