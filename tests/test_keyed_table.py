"""Keyed tables against a plain dictionary, at every commit."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from olapkit.operators.partitions import Bound, HashLevel, PartitionSpec
from olapkit.sources import keyed_table as kt
from olapkit.sources.keyed_table import KeyedTable
from olapkit.workspace import new_path

SCHEMA = "k INT, v STRING"


def rows_of(df):
    return {r["k"]: r["v"] for r in df.collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def new_table(spark, **options):
    schema = frame(spark, []).schema
    return KeyedTable.create(spark, new_path(spark, "t"), schema, ["k"], **options)


def test_random_history(spark):
    rng = random.Random(5)
    table, state, states = new_table(spark), {}, {0: {}}
    for ts in range(10, 90, 10):
        op = rng.choice(["insert_ignore", "upsert", "update_ignore", "delete_ignore"])
        picked = rng.sample(range(12), 6)
        rows = [(k, f"{op}{ts}") for k in picked]
        changes = frame(spark, rows)
        table.write(op, changes.select("k") if op == "delete_ignore" else changes, ts=ts)
        for k, v in rows:
            if op == "delete_ignore":
                state.pop(k, None)
            elif op == "upsert" or (op == "insert_ignore") == (k not in state):
                state[k] = v
        states[ts] = dict(state)
        if ts == 40:
            table.compact()
    for ts, want in states.items():
        assert rows_of(table.as_of(ts)) == want, ts
    times = sorted(states)
    for a, b in [(0, 80), (20, 60), (40, 50), (10, 30), (30, 70)]:
        got = {r["k"]: (r["v"], r["is_deleted"]) for r in table.diff(a, b).collect()}
        # Replaying the difference on the older state gives the newer one.
        replayed = dict(states[a])
        for k, (v, gone) in got.items():
            if gone:
                assert k in states[a] and k not in states[b]
                replayed.pop(k)
            else:
                replayed[k] = v
        assert replayed == states[b], (a, b)
    assert times[-1] == table.last_commit(table.meta())


def test_diff_edges(spark):
    table = new_table(spark)
    table.write("insert", frame(spark, [(1, "a"), (2, "a")]), ts=10)
    table.write("delete", frame(spark, [(1, "a")]).select("k"), ts=20)
    table.write("insert", frame(spark, [(1, "b"), (3, "c")]), ts=30)
    table.write("delete", frame(spark, [(3, "a"), (2, "a")]).select("k"), ts=40)
    got = {r["k"]: (r["v"], r["is_deleted"]) for r in table.diff(10, 40).collect()}
    # 1 went and came back, 2 went, 3 came and went.
    assert got == {1: ("b", False), 2: ("a", True)}
    assert table.diff(40, 40).isEmpty()


def test_times_out_of_range(spark):
    table = new_table(spark)
    table.write("insert", frame(spark, [(1, "a")]), ts=10)
    table.write("upsert", frame(spark, [(1, "b")]), ts=20)
    with pytest.raises(ValueError):
        table.write("upsert", frame(spark, [(1, "c")]), ts=20)
    with pytest.raises(ValueError):
        table.as_of(kt.now_micros() + 10**12)
    with pytest.raises(ValueError):
        table.at_least(30)
    table.compact(keep_history=False)
    assert rows_of(table.as_of(20)) == {1: "b"}
    with pytest.raises(ValueError):
        table.as_of(10)


def test_failed_batch_is_invisible(spark):
    table = new_table(spark)
    table.write("insert", frame(spark, [(1, "a")]), ts=10)
    with pytest.raises(RuntimeError):
        with table.batch() as staged:
            staged.write("upsert", frame(spark, [(1, "b"), (2, "b")]))
            raise RuntimeError("stop")
    assert rows_of(table.latest()) == {1: "a"}
    with table.batch(ts=20) as staged:
        staged.write("insert", frame(spark, [(2, "b")]))
        staged.write("insert_ignore", frame(spark, [(2, "c"), (3, "c")]))
        staged.write("delete", frame(spark, [(1, "")]).select("k"))
    assert rows_of(table.latest()) == {2: "b", 3: "c"}
    assert rows_of(table.as_of(19)) == {1: "a"}


def test_replayed_source_batch_changes_nothing(spark):
    table = new_table(spark)
    table.write("upsert", frame(spark, [(1, "a")]), source=("s", 0))
    table.write("upsert", frame(spark, [(1, "b")]), source=("s", 1))
    version = table.meta()["version"]
    table.write("upsert", frame(spark, [(1, "a")]), source=("s", 0))
    assert table.meta()["version"] == version
    assert rows_of(table.latest()) == {1: "b"}


def test_second_writer_of_a_version_fails(spark):
    table = new_table(spark)
    meta = table.meta()
    table.describe(comment="first")
    with pytest.raises(Exception, match="(?i)exists"):
        table._change(meta, comment="second")


def test_columns_come_and_go(spark):
    table = new_table(spark, required=["v"], defaults={"v": "none"}, comment="c")
    table.write("insert", frame(spark, [(1, "a")]), ts=10)
    table.add_column("n", IntegerType(), default=7)
    table.rename_column("v", "w")
    table.write("insert", spark.createDataFrame([(2,)], "k INT"), ts=20)
    table.drop_column("w")
    table.add_column("w", StringType())
    table.alter_column("n", default=None)
    table.write("insert", spark.createDataFrame([(3,)], "k INT"), ts=30)
    got = {r["k"]: (r["n"], r["w"]) for r in table.latest().collect()}
    assert got == {1: (7, None), 2: (7, None), 3: (None, None)}
    table.compact()
    assert {r["k"]: (r["n"], r["w"]) for r in table.latest().collect()} == got
    with pytest.raises(ValueError):
        table.drop_column("k")
    with pytest.raises(ValueError):
        table.add_column("x", StringType(), required=True)


def test_drift_adds_nullable_columns(spark):
    table = new_table(spark)
    table.write("insert", frame(spark, [(1, "a")]))
    more = spark.createDataFrame([(2, "b", 5)], "k INT, v STRING, extra INT")
    table.write("upsert", more)
    assert table.latest().columns == ["k", "v"]
    table.write("upsert", more, drift=True)
    got = {r["k"]: r["extra"] for r in table.latest().collect()}
    assert got == {1: None, 2: 5}


def test_where_operations(spark):
    table = new_table(spark)
    table.write("insert", frame(spark, [(1, "a"), (2, "b"), (3, None)]), ts=10)
    table.update_where(F.col("v") == "b", {"v": F.lit("z")}, ts=20)
    table.delete_where(F.col("v") == "a", ts=30)
    assert rows_of(table.latest()) == {2: "z", 3: None}
    assert rows_of(table.as_of(20)) == {1: "a", 2: "z", 3: None}


def test_key_columns_first(spark):
    schema = StructType.fromDDL("v STRING, k INT")
    table = KeyedTable.create(spark, new_path(spark, "t"), schema, ["k"])
    assert table.schema.names == ["k", "v"]
    assert not table.schema["k"].nullable
    assert table.exists()
    assert not KeyedTable(spark, new_path(spark, "none")).exists()


def test_partitioned_table(spark):
    spec = PartitionSpec(
        hash=(HashLevel(("k",), 2),),
        range_column="d",
        bounds=(Bound("2020-01-01", "2021-01-01"), Bound("2021-01-01", "2022-01-01")),
    )
    df = spark.range(200).selectExpr(
        "CAST(id AS INT) k", "date_add(DATE '2020-01-01', CAST(id * 10 AS INT)) d", "'v' v"
    )
    path = new_path(spark, "t")
    table = KeyedTable.create(spark, path, df.schema, ["k", "d"], partition=spec)
    refused = table.errors("insert", df)
    assert {r["error"] for r in refused.collect()} == {"NOT_COVERED"}
    table.write("insert", df, ts=10)
    stored = df.filter("d < DATE '2022-01-01'")
    assert refused.count() + stored.count() == 200
    assert table.latest().exceptAll(stored).isEmpty()
    table.compact()
    table.write("upsert", df.filter("k = 5").withColumn("v", F.lit("w")), ts=20)
    hit = table.scan({"k": 5}, lower="2020-01-01", upper="2021-01-01")
    assert [(r["k"], r["v"]) for r in hit.collect()] == [(5, "w")]
    plan = hit._jdf.queryExecution().executedPlan().toString()
    folders = [x.split("]")[0] for x in plan.split("PartitionFilters: [")[1:]]
    assert any("_range" in f and "_bucket0" in f for f in folders)
    assert table.scan({"k": 5, "d": "2021-06-01"}).isEmpty()
    assert table.scan({}, lower="2021-01-01").count() == stored.filter("d >= DATE '2021-01-01'").count()
    table.drop_range("d", "2020-01-01", "2021-01-01")
    assert table.latest().filter("d < DATE '2021-01-01'").isEmpty()
    table.write("insert_ignore", df, ts=30)
    assert table.latest().filter("d < DATE '2021-01-01'").isEmpty()
    table.add_range(Bound("2020-01-01", "2020-06-01"))
    table.write("insert_ignore", df, ts=40)
    table.compact()
    want = df.filter("d < DATE '2022-01-01' AND (d < DATE '2020-06-01' OR d >= DATE '2021-01-01')")
    assert table.latest().select("k").exceptAll(want.select("k")).isEmpty()
    assert table.latest().count() == want.count()
    with pytest.raises(ValueError):
        KeyedTable.create(spark, new_path(spark, "t"), df.schema, ["k"], partition=spec)


def test_write_reports_what_it_refused(spark, tmp_path):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    table = KeyedTable.create_as(first, str(tmp_path / "t"), ["k"])
    more = spark.createDataFrame([(2, "c", 1), (3, "d", 2), (3, "e", 3), (None, "f", 4)], "k int, v string, n int")
    written = table.write_reported("insert", more, seq="n")
    assert sorted(map(tuple, table.latest().collect())) == [(1, "a"), (2, "b"), (3, "d")]
    # Read after the write, and again after another one.
    table.write("delete", spark.createDataFrame([(2,), (3,)], "k int"))
    got = {(r["k"], r["n"]): r["error"] for r in written.refused.collect()}
    assert got == {(2, 1): "ALREADY_PRESENT", (3, 3): "ALREADY_PRESENT", (None, 4): "NULL_KEY"}
    assert table.last_commit(table.meta()) > written.ts


def test_the_newest_of_many_versions_is_read(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), spark.createDataFrame([], "k int").schema, ["k"])
    for k in range(12):
        table.write("insert", spark.createDataFrame([(k,)], "k int"))
    assert table.meta()["version"] == 12
    assert table.latest().count() == 12


def test_a_reported_write_counts_and_needs_its_batch_once(spark, tmp_path):
    spec = PartitionSpec(range_column="k", bounds=(Bound(0, 10),))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    table = KeyedTable.create_as(rows, str(tmp_path / "t"), ["k"], partition=spec)
    more = spark.createDataFrame([(2, "x", 1), (3, "c", 2), (3, "d", 3), (50, "e", 4), (None, "f", 5)], "k INT, v STRING, n INT")
    done = table.write_reported("insert", more.withColumn("v", F.concat("v", F.uuid().substr(1, 0))), seq="n")
    assert done.counts == {"incoming": 5, "applied": 1, "outside": 2}
    refused = sorted((r["n"], r["error"]) for r in done.refused.collect())
    assert [n for n, _ in refused] == [1, 3, 4, 5]
    assert dict(refused)[4] == "NOT_COVERED"
    assert {r["k"]: r["v"] for r in table.latest().collect()} == {1: "a", 2: "b", 3: "c"}


def test_a_scan_opens_only_the_folders_of_its_partition(spark, tmp_path):
    spec = PartitionSpec(hash=(HashLevel(("k",), 4),), range_column="d", bounds=(Bound(0, 50), Bound(50, 100)))
    rows = spark.range(100).selectExpr("CAST(id % 20 AS INT) k", "CAST(id AS INT) d", "CAST(id AS STRING) v")
    table = KeyedTable.create_as(rows, str(tmp_path / "t"), ["k", "d"], partition=spec)
    table.write("upsert", rows.filter("d % 3 = 0").selectExpr("k", "d", "'new' v"))
    table.write("delete", rows.filter("d % 7 = 1").select("k", "d"))
    want = {(r["k"], r["d"]): r["v"] for r in table.latest().filter("k = 5 AND d >= 50").collect()}
    assert want
    bucket = table.scan({"k": 5}, lower=50)
    # Everything outside one range folder is spoilt; what is left is enough for the scan.
    spoilt = 0
    for file in tmp_path.glob("t/log/**/*.parquet"):
        if "_range=1" not in str(file):
            file.write_bytes(b"spoilt")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
            spoilt += 1
    assert spoilt
    assert {(r["k"], r["d"]): r["v"] for r in table.scan({"k": 5}, lower=50).collect()} == want
    assert {(r["k"], r["d"]): r["v"] for r in bucket.collect()} == want
    with pytest.raises(Exception):
        table.scan({"k": 5}).collect()


def test_scans_stay_right_after_ranges_change(spark, tmp_path):
    spec = PartitionSpec(range_column="k", bounds=(Bound(0, 10), Bound(10, 20), Bound(20, 30)))
    rows = spark.range(30).selectExpr("CAST(id AS INT) k", "'a' v")
    table = KeyedTable.create_as(rows, str(tmp_path / "t"), ["k"], partition=spec)
    table.drop_range("k", 0, 10)
    table.add_range(Bound(30, 40))
    table.write("upsert", spark.range(25, 35).selectExpr("CAST(id AS INT) k", "'b' v"))
    got = {r["k"]: r["v"] for r in table.scan({}, lower=15, upper=33).collect()}
    assert got == {**{k: "a" for k in range(15, 25)}, **{k: "b" for k in range(25, 33)}}


def test_documents_grow_in_proportion_to_the_commits(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), StructType().add("k", IntegerType()), ["k"])
    meta, written = table.meta(), []
    table._publish = written.append
    for i in range(1, 1001):
        commit = {"ts": i, "seq": 0, "kind": "log", "path": f"log/{i}"}
        meta = table._change(meta, commits=[*meta["commits"], commit])
    entries = [len(d.get("added", d.get("commits"))) for d in written]
    assert len(written) == 1000 and sum(entries) < 8 * 1000
    # The last document and those since the last full list give all commits.
    documents = {0: {"version": 0, "commits": []}} | {d["version"]: d for d in written}
    table._documents = lambda first, last: [documents[v] for v in range(first, last + 1)]
    for newest in (1, 16, 17, 40, 333, 1000):
        head, commits = documents[newest], []
        for d in table._documents(head["listed"][0] if "added" in head else newest, newest):
            commits = commits + d["added"] if "added" in d else d["commits"]
        assert [c["ts"] for c in commits] == list(range(1, newest + 1)), newest


def test_many_versions_are_read_back(spark, tmp_path):
    table = KeyedTable.create(spark, str(tmp_path / "t"), StructType().add("k", IntegerType()).add("v", StringType()), ["k"])
    for i in range(20):
        table.write("upsert", spark.createDataFrame([(i % 7, f"v{i}")], "k INT, v STRING"), ts=10 + i)
    assert len(KeyedTable(spark, table.path).meta()["commits"]) == 20
    assert {r["k"]: r["v"] for r in table.latest().collect()} == {i % 7: f"v{i}" for i in range(20)}
    assert {r["k"]: r["v"] for r in table.as_of(14).collect()} == {i: f"v{i}" for i in range(5)}


def test_an_update_that_empties_a_required_column_is_refused_whole(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (3, "c", 3)], "k INT, v STRING, n INT")
    table = KeyedTable.create_as(rows, str(tmp_path / "t"), ["k"], required=["v"])
    before = table.last_commit(table.meta())
    with pytest.raises(ValueError, match="required"):
        table.update_where(F.col("k") > 1, {"v": F.when(F.col("k") == 2, "x")})
    assert table.last_commit(table.meta()) == before
    table.update_where(F.col("k") == 2, {"v": F.when(F.col("k") == 2, "x"), "n": F.lit(None).cast("int")})
    assert {tuple(r) for r in table.latest().collect()} == {(1, "a", 1), (2, "x", None), (3, "c", 3)}
