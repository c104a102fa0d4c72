"""Chain choice, restores and cleaning."""

import json
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from olapkit.registry import QUERIES
from olapkit.sources import backups
from olapkit.sources.backups import MANIFEST
from olapkit.sources.keyed_table import KeyedTable
from olapkit.workspace import new_path


def manifests(spark, *rows):
    """(from, to) pairs of one table; ids are their positions."""
    return spark.createDataFrame(
        [("t", "t", str(i), a, b) for i, (a, b) in enumerate(rows)], MANIFEST
    )


def path_of(spark, *rows, until=None):
    steps = backups.restore_steps(manifests(spark, *rows), until).orderBy("weight").collect()
    assert [r["weight"] for r in steps] == list(range(len(steps)))
    return [r["backup_id"] for r in steps]


def base_of(spark, *rows):
    return backups.chain_bases(manifests(spark, *rows)).first()["base_id"]


def test_simple_chain(spark):
    rows = [(0, 1), (1, 2), (2, 3)]
    assert path_of(spark, *rows) == ["0", "1", "2"]
    assert base_of(spark, *rows) == "2"
    assert path_of(spark, *rows, until=2) == ["0", "1"]


def test_forked_increments(spark):
    # 1 -> 2 -> 5 and 1 -> 4 -> 5: both end at 5, the first listed of equal weight is kept.
    rows = [(0, 1), (1, 2), (1, 4), (4, 5)]
    assert path_of(spark, *rows) == ["0", "2", "3"]


def test_lightest_path_wins(spark):
    rows = [(0, 1), (1, 2), (2, 3), (1, 3)]
    assert path_of(spark, *rows) == ["0", "3"]


def test_several_fulls(spark):
    # A full that ends with the longest chain restores alone; the next increment builds on it.
    rows = [(0, 1), (1, 2), (2, 4), (0, 4)]
    assert path_of(spark, *rows) == ["3"]
    assert base_of(spark, *rows) == "3"
    # While the newer full is older than the chain's end, restore follows the chain.
    rows = [(0, 1), (1, 3), (0, 2)]
    assert path_of(spark, *rows) == ["0", "1"]
    assert base_of(spark, *rows) == "2"


def test_increment_without_full(spark):
    assert backups.restore_steps(manifests(spark, (5, 6))).isEmpty()
    # Nor does a later increment on it lead anywhere, or a chain whose middle is lost.
    assert path_of(spark, (0, 1), (5, 6), (6, 7), (1, 2)) == ["0", "3"]
    assert path_of(spark, (0, 1), (1, 2), (3, 4), (4, 5)) == ["0", "1"]


def test_a_later_found_lighter_way_is_taken(spark):
    # The point 9 is reached from 5 by one more step, or from 3 by two; 5 itself is far from the full.
    rows = [(0, 1), (1, 2), (2, 3), (3, 4), (4, 5), (5, 9), (2, 8), (8, 9), (9, 10)]
    assert path_of(spark, *rows) == ["0", "1", "6", "7", "8"]


def test_a_chain_of_500_takes_no_job_per_link(spark):
    rows = [(0, 1), *[(i, i + 1) for i in range(1, 501)], (250, 251), (0, 2)]
    frame = manifests(spark, *rows)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "a chain of 500")
    steps = [r["backup_id"] for r in backups.restore_steps(frame).orderBy("weight").collect()]
    base = backups.chain_bases(frame).first()
    spark.sparkContext.setJobGroup("other", "other")
    # The second full backup, at 2, starts the lighter chain.
    assert steps == ["502", *[str(i) for i in range(2, 501)]]
    assert (base["base_id"], base["weight"], base["root_id"]) == ("500", 499, "502")
    assert len(jobs.getJobIdsForGroup("chain")) < 300


def test_stored_links_are_used_and_lost_predecessors_seen(spark):
    rows = [("t", "t", "a", 0, 1, None, "a", 1, 0), ("t", "t", "b", 1, 2, "a", "a", 1, 1), ("t", "t", "c", 2, 3, "b", "a", 1, 2)]
    links = ", ".join(f"{n} {k}" for n, k in backups.LINKS.items())
    frame = spark.createDataFrame(rows, f"{MANIFEST}, {links}")
    assert [r["backup_id"] for r in backups.restore_steps(frame).orderBy("weight").collect()] == ["a", "b", "c"]
    broken = frame.filter("backup_id <> 'b'")
    assert [r["backup_id"] for r in backups.restore_steps(broken).collect()] == ["a"]


def test_expired_paths(spark):
    # Old full with two increments, one branch that goes on; a new full with an increment.
    rows = [(0, 10), (10, 20), (20, 30), (10, 25), (0, 100), (100, 110)]
    got = backups.backup_expired(manifests(spark, *rows), now=120, age=50)
    assert {r["backup_id"] for r in got.collect()} == {"0", "1", "2", "3"}
    # Nothing on the restore path goes, however old.
    got = backups.backup_expired(manifests(spark, *rows[:4]), now=1000, age=1)
    assert {r["backup_id"] for r in got.collect()} == {"3"}


def test_links_are_found_once_and_stored(spark, monkeypatch):
    rows = manifests(spark, (0, 10), (10, 20), (20, 30), (10, 25))
    plan = backups.linked(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "FileScan" in plan
    found, anew = [], backups._linked_anew
    monkeypatch.setattr(backups, "_linked_anew", lambda known: found.append(1) or anew(known))
    kinds = QUERIES["backup_list"](spark, "/root/testdata/sf0.001").select("list").distinct().collect()
    assert {r["list"] for r in kinds} == {"all", "latest", "sequence"} and found == [1]


def test_only_those_on_their_way_look_further(spark, monkeypatch):
    """Of a chain of five and four lone full backups, no round takes the full ones along."""
    joined, join = [], DataFrame.join

    def seen(self, other, on=None, how=None):
        if "_root_to" in other.columns:
            joined.append(self.count())
        return join(self, other, on, how)

    chain = [(0, 1), *[(i, i + 1) for i in range(1, 5)], *[(0, 100 + i) for i in range(4)]]
    monkeypatch.setattr(DataFrame, "join", seen)
    links = backups.linked(manifests(spark, *chain))
    assert joined == [4, 3, 1][: len(joined)] and joined
    assert sorted(r["weight"] for r in links.collect()) == [0, 0, 0, 0, 0, 1, 2, 3, 4]


def table(spark, name):
    df = spark.createDataFrame([(k, f"v{k}") for k in range(10)], "k INT, v STRING")
    return KeyedTable.create_as(df, new_path(spark, name), ["k"], ts=10, name=name)


def rows_of(df):
    return {r["k"]: r["v"] for r in df.collect()}


def test_restore_and_clean_on_disk(spark):
    root, t = new_path(spark, "backups"), table(spark, "cleaned")
    with pytest.raises(ValueError):
        backups.restore(spark, root, "cleaned")
    first = backups.backup(t, root)
    t.write("delete", spark.createDataFrame([(0,), (1,)], "k INT"), ts=20)
    second = backups.backup(t, root)
    assert (first["from_ts"], second["from_ts"], second["to_ts"]) == (0, 10, 20)
    t.write("upsert", spark.createDataFrame([(1, "back"), (2, "new")], "k INT, v STRING"), ts=30)
    backups.backup(t, root, full=True)
    assert rows_of(backups.restore(spark, root, "cleaned")) == rows_of(t.latest())
    assert rows_of(backups.restore(spark, root, "cleaned", until=25)) == rows_of(t.as_of(20))
    found = backups.manifests(spark, root)
    old = backups.backup_expired(found, now=1000, age=10)
    expired = found.join(old.select("backup_id"), "backup_id", "left_semi")
    assert len(backups.delete_backups(spark, expired, dry_run=True)) == 2
    assert backups.manifests(spark, root).count() == 3
    backups.delete_backups(spark, expired)
    left = backups.manifests(spark, root)
    assert [r["from_ts"] for r in left.collect()] == [0]
    assert rows_of(backups.restore(spark, root, "cleaned")) == rows_of(t.latest())


def test_forced_start(spark):
    root, t = new_path(spark, "backups"), table(spark, "forced")
    t.write("upsert", spark.createDataFrame([(1, "x")], "k INT, v STRING"), ts=20)
    made = backups.backup(t, root, from_ts=10)
    assert made["from_ts"] == 10
    data = spark.read.parquet(f"{root}/{made['table_id']}/{made['backup_id']}/data")
    assert [(r["k"], r["v"], r["row_action"]) for r in data.collect()] == [(1, "x", 0)]


def test_action_column_avoids_names():
    assert backups.action_column(["k"]) == "row_action"
    assert backups.action_column(["row_action", "row_action_"]) == "row_action__"


def test_names(spark):
    names = ["ext::db.t", "ext::t", "db.t", "t", "a.b.c"]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")

    def renamed(**options):
        return [r[0] for r in df.select(backups.restore_name(F.col("n"), "ext::", **options)).collect()]

    assert renamed() == names
    assert renamed(drop_prefix=True, suffix="_r") == ["db.t_r", "t_r", "db.t_r", "t_r", "a.b.c_r"]
    assert renamed(database="new") == ["ext::new.t", "ext::new.t", "new.t", "new.t", "new.b.c"]


def test_a_long_chain_is_restored_in_two_scans(spark):
    root, t = new_path(spark, "backups"), table(spark, "long")
    backups.backup(t, root)
    for i in range(1, 6):
        t.write("upsert", spark.createDataFrame([(i, f"n{i}"), (20 + i, "new")], "k INT, v STRING"), ts=10 + i)
        made = backups.backup(t, root)
        assert (made["weight"], made["from_ts"]) == (i, 9 + i)
    restored = backups.restore(spark, root, "long")
    assert rows_of(restored) == rows_of(t.latest())
    plan = restored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 3, plan  # the full backup, and the increments for both sides of the merge


def test_several_tables_at_once(spark):
    root = new_path(spark, "backups")
    tables = [table(spark, f"several{i}") for i in range(3)]
    missing = KeyedTable(spark, new_path(spark, "missing"))
    got = backups.backup_many([tables[0], missing, *tables[1:]], root, parallel=2)
    assert [s for _, s in got] == ["ok", "AnalysisException", "ok", "ok"]
    assert [p for p, _ in got] == [tables[0].path, missing.path, tables[1].path, tables[2].path]
    with pytest.raises(Exception):
        backups.backup_many([missing, tables[0]], root, fail_fast=True)
    targets = {n: new_path(spark, n) for n in ("several0", "nobody", "several2")}
    assert backups.restore_many(spark, root, targets) == [("several0", "ok"), ("nobody", "ValueError"), ("several2", "ok")]
    assert rows_of(KeyedTable(spark, targets["several2"]).latest()) == rows_of(tables[2].latest())


def test_jobs_of_several_tables_overlap(spark, tmp_path):
    """From the event log of a session of its own: jobs of different tables run at the same time."""
    code = f"""
import sys
sys.path.insert(0, {str(Path(__file__).parent.parent)!r})
from pyspark.sql import SparkSession
SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.eventLog.enabled", "true") \\
    .config("spark.eventLog.dir", "file://{tmp_path}").config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false").getOrCreate()
from olapkit.workspace import local_session, new_path
from olapkit.sources import backups
from olapkit.sources.keyed_table import KeyedTable
spark = local_session("4")
tables = [KeyedTable.create_as(spark.range(200000).selectExpr("id", "uuid() v"), new_path(spark, n), ["id"], name=n) for n in "abcd"]
assert [s for _, s in backups.backup_many(tables, new_path(spark, "backups"), parallel=4)] == ["ok"] * 4
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=240, capture_output=True)
    (log,) = [p for p in tmp_path.iterdir() if p.is_file() and not p.name.startswith(".")]
    events = [json.loads(line) for line in log.read_text().splitlines()]
    named, end = {}, {}
    for e in events:
        if e["Event"] == "SparkListenerJobStart":
            named[e["Job ID"]] = (e.get("Properties", {}).get("spark.scheduler.pool"), e["Submission Time"])
        elif e["Event"] == "SparkListenerJobEnd":
            end[e["Job ID"]] = e["Completion Time"]
    spans = [(pool, start, end[i]) for i, (pool, start) in named.items() if pool]
    assert len({pool for pool, _, _ in spans}) == 4
    assert any(p != q and a < d and c < b for p, a, b in spans for q, c, d in spans)
