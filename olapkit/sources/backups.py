"""Full and incremental backups of keyed tables, and the choice of a chain to restore.

A backup is a folder ``<root>/<table id>/<end time>-<id>`` with Parquet rows under
``data`` and one JSON document under ``metadata``, written last: a backup without
metadata does not exist. A full backup starts at time 0; an increment starts where
its predecessor ended and carries ``row_action`` (0 or null put, 1 delete).

Every backup's document names the chain it was made on: its predecessor, the full backup at the root,
and its weight, the number of increments since. So the base of the next increment, the newest
state to restore and the list of latest backups are aggregates over the documents.

The chain functions work on a frame of manifest rows for any number of tables:
``table_name, table_id, backup_id, from_ts, to_ts``, and the links if they are known. Links that are not
known, and the backups on a path, are found by doubling: a round doubles the steps it looks back,
so a chain of 500 increments takes nine.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, StructField, StructType

from olapkit.operators import rowops
from olapkit.operators.partitions import Bound, PartitionSpec
from olapkit.operators.rowops import PUT, REMOVE
from olapkit.sources.keyed_table import KeyedTable, column_type
from olapkit.workspace import materialize

ACTION = "row_action"
MANIFEST = "table_name STRING, table_id STRING, backup_id STRING, from_ts BIGINT, to_ts BIGINT"
#: Predecessor, full backup, its end, increments since; a root of "" means that the backup is on no chain.
LINKS = {"prev_id": "STRING", "root_id": "STRING", "root_to": "BIGINT", "weight": "INT"}


def action_column(columns: Sequence[str]) -> str:
    """The action column's name, made free by underscores where the table has one like it."""
    name = ACTION
    while name in columns:
        name += "_"
    return name


# Chains


def linked(manifests: DataFrame) -> DataFrame:
    """The backups that lead back to a full one, each with its links.

    Stored links are taken as they are if every backup has them and none lost its predecessor. Else all are found
    anew: the predecessor of an increment is the backup that ends where it starts; of several the
    one with the fewest increments, then the newest full backup, then the least id.
    """
    for name, kind in LINKS.items():
        if name not in manifests.columns:
            manifests = manifests.withColumn(name, F.lit(None).cast(kind))
    known = materialize(manifests, "manifests")
    ids = known.select("table_id", F.col("backup_id").alias("prev_id"))
    lost = known.filter(F.col("prev_id").isNotNull()).join(ids, ["table_id", "prev_id"], "left_anti")
    unlinked = known.filter(F.col("root_id").isNull())
    if unlinked.isEmpty() and lost.isEmpty():
        return known.filter(F.col("root_id") != "")
    return _linked_anew(known.drop(*LINKS))


def _linked_anew(known: DataFrame) -> DataFrame:
    """Links from the times alone. An increment ends after it starts, so no chain returns to an earlier point."""
    full = F.col("from_ts") == 0
    ends = known.select("table_id", F.col("to_ts").alias("from_ts"), F.col("backup_id").alias("prev_id"))
    increments = known.filter(~full & (F.col("to_ts") > F.col("from_ts"))).select("table_id", "backup_id", "from_ts")
    candidates = materialize(increments.join(ends, ["table_id", "from_ts"]).drop("from_ts"), "predecessors")
    sizes = known.select("table_id", F.col("backup_id").alias("prev_id"), full.alias("_full"), F.col("from_ts").alias("_start"))
    first = F.struct(~F.col("_full"), F.col("_start"), F.col("prev_id"))
    picked = (
        candidates.join(sizes, ["table_id", "prev_id"])
        .groupBy("table_id", "backup_id")
        .agg(F.min_by("prev_id", first).alias("prev_id"), F.count(F.lit(1)).alias("_n"))
    )
    picked = materialize(picked, "picked")
    # Only where there is a choice can a lighter predecessor be found.
    contested = picked.filter(F.col("_n") > 1).select("table_id", "backup_id")
    settled = contested.isEmpty()
    rivals = None if settled else materialize(candidates.join(contested, ["table_id", "backup_id"], "left_semi"), "rivals")
    chosen = picked.drop("_n")
    while True:
        found = _weighed(known.filter(full), chosen)
        if settled:
            break
        # Is a lighter predecessor known now? Weights only fall, so this ends.
        weights = found.select("table_id", F.col("backup_id").alias("prev_id"), "weight", "root_to", "root_id")
        light = F.struct("weight", (-F.col("root_to")).alias("newest"), "prev_id")
        better = rivals.join(weights, ["table_id", "prev_id"]).groupBy("table_id", "backup_id")
        better = better.agg(F.min_by("prev_id", light).alias("_better"), F.min("weight").alias("_least"))
        better = materialize(better, "better")
        now = chosen.join(better, ["table_id", "backup_id"]).join(
            weights.select("table_id", "prev_id", "weight"), ["table_id", "prev_id"], "left"
        )
        if now.filter(F.col("weight").isNull() | (F.col("_least") < F.col("weight"))).isEmpty():
            break
        chosen = chosen.join(better, ["table_id", "backup_id"], "left").select(
            "table_id", "backup_id", F.coalesce("_better", "prev_id").alias("prev_id")
        )
        chosen = materialize(chosen, "chosen")
    links = known.join(found, ["table_id", "backup_id"]).join(chosen, ["table_id", "backup_id"], "left")
    return materialize(links, "links")


def _weighed(fulls: DataFrame, chosen: DataFrame) -> DataFrame:
    """(table_id, backup_id, root_id, weight, root_to) of the backups whose predecessors lead to a full one."""
    root = fulls.select(
        "table_id",
        "backup_id",
        F.col("backup_id").alias("up"),
        F.lit(0).alias("weight"),
        F.col("to_ts").alias("root_to"),
        F.lit(True).alias("done"),
    )
    increment = chosen.select(
        "table_id",
        "backup_id",
        F.col("prev_id").alias("up"),
        F.lit(1).alias("weight"),
        F.lit(None).cast("long").alias("root_to"),
        F.lit(False).alias("done"),
    )
    state = root.unionByName(increment)
    while True:
        state = materialize(state, "chains")
        ended, onward = state.filter("done"), state.filter(~F.col("done"))
        if onward.isEmpty():
            return state.select("table_id", "backup_id", F.col("up").alias("root_id"), "weight", "root_to")
        # Who has not come to a full backup looks as far back as the one it looks back to; who looks at nothing
        # is on no chain.
        further = state.select(
            "table_id",
            F.col("backup_id").alias("up"),
            F.col("up").alias("_up"),
            F.col("weight").alias("_weight"),
            F.col("root_to").alias("_root_to"),
            F.col("done").alias("_done"),
        )
        onward = onward.join(further, ["table_id", "up"]).select(
            "table_id",
            "backup_id",
            F.col("_up").alias("up"),
            (F.col("weight") + F.col("_weight")).alias("weight"),
            F.col("_root_to").alias("root_to"),
            F.col("_done").alias("done"),
        )
        state = ended.unionByName(onward)


def _jumps(links: DataFrame) -> list[DataFrame]:
    """(table_id, backup_id, up): the backups 1, 2, 4, ... steps before each, as far as the longest chain goes."""
    longest = links.agg(F.max("weight")).first()[0] or 0
    prev = links.filter(F.col("prev_id").isNotNull()).select("table_id", "backup_id", F.col("prev_id").alias("up"))
    jumps = [prev] if longest else []
    while 1 << len(jumps) <= longest:
        step = jumps[-1]
        onward = step.select("table_id", F.col("backup_id").alias("up"), F.col("up").alias("_up"))
        further = step.join(onward, ["table_id", "up"]).select("table_id", "backup_id", F.col("_up").alias("up"))
        jumps.append(materialize(further, "jumps"))
    return jumps


def path_to(links: DataFrame, ends: DataFrame, jumps: Sequence[DataFrame] | None = None) -> DataFrame:
    """(table_id, backup_id) of the backups on the paths to some ends: themselves and all before them.

    ``jumps`` are those of the links, if they are known already.
    """
    marked = materialize(ends.select("table_id", "backup_id"), "ends")
    for jump in reversed(_jumps(links) if jumps is None else jumps):
        more = jump.join(marked, ["table_id", "backup_id"], "left_semi").select("table_id", F.col("up").alias("backup_id"))
        marked = materialize(marked.unionByName(more).distinct(), "marked")
    return marked


def _best(links: DataFrame) -> DataFrame:
    """Per table the backup that ends last; among those the lightest, then the newest full."""
    order = F.struct(
        F.col("to_ts"), (-F.col("weight")).alias("w"), F.col("root_to"), F.col("root_id"), F.col("backup_id")
    )
    best = F.max_by(F.struct("backup_id", "root_id", "root_to", "to_ts", "weight"), order).alias("best")
    return links.groupBy("table_id").agg(best).select("table_id", "best.*")


def restore_steps(manifests: DataFrame, until: int | None = None) -> DataFrame:
    """The backups to restore of each table, with their links; ``weight`` numbers them from 0.

    ``until`` looks back in time.
    """
    return _steps(linked(manifests if until is None else manifests.filter(F.col("to_ts") <= until)))


def _steps(links: DataFrame) -> DataFrame:
    return links.join(path_to(links, _best(links)), ["table_id", "backup_id"], "left_semi")


def chain_bases(manifests: DataFrame) -> DataFrame:
    """Per table the backup the next increment continues: on the newest full, the latest
    increment, by the fewest steps."""
    links = linked(manifests)
    newest = (
        links.filter(F.col("weight") == 0)
        .groupBy("table_id")
        .agg(F.max_by("root_id", F.struct("root_to", "root_id")).alias("root_id"))
    )
    best = _best(links.join(newest, ["table_id", "root_id"], "left_semi"))
    return best.select("table_id", "root_id", F.col("backup_id").alias("base_id"), "root_to", "to_ts", "weight")


def backup_list(manifests: DataFrame, kind: str = "all", links: DataFrame | None = None) -> DataFrame:
    """Backups as (name, id, end time, from, to, type): ``all``, the ``latest`` of each
    table, or the restore ``sequence``. ``links`` are the manifests' own, as ``linked`` gives them, for several lists."""
    rows = manifests
    if kind == "latest":
        best = _best(linked(manifests) if links is None else links)
        rows = rows.join(best, ["table_id", "backup_id"], "left_semi")
    elif kind == "sequence":
        steps = _steps(linked(manifests) if links is None else links)
        rows = rows.join(steps, ["table_id", "backup_id"], "left_semi")
    elif kind != "all":
        raise ValueError("kind is all, latest or sequence")
    end = F.date_format(F.timestamp_micros("to_ts"), "yyyy-MM-dd'T'HH:mm:ss.SSSZ")
    return rows.select(
        "table_name",
        "table_id",
        end.alias("end_time"),
        "from_ts",
        "to_ts",
        F.when(F.col("from_ts") == 0, "full").otherwise("incremental").alias("type"),
    ).orderBy("table_name", "to_ts")


def backup_expired(manifests: DataFrame, now: int, age: int) -> DataFrame:
    """Backups on a path whose newest backup is older than ``age``, off the restore path."""
    links = linked(manifests)
    onward = links.filter(F.col("from_ts") > 0).select("table_id", F.col("from_ts").alias("to_ts"))
    # Ends of paths that are old, then every backup that leads to one.
    old = links.join(onward, ["table_id", "to_ts"], "left_anti").filter(F.col("to_ts") + age < now)
    jumps = _jumps(links)
    leading = path_to(links, old, jumps)
    needed = path_to(links, _best(links), jumps)
    gone = leading.join(needed, ["table_id", "backup_id"], "left_anti")
    return manifests.join(gone, ["table_id", "backup_id"], "left_semi")


def restore_name(
    name: Column,
    prefix: str,
    drop_prefix: bool = False,
    database: str | None = None,
    suffix: str = "",
) -> Column:
    """Name of the restored table: ``<prefix><database>.<table><suffix>``."""
    has_prefix = name.startswith(prefix)
    bare = F.when(has_prefix, F.substr(name, F.lit(len(prefix) + 1))).otherwise(name)
    dot = F.instr(bare, ".")
    kept = F.when(has_prefix & F.lit(not drop_prefix), prefix).otherwise("")
    home = F.lit(f"{database}.") if database else F.substr(bare, F.lit(1), dot)
    return F.concat(kept, home, F.substr(bare, dot + 1), F.lit(suffix))


# Backups on disk


def _links() -> str:
    return ", ".join(f"{name} {kind}" for name, kind in LINKS.items())


def manifests(spark: SparkSession, root: str) -> DataFrame:
    """One row per finished backup, with its path and its whole document."""
    try:
        documents = spark.read.text(f"{root.rstrip('/')}/*/*/metadata")
    except AnalysisException:
        return spark.createDataFrame([], f"{MANIFEST}, {_links()}, path STRING, document STRING")
    return documents.select(
        F.from_json("value", f"{MANIFEST}, {_links()}").alias("m"),
        F.regexp_extract("_metadata.file_path", "^(.*)/metadata/", 1).alias("path"),
        F.col("value").alias("document"),
    ).select("m.*", "path", "document")


def backup(
    table: KeyedTable,
    root: str,
    to_ts: int | None = None,
    full: bool = False,
    from_ts: int | None = None,
) -> dict:
    """Back up a table: an increment on the current chain where there is one.

    ``full`` forces a full backup, ``from_ts`` an increment from that time.
    """
    meta = table.meta()
    end = to_ts if to_ts is not None else table.last_commit(meta)
    backup_id = f"{end}-{uuid.uuid4().hex[:8]}"
    start, base = 0, None
    if not full and from_ts != 0:
        own = manifests(table.spark, root).filter(F.col("table_id") == meta["id"])
        if from_ts is not None:
            own = own.filter(F.col("to_ts") <= from_ts)
        base = chain_bases(own).first() if not own.isEmpty() else None
        start = from_ts if from_ts is not None else base["to_ts"] if base else 0
        base = base if base and base["to_ts"] == start else None
    if start == 0:
        links = {"prev_id": None, "root_id": backup_id, "root_to": end, "weight": 0}
    elif base is None:
        links = {"prev_id": None, "root_id": "", "root_to": 0, "weight": 0}
    else:
        links = {"prev_id": base["base_id"], "root_id": base["root_id"], "root_to": base["root_to"], "weight": base["weight"] + 1}
    path = f"{root.rstrip('/')}/{meta['id']}/{backup_id}"
    action = action_column([c["name"] for c in meta["columns"]])
    if start == 0:
        rows = table.as_of(end)
    else:
        deleted = F.when(F.col("is_deleted"), REMOVE).otherwise(PUT).cast("byte")
        rows = table.diff(start, end).withColumn(action, deleted).drop("is_deleted")
    rows.write.mode("errorifexists").parquet(f"{path}/data")
    document = {
        "table_name": meta["name"],
        "table_id": meta["id"],
        "backup_id": backup_id,
        "from_ts": start,
        "to_ts": end,
        **links,
        "format": "parquet",
        "keys": meta["keys"],
        "columns": [
            {k: c[k] for k in ("id", "name", "type", "read_default", "nullable", "default", "immutable")}
            for c in meta["columns"]
        ],
        "partition": meta.get("partition"),
        "dropped_ranges": meta.get("dropped_ranges", []),
        "action": action,
    }
    body = table.spark.range(1).select(F.lit(json.dumps(document)).alias("value"))
    body.write.mode("errorifexists").text(f"{path}/metadata")
    return document


@dataclass(frozen=True)
class Done:
    """What came of one table of several: ``ok`` or the name of the error."""

    name: str
    status: str
    result: object = None


def run_many(
    spark: SparkSession, work: Sequence[tuple[str, Callable[[], object]]], parallel: int = 4, fail_fast: bool = False
) -> list[Done]:
    """Named pieces of work as concurrent Spark jobs, at most ``parallel`` at a time; results in the order given.

    Each runs in a scheduler pool of its own, so that under fair scheduling a large table doesn't hold up a small one,
    and shows its name as the job description. One failure stops what has not begun only if asked, and is then raised.
    """

    def run(name: str, body: Callable[[], object]) -> Done:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        spark.sparkContext.setLocalProperty("spark.job.description", name)
        try:
            return Done(name, "ok", body())
        except Exception as error:
            if fail_fast:
                raise
            return Done(name, type(error).__name__)

    if parallel < 1:
        raise ValueError("at least one piece of work runs at a time")
    with ThreadPoolExecutor(parallel) as pool:
        begun = [pool.submit(inheritable_thread_target(spark)(run), name, body) for name, body in work]
        try:
            return [b.result() for b in begun]
        except BaseException:
            for b in begun:
                b.cancel()
            raise


def backup_many(
    tables: Sequence[KeyedTable], root: str, fail_fast: bool = False, parallel: int = 4
) -> list[tuple[str, str]]:
    """(path, ``ok`` or the error) per table, several at a time; one failure stops the rest only if asked."""
    if not tables:
        return []
    work = [(t.path, lambda t=t: backup(t, root)) for t in tables]
    return [(d.name, d.status) for d in run_many(tables[0].spark, work, parallel, fail_fast)]


def restore_many(
    spark: SparkSession,
    root: str,
    names: dict[str, str],
    until: int | None = None,
    fail_fast: bool = False,
    parallel: int = 4,
) -> list[tuple[str, str]]:
    """Restore tables by name into new paths, several at a time: (name, ``ok`` or the error) per table."""
    work = [(n, lambda n=n, p=p: restore_table(spark, root, n, p, until)) for n, p in names.items()]
    return [(d.name, d.status) for d in run_many(spark, work, parallel, fail_fast)]


def _adjusted(spark: SparkSession, rows: Sequence, last: dict) -> DataFrame:
    """Rows of backups with the same columns under the newest column names, matched by column id, with ``_to``, the
    end of their backup. One scan, however many backups."""
    document = json.loads(rows[0]["document"])
    names = {c["id"]: c["name"] for c in document["columns"]}
    action = document["action"]
    fields = [StructField(c["name"], column_type(c["type"])) for c in document["columns"]]
    # A full backup has no action; its rows are put.
    schema = StructType([*fields, StructField(action, ByteType())])
    stored = spark.read.schema(schema).parquet(*[f"{r['path']}/data" for r in rows])
    end = F.regexp_extract("_metadata.file_path", "/([0-9]+)-[0-9a-f]+/data/", 1).cast("long")
    cells = [F.coalesce(F.col(action), F.lit(PUT).cast("byte")).alias("_op"), end.alias("_to")]
    for c in last["columns"]:
        if c["id"] in names:
            cells.append(F.col(f"`{names[c['id']]}`").alias(c["name"]))
        else:
            cells.append(F.lit(c["read_default"]).cast(column_type(c["type"])).alias(c["name"]))
    rows_now = stored.select(*cells)
    for gap in last["dropped_ranges"]:
        # Rows saved before the range was dropped are not brought back.
        inside = Bound(gap["lower"], gap["upper"]).holds(F.col(gap["column"]))
        rows_now = rows_now.filter(~((F.col("_to") <= gap["ts"]) & F.coalesce(inside, F.lit(False))))
    return rows_now


def restore(
    spark: SparkSession, root: str, table_name: str, until: int | None = None
) -> DataFrame:
    """The table as the newest usable chain holds it: the full backup, and one scan of all increments alike.

    A name stands for the tables that have it or once had it, so a chain outlives a rename.
    """
    return _restored(spark, root, table_name, until)[0]


def restore_table(
    spark: SparkSession, root: str, table_name: str, path: str, until: int | None = None
) -> KeyedTable:
    """A new keyed table with the restored rows, key, partitions and column attributes."""
    state, last = _restored(spark, root, table_name, until)
    columns, keys = last["columns"], last["keys"]
    spec = last.get("partition")
    return KeyedTable.create_as(
        state,
        path,
        keys,
        name=last["table_name"],
        required=[c["name"] for c in columns if not c["nullable"] and c["name"] not in keys],
        defaults={c["name"]: c["default"] for c in columns if c["default"] is not None},
        immutable=[c["name"] for c in columns if c["immutable"]],
        partition=PartitionSpec.from_json(spec) if spec else None,
    )


def _restored(spark: SparkSession, root: str, table_name: str, until: int | None) -> tuple[DataFrame, dict]:
    """The restored rows and the document of the chain's last backup."""
    found = manifests(spark, root)
    named = found.filter(F.col("table_name") == table_name).select("table_id").distinct()
    own = found.join(named, "table_id", "left_semi")
    # A name may have stood for several tables: the one with the newest state counts.
    best = _best(linked(own if until is None else own.filter(F.col("to_ts") <= until)))
    end = best.orderBy(F.desc("to_ts"), "table_id").first()
    if end is None:
        raise ValueError(f"no backup of {table_name}")
    steps = restore_steps(own.filter(F.col("table_id") == end["table_id"]), until)
    # The documents of one chain.
    chain = steps.select("weight", "path", "document").orderBy("weight").collect()
    last = json.loads(chain[-1]["document"])
    state = _adjusted(spark, chain[:1], last).drop("_op", "_to")
    if len(chain) == 1:
        return state, last
    alike: dict[str, list] = {}
    for row in chain[1:]:
        document = json.loads(row["document"])
        alike.setdefault(json.dumps([document["columns"], document["action"]]), []).append(row)
    increments = [_adjusted(spark, rows, last) for rows in alike.values()]
    changes = reduce(DataFrame.unionByName, increments)
    return rowops.merge(state, rowops.last_changes(changes, last["keys"], "_to"), last["keys"]), last


def delete_backups(spark: SparkSession, expired: DataFrame, dry_run: bool = False) -> list[str]:
    """Delete the folders of expired backups, newest first, metadata before rows.

    ``expired`` comes from ``backup_expired(manifests(...))``: one row per folder to go.
    """
    paths = [r["path"] for r in expired.orderBy(F.desc("to_ts")).select("path").collect()]
    if not dry_run:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        settings = spark.sparkContext._jsc.hadoopConfiguration()
        for path in paths:
            for folder in (f"{path}/metadata", path):
                target = hadoop(folder)
                target.getFileSystem(settings).delete(target, True)
    return paths
