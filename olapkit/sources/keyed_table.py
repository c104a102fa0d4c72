"""A table with a unique key, kept as Parquet files of changes.

``<path>/meta/version=N`` holds one small JSON document per version: columns, key,
and the commits it adds. Every so often a version lists all commits again, in steps that grow with the
list, so that all documents together grow in proportion to the commits. A version becomes visible when
its document is written, which is the last step of every change. One writer per table at a time: of two that
publish the same version one usually fails, but a plain file store can't promise it.

``<path>/log/...`` holds the rows of a commit: full row images with ``_op`` (0 put,
1 delete), ``_ts`` (commit time in microseconds) and ``_seq``; in a partitioned table a folder for each
partition the commit touches, so that a scan of some keys opens only theirs. ``<path>/snapshot/...``
holds a folded state. Reading joins the newest snapshot with the log after it, so
an upsert of whole rows costs one append and never reads the table.

Columns are stored under ``c<id>``: renames and drops touch only the metadata.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType

from olapkit.operators import partitions, rowops
from olapkit.operators.partitions import Bound, PartitionSpec
from olapkit.operators.rowops import PUT, REMOVE, Rules, merge
from olapkit.workspace import materialize

CONTROL = ["_op", "_ts", "_seq"]
#: A version lists all commits again after so many documents, and after a quarter of the commits it listed last.
LEAST_DELTAS = 16
NOT_COVERED = "NOT_COVERED"


def now_micros() -> int:
    return time.time_ns() // 1000


def _type_json(kind: DataType):
    return kind.jsonValue()


def column_type(value) -> DataType:
    return StructType.fromJson(
        {"type": "struct", "fields": [{"name": "x", "type": value, "nullable": True, "metadata": {}}]}
    )["x"].dataType


@dataclass(frozen=True)
class Written:
    """Commit time of a write, (keys, seq if one was named, error) of each row it refused, and its counts.

    ``incoming`` rows came, ``applied`` took effect, ``outside`` belong to no partition.
    """

    ts: int
    refused: DataFrame
    counts: Mapping[str, int]


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    # Metadata

    @classmethod
    def create(
        cls,
        spark: SparkSession,
        path: str,
        schema: StructType,
        keys: Sequence[str],
        name: str | None = None,
        required: Sequence[str] = (),
        defaults: Mapping[str, object] | None = None,
        immutable: Sequence[str] = (),
        owner: str = "",
        comment: str = "",
        partition: PartitionSpec | None = None,
    ) -> "KeyedTable":
        """A new empty table; key columns come first and are never null.

        ``partition`` uses key columns only; its bounds are numbers or strings (dates
        as ISO text). Rows outside every range are refused.
        """
        if partition is not None:
            used = {c for level in partition.hash for c in level.columns}
            used |= {partition.range_column} if partition.bounds else set()
            if not used <= set(keys):
                raise ValueError("partition columns must be key columns")
        defaults = dict(defaults or {})
        ordered = [*keys, *[f.name for f in schema if f.name not in keys]]
        columns = []
        for i, column in enumerate(ordered):
            columns.append(
                {
                    "id": i,
                    "name": column,
                    "type": _type_json(schema[column].dataType),
                    "nullable": column not in keys and column not in required,
                    "default": defaults.get(column),
                    "read_default": None,
                    "added": 0,
                    "immutable": column in immutable,
                    "comment": "",
                }
            )
        table = cls(spark, path)
        table._publish(
            {
                "version": 0,
                "id": uuid.uuid4().hex,
                "name": name or path.rstrip("/").rsplit("/", 1)[-1],
                "owner": owner,
                "comment": comment,
                "dropped": False,
                "keys": list(keys),
                "columns": columns,
                "next_id": len(columns),
                "commits": [],
                "history_start": 0,
                "sources": {},
                "partition": partition.to_json() if partition else None,
            }
        )
        return table

    @classmethod
    def create_as(
        cls, df: DataFrame, path: str, keys: Sequence[str], ts: int | None = None, **options
    ) -> "KeyedTable":
        """A table made from a query, whose rows are inserted."""
        table = cls.create(df.sparkSession, path, df.schema, keys, **options)
        table.write("insert", df, ts=ts)
        return table

    def _publish(self, meta: dict) -> None:
        body = self.spark.range(1).select(F.lit(json.dumps(meta)).alias("value"))
        body.write.mode("errorifexists").text(f"{self.path}/meta/version={meta['version']}")

    def exists(self) -> bool:
        try:
            return not self.spark.read.text(f"{self.path}/meta").isEmpty()
        except AnalysisException:
            return False

    def meta(self) -> dict:
        """The newest document, with the commits that it and the ones before it added.

        The names of the files tell which is newest; of the others only those since the last full list are read.
        """
        files = self.spark.read.text(f"{self.path}/meta").inputFiles()
        newest = max(int(f.rsplit("/version=", 1)[1].split("/")[0]) for f in files)
        (head,) = self._documents(newest, newest)
        if "added" not in head:
            return {**head, "listed": [head["version"], len(head["commits"])]}
        commits: list[dict] = []
        for document in [*self._documents(head["listed"][0], newest - 1), head]:
            commits = commits + document["added"] if "added" in document else document["commits"]
        del head["added"]
        return {**head, "commits": commits}

    def _documents(self, first: int, last: int) -> list[dict]:
        """The documents of some versions, in order."""
        paths = [f"{self.path}/meta/version={n}" for n in range(first, last + 1)]
        documents = [json.loads(r["value"]) for r in self.spark.read.text(paths).collect()] if paths else []
        return sorted(documents, key=lambda d: d["version"])

    def _change(self, meta: dict, **values) -> dict:
        changed = {**meta, **values, "version": meta["version"] + 1}
        old, new = meta["commits"], changed["commits"]
        version, size = meta.get("listed", [meta["version"], len(old)])
        since = changed["version"] - version
        document = {k: v for k, v in changed.items() if k != "listed"}
        if new[: len(old)] == old and since <= max(LEAST_DELTAS, size // 4):
            changed["listed"] = document["listed"] = [version, size]
            document["added"] = new[len(old) :]
            del document["commits"]
        else:
            changed["listed"] = [changed["version"], len(new)]
        self._publish(document)
        return changed

    def rules(self, meta: dict | None = None) -> Rules:
        meta = meta or self.meta()
        columns = meta["columns"]
        return Rules(
            keys=tuple(meta["keys"]),
            required=tuple(
                c["name"] for c in columns if not c["nullable"] and c["name"] not in meta["keys"]
            ),
            defaults={c["name"]: c["default"] for c in columns if c["default"] is not None},
            immutable=tuple(c["name"] for c in columns if c["immutable"]),
        )

    @staticmethod
    def spec(meta: dict) -> PartitionSpec | None:
        return PartitionSpec.from_json(meta["partition"]) if meta.get("partition") else None

    @property
    def schema(self) -> StructType:
        return StructType(
            [StructField(c["name"], column_type(c["type"]), c["nullable"]) for c in self.meta()["columns"]]
        )

    # Reading

    def _files(
        self, meta: dict, paths: Sequence[str], control: bool, prune: Column | None = None, root: str | None = None
    ) -> DataFrame:
        """Stored rows under their current column names; ``prune`` picks partition folders, which
        are those below ``root`` if several paths are given."""
        fields = [StructField(f"c{c['id']}", column_type(c["type"])) for c in meta["columns"]]
        stored = StructType(
            [
                *fields,
                *StructType.fromJson(
                    {
                        "type": "struct",
                        "fields": [
                            {"name": n, "type": t, "nullable": True, "metadata": {}}
                            for n, t in zip(CONTROL, ("byte", "long", "integer"))
                        ],
                    }
                ).fields,
            ]
        )
        if paths:
            reader = self.spark.read.schema(stored)
            if root is not None:
                reader = reader.option("basePath", f"{self.path}/{root}")
            df = reader.parquet(*[f"{self.path}/{p}" for p in paths])
        else:
            df = self.spark.createDataFrame([], stored)
        if prune is not None:
            df = df.filter(prune)
        cells = []
        for c in meta["columns"]:
            cell = F.col(f"c{c['id']}")
            if c["read_default"] is not None:
                old = F.lit(c["read_default"]).cast(column_type(c["type"]))
                cell = F.when(F.col("_ts") < c["added"], old).otherwise(cell)
            cells.append(cell.alias(c["name"]))
        df = df.select(*cells, *CONTROL)
        for gap in meta.get("dropped_ranges", []):
            inside = Bound(gap["lower"], gap["upper"]).holds(F.col(gap["column"]))
            df = df.filter(~((F.col("_ts") <= gap["ts"]) & F.coalesce(inside, F.lit(False))))
        return df if control else df.drop(*CONTROL)

    @staticmethod
    def _commits(meta: dict, kind: str, after: int, upto: int) -> list[dict]:
        return [c for c in meta["commits"] if c["kind"] == kind and after < c["ts"] <= upto]

    def _last_rows(self, meta: dict, after: int, upto: int, prune: Column | None = None) -> DataFrame:
        """The last logged row of each key in (after, upto]."""
        commits = self._commits(meta, "log", after, upto)
        # Folder numbers mean the present partitions only where the commit was placed by them.
        placed = [c["path"] for c in commits if "layout" in c]
        now = [c["path"] for c in commits if "layout" in c and c["layout"] == meta.get("layout", 0)]
        if prune is None or len(now) < len(placed):
            prune = None
        plain = [c["path"] for c in commits if "layout" not in c]
        parts = [self._files(meta, plain, control=True)] if plain or not placed else []
        if placed:
            parts.append(self._files(meta, placed, control=True, prune=prune, root="log"))
        rows = reduce(DataFrame.unionByName, parts)
        if len(commits) > 1:
            rest = [c for c in rows.columns if c not in meta["keys"]]
            newest = F.max_by(F.struct(*rest), F.struct("_ts", "_seq")).alias("_row")
            rows = rows.groupBy(*meta["keys"]).agg(newest).select(*meta["keys"], "_row.*")
        names = [c["name"] for c in meta["columns"]]
        return rows.select(*names, "_op")

    def _state(self, meta: dict, upto: int, prune: Column | None = None) -> DataFrame:
        snapshots = [c for c in meta["commits"] if c["kind"] == "snapshot" and c["ts"] <= upto]
        newest = max(snapshots, key=lambda c: c["ts"], default={"ts": 0, "path": None})
        tail = self._last_rows(meta, newest["ts"], upto, prune)
        if newest["path"] is None:
            return tail.filter(F.col("_op") == PUT).drop("_op")
        folders = prune if newest.get("partitioned") == meta.get("partition") else None
        base = self._files(meta, [newest["path"]], control=False, prune=folders)
        if not self._commits(meta, "log", newest["ts"], upto):
            return base
        return merge(base, tail, meta["keys"])

    @staticmethod
    def last_commit(meta: dict) -> int:
        """Time of the newest commit, 0 before the first."""
        return max((c["ts"] for c in meta["commits"]), default=0)

    def latest(self) -> DataFrame:
        meta = self.meta()
        return self._state(meta, self.last_commit(meta))

    def scan(
        self, equals: Mapping[str, object], lower: object = None, upper: object = None
    ) -> DataFrame:
        """Latest rows with ``equals`` key values and the range column in ``[lower, upper)``.

        Of a partitioned table only the matching folders are read, of its log as of its snapshot.
        """
        meta = self.meta()
        spec = self.spec(meta) or PartitionSpec()
        if set(equals) - set(meta["keys"]):
            raise ValueError("only key columns can be given; filter the result by others")
        prune = partitions.partition_predicate(spec, self.schema, equals, lower, upper)
        state = self._state(meta, self.last_commit(meta), prune)
        return state.filter(partitions.row_predicate(spec, equals, lower, upper))

    def as_of(self, ts: int) -> DataFrame:
        """The table at a time; the same answer however often it is asked."""
        meta = self.meta()
        if ts > max(now_micros(), self.last_commit(meta)):
            raise ValueError("the time lies in the future")
        if ts < meta["history_start"]:
            raise ValueError("the time lies before the kept history")
        return self._state(meta, ts)

    def at_least(self, ts: int) -> DataFrame:
        """The newest state, which must include the commit at ``ts`` (read your writes)."""
        meta = self.meta()
        if self.last_commit(meta) < ts:
            raise ValueError("that commit is not visible yet")
        return self._state(meta, self.last_commit(meta))

    def diff(self, start: int, end: int) -> DataFrame:
        """Keys changed in (start, end] with their final values and ``is_deleted``.

        A key deleted and put back is live. A key absent at both ends is left out.
        """
        meta = self.meta()
        if start > end or start < meta["history_start"]:
            raise ValueError("the interval is not in the kept history")
        rows = self._last_rows(meta, start, end)
        names = [c["name"] for c in meta["columns"]]
        live = rows.filter(F.col("_op") == PUT).select(*names, F.lit(False).alias("is_deleted"))
        gone = rows.filter(F.col("_op") == REMOVE)
        before = rowops.present_keys(self._state(meta, start), gone, meta["keys"])
        dead = gone.join(before, meta["keys"], "left_semi")
        return live.unionByName(dead.select(*names, F.lit(True).alias("is_deleted")))

    # Writing

    def _store(self, meta: dict, delta: DataFrame, ts: int, seq: int) -> dict:
        """Write the rows of one change; they are not visible until published."""
        spec, name = self.spec(meta), f"{ts}-{seq}-{uuid.uuid4().hex[:8]}"
        commit = {"ts": ts, "seq": seq, "kind": "log", "path": f"log/{name}"}
        cells = [F.col(c["name"]).alias(f"c{c['id']}") for c in meta["columns"]]
        control = [
            F.col("_op").cast("byte").alias("_op"),
            F.lit(ts).cast("long").alias("_ts"),
            F.lit(seq).cast("int").alias("_seq"),
        ]
        if spec is None or not spec.columns:
            delta.select(*cells, *control).write.parquet(f"{self.path}/{commit['path']}")
            return commit
        # A folder name that Spark can read as a partition of the log, so that many commits are one scan.
        commit |= {"path": f"log/commit=c{name}", "layout": meta.get("layout", 0)}
        placed = partitions.clustered(delta, spec, meta["keys"]).select(*cells, *control, *spec.columns)
        placed.write.partitionBy(*spec.columns).parquet(f"{self.path}/{commit['path']}")
        return commit

    def _next_ts(self, meta: dict, ts: int | None) -> int:
        last = self.last_commit(meta)
        if ts is None:
            return max(now_micros(), last + 1)
        if ts <= last:
            raise ValueError(f"commit times only grow: {ts} is not after {last}")
        return ts

    def write(
        self,
        op: str,
        changes: DataFrame,
        ts: int | None = None,
        seq: str | None = None,
        ignore_null: bool = False,
        drift: bool = False,
        source: tuple[str, int] | None = None,
    ) -> int:
        """Apply one batch and return its commit time.

        Of several changes to one key those later in ``seq`` count, without ``seq`` those
        that came later (see ``rowops.in_arrival_order``); a table never holds a key twice.
        ``source`` names the stream and batch number; a batch that was already
        committed is skipped. ``drift`` adds unknown incoming columns first.
        """
        meta = self.meta()
        if source is not None and meta["sources"].get(source[0], -1) >= source[1]:
            return self.last_commit(meta)
        changes, seq = rowops.in_arrival_order(changes, seq)
        if drift:
            meta = self._widen(meta, changes, [seq])
        ts = self._next_ts(meta, ts)
        base = self._state(meta, self.last_commit(meta))
        spec = self.spec(meta)
        if spec is not None:
            changes = changes.filter(partitions.covered(spec))
        delta = rowops.plan_change(base, changes, self.rules(meta), op, seq, ignore_null)
        commit = self._store(meta, delta, ts, 0)
        values = {"commits": [*meta["commits"], commit]}
        if source is not None:
            values["sources"] = {**meta["sources"], source[0]: source[1]}
        self._change(meta, **values)
        return ts

    def write_reported(
        self, op: str, changes: DataFrame, ts: int | None = None, seq: str | None = None, ignore_null: bool = False
    ) -> "Written":
        """``write``, with the rows that it refused and its counts, all from one pass.

        The batch is evaluated once, the table is read once. Refused rows are read from what the write stored
        beside the table, at any time after it.
        """
        meta = self.meta()
        ts = self._next_ts(meta, ts)
        given, spec = seq, self.spec(meta)
        base = self._state(meta, self.last_commit(meta))
        outside, counts = None, {"outside": 0}
        if spec is not None:
            changes, seq = rowops.in_arrival_order(rowops.align(base, changes, extra=[seq] if seq else []), seq)
            seen = Observation()
            inside = F.coalesce(partitions.covered(spec), F.lit(False))
            arrived = materialize(changes.observe(seen, F.count(F.when(~inside, 1)).alias("outside")), "arrived")
            changes, outside = partitions.split_covered(arrived, spec)
            counts = {"outside": seen.get["outside"]}
        done = rowops.carry_out(base, changes, self.rules(meta), op, seq, ignore_null)
        shown = [*meta["keys"], *([given] if given else [])]
        refused = done.errors.select(*shown, "error")
        if outside is not None:
            refused = refused.unionByName(outside.select(*shown, F.lit(NOT_COVERED).alias("error")))
        commit = self._store(meta, done.delta, ts, 0)
        self._change(meta, commits=[*meta["commits"], commit])
        counts |= {"incoming": done.counts["incoming"] + counts["outside"], "applied": done.counts["applied"]}
        return Written(ts, refused, counts)

    def errors(self, op: str, changes: DataFrame, seq: str | None = None) -> DataFrame:
        """The rows ``write`` would refuse against the current state."""
        meta = self.meta()
        base, spec = self._state(meta, self.last_commit(meta)), self.spec(meta)
        given = seq
        changes, seq = rowops.in_arrival_order(changes, seq)
        hidden = [] if given else [seq]
        if spec is None:
            return rowops.row_errors(base, changes, self.rules(meta), op, seq).drop(*hidden)
        stored, outside = partitions.split_covered(changes, spec)
        refused = rowops.row_errors(base, stored, self.rules(meta), op, seq).drop(*hidden)
        shown = [*meta["keys"], *([given] if given else [])]
        return refused.unionByName(outside.select(*shown, F.lit(NOT_COVERED).alias("error")))

    def write_feed(
        self, feed: DataFrame, action: str, seq: str, ts: int | None = None
    ) -> int:
        """Apply a feed whose rows carry their own action (0 or null put, 1 delete).

        Rows with a null key, and rows outside every range, are not stored.
        """
        meta = self.meta()
        ts = self._next_ts(meta, ts)
        feed = feed.dropna(subset=meta["keys"])
        if self.spec(meta) is not None:
            feed = feed.filter(partitions.covered(self.spec(meta)))
        names = [c["name"] for c in meta["columns"]]
        last = rowops.last_changes(feed, meta["keys"], seq)
        op = F.coalesce(F.col(action), F.lit(PUT)).alias("_op")
        commit = self._store(meta, last.select(*names, op), ts, 0)
        self._change(meta, commits=[*meta["commits"], commit])
        return ts

    @contextmanager
    def batch(self, ts: int | None = None):
        """Several operations that become visible together, or not at all."""
        meta = self.meta()
        staged = StagedBatch(self, meta, self._next_ts(meta, ts))
        yield staged
        if not staged.cancelled:
            self._change(meta, commits=[*meta["commits"], *staged.commits])

    def update_where(
        self, predicate: Column, values: Mapping[str, Column], ts: int | None = None
    ) -> int:
        """Set columns on the rows that meet the predicate; only those rows are logged.

        An immutable column can't be set. If a required column would become null on some row, nothing is written.
        """
        meta = self.meta()
        rules = self.rules(meta)
        if set(values) & set(rules.immutable):
            raise ValueError("immutable columns cannot be updated")
        hit = self._state(meta, self.last_commit(meta)).filter(predicate)
        changed = rowops.update_where(hit, F.lit(True), values, meta["keys"])
        emptied = [c for c in rules.required if c in values]
        if emptied and not changed.filter(reduce(Column.__or__, [F.col(c).isNull() for c in emptied])).isEmpty():
            raise ValueError(f"required columns would become null: one of {emptied}")
        return self._log_rows(meta, changed, PUT, ts)

    def delete_where(self, predicate: Column, ts: int | None = None) -> int:
        meta = self.meta()
        hit = self._state(meta, self.last_commit(meta)).filter(predicate)
        return self._log_rows(meta, hit, REMOVE, ts)

    def _log_rows(self, meta: dict, rows: DataFrame, op: int, ts: int | None) -> int:
        ts = self._next_ts(meta, ts)
        commit = self._store(meta, rows.withColumn("_op", F.lit(op)), ts, 0)
        self._change(meta, commits=[*meta["commits"], commit])
        return ts

    def compact(self, keep_history: bool = True) -> None:
        """Fold the log into a snapshot sorted by key; every read answers as before.

        Without ``keep_history`` times before the snapshot can no longer be read.
        """
        meta = self.meta()
        ts = self.last_commit(meta)
        path = f"snapshot/{ts}-{uuid.uuid4().hex[:8]}"
        cells = [F.col(c["name"]).alias(f"c{c['id']}") for c in meta["columns"]]
        control = [
            F.lit(PUT).cast("byte").alias("_op"),
            F.lit(ts).cast("long").alias("_ts"),
            F.lit(0).cast("int").alias("_seq"),
        ]
        state, spec = self._state(meta, ts), self.spec(meta)
        if spec is None:
            placed = state.repartitionByRange(*meta["keys"]).sortWithinPartitions(*meta["keys"])
            writer = placed.select(*cells, *control).write
        else:
            placed = partitions.clustered(state, spec, meta["keys"])
            writer = placed.select(*cells, *control, *spec.columns).write.partitionBy(*spec.columns)
        writer.parquet(f"{self.path}/{path}")
        snapshot = {
            "ts": ts,
            "seq": 0,
            "kind": "snapshot",
            "path": path,
            "partitioned": meta.get("partition"),
        }
        if keep_history:
            self._change(meta, commits=[*meta["commits"], snapshot])
        else:
            self._change(meta, commits=[snapshot], history_start=ts)

    # Columns

    def _widen(self, meta: dict, changes: DataFrame, extra: Sequence[str]) -> dict:
        known = {c["name"] for c in meta["columns"]}
        for f in changes.schema:
            if f.name not in known and f.name not in extra:
                meta = self.add_column(f.name, f.dataType)
        return meta

    def add_column(
        self, name: str, kind: DataType, default: object = None, required: bool = False
    ) -> dict:
        """Existing rows read the default; a column without one must be nullable."""
        meta = self.meta()
        if any(c["name"] == name for c in meta["columns"]):
            raise ValueError(f"column {name} exists")
        if required and default is None:
            raise ValueError("a required column needs a default")
        column = {
            "id": meta["next_id"],
            "name": name,
            "type": _type_json(kind),
            "nullable": not required,
            "default": default,
            "read_default": default,
            "added": self.last_commit(meta) + 1,
            "immutable": False,
            "comment": "",
        }
        return self._change(
            meta, columns=[*meta["columns"], column], next_id=meta["next_id"] + 1
        )

    def drop_column(self, name: str) -> dict:
        meta = self.meta()
        if name in meta["keys"]:
            raise ValueError("a key column cannot be dropped")
        return self._change(meta, columns=[c for c in meta["columns"] if c["name"] != name])

    def rename_column(self, old: str, new: str) -> dict:
        meta = self.meta()
        if any(c["name"] == new for c in meta["columns"]):
            raise ValueError(f"column {new} exists")
        columns = [{**c, "name": new} if c["name"] == old else c for c in meta["columns"]]
        if old in meta["keys"] and meta.get("partition"):
            raise ValueError("a key column of a partitioned table cannot be renamed")
        keys = [new if k == old else k for k in meta["keys"]]
        gaps = [
            {**g, "column": new} if g["column"] == old else g for g in meta.get("dropped_ranges", [])
        ]
        return self._change(meta, columns=columns, keys=keys, dropped_ranges=gaps)

    def alter_column(self, name: str, **attributes) -> dict:
        """Change ``default`` (None removes it), ``comment`` or ``immutable``."""
        if set(attributes) - {"default", "comment", "immutable"}:
            raise ValueError("only default, comment and immutable can be altered")
        meta = self.meta()
        columns = [{**c, **attributes} if c["name"] == name else c for c in meta["columns"]]
        return self._change(meta, columns=columns)

    def add_range(self, bound: Bound) -> dict:
        """Accept rows of one more range."""
        meta = self.meta()
        return self._change(meta, partition=self.spec(meta).with_range(bound).to_json(), layout=meta.get("layout", 0) + 1)

    def drop_range(self, column: str, lower, upper) -> dict:
        """Drop the rows stored so far with ``lower <= column < upper``; later rows stay.

        On a table partitioned by ranges the range goes too, and must exist.
        """
        meta = self.meta()
        spec = self.spec(meta)
        if spec is not None and spec.bounds:
            smaller = spec.without_range(Bound(lower, upper))
            meta = {**meta, "partition": smaller.to_json(), "layout": meta.get("layout", 0) + 1}
        gap = {"column": column, "lower": lower, "upper": upper, "ts": self.last_commit(meta)}
        return self._change(meta, dropped_ranges=[*meta.get("dropped_ranges", []), gap])

    # Table attributes

    def drop(self) -> dict:
        """Hide the table; ``recall`` brings it back."""
        return self._change(self.meta(), dropped=True)

    def recall(self) -> dict:
        return self._change(self.meta(), dropped=False)

    def describe(self, **attributes) -> dict:
        """Change ``name``, ``owner`` or ``comment``."""
        if set(attributes) - {"name", "owner", "comment"}:
            raise ValueError("only name, owner and comment can be set")
        return self._change(self.meta(), **attributes)


class StagedBatch:
    def __init__(self, table: KeyedTable, meta: dict, ts: int):
        self.table, self.meta, self.ts = table, meta, ts
        self.commits: list[dict] = []
        self.cancelled = False

    def write(self, op: str, changes: DataFrame, seq: str | None = None) -> None:
        """One operation; it sees the earlier ones of the batch."""
        pending = {**self.meta, "commits": [*self.meta["commits"], *self.commits]}
        base = self.table._state(pending, self.ts)
        spec = self.table.spec(self.meta)
        if spec is not None:
            changes = changes.filter(partitions.covered(spec))
        changes, seq = rowops.in_arrival_order(changes, seq)
        delta = rowops.plan_change(base, changes, self.table.rules(self.meta), op, seq)
        self.commits.append(self.table._store(self.meta, delta, self.ts, len(self.commits)))

    def rollback(self) -> None:
        self.cancelled = True


# Many tables, and files in and out


def list_tables(spark: SparkSession, root: str, name_filter: str = "") -> DataFrame:
    """(name, path, version, dropped, owner, comment) of the tables under a folder."""
    documents = spark.read.text(f"{root.rstrip('/')}/*/meta/version=*").select(
        F.regexp_extract("_metadata.file_path", "^(.*)/meta/version=[0-9]+/", 1).alias("path"),
        F.from_json(
            "value",
            "version BIGINT, name STRING, dropped BOOLEAN, owner STRING, comment STRING",
        ).alias("m"),
    )
    newest = documents.groupBy("path").agg(F.max_by("m", "m.version").alias("m"))
    return newest.select("m.name", "path", "m.version", "m.dropped", "m.owner", "m.comment").filter(
        ~F.col("dropped") & F.col("name").contains(name_filter)
    )


def save_table(df: DataFrame, table: KeyedTable, mode: str = "append") -> int:
    """Data frame writer modes on a keyed table: append upserts, overwrite is refused."""
    if mode != "append":
        raise ValueError("a keyed table can only be appended to")
    return table.write("upsert", df)


def import_table(table: KeyedTable, path: str, fmt: str, op: str = "upsert", **options) -> int:
    """Apply the rows of csv or parquet files; text columns take the table's types."""
    reader = table.spark.read.options(**options)
    rows = reader.schema(table.schema).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
    return table.write(op, rows)


def export_table(
    table: KeyedTable, path: str, fmt: str, columns: Sequence[str] | None = None, **options
) -> None:
    rows = table.latest()
    rows.select(*(columns or rows.columns)).write.format(fmt).options(**options).save(path)


def copy_table(
    source: KeyedTable,
    target: KeyedTable,
    op: str,
    predicate: Column | None = None,
    columns: Sequence[str] | None = None,
    skip: Sequence[str] = ("auto_incrementing_id",),
) -> int | None:
    """Copy matching rows with insert, insert_ignore, upsert or upsert_ignore; none copies no row."""
    if op == "none":
        return None
    if op not in ("insert", "insert_ignore", "upsert", "upsert_ignore"):
        raise ValueError(f"cannot copy with {op!r}")
    rows = source.latest()
    if predicate is not None:
        rows = rows.filter(predicate)
    wanted = [c for c in (columns or rows.columns) if c not in skip]
    return target.write(op, rows.select(*wanted))
