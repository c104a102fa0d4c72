"""Row operations on a table with a unique key, as joins.

``judge`` groups a batch with the stored rows it touches and says of each key what came,
whether the table has it, and what becomes of it. From that follow the *delta* (at most one row per
key, a full row image plus ``_op``: 0 put, 1 delete), the refused rows and the counts.
``merge`` folds a delta into a table. A batch may hold a key many times; it is summed up per key
in the tasks first, so a hot key is one row per map task.

Stored rows are picked by a semi join with the touched keys, so Spark can broadcast a small batch and
leave a large table in place; they are read once. ``apply_ops`` writes the batch and the judged keys once
each, and everything else reads those: of its inputs the batch is evaluated once, the table
twice (to judge, and for the new state).

A column an operation does not set is a column the incoming frame does not have.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import DataType

from olapkit.operators.numbering import number_rows
from olapkit.operators.skew import HOT_ROWS, salted_join
from olapkit.workspace import materialize

PUT, REMOVE = 0, 1

ALREADY_PRESENT = "ALREADY_PRESENT"
NOT_FOUND = "NOT_FOUND"
NULL_KEY = "NULL_KEY"
MISSING_VALUE = "MISSING_VALUE"
IMMUTABLE = "IMMUTABLE"

OPS = (
    "insert",
    "insert_ignore",
    "update",
    "update_ignore",
    "upsert",
    "upsert_ignore",
    "delete",
    "delete_ignore",
)


@dataclass(frozen=True)
class Rules:
    """What a table asks of its rows."""

    keys: tuple[str, ...]
    required: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)
    immutable: tuple[str, ...] = ()


@dataclass(frozen=True)
class Applied:
    """New state, one row per refused incoming row, and one row of counts."""

    state: DataFrame
    errors: DataFrame
    counts: DataFrame


def align(
    base: DataFrame, changes: DataFrame, drift: bool = False, extra: Sequence[str] = ()
) -> DataFrame:
    """Keep the incoming columns the table knows; refuse a column of another type.

    ``extra`` names control columns to keep. With ``drift`` unknown columns stay,
    to be added to the table.
    """
    known = {f.name: f.dataType for f in base.schema}
    for f in changes.schema:
        if f.name in known and f.dataType != known[f.name]:
            raise TypeError(
                f"column {f.name}: got {f.dataType.simpleString()},"
                f" the table has {known[f.name].simpleString()}"
            )
    keep = [c for c in changes.columns if drift or c in known or c in extra]
    return changes.select(*keep)


def widen(base: DataFrame, changes: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """The table with the unknown incoming columns added as nulls."""
    new = [f for f in changes.schema if f.name not in base.columns and f.name not in extra]
    return base.withColumns({f.name: F.lit(None).cast(f.dataType) for f in new})


ARRIVAL = "_arrival"


def file_position(df: DataFrame) -> Column | None:
    """Where the rows of a frame stand in the files they were read from; None if no files show.

    File time, file name, and the row's number in its file, or the start of its block in formats without
    row numbers. Filters, projections and shuffles keep it, joins and groupings don't.
    """
    try:
        place = df.metadataColumn("_metadata")
        names = df.select(place.alias("place")).schema["place"].dataType.names
    except AnalysisException:
        return None
    inside = "row_index" if "row_index" in names else "file_block_start"
    return F.struct(*[place[n].alias(n) for n in ("file_modification_time", "file_path", inside)])


def in_arrival_order(changes: DataFrame, seq: str | None) -> tuple[DataFrame, str]:
    """The batch with a column that orders it: its own, or the order in which its rows came.

    Rows of files are ordered by their place there, which a replay after a shuffle or a lost executor
    finds again. Rows of one place, and batches not read from files, are ordered as Spark hands
    them over, which is only as repeatable as their plan.
    """
    if seq is not None:
        return changes, seq
    place = F.col(ARRIVAL) if ARRIVAL in changes.columns else file_position(changes)
    order = F.monotonically_increasing_id()
    if place is not None:
        order = F.struct(place.alias("place"), order.alias("turn"))
    return changes.withColumn(ARRIVAL, order), ARRIVAL


def last_changes(
    changes: DataFrame, keys: Sequence[str], seq: str | None, ignore_null: bool = False
) -> DataFrame:
    """One row per key: the last value of each column in ``seq`` order.

    With ``ignore_null`` a null does not replace an earlier value of the batch.
    Without ``seq`` the keys of the batch must be unique.
    """
    values = [c for c in changes.columns if c not in keys and c != seq]
    if seq is None:
        return changes
    if not values:
        return changes.select(*keys).distinct()
    if ignore_null:
        picks = [
            F.max_by(c, F.when(F.col(c).isNotNull(), F.col(seq))).alias(c) for c in values
        ]
        return changes.groupBy(*keys).agg(*picks)
    row = F.max_by(F.struct(*values), F.col(seq)).alias("_row")
    return changes.groupBy(*keys).agg(row).select(*keys, "_row.*")


def present_keys(base: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Touched keys the table has; reads only the table's key columns."""
    return base.select(*keys).join(touched.select(*keys), list(keys), "left_semi")


def _typed(value: object, kind: DataType) -> Column:
    return F.lit(value).cast(kind)


def _unset_required(changes: DataFrame, rules: Rules) -> list[str]:
    return [c for c in rules.required if c not in changes.columns and c not in rules.defaults]


def _row_error(changes: DataFrame, rules: Rules, op: str, ignore_null: bool = False) -> Column:
    """Why a row is refused on its own account, else null.

    With ``ignore_null`` a null is an unset cell, which only a row new to the
    table may be refused for.
    """
    missing_key = F.lit(False)
    for k in rules.keys:
        missing_key = missing_key | F.col(k).isNull()
    error = F.when(missing_key, NULL_KEY)
    if op.startswith("delete") or ignore_null:
        return error
    empty = F.lit(op.startswith("insert") and bool(_unset_required(changes, rules)))
    for c in rules.required:
        if c in changes.columns:
            empty = empty | F.col(c).isNull()
    return error.when(empty, MISSING_VALUE)


def _check(base: DataFrame, changes: DataFrame, rules: Rules, op: str, seq: str | None) -> None:
    if op not in OPS:
        raise ValueError(f"unknown operation {op!r}")
    values = [c for c in changes.columns if c not in rules.keys and c != seq]
    lacking = [k for k in rules.keys if k not in changes.columns]
    if lacking:
        raise ValueError(f"{op} needs the key columns {lacking}")
    if op.startswith("delete") and values:
        raise ValueError(f"{op} may set key columns only, not {values}")
    if op.startswith("update") and not values:
        raise ValueError(f"{op} needs at least one value column")
    unknown = [c for c in values if c not in base.columns]
    if unknown:
        raise ValueError(f"the table has no columns {unknown}")


def _sets_immutable(changes: DataFrame, rules: Rules) -> bool:
    return any(c in changes.columns for c in rules.immutable)


def _takes_first(changes: DataFrame, rules: Rules, op: str) -> bool:
    """Whether only a key's first row counts, as the table may not have the key before it."""
    return op.startswith("insert") or (op == "upsert" and _sets_immutable(changes, rules))


def _replaces(base: DataFrame, changes: DataFrame, rules: Rules, op: str, ignore_null: bool) -> bool:
    """Whether the batch alone says what is stored."""
    whole = not ignore_null and set(base.columns) <= set(changes.columns)
    return op.startswith("upsert") and whole and not _sets_immutable(changes, rules)


def judge(
    base: DataFrame,
    changes: DataFrame,
    rules: Rules,
    op: str,
    seq: str | None = None,
    ignore_null: bool = False,
) -> DataFrame:
    """One row per key of the batch, null keys too.

    ``_all`` rows came, of which ``_n`` aren't refused on their own account, the first of those at ``_first``.
    ``_present`` tells whether the table has the key (false if the operation need not know), ``_old`` holds its stored values,
    ``_new`` the values that count, ``_carried`` the immutable values a new row keeps.
    Without ``seq`` the keys of the batch must be unique.
    """
    changes = align(base, changes, extra=[seq] if seq else [])
    _check(base, changes, rules, op, seq)
    keys = list(rules.keys)
    values = [c for c in changes.columns if c not in keys and c != seq]
    carried = [c for c in rules.immutable if c in values] if op.startswith("upsert") else []
    order = F.col(seq) if seq else F.lit(0)
    came = changes.select(
        *keys,
        F.lit(True).alias("_came"),
        F.when(_row_error(changes, rules, op, ignore_null).isNull(), order).alias("_order"),
        *[F.col(c).alias(f"_new_{c}") for c in values],
    )
    old: list[str] = []
    if not _replaces(base, changes, rules, op, ignore_null):
        if not _takes_first(changes, rules, op):
            old = [c for c in base.columns if c not in keys]
        touched = came.filter(F.col("_order").isNotNull()).select(*keys).distinct()
        stored = base.select(*keys, *old).join(touched, keys, "left_semi")
        stored = stored.select(*keys, *[F.struct(*old).alias("_old")] * bool(old), F.lit(False).alias("_came"))
        came = came.unionByName(stored, allowMissingColumns=True)

    ordered = F.col("_order")

    def picked(pick, names: Sequence[str]) -> Column:
        return pick(F.struct(*[F.col(f"_new_{c}").alias(c) for c in names]), ordered)

    parts = [
        F.count(F.when(F.col("_came"), 1)).alias("_all"),
        F.count(ordered).alias("_n"),
        F.min(ordered).alias("_first"),
        (F.count(F.when(~F.col("_came"), 1)) > 0).alias("_present"),
    ]
    if old:
        parts.append(F.first("_old", ignorenulls=True).alias("_old"))
    if values and ignore_null and not _takes_first(changes, rules, op):
        # The last value of each column that is not null.
        last = [F.max_by(f"_new_{c}", F.when(F.col(f"_new_{c}").isNotNull(), ordered)).alias(c) for c in values]
        parts.append(F.struct(*last).alias("_new"))
    elif values:
        parts.append(picked(F.min_by if _takes_first(changes, rules, op) else F.max_by, values).alias("_new"))
    if carried:
        parts.append(picked(F.min_by, carried).alias("_carried"))
    return came.groupBy(*keys).agg(*parts)


def _delta(
    base: DataFrame, changes: DataFrame, judged: DataFrame, rules: Rules, op: str, ignore_null: bool = False
) -> DataFrame:
    """The full rows plus ``_op`` that judged keys come to."""
    present, lacks = F.col("_present"), bool(_unset_required(changes, rules))
    valid = judged.filter(F.col("_n") > 0)
    given = [c for c in changes.columns if c in base.columns and c not in rules.keys]
    frozen = rules.immutable if op.endswith("_ignore") else ()

    def merged(c: str) -> Column:
        if c not in given or c in frozen:
            return F.col("_old")[c]
        return F.coalesce(F.col("_new")[c], F.col("_old")[c]) if ignore_null else F.col("_new")[c]

    def fresh(f) -> Column:
        if f.name not in given:
            return _typed(rules.defaults.get(f.name), f.dataType)
        kept = "_carried" if op.startswith("upsert") and f.name in rules.immutable else "_new"
        return F.col(kept)[f.name]

    def rows(df: DataFrame, cell, kind: int) -> DataFrame:
        cells = [F.col(f.name) if f.name in rules.keys else cell(f).alias(f.name) for f in base.schema]
        return df.select(*cells, F.lit(kind).cast("byte").alias("_op"))

    if op.startswith("delete"):
        return rows(valid.filter(present), lambda f: F.col("_old")[f.name], REMOVE)
    if _takes_first(changes, rules, op):
        refuses = op == "upsert" and lacks
        return rows(valid.filter(~present & F.lit(not refuses)), fresh, PUT)
    if op.startswith("update"):
        refuses = op == "update" and _sets_immutable(changes, rules)
        return rows(valid.filter(present & F.lit(not refuses)), lambda f: merged(f.name), PUT)
    if _replaces(base, changes, rules, op, ignore_null):
        return rows(valid, lambda f: F.col("_new")[f.name], PUT)
    whole = F.lit(not lacks)
    for c in rules.required if ignore_null else ():
        whole = whole & F.col("_new")[c].isNotNull() if c in given else whole
    return rows(valid.filter(present | whole), lambda f: F.when(present, merged(f.name)).otherwise(fresh(f)), PUT)


def plan_change(
    base: DataFrame,
    changes: DataFrame,
    rules: Rules,
    op: str,
    seq: str | None = None,
    ignore_null: bool = False,
) -> DataFrame:
    """The delta of one batch: full rows plus ``_op``, one per key that changes."""
    judged = judge(base, changes, rules, op, seq, ignore_null)
    return _delta(base, changes, judged, rules, op, ignore_null)


def merge(base: DataFrame, delta: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table after a delta."""
    kept = base.join(delta.select(*keys), list(keys), "left_anti")
    return kept.unionByName(delta.filter(F.col("_op") == PUT).drop("_op"))


def refused_rows(
    changes: DataFrame,
    judged: DataFrame,
    rules: Rules,
    op: str,
    seq: str | None = None,
    ignore_null: bool = False,
) -> DataFrame:
    """(keys, seq, error) of the rows of a batch that its judged keys refuse."""
    shown = [*rules.keys, *([seq] if seq else [])]
    own = _row_error(changes, rules, op, ignore_null)
    bad = changes.select(*shown, own.alias("error")).filter(F.col("error").isNotNull())

    needed = [c for c in rules.required if c in changes.columns] if ignore_null else []
    lacks = F.lit(bool(_unset_required(changes, rules)))
    for c in needed:
        lacks = lacks | F.col(c).isNull()
    valid = changes.filter(own.isNull()).select(*shown, lacks.alias("_lacks"))
    present = F.col("_present")
    again = F.col(seq) > F.col("_first") if seq else F.lit(False)
    immutable = _sets_immutable(changes, rules)
    repeated, always = F.col("_n") > 1, F.lit(True)
    if op == "insert":
        error, suspect = F.when(present | again, ALREADY_PRESENT), present | repeated
    elif op == "delete":
        error, suspect = F.when(~present | again, NOT_FOUND), ~present | repeated
    elif op == "update" and immutable:
        error, suspect = F.when(~present, NOT_FOUND).otherwise(IMMUTABLE), always
    elif op == "update":
        error, suspect = F.when(~present, NOT_FOUND), ~present
    elif op == "upsert" and immutable:
        error = F.when(F.col("_lacks") & ~present, MISSING_VALUE)
        error, suspect = error.when(present | again, IMMUTABLE), always
    elif op.startswith("upsert"):
        if not needed and not _unset_required(changes, rules):
            return bad
        error, suspect = F.when(F.col("_lacks") & ~present, MISSING_VALUE), ~present
    else:
        return bad
    # Only keys with a refused row are marked. The batch may hold one of them very often; the number of
    # its rows is known, and at most one key per HOT_ROWS of them is hot.
    known = judged.filter(F.col("_n") > 0)
    marks = known.filter(suspect).select(*rules.keys, "_n", "_first", "_present")
    hot = known.filter(F.col("_n") > HOT_ROWS).select(*rules.keys)
    refused = (
        salted_join(valid, marks, rules.keys, hot=hot)
        .select(*shown, error.alias("error"))
        .filter(F.col("error").isNotNull())
    )
    return bad.unionByName(refused)


def row_errors(
    base: DataFrame,
    changes: DataFrame,
    rules: Rules,
    op: str,
    seq: str | None = None,
    ignore_null: bool = False,
) -> DataFrame:
    """(keys, seq, error) of each refused row; the ``_ignore`` forms refuse only bad rows."""
    changes = align(base, changes, extra=[seq] if seq else [])
    judged = judge(base, changes, rules, op, seq, ignore_null)
    return refused_rows(changes, judged, rules, op, seq, ignore_null)


def _effect(changes: DataFrame, rules: Rules, op: str) -> Column:
    """How many rows of a judged key took effect."""
    present, n = F.col("_present"), F.col("_n")
    one, some = F.lit(1).cast("long"), n > 0
    if _takes_first(changes, rules, op):
        effect = F.when(some & ~present, one)
    elif op.startswith("delete"):
        effect = F.when(some & present, one)
    elif op.startswith("update"):
        refuses = op == "update" and _sets_immutable(changes, rules)
        effect = F.when(present & F.lit(not refuses), n)
    else:
        effect = n
    if op.startswith("upsert") and _unset_required(changes, rules):
        effect = F.when(present, effect)
    return F.coalesce(effect, F.lit(0).cast("long"))


def _tally(changes: DataFrame, rules: Rules, op: str) -> list[Column]:
    """Incoming rows and rows that took effect, summed over judged keys."""
    return [
        F.coalesce(F.sum("_all"), F.lit(0).cast("long")).alias("incoming"),
        F.coalesce(F.sum(_effect(changes, rules, op)), F.lit(0).cast("long")).alias("applied"),
    ]


def op_counts(
    base: DataFrame, changes: DataFrame, rules: Rules, op: str, seq: str | None = None
) -> DataFrame:
    """One row: operation, incoming rows, rows that took effect."""
    judged = judge(base, changes, rules, op, seq)
    return judged.agg(*_tally(changes, rules, op)).select(F.lit(op).alias("op"), "incoming", "applied")


@dataclass(frozen=True)
class Outcome:
    """What one batch comes to: its delta, its refused rows, and its counts by name."""

    delta: DataFrame
    errors: DataFrame
    counts: Mapping[str, int]


def carry_out(
    base: DataFrame,
    changes: DataFrame,
    rules: Rules,
    op: str,
    seq: str | None = None,
    ignore_null: bool = False,
) -> Outcome:
    """Judge one batch. The batch and its judged keys are written once; counts are taken while writing."""
    given = seq
    changes = align(base, changes, extra=[seq] if seq else [])
    changes, seq = in_arrival_order(changes, seq)
    arrived = materialize(changes, "arrived")
    counted = Observation()
    judged = judge(base, arrived, rules, op, seq, ignore_null)
    judged = materialize(judged.observe(counted, *_tally(arrived, rules, op)), "judged")
    errors = refused_rows(arrived, judged, rules, op, seq, ignore_null)
    return Outcome(
        _delta(base, arrived, judged, rules, op, ignore_null),
        errors if given else errors.drop(seq),
        {"incoming": counted.get["incoming"], "applied": counted.get["applied"]},
    )


def apply_ops(
    base: DataFrame,
    changes: DataFrame,
    rules: Rules,
    op: str,
    seq: str | None = None,
    ignore_null: bool = False,
) -> Applied:
    """One batch against a table. Refused rows never undo the rest of the batch."""
    done = carry_out(base, changes, rules, op, seq, ignore_null)
    counts = base.sparkSession.createDataFrame(
        [(op, done.counts["incoming"], done.counts["applied"])], "op string, incoming bigint, applied bigint"
    )
    return Applied(merge(base, done.delta, rules.keys), done.errors, counts)


def apply_feed(
    base: DataFrame, feed: DataFrame, keys: Sequence[str], action: str, seq: str
) -> DataFrame:
    """A feed whose rows say themselves whether they put (0 or null) or delete (1)."""
    last = last_changes(feed, keys, seq)
    op = F.coalesce(F.col(action), F.lit(PUT)).cast("byte").alias("_op")
    return merge(base, last.select(*base.columns, op), keys)


def update_where(
    df: DataFrame, predicate: Column, values: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """Set columns on the rows that meet the predicate. Key values are never updated."""
    if set(values) & set(keys):
        raise ValueError("key columns cannot be updated")
    met = F.coalesce(predicate, F.lit(False))
    cells = {
        c: F.when(met, v.cast(df.schema[c].dataType)).otherwise(F.col(c)) for c, v in values.items()
    }
    return df.withColumns(cells)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def auto_increment(
    existing: DataFrame,
    rows: DataFrame,
    within: Sequence[str],
    order_by: Sequence[str],
    name: str = "auto_incrementing_id",
) -> DataFrame:
    """Number new rows upwards from the highest stored number of their partition.

    Makes a non-unique key unique; only inserts make sense on such a table.
    """
    highest = existing.groupBy(*within).agg(F.max(name).alias("_highest"))
    numbered = number_rows(rows, order_by, name, within=within)
    # A null partition is one partition, as it is for the numbering.
    match = F.lit(True)
    for i, c in enumerate(within):
        highest = highest.withColumnRenamed(c, f"_within{i}")
        match = match & numbered[c].eqNullSafe(F.col(f"_within{i}"))
    return numbered.join(highest, match, "left").select(
        *rows.columns, (F.col(name) + F.coalesce(F.col("_highest"), F.lit(0))).alias(name)
    )
