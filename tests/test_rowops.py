"""Row operations against a plain dictionary."""

import random

import pytest
from pyspark.sql import functions as F

from olapkit.operators import rowops
from olapkit.operators.rowops import Rules
from olapkit.workspace import materialize

SCHEMA = "k INT, a STRING, b INT"


def rows_of(df):
    return {r["k"]: (r["a"], r["b"]) for r in df.collect()}


def expected(state, changes, op, immutable=()):
    """Sequential semantics of one batch; returns (state, refused (k, seq, error))."""
    state, refused = dict(state), []
    for k, a, b, seq in sorted(changes, key=lambda c: c[3]):
        kind, ignore = op.replace("_ignore", ""), op.endswith("_ignore")
        if k is None:
            refused.append((k, seq, "NULL_KEY"))
        elif kind == "insert":
            if k in state:
                if not ignore:
                    refused.append((k, seq, "ALREADY_PRESENT"))
            else:
                state[k] = (a, b)
        elif kind == "delete":
            if state.pop(k, None) is None and not ignore:
                refused.append((k, seq, "NOT_FOUND"))
        elif kind == "update":
            if k not in state:
                if not ignore:
                    refused.append((k, seq, "NOT_FOUND"))
            elif "a" in immutable:
                if ignore:
                    state[k] = (state[k][0], b)
                else:
                    refused.append((k, seq, "IMMUTABLE"))
            else:
                state[k] = (a, b)
        elif k in state and "a" in immutable:
            if ignore:
                state[k] = (state[k][0], b)
            else:
                refused.append((k, seq, "IMMUTABLE"))
        else:
            state[k] = (a, b)
    return state, refused


@pytest.mark.parametrize("immutable", [(), ("a",)])
@pytest.mark.parametrize("op", rowops.OPS)
def test_batches_like_one_row_at_a_time(spark, op, immutable):
    rng = random.Random(op + str(immutable))
    state = {k: (f"s{k}", k) for k in rng.sample(range(40), 20)}
    # A third of the batch is one key.
    keys = [7] * 20 + [rng.randrange(40) for _ in range(38)] + [None, None]
    rng.shuffle(keys)
    changes = [(k, f"n{i}", 100 + i, i) for i, k in enumerate(keys)]
    base = spark.createDataFrame([(k, *v) for k, v in state.items()], SCHEMA)
    frame = spark.createDataFrame(changes, "k INT, a STRING, b INT, seq INT")
    if op.startswith("delete"):
        frame = frame.drop("a", "b")
    rules = Rules(keys=("k",), immutable=immutable)
    done = rowops.apply_ops(base, frame, rules, op, "seq")
    want, refused = expected(state, changes, op, immutable)
    assert rows_of(done.state) == want
    got = [(r["k"], r["seq"], r["error"]) for r in done.errors.collect()]
    assert sorted(got, key=str) == sorted(refused, key=str)
    counts = done.counts.first()
    assert counts["incoming"] == len(changes)
    if not op.endswith("_ignore"):
        assert counts["applied"] == len(changes) - len(refused)


def test_ignore_null_keeps_stored_values(spark):
    base = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], SCHEMA)
    changes = spark.createDataFrame(
        [(1, None, 5, 1), (1, "z", None, 2), (3, None, 9, 1)], "k INT, a STRING, b INT, seq INT"
    )
    done = rowops.apply_ops(base, changes, Rules(keys=("k",)), "upsert", "seq", ignore_null=True)
    assert rows_of(done.state) == {1: ("z", 5), 2: ("y", 2), 3: (None, 9)}


def test_required_columns_and_defaults(spark):
    base = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    keys = spark.createDataFrame([(1,), (2,)], "k INT")
    rules = Rules(keys=("k",), required=("a",))
    done = rowops.apply_ops(base, keys, rules, "insert")
    assert rows_of(done.state) == {1: ("x", 1)}
    assert {r["error"] for r in done.errors.collect()} == {"MISSING_VALUE"}
    filled = Rules(keys=("k",), required=("a",), defaults={"a": "d", "b": 4})
    assert rows_of(rowops.apply_ops(base, keys, filled, "insert").state) == {
        1: ("x", 1),
        2: ("d", 4),
    }
    # An upsert may leave a required column of a stored row alone, but cannot add a row without it.
    values = spark.createDataFrame([(1, 8), (2, 9)], "k INT, b INT")
    done = rowops.apply_ops(base, values, rules, "upsert")
    assert rows_of(done.state) == {1: ("x", 8)}
    assert [(r["k"], r["error"]) for r in done.errors.collect()] == [(2, "MISSING_VALUE")]


def test_refused_shapes(spark):
    base = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    rules = Rules(keys=("k",))
    with pytest.raises(ValueError):
        rowops.plan_change(base, base, rules, "delete")
    with pytest.raises(ValueError):
        rowops.plan_change(base, base.select("k"), rules, "update")
    with pytest.raises(ValueError):
        rowops.plan_change(base, base.select("a"), rules, "insert")
    with pytest.raises(TypeError):
        rowops.plan_change(base, base.withColumn("b", F.lit("1")), rules, "upsert")
    with pytest.raises(ValueError):
        rowops.update_where(base, F.lit(True), {"k": F.lit(2)}, keys=["k"])


def test_feed_of_puts_and_deletes(spark):
    base = spark.createDataFrame([(1, "x", 1), (2, "y", 2)], SCHEMA)
    feed = spark.createDataFrame(
        [(1, "n", 3, 1, 0), (1, None, None, 2, 1), (2, "m", 4, 1, None), (9, None, None, 1, 1)],
        "k INT, a STRING, b INT, seq INT, act INT",
    )
    assert rows_of(rowops.apply_feed(base, feed, ["k"], "act", "seq")) == {2: ("m", 4)}


def test_small_batch_leaves_the_table_in_place(spark):
    """A broadcastable batch must not shuffle the table."""
    base = spark.range(1000).selectExpr("CAST(id AS INT) k", "'x' a", "1 b")
    changes = materialize(spark.createDataFrame([(3, "n", 2)], SCHEMA), "changes")
    for op in ("upsert", "update", "insert"):
        delta = rowops.plan_change(base, changes, Rules(keys=("k",)), op)
        plan = rowops.merge(base, delta, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan, op


def test_file_rows_count_in_file_order_after_any_shuffle(spark, tmp_path):
    path = str(tmp_path / "deliveries")
    for turn in range(3):
        rows = spark.range(400).selectExpr("CAST(id % 37 AS INT) k", f"concat('{turn}-', id) a", "CAST(id AS INT) b")
        rows.coalesce(1).write.mode("append").parquet(path)
    base = spark.createDataFrame([], SCHEMA)
    last = {k: f"2-{max(i for i in range(400) if i % 37 == k)}" for k in range(37)}
    first = {k: f"0-{k}" for k in range(37)}
    for pieces, by in ((1, "a"), (7, "b"), (5, "k")):
        batch = spark.read.parquet(path).repartition(pieces, by).filter("b >= 0")
        for op, want in (("upsert", last), ("insert_ignore", first)):
            ordered, seq = rowops.in_arrival_order(batch, None)
            delta = rowops.plan_change(base, ordered, Rules(keys=("k",)), op, seq)
            assert {r["k"]: r["a"] for r in delta.collect()} == want


def test_rows_without_files_come_as_spark_hands_them_over(spark):
    batch = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], SCHEMA)
    assert rowops.file_position(batch) is None
    done = rowops.apply_ops(batch.limit(0), batch, Rules(keys=("k",)), "upsert")
    assert rows_of(done.state) == {1: ("y", 2)}


@pytest.mark.parametrize("op", ["insert", "update", "upsert_ignore", "delete"])
def test_inputs_are_read_at_most_twice(spark, tmp_path, op):
    """What follows from a judged batch reads neither the batch again, nor the table but for the new state."""
    stored, batch = str(tmp_path / "stored"), str(tmp_path / "batch")
    spark.range(50).selectExpr("CAST(id AS INT) k", "'s' a", "1 b").write.parquet(stored)
    spark.range(30, 90).selectExpr("CAST(id AS INT) k", "'n' a", "2 b", "id seq").write.parquet(batch)
    changes = spark.read.parquet(batch)
    changes = changes.select("k", "seq") if op == "delete" else changes
    done = rowops.apply_ops(spark.read.parquet(stored), changes, Rules(keys=("k",), immutable=("a",)), op, "seq")
    for frame, of_table in ((done.state, 1), (done.errors, 0)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count(f"[file:{stored}]") == of_table and f"[file:{batch}]" not in plan, plan


def test_a_hot_key_of_refused_rows(spark, monkeypatch):
    monkeypatch.setattr(rowops, "HOT_ROWS", 10)
    base = spark.createDataFrame([(1, "x", 1)], SCHEMA)
    batch = spark.createDataFrame([(1 if i % 3 else i, "n", i, i) for i in range(300)], "k INT, a STRING, b INT, seq INT")
    done = rowops.apply_ops(base, batch, Rules(keys=("k",)), "insert", "seq")
    want = sorted(i for i in range(300) if i % 3)
    assert sorted(r["seq"] for r in done.errors.collect()) == want
    assert done.counts.first().asDict() == {"op": "insert", "incoming": 300, "applied": 100}
