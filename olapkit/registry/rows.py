"""Data quality checks and row operations on a keyed table."""

from pyspark.sql import functions as F

from olapkit.operators import quality, rowops
from olapkit.operators.rowops import Rules
from olapkit.plans import sales
from olapkit.registry.base import query

# Data quality

REFUSED_SQL = "SELECT c_custkey FROM customer WHERE c_acctbal < 0"


def refused(t):
    return quality.reject(t.customer, F.col("c_acctbal") < 0, ["c_custkey"])


@query(
    "reject_rows",
    """
    SELECT 'kept' AS part, c_custkey FROM customer WHERE NOT coalesce(c_acctbal < 0, false)
    UNION ALL SELECT 'rejected', c_custkey FROM customer WHERE c_acctbal < 0
    """,
)
def reject_rows(t):
    kept, lost = refused(t)
    return kept.select(F.lit("kept").alias("part"), "c_custkey").unionAll(
        lost.select(F.lit("rejected").alias("part"), "c_custkey")
    )


@query(
    "cascade_clean",
    f"""
    WITH lost AS (SELECT o_orderkey FROM orders WHERE o_custkey IN ({REFUSED_SQL}))
    SELECT 'orders' AS table_name, o_orderkey AS order_key, NULL AS line FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM lost)
    UNION ALL
    SELECT 'lineitem', l_orderkey, l_linenumber FROM lineitem
    WHERE l_orderkey NOT IN (SELECT o_orderkey FROM lost)
    """,
)
def cascade_clean(t):
    _, customers = refused(t)
    orders, lost = quality.cascade(customers, t.orders, "o_custkey", ["o_orderkey"])
    lines, _ = quality.cascade(lost, t.lineitem, "l_orderkey", ["l_orderkey", "l_linenumber"])
    return orders.select(
        F.lit("orders").alias("table_name"),
        F.col("o_orderkey").alias("order_key"),
        F.lit(None).cast("int").alias("line"),
    ).unionAll(lines.select(F.lit("lineitem"), "l_orderkey", "l_linenumber"))


@query(
    "pk_violations",
    """
    WITH l AS (SELECT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS l_orderkey, l_linenumber FROM lineitem)
    SELECT l_orderkey, l_linenumber, count(*) AS rows,
           CASE WHEN l_orderkey IS NULL THEN 'null' ELSE 'duplicate' END AS reason
    FROM l GROUP BY ALL HAVING count(*) > 1 OR l_orderkey IS NULL
    """,
)
def pk_violations(t):
    key = F.when(F.col("l_returnflag") != "R", F.col("l_orderkey"))
    lines = t.lineitem.withColumn("l_orderkey", key)
    return quality.primary_key_violations(lines, ["l_orderkey", "l_linenumber"])


@query(
    "fk_violations",
    f"""
    SELECT o_custkey, count(*) AS rows FROM orders
    WHERE o_custkey IN ({REFUSED_SQL}) GROUP BY o_custkey
    """,
)
def fk_violations(t):
    kept, _ = refused(t)
    return quality.foreign_key_violations(t.orders, "o_custkey", kept, "c_custkey")


@query(
    "clean_report",
    f"""
    SELECT 'orders' AS table_name, count(*) AS rows_before,
           count(*) FILTER (o_custkey NOT IN ({REFUSED_SQL})) AS rows_after,
           count(*) FILTER (o_custkey IN ({REFUSED_SQL})) AS rows_removed FROM orders
    """,
)
def clean_report(t):
    return quality.clean_report("orders", t.orders, "o_custkey", refused(t)[1])


# Row operations: the table knows the orders up to 1999, a batch brings those from
# 1998 on, the urgent ones twice. Together they are all orders.

COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]
RULES = Rules(keys=("o_orderkey",))

BATCH_SQL = """
WITH base AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < DATE '2000-01-01'),
keys AS (SELECT o_orderkey FROM base),
recent AS (SELECT * FROM orders WHERE o_orderdate >= DATE '1998-01-01'),
batch AS (
  SELECT o_orderkey, o_custkey + 1 AS o_custkey, 'N' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, 1 AS seq
  FROM recent
  UNION ALL
  SELECT o_orderkey, o_custkey + 2, 'M', o_totalprice + 2, 2 FROM recent WHERE o_orderpriority = '1-URGENT'),
last AS (SELECT * FROM batch QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY seq DESC) = 1),
first AS (SELECT * FROM batch WHERE seq = 1)
"""


def base(t):
    return t.orders.filter(F.col("o_orderdate") < sales.day("2000-01-01")).select(*COLUMNS)


def recent(t, *more):
    rows = t.orders.filter(F.col("o_orderdate") >= sales.day("1998-01-01"))
    return rows.select(*COLUMNS, *more)


def batch(t):
    def copy(rows, status, n):
        return rows.select(
            "o_orderkey",
            (F.col("o_custkey") + n).alias("o_custkey"),
            F.lit(status).alias("o_orderstatus"),
            (F.col("o_totalprice") + n).alias("o_totalprice"),
            F.lit(n).alias("seq"),
        )

    rows = recent(t, "o_orderpriority")
    urgent = rows.filter(F.col("o_orderpriority") == "1-URGENT")
    return copy(rows, "N", 1).unionAll(copy(urgent, "M", 2))


def outcome(applied):
    """State rows, then refused rows."""
    return applied.state.unionByName(applied.errors, allowMissingColumns=True)


@query(
    "op_insert",
    BATCH_SQL
    + """
    SELECT *, NULL::INT AS seq, NULL AS error FROM base
    UNION ALL SELECT * EXCLUDE seq, NULL, NULL FROM first WHERE o_orderkey NOT IN (FROM keys)
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL, seq, 'ALREADY_PRESENT' FROM batch
              WHERE o_orderkey IN (FROM keys) OR seq > 1
    """,
)
def op_insert(t):
    return outcome(rowops.apply_ops(base(t), batch(t), RULES, "insert", "seq"))


@query(
    "op_insert_ignore",
    BATCH_SQL
    + """
    SELECT *, NULL::INT AS seq, NULL::VARCHAR AS error FROM base
    UNION ALL SELECT * EXCLUDE seq, NULL, NULL FROM first WHERE o_orderkey NOT IN (FROM keys)
    """,
)
def op_insert_ignore(t):
    return outcome(rowops.apply_ops(base(t), batch(t), RULES, "insert_ignore", "seq"))


@query(
    "op_update",
    BATCH_SQL
    + """
    SELECT b.o_orderkey, b.o_custkey, coalesce(l.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
           coalesce(l.o_totalprice, b.o_totalprice) AS o_totalprice, NULL::INT AS seq, NULL AS error
    FROM base b LEFT JOIN last l USING (o_orderkey)
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL, seq, 'NOT_FOUND' FROM batch WHERE o_orderkey NOT IN (FROM keys)
    """,
)
def op_update(t):
    return outcome(
        rowops.apply_ops(base(t), batch(t).drop("o_custkey"), RULES, "update", "seq")
    )


@query(
    "op_update_ignore",
    BATCH_SQL
    + """
    SELECT b.o_orderkey, b.o_custkey, coalesce(l.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
           coalesce(l.o_totalprice, b.o_totalprice) AS o_totalprice
    FROM base b LEFT JOIN last l USING (o_orderkey)
    """,
)
def op_update_ignore(t):
    rules = Rules(keys=("o_orderkey",), immutable=("o_custkey",))
    return rowops.apply_ops(base(t), batch(t), rules, "update_ignore", "seq").state


@query(
    "op_upsert",
    BATCH_SQL
    + """
    SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last)
    UNION ALL SELECT * EXCLUDE seq FROM last
    """,
)
def op_upsert(t):
    return rowops.apply_ops(base(t), batch(t), RULES, "upsert", "seq").state


@query(
    "op_upsert_ignore",
    BATCH_SQL
    + """
    SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last)
    UNION ALL
    SELECT l.o_orderkey, coalesce(b.o_custkey, f.o_custkey), l.o_orderstatus, l.o_totalprice
    FROM last l LEFT JOIN base b USING (o_orderkey) JOIN first f USING (o_orderkey)
    """,
)
def op_upsert_ignore(t):
    rules = Rules(keys=("o_orderkey",), immutable=("o_custkey",))
    return rowops.apply_ops(base(t), batch(t), rules, "upsert_ignore", "seq").state


@query(
    "op_delete",
    BATCH_SQL
    + """
    SELECT *, NULL::INT AS seq, NULL AS error FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL, seq, 'NOT_FOUND' FROM batch
              WHERE o_orderkey NOT IN (FROM keys) OR seq > 1
    """,
)
def op_delete(t):
    keys = batch(t).select("o_orderkey", "seq")
    return outcome(rowops.apply_ops(base(t), keys, RULES, "delete", "seq"))


@query(
    "op_delete_ignore",
    BATCH_SQL + "SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)",
)
def op_delete_ignore(t):
    keys = batch(t).select("o_orderkey", "seq")
    return rowops.apply_ops(base(t), keys, RULES, "delete_ignore", "seq").state


@query(
    "upsert_ignore_null",
    BATCH_SQL
    + """
    , ch AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'N' END AS o_orderstatus,
                    CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 END AS o_totalprice FROM recent)
    SELECT o_orderkey, b.o_custkey, coalesce(ch.o_orderstatus, b.o_orderstatus) AS o_orderstatus,
           coalesce(ch.o_totalprice, b.o_totalprice) AS o_totalprice
    FROM base b FULL JOIN ch USING (o_orderkey)
    """,
)
def upsert_ignore_null(t):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    done = F.col("o_orderstatus") == "F"
    changes = recent(t, "o_orderpriority").select(
        "o_orderkey",
        F.when(urgent, "N").alias("o_orderstatus"),
        F.when(done, F.col("o_totalprice") + 1).alias("o_totalprice"),
    )
    return rowops.apply_ops(base(t), changes, RULES, "upsert", ignore_null=True).state


@query(
    "insert_defaults",
    BATCH_SQL
    + """
    SELECT *, NULL AS error FROM base
    UNION ALL
    SELECT o_orderkey, o_custkey, 'O', NULL, NULL FROM recent
    WHERE o_orderkey NOT IN (FROM keys) AND o_orderpriority <> '5-LOW'
    UNION ALL
    SELECT o_orderkey, NULL, NULL, NULL, CASE WHEN o_orderpriority = '5-LOW' THEN 'MISSING_VALUE' ELSE 'ALREADY_PRESENT' END
    FROM recent WHERE o_orderpriority = '5-LOW' OR o_orderkey IN (FROM keys)
    """,
)
def insert_defaults(t):
    rules = Rules(
        keys=("o_orderkey",), required=("o_custkey", "o_orderstatus"), defaults={"o_orderstatus": "O"}
    )
    known = F.col("o_orderpriority") != "5-LOW"
    changes = recent(t, "o_orderpriority").select(
        "o_orderkey", F.when(known, F.col("o_custkey")).alias("o_custkey")
    )
    return outcome(rowops.apply_ops(base(t), changes, rules, "insert"))


@query("dedup_changes", BATCH_SQL + "SELECT * EXCLUDE seq FROM last")
def dedup_changes(t):
    return rowops.last_changes(batch(t), ["o_orderkey"], "seq")


@query(
    "schema_drift",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CASE WHEN o_orderdate >= DATE '1998-01-01' THEN o_orderpriority END AS o_orderpriority
    FROM orders
    """,
)
def schema_drift(t):
    changes = recent(t, "o_orderpriority")
    table = rowops.widen(base(t), rowops.align(base(t), changes, drift=True))
    return rowops.apply_ops(table, changes, RULES, "upsert").state


@query(
    "type_check",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, true AS wrong_type_refused FROM orders
    """,
)
def type_check(t):
    wide = recent(t, "o_orderpriority")
    try:
        rowops.align(base(t), wide.withColumn("o_custkey", F.col("o_custkey").cast("string")))
        refused_type = False
    except TypeError:
        refused_type = True
    # The extra column is left out, as drift is off.
    state = rowops.apply_ops(base(t), wide, RULES, "upsert").state
    return state.withColumn("wrong_type_refused", F.lit(refused_type))


@query(
    "null_key_errors",
    """
    SELECT error, count(*) AS n FROM (
      SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'NULL_KEY'
                  WHEN o_orderdate < DATE '2000-01-01' THEN 'ALREADY_PRESENT' END AS error
      FROM orders) WHERE error IS NOT NULL GROUP BY error
    """,
)
def null_key_errors(t):
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey"))
    changes = t.orders.select(key.alias("o_orderkey"), "o_custkey")
    errors = rowops.row_errors(base(t), changes, RULES, "insert")
    return errors.groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query(
    "auto_increment",
    """
    WITH old AS (SELECT o_custkey, o_orderkey,
                        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS auto_incrementing_id
                 FROM orders WHERE o_orderdate < DATE '1998-01-01'),
    top AS (SELECT o_custkey, max(auto_incrementing_id) AS m FROM old GROUP BY 1)
    SELECT * FROM old
    UNION ALL
    SELECT o_custkey, o_orderkey,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) + coalesce(m, 0)
    FROM orders LEFT JOIN top USING (o_custkey) WHERE o_orderdate >= DATE '1998-01-01'
    """,
)
def auto_increment(t):
    columns = ["o_custkey", "o_orderkey"]
    early = t.orders.filter(F.col("o_orderdate") < sales.day("1998-01-01")).select(*columns)
    none = early.limit(0).withColumn("auto_incrementing_id", F.lit(0).cast("long"))
    old = rowops.auto_increment(none, early, ["o_custkey"], ["o_orderkey"])
    late = recent(t).select(*columns)
    return old.unionByName(rowops.auto_increment(old, late, ["o_custkey"], ["o_orderkey"]))


@query(
    "update_where",
    """
    SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 250000 THEN 'B' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_totalprice > 250000 THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice
    FROM orders
    """,
)
def update_where(t):
    return rowops.update_where(
        t.orders.select(*COLUMNS),
        F.col("o_totalprice") > 250000,
        {"o_orderstatus": F.lit("B"), "o_totalprice": F.col("o_totalprice") - 1},
        keys=["o_orderkey"],
    )


@query(
    "delete_where",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
    WHERE NOT coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END > 250000, false)
    """,
)
def delete_where(t):
    price = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice"))
    return rowops.delete_where(t.orders, price > 250000).select(*COLUMNS)


@query(
    "op_counts",
    BATCH_SQL
    + """
    SELECT 'insert' AS op, count(*) AS incoming, count(DISTINCT o_orderkey) FILTER (o_orderkey NOT IN (FROM keys)) AS applied FROM batch
    UNION ALL SELECT 'update', count(*), count(*) FILTER (o_orderkey IN (FROM keys)) FROM batch
    UNION ALL SELECT 'upsert', count(*), count(*) FROM batch
    UNION ALL SELECT 'delete', count(*), count(DISTINCT o_orderkey) FILTER (o_orderkey IN (FROM keys)) FROM batch
    """,
)
def op_counts(t):
    keys = batch(t).select("o_orderkey", "seq")
    out = rowops.op_counts(base(t), batch(t), RULES, "insert", "seq")
    out = out.unionAll(rowops.op_counts(base(t), batch(t), RULES, "update", "seq"))
    out = out.unionAll(rowops.op_counts(base(t), batch(t), RULES, "upsert", "seq"))
    return out.unionAll(rowops.op_counts(base(t), keys, RULES, "delete", "seq"))


@query(
    "apply_feed",
    BATCH_SQL
    + """
    SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last)
    UNION ALL SELECT * EXCLUDE seq FROM last WHERE seq = 1
    """,
)
def apply_feed(t):
    # The second row of an urgent order deletes it.
    feed = batch(t).withColumn("row_action", F.when(F.col("seq") == 2, 1).cast("byte"))
    return rowops.apply_feed(base(t), feed, ["o_orderkey"], "row_action", "seq")
