"""Files, keyed tables with history, and backups."""

from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from olapkit.operators.numbering import number_rows, split_batches
from olapkit.plans.tables import LINEITEM_DATES_SQL
from olapkit.registry.base import query, rounded
from olapkit.registry.rows import BATCH_SQL, COLUMNS, base, batch, recent
from olapkit.schemas import LINEITEM
from olapkit.sources import backups, bucketed, files
from olapkit.sources import keyed_table as kt
from olapkit.sources.keyed_table import KeyedTable
from olapkit.workspace import materialize, new_path

# Files

PART_DDL = "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE"


def part_csv(t, header=True):
    path = new_path(t.spark, "part-csv")
    files.write_delimited(t.part, path, header=header)
    return path


@query("read_csv_typed", "SELECT * FROM part")
def read_csv_typed(t):
    return files.read_delimited(t.spark, part_csv(t), PART_DDL)


@query(
    "read_csv_strings",
    "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, TRY_CAST(p_size AS INTEGER) AS p_size FROM part",
)
def read_csv_strings(t):
    rows = files.read_delimited(t.spark, part_csv(t))
    return rows.select("p_partkey", "p_name", F.col("p_size").try_cast("int").alias("p_size"))


@query("read_csv_infer", "SELECT * FROM part")
def read_csv_infer(t):
    rows = files.read_delimited(t.spark, part_csv(t), infer=True)
    return rows.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query(
    "repair_header",
    """
    SELECT 'replaced' AS kind, CAST(p_partkey AS VARCHAR) AS key, p_name AS label FROM part
    UNION ALL SELECT 'inserted', CAST(p_partkey AS VARCHAR), p_name FROM part
    """,
)
def repair_header(t):
    names = ["key", "label", "brand", "kind_of", "size", "price"]
    replaced = files.repair_header(t.spark, part_csv(t), names, has_header=True)
    inserted = files.repair_header(t.spark, part_csv(t, header=False), names, has_header=False)
    return replaced.select(F.lit("replaced").alias("kind"), "key", "label").unionAll(
        inserted.select(F.lit("inserted"), "key", "label")
    )


@query(
    "read_tbl",
    f"""
    SELECT l_orderkey::INT AS l_orderkey, l_linenumber, l_partkey::INT AS l_partkey,
           l_quantity::INT AS l_quantity, l_extendedprice::FLOAT::DOUBLE AS l_extendedprice,
           l_returnflag, l_shipdate, l_receiptdate, l_shipmode
    FROM ({LINEITEM_DATES_SQL})
    """,
)
def read_tbl(t):
    lines = t.lineitem_dates.withColumn("l_quantity", F.col("l_quantity").cast("int"))
    # Columns the test data lacks are empty fields of the file.
    cells = [F.col(c) if c in lines.columns else F.lit(None).cast("string").alias(c) for c in LINEITEM.names]
    path = new_path(t.spark, "lineitem-tbl")
    files.write_tbl(lines.select(*cells), path)
    rows = files.read_tbl(t.spark, path)
    return rows.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_quantity",
        F.col("l_extendedprice").cast("double").alias("l_extendedprice"),
        "l_returnflag",
        "l_shipdate",
        "l_receiptdate",
        "l_shipmode",
    )


@query("clustered_write", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey")
def clustered_write(t):
    path = new_path(t.spark, "clustered")
    files.clustered_write(t.orders, ["o_custkey"], 8, path)
    stored = t.spark.read.parquet(path)
    return stored.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))


@query("bucketed_layout", "SELECT o_custkey, count(*) AS n, 1 AS files, true AS placed FROM orders GROUP BY o_custkey")
def bucketed_layout(t):
    path = new_path(t.spark, "bucketed")
    bucketed.write_bucketed(t.orders, path, ["o_custkey"], 8)
    layout = bucketed.bucket_layout(t.spark.read.parquet(path), ["o_custkey"], 8)
    keys = t.spark.read.parquet(path).groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("_metadata.file_name").alias("files")
    )
    bad = layout.filter((F.col("files") != 1) | (F.col("misplaced") > 0)).select("bucket", F.lit(False).alias("placed"))
    placed = keys.withColumn("bucket", bucketed.bucket_of(["o_custkey"], 8)).join(bad, "bucket", "left")
    return placed.select("o_custkey", "n", "files", F.coalesce("placed", F.lit(True)).alias("placed"))


@query(
    "bucketed_join",
    """
    SELECT o_orderkey, o_custkey, count(*) AS lines, round(sum(l_extendedprice), 2) AS total
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY ALL
    """,
)
def bucketed_join(t):
    orders, lines = new_path(t.spark, "bucketed"), new_path(t.spark, "bucketed")
    bucketed.write_bucketed(t.orders, orders, ["o_orderkey"], 8)
    bucketed.write_bucketed(t.lineitem, lines, ["l_orderkey"], 8)
    left, right = (bucketed.read_bucketed(t.spark, p) for p in (orders, lines))
    # Neither the join nor the grouping by the same key shuffles.
    joined = left.join(right.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    grouped = joined.groupBy("o_orderkey", "o_custkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_extendedprice").alias("total")
    )
    return rounded(grouped, 2, "total")


@query(
    "split_batches",
    "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch FROM orders",
)
def batches(t):
    return split_batches(t.orders.select("o_orderkey"), 1000, ["o_orderkey"])


@query(
    "save_modes",
    """
    SELECT 'append' AS mode, 2 * count(*) AS n FROM part UNION ALL SELECT 'overwrite', count(*) FROM part
    UNION ALL SELECT 'errorifexists refused', count(*) FROM part
    UNION ALL SELECT 'keyed overwrite refused', count(*) FROM part
    """,
)
def save_modes(t):
    out = []

    def stored(label, path):
        n = F.count(F.lit(1)).alias("n")
        out.append(t.spark.read.parquet(path).agg(n).select(F.lit(label).alias("mode"), "n"))

    for mode in ("append", "overwrite"):
        path = new_path(t.spark, "saved")
        files.save(t.part, path)
        files.save(t.part, path, mode)
        stored(mode, path)
    path = new_path(t.spark, "saved")
    files.save(t.part, path)
    try:
        files.save(t.part, path)
        stored("errorifexists accepted", path)
    except Exception:
        stored("errorifexists refused", path)
    table = KeyedTable.create_as(t.part, new_path(t.spark, "table"), ["p_partkey"])
    try:
        kt.save_table(t.part, table, "overwrite")
        label = "keyed overwrite accepted"
    except ValueError:
        label = "keyed overwrite refused"
    n = F.count(F.lit(1)).alias("n")
    out.append(table.latest().agg(n).select(F.lit(label).alias("mode"), "n"))
    return out[0].unionAll(out[1]).unionAll(out[2]).unionAll(out[3])


@query(
    "import_upsert",
    BATCH_SQL
    + """
    SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last)
    UNION ALL SELECT * EXCLUDE seq FROM last
    """,
)
def import_upsert(t):
    table = orders_table(t)
    once, twice = (batch(t).filter(F.col("seq") == n).drop("seq") for n in (1, 2))
    text, binary = new_path(t.spark, "in-csv"), new_path(t.spark, "in-parquet")
    files.write_delimited(once, text)
    twice.write.parquet(binary)
    kt.import_table(table, text, "csv", header=True)
    kt.import_table(table, binary, "parquet")
    return table.latest()


@query(
    "export_roundtrip",
    """
    SELECT fmt, o_orderkey, o_totalprice FROM orders, (VALUES ('csv'), ('parquet')) f(fmt)
    """,
)
def export_roundtrip(t):
    table, columns = all_orders(t), ["o_totalprice", "o_orderkey"]
    text, binary = new_path(t.spark, "out-csv"), new_path(t.spark, "out-parquet")
    kt.export_table(table, text, "csv", columns, header=True)
    kt.export_table(table, binary, "parquet", columns)
    back = files.read_delimited(t.spark, text, "o_totalprice DOUBLE, o_orderkey BIGINT")
    return back.select(F.lit("csv").alias("fmt"), "o_orderkey", "o_totalprice").unionAll(
        t.spark.read.parquet(binary).select(F.lit("parquet"), "o_orderkey", "o_totalprice")
    )


# Keyed tables

def orders_table(t, **options):
    path = new_path(t.spark, "table")
    return KeyedTable.create_as(base(t), path, ["o_orderkey"], ts=100, name="orders", **options)


def all_orders(t, path=None):
    path = path or new_path(t.spark, "table")
    return KeyedTable.create_as(t.orders.select(*COLUMNS), path, ["o_orderkey"], name="orders")


def of_priority(t, priority):
    return t.orders.filter(F.col("o_orderpriority") == priority)


def reinserted(t):
    rows = of_priority(t, "2-HIGH").filter(F.col("o_orderstatus") == "F").select(*COLUMNS)
    return rows.withColumn("o_orderstatus", F.lit("R"))


def history(t):
    """Time 100 base, 200 the batch, 300 high priorities deleted, 400 their closed orders back."""
    table = orders_table(t)
    table.write("upsert", batch(t), ts=200, seq="seq")
    table.write("delete_ignore", of_priority(t, "2-HIGH").select("o_orderkey"), ts=300)
    table.write("upsert", reinserted(t), ts=400)
    return table


HISTORY_SQL = (
    BATCH_SQL
    + """,
at200 AS (SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last)
          UNION ALL SELECT * EXCLUDE seq FROM last),
high AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH'),
at300 AS (SELECT * FROM at200 WHERE o_orderkey NOT IN (FROM high)),
back AS (SELECT o_orderkey, o_custkey, 'R' AS o_orderstatus, o_totalprice FROM orders
         WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'),
gone AS (SELECT * FROM at200 WHERE o_orderkey IN (FROM high) AND o_orderkey NOT IN (SELECT o_orderkey FROM back)),
at400 AS (SELECT * FROM at300 UNION ALL SELECT * FROM back)
"""
)


@query("ctas", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def ctas(t):
    table = orders_table(t)
    table.write("insert_ignore", recent(t))
    return table.latest()


@query(
    "write_reported",
    BATCH_SQL
    + """
    SELECT 'stored' AS part, o_orderkey, seq, o_totalprice, NULL AS error FROM (
      SELECT o_orderkey, NULL::INT AS seq, o_totalprice FROM base
      UNION ALL SELECT o_orderkey, NULL, o_totalprice FROM first WHERE o_orderkey NOT IN (FROM keys))
    UNION ALL SELECT 'refused', o_orderkey, seq, NULL, 'ALREADY_PRESENT' FROM batch
              WHERE o_orderkey IN (FROM keys) OR seq > 1
    """,
)
def write_reported(t):
    table = orders_table(t)
    written = table.write_reported("insert", batch(t), seq="seq")
    # Read after the write: the rows are judged against the state before it.
    stored = table.latest().select(F.lit("stored").alias("part"), "o_orderkey", "o_totalprice")
    refused = written.refused.select(F.lit("refused").alias("part"), "*")
    return stored.unionByName(refused, allowMissingColumns=True)


@query(
    "write_counts",
    BATCH_SQL
    + """
    SELECT 'insert' AS op, count(*) AS incoming, count(DISTINCT o_orderkey) FILTER (o_orderkey NOT IN (FROM keys)) AS applied FROM batch
    UNION ALL SELECT 'update', count(*), count(*) FROM batch
    UNION ALL SELECT 'delete', count(*), count(DISTINCT o_orderkey) FROM batch
    """,
)
def write_counts(t):
    table, rows = orders_table(t), []
    for op, changes in (("insert", batch(t)), ("update", batch(t)), ("delete", batch(t).select("o_orderkey", "seq"))):
        counts = table.write_reported(op, changes, seq="seq").counts
        rows.append((op, counts["incoming"], counts["applied"]))
    return t.spark.createDataFrame(rows, "op string, incoming bigint, applied bigint")


@query(
    "arrival_order",
    BATCH_SQL
    + """
    SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last)
    UNION ALL SELECT * EXCLUDE seq FROM last
    """,
)
def arrival_order(t):
    # Keys repeat across the files of two deliveries; the shuffle mixes them before the write.
    table, path = orders_table(t), new_path(t.spark, "deliveries")
    for n in (1, 2):
        delivery = batch(t).filter(F.col("seq") == n).drop("seq")
        delivery.repartition(3, "o_custkey").write.mode("append").parquet(path)
    table.write("upsert", t.spark.read.parquet(path).repartition(7, "o_totalprice"))
    return table.latest()


@query(
    "copy_table",
    BATCH_SQL
    + """
    SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last WHERE o_totalprice > 100000)
    UNION ALL SELECT * EXCLUDE seq FROM last WHERE o_totalprice > 100000
    """,
)
def copy_table(t):
    path = new_path(t.spark, "table")
    source = KeyedTable.create(t.spark, path, base(t).schema, ["o_orderkey"])
    source.write("upsert", batch(t), seq="seq")
    target = orders_table(t)
    kt.copy_table(source, target, "none")
    kt.copy_table(source, target, "upsert", F.col("o_totalprice") > 100000)
    return target.latest()


@query(
    "as_of",
    HISTORY_SQL
    + """
    SELECT 100 AS at, * FROM base UNION ALL SELECT 200, * FROM at200
    UNION ALL SELECT 350, * FROM at300 UNION ALL SELECT 400, * FROM at400
    """,
)
def as_of(t):
    table = history(t)
    states = [table.as_of(ts).select(F.lit(ts).alias("at"), "*") for ts in (100, 200, 350, 400)]
    return states[0].unionAll(states[1]).unionAll(states[2]).unionAll(states[3])


@query("latest", HISTORY_SQL + "SELECT * FROM at400")
def latest(t):
    return history(t).latest()


@query(
    "diff_scan",
    HISTORY_SQL
    + """
    SELECT *, false AS is_deleted FROM back
    UNION ALL SELECT * EXCLUDE seq, false FROM last WHERE o_orderkey NOT IN (FROM high)
    UNION ALL SELECT *, true FROM gone WHERE o_orderkey IN (FROM keys)
    """,
)
def diff_scan(t):
    return history(t).diff(100, 400)


@query(
    "read_own_writes",
    BATCH_SQL
    + """
    SELECT * FROM base
    UNION ALL SELECT * EXCLUDE seq FROM first WHERE o_orderkey NOT IN (FROM keys)
    """,
)
def read_own_writes(t):
    table = orders_table(t)
    written = table.write("insert_ignore", batch(t), seq="seq")
    return table.at_least(written)


@query(
    "compact",
    HISTORY_SQL
    + """,
    late AS (SELECT * FROM at400 WHERE o_orderkey NOT IN (
               SELECT o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM'))
    SELECT 'now' AS at, * FROM late UNION ALL SELECT 'before', * FROM at200
    """,
)
def compact(t):
    table = history(t)
    table.compact()
    table.write("delete_ignore", of_priority(t, "3-MEDIUM").select("o_orderkey"), ts=500)
    now = table.latest().select(F.lit("now").alias("at"), "*")
    return now.unionAll(table.as_of(200).select(F.lit("before"), "*"))


@query(
    "staged_commit",
    BATCH_SQL
    + """
    , medium AS (SELECT o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM')
    SELECT * FROM base WHERE o_orderkey NOT IN (SELECT o_orderkey FROM last) AND o_orderkey NOT IN (FROM medium)
    UNION ALL SELECT * EXCLUDE seq FROM last WHERE o_orderkey NOT IN (FROM medium)
    """,
)
def staged_commit(t):
    table = orders_table(t)
    with table.batch() as cancelled:
        cancelled.write("delete", table.latest().select("o_orderkey"))
        cancelled.rollback()
    with table.batch() as staged:
        staged.write("upsert", batch(t), seq="seq")
        staged.write("delete_ignore", of_priority(t, "3-MEDIUM").select("o_orderkey"))
    return table.latest()


@query(
    "catalog",
    """
    SELECT 'sales_orders' AS name, 'night shift' AS owner, count(*) AS rows FROM orders
    UNION ALL SELECT 'sales_parts', '', count(*) FROM part
    """,
)
def catalog(t):
    root = new_path(t.spark, "catalog")
    orders = all_orders(t, f"{root}/a")
    parts = KeyedTable.create_as(t.part, f"{root}/b", ["p_partkey"], name="sales_parts")
    other = KeyedTable.create(t.spark, f"{root}/c", t.part.schema, ["p_partkey"], name="sales_old")
    orders.describe(name="sales_orders", owner="night shift")
    other.drop()
    parts.drop()
    parts.recall()
    listed = kt.list_tables(t.spark, root, "sales_")
    n = F.count(F.lit(1)).alias("rows")
    counts = orders.latest().agg(n).select(F.lit("sales_orders").alias("name"), "rows").unionAll(
        parts.latest().agg(n).select(F.lit("sales_parts"), "rows")
    )
    return listed.join(counts, "name").select("name", "owner", "rows")


ALTERED_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus AS status, 'web' AS channel, NULL AS note
FROM orders WHERE o_orderdate < DATE '1998-01-01'
UNION ALL
SELECT o_orderkey, o_custkey, 'N', 'shop', o_orderpriority FROM orders WHERE o_orderdate >= DATE '1998-01-01'
"""


def altered(t):
    """Drops, renames and adds columns between two writes."""
    table = orders_table(t)
    table.drop_column("o_totalprice")
    table.rename_column("o_orderstatus", "status")
    table.add_column("channel", StringType(), default="web", required=True)
    table.add_column("note", StringType())
    table.alter_column("channel", default="shop", comment="where it was sold")
    return table


def altered_rows(t):
    return recent(t, "o_orderpriority").select(
        "o_orderkey",
        "o_custkey",
        F.lit("N").alias("status"),
        F.lit("shop").alias("channel"),
        F.col("o_orderpriority").alias("note"),
    )


@query("alter_columns", ALTERED_SQL)
def alter_columns(t):
    table = altered(t)
    table.write("upsert", altered_rows(t))
    return table.latest()


# Backups


@query("backup_full", HISTORY_SQL + "SELECT * FROM at200")
def backup_full(t):
    root = new_path(t.spark, "backups")
    made = backups.backup(history(t), root, to_ts=200)
    return t.spark.read.parquet(f"{root}/{made['table_id']}/{made['backup_id']}/data")


@query(
    "backup_incremental",
    HISTORY_SQL
    + """
    SELECT *, 0::TINYINT AS row_action FROM back
    UNION ALL SELECT *, 1::TINYINT FROM gone
    """,
)
def backup_incremental(t):
    root, table = new_path(t.spark, "backups"), history(t)
    backups.backup(table, root, to_ts=200)
    made = backups.backup(table, root, to_ts=400)
    return t.spark.read.parquet(f"{root}/{made['table_id']}/{made['backup_id']}/data")


def chain(t, table, *times):
    root = new_path(t.spark, "backups")
    for ts in times:
        backups.backup(table, root, to_ts=ts)
    return root


@query("restore_chain", HISTORY_SQL + "SELECT * FROM at400")
def restore_chain(t):
    return backups.restore(t.spark, chain(t, history(t), 100, 200, 300, 400), "orders")


@query("restore_as_of", HISTORY_SQL + "SELECT * FROM at300")
def restore_as_of(t):
    return backups.restore(t.spark, chain(t, history(t), 100, 300, 400), "orders", until=350)


@query("restore_altered", ALTERED_SQL)
def restore_altered(t):
    root = new_path(t.spark, "backups")
    table = orders_table(t)
    backups.backup(table, root)
    table.drop_column("o_totalprice")
    table.rename_column("o_orderstatus", "status")
    table.add_column("channel", StringType(), default="web", required=True)
    table.add_column("note", StringType())
    table.write("upsert", altered_rows(t))
    backups.backup(table, root)
    return backups.restore(t.spark, root, "orders")


@query(
    "restore_dropped_range",
    BATCH_SQL
    + """
    SELECT * FROM base WHERE NOT (o_orderkey >= 300 AND o_orderkey < 9000)
      AND o_orderkey NOT IN (SELECT o_orderkey FROM last)
    UNION ALL SELECT * EXCLUDE seq FROM last
    """,
)
def restore_dropped_range(t):
    root = new_path(t.spark, "backups")
    table = orders_table(t)
    backups.backup(table, root)
    table.drop_range("o_orderkey", 300, 9000)
    table.write("upsert", batch(t), seq="seq")
    backups.backup(table, root)
    return backups.restore(t.spark, root, "orders")


@query(
    "restore_renamed",
    BATCH_SQL
    + """
    SELECT * FROM base WHERE o_orderkey >= 300 AND o_orderkey NOT IN (SELECT o_orderkey FROM last)
    UNION ALL SELECT * EXCLUDE seq FROM last
    """,
)
def restore_renamed(t):
    root = new_path(t.spark, "backups")
    table = orders_table(t)
    backups.backup(table, root)
    table.drop_range("o_orderkey", None, 300)
    table.describe(name="renamed")
    table.write("upsert", batch(t), seq="seq")
    backups.backup(table, root)
    return backups.restore_table(t.spark, root, "renamed", new_path(t.spark, "table")).latest()


@query(
    "ctas_repeated_keys",
    "SELECT * FROM orders",
)
def ctas_repeated_keys(t):
    repeated = t.orders.withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(t.orders)
    table = KeyedTable.create_as(repeated.limit(0), new_path(t.spark, "table"), ["o_orderkey"])
    # The later of two rows with one key counts.
    table.write("upsert", repeated)
    return table.latest()


@query(
    "restore_names",
    """
    SELECT p_partkey,
           CASE WHEN p_size > 25 THEN 'ext::' ELSE '' END || 'new.' || p_type || '_copy' AS moved,
           CASE WHEN p_retailprice > 950 THEN 'db' || p_size || '.' ELSE '' END || p_type AS bare
    FROM part
    """,
)
def restore_names(t):
    name = F.concat(
        F.when(F.col("p_size") > 25, "ext::").otherwise(""),
        F.when(F.col("p_retailprice") > 950, F.concat(F.lit("db"), F.col("p_size"), F.lit("."))).otherwise(""),
        "p_type",
    )
    rows = t.part.select("p_partkey", name.alias("name"))
    n = F.col("name")
    return rows.select(
        "p_partkey",
        backups.restore_name(n, "ext::", database="new", suffix="_copy").alias("moved"),
        backups.restore_name(n, "ext::", drop_prefix=True).alias("bare"),
    )


@query(
    "backup_many",
    """
    SELECT 'orders' AS table_name, 'ok' AS status, count(*) AS rows FROM orders
    UNION ALL SELECT 'part', 'ok', count(*) FROM part
    UNION ALL SELECT 'missing', 'AnalysisException', 0
    """,
)
def backup_many(t):
    root = new_path(t.spark, "backups")
    orders = all_orders(t)
    missing = KeyedTable(t.spark, new_path(t.spark, "missing"))
    parts = KeyedTable.create_as(t.part, new_path(t.spark, "table"), ["p_partkey"], name="part")
    statuses = [s for _, s in backups.backup_many([orders, missing, parts], root)]
    n = F.count(F.lit(1)).alias("rows")
    out = None
    for name, status in zip(("orders", "missing", "part"), statuses):
        rows = backups.restore(t.spark, root, name) if status == "ok" else t.part.limit(0)
        row = rows.agg(n).select(F.lit(name).alias("table_name"), F.lit(status).alias("status"), "rows")
        out = row if out is None else out.unionAll(row)
    return out


@query(
    "restore_many",
    """
    SELECT 'orders' AS table_name, o_orderkey AS id, o_totalprice AS price FROM orders
    UNION ALL SELECT 'part', p_partkey, p_retailprice FROM part
    UNION ALL SELECT 'customer', c_custkey, c_acctbal + 1 FROM customer
    """,
)
def restore_many(t):
    root, spark = new_path(t.spark, "backups"), t.spark
    customers = KeyedTable.create_as(t.customer, new_path(spark, "table"), ["c_custkey"], name="customer")
    parts = KeyedTable.create_as(t.part, new_path(spark, "table"), ["p_partkey"], name="part")
    tables = [all_orders(t), parts, customers]
    backups.backup_many(tables, root)
    customers.update_where(F.lit(True), {"c_acctbal": F.col("c_acctbal") + 1})
    backups.backup_many(tables[2:], root)
    targets = {name: new_path(spark, name) for name in ("orders", "part", "customer")}
    statuses = dict(backups.restore_many(spark, root, targets))
    out = None
    for name, key, price in (
        ("orders", "o_orderkey", "o_totalprice"),
        ("part", "p_partkey", "p_retailprice"),
        ("customer", "c_custkey", "c_acctbal"),
    ):
        rows = KeyedTable(spark, targets[name]).latest().filter(F.lit(statuses[name] == "ok"))
        rows = rows.select(F.lit(name).alias("table_name"), F.col(key).alias("id"), F.col(price).alias("price"))
        out = rows if out is None else out.unionAll(rows)
    return out


# Chain choice over many tables: each customer is a table, each of its orders a backup.

MANIFEST_SQL = """
WITH RECURSIVE n AS (
  SELECT o_custkey, o_orderkey, o_orderpriority, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i FROM orders),
m AS (
  SELECT 'table ' || o_custkey AS table_name, CAST(o_custkey AS VARCHAR) AS table_id,
         CAST(o_orderkey AS VARCHAR) AS backup_id, i * 1000000 AS to_ts,
         CASE WHEN (i - 1) % 6 = 0 THEN 0 WHEN o_orderpriority = '5-LOW' THEN ((i - 1) // 2) * 1000000
              ELSE (i - 1) * 1000000 END AS from_ts FROM n),
r AS (
  SELECT table_id, backup_id AS root_id, to_ts AS root_to, to_ts, 0 AS weight, [backup_id] AS path
  FROM m WHERE from_ts = 0
  UNION ALL
  SELECT r.table_id, root_id, root_to, m.to_ts, weight + 1, list_append(path, m.backup_id)
  FROM r JOIN m ON m.table_id = r.table_id AND m.from_ts = r.to_ts AND m.from_ts > 0),
best AS (
  SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY table_id ORDER BY to_ts DESC, weight, root_to DESC) = 1)
"""


def order_manifests(t):
    numbered = number_rows(
        t.orders.select("o_custkey", "o_orderkey", "o_orderpriority"),
        ["o_orderkey"],
        "i",
        within=["o_custkey"],
    )
    before = F.col("i") - 1
    start = (
        F.when(before % 6 == 0, 0)
        .when(F.col("o_orderpriority") == "5-LOW", F.floor(before / 2) * 1_000_000)
        .otherwise(before * 1_000_000)
    )
    return numbered.select(
        F.concat(F.lit("table "), "o_custkey").alias("table_name"),
        F.col("o_custkey").cast("string").alias("table_id"),
        F.col("o_orderkey").cast("string").alias("backup_id"),
        start.alias("from_ts"),
        (F.col("i") * 1_000_000).alias("to_ts"),
    )


@query(
    "chain_base",
    MANIFEST_SQL
    + """
    SELECT table_id, root_id, path[-1] AS base_id, to_ts, weight::INT AS weight FROM r
    WHERE (table_id, root_to) IN (SELECT table_id, max(root_to) FROM r GROUP BY table_id)
    QUALIFY row_number() OVER (PARTITION BY table_id ORDER BY to_ts DESC, weight) = 1
    """,
)
def chain_base(t):
    return backups.chain_bases(order_manifests(t)).drop("root_to")


@query(
    "backup_list",
    MANIFEST_SQL
    + """
    , chosen AS (
      SELECT 'all' AS list, * FROM m
      UNION ALL SELECT 'latest', * FROM m WHERE (table_id, backup_id) IN (SELECT table_id, path[-1] FROM best)
      UNION ALL SELECT 'sequence', * FROM m
                WHERE (table_id, backup_id) IN (SELECT table_id, unnest(path) FROM best))
    SELECT list, table_name, table_id, strftime(make_timestamp(to_ts), '%Y-%m-%dT%H:%M:%S.%g') || '+0000' AS end_time,
           from_ts, to_ts, CASE WHEN from_ts = 0 THEN 'full' ELSE 'incremental' END AS type FROM chosen
    """,
)
def backup_list(t):
    rows = materialize(order_manifests(t), "manifests")
    links = backups.linked(rows)
    lists = [
        backups.backup_list(rows, kind, links).select(F.lit(kind).alias("list"), "*")
        for kind in ("all", "latest", "sequence")
    ]
    return lists[0].unionAll(lists[1]).unionAll(lists[2])


@query(
    "backup_expired",
    MANIFEST_SQL
    + """
    , leaf AS (SELECT DISTINCT table_id, to_ts, path FROM r
               WHERE (table_id, to_ts) NOT IN (SELECT table_id, from_ts FROM m WHERE from_ts > 0)
                 AND to_ts + 2000000 < 9000000)
    SELECT table_name, table_id, backup_id, from_ts, to_ts FROM m
    WHERE (table_id, backup_id) IN (SELECT table_id, unnest(path) FROM leaf)
      AND (table_id, backup_id) NOT IN (SELECT table_id, unnest(path) FROM best)
    """,
)
def backup_expired(t):
    return backups.backup_expired(order_manifests(t), now=9_000_000, age=2_000_000)
