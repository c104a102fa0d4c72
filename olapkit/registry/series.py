"""Metric series, verification and streams."""

from pyspark.sql import functions as F

from olapkit.operators import metrics, verify
from olapkit.registry.base import query, rounded
from olapkit.registry.rows import base, recent
from olapkit.sources.keyed_table import KeyedTable
from olapkit.streaming import upsert as streams
from olapkit.workspace import new_path

# Metrics: a user is a host, an event type a metric. Of events in one second the
# one with the highest number counts.

POINT_SQL = """
SELECT 'host' || user_id || '.example.com' AS host, event_type || '.avg1' AS metric,
       epoch(date_trunc('second', ts))::INT AS timestamp, arg_max(value, event_id) AS value
FROM events GROUP BY ALL
"""


def points(t):
    return t.events.groupBy(
        F.format_string("host%d.example.com", "user_id").alias("host"),
        F.concat("event_type", F.lit(".avg1")).alias("metric"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).cast("int").alias("timestamp"),
    ).agg(F.max_by("value", "event_id").alias("value"))


def metric_lines(t):
    """One line per event; those of errors are broken in one of three ways."""
    good = F.format_string(
        "host%d.example.com/.%s.avg1 %s %d",
        "user_id",
        "event_type",
        F.col("value").cast("string"),
        F.unix_timestamp(F.col("ts").cast("timestamp")),
    )
    broken = (
        F.when(F.col("value") < 5, F.concat(good, F.lit(" more")))
        .when(F.col("value") < 10, F.replace(good, F.lit("/."), F.lit("-")))
        .otherwise(F.replace(good, F.lit("1 "), F.lit("1 x")))
    )
    return t.events.select(
        "event_type", F.when(F.col("event_type") == "error", broken).otherwise(good).alias("line")
    )


@query(
    "metric_parse",
    """
    WITH l AS (
      SELECT event_type, 'host' || user_id || '.example.com' AS host, event_type || '.avg1' AS metric,
             epoch(date_trunc('second', ts))::INT AS timestamp, value FROM events)
    SELECT host, metric, timestamp, value, NULL AS line FROM l WHERE event_type <> 'error'
    UNION ALL
    SELECT NULL, NULL, NULL, NULL,
           CASE WHEN value < 5 THEN host || '/.' || metric || ' ' || value || ' ' || timestamp || ' more'
                WHEN value < 10 THEN host || '-' || metric || ' ' || value || ' ' || timestamp
                ELSE replace(host || '/.' || metric || ' ' || value || ' ' || timestamp, '1 ', '1 x') END
    FROM l WHERE event_type = 'error'
    """,
)
def metric_parse(t):
    good, rejected = metrics.parse_metric_lines(metric_lines(t))
    return good.unionByName(rejected, allowMissingColumns=True)


@query(
    "metric_ids",
    "SELECT DISTINCT 'host' || user_id || '.example.com' AS host, event_type || '.avg1' AS metric FROM events",
)
def metric_ids(t):
    known = metrics.metric_ids(points(t).filter(F.col("host") < "host3"))
    return metrics.metric_ids(points(t), known)


@query(
    "metric_fetch",
    f"""
    SELECT timestamp, value FROM ({POINT_SQL})
    WHERE host = 'host7.example.com' AND metric = 'click.avg1'
      AND timestamp BETWEEN epoch(TIMESTAMP '2024-01-05') AND epoch(TIMESTAMP '2024-01-25')
    """,
)
def metric_fetch(t):
    return metrics.fetch(points(t), "host7.example.com", "click.avg1", 1704412800, 1706140800)


STEP_SQL = f"""
SELECT host, metric, greatest(coalesce(min(gap), 1), 1)::BIGINT AS step FROM (
  SELECT host, metric, timestamp - lag(timestamp) OVER (PARTITION BY host, metric ORDER BY timestamp) AS gap
  FROM ({POINT_SQL})) GROUP BY host, metric
"""


@query("metric_step", STEP_SQL)
def metric_step(t):
    return metrics.infer_step(points(t))


HOUR_SQL = f"""
WITH p AS (SELECT host, metric, timestamp::BIGINT AS t, value FROM ({POINT_SQL})),
span AS (SELECT host, metric, min(t) AS a, max(t) AS b FROM p GROUP BY ALL),
grid AS (SELECT host, metric, a, unnest(range(0, ceil((b - a) / 3600.0)::BIGINT + 1)) AS slot FROM span),
v AS (SELECT p.host, p.metric, ceil((t - a) / 3600.0)::BIGINT AS slot, arg_max(value, t) AS value
      FROM p JOIN span USING (host, metric) GROUP BY ALL)
SELECT host, metric, a + slot * 3600 AS timestamp, value FROM grid LEFT JOIN v USING (host, metric, slot)
"""


@query("metric_resample", HOUR_SQL)
def metric_resample(t):
    return metrics.resample(points(t), 3600)


TREE_SQL = """
WITH names AS (SELECT DISTINCT string_split('host' || user_id || '.example.com.' || event_type || '.avg1', '.') AS p FROM events),
edges AS (SELECT DISTINCT array_to_string(p[1:d], '.') AS path, d::INT AS depth, p[d + 1] AS child
          FROM names, range(1, 6) r(d) WHERE d <= len(p))
SELECT path, depth, count(child) = 0 AS is_leaf, count(child) AS children FROM edges GROUP BY path, depth
"""


@query(
    "metric_find",
    f"""
    SELECT path, is_leaf FROM ({TREE_SQL})
    WHERE regexp_full_match(path, 'host1[^.]*\\.example\\.com\\.(?:click|view)')
    """,
)
def metric_find(t):
    return metrics.find(metrics.metric_ids(points(t)), "host1*.example.com.{click,view}")


@query("metric_tree", TREE_SQL)
def metric_tree(t):
    return metrics.metric_tree(metrics.metric_ids(points(t)))


@query(
    "stat_parse",
    """
    SELECT l_orderkey * 10 + l_linenumber AS ts, l_quantity::FLOAT::DOUBLE AS usr,
           l_extendedprice::FLOAT::DOUBLE AS sys, l_tax::FLOAT::DOUBLE + 0.0 AS idl
    FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linestatus = 'F') AND l_discount <> 0.1::DOUBLE
    """,
)
def stat_parse(t):
    numbers = F.concat_ws(", ", "l_quantity", "l_extendedprice", "l_tax")
    line = (
        F.when(
            (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), '"usr","sys","idl"'
        )
        .when(F.col("l_discount") == 0.1, F.concat(numbers, F.lit(",1")))
        .otherwise(numbers)
    )
    lines = t.lineitem.select(line.alias("line"), "l_orderkey", "l_linenumber")
    ts = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    rows = metrics.parse_stat_lines(lines, ["usr", "sys", "idl"], ts)
    return rows.withColumns({c: F.col(c).cast("double") + F.lit(0.0) for c in ("usr", "sys", "idl")})


# Verification


@query(
    "verify_links",
    """
    WITH n AS (SELECT o_orderkey AS k, CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey - 50 ELSE o_orderkey - 1 END AS prev FROM orders),
    refs AS (SELECT prev, count(*) AS c FROM n GROUP BY prev)
    SELECT count(*) FILTER (k IS NOT NULL AND c = 1) AS referenced, count(*) FILTER (k IS NOT NULL AND c > 1) AS extra,
           count(*) FILTER (k IS NOT NULL AND c IS NULL) AS unreferenced, count(*) FILTER (k IS NULL) AS undefined
    FROM n FULL JOIN refs ON n.k = refs.prev
    """,
)
def verify_links(t):
    key = F.col("o_orderkey")
    urgent = F.col("o_orderpriority") == "1-URGENT"
    previous = F.when(urgent, F.col("o_custkey") - 50).otherwise(key - 1)
    nodes = t.orders.select(key.alias("k"), previous.alias("prev"))
    return verify.verify_links(nodes, ["k"], ["prev"])


@query(
    "generate_links",
    """
    SELECT count(*) * 8 AS referenced, 0 AS extra, 0 AS unreferenced, 0 AS undefined FROM customer
    """,
)
def generate_links(t):
    links = verify.generate_links(t.customer, "c_custkey", nodes=8, seed=5)
    return verify.verify_links(links, ["key1", "key2"], ["prev1", "prev2"])


MD5_SUM = "sum(CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)::DECIMAL(38,0))"
LINE_TEXT = """concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::DECIMAL(38,4),
  l_extendedprice::DECIMAL(38,4), l_discount::DECIMAL(38,4), l_tax::DECIMAL(38,4), l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))"""
LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_linestatus", "l_shipdate",
]


@query(
    "checksum",
    f"""
    SELECT 'lineitem' AS table_name, l_returnflag AS part, count(*) AS rows, {MD5_SUM.format(text=LINE_TEXT)}::VARCHAR AS md5_sum
    FROM lineitem GROUP BY 2
    UNION ALL
    SELECT 'customer', NULL, count(*),
           {MD5_SUM.format(text="concat_ws('|', c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN '\\N' ELSE (c_acctbal::DECIMAL(38,4))::VARCHAR END)")}::VARCHAR
    FROM customer
    """,
)
def checksum(t):
    lines = verify.portable_checksum(t.lineitem, LINE_COLUMNS, by=["l_returnflag"])
    debtless = t.customer.withColumn("c_acctbal", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")))
    whole = verify.portable_checksum(debtless, ["c_custkey", "c_name", "c_nationkey", "c_acctbal"])
    sums = F.col("md5_sum").cast("string").alias("md5_sum")
    return lines.select(F.lit("lineitem").alias("table_name"), F.col("l_returnflag").alias("part"), "rows", sums).unionAll(
        whole.select(F.lit("customer"), F.lit(None).cast("string"), "rows", sums)
    )


@query(
    "checksum_equal",
    """
    SELECT o_orderpriority, o_orderpriority <> '1-URGENT' AS equal, count(*) AS rows FROM orders GROUP BY ALL
    """,
)
def checksum_equal(t):
    urgent = F.col("o_orderpriority") == "1-URGENT"
    other = t.orders.repartition(5, "o_custkey").withColumn(
        "o_totalprice", F.when(urgent, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    )
    return verify.checksum_equal(t.orders, other, by=["o_orderpriority"])


# Streams


#: A file of arrivals is written, and read again, by one task.
ROWS_PER_FILE = 250_000


def staged(t, df, parts=3):
    """A folder whose files arrive in a few parts, so that a stream sees several micro-batches, and the files of a part."""
    path = new_path(t.spark, "arrivals")
    files = max(1, -(-df.count() // (parts * ROWS_PER_FILE)))
    df.repartition(parts * files).write.parquet(path)
    return path, files


@query(
    "stream_upsert",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate < DATE '1998-01-01'
    UNION ALL SELECT o_orderkey, o_custkey, 'S', o_totalprice + 1 FROM orders WHERE o_orderdate >= DATE '1998-01-01'
    """,
)
def stream_upsert(t):
    table = KeyedTable.create_as(base(t), new_path(t.spark, "table"), ["o_orderkey"])
    arrivals = recent(t).withColumns(
        {"o_orderstatus": F.lit("S"), "o_totalprice": F.col("o_totalprice") + 1}
    )
    path, files = staged(t, arrivals)
    stream = streams.file_stream(t.spark, path, arrivals.schema, per_trigger=files)
    checkpoint = new_path(t.spark, "progress")
    streams.upsert_stream(stream, table, "orders", checkpoint).awaitTermination()
    return table.latest()


@query("stream_metrics", POINT_SQL)
def stream_metrics(t):
    # Every point arrives twice, beside some broken lines.
    lines = points(t).select(
        F.format_string(
            "%s/.%s %s %d", "host", "metric", F.col("value").cast("string"), "timestamp"
        ).alias("value")
    )
    broken = metric_lines(t).filter(F.col("event_type") == "error").select(F.col("line").alias("value"))
    path = new_path(t.spark, "lines")
    # Files in no order of time, each a micro-batch: points come up to a month late.
    shuffled = lines.unionAll(broken).repartition(2, F.xxhash64("value"))
    shuffled.write.text(path)
    lines.orderBy(F.desc("value")).coalesce(1).write.mode("append").text(path)
    table = KeyedTable.create(
        t.spark, new_path(t.spark, "table"), points(t).schema, ["host", "metric", "timestamp"]
    )
    stream = streams.file_stream(t.spark, path, "value STRING", "text", per_trigger=1)
    streams.metric_stream(stream, table, "metrics", new_path(t.spark, "progress")).awaitTermination()
    return table.latest()


@query(
    "stream_q1",
    """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price, count(*) AS count_order
    FROM lineitem WHERE l_shipdate <= DATE '1998-12-01' - INTERVAL 90 DAY GROUP BY l_returnflag, l_linestatus
    """,
)
def stream_q1(t):
    path, files = staged(t, t.lineitem)
    stream = streams.file_stream(t.spark, path, t.lineitem.schema, per_trigger=files)
    out = new_path(t.spark, "summary")
    streams.pricing_stream(stream, out, new_path(t.spark, "progress")).awaitTermination()
    summary = streams.newest_batch(t.spark, out).select(
        "l_returnflag", "l_linestatus", "sum_qty", "sum_base_price", "sum_disc_price", "count_order"
    )
    return rounded(rounded(summary, 2, "sum_base_price"), 4, "sum_disc_price")


@query(
    "stream_json",
    """
    SELECT event_id AS id, (props->>'k')::INT AS k, event_type AS kind FROM events
    UNION ALL SELECT -event_id - 1, (props->>'k')::INT, 'twin' FROM events
    """,
)
def stream_json(t):
    payload = F.format_string(
        '[{"id": %d, "k": %s, "kind": "%s", "x": 0}, {"id": %d, "k": %s, "kind": "twin"}]',
        "event_id",
        F.get_json_object("props", "$.k"),
        "event_type",
        -F.col("event_id") - 1,
        F.get_json_object("props", "$.k"),
    )
    arrivals = t.events.select(payload.alias("payload"))
    types = {"id": "bigint", "k": "int", "kind": "string"}
    empty = t.spark.createDataFrame([], "id BIGINT, k INT, kind STRING")
    table = KeyedTable.create(t.spark, new_path(t.spark, "table"), empty.schema, ["id"])
    path, files = staged(t, arrivals)
    stream = streams.file_stream(t.spark, path, arrivals.schema, per_trigger=2 * files)
    streams.json_stream(
        stream, "payload", types, table, "users", new_path(t.spark, "progress")
    ).awaitTermination()
    return table.latest()


@query(
    "stream_drift",
    """
    SELECT event_id AS id, event_type AS kind, CASE WHEN event_id % 2 = 1 THEN (props->>'k')::BIGINT END AS k,
           CASE WHEN event_id % 2 = 1 AND event_id % 3 = 0 THEN 'a' END AS note FROM events
    """,
)
def stream_drift(t):
    # The first file's documents have two fields, the second's four; the table learns of them as they come.
    event = F.col("event_id")
    early = F.to_json(F.struct(event.alias("id"), F.col("event_type").alias("kind")))
    late = F.to_json(
        F.struct(
            event.alias("id"),
            F.col("event_type").alias("kind"),
            F.get_json_object("props", "$.k").cast("bigint").alias("k"),
            F.when(event % 3 == 0, "a").alias("note"),
        )
    )
    path = new_path(t.spark, "documents")
    for odd, document in ((0, early), (1, late)):
        t.events.filter(event % 2 == odd).select(document.alias("value")).coalesce(1).write.mode("append").text(path)
    table = KeyedTable.create(t.spark, new_path(t.spark, "table"), t.spark.createDataFrame([], "id BIGINT").schema, ["id"])
    stream = streams.file_stream(t.spark, path, "value STRING", "text", per_trigger=1)
    streams.document_stream(stream, "value", table, "events", new_path(t.spark, "progress")).awaitTermination()
    return table.latest()
