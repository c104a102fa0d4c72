"""Rows as JSON, XML, pipe lines and key-value records."""

from pyspark.sql import functions as F

from olapkit.registry.base import query
from olapkit.registry.shapes import FLAT_SQL, flat
from olapkit.sources import encode, variants
from olapkit.workspace import new_path

ORDER_SQL = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
       o_orderpriority FROM orders
"""
ORDER = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate DATE, o_orderpriority STRING"
)


def order_rows(t):
    return t.orders.withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("json_roundtrip", ORDER_SQL)
def json_roundtrip(t):
    return encode.from_documents(encode.to_documents(order_rows(t)), ORDER)


@query("bulk_json", f"SELECT 'sales' AS _index, CAST(o_orderkey AS VARCHAR) AS _id, * FROM ({ORDER_SQL})")
def bulk_json(t):
    return encode.from_bulk_json(encode.to_bulk_json(order_rows(t), "sales", "o_orderkey"), ORDER)


@query("xml_roundtrip", ORDER_SQL)
def xml_roundtrip(t):
    return encode.from_xml_rows(encode.to_xml_rows(order_rows(t), "order"), ORDER, "order")


@query(
    "pipe_lines",
    """
    SELECT concat_ws('|', p_partkey, p_name, p_brand, p_type, p_size, p_retailprice) AS line FROM part
    """,
)
def pipe_lines(t):
    return encode.to_pipe_lines(t.part)


RECORD_KEY = ["l_shipmode", "o_orderkey", "o_orderstatus"]


@query(
    "hash_records",
    f"""
    WITH r AS (
      SELECT l_shipmode || '_' || o_orderkey || '_' || o_orderstatus AS key,
             CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_quantity AS VARCHAR) AS l_quantity,
             CAST(l_extendedprice AS VARCHAR) AS l_extendedprice, CAST(l_shipdate AS VARCHAR) AS l_shipdate,
             c_mktsegment, p_name
      FROM ({FLAT_SQL}))
    UNPIVOT r ON l_linenumber, l_quantity, l_extendedprice, l_shipdate, c_mktsegment, p_name
    INTO NAME field VALUE value
    """,
)
def hash_records(t):
    fields = ["l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "c_mktsegment", "p_name"]
    rows = encode.to_hash_records(flat(t).select(*RECORD_KEY, *fields), RECORD_KEY)
    return rows.select("key", F.explode("fields").alias("field", "value"))


@query(
    "hash_decode",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS key, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS o_custkey
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def hash_decode(t):
    known = F.col("o_orderpriority") != "5-LOW"
    dirty = order_rows(t).withColumns(
        {
            "o_totalprice": F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")),
            "o_custkey": F.when(known, F.col("o_custkey").cast("string")).otherwise("none"),
        }
    )
    stored = encode.to_hash_records(dirty, ["o_orderkey"])
    types = {"o_totalprice": "double", "o_orderdate": "date", "o_custkey": "bigint"}
    return encode.from_hash_records(stored, types, required=["o_totalprice"])


@query(
    "json_extract",
    """
    SELECT event_id, event_type, (props->>'k')::INT AS k, value AS v FROM events
    UNION ALL
    SELECT event_id, event_type, (props->>'k')::INT + 1000, NULL FROM events
    """,
)
def json_extract(t):
    # A payload of two records, each with a field that is not asked for.
    payload = F.format_string(
        '[{"k": %s, "v": %s, "x": true}, {"k": %s, "x": [1]}]',
        F.get_json_object("props", "$.k"),
        F.col("value").cast("string"),
        (F.get_json_object("props", "$.k").cast("int") + 1000).cast("string"),
    )
    events = t.events.select("event_id", "event_type", payload.alias("payload"))
    return encode.json_fields(events, "payload", {"k": "int", "v": "double"})


# Documents of varying shape: a field that is missing in some, a number in others, text in the rest.

VARYING_SQL = """
SELECT event_id AS id, event_type AS kind,
       CASE event_id % 4 WHEN 0 THEN props->>'k' WHEN 1 THEN props->>'k' WHEN 2 THEN 'k' || (props->>'k') END AS k,
       event_id % 4 AS shape, CASE WHEN event_id % 4 <> 3 THEN value END AS v FROM events
"""


def varying(t):
    k, shape = F.get_json_object("props", "$.k"), F.col("event_id") % 4

    def document(*fields):
        named = [F.col("event_id").alias("id"), F.col("event_type").alias("kind"), *fields]
        return F.to_json(F.struct(*named))

    value = F.col("value").alias("a value")
    text = (
        F.when(shape == 0, document(k.cast("int").alias("k"), value))
        .when(shape == 1, document(k.alias("k"), value, F.struct(k.cast("int").alias("x")).alias("more")))
        .when(shape == 2, document(F.concat(F.lit("k"), k).alias("k"), value))
        .otherwise(document())
    )
    path = new_path(t.spark, "variants")
    variants.to_variants(t.events.select(text.alias("document")), "document").write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    "variant_fields",
    f"""
    WITH d AS ({VARYING_SQL})
    SELECT 'id' AS field, 'number' AS type, count(*) AS rows FROM d UNION ALL SELECT 'kind', 'text', count(*) FROM d
    UNION ALL SELECT 'k', CASE shape WHEN 0 THEN 'number' ELSE 'text' END, count(*) FROM d WHERE shape <> 3 GROUP BY 2
    UNION ALL SELECT 'a value', 'number', count(*) FROM d WHERE v IS NOT NULL
    UNION ALL SELECT 'more', 'object', count(*) FROM d WHERE shape = 1
    """,
)
def variant_fields(t):
    # A number without a fraction is another type than one with; here both are numbers.
    seen = variants.observed_fields(varying(t), "document")
    kind = F.when(F.col("type") == "STRING", "text").when(F.col("type") == "OBJECT", "object").otherwise("number")
    return seen.groupBy("field", kind.alias("type")).agg(F.sum("rows").alias("rows"))


@query(
    "variant_extract",
    f"""
    SELECT id, kind, TRY_CAST(k AS BIGINT) AS k, k AS k_text, v, CASE WHEN shape = 1 THEN k::BIGINT END AS x FROM ({VARYING_SQL})
    """,
)
def variant_extract(t):
    documents = varying(t)
    rows = documents.select(
        variants.field("document", "id", "bigint").alias("id"),
        variants.field("document", "kind", "string").alias("kind"),
        variants.field("document", "k", "bigint").alias("k"),
        variants.field("document", "k", "string").alias("k_text"),
        (variants.field("document", "a value", "double") + F.lit(0.0)).alias("v"),
        F.try_variant_get("document", "$.more.x", "bigint").alias("x"),
    )
    return rows
