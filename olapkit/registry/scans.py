"""Projections, predicates, joins, aggregates, order and set operations."""

from pyspark.sql import functions as F

from olapkit.functions.predicates import (
    all_of,
    bloom_words,
    filter_json,
    key_range,
    might_contain,
    require_not_null,
)
from olapkit.operators import sketches
from olapkit.operators.numbering import number_rows
from olapkit.operators.scan import (
    by_position,
    scan_ordered,
    table_difference,
    top_rows,
    union_by_name,
)
from olapkit.operators.scan import count_distinct as exact_distinct
from olapkit.plans import sales
from olapkit.plans.tables import LINEITEM_DATES_SQL
from olapkit.registry.base import query, rounded
from olapkit.workspace import materialize


@query("project_names", "SELECT o_totalprice, o_orderkey FROM orders")
def project_names(t):
    return t.orders.select("o_totalprice", "o_orderkey")


@query("project_index", "SELECT c_mktsegment, c_custkey, c_name FROM customer")
def project_index(t):
    return by_position(t.customer, [4, 0, 1])


@query("count_all", "SELECT count(*) AS n FROM lineitem")
def count_all(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"))


@query(
    "pred_compare",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem
    WHERE l_quantity >= 10 AND l_quantity < 20 AND l_partkey > 5 AND l_linenumber <= 6
      AND l_returnflag = 'R'
    """,
)
def pred_compare(t):
    c = F.col
    return t.lineitem.filter(
        all_of(
            c("l_quantity") >= 10,
            c("l_quantity") < 20,
            c("l_partkey") > 5,
            c("l_linenumber") <= 6,
            c("l_returnflag") == "R",
        )
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "pred_in",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')",
)
def pred_in(t):
    return t.orders.filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select(
        "o_orderkey", "o_orderpriority"
    )


@query(
    "pred_null",
    """
    WITH l AS (
      SELECT l_orderkey, l_linenumber, l_partkey,
             CASE WHEN l_linestatus = 'F' THEN l_returnflag END AS flag FROM lineitem)
    SELECT 'null' AS kind, count(*) AS n, sum(l_partkey)::BIGINT AS parts FROM l WHERE flag IS NULL
    UNION ALL
    SELECT 'not null', count(*), sum(l_partkey)::BIGINT FROM l WHERE flag IS NOT NULL
    """,
)
def pred_null(t):
    flag = F.when(F.col("l_linestatus") == "F", F.col("l_returnflag"))
    lines = t.lineitem.withColumn("flag", flag)
    sums = [F.count(F.lit(1)).alias("n"), F.sum("l_partkey").alias("parts")]
    missing = lines.filter(F.col("flag").isNull()).agg(*sums)
    present = lines.filter(F.col("flag").isNotNull()).agg(*sums)
    return missing.select(F.lit("null").alias("kind"), "*").unionAll(
        present.select(F.lit("not null").alias("kind"), "*")
    )


@query("pred_prefix", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'blue%'")
def pred_prefix(t):
    return t.part.filter(F.col("p_name").startswith("blue")).select("p_partkey", "p_name")


@query(
    "pred_and",
    """
    SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice > 1000 AND o_totalprice <= 200000 AND o_totalprice > 50000
      AND o_totalprice IS NOT NULL
    """,
)
def pred_and(t):
    price = F.col("o_totalprice")
    return t.orders.filter(
        all_of(price > 1000, price <= 200000, price > 50000, price.isNotNull())
    ).select("o_orderkey", "o_totalprice")


@query(
    "pred_contradiction",
    "SELECT count(*) AS n FROM orders WHERE o_orderkey > 100 AND o_orderkey < 50",
)
def pred_contradiction(t):
    key = F.col("o_orderkey")
    return t.orders.filter(all_of(key > 100, key < 50)).agg(F.count(F.lit(1)).alias("n"))


@query(
    "bloom_semi",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
                        AND c_acctbal > 5000)
    """,
)
def bloom_semi(t):
    wanted = t.customer.filter(
        (F.col("c_mktsegment") == "HOUSEHOLD") & (F.col("c_acctbal") > 5000)
    ).select("c_custkey")
    words = bloom_words(wanted, "c_custkey")
    likely = might_contain(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", words)
    return likely.join(wanted, F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query(
    "pred_json",
    """
    SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders
    WHERE o_totalprice >= 100000 AND o_orderpriority IN ('2-HIGH', '3-MEDIUM')
      AND o_custkey IS NOT NULL AND o_orderstatus = 'F'
    """,
)
def pred_json(t):
    spec = """["AND", [">=", "o_totalprice", 100000],
               ["IN", "o_orderpriority", ["2-HIGH", "3-MEDIUM"]],
               ["NOTNULL", "o_custkey"], ["=", "o_orderstatus", "F"]]"""
    return filter_json(t.orders, spec).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query(
    "key_range",
    """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE (l_orderkey > 100 OR (l_orderkey = 100 AND l_linenumber >= 3))
      AND (l_orderkey < 14000 OR (l_orderkey = 14000 AND l_linenumber < 5))
    """,
)
def key_range_query(t):
    return key_range(t.lineitem, ["l_orderkey", "l_linenumber"], (100, 3), (14000, 5)).select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query(
    "pred_residual",
    """
    SELECT p_partkey, p_name, p_brand FROM part
    WHERE p_brand <> 'Brand#2' AND (p_name LIKE '%ring%' OR p_size = 11)
    """,
)
def pred_residual(t):
    return t.part.filter(
        (F.col("p_brand") != "Brand#2") & (F.col("p_name").contains("ring") | (F.col("p_size") == 11))
    ).select("p_partkey", "p_name", "p_brand")


@query("assert_not_null", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def assert_not_null(t):
    return require_not_null(t.orders, "o_orderkey", "o_custkey").select(
        "o_orderkey", "o_custkey", "o_totalprice"
    )


@query(
    "scan_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
)
def scan_limit(t):
    return (
        t.orders.select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(25)
    )


# Joins


@query(
    "join_3way",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, c_custkey, c_name FROM customer, orders, lineitem
    WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND c_mktsegment = 'HOUSEHOLD'
    """,
)
def join_3way(t):
    buyers = t.customer.filter(F.col("c_mktsegment") == "HOUSEHOLD").select("c_custkey", "c_name")
    bought = t.orders.select("o_orderkey", "o_custkey").join(
        buyers, F.col("o_custkey") == F.col("c_custkey")
    )
    return (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
        .join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "c_custkey", "c_name")
    )


@query(
    "join_6way",
    """
    SELECT r_name, n_name, count(*) AS lines, sum(l_quantity) AS quantity
    FROM customer, orders, lineitem, supplier, nation, region
    WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND l_suppkey = s_suppkey
      AND c_nationkey = s_nationkey AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
    GROUP BY r_name, n_name
    """,
)
def join_6way(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    bought = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_nationkey"
    )
    pairs = (
        t.lineitem.join(bought, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("l_suppkey", "c_nationkey")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"))
    )
    local = pairs.join(
        t.supplier,
        (F.col("l_suppkey") == F.col("s_suppkey")) & (F.col("c_nationkey") == F.col("s_nationkey")),
    )
    by_nation = local.groupBy("s_nationkey").agg(
        F.sum("lines").alias("lines"), F.sum("quantity").alias("quantity")
    )
    return by_nation.join(places, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "r_name", "n_name", "lines", "quantity"
    )


@query(
    "semi_exists",
    f"""
    WITH l AS ({LINEITEM_DATES_SQL})
    SELECT o_orderkey, o_orderpriority FROM orders
    WHERE EXISTS (SELECT * FROM l WHERE l_orderkey = o_orderkey AND l_commitdate < l_receiptdate)
    """,
)
def semi_exists(t):
    return t.orders.select("o_orderkey", "o_orderpriority").join(
        sales.late_lines(t.lineitem_dates), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi"
    )


@query(
    "anti_cascade",
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
    """,
)
def anti_cascade(t):
    refused = t.customer.filter(F.col("c_acctbal") < 0).select("c_custkey")
    return t.orders.select("o_orderkey", "o_custkey").join(
        refused, F.col("o_custkey") == F.col("c_custkey"), "left_anti"
    )


@query(
    "lookup_join",
    """
    SELECT o_orderkey, c_custkey, n_name, r_name FROM orders
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    """,
)
def lookup_join(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    return t.orders.join(buyers, F.col("o_custkey") == F.col("c_custkey")).select(
        "o_orderkey", "c_custkey", "n_name", "r_name"
    )


@query(
    "join_broadcast",
    """
    SELECT s_suppkey, s_name, l_orderkey, l_partkey FROM lineitem, supplier
    WHERE l_suppkey = s_suppkey AND s_acctbal > 5000
    """,
)
def join_broadcast(t):
    rich = t.supplier.filter(F.col("s_acctbal") > 5000).select("s_suppkey", "s_name")
    return (
        t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey")
        .join(rich, F.col("l_suppkey") == F.col("s_suppkey"))
        .select("s_suppkey", "s_name", "l_orderkey", "l_partkey")
    )


@query(
    "delete_join",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity = 50)
    """,
)
def delete_join(t):
    doomed = t.lineitem.filter(F.col("l_quantity") == 50).select("l_orderkey").distinct()
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice").join(
        doomed, F.col("o_orderkey") == F.col("l_orderkey"), "left_anti"
    )


# Aggregates and order


@query(
    "agg_group",
    """
    SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(avg(l_quantity), 6) AS avg_qty,
           count(*) AS n FROM lineitem GROUP BY ALL
    """,
)
def agg_group(t):
    df = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_quantity").alias("avg_qty"),
        F.count(F.lit(1)).alias("n"),
    )
    return rounded(df, 6, "avg_qty")


@query("agg_global", "SELECT round(sum(o_totalprice), 2) AS total FROM orders")
def agg_global(t):
    return rounded(t.orders.agg(F.sum("o_totalprice").alias("total")), 2, "total")


@query("agg_count", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY ALL")
def agg_count(t):
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_values", "SELECT DISTINCT l_partkey FROM lineitem")
def distinct_values(t):
    return t.lineitem.select("l_partkey").distinct()


@query(
    "count_distinct",
    "SELECT count(DISTINCT l_linenumber) AS n, count(DISTINCT l_partkey) AS parts FROM lineitem",
)
def count_distinct(t):
    return exact_distinct(t.lineitem, "l_linenumber", "l_partkey").toDF("n", "parts")


@query(
    "distinct_sketches",
    """
    SELECT 'month' AS level, strftime(l_shipdate, '%Y-%m') AS part, count(DISTINCT l_partkey) AS parts,
           count(DISTINCT l_orderkey) AS orders, true AS within FROM lineitem GROUP BY 2
    UNION ALL SELECT 'year', strftime(l_shipdate, '%Y'), count(DISTINCT l_partkey), count(DISTINCT l_orderkey), true
    FROM lineitem GROUP BY 2
    UNION ALL SELECT 'all', 'all', count(DISTINCT l_partkey), count(DISTINCT l_orderkey), true FROM lineitem
    """,
)
def distinct_sketches(t):
    # Sketches by month are stored; years and the whole are united from them. Each estimate stands beside the
    # exact numbers and must lie within four standard errors of them.
    columns = ["l_partkey", "l_orderkey"]
    lines = t.lineitem.withColumn("part", F.date_format("l_shipdate", "yyyy-MM"))
    months = materialize(sketches.distinct_sketches(lines, ["part"], columns), "sketches")
    out = None
    for level, part in (("month", F.col("part")), ("year", F.substring("part", 1, 4)), ("all", F.lit("all"))):
        guessed = sketches.count_distinct_stored(months.withColumn("part", part), ["part"], columns)
        exact = lines.withColumn("part", part).groupBy("part").agg(
            F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_orderkey").alias("orders")
        )
        near = sketches.within(F.col("l_partkey"), F.col("parts")) & sketches.within(F.col("l_orderkey"), F.col("orders"))
        rows = exact.join(guessed, "part").select(F.lit(level).alias("level"), "part", "parts", "orders", near.alias("within"))
        out = rows if out is None else out.unionAll(rows)
    return out


@query(
    "sort_multi",
    """
    SELECT o_orderkey, o_orderdate, o_totalprice,
           row_number() OVER (ORDER BY o_totalprice DESC, o_orderdate, o_orderkey) AS position
    FROM orders
    """,
)
def sort_multi(t):
    df = t.orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return number_rows(df, [F.desc("o_totalprice"), "o_orderdate", "o_orderkey"], "position")


@query(
    "top_k",
    """
    (SELECT 'highest' AS kind, event_id, value FROM events ORDER BY value DESC, event_id LIMIT 1)
    UNION ALL
    (SELECT 'lowest', event_id, value FROM events ORDER BY value, event_id LIMIT 5)
    """,
)
def top_k(t):
    events = t.events.select("event_id", "value")
    highest = top_rows(events, 1, F.desc("value"), "event_id")
    lowest = top_rows(events, 5, "value", "event_id")
    return highest.select(F.lit("highest").alias("kind"), "*").unionAll(
        lowest.select(F.lit("lowest").alias("kind"), "*")
    )


@query(
    "scan_ordered",
    """
    SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_partkey) AS position FROM part
    """,
)
def scan_in_key_order(t):
    numbered = number_rows(t.part.select("p_partkey", "p_name"), ["p_partkey"], "position")
    return scan_ordered(numbered, ["p_partkey"])


# Set operations


@query(
    "union_all",
    """
    SELECT o_orderkey, o_custkey, o_totalprice, NULL::TIMESTAMP AS o_orderdate FROM orders
    WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT o_orderkey, o_custkey, NULL, o_orderdate FROM orders WHERE o_orderstatus <> 'F'
    """,
)
def union_all(t):
    done = t.orders.filter(F.col("o_orderstatus") == "F")
    rest = t.orders.filter(F.col("o_orderstatus") != "F")
    return union_by_name(
        done.select("o_orderkey", "o_custkey", "o_totalprice"),
        rest.select("o_custkey", "o_orderkey", "o_orderdate"),
    )


@query(
    "table_diff",
    """
    SELECT 'left' AS side, o_orderkey, o_orderstatus FROM orders WHERE o_totalprice < 20000
    UNION ALL
    SELECT 'right', o_orderkey, o_orderstatus FROM orders WHERE o_totalprice > 400000
    """,
)
def table_diff(t):
    a = t.orders.filter("o_totalprice <= 400000").select("o_orderkey", "o_orderstatus")
    b = t.orders.filter("o_totalprice >= 20000").select("o_orderkey", "o_orderstatus")
    return table_difference(a, b)
