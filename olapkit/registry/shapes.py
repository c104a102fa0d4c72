"""Star, flat, sparse and key-value shapes, and the queries on them."""

from pyspark.sql import functions as F

from olapkit.functions import scalars
from olapkit.operators import models
from olapkit.operators.numbering import number_rows, unique_ids
from olapkit.plans import flat as wide
from olapkit.plans import store
from olapkit.plans.tables import LINEITEM_DATES_SQL, ORDERS_PRIORITY_SQL, with_line_dates
from olapkit.registry.base import query, rounded
from olapkit.sources.encode import from_hash_records, to_hash_records
from olapkit.sources.stored_shapes import Shape, ShapeStore
from olapkit.workspace import shared_root


def flat(t):
    # What follows from the keys is added to the joined rows, so that no shuffle carries it.
    lines = t.lineitem.withColumn("l_shipdate", F.to_date("l_shipdate"))
    wide = models.flat_line_item(lines, t.orders_priority, t.customer, t.part, t.supplier, t.nation, t.region)
    dated = with_line_dates(wide, part="p_partkey", supplier="s_suppkey")
    return dated.select(*models.existing(dated, models.FLAT))


FLAT_SQL = f"""
SELECT l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
       l_shipdate, l_commitdate, l_receiptdate, l_shipmode,
       o_orderkey, o_orderstatus, o_orderdate, o_orderpriority, o_shippriority,
       c_custkey, c_name, c_mktsegment, cn.n_name AS c_nationname, cr.r_name AS c_regionname,
       p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
       s_suppkey, s_name, sn.n_name AS s_nationname, sr.r_name AS s_regionname
FROM ({LINEITEM_DATES_SQL}) l JOIN ({ORDERS_PRIORITY_SQL}) o ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey
"""


# Shapes


@query("flat_line_item", f"SELECT * REPLACE (l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax) FROM ({FLAT_SQL})")
def flat_line_item(t):
    return flat(t)


@query(
    "flat_order",
    f"""
    SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, o_shippriority,
           c_name, c_nationkey, c_acctbal, c_mktsegment, n_name AS c_nationname, r_name AS c_regionname
    FROM ({ORDERS_PRIORITY_SQL}) o JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def flat_order(t):
    return models.flat_order(t.orders_priority, t.customer, t.nation, t.region)


@query(
    "star_line_item",
    f"""
    SELECT l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
           l_returnflag, l_linestatus, l_receiptdate, l_shipmode, o_custkey AS c_custkey
    FROM ({LINEITEM_DATES_SQL}) l JOIN orders ON l_orderkey = o_orderkey
    """,
)
def star_line_item(t):
    return models.star_line_item(t.lineitem_dates, t.orders)


@query(
    "star_customer",
    """
    SELECT c_custkey, c_name, n_name AS c_nationname, r_name AS c_regionname, c_acctbal, c_mktsegment
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def star_customer(t):
    return models.star_customer(t.customer, t.nation, t.region)


@query(
    "star_supplier",
    """
    SELECT s_suppkey, s_name, n_name AS s_nationname, r_name AS s_regionname, s_acctbal
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def star_supplier(t):
    return models.star_supplier(t.supplier, t.nation, t.region)


LINKS_SQL = """
SELECT p_partkey AS ps_partkey,
       (p_partkey + i * (s // 4 + CAST(trunc((p_partkey - 1) / s) AS BIGINT))) % s + 1 AS ps_suppkey
FROM part, (SELECT count(*) AS s FROM supplier), range(4) r(i)
"""


def links(t):
    return models.part_supplier_links(t.part, t.supplier.count())


@query("part_supplier_links", LINKS_SQL)
def part_supplier_links(t):
    return links(t)


@query(
    "part_supplier_star",
    f"""
    SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
           s_suppkey, s_name, n_name AS s_nationname, r_name AS s_regionname, s_acctbal
    FROM ({LINKS_SQL}) JOIN part ON ps_partkey = p_partkey JOIN supplier ON ps_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    """,
)
def part_supplier_star(t):
    return models.part_supplier_star(t.part, links(t), t.supplier, t.nation, t.region)


@query(
    "date_dim",
    """
    WITH days AS (
      SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS date
      FROM orders),
    n AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS orders FROM orders GROUP BY 1)
    SELECT row_number() OVER (ORDER BY date) AS "dateKey", date, month(date)::INT AS month, year(date)::INT AS year,
           year(date) || '-' || month(date) AS "yearMonthNum", year(date) || '-' || month(date) AS "yearMonth",
           (dayofweek(date) + 1)::INT AS "dayNumInWeek", day(date)::INT AS "dayNumInMonth",
           dayofyear(date)::INT AS "dayNumInYear", month(date)::INT AS "monthNumInYear",
           weekofyear(date)::INT AS "weekNumInYear", coalesce(orders, 0) AS orders
    FROM days LEFT JOIN n USING (date)
    """,
)
def date_dim(t):
    span = t.orders.agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    ).first()
    calendar = models.date_dim(t.spark, span["first"].isoformat(), (span["last"] - span["first"]).days + 1)
    per_day = t.orders.groupBy(F.to_date("o_orderdate").alias("date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return calendar.join(per_day, "date", "left").fillna(0, ["orders"])


@query(
    "sparse_order",
    """
    WITH cells AS (
      SELECT l_orderkey, 'part_' || l_partkey || '=' || sum(l_quantity)::BIGINT AS cell FROM lineitem GROUP BY l_orderkey, l_partkey
    ), rows AS (SELECT l_orderkey, count(*) AS parts, string_agg(cell, ',' ORDER BY cell) AS cells FROM cells GROUP BY ALL)
    SELECT o_orderkey, o_orderstatus, c_name, n_name AS c_nationname, r_name AS c_regionname,
           coalesce(parts, 0)::INT AS parts, coalesce(cells, '') AS cells
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey LEFT JOIN rows ON l_orderkey = o_orderkey
    """,
)
def sparse_order(t):
    wide = models.sparse_order(t.lineitem, t.orders, t.customer, t.nation, t.region)
    cells = F.transform(
        F.map_entries("quantities"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("long").cast("string"))
    )
    return wide.select(
        "o_orderkey", "o_orderstatus", "c_name", "c_nationname", "c_regionname",
        F.size("quantities").alias("parts"), F.array_join(F.array_sort(cells), ",").alias("cells"),
    )


@query(
    "sparsify",
    """
    SELECT count(*) AS rows, count(DISTINCT c_custkey) AS keys, 0::BIGINT AS changed, 0::BIGINT AS names_lost,
           true AS rates_hold, count(*) AS drawn_twice_alike
    FROM customer
    """,
)
def sparsify(t):
    rules = [(20.0, ["c_name"]), (12.5, ["c_name", "c_nationkey", "c_acctbal"])]
    thinned, again = (models.sparsify(t.customer, ["c_custkey"], rules, seed=7) for _ in range(2))
    rest = [c for c in t.customer.columns if c != "c_custkey"]
    old = t.customer.select("c_custkey", *[F.col(c).alias(f"_{c}") for c in rest])
    second = again.select("c_custkey", F.xxhash64(*rest).alias("_again"))
    both = thinned.join(old, "c_custkey").join(second, "c_custkey")
    differs = F.lit(False)
    for c in rest:
        differs = differs | (F.col(c).isNotNull() & ~F.col(c).eqNullSafe(F.col(f"_{c}")))
    # About 20 and 32.5 of a hundred rows; wide enough for the smallest folder.
    nation = F.count_if(F.col("c_nationkey").isNull()) / F.count(F.lit(1))
    segment = F.count_if(F.col("c_mktsegment").isNull()) / F.count(F.lit(1))
    return both.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("c_custkey").alias("keys"),
        F.count_if(differs).alias("changed"),
        F.count_if(F.col("c_name").isNull() & F.col("_c_name").isNotNull()).alias("names_lost"),
        (nation.between(0.08, 0.32) & segment.between(0.2, 0.45)).alias("rates_hold"),
        F.count_if(F.xxhash64(*rest) == F.col("_again")).alias("drawn_twice_alike"),
    )


@query(
    "order_rollup",
    """
    SELECT l_orderkey,
           sum((round(l_extendedprice * 100)::BIGINT * (100 - round(l_discount * 100)::BIGINT) // 100)
               * (100 + round(l_tax * 100)::BIGINT) // 100)::BIGINT AS total_cents,
           count(*) AS lines,
           CASE WHEN count(*) FILTER (l_shipdate <= DATE '1998-08-02') = count(*) THEN 'F'
                WHEN count(*) FILTER (l_shipdate <= DATE '1998-08-02') > 0 THEN 'P' ELSE 'O' END AS orderstatus
    FROM lineitem GROUP BY l_orderkey
    """,
)
def order_rollup(t):
    return models.order_rollup(t.lineitem, "1998-08-02")


@query(
    "line_status",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey,
           CASE WHEN l_shipdate <= DATE '1998-08-02' THEN 'F' ELSE 'O' END AS l_linestatus,
           CASE WHEN l_receiptdate <= DATE '1998-08-02' THEN l_returnflag ELSE 'N' END AS l_returnflag
    FROM ({LINEITEM_DATES_SQL})
    """,
)
def line_status(t):
    return models.line_status(t.lineitem_dates, "1998-08-02").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "l_returnflag"
    )


@query(
    "add_row_id",
    "SELECT event_id, user_id, row_number() OVER (ORDER BY user_id, ts, event_id) AS row_id FROM events",
)
def add_row_id(t):
    numbered = number_rows(t.events.select("event_id", "user_id", "ts"), ["user_id", "ts", "event_id"])
    return numbered.drop("ts")


# Scalar functions


@query(
    "fn_parse_time",
    """
    SELECT event_id, date_trunc('second', ts) AS parsed, CAST(ts AS DATE) AS day,
           event_type <> 'error' AS well_formed FROM events
    """,
)
def fn_parse_time(t):
    text = F.date_format("ts", "MM/dd/yyyy HH:mm:ss")
    dirty = F.when(F.col("event_type") == "error", F.concat(F.lit("?"), text)).otherwise(text)
    parsed = t.events.select(
        "event_id",
        scalars.us_timestamp(text).cast("timestamp_ntz").alias("parsed"),
        scalars.iso_date(F.date_format("ts", "yyyy-MM-dd")).alias("day"),
        scalars.us_timestamp(dirty).isNotNull().alias("well_formed"),
    )
    return parsed


@query(
    "fn_part_price",
    "SELECT p_partkey, 90000 + (p_partkey // 10) % 20001 + (p_partkey % 1000) * 100 AS cents FROM part",
)
def fn_part_price(t):
    return t.part.select("p_partkey", scalars.part_price_cents(F.col("p_partkey")).alias("cents"))


@query(
    "fn_order_key",
    "SELECT o_orderkey, ((o_orderkey >> 3) << 5) + (o_orderkey & 7) AS sparse_key FROM orders",
)
def fn_order_key(t):
    return t.orders.select("o_orderkey", scalars.sparse_order_key(F.col("o_orderkey")).alias("sparse_key"))


@query("fn_clerk", "SELECT o_orderkey, printf('Clerk#%09d', o_custkey) AS clerk FROM orders")
def fn_clerk(t):
    return t.orders.select("o_orderkey", scalars.clerk_label(F.col("o_custkey")).alias("clerk"))


@query("fn_varchar", "SELECT p_partkey, p_name[1:6] AS short_name FROM part")
def fn_varchar(t):
    return t.part.select("p_partkey", scalars.varchar(F.col("p_name"), 6).alias("short_name"))


@query(
    "fn_decimal",
    """
    SELECT o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(7,2))::DOUBLE AS price,
           TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NOT NULL AS fits FROM orders
    """,
)
def fn_decimal(t):
    price = scalars.decimal_or_null(F.col("o_totalprice"), 7, 2)
    return t.orders.select(
        "o_orderkey", price.cast("double").alias("price"), price.isNotNull().alias("fits")
    )


# Queries on wide rows and on key-value records

WIDE_SQL = {
    "q1": """
        SELECT l_returnflag, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
               round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
               round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
               round(sum(l_quantity) / count(*), 2) AS avg_qty,
               round(sum(l_extendedprice) / count(*), 2) AS avg_price,
               round(sum(l_discount) / count(*), 2) AS avg_disc, count(*) AS count_order
        FROM flat WHERE l_shipdate <= DATE '1998-12-01' - INTERVAL 90 DAY GROUP BY l_returnflag""",
    "q2": """
        SELECT o_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
               min(o_orderdate) AS o_orderdate, min(o_shippriority) AS o_shippriority
        FROM flat WHERE l_shipdate > DATE '1990-08-29' AND o_orderdate < DATE '2000-08-29'
        GROUP BY o_orderkey""",
    "q3": """
        SELECT o_orderpriority, count(*) AS order_count FROM flat
        WHERE o_orderdate >= DATE '1990-01-01' AND o_orderdate < DATE '1996-05-04'
          AND l_commitdate < l_receiptdate GROUP BY o_orderpriority""",
    "q4": """
        SELECT 'nation:' || s_nationname AS nation,
               round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
        FROM flat WHERE o_orderdate >= DATE '1992-01-01' AND o_orderdate < DATE '1998-04-02'
        GROUP BY s_nationname""",
    "q5": """
        SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue FROM flat
        WHERE l_shipdate >= DATE '1990-01-01' AND l_shipdate < DATE '1996-08-09'
          AND l_discount >= 0.04::DOUBLE AND l_discount <= 0.06::DOUBLE AND l_quantity < 40""",
}
WIDE_PLAN = {
    "q1": wide.pricing_by_flag,
    "q2": lambda df: rounded(wide.revenue_by_order(df), 4, "revenue"),
    "q3": wide.late_lines_by_priority,
    "q4": lambda df: rounded(wide.revenue_by_supplier_nation(df), 4, "revenue"),
    "q5": lambda df: rounded(wide.discount_revenue(df), 2, "revenue"),
}
RECORD_FIELDS = {
    "l_quantity": "double",
    "l_extendedprice": "double",
    "l_discount": "double",
    "l_tax": "double",
    "l_returnflag": "string",
    "l_shipdate": "date",
    "l_commitdate": "date",
    "l_receiptdate": "date",
    "o_orderkey": "bigint",
    "o_orderdate": "date",
    "o_orderpriority": "string",
    "o_shippriority": "int",
    "s_nationname": "string",
}


FLAT_INPUTS = ("lineitem", "orders", "customer", "part", "supplier", "nation", "region")


def shape_store(t):
    return ShapeStore(t.spark, f"{shared_root(t.spark)}/olapkit/shapes")


def flat_shape(t):
    """The wide rows as they are loaded: once for these input files, whatever the number of queries."""
    return Shape("flat_line_item", tuple(t.path(n) for n in FLAT_INPUTS), lambda: flat(t), sort_by=("l_shipdate",))


def record_shape(t):
    def build():
        rows = unique_ids(shape_store(t).read(flat_shape(t)), "linenumber_id")
        return to_hash_records(rows, ["linenumber_id"])

    return Shape("flat_records", tuple(t.path(n) for n in FLAT_INPUTS), build)


for _name, _plan in WIDE_PLAN.items():
    _sql = f"WITH flat AS ({FLAT_SQL}) {WIDE_SQL[_name]}"
    query(f"flat_{_name}", _sql)(lambda t, plan=_plan: plan(shape_store(t).read(flat_shape(t))))
    query(f"kv_{_name}", _sql)(
        lambda t, plan=_plan: plan(from_hash_records(shape_store(t).read(record_shape(t)), RECORD_FIELDS))
    )


@query("stored_flat", f"SELECT * REPLACE (l_discount + 0.0 AS l_discount, l_tax + 0.0 AS l_tax) FROM ({FLAT_SQL})")
def stored_flat(t):
    return shape_store(t).read(flat_shape(t))


# Queries on the keyed store's line items

STORE_SQL = """
SELECT l_returnflag, l_linestatus, sum(l_quantity)::BIGINT AS sum_qty,
       round(sum(l_extendedprice), 2) AS sum_base_price, round(avg(l_quantity), 4) AS avg_qty,
       round(avg(l_extendedprice), 4) AS avg_price, round(avg(l_discount), 6) AS avg_disc,
       count(*) AS count_order
FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') <= '1998-09-02' {extra}
GROUP BY l_returnflag, l_linestatus
"""


def shown(df):
    return rounded(rounded(rounded(df, 2, "sum_base_price"), 4, "avg_qty", "avg_price"), 6, "avg_disc")


@query("store_q1", STORE_SQL.format(extra=""))
def store_q1(t):
    return shown(store.pricing(store.store_line_item(t.lineitem)))


@query(
    "store_matching_rows",
    "SELECT count(*) AS matching_rows FROM lineitem WHERE strftime(l_shipdate, '%Y-%m-%d') <= '1998-09-02'",
)
def store_matching_rows(t):
    return store.matching_rows(store.pricing(store.store_line_item(t.lineitem)))


@query("store_q1_range", STORE_SQL.format(extra="AND l_orderkey BETWEEN 100 AND 14000"))
def store_q1_range(t):
    return shown(store.pricing_of_orders(store.store_line_item(t.lineitem), 100, 14000))


@query("count_quantity", "SELECT count(*) AS n FROM lineitem WHERE l_quantity = 48")
def count_quantity(t):
    return t.lineitem.filter(F.col("l_quantity") == 48).agg(F.count(F.lit(1)).alias("n"))


@query("count_key", "SELECT count(*) AS n FROM lineitem WHERE l_orderkey = 2000")
def count_key(t):
    return t.lineitem.filter(F.col("l_orderkey") == 2000).agg(F.count(F.lit(1)).alias("n"))
