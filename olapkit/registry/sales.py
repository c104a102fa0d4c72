"""Decision-support queries on the snowflake tables."""

from olapkit.plans import sales
from olapkit.plans.tables import LINEITEM_DATES_SQL, ORDERS_PRIORITY_SQL
from olapkit.registry.base import query, rounded


@query(
    "q1_pricing_summary",
    """
    SELECT l_returnflag, l_linestatus,
           sum(l_quantity) AS sum_qty,
           round(sum(l_extendedprice), 2) AS sum_base_price,
           round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price,
           round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
           round(avg(l_quantity), 4) AS avg_qty,
           round(avg(l_extendedprice), 4) AS avg_price,
           round(avg(l_discount), 6) AS avg_disc,
           count(*) AS count_order
    FROM lineitem
    WHERE l_shipdate <= DATE '1998-12-01' - INTERVAL 90 DAY
    GROUP BY l_returnflag, l_linestatus
    """,
)
def q1(t):
    df = sales.pricing_summary(t.lineitem)
    # Net prices have four decimals: rounded there, no sum lies between two results.
    df = rounded(df, 2, "sum_base_price", "sum_charge")
    df = rounded(df, 4, "sum_disc_price", "avg_qty", "avg_price")
    return rounded(df, 6, "avg_disc")


@query(
    "q2_order_revenue",
    f"""
    WITH o AS ({ORDERS_PRIORITY_SQL})
    SELECT l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
           o_orderdate, o_shippriority
    FROM customer, o, lineitem
    WHERE c_mktsegment = 'HOUSEHOLD' AND c_custkey = o_custkey AND l_orderkey = o_orderkey
      AND o_orderdate < DATE '2000-08-29' AND l_shipdate > DATE '1990-08-29'
    GROUP BY l_orderkey, o_orderdate, o_shippriority
    """,
)
def q2(t):
    return rounded(sales.order_revenue(t.customer, t.orders_priority, t.lineitem), 4, "revenue")


@query(
    "q3_priority_count",
    f"""
    WITH l AS ({LINEITEM_DATES_SQL})
    SELECT o_orderpriority, count(*) AS order_count
    FROM orders
    WHERE o_orderdate >= DATE '1990-01-01' AND o_orderdate < DATE '1996-05-04' + INTERVAL 3 MONTH
      AND EXISTS (SELECT * FROM l WHERE l_orderkey = o_orderkey AND l_commitdate < l_receiptdate)
    GROUP BY o_orderpriority
    """,
)
def q3(t):
    return sales.priority_count(t.orders, t.lineitem_dates)


@query(
    "q4_local_supplier",
    """
    SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue
    FROM customer, orders, lineitem, supplier, nation, region
    WHERE c_custkey = o_custkey AND l_orderkey = o_orderkey AND l_suppkey = s_suppkey
      AND c_nationkey = s_nationkey AND s_nationkey = n_nationkey AND n_regionkey = r_regionkey
      AND r_name = 'AMERICA'
      AND o_orderdate >= DATE '1992-01-01' AND o_orderdate < DATE '1998-04-02' + INTERVAL 1 YEAR
    GROUP BY n_name
    """,
)
def q4(t):
    return rounded(
        sales.local_supplier_volume(
            t.customer, t.orders, t.lineitem, t.supplier, t.nation, t.region
        ),
        4,
        "revenue",
    )


@query(
    "q5_forecast",
    """
    SELECT round(sum(l_extendedprice * l_discount), 2) AS revenue
    FROM lineitem
    WHERE l_shipdate >= DATE '1990-01-01' AND l_shipdate < DATE '1996-08-09' + INTERVAL 1 YEAR
      AND l_discount BETWEEN 0.04::DOUBLE AND 0.06::DOUBLE AND l_quantity < 40
    """,
)
def q5(t):
    return rounded(sales.forecast_revenue(t.lineitem), 2, "revenue")
