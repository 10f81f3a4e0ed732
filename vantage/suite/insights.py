"""Insight specs (queryBuilder mode): flagship, filters, joins, aggregates, pivot, order/limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.plans.builder import InsightBuilder, join_on, select_def, where_def
from vantage.plans.insight import run_insight
from vantage.sources.tables import TableResolver, read_table
from vantage.suite.registry import register, rounded, rounded_ratio


def resolver(spark: SparkSession, sf_dir: str) -> TableResolver:
    """Driver tables plus datasets derived from them that carry NULLs, empty strings and booleans
    (the driver tables have none). Derived datasets are built only when a spec names them."""
    r = TableResolver(spark, sf_dir)

    def cust():
        c = read_table(spark, sf_dir, "customer")
        return c.withColumn(
            "c_segment",
            F.when(F.col("c_mktsegment") == "BUILDING", F.lit(None).cast("string"))
             .when(F.col("c_mktsegment") == "MACHINERY", F.lit(""))
             .otherwise(F.col("c_mktsegment")))

    def lines():
        return read_table(spark, sf_dir, "lineitem").withColumn(
            "l_is_return",
            F.when(F.col("l_returnflag") == "R", F.lit(True))
             .when(F.col("l_returnflag") == "N", F.lit(False)))

    def line_returns():
        li = read_table(spark, sf_dir, "lineitem")
        return li.filter(F.col("l_returnflag") == "R").select(
            F.col("l_orderkey").alias("r_orderkey"), F.col("l_linenumber").alias("r_linenumber"),
            F.col("l_quantity").alias("r_quantity"))

    r.bind("cust", cust)
    r.bind("lines", lines)
    r.bind("big_orders", lambda: read_table(spark, sf_dir, "orders").filter(F.col("o_totalprice") > 400000))
    r.bind("rich_cust", lambda: read_table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 5000))
    r.bind("line_returns", line_returns)
    return r


# Oracle-side definitions of the derived datasets above.
CUST_SQL = """(SELECT *, CASE WHEN c_mktsegment = 'BUILDING' THEN NULL
                              WHEN c_mktsegment = 'MACHINERY' THEN ''
                              ELSE c_mktsegment END AS c_segment FROM customer)"""
LINES_SQL = """(SELECT *, CASE WHEN l_returnflag = 'R' THEN TRUE
                               WHEN l_returnflag = 'N' THEN FALSE END AS l_is_return FROM lineitem)"""
BIG_ORDERS_SQL = "(SELECT * FROM orders WHERE o_totalprice > 400000)"


# -- flagship -----------------------------------------------------------------------------------

def revenue_by_segment_spec(limit: int = 3) -> dict:
    return (InsightBuilder()
            .set_name("revenue by segment")
            .add_dataset("customer")
            .add_dataset("orders", "inner", [join_on("customer", "c_custkey", "orders", "o_custkey")])
            .add_select("c_mktsegment", label="segment")
            .add_select("o_totalprice", "orders", aggregate="sum", label="revenue")
            .add_select("o_orderkey", "orders", aggregate="count", label="n_orders")
            .add_filter("o_orderstatus", "equals", "F", dataset_id="orders")
            .add_order_by("o_totalprice", "orders", aggregate="sum", direction="desc")
            .add_order_by("c_mktsegment")
            .set_limit(limit)
            .build())


@register("insight_revenue_by_segment", """
SELECT c_mktsegment AS segment, round(sum(o_totalprice), 2) AS revenue, count(o_orderkey) AS n_orders
FROM customer JOIN orders ON c_custkey = o_custkey
WHERE o_orderstatus = 'F'
GROUP BY c_mktsegment ORDER BY sum(o_totalprice) DESC, c_mktsegment LIMIT 3
""")
def insight_revenue_by_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(run_insight(revenue_by_segment_spec(3), resolver(spark, sf_dir)), 2, "revenue")


@register("insight_revenue_eager", """
SELECT c_mktsegment AS segment, c_nationkey AS nation, round(sum(o_totalprice), 2) AS revenue,
       count(o_orderkey) AS n_orders, min(o_orderdate) AS first_order, max(o_totalprice) AS top_order,
       round(avg(o_totalprice) + 1e-9, 4) AS avg_order
FROM customer JOIN orders ON c_custkey = o_custkey
WHERE o_orderstatus <> 'P' AND c_acctbal > 0
GROUP BY c_mktsegment, c_nationkey HAVING count(o_orderkey) > 20
""")
def insight_revenue_eager(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five aggregates of one measured dataset over a join, two keys, and a filter on a count."""
    spec = (InsightBuilder()
            .add_dataset("customer")
            .add_dataset("orders", "inner", [join_on("customer", "c_custkey", "orders", "o_custkey")])
            .add_select("c_mktsegment", label="segment").add_select("c_nationkey", label="nation")
            .add_select("o_totalprice", "orders", "sum", "revenue")
            .add_select("o_orderkey", "orders", "count", "n_orders")
            .add_select("o_orderdate", "orders", "min", "first_order")
            .add_select("o_totalprice", "orders", "max", "top_order")
            .add_select("o_totalprice", "orders", "avg", "avg_order")
            .add_filter("o_orderstatus", "not_equals", "P", dataset_id="orders")
            .add_filter("c_acctbal", "greater_than", 0)
            .add_filter_defs([where_def("o_orderkey", "orders", "greater_than", 20, aggregate="count")])
            .build())
    out = run_insight(spec, resolver(spark, sf_dir))
    return rounded_ratio(rounded(out, 2, "revenue"), 4, "avg_order")


# -- filters ------------------------------------------------------------------------------------

def _filter_query(dataset: str, columns: list[str], column: str, operator: str, value=None):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = InsightBuilder().add_dataset(dataset)
        for c in columns:
            b.add_select(c)
        b.add_filter(column, operator, value)
        return run_insight(b.build(), resolver(spark, sf_dir))
    return run


def _sql_cond(column: str, operator: str, value) -> str:
    lit = (f"'{value}'" if isinstance(value, str) else repr(value))
    return {
        "equals": f"{column} = {lit}",
        "not_equals": f"{column} <> {lit}",
        "like": f"CAST({column} AS VARCHAR) LIKE {lit} ESCAPE '\\'",
        "not_like": f"NOT (CAST({column} AS VARCHAR) LIKE {lit} ESCAPE '\\')",
        "starts_with": f"starts_with(CAST({column} AS VARCHAR), {lit})",
        "ends_with": f"ends_with(CAST({column} AS VARCHAR), {lit})",
        "contains": f"contains(CAST({column} AS VARCHAR), {lit})",
        "not_contains": f"NOT contains(CAST({column} AS VARCHAR), {lit})",
        "is_null": f"{column} IS NULL",
        "is_not_null": f"{column} IS NOT NULL",
        "greater_than": f"{column} > {lit}",
        "less_than": f"{column} < {lit}",
        "greater_or_equals": f"{column} >= {lit}",
        "less_or_equals": f"{column} <= {lit}",
        "is_null_or_empty": f"({column} IS NULL OR {column} = '')",
        "is_not_null_or_empty": f"({column} IS NOT NULL AND {column} <> '')",
        "is_true": f"{column} = TRUE",
        "is_false": f"{column} = FALSE",
    }[operator]


_FILTER_CASES = [
    # operator, dataset, oracle source, columns, filtered column, value
    ("equals", "cust", CUST_SQL, ["c_custkey", "c_segment"], "c_segment", "HOUSEHOLD"),
    ("not_equals", "cust", CUST_SQL, ["c_custkey", "c_segment"], "c_segment", "HOUSEHOLD"),
    ("like", "part", "part", ["p_partkey", "p_name"], "p_name", "%re_ %"),
    ("not_like", "part", "part", ["p_partkey", "p_name"], "p_name", "%bolt%"),
    ("starts_with", "customer", "customer", ["c_custkey", "c_name"], "c_name", "Customer#00000001"),
    ("ends_with", "part", "part", ["p_partkey", "p_name"], "p_name", "widget"),
    ("contains", "part", "part", ["p_partkey", "p_name"], "p_name", "ring"),
    ("not_contains", "cust", CUST_SQL, ["c_custkey", "c_segment"], "c_segment", "U"),
    ("is_null", "cust", CUST_SQL, ["c_custkey", "c_segment"], "c_segment", None),
    ("is_not_null", "cust", CUST_SQL, ["c_custkey", "c_segment"], "c_segment", None),
    ("greater_than", "orders", "orders", ["o_orderkey", "o_totalprice"], "o_totalprice", 400000),
    ("less_than", "customer", "customer", ["c_custkey", "c_acctbal"], "c_acctbal", 1000),
    ("greater_or_equals", "orders", "orders", ["o_orderkey", "o_orderdate"], "o_orderdate", "1998-01-01"),
    ("less_or_equals", "part", "part", ["p_partkey", "p_size"], "p_size", 10),
    ("is_null_or_empty", "cust", CUST_SQL, ["c_custkey", "c_segment"], "c_segment", None),
    ("is_not_null_or_empty", "cust", CUST_SQL, ["c_custkey", "c_segment"], "c_segment", None),
    ("is_true", "lines", LINES_SQL, ["l_orderkey", "l_linenumber", "l_is_return"], "l_is_return", None),
    ("is_false", "lines", LINES_SQL, ["l_orderkey", "l_linenumber", "l_is_return"], "l_is_return", None),
]

for _op, _ds, _src, _cols, _col, _val in _FILTER_CASES:
    register(f"filter_{_op}",
             f"SELECT {', '.join(_cols)} FROM {_src} t WHERE {_sql_cond(_col, _op, _val)}"
             )(_filter_query(_ds, _cols, _col, _op, _val))


@register("filter_and", """
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderstatus = 'O' AND o_totalprice > 200000 AND starts_with(o_orderpriority, '1')
""")
def filter_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = (InsightBuilder().add_dataset("orders")
            .add_select("o_orderkey").add_select("o_orderpriority")
            .add_filter("o_orderstatus", "equals", "O")
            .add_filter("o_totalprice", "greater_than", 200000)
            .add_filter("o_orderpriority", "starts_with", "1")
            .build())
    return run_insight(spec, resolver(spark, sf_dir))


@register("having_sum", """
SELECT o_custkey, count(o_orderkey) AS n_orders FROM orders
GROUP BY o_custkey HAVING sum(o_totalprice) > 3000000
""")
def having_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = (InsightBuilder().add_dataset("orders")
            .add_select("o_custkey").add_select("o_orderkey", aggregate="count", label="n_orders")
            .add_filter_defs([where_def("o_totalprice", "orders", "greater_than", 3000000, aggregate="sum")])
            .build())
    return run_insight(spec, resolver(spark, sf_dir))


# -- joins --------------------------------------------------------------------------------------

def _join_spec(first: str, second: str, how: str, conds: list, selects: list[tuple[str, str]]) -> dict:
    b = InsightBuilder().add_dataset(first).add_dataset(second, how, conds)
    for ds, col in selects:
        b.add_select(col, ds)
    return b.build()


@register("join_inner", """
SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def join_inner(spark, sf_dir):
    spec = _join_spec("nation", "region", "inner", [join_on("nation", "n_regionkey", "region", "r_regionkey")],
                      [("nation", "n_name"), ("region", "r_name")])
    return run_insight(spec, resolver(spark, sf_dir))


@register("join_left", f"""
SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN {BIG_ORDERS_SQL} b ON c_custkey = o_custkey
""")
def join_left(spark, sf_dir):
    spec = _join_spec("customer", "big_orders", "left",
                      [join_on("customer", "c_custkey", "big_orders", "o_custkey")],
                      [("customer", "c_custkey"), ("big_orders", "o_orderkey"), ("big_orders", "o_totalprice")])
    return run_insight(spec, resolver(spark, sf_dir))


@register("join_right", f"""
SELECT o_orderkey, c_custkey, c_name FROM {BIG_ORDERS_SQL} b RIGHT JOIN customer ON o_custkey = c_custkey
""")
def join_right(spark, sf_dir):
    spec = _join_spec("big_orders", "customer", "right",
                      [join_on("big_orders", "o_custkey", "customer", "c_custkey")],
                      [("big_orders", "o_orderkey"), ("customer", "c_custkey"), ("customer", "c_name")])
    return run_insight(spec, resolver(spark, sf_dir))


@register("join_full", f"""
SELECT o_orderkey, c_custkey FROM {BIG_ORDERS_SQL} b
FULL OUTER JOIN (SELECT * FROM customer WHERE c_acctbal > 5000) c ON o_custkey = c_custkey
""")
def join_full(spark, sf_dir):
    spec = _join_spec("big_orders", "rich_cust", "full",
                      [join_on("big_orders", "o_custkey", "rich_cust", "c_custkey")],
                      [("big_orders", "o_orderkey"), ("rich_cust", "c_custkey")])
    return run_insight(spec, resolver(spark, sf_dir))


@register("join_semi", f"""
SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM {BIG_ORDERS_SQL} b)
""")
def join_semi(spark, sf_dir):
    spec = _join_spec("customer", "big_orders", "semi",
                      [join_on("customer", "c_custkey", "big_orders", "o_custkey")],
                      [("customer", "c_custkey"), ("customer", "c_name")])
    return run_insight(spec, resolver(spark, sf_dir))


@register("join_anti", f"""
SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS
  (SELECT 1 FROM {BIG_ORDERS_SQL} b WHERE b.o_custkey = customer.c_custkey)
""")
def join_anti(spark, sf_dir):
    spec = _join_spec("customer", "big_orders", "anti",
                      [join_on("customer", "c_custkey", "big_orders", "o_custkey")],
                      [("customer", "c_custkey"), ("customer", "c_name")])
    return run_insight(spec, resolver(spark, sf_dir))


@register("join_cross", """
SELECT r_name, n_name FROM region CROSS JOIN nation
""")
def join_cross(spark, sf_dir):
    # region has five rows by definition of the schema, so the product is bounded by 5 x nation.
    b = InsightBuilder().add_dataset("region").add_dataset("nation", "cross", allow_product=True)
    spec = b.add_select("r_name", "region").add_select("n_name", "nation").build()
    return run_insight(spec, resolver(spark, sf_dir))


@register("join_multikey", """
SELECT l_orderkey, l_linenumber, l_quantity, r_quantity
FROM lineitem JOIN (SELECT l_orderkey AS r_orderkey, l_linenumber AS r_linenumber, l_quantity AS r_quantity
                    FROM lineitem WHERE l_returnflag = 'R') r
  ON l_orderkey = r_orderkey AND l_linenumber = r_linenumber
""")
def join_multikey(spark, sf_dir):
    spec = _join_spec("lineitem", "line_returns", "inner",
                      [join_on("lineitem", "l_orderkey", "line_returns", "r_orderkey"),
                       join_on("lineitem", "l_linenumber", "line_returns", "r_linenumber")],
                      [("lineitem", "l_orderkey"), ("lineitem", "l_linenumber"), ("lineitem", "l_quantity"),
                       ("line_returns", "r_quantity")])
    return run_insight(spec, resolver(spark, sf_dir))


@register("join_chain", """
SELECT r_name AS region, count(o_orderkey) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM region JOIN nation ON r_regionkey = n_regionkey
JOIN customer ON n_nationkey = c_nationkey
JOIN orders ON c_custkey = o_custkey
GROUP BY r_name
""")
def join_chain(spark, sf_dir):
    spec = (InsightBuilder()
            .add_dataset("region")
            .add_dataset("nation", "inner", [join_on("region", "r_regionkey", "nation", "n_regionkey")])
            .add_dataset("customer", "inner", [join_on("nation", "n_nationkey", "customer", "c_nationkey")])
            .add_dataset("orders", "inner", [join_on("customer", "c_custkey", "orders", "o_custkey")])
            .add_select("r_name", label="region")
            .add_select("o_orderkey", "orders", "count", "n_orders")
            .add_select("o_totalprice", "orders", "sum", "revenue")
            .build())
    return rounded(run_insight(spec, resolver(spark, sf_dir)), 2, "revenue")


# -- aggregates ---------------------------------------------------------------------------------

@register("agg_global", """
SELECT round(sum(l_quantity), 2) AS sum_qty, count(l_orderkey) AS n_lines,
       round(avg(l_extendedprice) + 1e-9, 4) AS avg_price, min(l_shipdate) AS first_ship, max(l_discount) AS max_disc
FROM lineitem
""")
def agg_global(spark, sf_dir):
    spec = (InsightBuilder().add_dataset("lineitem")
            .add_select("l_quantity", aggregate="sum", label="sum_qty")
            .add_select("l_orderkey", aggregate="count", label="n_lines")
            .add_select("l_extendedprice", aggregate="avg", label="avg_price")
            .add_select("l_shipdate", aggregate="min", label="first_ship")
            .add_select("l_discount", aggregate="max", label="max_disc")
            .build())
    out = run_insight(spec, resolver(spark, sf_dir))
    return rounded_ratio(rounded(out, 2, "sum_qty"), 4, "avg_price")


@register("agg_count_distinct", """
SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers, count(o_orderkey) AS n_orders
FROM orders GROUP BY o_orderstatus
""")
def agg_count_distinct(spark, sf_dir):
    spec = (InsightBuilder().add_dataset("orders")
            .add_select("o_orderstatus")
            .add_select("o_custkey", aggregate="count_distinct", label="n_customers")
            .add_select("o_orderkey", aggregate="count", label="n_orders")
            .build())
    return run_insight(spec, resolver(spark, sf_dir))


@register("agg_avg_min_max", """
SELECT l_returnflag, l_linestatus, round(avg(l_quantity) + 1e-9, 4) AS avg_qty,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price, count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def agg_avg_min_max(spark, sf_dir):
    spec = (InsightBuilder().add_dataset("lineitem")
            .add_select("l_returnflag").add_select("l_linestatus")
            .add_select("l_quantity", aggregate="avg", label="avg_qty")
            .add_select("l_extendedprice", aggregate="min", label="min_price")
            .add_select("l_extendedprice", aggregate="max", label="max_price")
            .add_select("*", aggregate="count", label="n")
            .build())
    return rounded_ratio(run_insight(spec, resolver(spark, sf_dir)), 4, "avg_qty")


@register("pivot_status", """
SELECT o_orderpriority AS priority,
       round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS "F",
       round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 2) AS "O",
       round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS "P"
FROM orders GROUP BY o_orderpriority
""")
def pivot_status(spark, sf_dir):
    spec = (InsightBuilder().add_dataset("orders")
            .add_select("o_orderpriority", label="priority")
            .add_select("o_orderstatus", label="status")
            .add_select("o_totalprice", aggregate="sum", label="revenue")
            .set_pivot(rows=["priority"], columns=[{"label": "status", "values": ["F", "O", "P"]}],
                       values=["revenue"])
            .build())
    return rounded(run_insight(spec, resolver(spark, sf_dir)), 2, "F", "O", "P")


# -- order and limit ----------------------------------------------------------------------------

@register("order_by_unselected_agg", """
SELECT o_custkey, count(o_orderkey) AS n_orders FROM orders
GROUP BY o_custkey ORDER BY sum(o_totalprice) DESC, o_custkey LIMIT 10
""")
def order_by_unselected_agg(spark, sf_dir):
    spec = (InsightBuilder().add_dataset("orders")
            .add_select("o_custkey").add_select("o_orderkey", aggregate="count", label="n_orders")
            .add_order_by("o_totalprice", aggregate="sum", direction="desc")
            .add_order_by("o_custkey")
            .set_limit(10)
            .build())
    return run_insight(spec, resolver(spark, sf_dir))


@register("limit_zero", """
SELECT o_orderkey FROM orders LIMIT 0
""")
def limit_zero(spark, sf_dir):
    spec = InsightBuilder().add_dataset("orders").add_select("o_orderkey").set_limit(0).build()
    return run_insight(spec, resolver(spark, sf_dir))


@register("insight_v3_spec", """
SELECT n_name AS nation, count(c_custkey) AS n_customers FROM nation JOIN customer ON n_nationkey = c_nationkey
WHERE c_mktsegment <> 'AUTOMOBILE'
GROUP BY n_name ORDER BY n_customers DESC, nation LIMIT 5
""")
def insight_v3_spec(spark, sf_dir):
    spec = (InsightBuilder(version=3).add_dataset("nation")
            .add_dataset("customer", "inner", [join_on("nation", "n_nationkey", "customer", "c_nationkey")])
            .add_select("n_name", label="nation")
            .add_select_defs([select_def("c_custkey", "customer", "count", "n_customers")])
            .add_filter("c_mktsegment", "not_equals", "AUTOMOBILE", dataset_id="customer")
            .add_order_by("c_custkey", "customer", aggregate="count", direction="desc")
            .add_order_by("n_name")
            .set_limit(5)
            .build())
    return run_insight(spec, resolver(spark, sf_dir))
