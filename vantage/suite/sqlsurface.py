"""SQL surface: placeholders, positional/named arguments, variables, FROM-first, export, SQL text
features (windows, set operations, rollup, CTE, semi/anti, scalar and JSON functions)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from vantage.plans.builder import InsightBuilder
from vantage.plans.insight import run_insight
from vantage.plans.sql import execute_sql, export, export_query
from vantage.sources.datasets import read_dataset
from vantage.sources.tables import TableResolver
from vantage.session import scratch_path
from vantage.suite.registry import register


def _sql(spark: SparkSession, sf_dir: str, text: str, ids: list[str], **kw) -> DataFrame:
    return execute_sql(spark, text, ids, resolve=TableResolver(spark, sf_dir), **kw)


@register("sql_positional", """
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS revenue
FROM orders WHERE o_totalprice > 300000 AND o_orderpriority = '1-URGENT' GROUP BY o_orderstatus
""")
def sql_positional(spark, sf_dir):
    text = """SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS revenue
              FROM '{{orders}}' WHERE o_totalprice > ? AND o_orderpriority = ? GROUP BY o_orderstatus"""
    return _sql(spark, sf_dir, text, ["orders"], args=[300000, "1-URGENT"])


@register("sql_named", """
SELECT o_orderpriority, count(*) AS n FROM orders
WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY o_orderpriority
""")
def sql_named(spark, sf_dir):
    text = """SELECT o_orderpriority, count(*) AS n FROM '{{orders}}'
              WHERE o_orderdate >= CAST(:start AS TIMESTAMP_NTZ) AND o_orderdate < CAST(:stop AS TIMESTAMP_NTZ)
              GROUP BY o_orderpriority"""
    return _sql(spark, sf_dir, text, ["orders"], named_args={"start": "1997-01-01", "stop": "1998-01-01"})


@register("sql_placeholder", """
SELECT n_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance
FROM nation n JOIN customer c ON n.n_nationkey = c.c_nationkey GROUP BY n_name
""")
def sql_placeholder(spark, sf_dir):
    text = """SELECT n_name, count(*) AS n_customers, round(sum(c_acctbal), 2) AS balance
              FROM '{{nation}}' n JOIN '{{customer}}' c ON n.n_nationkey = c.c_nationkey GROUP BY n_name"""
    return _sql(spark, sf_dir, text, ["nation", "customer"])


SQL_VARIABLES_TEXT = """SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM '{{orders}}' WHERE o_orderstatus = :status AND o_totalprice >= :min_price GROUP BY o_custkey"""


@register("sql_variables", """
SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS revenue
FROM orders WHERE o_orderstatus = 'P' AND o_totalprice >= 250000 GROUP BY o_custkey
""")
def sql_variables(spark, sf_dir):
    spec = (InsightBuilder().set_mode("sqlEditor").set_sql(SQL_VARIABLES_TEXT)
            .add_sql_variable("v1", "status", "Status", custom_values="F,O,P", default_value="O")
            .add_sql_variable("v2", "min_price", "Minimum price", type="number", input_option="text",
                              default_value="250000")
            .build())
    return run_insight(spec, TableResolver(spark, sf_dir), variables={"status": "P"}, spark=spark)


@register("insight_sql_mode", """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
       round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n
FROM lineitem GROUP BY l_returnflag, l_linestatus
""")
def insight_sql_mode(spark, sf_dir):
    text = """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
                     round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue, count(*) AS n
              FROM '{{lineitem}}' GROUP BY l_returnflag, l_linestatus"""
    spec = InsightBuilder().set_mode("sqlEditor").set_sql(text).build()
    return run_insight(spec, TableResolver(spark, sf_dir), spark=spark)


@register("sql_from_first", "FROM orders")
def sql_from_first(spark, sf_dir):
    return _sql(spark, sf_dir, export_query("orders"), ["orders"])


@register("export_query", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def export_query_roundtrip(spark, sf_dir):
    """Export (default whole-table query) written as Parquet to the shared folder, read back."""
    out = scratch_path(spark, "exports", uuid.uuid4().hex)
    export(spark, "orders", out, TableResolver(spark, sf_dir))
    return read_dataset(spark, out)


# -- SQL text features (X7) -----------------------------------------------------------------------

@register("sql_window", """
SELECT o_custkey, o_orderkey, o_totalprice, CAST(rn AS INTEGER) AS rn FROM (
  SELECT o_custkey, o_orderkey, o_totalprice,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
  FROM orders) t WHERE rn <= 2
""")
def sql_window(spark, sf_dir):
    # rn <= k lets Spark insert a partial WindowGroupLimit before the shuffle, so a hot customer
    # contributes at most k rows per input partition to the exchange.
    text = """SELECT o_custkey, o_orderkey, o_totalprice, rn FROM (
                SELECT o_custkey, o_orderkey, o_totalprice,
                       row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rn
                FROM '{{orders}}') t WHERE rn <= 2"""
    return _sql(spark, sf_dir, text, ["orders"])


@register("sql_setops", """
(SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'
 INTERSECT SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
UNION
(SELECT c_custkey AS o_custkey FROM customer WHERE c_acctbal > 9000
 EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def sql_setops(spark, sf_dir):
    text = """(SELECT o_custkey FROM '{{orders}}' WHERE o_orderstatus = 'F'
               INTERSECT SELECT o_custkey FROM '{{orders}}' WHERE o_orderpriority = '1-URGENT')
              UNION
              (SELECT c_custkey AS o_custkey FROM '{{customer}}' WHERE c_acctbal > 9000
               EXCEPT SELECT o_custkey FROM '{{orders}}' WHERE o_orderstatus = 'P')"""
    return _sql(spark, sf_dir, text, ["orders", "customer"])


@register("sql_rollup", """
SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)
""")
def sql_rollup(spark, sf_dir):
    text = """SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS revenue
              FROM '{{orders}}' GROUP BY ROLLUP (o_orderstatus, o_orderpriority)"""
    return _sql(spark, sf_dir, text, ["orders"])


@register("sql_cte", """
WITH per_cust AS (SELECT o_custkey, sum(o_totalprice) AS spent FROM orders GROUP BY o_custkey),
     ranked AS (SELECT c_mktsegment, spent FROM per_cust JOIN customer ON o_custkey = c_custkey)
SELECT c_mktsegment, count(*) AS n_customers, round(avg(spent) + 1e-9, 2) AS avg_spent, round(max(spent), 2) AS max_spent
FROM ranked GROUP BY c_mktsegment
""")
def sql_cte(spark, sf_dir):
    text = """WITH per_cust AS (SELECT o_custkey, sum(o_totalprice) AS spent FROM '{{orders}}' GROUP BY o_custkey),
                   ranked AS (SELECT c_mktsegment, spent FROM per_cust JOIN '{{customer}}' ON o_custkey = c_custkey)
              SELECT c_mktsegment, count(*) AS n_customers, round(avg(spent) + 1e-9, 2) AS avg_spent,
                     round(max(spent), 2) AS max_spent
              FROM ranked GROUP BY c_mktsegment"""
    return _sql(spark, sf_dir, text, ["orders", "customer"])


@register("sql_semi_anti", """
SELECT s_suppkey, s_name,
       EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_returnflag = 'R') AS has_returns
FROM supplier
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49 AND l_discount >= 0.1 AND l_tax >= 0.08)
""")
def sql_semi_anti(spark, sf_dir):
    text = """SELECT s_suppkey, s_name,
                     EXISTS (SELECT 1 FROM '{{lineitem}}' WHERE l_suppkey = s_suppkey AND l_returnflag = 'R') AS has_returns
              FROM '{{supplier}}'
              WHERE NOT EXISTS (SELECT 1 FROM '{{lineitem}}' WHERE l_suppkey = s_suppkey AND l_quantity > 49 AND l_discount >= 0.1 AND l_tax >= 0.08)"""
    return _sql(spark, sf_dir, text, ["lineitem", "supplier"])


@register("sql_scalar", """
SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, upper(substr(o_orderpriority, 3)) AS prio,
       count(*) AS n, round(sum(o_totalprice) / 1000 + 1e-9, 3) AS revenue_k,
       CAST(max(length(concat(o_orderstatus, '-', o_orderpriority))) AS INTEGER) AS max_len,
       CAST(min(date_diff('day', TIMESTAMP '1990-01-01', o_orderdate)) AS INTEGER) AS first_day
FROM orders GROUP BY 1, 2
""")
def sql_scalar(spark, sf_dir):
    text = """SELECT year(o_orderdate) AS yr, upper(substr(o_orderpriority, 3)) AS prio,
                     count(*) AS n, round(sum(o_totalprice) / 1000 + 1e-9, 3) AS revenue_k,
                     max(length(concat(o_orderstatus, '-', o_orderpriority))) AS max_len,
                     min(datediff(o_orderdate, TIMESTAMP_NTZ '1990-01-01')) AS first_day
              FROM '{{orders}}' GROUP BY 1, 2"""
    return _sql(spark, sf_dir, text, ["orders"])


@register("sql_json", """
SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       max(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS max_k
FROM events GROUP BY event_type
""")
def sql_json(spark, sf_dir):
    text = """SELECT event_type, count(*) AS n, sum(CAST(get_json_object(props, '$.k') AS BIGINT)) AS sum_k,
                     max(CAST(get_json_object(props, '$.k') AS BIGINT)) AS max_k
              FROM '{{events}}' GROUP BY event_type"""
    return _sql(spark, sf_dir, text, ["events"])


@register("sql_arrays", """
SELECT o_custkey, list_sort(list(DISTINCT o_orderstatus)) AS statuses,
       CAST(len(list(DISTINCT o_orderpriority)) AS INTEGER) AS n_priorities,
       list_contains(list(DISTINCT o_orderstatus), 'F') AS has_finished
FROM orders GROUP BY o_custkey
""")
def sql_arrays(spark, sf_dir):
    # collect_set per customer holds at most the distinct statuses / priorities (a handful)
    text = """SELECT o_custkey, array_sort(collect_set(o_orderstatus)) AS statuses,
                     size(collect_set(o_orderpriority)) AS n_priorities,
                     array_contains(collect_set(o_orderstatus), 'F') AS has_finished
              FROM '{{orders}}' GROUP BY o_custkey"""
    return _sql(spark, sf_dir, text, ["orders"])


@register("sql_explode", """
SELECT part, count(*) AS n FROM (SELECT unnest(string_split(o_orderpriority, '-')) AS part FROM orders) t
GROUP BY part
""")
def sql_explode(spark, sf_dir):
    text = """SELECT part, count(*) AS n
              FROM (SELECT explode(split(o_orderpriority, '-')) AS part FROM '{{orders}}') t GROUP BY part"""
    return _sql(spark, sf_dir, text, ["orders"])


@register("sql_maps", """
SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS sum_k,
       CAST(max(len(json_keys(props))) AS INTEGER) AS n_keys
FROM events GROUP BY event_type
""")
def sql_maps(spark, sf_dir):
    text = """SELECT event_type, sum(element_at(m, 'k')) AS sum_k, max(size(map_keys(m))) AS n_keys
              FROM (SELECT event_type, from_json(props, 'map<string,bigint>') AS m FROM '{{events}}') t
              GROUP BY event_type"""
    return _sql(spark, sf_dir, text, ["events"])
