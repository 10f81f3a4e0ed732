"""Chart-ready frames (V1–V7) over insight results."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantage.operators import charts
from vantage.plans.builder import InsightBuilder, join_on
from vantage.plans.insight import run_insight
from vantage.sources import catalog as cat
from vantage.sources.tables import TableResolver
from vantage.suite import fixtures_sql as fx
from vantage.suite.registry import register, rounded, rounded_ratio


def _run(spark, sf_dir, builder: InsightBuilder):
    return run_insight(builder.build(), TableResolver(spark, sf_dir))


@register("chart_table", """
SELECT l_returnflag, count(l_orderkey) AS "Anzahl Positionen", round(avg(l_discount) + 1e-9, 4) AS "Rabatt %"
FROM lineitem GROUP BY l_returnflag
""")
def chart_table(spark, sf_dir):
    b = (InsightBuilder().add_dataset("lineitem").add_select("l_returnflag")
         .add_select("l_orderkey", aggregate="count", label="Anzahl Positionen")
         .add_select("l_discount", aggregate="avg", label="Rabatt %"))
    out = charts.table_frame(_run(spark, sf_dir, b), ["l_returnflag", "Anzahl Positionen", "Rabatt %"])
    return rounded_ratio(out, 4, "Rabatt %")


@register("chart_column_types", f"""
SELECT dataset_id, column_id, label,
       CASE WHEN contains(label, '%') OR contains(lower(label), 'anzahl') THEN 'number' ELSE 'text' END AS display_type
FROM {fx.DATASET_COLUMNS} t
""")
def chart_column_types(spark, sf_dir):
    cols = cat.dataset_columns(spark, sf_dir)
    return charts.table_column_types(cols).select("dataset_id", "column_id", "label", "display_type")


@register("chart_big_number", """
SELECT round(sum(value), 2) AS value FROM events
""")
def chart_big_number(spark, sf_dir):
    b = InsightBuilder().add_dataset("events").add_select("value")
    return rounded(charts.big_number(_run(spark, sf_dir, b), "value", "sum"), 2, "value")


@register("chart_bar", """
SELECT event_type AS x, count(event_id) AS y, CAST(NULL AS VARCHAR) AS series FROM events GROUP BY event_type
""")
def chart_bar(spark, sf_dir):
    b = (InsightBuilder().add_dataset("events").add_select("event_type")
         .add_select("event_id", aggregate="count", label="n_events"))
    return charts.bar_frame(_run(spark, sf_dir, b), "event_type", "n_events")


@register("chart_line", """
SELECT o_orderpriority AS x, round(sum(o_totalprice), 2) AS y, o_orderstatus AS series
FROM orders GROUP BY o_orderpriority, o_orderstatus
""")
def chart_line(spark, sf_dir):
    b = (InsightBuilder().add_dataset("orders").add_select("o_orderpriority").add_select("o_orderstatus")
         .add_select("o_totalprice", aggregate="sum", label="revenue"))
    return rounded(charts.line_frame(_run(spark, sf_dir, b), "o_orderpriority", "revenue", "o_orderstatus"), 2, "y")


@register("chart_pie", """
SELECT n_name AS label, count(c_custkey) AS measure FROM nation JOIN customer ON n_nationkey = c_nationkey
GROUP BY n_name
""")
def chart_pie(spark, sf_dir):
    b = (InsightBuilder().add_dataset("nation")
         .add_dataset("customer", "inner", [join_on("nation", "n_nationkey", "customer", "c_nationkey")])
         .add_select("n_name").add_select("c_custkey", "customer", "count", "customers"))
    return charts.pie_frame(_run(spark, sf_dir, b), "n_name", "customers")


@register("chart_choropleth", """
SELECT n_name AS geometry, n_name AS label, round(sum(c_acctbal), 2) AS value
FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_name
""")
def chart_choropleth(spark, sf_dir):
    b = (InsightBuilder().add_dataset("nation")
         .add_dataset("customer", "inner", [join_on("nation", "n_nationkey", "customer", "c_nationkey")])
         .add_select("n_name").add_select("c_acctbal", "customer", "sum", "balance"))
    out = charts.map_frame(_run(spark, sf_dir, b), "n_name", "n_name", "balance", "choropleth")
    return rounded(out, 2, "value")


@register("chart_scatter", """
SELECT n_name AS geometry, CAST(NULL AS VARCHAR) AS label, CAST(count(c_custkey) AS DOUBLE) AS value, r_name AS "group"
FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey
GROUP BY n_name, r_name
""")
def chart_scatter(spark, sf_dir):
    b = (InsightBuilder().add_dataset("region")
         .add_dataset("nation", "inner", [join_on("region", "r_regionkey", "nation", "n_regionkey")])
         .add_dataset("customer", "inner", [join_on("nation", "n_nationkey", "customer", "c_nationkey")])
         .add_select("n_name", "nation").add_select("r_name")
         .add_select("c_custkey", "customer", "count", "customers"))
    out = charts.map_frame(_run(spark, sf_dir, b), "n_name", None, "customers", "scatter", group="r_name")
    return out.withColumn("value", F.col("value").cast("double"))


@register("chart_from_config", """
SELECT CAST(o_orderpriority AS VARCHAR) AS x, count(o_orderkey) AS y, o_orderstatus AS series
FROM orders WHERE o_totalprice > 100000 GROUP BY o_orderpriority, o_orderstatus
""")
def chart_from_config(spark, sf_dir):
    """An insight whose visual config asks for a bar chart: spec → result → chart frame."""
    config = {"type": "bar-chart",
              "xAxis": {"column": {"key": "o_orderpriority", "label": "priority", "type": "text"}},
              "yAxis": {"column": {"key": "o_orderkey", "label": "orders", "type": "number"}},
              "metric": {"column": {"key": "o_orderstatus", "label": "status", "type": "text"}}}
    spec = (InsightBuilder().add_dataset("orders")
            .add_select("o_orderpriority", label="priority").add_select("o_orderstatus", label="status")
            .add_select("o_orderkey", aggregate="count", label="orders")
            .add_filter("o_totalprice", "greater_than", 100000)
            .set_config(config).build())
    return charts.chart_frame(run_insight(spec, TableResolver(spark, sf_dir)), spec["config"])
