"""Report structures (W1–W5) and record validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from vantage.operators import reports as rep
from vantage.operators.validation import validate_records
from vantage.sources import catalog as cat
from vantage.sources.tables import read_table
from vantage.suite import fixtures_sql as fx
from vantage.suite.registry import register


@register("widget_extract", f"SELECT report_id, insight_id FROM {fx.STRUCTURE_INSIGHTS} s")
def widget_extract(spark, sf_dir):
    return rep.extract_widgets(spark, cat.reports(spark, sf_dir))


@register("widget_extract_sql", f"SELECT report_id, insight_id FROM {fx.STRUCTURE_INSIGHTS} s")
def widget_extract_sql(spark, sf_dir):
    """W1 with built-ins only: level by level over VARIANT arrays inside the row."""
    return rep.extract_widgets(spark, cat.reports(spark, sf_dir), method="sql")


@register("report_diff", f"""
SELECT report_id, insight_id, 'add' AS action FROM
  (SELECT report_id, insight_id FROM {fx.STRUCTURE_INSIGHTS} s EXCEPT SELECT report_id, insight_id FROM {fx.CURRENT_INSIGHTS} c)
UNION ALL
SELECT report_id, insight_id, 'remove' AS action FROM
  (SELECT report_id, insight_id FROM {fx.CURRENT_INSIGHTS} c2 EXCEPT SELECT report_id, insight_id FROM {fx.STRUCTURE_INSIGHTS} s2)
""")
def report_diff(spark, sf_dir):
    reports = cat.reports(spark, sf_dir)
    new = rep.extract_widgets(spark, reports)
    current = rep.metadata_references(reports, insights_col="current_insights")
    return rep.reference_diff(current, new, reports.select("report_id"))


@register("report_refs_update", f"SELECT report_id, insight_id FROM {fx.STRUCTURE_INSIGHTS} s")
def report_refs_update(spark, sf_dir):
    """W2 + W3: apply the reference diff to the current references; afterwards they are exactly
    the insights the structures use."""
    reports = cat.reports(spark, sf_dir)
    current = rep.metadata_references(reports, insights_col="current_insights")
    diff = rep.reference_diff(current, rep.extract_widgets(spark, reports), reports.select("report_id"))
    return rep.apply_reference_diff(current, diff)


@register("report_refs", f"SELECT report_id, insight_id FROM {fx.CURRENT_INSIGHTS} c")
def report_refs(spark, sf_dir):
    return rep.metadata_references(cat.reports(spark, sf_dir), insights_col="current_insights")


@register("report_assemble", f"""
WITH b AS (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY pos, block, insight_id) AS rn
           FROM {fx.REPORT_BLOCKS} b0),
firsts AS (SELECT report_id, insight_id, min(rn) AS p FROM b WHERE insight_id IS NOT NULL AND insight_id <> ''
           GROUP BY 1, 2)
SELECT s.report_id, s.structure, i.insights FROM
  (SELECT report_id, '{{"editorState": [' || string_agg(block, ', ' ORDER BY rn) || ']}}' AS structure
   FROM b GROUP BY report_id) s
LEFT JOIN (SELECT report_id, list(insight_id ORDER BY p) AS insights FROM firsts GROUP BY report_id) i
  ON s.report_id = i.report_id
""")
def report_assemble(spark, sf_dir):
    out = rep.assemble(cat.report_blocks(spark, sf_dir))
    return out.withColumn("insights", F.when(F.size("insights") > 0, F.col("insights")))


_SECTION = 2  # positions per section here, so that reports have several


@register("report_sections", f"""
WITH b AS (SELECT report_id, block, insight_id, CAST((pos - 1) // {_SECTION} AS INTEGER) AS section,
                  row_number() OVER (PARTITION BY report_id ORDER BY pos, block, insight_id) AS rn FROM {fx.REPORT_BLOCKS} b0),
firsts AS (SELECT report_id, insight_id, min(rn) AS rn, arg_min(section, rn) AS section FROM b WHERE insight_id <> '' GROUP BY 1, 2),
ids AS (SELECT report_id, section, string_agg(insight_id, ',' ORDER BY rn) AS insights FROM firsts GROUP BY 1, 2)
SELECT s.report_id, s.section, s.blocks, coalesce(i.insights, '') AS insights
FROM (SELECT report_id, section, string_agg(block, ', ' ORDER BY rn) AS blocks FROM b GROUP BY 1, 2) s
LEFT JOIN ids i ON s.report_id = i.report_id AND s.section = i.section
""")
def report_sections(spark, sf_dir):
    """W4 in sections: no task holds more than one section of a report."""
    out = rep.assemble_sections(cat.report_blocks(spark, sf_dir), section_size=_SECTION)
    return out.withColumn("insights", F.array_join("insights", ","))


_CELL = """'{"type":"' || CASE WHEN rn = 1 THEN 'th' ELSE 'td' END || '","children":[{"text":"' || c || '"}]}'"""


@register("report_table_block", f"""
WITH rows AS (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey
                     ORDER BY l_linenumber, CAST(l_quantity AS VARCHAR), l_returnflag) AS rn,
                     [CAST(l_linenumber AS VARCHAR), CAST(l_quantity AS VARCHAR), l_returnflag] AS cells FROM lineitem),
trs AS (SELECT l_orderkey, rn,
               '{{"type":"tr","children":[' || array_to_string(list_transform(cells, lambda c: {_CELL}), ',') || ']}}' AS tr
        FROM rows)
SELECT l_orderkey AS table_id,
       '{{"type":"table","id":"t' || l_orderkey || '","children":[' || string_agg(tr, ',' ORDER BY rn) || ']}}' AS block
FROM trs GROUP BY l_orderkey
""")
def report_table_block(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_orderkey").alias("table_id"), F.col("l_linenumber").alias("row_nr"),
                     F.array(F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("string"),
                             F.col("l_returnflag")).alias("cells"))
    return rep.table_blocks(rows, has_header=True)


@register("report_table_sections", f"""
WITH rows AS (SELECT l_suppkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_returnflag) AS rn,
                     [CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), l_returnflag] AS cells,
                     l_orderkey * 10 + l_linenumber AS row_nr FROM lineitem),
trs AS (SELECT l_suppkey, CAST((row_nr - 1) // 5000 AS INTEGER) AS section, rn,
               '{{"type":"tr","children":[' || array_to_string(list_transform(cells, lambda c: {_CELL}), ',') || ']}}' AS tr
        FROM rows)
SELECT l_suppkey AS table_id, section, string_agg(tr, ',' ORDER BY rn) AS rows FROM trs GROUP BY 1, 2
""")
def report_table_sections(spark, sf_dir):
    """W5 in sections: one table per supplier, of any length."""
    li = read_table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_suppkey").alias("table_id"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_nr"),
                     F.array(F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                             F.col("l_returnflag")).alias("cells"))
    return rep.table_sections(rows, section_size=5000)


@register("validate_records", f"""
SELECT id, error, error IS NULL AS ok FROM (
  SELECT id, CASE
    WHEN NOT contains(content_type, 'application/json') THEN CASE WHEN status IN (200, 201) THEN NULL ELSE 'http_status' END
    WHEN NOT json_valid(body) THEN 'invalid_json'
    WHEN status NOT IN (200, 201) THEN 'http_status'
    WHEN NOT coalesce(list_contains(json_keys(body), 'data'), FALSE) THEN 'missing_key:data'
    WHEN NOT coalesce(list_contains(json_keys(json_extract(body, '$.data')), 'id'), FALSE) THEN 'missing_key:id'
  END AS error FROM {fx.RESPONSES} r) t
""")
def validate_records_query(spark, sf_dir):
    out = validate_records(cat.responses(spark, sf_dir), required_keys=("data", "id"))
    return out.select("id", "error", "ok")
