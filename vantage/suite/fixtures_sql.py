"""DuckDB definitions of the derived catalog tables (twins of ``vantage.sources.catalog``).

Each constant is a parenthesised subquery usable in FROM.
"""

RESOURCES = """(SELECT CAST(p_partkey AS VARCHAR) AS id, lower(p_type) AS container_id,
  CASE WHEN p_size <= 20 THEN 'dataset' WHEN p_size <= 40 THEN 'insight' ELSE 'report' END AS resource_type,
  CASE WHEN p_size = 50 THEN p_name ELSE p_brand || ' - ' || p_name END AS name FROM part)"""

DATASETS = """(SELECT CAST(p_partkey AS VARCHAR) AS id, lower(p_type) AS solution_id, p_name AS name,
  p_brand AS description, p_type AS source, 'p' || p_partkey AS slug,
  CASE WHEN p_size > 45 THEN NULL ELSE 'size ' || p_size END AS documentation FROM part)"""

TAGS = """(SELECT DISTINCT replace(p_brand, 'Brand#', 'tag-') AS tag_id, p_brand AS name, '#1F009D' AS color FROM part)"""

RESOURCE_TAGS = """(SELECT replace(p_brand, 'Brand#', 'tag-') AS tag_id, CAST(p_partkey AS VARCHAR) AS resource_id FROM part)"""


def _band(v: str) -> str:
    return f"CASE WHEN {v} < 20 THEN 'viewer' WHEN {v} < 100 THEN 'editor' ELSE 'admin' END"


ROLE_ASSIGNMENTS = f"""(SELECT resource_id, principal_id, {_band('v')} AS role FROM (
  SELECT CAST(user_id AS VARCHAR) AS resource_id, 'g-' || event_type AS principal_id, arg_max(value, event_id) AS v
  FROM events GROUP BY 1, 2) t)"""

ROLE_CHANGES = f"""(SELECT CAST(user_id AS VARCHAR) AS resource_id, 'g-' || event_type AS principal_id, event_id AS seq,
  CASE WHEN value < 10 THEN 'unassign' ELSE 'assign' END AS op, {_band('value')} AS role FROM events)"""

_SCORE = "CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)"
_K = "json_extract_string(props, '$.k')"

CHANGES = f"""(SELECT 'k' || user_id AS key, event_id AS seq,
  CASE event_type WHEN 'signup' THEN 'create' WHEN 'error' THEN 'delete' ELSE 'update' END AS op,
  CASE WHEN event_type = 'signup' THEN '{{"name": "n' || event_id || '", "score": ' || {_SCORE} || ', "tier": ' || {_K} || '}}'
       WHEN event_type = 'click' THEN '{{"score": ' || {_SCORE} || '}}'
       WHEN event_type = 'view' THEN '{{"name": "v' || event_id || '"}}'
       WHEN event_type = 'purchase' AND value < 30 THEN '{{"tier": ' || {_K} || ', "score": null}}'
       WHEN event_type = 'purchase' THEN '{{"tier": ' || {_K} || '}}'
       ELSE '{{}}' END AS payload
  FROM events)"""

RECORDS = """(SELECT 'k' || c_custkey AS key, c_name AS name, CAST(floor(c_acctbal) AS BIGINT) AS score,
  CAST(c_nationkey AS BIGINT) AS tier FROM customer)"""

_INSIGHT = "CASE WHEN l_linenumber = 7 THEN '' ELSE 'ins' || l_partkey END"
_WIDGET = (f"""'{{"type": "widget", "id": "b' || l_orderkey || '_' || l_linenumber || '", "children": [{{"text": ""}}], """
           f""""widgetData": {{"insightId": "' || ({_INSIGHT}) || '"}}, "height": null}}'""")

REPORT_BLOCKS = f"""(SELECT 'rep' || l_orderkey AS report_id, l_linenumber AS pos,
  CASE WHEN l_linestatus = 'O' AND l_linenumber = 1
         THEN '{{"type": "p", "children": [{{"text": "note"}}], "widgetData": {{"insightId": "' || ({_INSIGHT}) || '"}}}}'
       WHEN l_returnflag = 'R' AND l_linenumber % 2 = 0
         THEN '{{"type": "column-group", "children": [{{"type": "column", "children": [' || {_WIDGET} || ']}}]}}'
       ELSE {_WIDGET} END AS block,
  CASE WHEN l_linestatus = 'O' AND l_linenumber = 1 THEN NULL ELSE {_INSIGHT} END AS insight_id,
  (l_linestatus = 'O' AND l_linenumber = 1) AS is_paragraph
  FROM lineitem)"""

# insight ids the structure really references (widgets anywhere, non-empty id)
STRUCTURE_INSIGHTS = f"""(SELECT DISTINCT report_id, insight_id FROM {REPORT_BLOCKS} b
  WHERE NOT is_paragraph AND insight_id <> '')"""

CURRENT_INSIGHTS = """(SELECT DISTINCT 'rep' || l_orderkey AS report_id,
  CASE WHEN l_quantity > 25 THEN 'ins' || l_partkey ELSE 'old' || l_partkey END AS insight_id
  FROM lineitem WHERE l_quantity > 25 OR l_quantity <= 5)"""

REPORT_VIEWS = """(SELECT 'v' || o_orderkey AS id, 'rep' || o_custkey AS report_id, o_orderpriority AS name,
  '{"status": "' || o_orderstatus || '"}' AS config FROM orders)"""

DPA_ENTRIES = """(SELECT 'sol' || s_nationkey AS solution_id, 's' || s_suppkey AS slug,
  CASE WHEN s_acctbal > 5000 THEN 'active' ELSE 'inactive' END AS status, s_acctbal >= 0 AS toggleable,
  s_acctbal > 1000 AS confirmed, CASE WHEN s_acctbal > 2000 THEN 'yes' ELSE 'no' END AS has_personal,
  'cat-' || s_nationkey AS category, 'type-' || s_nationkey AS data_type,
  CASE WHEN s_acctbal < 0 THEN 'customers' ELSE 'staff' END AS person_group FROM supplier)"""

_BODY = """'{"data": {"id": "e' || event_id || '", "props": ' || props || '}}'"""
RESPONSES = f"""(SELECT event_id AS id,
  CASE WHEN event_type = 'view' THEN 'text/plain' ELSE 'application/json' END AS content_type,
  CASE WHEN value < 5 THEN 500 WHEN value < 100 THEN 200 ELSE 201 END AS status,
  CASE WHEN event_id % 7 = 0 THEN substr({_BODY}, 1, 12)
       WHEN event_type = 'error' THEN '{{"meta": ' || props || '}}'
       ELSE {_BODY} END AS body,
  event_type FROM events)"""

# Column names and Spark types of the driver tables a dataset can carry (FIXTURES.md §1).
DRIVER_SCHEMAS = {
    "customer": [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_acctbal", "double"),
                 ("c_mktsegment", "string")],
    "supplier": [("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double")],
    "part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
             ("p_size", "int"), ("p_retailprice", "double")],
    "orders": [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
               ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")],
    "lineitem": [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                 ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"),
                 ("l_tax", "double"), ("l_returnflag", "string"), ("l_linestatus", "string"),
                 ("l_shipdate", "timestamp_ntz")],
    "events": [("event_id", "bigint"), ("ts", "timestamp_ntz"), ("user_id", "bigint"), ("event_type", "string"),
               ("value", "double"), ("props", "string")],
}
TYPE_TO_TABLE = [("ECONOMY", "customer"), ("LARGE", "lineitem"), ("SMALL", "orders"),
                 ("PROMO", "part"), ("STANDARD", "supplier"), ("MEDIUM", "events")]

SCHEMA_ROWS = "(VALUES " + ", ".join(
    f"('{t}', '{c}', '{ty}', {i})" for t, cols in DRIVER_SCHEMAS.items() for i, (c, ty) in enumerate(cols, start=1)
) + ") AS s(tbl, column_id, type, position)"
TYPE_MAP = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in TYPE_TO_TABLE) + ") AS m(p_type, tbl)"

DATASET_COLUMNS = f"""(SELECT CAST(p_partkey AS VARCHAR) AS dataset_id, s.column_id, s.type,
  CASE WHEN s.type IN ('int', 'bigint') THEN 'Anzahl ' || s.column_id
       WHEN s.type = 'double' THEN s.column_id || ' %' ELSE s.column_id END AS label,
  s.position, s.tbl AS table_name
  FROM part p JOIN {TYPE_MAP} ON p.p_type = m.p_type JOIN {SCHEMA_ROWS} ON s.tbl = m.tbl)"""
