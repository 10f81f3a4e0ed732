"""Catalog listing (C1–C8), KPI match and changes (K1, M1–M8), tags and roles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vantage.operators import changes as chg
from vantage.operators import listing as lst
from vantage.operators import rights, roles
from vantage.operators.indexes import PageIndex, SearchIndex
from vantage.session import scratch_path
from vantage.sources import catalog as cat
from vantage.sources.tables import read_table
from vantage.suite import fixtures_sql as fx
from vantage.suite.registry import register

# -- listing --------------------------------------------------------------------------------------


@register("list_resources", f"""
SELECT id, container_id, resource_type, name FROM {fx.RESOURCES} r
WHERE container_id = 'economy' AND resource_type = 'dataset'
  AND id IN (SELECT resource_id FROM {fx.ROLE_ASSIGNMENTS} a WHERE principal_id = 'g-click' AND role IN ('editor', 'admin'))
""")
def list_resources(spark, sf_dir):
    return lst.list_resources(cat.resources(spark, sf_dir), "economy", "dataset", "can_edit",
                              principal_id="g-click", role_assignments=cat.role_assignments(spark, sf_dir))


_EVENT_GROUPS = "['g-click', 'g-view', 'g-purchase', 'g-signup', 'g-error']"
MEMBERSHIPS = f"""(SELECT {_EVENT_GROUPS}[r_regionkey + 1] AS group_id, 'region-' || r_regionkey AS member_id FROM region
  UNION ALL SELECT 'region-' || n_regionkey, 'nation-' || n_nationkey FROM nation
  UNION ALL SELECT 'nation-' || n_nationkey, 'region-' || n_regionkey FROM nation WHERE n_nationkey = 3
  UNION ALL SELECT 'nation-' || s_nationkey, 'u' || s_suppkey FROM supplier)"""
CONTAINMENT = """(SELECT DISTINCT 'ws-' || p_brand AS container_id, lower(p_type) AS id FROM part WHERE p_size < 3
  UNION ALL SELECT lower(p_type), CAST(p_partkey AS VARCHAR) FROM part)"""
_KINDS = "['economy', 'large', 'medium', 'promo', 'small', 'standard']"
CONTAINER_ROLES = f"""(SELECT CASE WHEN n_nationkey % 5 = 0 THEN 'ws-Brand#' || (n_nationkey + 1) ELSE {_KINDS}[n_nationkey % 6 + 1] END AS resource_id,
  'nation-' || n_nationkey AS principal_id,
  CASE WHEN n_nationkey * 7 < 20 THEN 'viewer' WHEN n_nationkey * 7 < 100 THEN 'editor' ELSE 'admin' END AS role FROM nation)"""


@register("list_permitted", f"""
WITH RECURSIVE member(principal_id, member_id) AS (
  SELECT group_id, member_id FROM {MEMBERSHIPS} m0
  UNION SELECT m.principal_id, n.member_id FROM member m JOIN {MEMBERSHIPS} n ON m.member_id = n.group_id),
inside(resource_id, id) AS (
  SELECT container_id, id FROM {CONTAINMENT} c0
  UNION SELECT i.resource_id, c.id FROM inside i JOIN {CONTAINMENT} c ON i.id = c.container_id),
given AS (SELECT resource_id, principal_id, role FROM {fx.ROLE_ASSIGNMENTS} a UNION ALL SELECT * FROM {CONTAINER_ROLES} cr),
spread AS (SELECT * FROM given UNION ALL SELECT i.id, g.principal_id, g.role FROM given g JOIN inside i ON g.resource_id = i.resource_id),
held AS (SELECT * FROM spread UNION ALL SELECT s.resource_id, m.member_id, s.role FROM spread s JOIN member m ON s.principal_id = m.principal_id)
SELECT DISTINCT h.principal_id, r.id, r.name FROM held h JOIN {fx.RESOURCES} r ON h.resource_id = r.id
WHERE h.role IN ('editor', 'admin') AND r.container_id = 'economy' AND r.resource_type = 'report' AND h.principal_id LIKE 'u%'
""")
def list_permitted(spark, sf_dir):
    """The reports of a solution that each user may edit, through nested groups (with a cycle) and containers."""
    res = cat.resources(spark, sf_dir).where("container_id = 'economy' AND resource_type = 'report'").select("id", "name")
    given = cat.role_assignments(spark, sf_dir).unionByName(cat.container_roles(spark, sf_dir))
    out = rights.permitted(res, given, "can_edit", cat.memberships(spark, sf_dir), cat.containment(spark, sf_dir))
    return out.where(F.col("principal_id").startswith("u"))


@register("effective_roles", f"""
WITH RECURSIVE member(principal_id, member_id) AS (
  SELECT group_id, member_id FROM {MEMBERSHIPS} m0
  UNION SELECT m.principal_id, n.member_id FROM member m JOIN {MEMBERSHIPS} n ON m.member_id = n.group_id),
held AS (SELECT * FROM {CONTAINER_ROLES} g UNION ALL
         SELECT g.resource_id, m.member_id, g.role FROM {CONTAINER_ROLES} g JOIN member m ON g.principal_id = m.principal_id)
SELECT resource_id, principal_id, arg_max(role, list_position(['viewer', 'editor', 'admin'], role)) AS role FROM held GROUP BY 1, 2
""")
def effective_roles(spark, sf_dir):
    """The strongest role of every user and group on every container, through nested groups with a cycle."""
    return rights.effective_roles(cat.container_roles(spark, sf_dir), cat.memberships(spark, sf_dir))


@register("page", f"""
SELECT id, container_id, resource_type, name FROM {fx.RESOURCES} r WHERE container_id = 'economy'
ORDER BY id LIMIT 50 OFFSET 50
""")
def page(spark, sf_dir):
    res = cat.resources(spark, sf_dir).filter(F.col("container_id") == "economy")
    return lst.page(res, page_nr=2, size=50, order_by=["id"])


@register("page_deep", """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 75 OFFSET (SELECT (count(*) // 150) * 75 FROM lineitem)
""")
def page_deep(spark, sf_dir):
    """C2 from a stored page index: a page in the middle of all line items by price; only the parts it touches are read."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    index = PageIndex.build(li, scratch_path(spark, "pages", uuid.uuid4().hex),
                            [F.desc("l_extendedprice"), "l_orderkey", "l_linenumber"])
    return index.page(index.total // 150 + 1, 75)


@register("page_total", f"""
SELECT count(*) AS total FROM {fx.RESOURCES} r WHERE container_id = 'economy'
""")
def page_total(spark, sf_dir):
    return lst.total(cat.resources(spark, sf_dir).filter(F.col("container_id") == "economy"))


@register("page_numbers", f"""
SELECT id, container_id, CAST(ceil(row_number() OVER (ORDER BY container_id, id) / 100.0) AS INTEGER) AS page
FROM {fx.RESOURCES} r
""")
def page_numbers(spark, sf_dir):
    res = cat.resources(spark, sf_dir).select("id", "container_id")
    return lst.with_page_numbers(res, 100, ["container_id", "id"])


@register("list_all", f"""
SELECT id, name FROM {fx.RESOURCES} r WHERE container_id = 'promo' AND resource_type = 'insight'
""")
def list_all(spark, sf_dir):
    """Everything, no page loop."""
    return lst.list_resources(cat.resources(spark, sf_dir), "promo", "insight", permission=None).select("id", "name")


@register("search", f"""
SELECT id, name FROM {fx.RESOURCES} r WHERE contains(lower(name), 'red')
""")
def search(spark, sf_dir):
    return lst.search(cat.resources(spark, sf_dir), "RED").select("id", "name")


@register("search_index", f"""
SELECT id, name FROM {fx.RESOURCES} r WHERE contains(lower(name), 'red')
UNION ALL SELECT id, name FROM {fx.RESOURCES} r2 WHERE contains(lower(name), 'brand#2')
UNION ALL SELECT id, name FROM {fx.RESOURCES} r3 WHERE contains(lower(name), '#1')
""")
def search_index(spark, sf_dir):
    """C4 from a stored index: texts of many trigrams, of one, and one too short for them."""
    res = cat.resources(spark, sf_dir).select("id", "name")
    index = SearchIndex.build(res, scratch_path(spark, "search", uuid.uuid4().hex))
    return index.search("RED").unionByName(index.search("Brand#2")).unionByName(index.search("#1"))


@register("search_tags", f"""
SELECT tag_id, name FROM {fx.TAGS} t WHERE contains(lower(name), 'brand#1')
""")
def search_tags(spark, sf_dir):
    return lst.search(cat.tags(spark, sf_dir), "BRAND#1").select("tag_id", "name")


@register("filtered_list", f"""
SELECT id, resource_type, name FROM {fx.RESOURCES} r WHERE container_id = 'small' AND contains(lower(name), 'bolt')
""")
def filtered_list(spark, sf_dir):
    out = lst.filtered_list(cat.resources(spark, sf_dir), {"container_id": "small", "resource_type": ""}, "bolt")
    return out.select("id", "resource_type", "name")


@register("solution_datasets", f"""
SELECT d.* FROM {fx.DATASETS} d
WHERE id IN (SELECT id FROM {fx.RESOURCES} r WHERE container_id = 'large' AND resource_type = 'dataset')
""")
def solution_datasets(spark, sf_dir):
    return lst.solution_datasets(cat.resources(spark, sf_dir), cat.datasets(spark, sf_dir), "large")


@register("lookup_batch", f"""
SELECT q.id, r.name, r.id IS NOT NULL AS found
FROM (SELECT DISTINCT CAST(l_suppkey * 20 AS VARCHAR) AS id FROM lineitem) q LEFT JOIN {fx.RESOURCES} r ON q.id = r.id
""")
def lookup_batch(spark, sf_dir):
    req = read_table(spark, sf_dir, "lineitem").select((F.col("l_suppkey") * 20).cast("string").alias("id")).distinct()
    return lst.lookup(cat.resources(spark, sf_dir).select("id", "name"), req, "id").select("id", "name", "found")


ENTITIES = f"""(SELECT 'insight' AS entity_type, id AS key, id, name FROM {fx.RESOURCES} r1 WHERE resource_type = 'insight'
  UNION ALL SELECT 'insight_slug', 'p' || id, id, name FROM {fx.RESOURCES} r2 WHERE resource_type = 'insight'
  UNION ALL SELECT 'report', id, id, name FROM {fx.RESOURCES} r3 WHERE resource_type = 'report'
  UNION ALL SELECT 'report_view', id, id, name FROM {fx.REPORT_VIEWS} v
  UNION ALL SELECT DISTINCT 'solution', container_id, container_id, container_id FROM {fx.RESOURCES} r4
  UNION ALL SELECT 'tag', tag_id, tag_id, name FROM {fx.TAGS} t
  UNION ALL SELECT DISTINCT 'group', principal_id, principal_id, substr(principal_id, 3) FROM {fx.ROLE_CHANGES} c)"""


@register("lookup_entities", f"""
WITH q AS (SELECT DISTINCT
  CASE l_linenumber % 7 WHEN 0 THEN 'insight' WHEN 1 THEN 'insight_slug' WHEN 2 THEN 'report' WHEN 3 THEN 'report_view'
       WHEN 4 THEN 'solution' WHEN 5 THEN 'tag' ELSE 'group' END AS entity_type,
  CASE l_linenumber % 7 WHEN 0 THEN CAST(l_partkey AS VARCHAR) WHEN 1 THEN 'p' || l_partkey WHEN 2 THEN CAST(l_partkey AS VARCHAR)
       WHEN 3 THEN 'v' || (l_orderkey * 2) WHEN 4 THEN CASE l_returnflag WHEN 'R' THEN 'economy' WHEN 'A' THEN 'large' ELSE 'nowhere' END
       WHEN 5 THEN 'tag-' || (l_partkey % 40) ELSE CASE l_linestatus WHEN 'O' THEN 'g-click' ELSE 'g-nobody' END END AS key
  FROM lineitem)
SELECT q.entity_type, q.key, e.id, e.name, e.key IS NOT NULL AS found
FROM q LEFT JOIN {ENTITIES} e ON q.entity_type = e.entity_type AND q.key = e.key
""")
def lookup_entities(spark, sf_dir):
    """Insights by id and by slug, reports, views, solutions, tags and groups, looked up in one join with a stored index."""
    mark = uuid.uuid4().hex
    index = lst.entity_index(cat.entities(spark, sf_dir), f"entities_{mark}", scratch_path(spark, "entities", mark), buckets=16)
    out = lst.lookup_entities(index, cat.lookup_requests(spark, sf_dir))
    return out.select("entity_type", "key", "id", "name", "found")


@register("report_views", f"""
SELECT id, report_id, name, config FROM {fx.REPORT_VIEWS} v WHERE report_id = 'rep7' ORDER BY id LIMIT 5
""")
def report_views(spark, sf_dir):
    views = cat.report_views(spark, sf_dir).filter(F.col("report_id") == "rep7")
    return lst.page(views, 1, 5, ["id"])


# -- KPI match and changes ------------------------------------------------------------------------

KPI_REQUESTS = """(SELECT DISTINCT lower(p_type) AS solution_id,
  CASE WHEN p_size = 50 THEN p_name ELSE p_brand END AS kpi_id FROM part WHERE p_size > 40)"""
KPI_INSIGHTS = f"""(SELECT id, container_id AS solution_id, name FROM {fx.RESOURCES} r WHERE resource_type = 'insight')"""
KPI_FIRST = f"""(SELECT solution_id, CASE WHEN strpos(name, ' - ') > 0 THEN substr(name, 1, strpos(name, ' - ') - 1)
  ELSE name END AS kpi_id, id FROM {KPI_INSIGHTS} i)"""


def _kpi_inputs(spark, sf_dir):
    res = cat.resources(spark, sf_dir)
    insights = res.filter(F.col("resource_type") == "insight").select(
        "id", F.col("container_id").alias("solution_id"), "name")
    p = read_table(spark, sf_dir, "part").filter(F.col("p_size") > 40)
    requests = p.select(F.lower("p_type").alias("solution_id"),
                        F.when(F.col("p_size") == 50, F.col("p_name")).otherwise(F.col("p_brand")).alias("kpi_id")
                        ).distinct()
    return insights, requests


@register("kpi_match", f"""
SELECT q.solution_id, q.kpi_id, f.insight_id FROM {KPI_REQUESTS} q LEFT JOIN
  (SELECT solution_id, kpi_id, arg_min(id, CAST(id AS BIGINT)) AS insight_id FROM {KPI_FIRST} k GROUP BY 1, 2) f
  ON q.solution_id = f.solution_id AND q.kpi_id = f.kpi_id
""")
def kpi_match(spark, sf_dir):
    insights, requests = _kpi_inputs(spark, sf_dir)
    return chg.kpi_match(insights, requests, order=F.col("id").cast("bigint"))


@register("kpi_upsert", f"""
SELECT coalesce(f.insight_id, 'new-' || q.solution_id || '-' || q.kpi_id) AS id, q.solution_id,
       q.kpi_id || ' - refreshed' AS name, CASE WHEN f.insight_id IS NULL THEN 'create' ELSE 'update' END AS action
FROM {KPI_REQUESTS} q LEFT JOIN
  (SELECT solution_id, kpi_id, arg_min(id, CAST(id AS BIGINT)) AS insight_id FROM {KPI_FIRST} k GROUP BY 1, 2) f
  ON q.solution_id = f.solution_id AND q.kpi_id = f.kpi_id
""")
def kpi_upsert(spark, sf_dir):
    insights, requests = _kpi_inputs(spark, sf_dir)
    bodies = requests.withColumn("name", F.concat(F.col("kpi_id"), F.lit(" - refreshed")))
    return chg.upsert_by_kpi(insights, bodies, order=F.col("id").cast("bigint"))


@register("kpi_upsert_merge", f"""
WITH bodies AS (SELECT lower(p_type) AS solution_id, CASE WHEN p_size = 50 THEN p_name ELSE p_brand END AS kpi_id,
                p_partkey AS seq FROM part WHERE p_size > 40),
latest AS (SELECT solution_id, kpi_id, kpi_id || ' - order ' || max(seq) AS name FROM bodies GROUP BY 1, 2),
firsts AS (SELECT solution_id, kpi_id, arg_min(id, CAST(id AS BIGINT)) AS id FROM {KPI_FIRST} k GROUP BY 1, 2),
upserts AS (SELECT l.solution_id, l.kpi_id, l.name, f.id FROM latest l LEFT JOIN firsts f
            ON l.solution_id = f.solution_id AND l.kpi_id = f.kpi_id)
SELECT i.id, i.solution_id, coalesce(u.name, i.name) AS name FROM {KPI_INSIGHTS} i LEFT JOIN upserts u ON i.id = u.id
UNION ALL SELECT 'new-' || solution_id || '-' || kpi_id, solution_id, name FROM upserts WHERE id IS NULL
""")
def kpi_upsert_merge(spark, sf_dir):
    """M6: the whole insight table after a batch of upserts that holds many bodies per KPI."""
    insights, _ = _kpi_inputs(spark, sf_dir)
    p = read_table(spark, sf_dir, "part").filter(F.col("p_size") > 40)
    kpi = F.when(F.col("p_size") == 50, F.col("p_name")).otherwise(F.col("p_brand"))
    bodies = p.select(F.lower("p_type").alias("solution_id"), kpi.alias("kpi_id"), F.col("p_partkey").alias("seq"),
                      F.concat(kpi, F.lit(" - order "), F.col("p_partkey")).alias("name"))
    state, _ = chg.merge_by_kpi(insights, bodies, order=F.col("id").cast("bigint"))
    return state


NEW_DATASETS = f"""(SELECT CAST(p_partkey + 1500 AS VARCHAR) AS id, 0 AS seq FROM part
  UNION ALL SELECT CAST(p_partkey + 1500 AS VARCHAR), 1 FROM part WHERE p_size > 45)"""


@register("create_conflicts", f"""
SELECT id, seq, CASE WHEN seq > 0 THEN 'duplicate in batch' ELSE 'exists' END AS reason FROM {NEW_DATASETS} n
WHERE seq > 0 OR id IN (SELECT id FROM {fx.DATASETS} d)
""")
def create_conflicts(spark, sf_dir):
    """M1: rejects of a create batch (existing keys, repeats inside the batch)."""
    p = read_table(spark, sf_dir, "part")
    new = (p.select((F.col("p_partkey") + 1500).cast("string").alias("id"), F.lit(0).alias("seq"))
           .unionByName(p.filter(F.col("p_size") > 45)
                        .select((F.col("p_partkey") + 1500).cast("string").alias("id"), F.lit(1).alias("seq"))))
    state = cat.datasets(spark, sf_dir).select("id")
    _, rejects = chg.create(state, new, "id")
    return rejects.select("id", "seq", "reason")


@register("create_accepted", f"""
SELECT id FROM {fx.DATASETS} d UNION ALL
SELECT DISTINCT id FROM {NEW_DATASETS} n WHERE id NOT IN (SELECT id FROM {fx.DATASETS} d2)
""")
def create_accepted(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    new = (p.select((F.col("p_partkey") + 1500).cast("string").alias("id"), F.lit(0).alias("seq"))
           .unionByName(p.filter(F.col("p_size") > 45)
                        .select((F.col("p_partkey") + 1500).cast("string").alias("id"), F.lit(1).alias("seq"))))
    state, _ = chg.create(cat.datasets(spark, sf_dir).select("id"), new, "id")
    return state


def _fold_sql(changes_sql: str, records_sql: str = fx.RECORDS) -> str:
    """Oracle of the change fold, written from its definition (reset = last create/delete)."""
    def winner(field: str, cast: str) -> str:
        has = f"op <> 'delete' AND list_contains(ks, '{field}')"
        val = f"CAST(json_extract_string(payload, '$.{field}') AS {cast})"
        return (f"arg_max([{val}], seq) FILTER (WHERE {has}) AS w_{field}, "
                f"max(seq) FILTER (WHERE {has}) AS s_{field}")

    def pick(field: str) -> str:
        return (f"CASE WHEN a.s_{field} IS NOT NULL AND (a.reset_seq IS NULL OR a.s_{field} >= a.reset_seq) "
                f"THEN a.w_{field}[1] WHEN a.reset_seq IS NULL THEN r.{field} ELSE NULL END AS {field}")

    return f"""
WITH ch AS (SELECT key, seq, op, payload, json_keys(payload) AS ks FROM {changes_sql} c),
agg AS (SELECT key,
  max(seq) FILTER (WHERE op IN ('create', 'delete')) AS reset_seq,
  arg_max(op, seq) FILTER (WHERE op IN ('create', 'delete')) AS reset_op,
  {winner('name', 'VARCHAR')}, {winner('score', 'BIGINT')}, {winner('tier', 'BIGINT')}
  FROM ch GROUP BY key)
SELECT coalesce(r.key, a.key) AS key, {pick('name')}, {pick('score')}, {pick('tier')}
FROM {records_sql} r FULL OUTER JOIN agg a ON r.key = a.key
WHERE (a.reset_seq IS NULL AND r.key IS NOT NULL) OR a.reset_op = 'create'
"""


UPDATES_ONLY = f"(SELECT * FROM {fx.CHANGES} c0 WHERE op = 'update')"


@register("partial_update", _fold_sql(UPDATES_ONLY))
def partial_update(spark, sf_dir):
    """M2: merge many partial updates (key presence decides; explicit null overrides)."""
    ups = cat.changes(spark, sf_dir).filter(F.col("op") == "update")
    state, _ = chg.partial_update(cat.records(spark, sf_dir), ups)
    return state


@register("update_body", f"""
SELECT r.key, CASE WHEN b.key IS NULL THEN r.name ELSE b.name END AS name, r.score, r.tier
FROM {fx.RECORDS} r LEFT JOIN
  (SELECT 'k' || c_custkey AS key, upper(c_name) AS name FROM customer WHERE c_mktsegment = 'AUTOMOBILE') b
  ON r.key = b.key
""")
def update_body(spark, sf_dir):
    """M3: the fields that a body holds are set, the others keep their value."""
    c = read_table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "AUTOMOBILE")
    bodies = c.select(F.concat(F.lit("k"), F.col("c_custkey")).alias("key"),
                      F.to_json(F.struct(F.upper("c_name").alias("name"))).alias("payload"))
    return chg.update_body(cat.records(spark, sf_dir), bodies)


@register("doc_replace", f"""
SELECT d.id, d.solution_id, d.name, d.description, d.source, d.slug,
       CASE WHEN v.id IS NULL THEN d.documentation ELSE v.documentation END AS documentation
FROM {fx.DATASETS} d LEFT JOIN
  (SELECT CAST(p_partkey AS VARCHAR) AS id, 'doc v2 ' || p_name AS documentation FROM part WHERE p_size < 5) v
  ON d.id = v.id
""")
def doc_replace(spark, sf_dir):
    """M4: documentation replaced, everything else kept."""
    p = read_table(spark, sf_dir, "part").filter(F.col("p_size") < 5)
    docs = p.select(F.col("p_partkey").cast("string").alias("id"),
                    F.concat(F.lit("doc v2 "), F.col("p_name")).alias("documentation"))
    return chg.replace_field(cat.datasets(spark, sf_dir), docs, "documentation", "id")


@register("delete_keys", f"""
SELECT * FROM {fx.DATASETS} d WHERE id NOT IN (SELECT CAST(l_partkey AS VARCHAR) FROM lineitem WHERE l_quantity > 49)
""")
def delete_keys(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").filter(F.col("l_quantity") > 49)
    return chg.delete_keys(cat.datasets(spark, sf_dir), li.select(F.col("l_partkey").cast("string").alias("id")), "id")


@register("dpa_entries", f"""
SELECT solution_id, slug,
       CASE WHEN has_personal = 'yes' AND status = 'inactive' THEN 'active' ELSE status END AS status,
       toggleable, confirmed, has_personal, category, 1 AS n_amendments, data_type, person_group
FROM {fx.DPA_ENTRIES} e WHERE solution_id <> 'sol24'
""")
def dpa_entries(spark, sf_dir):
    """M7: nested entries keyed (solution, slug): create from suppliers, update status of entries
    holding personal data, delete one solution's entries; struct and array columns pass through."""
    entries = cat.dpa_entries(spark, sf_dir)
    state, _ = chg.create(spark.createDataFrame([], entries.schema), entries, ["solution_id", "slug"])
    updates = (state.filter(F.col("attributes.hasPersonalData") == "yes")
               .select("solution_id", "slug", F.lit("active").alias("status")))
    updates = updates.join(state.filter(F.col("status") == "inactive").select("solution_id", "slug"),
                           ["solution_id", "slug"], "left_semi")
    keyed = state.withColumn("_k", F.concat_ws("/", "solution_id", "slug"))
    upd = updates.withColumn("_k", F.concat_ws("/", "solution_id", "slug")).select("_k", "status")
    state = chg.replace_field(keyed, upd, "status", "_k").drop("_k")
    state = chg.delete_keys(state, state.filter(F.col("solution_id") == "sol24"), ["solution_id", "slug"])
    a = F.col("attributes")
    return state.select(
        "solution_id", "slug", "status", "toggleable",
        a["dataProcessingConfirmed"].alias("confirmed"), a["hasPersonalData"].alias("has_personal"),
        a["dataCategory"].alias("category"), F.size(a["activityAmendments"]).alias("n_amendments"),
        a["activityAmendments"][0]["dataType"].alias("data_type"),
        a["activityAmendments"][0]["personGroup"].alias("person_group"))


@register("dpa_amendments", f"""
WITH entry AS (
  SELECT solution_id, slug, CASE WHEN bal < 1500 THEN 'inactive' ELSE status END AS status, toggleable, has_personal, data_type,
         CASE WHEN bal < 1500 THEN 'suppliers' WHEN bal < 3000 THEN 'visitors' ELSE person_group END AS person_group
  FROM {fx.DPA_ENTRIES} e JOIN (SELECT 's' || s_suppkey AS slug, s_acctbal AS bal FROM supplier) s USING (slug)),
change AS (
  SELECT 'sol' || s_nationkey AS solution_id, 's' || s_suppkey AS slug,
         CASE WHEN l_linenumber = 1 THEN 'type-' || s_nationkey ELSE 'line-' || l_linenumber END AS data_type,
         CASE WHEN l_linestatus = 'O' THEN 'visitors' ELSE 'staff' END AS person_group, max(l_orderkey * 10 + l_linenumber) AS seq,
         arg_max(CASE WHEN l_returnflag = 'R' THEN 'remove' ELSE 'set' END,
                 (l_orderkey * 10 + l_linenumber, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END)) AS op,
         'order ' || arg_max(l_orderkey, l_orderkey * 10 + l_linenumber) || '/access log' AS rest
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2, 3, 4),
item AS (
  SELECT e.solution_id, e.slug, -1 AS pos, e.data_type || '/' || e.person_group || '/' || coalesce(c.rest, 'reporting/pseudonymised') AS item
  FROM entry e LEFT JOIN change c USING (solution_id, slug, data_type, person_group) WHERE c.op IS NULL OR c.op = 'set'
  UNION ALL
  SELECT c.solution_id, c.slug, c.seq, c.data_type || '/' || c.person_group || '/' || c.rest
  FROM change c LEFT JOIN entry e USING (solution_id, slug, data_type, person_group) WHERE c.op = 'set' AND e.status IS NULL),
joined AS (SELECT solution_id, slug, string_agg(item, ';' ORDER BY pos, item) AS amendments FROM item GROUP BY 1, 2)
SELECT e.solution_id, e.slug, e.status, e.toggleable, e.has_personal, coalesce(j.amendments, '') AS amendments
FROM entry e LEFT JOIN joined j USING (solution_id, slug)
""")
def dpa_amendments(spark, sf_dir):
    """M7: entries updated as a whole, then single amendments replaced, added and removed by (data type, person group)."""
    state, _ = chg.dpa_update(cat.dpa_entries(spark, sf_dir), cat.dpa_updates(spark, sf_dir))
    state, _ = chg.merge_nested(state, cat.dpa_amendment_changes(spark, sf_dir), "attributes.activityAmendments",
                                ["dataType", "personGroup"])
    text = F.transform("attributes.activityAmendments",
                       lambda a: F.concat_ws("/", a["dataType"], a["personGroup"], a["purpose"], a["safetyMeasures"]))
    return state.select("solution_id", "slug", "status", "toggleable", F.col("attributes.hasPersonalData").alias("has_personal"),
                        F.array_join(text, ";").alias("amendments"))


@register("apply_changes", _fold_sql(fx.CHANGES))
def apply_changes(spark, sf_dir):
    """M8: the whole create/update/delete stream folded onto the records in one pass."""
    state, _ = chg.apply_changes(cat.records(spark, sf_dir), cat.changes(spark, sf_dir))
    return state


@register("apply_changes_stream", _fold_sql(fx.CHANGES))
def apply_changes_stream(spark, sf_dir):
    """M8 over a stream: the change table lands as files in random seq order, Structured Streaming
    folds two files per micro-batch; the records after the last batch equal the batch fold."""
    from vantage.streaming import changes as stream

    root = scratch_path(spark, "change-stream", uuid.uuid4().hex)
    changes = cat.changes(spark, sf_dir)
    changes.repartition(6).write.parquet(f"{root}/source")
    state = cat.records(spark, sf_dir)
    q = stream.start_change_stream(spark, f"{root}/source", changes.schema, stream.fields_of(state),
                                   f"{root}/fold", f"{root}/checkpoint", files_per_batch=2)
    q.awaitTermination()
    return stream.current_records(spark, state, f"{root}/fold")


@register("apply_changes_rejects", f"""
SELECT key, seq, op, payload FROM (
  SELECT c.*, last_value(CASE WHEN op IN ('create', 'delete') THEN op END IGNORE NULLS)
           OVER (PARTITION BY key ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev,
         key IN (SELECT key FROM {fx.RECORDS} r) AS present
  FROM {fx.CHANGES} c) t
WHERE op <> 'create' AND ((prev IS NULL AND NOT present) OR prev = 'delete')
""")
def apply_changes_rejects(spark, sf_dir):
    """M8 rejects: updates and deletes that reach a key which is absent at that point."""
    _, rejects = chg.apply_changes(cat.records(spark, sf_dir), cat.changes(spark, sf_dir), bucket_width=1000)
    return rejects.select("key", "seq", "op", "payload")


# -- tags and roles -------------------------------------------------------------------------------

@register("tag_assign", f"""
SELECT * FROM (
  SELECT tag_id, resource_id FROM {fx.RESOURCE_TAGS} t
  UNION
  SELECT CASE WHEN p_retailprice > 1900 THEN 'tag-premium' ELSE replace(p_brand, 'Brand#', 'tag-') END,
         CAST(p_partkey AS VARCHAR) FROM part WHERE p_retailprice > 1900 OR p_size < 3) u
WHERE (tag_id, resource_id) NOT IN (SELECT 'tag-premium', CAST(p_partkey AS VARCHAR) FROM part WHERE p_size = 1)
""")
def tag_assign(spark, sf_dir):
    """Assign (new tags, plus pairs that already exist) then unassign."""
    p = read_table(spark, sf_dir, "part")
    new = (p.filter((F.col("p_retailprice") > 1900) | (F.col("p_size") < 3))
           .select(F.when(F.col("p_retailprice") > 1900, F.lit("tag-premium"))
                    .otherwise(F.regexp_replace("p_brand", "Brand#", "tag-")).alias("tag_id"),
                   F.col("p_partkey").cast("string").alias("resource_id")))
    remove = p.filter(F.col("p_size") == 1).select(F.lit("tag-premium").alias("tag_id"),
                                                    F.col("p_partkey").cast("string").alias("resource_id"))
    return roles.tag_unassign(roles.tag_assign(cat.resource_tags(spark, sf_dir), new), remove)


@register("resources_by_tags", f"""
SELECT * FROM {fx.RESOURCES} r WHERE id IN (SELECT resource_id FROM {fx.RESOURCE_TAGS} t WHERE tag_id IN ('tag-7', 'tag-13'))
""")
def resources_by_tags(spark, sf_dir):
    return roles.resources_by_tags(cat.resources(spark, sf_dir), cat.resource_tags(spark, sf_dir), ["tag-7", "tag-13"])


_LAST_ASSIGN = f"""(SELECT resource_id, principal_id, arg_max(role, seq) AS role FROM {fx.ROLE_CHANGES} c
  WHERE op = 'assign' GROUP BY 1, 2)"""


@register("role_assign", f"""
SELECT a.resource_id, a.principal_id, a.role FROM {fx.ROLE_ASSIGNMENTS} a
WHERE (resource_id, principal_id) NOT IN (SELECT resource_id, principal_id FROM {_LAST_ASSIGN} l)
UNION ALL SELECT * FROM {_LAST_ASSIGN} l2
""")
def role_assign(spark, sf_dir):
    new = cat.role_changes(spark, sf_dir).filter(F.col("op") == "assign")
    return roles.role_assign(cat.role_assignments(spark, sf_dir), new)


@register("role_unassign", f"""
SELECT * FROM {fx.ROLE_ASSIGNMENTS} a
WHERE (resource_id, principal_id) NOT IN (SELECT resource_id, principal_id FROM {fx.ROLE_CHANGES} c WHERE op = 'unassign')
""")
def role_unassign(spark, sf_dir):
    remove = cat.role_changes(spark, sf_dir).filter(F.col("op") == "unassign")
    return roles.role_unassign(cat.role_assignments(spark, sf_dir), remove)


@register("role_delta", f"""
WITH last AS (SELECT resource_id, principal_id,
    arg_max(op, (seq, CASE WHEN op = 'assign' THEN 1 ELSE 0 END)) AS op,
    arg_max(role, (seq, CASE WHEN op = 'assign' THEN 1 ELSE 0 END)) AS role
  FROM {fx.ROLE_CHANGES} c GROUP BY 1, 2)
SELECT a.* FROM {fx.ROLE_ASSIGNMENTS} a
WHERE (resource_id, principal_id) NOT IN (SELECT resource_id, principal_id FROM last)
UNION ALL SELECT resource_id, principal_id, role FROM last WHERE op = 'assign'
""")
def role_delta(spark, sf_dir):
    return roles.role_delta(cat.role_assignments(spark, sf_dir), cat.role_changes(spark, sf_dir))


@register("resource_principals", f"""
SELECT * FROM {fx.ROLE_ASSIGNMENTS} a WHERE role = 'admin'
""")
def resource_principals(spark, sf_dir):
    return roles.resource_principals(cat.role_assignments(spark, sf_dir), None, {"role": "admin", "principal_id": ""})
