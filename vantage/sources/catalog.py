"""Catalog tables derived from the driver tables (FIXTURES.md §3).

The catalog the operators work on — resources, datasets, tags, role assignments, change streams,
reports — is derived here from the TPC-H-like tables so that every catalog query reads data that
grows with the scale factor. The DuckDB twins of these definitions are in
``vantage/suite/fixtures_sql.py``; both sides use the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.sources.tables import read_table

# Fixed values of the derivation.
DEFAULT_TAG_COLOR = "#1F009D"
TYPE_TO_TABLE = {  # which driver table's schema a dataset of a given part type carries
    "ECONOMY": "customer", "LARGE": "lineitem", "SMALL": "orders",
    "PROMO": "part", "STANDARD": "supplier", "MEDIUM": "events",
}


def role_band(value: Column) -> Column:
    return F.when(value < 20, "viewer").when(value < 100, "editor").otherwise("admin")


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.lower("p_type").alias("container_id"),
        F.when(F.col("p_size") <= 20, "dataset").when(F.col("p_size") <= 40, "insight")
         .otherwise("report").alias("resource_type"),
        F.when(F.col("p_size") == 50, F.col("p_name"))
         .otherwise(F.concat_ws(" - ", "p_brand", "p_name")).alias("name"),
    )


def datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("id"),
        F.lower("p_type").alias("solution_id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("description"),
        F.col("p_type").alias("source"),
        F.concat(F.lit("p"), F.col("p_partkey")).alias("slug"),
        F.when(F.col("p_size") > 45, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("size "), F.col("p_size"))).alias("documentation"),
    )


def schema_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(table, column_id, type, position) for the tables named in ``TYPE_TO_TABLE`` — read from
    Parquet footers, a few dozen rows whatever the scale."""
    rows = []
    for table in sorted(set(TYPE_TO_TABLE.values())):
        for pos, f in enumerate(read_table(spark, sf_dir, table).schema.fields, start=1):
            rows.append((table, f.name, f.dataType.simpleString(), pos))
    return spark.createDataFrame(rows, "table string, column_id string, type string, position int")


def column_label(column_id: Column, dtype: Column) -> Column:
    return (F.when(dtype.isin("int", "bigint"), F.concat(F.lit("Anzahl "), column_id))
             .when(dtype == "double", F.concat(column_id, F.lit(" %")))
             .otherwise(column_id))


def dataset_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (dataset, column): each dataset carries the schema of the table its type maps to.
    The schema side is a few dozen rows (bounded by the number of driver columns), so the join
    broadcasts it without growing."""
    mapping = spark.createDataFrame(list(TYPE_TO_TABLE.items()), "p_type string, table string")
    cols = schema_rows(spark, sf_dir).join(F.broadcast(mapping), "table")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    return (p.join(F.broadcast(cols), "p_type")
            .select(F.col("p_partkey").cast("string").alias("dataset_id"),
                    "column_id", "type",
                    column_label(F.col("column_id"), F.col("type")).alias("label"),
                    F.create_map(F.lit("position"), F.col("position").cast("string"),
                                 F.lit("table"), F.col("table")).alias("metadata")))


def dataset_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document per dataset, as its details come from a catalog: with column metadata, without columns, with
    a null or missing level above them, or cut off."""
    p = read_table(spark, sf_dir, "part")
    key = F.col("p_partkey").cast("string")
    columns = F.concat(F.lit('{"c1": {"label": "'), F.col("p_brand"), F.lit('", "position": '), F.col("p_size"),
                       F.lit('}, "c2": {"hidden": '), (F.col("p_size") > 25).cast("string"), F.lit('}, "c3": {}}'))
    kind = F.col("p_partkey") % 7
    meta = (F.when(kind == 0, F.lit(""))
             .when(kind == 1, F.lit(', "metadata": null'))
             .when(kind == 2, F.lit(', "metadata": {}'))
             .when(kind == 3, F.lit(', "metadata": {"schema": {"rows": 5}}'))
             .otherwise(F.concat(F.lit(', "metadata": {"schema": {"columns": '), columns, F.lit("}}"))))
    text = F.concat(F.lit('{"id": "'), key, F.lit('"'), meta, F.lit("}"))
    return p.select(key.alias("dataset_id"), F.when(F.col("p_size") == 50, F.substring(text, 1, 20)).otherwise(text).alias("document"))


def metadata_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Updates of column metadata, one per order: to the dataset of the order's customer number. They name the columns
    of a customer dataset and one that does not exist; some payloads are no objects."""
    o = read_table(spark, sf_dir, "orders")
    payload = (F.when(F.col("o_orderkey") % 11 == 0, F.lit("[1, 2]"))
               .when(F.col("o_orderkey") % 11 == 1, F.lit('{"c_name": "no object", "c_custkey": {"unit": null}}'))
               .when(F.col("o_orderstatus") == "F", F.concat(
                   F.lit('{"c_name": {"label": "'), F.col("o_orderpriority"), F.lit('", "order": '), F.col("o_orderkey"),
                   F.lit('}, "c_missing": {}}')))
               .otherwise(F.concat(F.lit('{"c_acctbal": {"unit": "EUR", "order": "'), F.col("o_orderkey"), F.lit('"}}'))))
    return o.select(F.col("o_custkey").cast("string").alias("dataset_id"), F.col("o_orderkey").alias("seq"), payload.alias("columns"))


def tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return (p.select(F.regexp_replace("p_brand", "Brand#", "tag-").alias("tag_id"),
                     F.col("p_brand").alias("name"), F.lit(DEFAULT_TAG_COLOR).alias("color"))
            .distinct())


def resource_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.regexp_replace("p_brand", "Brand#", "tag-").alias("tag_id"),
                    F.col("p_partkey").cast("string").alias("resource_id"))


def role_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current (resource, principal, role): the role of the latest event of each pair."""
    e = read_table(spark, sf_dir, "events")
    return (e.groupBy(F.col("user_id").cast("string").alias("resource_id"),
                      F.concat(F.lit("g-"), F.col("event_type")).alias("principal_id"))
            .agg(F.max_by("value", "event_id").alias("_v"))
            .select("resource_id", "principal_id", role_band(F.col("_v")).alias("role")))


def role_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("resource_id"),
        F.concat(F.lit("g-"), F.col("event_type")).alias("principal_id"),
        F.col("event_id").alias("seq"),
        F.when(F.col("value") < 10, "unassign").otherwise("assign").alias("op"),
        role_band(F.col("value")).alias("role"),
    )


def _k(e: DataFrame) -> Column:
    return F.get_json_object(F.col("props"), "$.k")


def memberships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(group_id, member_id): an event group holds a region's group, that its nations' groups, those the suppliers. One nation
    holds its region again, so there is a cycle."""
    events = F.array(*[F.lit(f"g-{e}") for e in ("click", "view", "purchase", "signup", "error")])
    nation = read_table(spark, sf_dir, "nation")
    region_of = F.concat(F.lit("region-"), F.col("n_regionkey"))
    nation_of = F.concat(F.lit("nation-"), F.col("n_nationkey"))
    pairs = [
        read_table(spark, sf_dir, "region").select(F.element_at(events, F.col("r_regionkey") + 1).alias("group_id"),
                                                   F.concat(F.lit("region-"), F.col("r_regionkey")).alias("member_id")),
        nation.select(region_of, nation_of),
        nation.where("n_nationkey = 3").select(nation_of, region_of),
        read_table(spark, sf_dir, "supplier").select(F.concat(F.lit("nation-"), F.col("s_nationkey")), F.concat(F.lit("u"), F.col("s_suppkey"))),
    ]
    out = pairs[0]
    for pair in pairs[1:]:
        out = out.union(pair)
    return out


def containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(container_id, id): a workspace per brand holds solutions, a solution its resources."""
    p = read_table(spark, sf_dir, "part")
    solution = F.lower("p_type")
    workspaces = p.where("p_size < 3").select(F.concat(F.lit("ws-"), F.col("p_brand")).alias("container_id"), solution.alias("id")).distinct()
    return workspaces.union(p.select(solution, F.col("p_partkey").cast("string")))


def container_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assignments on containers: every nation's group has a role on one solution or one workspace."""
    n = read_table(spark, sf_dir, "nation")
    kinds = F.array(*[F.lit(t.lower()) for t in sorted(TYPE_TO_TABLE)])
    where = F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("ws-Brand#"), F.col("n_nationkey") + 1)).otherwise(
        F.element_at(kinds, F.col("n_nationkey") % 6 + 1))
    return n.select(where.alias("resource_id"), F.concat(F.lit("nation-"), F.col("n_nationkey")).alias("principal_id"),
                    role_band(F.col("n_nationkey") * 7).alias("role"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change stream (key, seq, op, payload JSON). Payloads carry a subset of the fields
    name/score/tier, sometimes an explicit JSON null."""
    e = read_table(spark, sf_dir, "events")
    score = F.round(F.col("value") * 100).cast("bigint").cast("string")
    k = _k(e)
    payload = (
        F.when(F.col("event_type") == "signup",
               F.concat(F.lit('{"name": "n'), F.col("event_id").cast("string"), F.lit('", "score": '), score,
                        F.lit(', "tier": '), k, F.lit("}")))
         .when(F.col("event_type") == "click", F.concat(F.lit('{"score": '), score, F.lit("}")))
         .when(F.col("event_type") == "view",
               F.concat(F.lit('{"name": "v'), F.col("event_id").cast("string"), F.lit('"}')))
         .when((F.col("event_type") == "purchase") & (F.col("value") < 30),
               F.concat(F.lit('{"tier": '), k, F.lit(', "score": null}')))
         .when(F.col("event_type") == "purchase", F.concat(F.lit('{"tier": '), k, F.lit("}")))
         .otherwise(F.lit("{}"))
    )
    return e.select(
        F.concat(F.lit("k"), F.col("user_id")).alias("key"),
        F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "signup", "create").when(F.col("event_type") == "error", "delete")
         .otherwise("update").alias("op"),
        payload.alias("payload"),
    )


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current keyed records the change stream applies to: one per customer."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.concat(F.lit("k"), F.col("c_custkey")).alias("key"),
                    F.col("c_name").alias("name"),
                    F.floor("c_acctbal").cast("bigint").alias("score"),
                    F.col("c_nationkey").cast("bigint").alias("tier"))


def _widget_json(block_id: Column, insight_id: Column) -> Column:
    return F.concat(F.lit('{"type": "widget", "id": "'), block_id,
                    F.lit('", "children": [{"text": ""}], "widgetData": {"insightId": "'), insight_id,
                    F.lit('"}, "height": null}'))


def _line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per line item: its report (the order), block position and JSON, the widget's insight id, and
    the insight the report referenced before its structure was edited (``current_id``)."""
    li = read_table(spark, sf_dir, "lineitem")
    insight = F.when(F.col("l_linenumber") == 7, F.lit("")).otherwise(F.concat(F.lit("ins"), F.col("l_partkey")))
    block_id = F.concat(F.lit("b"), F.col("l_orderkey"), F.lit("_"), F.col("l_linenumber"))
    widget = _widget_json(block_id, insight)
    paragraph = (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1)
    block = (
        F.when(paragraph,
               F.concat(F.lit('{"type": "p", "children": [{"text": "note"}], "widgetData": {"insightId": "'),
                        insight, F.lit('"}}')))
         .when((F.col("l_returnflag") == "R") & (F.col("l_linenumber") % 2 == 0),
               F.concat(F.lit('{"type": "column-group", "children": [{"type": "column", "children": ['),
                        widget, F.lit("]}]}")))
         .otherwise(widget)
    )
    current = (F.when(F.col("l_quantity") > 25, F.concat(F.lit("ins"), F.col("l_partkey")))
                .when(F.col("l_quantity") <= 5, F.concat(F.lit("old"), F.col("l_partkey"))))
    return li.select(
        F.concat(F.lit("rep"), F.col("l_orderkey")).alias("report_id"),
        F.col("l_linenumber").alias("pos"),
        block.alias("block"),
        F.when(~paragraph, insight).alias("insight_id"),
        current.alias("current_id"),
    )


def report_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One block per line item; report = order. Returned even lines become column groups holding
    the widget one level down; the first line of open orders is a paragraph that carries
    ``widgetData`` (not a widget, so its ``insight_id`` is NULL); line 7 is a widget with an empty
    insight id."""
    return _line_blocks(spark, sf_dir).drop("current_id")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(report_id, structure JSON, current_insights): one report per order, built in one grouped
    aggregation over the line items (blocks per report are bounded by the lines of one order).
    ``current_insights`` is the reference list as it stood before the structure was edited: big
    lines' insights plus stale ones of small lines."""
    per = _line_blocks(spark, sf_dir).groupBy("report_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "block"))).alias("_b"),
        F.array_sort(F.array_distinct(F.collect_list("current_id"))).alias("current_insights"))
    return per.select(
        "report_id",
        F.concat(F.lit('{"editorState": ['), F.array_join(F.col("_b.block"), ", "), F.lit("]}")).alias("structure"),
        "current_insights")


def report_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("v"), F.col("o_orderkey")).alias("id"),
        F.concat(F.lit("rep"), F.col("o_custkey")).alias("report_id"),
        F.col("o_orderpriority").alias("name"),
        F.concat(F.lit('{"status": "'), F.col("o_orderstatus"), F.lit('"}')).alias("config"),
    )


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything a lookup can ask for: (entity_type, key, id, name)."""
    res = resources(spark, sf_dir)
    insight = res.where("resource_type = 'insight'")
    parts = [
        insight.select(F.lit("insight").alias("entity_type"), F.col("id").alias("key"), "id", "name"),
        insight.select(F.lit("insight_slug"), F.concat(F.lit("p"), F.col("id")), "id", "name"),
        res.where("resource_type = 'report'").select(F.lit("report"), "id", "id", "name"),
        report_views(spark, sf_dir).select(F.lit("report_view"), "id", "id", "name"),
        res.select("container_id").distinct().select(F.lit("solution"), "container_id", "container_id", "container_id"),
        tags(spark, sf_dir).select(F.lit("tag"), "tag_id", "tag_id", "name"),
        role_changes(spark, sf_dir).select("principal_id").distinct().select(
            F.lit("group"), "principal_id", "principal_id", F.substring("principal_id", 3, 100)),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def lookup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One lookup per line item, of all entity types, with misses: (entity_type, key)."""
    li = read_table(spark, sf_dir, "lineitem")
    part, kind = F.col("l_partkey").cast("string"), F.col("l_linenumber") % 7
    types = ["insight", "insight_slug", "report", "report_view", "solution", "tag", "group"]
    keys = [part, F.concat(F.lit("p"), part), part, F.concat(F.lit("v"), F.col("l_orderkey") * 2),
            F.when(F.col("l_returnflag") == "R", "economy").when(F.col("l_returnflag") == "A", "large").otherwise("nowhere"),
            F.concat(F.lit("tag-"), F.col("l_partkey") % 40), F.when(F.col("l_linestatus") == "O", "g-click").otherwise("g-nobody")]
    entity, key = F.lit(types[0]), keys[0]
    for i in range(1, 7):
        entity, key = F.when(kind == i, types[i]).otherwise(entity), F.when(kind == i, keys[i]).otherwise(key)
    return li.select(entity.alias("entity_type"), key.alias("key"))


def dpa_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat requests to create processing-register entries, one per supplier. Status and
    toggleable are left out (NULL) where the defaults apply."""
    s = read_table(spark, sf_dir, "supplier")
    return s.select(
        F.concat(F.lit("sol"), F.col("s_nationkey")).alias("solution_id"),
        F.concat(F.lit("s"), F.col("s_suppkey")).alias("slug"),
        F.when(F.col("s_acctbal") > 5000, F.lit("active")).alias("status"),
        F.when(F.col("s_acctbal") < 0, F.lit(False)).alias("toggleable"),
        (F.col("s_acctbal") > 1000).alias("data_processing_confirmed"),
        F.when(F.col("s_acctbal") > 2000, "yes").otherwise("no").alias("has_personal_data"),
        F.concat(F.lit("cat-"), F.col("s_nationkey")).alias("data_category"),
        F.concat(F.lit("type-"), F.col("s_nationkey")).alias("data_type"),
        F.when(F.col("s_acctbal") < 0, "customers").otherwise("staff").alias("person_group"),
        F.lit("reporting").alias("purpose"),
        F.lit("pseudonymised").alias("safety_measures"),
    )


def dpa_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested entries built from ``dpa_requests``."""
    from vantage.operators.changes import dpa_entries_from

    return dpa_entries_from(dpa_requests(spark, sf_dir))


def dpa_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat update requests for the entries of suppliers with a low balance, two for some of them."""
    base = dpa_requests(spark, sf_dir)
    s = read_table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("slug"), "s_acctbal")
    low = base.join(s.where(F.col("s_acctbal") < 3000), "slug")
    first = low.withColumn("seq", F.lit(1)).withColumn("person_group", F.lit("visitors"))
    second = (low.where(F.col("s_acctbal") < 1500).withColumn("seq", F.lit(2))
              .withColumn("person_group", F.lit("suppliers")).withColumn("status", F.lit(None).cast("string")))
    columns = ["seq", *base.columns]
    return first.select(*columns).unionByName(second.select(*columns))


def dpa_amendment_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of single amendments, one per line item, keyed by the line's supplier: returned lines
    remove an amendment, the others set one. First lines name the entry's own data type."""
    li = read_table(spark, sf_dir, "lineitem")
    s = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    kind = F.when(F.col("l_linenumber") == 1, F.concat(F.lit("type-"), F.col("s_nationkey"))).otherwise(
        F.concat(F.lit("line-"), F.col("l_linenumber")))
    item = F.struct(kind.alias("dataType"), F.when(F.col("l_linestatus") == "O", "visitors").otherwise("staff").alias("personGroup"),
                    F.concat(F.lit("order "), F.col("l_orderkey")).alias("purpose"), F.lit("access log").alias("safetyMeasures"))
    return li.join(s, "l_suppkey").select(
        F.concat(F.lit("sol"), F.col("s_nationkey")).alias("solution_id"), F.concat(F.lit("s"), F.col("l_suppkey")).alias("slug"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
        F.when(F.col("l_returnflag") == "R", "remove").otherwise("set").alias("op"), item.alias("item"))


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records to validate: content type, status and JSON body; every seventh body is cut."""
    e = read_table(spark, sf_dir, "events")
    body = F.concat(F.lit('{"data": {"id": "e'), F.col("event_id"), F.lit('", "props": '), F.col("props"),
                    F.lit("}}"))
    return e.select(
        F.col("event_id").alias("id"),
        F.when(F.col("event_type") == "view", "text/plain").otherwise("application/json").alias("content_type"),
        F.when(F.col("value") < 5, 500).when(F.col("value") < 100, 200).otherwise(201).alias("status"),
        F.when(F.col("event_id") % 7 == 0, F.substring(body, 1, 12))
         .when(F.col("event_type") == "error", F.concat(F.lit('{"meta": '), F.col("props"), F.lit("}")))
         .otherwise(body).alias("body"),
    )

