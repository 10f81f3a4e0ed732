"""Datasets in and out, lookups, registration, column catalog, source timestamps."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vantage.operators import metadata as md
from vantage.operators.listing import lookup
from vantage.session import scratch_path
from vantage.sources import catalog as cat
from vantage.sources import datasets as ds
from vantage.sources.tables import read_table
from vantage.suite import fixtures_sql as fx
from vantage.suite.registry import register


@register("dataset_roundtrip", """
SELECT * FROM lineitem
""")
def dataset_roundtrip(spark, sf_dir):
    """S3 write partitioned by return flag and sorted by order key within files, S1 whole read back."""
    path = scratch_path(spark, "datasets", uuid.uuid4().hex)
    li = read_table(spark, sf_dir, "lineitem")
    ds.write_dataset(li, path, partition_by=["l_returnflag"], sort_within=["l_orderkey"])
    return ds.read_dataset(spark, path).select(*li.columns)


@register("dataset_partition_values", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 4 = 0 THEN '01' WHEN o_orderkey % 4 = 1 THEN '1' WHEN o_orderkey % 4 = 2 THEN '' END AS code,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(year(o_orderdate) AS INTEGER) END AS year, o_totalprice
FROM orders
""")
def dataset_partition_values(spark, sf_dir):
    """S3/S1 through the store: a dataset partitioned by a string column that holds '01', '1', '' and NULL and by
    a number with NULLs is replaced by a second version and comes back whole and with its types."""
    store = ds.DatasetStore(spark, scratch_path(spark, "datasets", uuid.uuid4().hex))
    o = read_table(spark, sf_dir, "orders")
    rest = F.col("o_orderkey") % 4
    code = F.when(rest == 0, "01").when(rest == 1, "1").when(rest == 2, "")
    year = F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate"))
    store.write("orders", o.select("o_orderkey"))
    store.write("orders", o.select("o_orderkey", code.alias("code"), year.alias("year"), "o_totalprice"), partition_by=["code", "year"])
    return store.read("orders")


@register("dataset_lookup", f"""
SELECT r.id, d.name, d.slug, d.id IS NOT NULL AS found
FROM (SELECT DISTINCT CAST(o_custkey * 2 AS VARCHAR) AS id FROM orders) r LEFT JOIN {fx.DATASETS} d ON r.id = d.id
""")
def dataset_lookup(spark, sf_dir):
    """S4 in bulk: every requested id looked up in one join."""
    requests = read_table(spark, sf_dir, "orders").select((F.col("o_custkey") * 2).cast("string").alias("id")).distinct()
    found = lookup(cat.datasets(spark, sf_dir).select("id", "name", "slug"), requests, "id")
    return found.select("id", "name", "slug", "found")


@register("dataset_lookup_slug", f"""
SELECT d.id, d.solution_id, d.slug FROM {fx.DATASETS} d
WHERE (d.solution_id, d.slug) IN (SELECT lower(p_type), 'p' || (p_partkey + p_size) FROM part)
""")
def dataset_lookup_slug(spark, sf_dir):
    """S5 in bulk: (solution, slug) pairs looked up with a semi-join."""
    p = read_table(spark, sf_dir, "part")
    requests = p.select(F.lower("p_type").alias("solution_id"),
                        F.concat(F.lit("p"), F.col("p_partkey") + F.col("p_size")).alias("slug"))
    return ds.lookup_by_slug(cat.datasets(spark, sf_dir), requests).select("id", "solution_id", "slug")


@register("dataset_get_or_create", f"""
SELECT id, solution_id, name, slug, FALSE AS created FROM {fx.DATASETS} d
UNION ALL
SELECT 'ds_' || substr(sha256(w.solution_id || '|' || w.slug), 1, 16), w.solution_id, w.name, w.slug, TRUE
FROM (SELECT solution_id, slug, arg_min(name, seq) AS name FROM (
        SELECT lower(p_type) AS solution_id, 'p' || (p_partkey + 1000) AS slug, p_name AS name, 0 AS seq FROM part
        UNION ALL
        SELECT lower(p_type), 'p' || (p_partkey + 1000), upper(p_name), 1 FROM part WHERE p_size > 45) x
      GROUP BY solution_id, slug) w
WHERE (w.solution_id, w.slug) NOT IN (SELECT solution_id, slug FROM {fx.DATASETS} d2)
""")
def dataset_get_or_create(spark, sf_dir):
    """S6 in bulk: existing registrations win, new ones are created once per key."""
    p = read_table(spark, sf_dir, "part")
    key = [F.lower("p_type").alias("solution_id"), F.concat(F.lit("p"), F.col("p_partkey") + 1000).alias("slug")]
    wanted = (p.select(*key, F.col("p_name").alias("name"), F.lit(0).alias("seq"))
              .unionByName(p.filter(F.col("p_size") > 45)
                           .select(*key, F.upper("p_name").alias("name"), F.lit(1).alias("seq"))))
    out = ds.get_or_create(cat.datasets(spark, sf_dir), wanted, id_prefix="ds", separator="|")
    return out.select("id", "solution_id", "name", "slug", "created")


@register("dataset_columns", f"""
SELECT dataset_id, column_id, type, label, position, table_name FROM {fx.DATASET_COLUMNS} t
""")
def dataset_columns(spark, sf_dir):
    """Column catalog of every dataset (types from the Parquet footers, metadata as a map)."""
    cols = cat.dataset_columns(spark, sf_dir)
    return cols.select("dataset_id", "column_id", "type", "label",
                       F.col("metadata")["position"].cast("int").alias("position"),
                       F.col("metadata")["table"].alias("table_name"))


@register("dataset_metadata_read", f"""
SELECT CAST(p_partkey AS VARCHAR) AS dataset_id,
       CASE WHEN p_size < 50 AND p_partkey % 7 > 3 THEN
         '{{"c1":{{"label":"' || p_brand || '","position":' || p_size || '}},"c2":{{"hidden":' || (p_size > 25) || '}},"c3":{{}}}}'
       ELSE '{{}}' END AS columns
FROM part
""")
def dataset_metadata_read(spark, sf_dir):
    """S7 read: the columns' metadata of every dataset document; a missing level reads as an empty object."""
    return md.metadata_columns(cat.dataset_documents(spark, sf_dir)).select("dataset_id", "columns")


@register("dataset_metadata_columns", """
SELECT CAST(p_partkey AS VARCHAR) AS dataset_id, c.column_id, c.label, c.hidden FROM part,
  (VALUES ('c1'), ('c2'), ('c3')) v(name),
  LATERAL (SELECT v.name AS column_id, CASE v.name WHEN 'c1' THEN p_brand END AS label,
                  CASE v.name WHEN 'c2' THEN CAST(p_size > 25 AS VARCHAR) END AS hidden) c
WHERE p_size < 50 AND p_partkey % 7 > 3
""")
def dataset_metadata_columns(spark, sf_dir):
    """S7 read as a table: one row per column that a document describes."""
    rows = md.column_rows(cat.dataset_documents(spark, sf_dir))
    return rows.select("dataset_id", "column_id", F.try_element_at("metadata", F.lit("label")).alias("label"),
                       F.try_element_at("metadata", F.lit("hidden")).alias("hidden"))


_UPDATES_SQL = """(SELECT CAST(o_custkey AS VARCHAR) AS dataset_id, o_orderkey AS seq, column_id,
    CASE WHEN column_id = 'c_name' THEN 'label=' || o_orderpriority || ',order=' || o_orderkey
         WHEN column_id = 'c_acctbal' THEN 'order=' || o_orderkey || ',unit=EUR' WHEN column_id = 'c_custkey' THEN 'unit=' ELSE '' END AS metadata
  FROM orders, (VALUES ('c_name'), ('c_missing'), ('c_acctbal'), ('c_custkey')) v(column_id)
  WHERE o_orderkey % 11 <> 0 AND CASE WHEN o_orderkey % 11 = 1 THEN column_id = 'c_custkey'
        WHEN o_orderstatus = 'F' THEN column_id IN ('c_name', 'c_missing') ELSE column_id = 'c_acctbal' END)"""


def _flat(metadata):
    """A metadata map as one text, its entries in order."""
    entries = F.transform(F.array_sort(F.map_entries(metadata)), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))))
    return F.array_join(entries, ",")


@register("dataset_metadata_merge", f"""
WITH last AS (SELECT dataset_id, column_id, arg_max(metadata, seq) AS metadata FROM {_UPDATES_SQL} u GROUP BY 1, 2)
SELECT t.dataset_id, t.column_id, t.label,
       coalesce(l.metadata, 'position=' || t.position || ',table=' || t.table_name) AS metadata
FROM {fx.DATASET_COLUMNS} t LEFT JOIN last l ON t.dataset_id = l.dataset_id AND t.column_id = l.column_id
""")
def dataset_metadata_merge(spark, sf_dir):
    """S7 write: the whole column catalog after the updates."""
    new, _ = md.merge_column_metadata(cat.dataset_columns(spark, sf_dir), cat.metadata_updates(spark, sf_dir))
    return new.select("dataset_id", "column_id", "label", _flat(F.col("metadata")).alias("metadata"))


@register("dataset_metadata_rejects", f"""
SELECT CAST(o_custkey AS VARCHAR) AS dataset_id, NULL AS column_id, o_orderkey AS seq, 'bad payload' AS reason
FROM orders WHERE o_orderkey % 11 = 0
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'c_name', o_orderkey, 'bad column' FROM orders WHERE o_orderkey % 11 = 1
UNION ALL SELECT dataset_id, column_id, max(seq), 'absent column' FROM {_UPDATES_SQL} u
WHERE (dataset_id, column_id) NOT IN (SELECT dataset_id, column_id FROM {fx.DATASET_COLUMNS} t) GROUP BY 1, 2
""")
def dataset_metadata_rejects(spark, sf_dir):
    """S7 write: what could not be applied."""
    _, rejects = md.merge_column_metadata(cat.dataset_columns(spark, sf_dir), cat.metadata_updates(spark, sf_dir))
    return rejects


SOURCE_TS_SQL = """(SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
       WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ')
       WHEN starts_with(o_orderpriority, '1') THEN o_orderpriority
       ELSE day(o_orderdate) || '-' || month(o_orderdate) || '-' || year(o_orderdate) END AS source_timestamp
  FROM orders)"""


@register("source_timestamp", f"""
SELECT o_orderkey, source_timestamp,
       CASE WHEN regexp_full_match(source_timestamp, '[0-9]+-[0-9]+-[0-9]+') THEN source_timestamp || 'T00:00:00Z'
            ELSE source_timestamp END AS source_timestamp_norm
FROM {SOURCE_TS_SQL} t
""")
def source_timestamp(spark, sf_dir):
    """S8 over one source timestamp per order, in the shapes seen in practice: date only, full ISO,
    free text with one dash, and d-m-yyyy."""
    o = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    raw = (F.when(F.col("o_orderstatus") == "F", F.date_format(d, "yyyy-MM-dd"))
            .when(F.col("o_orderstatus") == "O", F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(F.col("o_orderpriority").startswith("1"), F.col("o_orderpriority"))
            .otherwise(F.concat_ws("-", F.dayofmonth(d), F.month(d), F.year(d))))
    return ds.normalized_source_timestamps(o.select("o_orderkey", raw.alias("source_timestamp")))
