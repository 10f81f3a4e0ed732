"""Catalog listing, paging, search and batch lookups as set operations.

A listing is a filter plus semi-joins; paging is an ordered slice of it. Listing everything is
the unpaged DataFrame itself: no page loop. Lookups of many ids at once are one join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vantage.functions.expressions import search_match
from vantage.session import checkpoint_dir

# Decided here: which roles satisfy a permission name (the spec names only can_edit and admin).
DEFAULT_PERMISSION_ROLES = {
    "can_view": ("viewer", "editor", "admin"),
    "can_edit": ("editor", "admin"),
    "admin": ("admin",),
}


def list_resources(resources: DataFrame, container_id: str, resource_type: str = "dataset",
                   permission: str | None = "can_edit", principal_id: str | None = None,
                   role_assignments: DataFrame | None = None, search: str | None = None,
                   tag_ids: list[str] | None = None, resource_tags: DataFrame | None = None,
                   permission_roles: dict | None = None) -> DataFrame:
    """C1 (+T2, C4): resources of a type in a container; with a principal, only those on which
    the principal holds a role that grants ``permission``; with tags, those carrying any of them."""
    out = resources.filter((F.col("container_id") == container_id) & (F.col("resource_type") == resource_type))
    out = out.filter(search_match(F.col("name"), search))
    if principal_id is not None:
        if role_assignments is None:
            raise ValueError("principal given without role assignments")
        roles = (permission_roles or DEFAULT_PERMISSION_ROLES).get(permission)
        if roles is None:
            raise ValueError(f"unknown permission {permission!r}")
        grants = role_assignments.filter((F.col("principal_id") == principal_id) & F.col("role").isin(*roles))
        out = out.join(grants.select(F.col("resource_id").alias("id")), "id", "left_semi")
    if tag_ids:
        if resource_tags is None:
            raise ValueError("tags given without resource_tags")
        tagged = resource_tags.filter(F.col("tag_id").isin(*tag_ids)).select(F.col("resource_id").alias("id"))
        out = out.join(tagged, "id", "left_semi")
    return out.select(*resources.columns)


def _order(cols: list[str | Column]) -> list[Column]:
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in cols]


def page(df: DataFrame, page_nr: int = 1, size: int = 100, order_by: list | None = None) -> DataFrame:
    """One 1-based page of an ordered listing: ``orderBy.offset.limit``, whatever the page number.

    Lazy; Spark plans it as a top-k of ``page_nr * size`` rows and falls back to a sort beyond
    ``spark.sql.execution.topKSortFallbackThreshold``. Rows that tie are ordered by ``id``. Many or
    deep pages of a large listing come from ``with_page_numbers`` in one pass instead.
    """
    if page_nr < 1 or size < 1:
        raise ValueError("page and size are 1-based and positive")
    order_by = list(order_by or ["id"])
    if "id" in df.columns and "id" not in [c for c in order_by if isinstance(c, str)]:
        order_by.append("id")
    return df.orderBy(*_order(order_by)).offset((page_nr - 1) * size).limit(size)


def total(df: DataFrame) -> DataFrame:
    """The ``total`` of a page envelope: a one-row distributed count (the page itself is ``page``)."""
    return df.agg(F.count(F.lit(1)).alias("total"))


def with_row_numbers(df: DataFrame, order_by: list, name: str = "row_nr") -> DataFrame:
    """1-based global row numbers in ``order_by`` order without pulling the table into one task.

    The frame is range-partitioned by the order and sorted within partitions, checkpointed to the
    shared folder (so both passes below see the same partitioning, also after executor loss), its
    per-partition row counts (one row per partition) turned into offsets, and each row numbered
    as partition offset + position within the partition.
    """
    checkpoint_dir(df.sparkSession)      # make sure the session has its shared checkpoint folder
    order = _order(order_by)
    ordered = df.orderBy(*order).withColumn("_pid", F.spark_partition_id()) \
        .withColumn("_mid", F.monotonically_increasing_id())
    ordered = ordered.checkpoint(eager=True)
    counts = ordered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    offsets = counts.select(
        "_pid", "_first",
        (F.sum("_n").over(_all_before()) - F.col("_n")).alias("_offset"))
    # offsets has one row per partition of ``ordered``: its size is bounded by the partition count
    return (ordered.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_offset") + (F.col("_mid") - F.col("_first")) + 1)
            .drop("_pid", "_mid", "_first", "_offset"))


def _all_before():
    # one row per partition of the sorted frame, so an unpartitioned window is bounded
    return Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def with_page_numbers(df: DataFrame, size: int, order_by: list) -> DataFrame:
    """C2 in bulk: page number of every row (``ceil(row_nr / size)``)."""
    return (with_row_numbers(df, order_by, "_rn")
            .withColumn("page", F.ceil(F.col("_rn") / F.lit(size)).cast("int")).drop("_rn"))


def search(df: DataFrame, text: str | None, column: str = "name") -> DataFrame:
    """C4: case-insensitive substring search; empty search keeps everything."""
    return df.filter(search_match(F.col(column), text))


def filtered_list(df: DataFrame, filters: dict | None = None, text: str | None = None,
                  column: str = "name") -> DataFrame:
    """Optional extra equality filters, only the truthy ones apply, plus search."""
    out = search(df, text, column)
    for key, value in (filters or {}).items():
        if value:
            out = out.filter(F.col(key) == F.lit(value))
    return out


def solution_datasets(resources: DataFrame, datasets: DataFrame, solution_id: str) -> DataFrame:
    """Every dataset of a solution with its details, one join instead of one call per id."""
    ids = resources.filter((F.col("container_id") == solution_id) & (F.col("resource_type") == "dataset"))
    return datasets.join(ids.select("id"), "id", "left_semi").select(*datasets.columns)


def lookup(entities: DataFrame, requests: DataFrame, key: str = "id") -> DataFrame:
    """Requests left-joined with the entity table; ``found`` marks the misses."""
    ents = entities.withColumn("found", F.lit(True))
    return requests.join(ents, key, "left").withColumn("found", F.coalesce(F.col("found"), F.lit(False)))


# -- C7 over all entity types -----------------------------------------------------------------------

ENTITY_KEY = ["entity_type", "key"]


def entity_index(entities: DataFrame, table: str, path: str, buckets: int = 200) -> DataFrame:
    """The catalog's entities (entity_type, key, and what a lookup returns), stored bucketed and sorted by their key.

    Insights by id and by slug, reports, views, solutions, tags and groups are rows of one table, told apart
    by ``entity_type``. ``table`` is an external table over ``path`` (a shared folder); a later session can
    read it again by that name if its catalog is kept. Take about one bucket per 200 MB of catalog.
    """
    spark = entities.sparkSession
    (entities.write.format("parquet").bucketBy(buckets, *ENTITY_KEY).sortBy(*ENTITY_KEY)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def lookup_entities(index: DataFrame, requests: DataFrame) -> DataFrame:
    """C7 in bulk over all types: each distinct (entity_type, key) request with its entity, if there is one; ``found``
    marks the misses. With an ``entity_index`` only the requests are shuffled; the catalog is read bucket by bucket."""
    wanted = requests.select(*ENTITY_KEY).distinct()
    held = index.withColumn("found", F.lit(True))
    return wanted.join(held, ENTITY_KEY, "left").withColumn("found", F.coalesce("found", F.lit(False)))
