"""Column metadata of datasets (S7): reading it out of dataset documents, and merging updates into the catalog.

A dataset document is JSON; its columns' metadata lie at ``metadata.schema.columns``, an object with one
object per column. Documents are parsed once to VARIANT and read level by level; a level that is
missing, null, or no object reads as ``{}``. The catalog keeps one row per (dataset, column) with the
metadata as a map, so updates are a keyed merge and no document is rewritten for one column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COLUMNS_PATH = "$.metadata.schema.columns"
_KEY = ["dataset_id", "column_id"]


def _object(variant: Column) -> Column:
    """The variant as a map of variants; NULL when it is no object."""
    return F.try_variant_get(variant, "$", "map<string,variant>")


def metadata_columns(documents: DataFrame, document: str = "document") -> DataFrame:
    """S7 read in bulk: ``documents`` with ``columns``, the columns' metadata as a JSON object; ``{}`` where
    the document is no JSON or lacks a level."""
    found = F.try_variant_get(F.try_parse_json(F.col(document)), COLUMNS_PATH, "variant")
    text = F.when(_object(found).isNotNull(), F.to_json(found))
    return documents.withColumn("columns", F.coalesce(text, F.lit("{}")))


def column_rows(documents: DataFrame, key: str = "dataset_id", document: str = "document") -> DataFrame:
    """S7 read as a table: (``key``, column_id, metadata) for every column a document describes. Metadata are a map
    of strings; nested values are JSON text, a null value stays NULL, and a column whose value is no object has an empty map."""
    found = F.try_variant_get(F.try_parse_json(F.col(document)), COLUMNS_PATH, "variant")
    return (documents.select(F.col(key), F.explode(_object(found)).alias("column_id", "_v"))
            .select(key, "column_id", _metadata(F.col("_v")).alias("metadata")))


def _metadata(variant: Column) -> Column:
    return F.coalesce(F.try_variant_get(variant, "$", "map<string,string>"), F.create_map().cast("map<string,string>"))


def merge_column_metadata(catalog: DataFrame, updates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """S7 write in bulk. ``catalog``: dataset_id, column_id, metadata (map of strings) and any other columns;
    ``updates``: dataset_id, optionally ``seq``, and ``columns``, a JSON object {column: {key: value}}.

    An update replaces the metadata of the columns it names; other columns keep theirs. Of several updates of
    one column the latest by ``seq`` counts (without one, or at ties, the greatest JSON text). Returns ``(new catalog,
    rejects)``; rejected are updates that are no JSON object (``bad payload``), columns whose value is no object
    (``bad column``) and columns the catalog does not hold (``absent column``), each with the column it names.

    Each payload is parsed once. Changes are reduced to one per column, with a map-side partial step, before
    the join with the catalog, so a column that a third of all updates name is one row by then.
    """
    seq = F.col("seq") if "seq" in updates.columns else F.lit(0).cast("bigint")
    parsed = updates.select("dataset_id", seq.alias("seq"), _object(F.try_parse_json("columns")).alias("_columns"))
    named = parsed.select("dataset_id", "seq", "_columns", F.explode_outer("_columns").alias("column_id", "_v"))
    rows = named.select("dataset_id", "seq", "column_id", F.to_json("_v").alias("_text"),
                        F.when(F.col("_columns").isNull(), "bad payload")
                        .when(F.col("column_id").isNotNull() & _object(F.col("_v")).isNull(), "bad column").alias("reason"))
    bad = rows.where(F.col("reason").isNotNull()).select("dataset_id", "column_id", "seq", "reason")
    last = (rows.where(F.col("reason").isNull() & F.col("column_id").isNotNull()).groupBy(*_KEY)
            .agg(F.max(F.struct("seq", "_text")).alias("_last"))
            .select(*_KEY, F.col("_last.seq").alias("_seq"), _metadata(F.parse_json("_last._text")).alias("_new")))
    both = catalog.withColumn("_held", F.lit(True)).join(last, _KEY, "full")
    new = both.where("_held").select(*[
        F.coalesce("_new", "metadata").alias("metadata") if c == "metadata" else F.col(c) for c in catalog.columns])
    absent = both.where(F.col("_held").isNull()).select(*_KEY, F.col("_seq").alias("seq"), F.lit("absent column").alias("reason"))
    return new, bad.unionByName(absent)
