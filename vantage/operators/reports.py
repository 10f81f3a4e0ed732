"""Report structures: widget extraction, reference diffs, metadata references, bulk assembly,
table blocks.

Report structures are JSON trees. Widget extraction walks each report's tree inside the task
that reads it (``mapInPandas``), or, with built-ins only, level by level over VARIANT arrays
inside the row. Everything else is joins and grouped aggregation keyed by report.
"""

from __future__ import annotations

import uuid

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.functions import jsonwalk
from vantage.session import scratch_path

# Ship the task-side walker by value: executors then need no installed copy of this package.
cloudpickle.register_pickle_by_value(jsonwalk)

def extract_widgets(spark: SparkSession, reports: DataFrame, id_col: str = "report_id",
                    structure_col: str = "structure", method: str = "map") -> DataFrame:
    """Distinct non-empty ``widgetData.insightId`` of every object whose ``type`` is
    ``"widget"`` and that has a ``widgetData`` key, at any depth, inside objects and arrays.

    ``method="map"`` (default): one ``mapInPandas`` pass; each report's document is walked where it
    lies, Arrow-batched, no shuffle and no iteration, so the cost is one scan whatever the depth.
    Memory per task is one batch of documents. ``report_id`` is the key of the reports table, so
    de-duplication within a report is enough for set semantics.

    ``method="sql"``: the same with built-ins only (``_walk_levels``).
    """
    src = reports.select(F.col(id_col).cast("string").alias("report_id"),
                         F.col(structure_col).alias("structure"))
    if method == "map":
        return src.mapInPandas(jsonwalk.widget_batches, "report_id string, insight_id string")
    if method == "sql":
        return _walk_levels(spark, src)
    raise ValueError(f"unknown method {method!r}")


# what the walk asks of an object; a widget without an object as ``widgetData`` has no insight id
_WIDGET = "struct<type string, widgetData struct<insightId string>>"


def _inside(nodes: Column, kind: str) -> Column:
    """The members of objects and elements of arrays among ``nodes`` that can be read as ``kind``."""
    found = F.flatten(F.filter(F.transform(nodes, lambda v: F.coalesce(
        F.map_values(F.try_variant_get(v, "$", f"map<string,{kind}>")), F.try_variant_get(v, "$", f"array<{kind}>"))),
        lambda x: x.isNotNull()))
    return F.filter(found, lambda x: x.isNotNull())


def _level(frontier: Column) -> tuple[Column, Column]:
    """The insight ids of the widgets among an array of nodes and one level below, and the nodes two levels below.

    Reading a node as a variant copies all below it, so the level between is read as plain maps and arrays.
    """
    objects = _inside(frontier, "map<string,variant>")
    own = F.transform(frontier, lambda v: F.try_variant_get(v, "$", _WIDGET))
    below = F.transform(F.filter(objects, lambda m: F.try_variant_get(m["type"], "$", "string") == "widget"),
                        lambda m: F.try_variant_get(m["widgetData"], "$.insightId", "string"))
    ids = F.concat(F.filter(own, lambda x: x["type"] == "widget")["widgetData"]["insightId"], below)
    return F.filter(ids, lambda x: x != ""), F.flatten(F.concat(F.transform(objects, F.map_values), _inside(frontier, "array<variant>")))


def _walk_levels(spark: SparkSession, src: DataFrame, first: int = 5, most: int = 16) -> DataFrame:
    """Widget ids by a walk inside each row: an array of the nodes of one level, replaced by those two levels below.

    A job takes ``first`` such steps (twice as many in each later one, up to ``most``); only documents that are still
    open then are written to the shared folder and taken further. So a document is parsed once, nothing is
    exploded or shuffled, and a few very deep documents cost further jobs over themselves only.
    """
    empty = F.array().cast("array<string>")
    walk = src.select("report_id", F.array(F.try_parse_json("structure")).alias("nodes"), empty.alias("ids")).where("structure IS NOT NULL")
    out, steps = None, first
    while True:
        for _ in range(steps):
            ids, below = _level(F.col("nodes"))
            walk = walk.select("report_id", below.alias("nodes"), F.concat("ids", ids).alias("ids"))
        walk = walk.select("report_id", F.when(F.size("nodes") > 0, F.col("nodes")).alias("nodes"), F.array_distinct("ids").alias("ids"))
        path = scratch_path(spark, "widgets", uuid.uuid4().hex)
        walk.write.parquet(path)  # unfiltered: a filter would be moved down and repeat the walk at every level
        walk = spark.read.schema(walk.schema).parquet(path)
        done = walk.where("nodes IS NULL").select("report_id", F.explode("ids").alias("insight_id"))
        out = done if out is None else out.unionByName(done)
        walk = walk.where("nodes IS NOT NULL")
        if walk.isEmpty():
            return out
        steps = min(2 * steps, most)


def reference_diff(current: DataFrame, new: DataFrame, updated_reports: DataFrame | None = None) -> DataFrame:
    """Per report, insights to add (in the new structure, not referenced yet) and to remove
    (referenced, no longer in the structure). Only reports whose structure was supplied are
    diffed (``updated_reports``: report ids; default: the reports present in ``new``).

    Both lists are exchanged once, by report, and grouped there. A row with a NULL key meets none of the other list.
    """
    keys = ["report_id", "insight_id"]
    scope = (updated_reports if updated_reports is not None else new).select("report_id").distinct()
    sides = [side.select(*keys, F.lit(n).alias("_new")) for n, side in enumerate((current, new))]
    if updated_reports is not None:
        rows = sides[0].unionByName(sides[1]).join(scope, "report_id", "left_semi")
    else:
        rows = sides[0].join(scope, "report_id", "left_semi").unionByName(sides[1])
    apart = F.when(F.col("report_id").isNull() | F.col("insight_id").isNull(), F.col("_new")).alias("_apart")
    both = rows.groupBy(*keys, apart).agg(F.min("_new").alias("_low"), F.max("_new").alias("_high"))
    action = F.when(F.col("_low") == 1, F.lit("add")).when(F.col("_high") == 0, F.lit("remove"))
    return both.where(F.col("_low") == F.col("_high")).select(*keys, action.alias("action"))


def metadata_references(reports: DataFrame, id_col: str = "report_id", insights_col: str = "insights") -> DataFrame:
    """One (report_id, insight_id) row per insight listed in a report's metadata."""
    return (reports.select(F.col(id_col).alias("report_id"), F.explode(insights_col).alias("insight_id"))
            .distinct())


def apply_reference_diff(references: DataFrame, diff: DataFrame) -> DataFrame:
    """W3 add/remove in bulk: (report_id, insight_id) references after the ``add`` and ``remove``
    rows of a ``reference_diff``. One full outer join, each input computed once; not one call per
    insight."""
    keys = ["report_id", "insight_id"]
    ref = references.select(*keys).distinct().withColumn("_ref", F.lit(True))
    both = ref.join(diff.select(*keys, "action"), keys, "full")
    keep = ((F.col("_ref") & (F.col("action").isNull() | (F.col("action") != "remove")))
            | (F.col("action") == "add"))
    return both.filter(keep).select(*keys)


def assemble(blocks: DataFrame, section_size: int | None = None) -> DataFrame:
    """Blocks (report_id, pos, block JSON, insight_id) → one row per report with its
    ``structure`` (blocks in ``pos`` order under ``editorState``) and ``insights`` (widget insight
    ids, de-duplicated, first-seen order, empty ids left out).

    One report's blocks are gathered into one array, so one report must fit in one task. Blocks
    with equal ``pos`` keep a stable order (by block text). For reports too large for that, pass
    ``section_size``: blocks are then grouped per (report, section of ``section_size`` positions)
    and each row holds that section's ``blocks`` (comma-joined, in order) and its ``insights``.
    Concatenating the sections in ``section`` order gives the ``editorState`` list.
    """
    sorted_blocks = F.sort_array(F.collect_list(F.struct("pos", "block", "insight_id")))
    keys = ["report_id"]
    if section_size:
        blocks = blocks.withColumn("section", F.floor((F.col("pos") - 1) / F.lit(section_size)).cast("int"))
        keys.append("section")
    per = blocks.groupBy(*keys).agg(sorted_blocks.alias("_b"))
    ids = F.array_distinct(F.filter(F.col("_b.insight_id"), lambda x: x.isNotNull() & (x != F.lit(""))))
    joined = F.array_join(F.col("_b.block"), ", ")
    if section_size:
        return per.select(*keys, joined.alias("blocks"), ids.alias("insights"))
    return per.select(
        "report_id",
        F.concat(F.lit('{"editorState": ['), joined, F.lit("]}")).alias("structure"),
        ids.alias("insights"),
    )


def table_blocks(rows: DataFrame, has_header: bool = True) -> DataFrame:
    """Rows (table_id, row_nr, cells array<string>) → one table block JSON per table. The first
    row in ``row_nr`` order is the header (``th`` cells) when ``has_header``. One grouped
    aggregation; a table's rows are gathered into one array (bounded by one table's size)."""
    per = rows.groupBy("table_id").agg(F.sort_array(F.collect_list(F.struct("row_nr", "cells"))).alias("_rows"))

    return per.select(
        "table_id",
        F.to_json(F.struct(F.lit("table").alias("type"),
                           F.concat(F.lit("t"), F.col("table_id").cast("string")).alias("id"),
                           _table_rows(F.col("_rows"), F.lit(has_header)).alias("children"))).alias("block"))


def assemble_sections(blocks: DataFrame, section_size: int = 1000) -> DataFrame:
    """W4 for reports of any size: one row per (report, section of ``section_size`` positions) with the
    section's ``blocks`` (comma-joined, in order) and ``insights``, the widget insight ids that the report
    shows in this section for the first time, in order. Concatenated in ``section`` order, the blocks are the
    ``editorState`` list and the insights the report's list.

    No task holds more than a section, if positions are unique in a report: the place where an
    insight is first seen is a grouped minimum with a map-side partial step.
    """
    keys = ["report_id", "section"]
    section = F.floor((F.col("pos") - 1) / F.lit(section_size)).cast("int").alias("section")
    texts = (blocks.select("report_id", section, F.struct("pos", "block", "insight_id").alias("_b")).groupBy(*keys)
             .agg(F.array_join(F.sort_array(F.collect_list("_b"))["block"], ", ").alias("blocks")))
    firsts = (blocks.where(F.col("insight_id") != "").groupBy("report_id", "insight_id")
              .agg(F.min(F.struct("pos", "block", "insight_id")).alias("_at"), F.min("pos").alias("pos"))
              .groupBy("report_id", section).agg(F.sort_array(F.collect_list("_at"))["insight_id"].alias("insights")))
    return texts.join(firsts, keys, "left").select(
        *keys, "blocks", F.coalesce("insights", F.array().cast("array<string>")).alias("insights"))


def _table_rows(rows: Column, header: Column) -> Column:
    """``tr`` structs of an array of rows; ``header``: the first of them has ``th`` cells."""
    def tr(row, i):
        kind = F.when(header & (i == 0), F.lit("th")).otherwise(F.lit("td"))
        return F.struct(F.lit("tr").alias("type"),
                        F.transform(row["cells"], lambda c: F.struct(kind.alias("type"),
                                                                     F.array(F.struct(c.alias("text"))).alias("children")))
                        .alias("children"))

    return F.transform(rows, tr)


def table_sections(rows: DataFrame, has_header: bool = True, section_size: int = 1000) -> DataFrame:
    """W5 for tables of any size: one row per (table, section of ``section_size`` row numbers) with ``rows``, the
    section's table rows as comma-joined JSON. ``table_blocks`` gives the same rows as one block.

    The header row is the table's smallest row number, known from a grouped minimum; it is joined with
    sections, not with rows.
    """
    section = F.floor((F.col("row_nr") - 1) / F.lit(section_size)).cast("int").alias("section")
    per = (rows.select("table_id", section, F.struct("row_nr", "cells").alias("_r")).groupBy("table_id", "section")
           .agg(F.sort_array(F.collect_list("_r")).alias("_rows")))
    first = rows.groupBy("table_id").agg(F.min(section).alias("_first"))
    children = F.to_json(_table_rows(F.col("_rows"), F.lit(has_header) & (F.col("section") == F.col("_first"))))
    return per.join(first, "table_id").select("table_id", "section", children.alias("_json")).select(
        "table_id", "section", F.expr("substring(_json, 2, char_length(_json) - 2)").alias("rows"))
