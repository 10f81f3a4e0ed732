"""Tags and role assignments as set operations.

Assign is ``left_anti`` on the pair + ``union``; unassign is ``left_anti``; a batch of role changes
keeps the last change per (resource, principal) with a grouped ``max(struct(seq, …))``, which
aggregates partially before the shuffle, so a hot resource is no problem.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAIR = ["resource_id", "principal_id"]


def pairs_assign(pairs: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Add many-to-many rows that are not there yet (no duplicates)."""
    fresh = new.select(*keys).distinct().join(pairs.select(*keys), keys, "left_anti")
    return pairs.select(*keys).unionByName(fresh)


def pairs_unassign(pairs: DataFrame, remove: DataFrame, keys: list[str]) -> DataFrame:
    """Remove many-to-many rows."""
    return pairs.join(remove.select(*keys), keys, "left_anti").select(*pairs.columns)


def tag_assign(resource_tags: DataFrame, assign: DataFrame) -> DataFrame:
    """T1 assign: rows (tag_id, resource_id)."""
    return pairs_assign(resource_tags, assign, ["tag_id", "resource_id"])


def tag_unassign(resource_tags: DataFrame, remove: DataFrame) -> DataFrame:
    """T1 unassign."""
    return pairs_unassign(resource_tags, remove, ["tag_id", "resource_id"])


def resources_by_tags(resources: DataFrame, resource_tags: DataFrame, tag_ids: list[str]) -> DataFrame:
    """Resources carrying any of the tags."""
    tagged = resource_tags.filter(F.col("tag_id").isin(*tag_ids)).select(F.col("resource_id").alias("id"))
    return resources.join(tagged, "id", "left_semi").select(*resources.columns)


def role_assign(assignments: DataFrame, new: DataFrame) -> DataFrame:
    """Add or replace: an assignment on an existing (resource, principal) replaces its role.
    Inside the batch the last row by ``seq`` wins when a seq column is present; without one, a pair
    with different roles is an error when the plan runs."""
    if "seq" in new.columns:
        new = (new.groupBy(*PAIR).agg(F.max(F.struct("seq", "role")).alias("_l"))
               .select(*PAIR, F.col("_l.role").alias("role")))
    else:  # no order given: nothing says which of several roles is meant
        new = new.groupBy(*PAIR).agg(F.min("role").alias("role"), F.max("role").alias("_other")).select(
            *PAIR, F.when(F.col("role").eqNullSafe(F.col("_other")), F.col("role")).otherwise(
                F.raise_error(F.lit("a principal has several roles and there is no seq column"))).alias("role"))
    return assignments.join(new.select(*PAIR), PAIR, "left_anti").unionByName(new.select(*PAIR, "role"))


def role_unassign(assignments: DataFrame, remove: DataFrame) -> DataFrame:
    """R2: remove (resource, principal) pairs; with only a principal column, every role of it."""
    keys = [c for c in PAIR if c in remove.columns]
    return assignments.join(remove.select(*keys).distinct(), keys, "left_anti").select(*assignments.columns)


def role_delta(assignments: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply many assign/unassign changes at once; the last per pair wins. At equal ``seq`` an
    assign beats an unassign (unassign first, then assign)."""
    rank = F.when(F.col("op") == "assign", 1).otherwise(0)
    last = (changes.groupBy(*PAIR)
            .agg(F.max(F.struct(F.col("seq"), rank.alias("r"), F.col("op"), F.col("role"))).alias("_l"))
            .select(*PAIR, F.col("_l.op").alias("op"), F.col("_l.role").alias("role")))
    kept = assignments.join(last.select(*PAIR), PAIR, "left_anti")
    return kept.unionByName(last.filter(F.col("op") == "assign").select(*PAIR, "role"))


def resource_principals(assignments: DataFrame, resource_id: str | None = None,
                        filters: dict | None = None) -> DataFrame:
    """Principals of a resource (or of all resources), with optional equality filters."""
    out = assignments if resource_id is None else assignments.filter(F.col("resource_id") == resource_id)
    for k, v in (filters or {}).items():
        if v:
            out = out.filter(F.col(k) == F.lit(v))
    return out
