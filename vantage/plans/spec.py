"""Insight specification: normalization of version 3 and version 4 documents, and validation.

A spec arrives either as a whole insight document (``{"query": {...}, "config": ...}``) or as the
query part alone. Both versions are brought to one canonical shape before planning; missing keys
take the version 4 defaults (no pivot, no variables).
"""

from __future__ import annotations

import copy
from dataclasses import dataclass
from typing import Any

# The names the spec format accepts.
FILTER_OPERATORS = (
    "equals", "not_equals", "like", "not_like", "starts_with", "ends_with", "contains",
    "not_contains", "is_null", "is_not_null", "greater_than", "less_than", "greater_or_equals",
    "less_or_equals", "is_null_or_empty", "is_not_null_or_empty", "is_true", "is_false",
)
MODES = ("queryBuilder", "sqlEditor")

# Operators that take no value.
UNARY_OPERATORS = frozenset({
    "is_null", "is_not_null", "is_null_or_empty", "is_not_null_or_empty", "is_true", "is_false",
})

# Aggregate names accepted in select, filter and order entries (semantics decided here).
AGGREGATES = ("sum", "count", "count_distinct", "avg", "min", "max")
_AGGREGATE_ALIASES = {"mean": "avg", "countDistinct": "count_distinct", "distinct_count": "count_distinct"}

JOIN_TYPES = {
    "inner": "inner", "left": "left", "left_outer": "left", "right": "right",
    "right_outer": "right", "full": "full", "full_outer": "full", "outer": "full",
    "semi": "left_semi", "left_semi": "left_semi", "anti": "left_anti", "left_anti": "left_anti",
    "cross": "cross",
}
DIRECTIONS = ("asc", "desc")


class SpecError(ValueError):
    """An insight spec that cannot be planned."""


@dataclass(frozen=True)
class ColumnRef:
    dataset_id: str
    column_id: str
    aggregate: str | None = None

    @property
    def key(self) -> tuple:
        return (self.dataset_id, self.column_id, self.aggregate)


def canonical_aggregate(name: str | None) -> str | None:
    if name is None or name == "":
        return None
    name = _AGGREGATE_ALIASES.get(name, name)
    if name not in AGGREGATES:
        raise SpecError(f"unknown aggregate {name!r}; expected one of {AGGREGATES}")
    return name


def _default_dataset(datasets: list[dict]) -> str:
    return datasets[0]["datasetId"] if datasets else ""


def column_ref(entry: dict, datasets: list[dict], aggregate: Any = None) -> ColumnRef:
    ds = entry.get("datasetId") or _default_dataset(datasets)
    if not ds:
        raise SpecError(f"column {entry.get('columnId')!r} has no dataset and the spec lists none")
    col = entry.get("columnId")
    if not col:
        raise SpecError("column reference without columnId")
    agg = entry.get("aggregate") if aggregate is None else aggregate
    return ColumnRef(ds, col, canonical_aggregate(agg))


def normalize(spec: dict) -> dict:
    """Return a deep-copied canonical query dict (version 4 shape) from a v3/v4 insight or query."""
    if not isinstance(spec, dict):
        raise SpecError("spec must be a dict")
    query = spec.get("query", spec)
    query = copy.deepcopy(query)
    mode = query.get("mode", "queryBuilder")
    if mode not in MODES:
        raise SpecError(f"invalid mode {mode!r}; valid modes are {MODES}")
    sql_editor = query.get("sqlEditor") or {}
    qb = query.get("queryBuilder") or {}
    pivot = qb.get("pivot") or {}
    return {
        "version": query.get("version", 4),
        "mode": mode,
        "sqlEditor": {
            "sqlString": sql_editor.get("sqlString", ""),
            "variables": list(sql_editor.get("variables") or []),
        },
        "queryBuilder": {
            "datasets": [
                {"datasetId": d["datasetId"],
                 "join": d.get("join") or {"type": "inner", "on": []}}
                for d in qb.get("datasets") or []
            ],
            "select": list(qb.get("select") or []),
            "where": list(qb.get("where") or []),
            "orderBy": list(qb.get("orderBy") or []),
            "pivot": {
                "enabled": bool(pivot.get("enabled", False)),
                "columns": list(pivot.get("columns") or []),
                "rows": list(pivot.get("rows") or []),
                "values": list(pivot.get("values") or []),
            },
            "limit": qb.get("limit"),
        },
    }


def validate_limit(limit: Any) -> int | None:
    if limit is None:
        return None
    if isinstance(limit, bool) or not isinstance(limit, int):
        raise SpecError(f"limit must be an integer, got {limit!r}")
    if limit < 0:
        raise SpecError("limit must be a non-negative integer")
    return limit
