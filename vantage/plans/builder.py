"""Fluent construction of insight spec documents (version 4, and the older version 3 shape).

The builder only produces the dict; ``vantage.plans.insight.run_insight`` turns it into a DataFrame.
Method names follow the public spec-building API so existing callers can switch.
"""

from __future__ import annotations

import uuid
from typing import Any

from vantage.plans.spec import FILTER_OPERATORS, MODES, SpecError


def _new_id() -> str:
    return str(uuid.uuid4())


class InsightBuilder:
    def __init__(self, version: int = 4):
        if version not in (3, 4):
            raise SpecError("version must be 3 or 4")
        self._version = version
        self._meta = {"solution_id": "", "name": "", "description": "", "slug": ""}
        self._mode = "queryBuilder"
        self._sql = ""
        self._variables: list[dict] = []
        self._datasets: list[dict] = []
        self._select: list[dict] = []
        self._where: list[dict] = []
        self._order: list[dict] = []
        self._pivot = {"enabled": False, "columns": [], "rows": [], "values": []}
        self._limit: int | None = None
        self._config: dict | None = None

    # -- metadata ---------------------------------------------------------------------------
    def set_solution_id(self, solution_id: str):
        self._meta["solution_id"] = solution_id
        return self

    def set_name(self, name: str):
        self._meta["name"] = name
        return self

    def set_slug(self, slug: str):
        self._meta["slug"] = slug
        return self

    def set_description(self, description: str):
        self._meta["description"] = description
        return self

    def set_config(self, config: dict):
        self._config = config
        return self

    def set_mode(self, mode: str):
        if mode not in MODES:
            raise SpecError(f"invalid mode {mode!r}; valid modes are {MODES}")
        self._mode = mode
        return self

    # -- query builder ----------------------------------------------------------------------
    def _first_dataset(self) -> str:
        return self._datasets[0]["datasetId"] if self._datasets else ""

    def add_dataset(self, dataset_id: str, join_type: str = "inner", join_on: list | None = None,
                    allow_product: bool = False):
        join = {"type": join_type, "on": list(join_on or [])}
        if allow_product:  # a cross join is planned only with it
            join["allowProduct"] = True
        self._datasets.append({"datasetId": dataset_id, "join": join})
        return self

    def add_select(self, column_id: str, dataset_id: str | None = None, aggregate: str | None = None,
                   label: str | None = None, id: str | None = None):
        self._select.append({
            "id": id or _new_id(), "datasetId": dataset_id or self._first_dataset(),
            "columnId": column_id, "aggregate": aggregate, "label": label or column_id,
        })
        return self

    def add_filter(self, column_id: str, operator: str, value: Any = None, dataset_id: str | None = None):
        if operator not in FILTER_OPERATORS:
            raise SpecError(f"invalid operator {operator!r}")
        self._where.append({
            "id": _new_id(),
            "column": {"datasetId": dataset_id or self._first_dataset(), "columnId": column_id, "aggregate": None},
            "operator": operator, "value": value,
        })
        return self

    def add_order_by(self, column_id: str, dataset_id: str | None = None, aggregate: str | None = None,
                     direction: str = "asc"):
        self._order.append({
            "id": _new_id(),
            "column": {"datasetId": dataset_id or self._first_dataset(), "columnId": column_id,
                       "aggregate": aggregate},
            "direction": direction,
        })
        return self

    def set_limit(self, limit: int):
        if limit < 0:
            raise SpecError("limit must be a non-negative integer")
        self._limit = limit
        return self

    def add_select_defs(self, selects: list[dict]):
        self._select.extend(selects)
        return self

    def add_filter_defs(self, filters: list[dict]):
        self._where.extend(filters)
        return self

    def set_pivot(self, rows: list, columns: list, values: list, enabled: bool = True):
        if self._version == 3:
            raise SpecError("version 3 specs have no pivot")
        self._pivot = {"enabled": enabled, "columns": list(columns), "rows": list(rows), "values": list(values)}
        return self

    # -- SQL editor -------------------------------------------------------------------------
    def set_sql(self, sql: str):
        self._sql = sql
        return self

    def add_sql_variable(self, id: str, name: str, label: str, type: str = "text",
                         input_option: str = "dropdown", dropdown_option: str = "single",
                         available_values_source: str = "custom", custom_values: str = "",
                         default_value: str | None = None, always_required: bool = True):
        if self._version == 3:
            raise SpecError("version 3 specs have no SQL variables")
        self._variables.append({
            "id": id, "name": name, "label": label, "type": type, "inputOption": input_option,
            "dropdownOption": dropdown_option, "availableValuesSource": available_values_source,
            "customValues": custom_values, "defaultValue": default_value, "alwaysRequired": always_required,
        })
        return self

    # -- output -----------------------------------------------------------------------------
    def build(self) -> dict:
        qb = {
            "version": 3 if self._version == 4 else 2,
            "datasets": [dict(d) for d in self._datasets],
            "select": [dict(s) for s in self._select],
            "where": [dict(w) for w in self._where],
            "orderBy": [dict(o) for o in self._order],
            "limit": self._limit,
        }
        if self._version == 4:
            qb["pivot"] = dict(self._pivot)
            sql_editor = {"sqlString": self._sql, "variables": [dict(v) for v in self._variables]}
        else:
            sql_editor = {"sqlString": self._sql}
        return {
            **self._meta,
            "query": {"version": self._version, "mode": self._mode, "sqlEditor": sql_editor, "queryBuilder": qb},
            "config": self._config,
        }


def join_on(left_dataset: str, left_column: str, right_dataset: str, right_column: str) -> dict:
    """One equality condition of a join entry, in the shape the planner reads."""
    return {"left": {"datasetId": left_dataset, "columnId": left_column},
            "right": {"datasetId": right_dataset, "columnId": right_column}}


def select_def(column_id: str, dataset_id: str, aggregate: str | None = None, label: str | None = None,
               id: str | None = None) -> dict:
    return {"id": id or _new_id(), "datasetId": dataset_id, "columnId": column_id,
            "aggregate": aggregate, "label": label or column_id}


def where_def(column_id: str, dataset_id: str, operator: str, value: Any = None,
              aggregate: str | None = None) -> dict:
    """A filter entry; with ``aggregate`` set it filters after aggregation (HAVING)."""
    return {"id": _new_id(), "column": {"datasetId": dataset_id, "columnId": column_id, "aggregate": aggregate},
            "operator": operator, "value": value}
