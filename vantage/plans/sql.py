"""SQL over listed datasets: placeholders, positional and named parameters, SQL variables.

The SQL text is Spark SQL and is handed to ``spark.sql`` as it stands, apart from one rewrite: a
quoted dataset placeholder ``'{{id}}'`` becomes the back-quoted name of a temp view bound to that
dataset for this call. Views are dropped again as soon as ``spark.sql`` has analysed the text;
the returned DataFrame keeps the resolved plan. Parameters go through Spark's own parameter
binding (``?`` for positional, ``:name`` for named), never through string formatting.
"""

from __future__ import annotations

import datetime
import re
import uuid
from typing import Any, Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from vantage.plans.spec import SpecError
from vantage.sources.versions import replace_folder

# Fixed value: a dataset placeholder is an id in double braces inside single quotes.
PLACEHOLDER = re.compile(r"'\{\{([^}]+)\}\}'")

Resolver = Callable[[str], DataFrame]


def placeholder_ids(sql: str) -> list[str]:
    seen: list[str] = []
    for m in PLACEHOLDER.finditer(sql):
        if m.group(1) not in seen:
            seen.append(m.group(1))
    return seen


def _view_name(dataset_id: str, token: str) -> str:
    safe = re.sub(r"[^0-9A-Za-z_]", "_", dataset_id)
    return f"vantage_{safe}_{token}"


def execute_sql(spark: SparkSession, sql: str, datasets: Iterable[str] | dict[str, DataFrame],
                resolve: Resolver | None = None, args: list | None = None,
                named_args: dict | None = None) -> DataFrame:
    """Run ``sql`` with the listed datasets bound to its placeholders.

    ``datasets`` is either a mapping id → DataFrame, or a list of ids resolved through ``resolve``.
    Placeholders naming an unlisted id are an error. Positional and named arguments cannot be
    mixed (Spark rejects the mix).
    """
    if args and named_args:
        raise SpecError("use either positional or named arguments, not both")
    if isinstance(datasets, dict):
        frames = dict(datasets)
    else:
        ids = list(datasets)
        if resolve is None and ids:
            raise SpecError("dataset ids given without a resolver")
        frames = {i: resolve(i) for i in ids}
    wanted = placeholder_ids(sql)
    missing = [i for i in wanted if i not in frames]
    if missing:
        raise SpecError(f"SQL refers to datasets that are not listed: {missing}")
    token = uuid.uuid4().hex[:12]
    views = {i: _view_name(i, token) for i in wanted}
    text = PLACEHOLDER.sub(lambda m: f"`{views[m.group(1)]}`", sql)
    for i, name in views.items():
        frames[i].createOrReplaceTempView(name)
    try:
        if args:
            return spark.sql(text, args=list(args))
        if named_args:
            return spark.sql(text, args=dict(named_args))
        return spark.sql(text)
    finally:
        for name in views.values():
            spark.catalog.dropTempView(name)


def export_query(dataset_id: str) -> str:
    """Default export query of a dataset: the whole table, FROM-first."""
    return "FROM '{{" + dataset_id + "}}'"


def export(spark: SparkSession, dataset_id: str, out_path: str, resolve: Resolver, sql: str | None = None,
           datasets: Iterable[str] | None = None, args: list | None = None,
           named_args: dict | None = None) -> str:
    """Run ``sql`` (default: the whole dataset) over the listed datasets and write the result
    as Parquet to ``out_path``, replacing what was there once it is complete. The result is written by
    the executors; nothing is gathered on the driver. Returns the path."""
    text = sql or export_query(dataset_id)
    ids = list(datasets) if datasets is not None else [dataset_id]
    replace_folder(execute_sql(spark, text, ids, resolve=resolve, args=args, named_args=named_args), out_path)
    return out_path


# -- SQL variables ------------------------------------------------------------------------------

def _custom_values(variable: dict) -> list[str]:
    raw = variable.get("customValues") or ""
    if isinstance(raw, list):
        return [str(v) for v in raw]
    return [v.strip() for v in str(raw).split(",") if v.strip() != ""]


def _typed(value: Any, vtype: str):
    if value is None:
        return None
    if vtype == "date":
        if isinstance(value, datetime.date):
            return value
        try:
            return datetime.date.fromisoformat(str(value).strip()[:10])
        except ValueError as exc:
            raise SpecError(f"not a date: {value!r}") from exc
    if vtype == "number":
        if isinstance(value, (int, float)) and not isinstance(value, bool):
            return value
        text = str(value).strip()
        try:
            return int(text)
        except ValueError:
            return float(text)
    return value if vtype not in ("text", "string") else str(value)


def bind_variables(variables: list[dict], values: dict | None) -> dict[str, Any]:
    """Values for the named parameters of an sqlEditor insight.

    Supplied value, else the default. A required variable with neither is an error. A variable
    whose values come from a ``custom`` list only accepts members of that list (comma separated).
    ``multiple`` dropdowns take a list and are bound as an array.
    """
    values = dict(values or {})
    bound: dict[str, Any] = {}
    for var in variables:
        name = var["name"]
        supplied = values.pop(name, None)
        if supplied is None:
            supplied = var.get("defaultValue")
        if supplied is None or supplied == "":
            if var.get("alwaysRequired", True):
                raise SpecError(f"SQL variable {name!r} is required and has no value")
            bound[name] = None
            continue
        vtype = var.get("type", "text")
        multiple = var.get("dropdownOption") == "multiple"
        items = list(supplied) if multiple and isinstance(supplied, (list, tuple)) else [supplied]
        if var.get("availableValuesSource", "custom") == "custom" and var.get("inputOption", "dropdown") == "dropdown":
            allowed = _custom_values(var)
            bad = [v for v in items if str(v) not in allowed]
            if allowed and bad:
                raise SpecError(f"value {bad[0]!r} is not one of the values of {name!r}: {allowed}")
        typed = [_typed(v, vtype) for v in items]
        bound[name] = typed if multiple else typed[0]
    if values:
        raise SpecError(f"values for unknown SQL variables: {sorted(values)}")
    return bound


def run_sql_editor(sql_editor: dict, resolve: Resolver, values: dict | None = None,
                   spark: SparkSession | None = None) -> DataFrame:
    """sqlEditor mode: placeholders resolved by id, variables bound as named parameters."""
    sql = sql_editor.get("sqlString") or ""
    if not sql.strip():
        raise SpecError("sqlEditor mode without SQL text")
    ids = placeholder_ids(sql)
    frames = {i: resolve(i) for i in ids}
    if spark is None:
        if not frames:
            raise SpecError("no session: pass spark= when the SQL names no dataset")
        spark = next(iter(frames.values())).sparkSession
    named = bind_variables(sql_editor.get("variables") or [], values)
    return execute_sql(spark, sql, frames, named_args=named or None)
