"""Left-deep join chain of spec datasets.

Each dataset is aliased by its id so that ``dataset.column`` references resolve after joins. The
physical strategy (broadcast hash, shuffled hash, sort-merge) is left to Catalyst and AQE: a side
is broadcast only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``, which
is a checked bound, and equi-joins otherwise shuffle on their keys. A cross join emits every pair,
so it needs ``"allowProduct": true`` in its join entry, whatever the sizes.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.plans.spec import JOIN_TYPES, SpecError


def qualified(dataset_id: str, column_id: str) -> Column:
    return F.col(f"`{dataset_id}`.`{column_id}`")


def _condition(entry: dict, right_id: str, seen: set[str]) -> Column:
    try:
        left, right = entry["left"], entry["right"]
        lds, lcol = left["datasetId"], left["columnId"]
        rds, rcol = right["datasetId"], right["columnId"]
    except (KeyError, TypeError) as exc:
        raise SpecError(f"join condition must be {{left: {{datasetId, columnId}}, right: {{...}}}}: {entry!r}") from exc
    for ds in (lds, rds):
        if ds not in seen and ds != right_id:
            raise SpecError(f"join condition references dataset {ds!r} that is not joined yet")
    return qualified(lds, lcol) == qualified(rds, rcol)


def join_chain(datasets: list[dict], resolve: Callable[[str], DataFrame]) -> tuple[DataFrame, list[str]]:
    """Join datasets left to right in list order; the first dataset's join entry is ignored.

    Returns the joined frame and the dataset ids whose columns are still visible (semi and anti
    joins hide the right side).
    """
    if not datasets:
        raise SpecError("spec lists no dataset")
    ids = [d["datasetId"] for d in datasets]
    if len(set(ids)) != len(ids):
        raise SpecError("a dataset may appear once; write self-joins as SQL")
    first = ids[0]
    df = resolve(first).alias(first)
    seen = {first}
    visible = [first]
    for d in datasets[1:]:
        ds = d["datasetId"]
        join = d.get("join") or {}
        how_raw = join.get("type", "inner")
        how = JOIN_TYPES.get(how_raw)
        if how is None:
            raise SpecError(f"unknown join type {how_raw!r}")
        right = resolve(ds).alias(ds)
        on = join.get("on") or []
        if how == "cross":
            if on:
                raise SpecError("a cross join takes no conditions")
            if join.get("allowProduct") is not True:
                raise SpecError(f"cross join with {ds!r} emits every pair; its join entry must say allowProduct: true")
            df = df.crossJoin(right)
        else:
            if not on:
                raise SpecError(f"join of {ds!r} has no condition; use type 'cross' for a product")
            cond = None
            for entry in on:
                c = _condition(entry, ds, seen)
                cond = c if cond is None else cond & c
            df = df.join(right, cond, how)
        seen.add(ds)
        if how not in ("left_semi", "left_anti"):
            visible.append(ds)
    return df, visible
