"""Aggregate functions named in specs, and pivot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.plans.spec import SpecError, canonical_aggregate


def aggregate_expr(name: str, col: Column | None) -> Column:
    """Built-in aggregate for a spec aggregate name. ``col`` None means ``*`` (count only)."""
    name = canonical_aggregate(name)
    if col is None:
        if name != "count":
            raise SpecError(f"aggregate {name!r} needs a column")
        return F.count(F.lit(1))
    if name == "sum":
        return F.sum(col)
    if name == "count":
        return F.count(col)
    if name == "count_distinct":
        return F.count_distinct(col)
    if name == "avg":
        return F.avg(col)
    if name == "min":
        return F.min(col)
    return F.max(col)


def pivot_frame(df: DataFrame, rows: list[str], pivot_column: str, measures: list[tuple[str, Column]],
                pivot_values: list | None = None) -> DataFrame:
    """``groupBy(rows).pivot(column, values).agg(measures)``.

    With ``pivot_values`` given the output columns are fixed and no extra job is needed to find
    the distinct pivot values; without them Spark runs one distinct aggregation on the (pruned)
    pivot column first. Output names: bare pivot value for a single measure, ``<value>_<alias>``
    for several (Spark's naming).
    """
    if not measures:
        raise SpecError("pivot needs at least one aggregated value")
    grouped = df.groupBy(*rows)
    grouped = grouped.pivot(pivot_column, pivot_values) if pivot_values is not None else grouped.pivot(pivot_column)
    return grouped.agg(*[expr.alias(alias) for alias, expr in measures])
