"""The eighteen filter operators as Column predicates.

SQL three-valued logic throughout: a NULL column value drops the row for every operator except
``is_null`` and ``is_null_or_empty``. String-pattern operators compare the column's string form and
are case-sensitive; ``like`` uses ``\\`` as escape. All predicates are built-in expressions, so
they stay inside whole-stage codegen and comparisons against literals reach the Parquet scan.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from vantage.plans.spec import FILTER_OPERATORS, UNARY_OPERATORS, SpecError


def _check_value(operator: str, value: Any) -> None:
    if operator in UNARY_OPERATORS:
        return
    if value is None:
        raise SpecError(f"operator {operator!r} needs a value")
    if isinstance(value, (list, tuple, set, dict)):
        raise SpecError(f"operator {operator!r} takes a scalar value, got {type(value).__name__}")


def predicate(col: Column, operator: str, value: Any = None, dtype: DataType | None = None) -> Column:
    """Predicate for one filter entry. ``dtype`` is the column's type (needed for the emptiness tests)."""
    if operator not in FILTER_OPERATORS:
        raise SpecError(f"invalid operator {operator!r}; valid operators are {FILTER_OPERATORS}")
    _check_value(operator, value)
    text = col.cast("string")
    is_string = isinstance(dtype, StringType) if dtype is not None else False
    if operator == "equals":
        return col == F.lit(value)
    if operator == "not_equals":
        return col != F.lit(value)
    if operator == "like":
        return text.like(str(value))
    if operator == "not_like":
        return ~text.like(str(value))
    if operator == "starts_with":
        return text.startswith(F.lit(str(value)))
    if operator == "ends_with":
        return text.endswith(F.lit(str(value)))
    if operator == "contains":
        return text.contains(F.lit(str(value)))
    if operator == "not_contains":
        return ~text.contains(F.lit(str(value)))
    if operator == "is_null":
        return col.isNull()
    if operator == "is_not_null":
        return col.isNotNull()
    if operator == "greater_than":
        return col > F.lit(value)
    if operator == "less_than":
        return col < F.lit(value)
    if operator == "greater_or_equals":
        return col >= F.lit(value)
    if operator == "less_or_equals":
        return col <= F.lit(value)
    if operator == "is_null_or_empty":
        return (col.isNull() | (col == F.lit(""))) if is_string else col.isNull()
    if operator == "is_not_null_or_empty":
        return (col.isNotNull() & (col != F.lit(""))) if is_string else col.isNotNull()
    if operator == "is_true":
        return col == F.lit(True)
    # is_false
    return col == F.lit(False)


def conjunction(predicates: list[Column]) -> Column | None:
    """The flat ``where`` list is an AND of its entries."""
    return reduce(lambda a, b: a & b, predicates) if predicates else None
