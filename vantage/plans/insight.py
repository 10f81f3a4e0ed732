"""Insight spec (queryBuilder mode) → one lazy DataFrame.

Plan shape: alias every dataset → left-deep join chain → WHERE (flat AND) → implicit GROUP BY
(non-aggregated selects are the keys when anything is aggregated) → HAVING on aggregates, hidden
when not selected → pivot → ORDER BY (NULLs last) → LIMIT → projection of the labels.

Everything is expressed with DataFrame operators, so Catalyst pushes the WHERE conjuncts into the
Parquet scans, prunes unused columns, plans partial/final hash aggregation, and turns
ORDER BY + LIMIT into a top-k (TakeOrderedAndProject). The plan's shape depends on the spec alone,
not on the size of its datasets.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.operators.aggregates import aggregate_expr, pivot_frame
from vantage.operators.filters import conjunction, predicate
from vantage.operators.joins import join_chain, qualified
from vantage.plans.spec import DIRECTIONS, ColumnRef, SpecError, column_ref, normalize, validate_limit

Resolver = Callable[[str], DataFrame]


def _order_column(col: Column, direction: str) -> Column:
    direction = (direction or "asc").lower()
    if direction not in DIRECTIONS:
        raise SpecError(f"unknown order direction {direction!r}")
    return col.asc_nulls_last() if direction == "asc" else col.desc_nulls_last()


def _source_col(ref: ColumnRef, visible: list[str]) -> Column | None:
    """Column for a reference; ``None`` for ``*`` (only valid under count)."""
    if ref.dataset_id not in visible:
        raise SpecError(f"dataset {ref.dataset_id!r} is not visible here (not listed, or semi/anti joined)")
    if ref.column_id == "*":
        return None
    return qualified(ref.dataset_id, ref.column_id)


def _value_expr(ref: ColumnRef, visible: list[str]) -> Column:
    col = _source_col(ref, visible)
    if ref.aggregate is None:
        if col is None:
            raise SpecError("'*' is only valid under count")
        return col
    return aggregate_expr(ref.aggregate, col)


def plan_query_builder(qb: dict, resolve: Resolver) -> DataFrame:
    datasets = qb["datasets"]
    joined, visible = join_chain(datasets, resolve)

    selects: list[tuple[ColumnRef, str]] = []
    for s in qb["select"]:
        ref = column_ref(s, datasets)
        label = s.get("label") or ref.column_id
        selects.append((ref, label))
    labels = [label for _, label in selects]
    if len(set(labels)) != len(labels):
        raise SpecError(f"duplicate select labels: {labels}")

    pre, post = [], []
    for w in qb["where"]:
        ref = column_ref(w.get("column") or {}, datasets)
        (post if ref.aggregate else pre).append((ref, w.get("operator"), w.get("value")))

    orders = []
    for o in qb["orderBy"]:
        ref = column_ref(o.get("column") or {}, datasets)
        orders.append((ref, o.get("direction", "asc")))

    limit = validate_limit(qb.get("limit"))
    pivot = qb.get("pivot") or {}

    df = joined
    if pre:
        cols = [_value_expr(ref, visible) for ref, _, _ in pre]
        types = joined.select(*cols).schema.fields
        df = df.filter(conjunction([predicate(c, op, v, f.dataType)
                                    for c, (_, op, v), f in zip(cols, pre, types)]))

    aggregated = any(r.aggregate for r, _ in selects) or bool(post) or any(r.aggregate for r, _ in orders)
    if pivot.get("enabled"):
        if post:
            raise SpecError("filters on aggregates (HAVING) cannot be combined with a pivot")
        out, out_labels = _plan_pivot(df, selects, pivot, orders, visible)
    elif aggregated:
        out, out_labels = _plan_aggregate(df, selects, post, orders, visible)
    else:
        out, out_labels = _plan_plain(df, selects, orders, visible)

    if limit is not None:
        out = out.limit(limit)
    return out.select(*[F.col(f"`{l}`") for l in out_labels])


def _plan_plain(df: DataFrame, selects, orders, visible) -> tuple[DataFrame, list[str]]:
    if not selects:
        names = [f.name for ds in visible for f in df.select(f"`{ds}`.*").schema.fields]
        if len(set(names)) != len(names):
            raise SpecError("select is empty and the joined datasets share column names")
        selects = [(ColumnRef(ds, f.name), f.name) for ds in visible for f in df.select(f"`{ds}`.*").schema.fields]
    proj = [_value_expr(ref, visible).alias(label) for ref, label in selects]
    by_ref = {ref.key: label for ref, label in selects}
    sort_cols, hidden = [], []
    for i, (ref, direction) in enumerate(orders):
        name = by_ref.get(ref.key)
        if name is None:
            name = f"__order_{i}"
            hidden.append(_value_expr(ref, visible).alias(name))
        sort_cols.append(_order_column(F.col(f"`{name}`"), direction))
    out = df.select(*proj, *hidden)
    if sort_cols:
        out = out.orderBy(*sort_cols)
    return out, [label for _, label in selects]


def _plan_aggregate(df: DataFrame, selects, post, orders, visible) -> tuple[DataFrame, list[str]]:
    keys = [(ref, label) for ref, label in selects if ref.aggregate is None]
    key_by_ref = {ref.key: label for ref, label in keys}
    agg_names: dict[tuple, str] = {ref.key: label for ref, label in selects if ref.aggregate}
    agg_items = [(ref, label) for ref, label in selects if ref.aggregate]

    def agg_name(ref: ColumnRef) -> str:
        if ref.key not in agg_names:
            name = f"__agg_{len(agg_names)}"
            agg_names[ref.key] = name
            agg_items.append((ref, name))
        return agg_names[ref.key]

    having_names = [agg_name(ref) for ref, _, _ in post]
    sort_cols = []
    for ref, direction in orders:
        if ref.aggregate:
            name = agg_name(ref)
        else:
            name = key_by_ref.get(ref.key)
            if name is None:
                raise SpecError(f"order column {ref.column_id!r} is neither selected nor aggregated")
        sort_cols.append(_order_column(F.col(f"`{name}`"), direction))

    key_cols = [_value_expr(ref, visible).alias(label) for ref, label in keys]
    agg_exprs = [_value_expr(ref, visible).alias(name) for ref, name in agg_items]
    out = df.groupBy(*key_cols).agg(*agg_exprs) if key_cols else df.agg(*agg_exprs)
    if post:
        types = {f.name: f.dataType for f in out.schema.fields}
        out = out.filter(conjunction([
            predicate(F.col(f"`{name}`"), op, v, types[name]) for name, (_, op, v) in zip(having_names, post)
        ]))
    if sort_cols:
        out = out.orderBy(*sort_cols)
    return out, [label for _, label in selects]


def _pivot_label(entry) -> tuple[str, list | None]:
    if isinstance(entry, dict):
        return entry.get("label") or entry.get("columnId"), entry.get("values")
    return entry, None


def _plan_pivot(df: DataFrame, selects, pivot, orders, visible) -> tuple[DataFrame, list[str]]:
    """Pivot entries name select labels: ``rows`` plain selects, one ``columns`` plain select
    (optionally ``{"label": ..., "values": [...]}`` to fix the output columns), ``values``
    aggregated selects (all aggregated selects when empty)."""
    by_label = {label: ref for ref, label in selects}
    rows = [_pivot_label(r)[0] for r in pivot.get("rows") or []]
    if len(pivot.get("columns") or []) != 1:
        raise SpecError("pivot needs exactly one column")
    pcol, pvalues = _pivot_label(pivot["columns"][0])
    values = [_pivot_label(v)[0] for v in pivot.get("values") or []] or \
        [label for ref, label in selects if ref.aggregate]
    for name in rows + [pcol] + values:
        if name not in by_label:
            raise SpecError(f"pivot refers to unknown select label {name!r}")
    if any(by_label[n].aggregate for n in rows + [pcol]):
        raise SpecError("pivot rows and column must be plain selects")
    if any(not by_label[n].aggregate for n in values):
        raise SpecError("pivot values must be aggregated selects")
    if any(by_label[n].column_id == "*" for n in values):
        raise SpecError("count(*) cannot be pivoted; count a column instead")
    base = df.select(*[_source_col(by_label[n], visible).alias(n) for n in rows + [pcol]],
                     *[_source_col(by_label[n], visible).alias(f"__m_{i}") for i, n in enumerate(values)])
    measures = [(n, aggregate_expr(by_label[n].aggregate, F.col(f"__m_{i}"))) for i, n in enumerate(values)]
    out = pivot_frame(base, rows, pcol, measures, pvalues)
    # Spark leaves a pivot cell NULL when a row has no input for that value; a count is 0 there.
    counts = [n for n in values if by_label[n].aggregate in ("count", "count_distinct")]
    if counts:
        cells = [c for c in out.columns if c not in rows]
        if len(values) == 1:
            zero = cells
        else:   # cells are named <value>_<label>; match the longest label suffix
            by_len = sorted(values, key=len, reverse=True)
            zero = [c for c in cells
                    if next((n for n in by_len if c.endswith(f"_{n}")), None) in counts]
        out = out.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(0)) for c in zero})
    sort_cols = []
    for ref, direction in orders:
        match = [label for r, label in selects if r.key == ref.key and label in rows]
        if not match:
            raise SpecError("a pivoted insight can only be ordered by its row columns")
        sort_cols.append(_order_column(F.col(f"`{match[0]}`"), direction))
    if sort_cols:
        out = out.orderBy(*sort_cols)
    return out, out.columns


def run_insight(spec: dict, resolve: Resolver, variables: dict | None = None, spark=None) -> DataFrame:
    """Evaluate an insight (either mode) to a DataFrame. ``variables`` feed sqlEditor mode."""
    query = normalize(spec)
    if query["mode"] == "queryBuilder":
        return plan_query_builder(query["queryBuilder"], resolve)
    from vantage.plans.sql import run_sql_editor

    return run_sql_editor(query["sqlEditor"], resolve, values=variables, spark=spark)


def run_chart(spec: dict, resolve: Resolver, variables: dict | None = None, spark=None) -> DataFrame:
    """The chart-ready frame of an insight: its result shaped by the spec's own visual ``config``."""
    from vantage.operators.charts import chart_frame

    config = spec.get("config") if isinstance(spec, dict) else None
    if not config:
        raise SpecError("the insight has no visual config")
    return chart_frame(run_insight(spec, resolve, variables, spark), config)
