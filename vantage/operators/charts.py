"""Chart-ready frames: the rows a chart reads, with columns named by their role.

A chart config names selected columns by role (x axis, y axis, series, label, measure, geometry,
group); here each chart turns an insight result into a DataFrame with exactly those role columns.
Styling (colors, layout, ticks, backgrounds) changes drawing, not rows, and is not modelled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vantage.functions.expressions import display_type
from vantage.operators.aggregates import aggregate_expr


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def table_frame(df: DataFrame, columns: list[str]) -> DataFrame:
    """V1: the selected columns in series order."""
    return df.select(*[_c(c) for c in columns])


def table_column_types(labels: DataFrame, label_col: str = "label") -> DataFrame:
    """V1 display types over a column catalog: ``number`` when the label contains ``%`` or
    (case-insensitively) ``anzahl``, else ``text``."""
    return labels.withColumn("display_type", display_type(F.col(label_col)))


def big_number(df: DataFrame, measure: str, aggregate: str = "sum") -> DataFrame:
    """V2: one aggregated measure (default sum) as a one-row frame ``value``."""
    return df.agg(aggregate_expr(aggregate, _c(measure)).alias("value"))


def _xy(df: DataFrame, x: str, y: str, metric: str | None) -> DataFrame:
    series = _c(metric).cast("string") if metric else F.lit(None).cast("string")
    return df.select(_c(x).cast("string").alias("x"), _c(y).alias("y"), series.alias("series"))


def bar_frame(df: DataFrame, x: str, y: str, metric: str | None = None) -> DataFrame:
    """V3: long-form (x as text, y as number, optional series)."""
    return _xy(df, x, y, metric)


def line_frame(df: DataFrame, x: str, y: str, metric: str | None = None) -> DataFrame:
    """V4: as the bar frame."""
    return _xy(df, x, y, metric)


def pie_frame(df: DataFrame, label: str, measure: str) -> DataFrame:
    """V5: slice label and measure."""
    return df.select(_c(label).cast("string").alias("label"), _c(measure).alias("measure"))


def map_frame(df: DataFrame, geometry: str, label: str | None = None, value: str | None = None,
              layer_type: str = "choropleth", group: str | None = None) -> DataFrame:
    """V6/V7: geometry with optional label and value; the scatter layer adds a group column
    (NULL when no group column is configured)."""
    if layer_type not in ("choropleth", "scatter"):
        raise ValueError(f"unknown layer type {layer_type!r}")
    cols = [_c(geometry).cast("string").alias("geometry"),
            (_c(label).cast("string") if label else F.lit(None).cast("string")).alias("label"),
            (_c(value) if value else F.lit(None).cast("double")).alias("value")]
    if layer_type == "scatter":
        cols.append((_c(group).cast("string") if group else F.lit(None).cast("string")).alias("group"))
    return df.select(*cols)


def _role(entry: dict | None) -> str | None:
    """Result column named by a config role (``{"column": {...}}`` or the column dict itself): its
    ``label``, which is the select's output name, else its ``key``."""
    if not isinstance(entry, dict):
        return None
    col = entry.get("column", entry) if "column" in entry else entry
    if not col:
        return None
    return col.get("label") or col.get("key")


def chart_frame(df: DataFrame, config: dict) -> DataFrame:
    """The chart-ready frame an insight's visual ``config`` asks for, over the insight result.

    Config types: ``table`` (``series`` in order), ``big-number`` (``measure`` and its
    ``aggregate``, default sum), ``bar-chart`` / ``line-chart`` (``xAxis``, ``yAxis``, optional
    ``metric``), ``pie-chart`` (``label``, ``measure``), ``map-chart`` (first layer:
    ``geometryColumn``, optional ``labelColumn`` / ``valueColumn``, ``groupColumn`` for scatter).
    Styling keys are ignored.
    """
    kind = (config or {}).get("type")
    if kind == "table":
        return table_frame(df, [_role(s) for s in config.get("series") or []])
    if kind == "big-number":
        measure = config.get("measure") or {}
        return big_number(df, _role(measure), measure.get("aggregate") or "sum")
    if kind in ("bar-chart", "line-chart"):
        frame = bar_frame if kind == "bar-chart" else line_frame
        return frame(df, _role(config.get("xAxis")), _role(config.get("yAxis")), _role(config.get("metric")))
    if kind == "pie-chart":
        return pie_frame(df, _role(config.get("label")), _role(config.get("measure")))
    if kind == "map-chart":
        layers = config.get("layers") or []
        if not layers:
            raise ValueError("map chart without layers")
        layer = layers[0]
        return map_frame(df, _role(layer.get("geometryColumn")), _role(layer.get("labelColumn")),
                         _role(layer.get("valueColumn")), layer.get("type", "choropleth"),
                         _role(layer.get("groupColumn")))
    raise ValueError(f"unknown chart type {kind!r}")
