import pytest

from vantage.operators import charts, roles


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([("DE", "Berlin", 3.0, "g1"), ("FR", None, 5.0, "g2"), ("DE", "Bonn", None, "g1")],
                                 "geo string, name string, v double, grp string")


def test_chart_frames(spark, df):
    assert charts.big_number(df, "v").collect()[0].value == 8.0
    assert charts.big_number(df, "v", "count").collect()[0].value == 2
    assert charts.bar_frame(df, "geo", "v").columns == ["x", "y", "series"]
    assert {r.series for r in charts.line_frame(df, "geo", "v", "grp").collect()} == {"g1", "g2"}
    assert charts.pie_frame(df, "name", "v").columns == ["label", "measure"]
    scatter = charts.map_frame(df, "geo", value="v", layer_type="scatter")
    assert scatter.columns == ["geometry", "label", "value", "group"]
    assert {r.group for r in scatter.collect()} == {None}
    assert charts.map_frame(df, "geo", "name", "v").columns == ["geometry", "label", "value"]
    with pytest.raises(ValueError):
        charts.map_frame(df, "geo", layer_type="heatmap")
    labels = spark.createDataFrame([("Anteil %",), ("ANZAHL Fälle",), ("Name",)], "label string")
    assert [r.display_type for r in charts.table_column_types(labels).collect()] == ["number", "number", "text"]


def test_role_and_tag_edges(spark):
    ra = spark.createDataFrame([("r1", "p1", "admin"), ("r2", "p1", "viewer"), ("r1", "p2", "editor")],
                               "resource_id string, principal_id string, role string")
    only_principal = spark.createDataFrame([("p1",)], "principal_id string")
    assert [tuple(r) for r in roles.role_unassign(ra, only_principal).collect()] == [("r1", "p2", "editor")]
    assert roles.resource_principals(ra, "r1", {"role": "admin"}).count() == 1
    tags = spark.createDataFrame([("t1", "r1")], "tag_id string, resource_id string")
    new = spark.createDataFrame([("t1", "r1"), ("t2", "r1"), ("t2", "r1")], "tag_id string, resource_id string")
    assigned = roles.tag_assign(tags, new)
    assert sorted(tuple(r) for r in assigned.collect()) == [("t1", "r1"), ("t2", "r1")]
    assert [tuple(r) for r in roles.tag_unassign(assigned, tags).collect()] == [("t2", "r1")]
    res = spark.createDataFrame([("r1", "x"), ("r2", "y")], "id string, name string")
    assert [r.id for r in roles.resources_by_tags(res, assigned, ["t2"]).collect()] == ["r1"]


def test_chart_frame_from_config(df):
    col = lambda label: {"column": {"key": label, "label": label}}
    assert charts.chart_frame(df, {"type": "table", "series": [col("v"), col("geo")]}).columns == ["v", "geo"]
    big = charts.chart_frame(df, {"type": "big-number", "measure": {**col("v"), "aggregate": "max"}})
    assert big.collect()[0].value == 5.0
    assert charts.chart_frame(df, {"type": "line-chart", "xAxis": col("geo"), "yAxis": col("v"),
                                   "metric": {"column": None}}).columns == ["x", "y", "series"]
    assert charts.chart_frame(df, {"type": "pie-chart", "label": col("name"), "measure": col("v")}).count() == 3
    scatter = charts.chart_frame(df, {"type": "map-chart", "layers": [
        {"type": "scatter", "geometryColumn": {"key": "geo", "label": "geo"}, "groupColumn": None}]})
    assert scatter.columns == ["geometry", "label", "value", "group"]
    with pytest.raises(ValueError):
        charts.chart_frame(df, {"type": "gauge"})
