import pytest

from vantage.plans.builder import InsightBuilder
from vantage.plans.insight import run_insight
from vantage.plans.spec import SpecError
from vantage.plans.sql import bind_variables, execute_sql, export_query, placeholder_ids


@pytest.fixture(scope="module")
def frames(spark):
    return {"ds-1": spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string"),
            "ds-2": spark.createDataFrame([(1, 10.0), (3, 30.0)], "k int, w double")}


def test_placeholders_bind_views_and_views_are_dropped(spark, frames):
    sql = "SELECT a.k, w FROM '{{ds-1}}' a JOIN '{{ds-2}}' b ON a.k = b.k WHERE a.k > ?"
    assert placeholder_ids(sql) == ["ds-1", "ds-2"]
    df = execute_sql(spark, sql, frames, args=[1])
    assert [tuple(r) for r in df.collect()] == [(3, 30.0)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("vantage_")]


def test_named_args_from_first_and_errors(spark, frames):
    df = execute_sql(spark, "FROM '{{ds-1}}' |> WHERE v = :v |> SELECT k", frames, named_args={"v": "b"})
    assert [r.k for r in df.collect()] == [2]
    assert execute_sql(spark, export_query("ds-2"), frames).count() == 2
    with pytest.raises(SpecError):
        execute_sql(spark, "SELECT * FROM '{{nope}}'", frames)
    with pytest.raises(SpecError):
        execute_sql(spark, "SELECT ?", frames, args=[1], named_args={"a": 1})


def test_variables():
    variables = [
        {"name": "status", "type": "text", "inputOption": "dropdown", "availableValuesSource": "custom",
         "customValues": "F,O,P", "defaultValue": "O", "alwaysRequired": True},
        {"name": "n", "type": "number", "inputOption": "text", "defaultValue": None, "alwaysRequired": False},
    ]
    assert bind_variables(variables, None) == {"status": "O", "n": None}
    assert bind_variables(variables, {"status": "P", "n": "12"}) == {"status": "P", "n": 12}
    with pytest.raises(SpecError):
        bind_variables(variables, {"status": "X"})
    with pytest.raises(SpecError):
        bind_variables([dict(variables[0], defaultValue=None)], {})
    with pytest.raises(SpecError):
        bind_variables(variables, {"unknown": 1})


def test_sql_editor_insight(spark, frames):
    spec = (InsightBuilder().set_mode("sqlEditor")
            .set_sql("SELECT count(*) AS n FROM '{{ds-1}}' WHERE k >= :lo")
            .add_sql_variable("v", "lo", "Lower", type="number", input_option="text", default_value="2").build())
    assert run_insight(spec, frames.__getitem__).collect()[0].n == 2


def test_column_metadata_roundtrip(spark, tmp_path):
    from vantage.sources import datasets as ds

    df = spark.createDataFrame([(1, "a")], "k int, v string")
    with_meta = ds.with_column_metadata(df, {"k": {"unit": "count", "label": "Anzahl"}})
    path = str(tmp_path / "meta")
    ds.write_dataset(with_meta, path)
    meta = ds.column_metadata(ds.read_dataset(spark, path))
    assert meta == {"k": {"unit": "count", "label": "Anzahl"}, "v": {}}
    import pytest as _pytest
    with _pytest.raises(KeyError):
        ds.with_column_metadata(df, {"missing": {}})


def test_source_timestamp_rule(spark):
    from vantage.sources.datasets import normalized_source_timestamps

    vals = ["2025-01-01", "1-1-1", "2025-01-01T00:00:00Z", "2025-1", "a-b-c", "", "2025--01"]
    df = spark.createDataFrame([(v,) for v in vals], "source_timestamp string")
    got = [r.source_timestamp_norm for r in normalized_source_timestamps(df).collect()]
    assert got == ["2025-01-01T00:00:00Z", "1-1-1T00:00:00Z", "2025-01-01T00:00:00Z", "2025-1", "a-b-c", "", "2025--01"]


def test_bulk_lookups_and_get_or_create(spark):
    from vantage.sources import datasets as ds

    cat = spark.createDataFrame([("d1", "s", "n1", None, None, "a", None), ("d2", "s", "n2", None, None, "b", None)],
                                "id string, solution_id string, name string, description string, source string, "
                                "slug string, documentation string")
    req = spark.createDataFrame([("d1",), ("d1",), ("zz",)], "id string")
    assert [r.id for r in ds.lookup_by_id(cat, req).collect()] == ["d1"]
    assert [r.id for r in ds.missing(cat, req, ["id"]).collect()] == ["zz"]
    wanted = spark.createDataFrame([("s", "a", "dup", 0), ("s", "c", "late", 2), ("s", "c", "early", 1)],
                                   "solution_id string, slug string, name string, seq int")
    out = {(r.slug, r.name, r.created) for r in ds.get_or_create(cat, wanted).collect()}
    assert out == {("a", "n1", False), ("b", "n2", False), ("c", "early", True)}


def test_multiple_dropdown_binds_an_array(spark, frames):
    spec = (InsightBuilder().set_mode("sqlEditor")
            .set_sql("SELECT k FROM '{{ds-1}}' WHERE array_contains(:vs, v) ORDER BY k")
            .add_sql_variable("v", "vs", "Values", dropdown_option="multiple", custom_values="a,b,c",
                              default_value="a").build())
    assert [r.k for r in run_insight(spec, frames.__getitem__, variables={"vs": ["a", "c"]}).collect()] == [1, 3]
    with pytest.raises(SpecError):
        run_insight(spec, frames.__getitem__, variables={"vs": ["a", "x"]})


def test_timeout_cancels_long_query_and_passes_short_one(spark, frames):
    import time

    from vantage.plans.timeout import run_with_timeout

    long_df = execute_sql(spark, "SELECT sum(id % 7) AS s FROM range(0, 1000000000000, 1, 8)", {})
    t0 = time.time()
    with pytest.raises(TimeoutError):
        run_with_timeout(long_df, lambda d: d.collect(), 1.0)
    assert time.time() - t0 < 30
    short = execute_sql(spark, "SELECT count(*) AS n FROM '{{ds-1}}'", frames)
    assert run_with_timeout(short, lambda d: d.collect(), 60)[0].n == 3


def test_dataset_store_roundtrip_and_sql(spark, tmp_path):
    from vantage.plans.sql import export
    from vantage.sources.datasets import DatasetStore

    store = DatasetStore(spark, str(tmp_path / "store"))
    store.write("ds-9", spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string"))
    assert store.read("ds-9").count() == 2
    out = export(spark, "ds-9", str(tmp_path / "exp"), store, sql="SELECT k FROM '{{ds-9}}' WHERE k > ?", args=[1])
    assert [r.k for r in spark.read.parquet(out).collect()] == [2]
    with pytest.raises(ValueError):
        store.path("../x")


def test_date_variable_binds_a_date(spark, frames):
    import datetime

    from vantage.plans.sql import bind_variables

    var = [{"name": "d", "type": "date", "inputOption": "text", "defaultValue": "2025-01-01", "alwaysRequired": True}]
    assert bind_variables(var, None) == {"d": datetime.date(2025, 1, 1)}
    with pytest.raises(SpecError):
        bind_variables(var, {"d": "1-1-1"})
    spec = (InsightBuilder().set_mode("sqlEditor")
            .set_sql("SELECT count(*) AS n FROM '{{ds-1}}' WHERE date_add(:d, k) > DATE '2025-01-02'")
            .add_sql_variable("v", "d", "Day", type="date", input_option="text", default_value="2025-01-01").build())
    assert run_insight(spec, frames.__getitem__).collect()[0].n == 2


def test_source_timestamp_parsed_copy(spark):
    import datetime

    from vantage.sources.datasets import normalized_source_timestamps

    df = spark.createDataFrame([("2025-03-04",), ("2025-03-04T05:06:07Z",), ("a-b-c",)], "source_timestamp string")
    got = [r.source_timestamp_ts for r in normalized_source_timestamps(df, parsed=True).collect()]
    assert got == [datetime.datetime(2025, 3, 4), datetime.datetime(2025, 3, 4, 5, 6, 7), None]


def test_write_sorted_within_files(spark, tmp_path):
    import pyarrow.parquet as pq

    from vantage.sources.datasets import write_dataset

    df = spark.range(0, 5000, 1, 4).selectExpr("id", "(id * 7919) % 1000 AS k").repartition(2)
    path = str(tmp_path / "sorted")
    write_dataset(df, path, sort_within=["k"])
    for f in (tmp_path / "sorted").glob("*.parquet"):
        ks = pq.read_table(f).column("k").to_pylist()
        assert ks == sorted(ks)
    assert spark.read.parquet(path).count() == 5000
