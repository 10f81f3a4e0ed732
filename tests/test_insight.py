import pytest

from vantage.plans.builder import InsightBuilder, join_on, where_def
from vantage.plans.insight import run_insight
from vantage.plans.spec import SpecError, normalize


@pytest.fixture(scope="module")
def resolve(spark):
    frames = {
        "c": spark.createDataFrame([(1, "A", "x"), (2, "B", None), (3, "A", "y"), (4, "C", "")],
                                   "ck int, seg string, tag string"),
        "o": spark.createDataFrame([(10, 1, 5.0), (11, 1, 7.0), (12, 2, 1.0), (13, 3, 2.0), (14, 9, 100.0)],
                                   "ok int, ck int, amt double"),
    }
    return lambda ds: frames[ds]


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_plain_select_filter_order_limit(resolve):
    spec = (InsightBuilder().add_dataset("o").add_select("ok").add_select("amt", label="amount")
            .add_filter("amt", "greater_than", 1.5).add_order_by("amt", direction="desc").set_limit(2).build())
    df = run_insight(spec, resolve)
    assert df.columns == ["ok", "amount"]
    assert rows(df) == [(14, 100.0), (11, 7.0)]


def test_implicit_group_by_join_and_having_on_hidden_aggregate(resolve):
    spec = (InsightBuilder().add_dataset("c")
            .add_dataset("o", "inner", [join_on("c", "ck", "o", "ck")])
            .add_select("seg").add_select("amt", "o", "sum", "total")
            .add_filter_defs([where_def("ok", "o", "greater_or_equals", 2, aggregate="count")])
            .add_order_by("seg").build())
    assert rows(run_insight(spec, resolve)) == [("A", 14.0)]


def test_global_aggregate_and_order_by_unselected_aggregate(resolve):
    spec = InsightBuilder().add_dataset("o").add_select("amt", aggregate="max", label="m") \
        .add_select("*", aggregate="count", label="n").build()
    assert rows(run_insight(spec, resolve)) == [(100.0, 5)]
    spec = (InsightBuilder().add_dataset("o").add_select("ck").add_select("ok", aggregate="count", label="n")
            .add_order_by("amt", aggregate="sum", direction="desc").build())
    assert [r[0] for r in rows(run_insight(spec, resolve))] == [9, 1, 3, 2]


def test_limit_zero_and_negative(resolve):
    spec = InsightBuilder().add_dataset("o").add_select("ok").set_limit(0).build()
    assert rows(run_insight(spec, resolve)) == []
    with pytest.raises(SpecError):
        InsightBuilder().set_limit(-1)
    bad = InsightBuilder().add_dataset("o").add_select("ok").build()
    bad["query"]["queryBuilder"]["limit"] = -1
    with pytest.raises(SpecError):
        run_insight(bad, resolve)


def test_outer_semi_anti_cross(resolve):
    base = InsightBuilder().add_dataset("c")
    left = base.add_dataset("o", "left", [join_on("c", "ck", "o", "ck")]).add_select("ck").add_select("ok", "o").build()
    assert sorted(rows(run_insight(left, resolve)), key=str) == sorted(
        [(1, 10), (1, 11), (2, 12), (3, 13), (4, None)], key=str)
    anti = (InsightBuilder().add_dataset("c").add_dataset("o", "anti", [join_on("c", "ck", "o", "ck")])
            .add_select("ck").build())
    assert rows(run_insight(anti, resolve)) == [(4,)]
    semi = (InsightBuilder().add_dataset("o").add_dataset("c", "semi", [join_on("o", "ck", "c", "ck")])
            .add_select("ok").build())
    assert sorted(rows(run_insight(semi, resolve))) == [(10,), (11,), (12,), (13,)]
    full = (InsightBuilder().add_dataset("c").add_dataset("o", "full", [join_on("c", "ck", "o", "ck")])
            .add_select("ck").add_select("ok", "o").build())
    assert len(rows(run_insight(full, resolve))) == 6


def test_semi_joined_columns_are_not_visible(resolve):
    spec = (InsightBuilder().add_dataset("o").add_dataset("c", "semi", [join_on("o", "ck", "c", "ck")])
            .add_select("seg", "c").build())
    with pytest.raises(SpecError):
        run_insight(spec, resolve)


@pytest.mark.parametrize("mutate", [
    lambda b: b.add_dataset("o"),                                   # join without condition
    lambda b: b.add_dataset("c", "inner", [join_on("c", "ck", "c", "ck")]),  # same dataset twice
    lambda b: b.add_dataset("o", "sideways", [join_on("c", "ck", "o", "ck")]),
    lambda b: b.add_select("ck").add_select("seg", label="ck"),   # duplicate label
    lambda b: b.add_select("ck", aggregate="median"),
    lambda b: b.add_select("ck").add_order_by("ck", direction="up"),
])
def test_invalid_specs(resolve, mutate):
    b = mutate(InsightBuilder().add_dataset("c"))
    with pytest.raises(SpecError):
        run_insight(b.build(), resolve)


def test_mode_and_version_normalization():
    with pytest.raises(SpecError):
        InsightBuilder().set_mode("graph")
    v3 = InsightBuilder(version=3).add_dataset("c").add_select("ck").build()
    assert v3["query"]["version"] == 3 and "pivot" not in v3["query"]["queryBuilder"]
    q = normalize(v3)
    assert q["queryBuilder"]["pivot"]["enabled"] is False and q["sqlEditor"]["variables"] == []
    with pytest.raises(SpecError):
        normalize({"query": {"mode": "other"}})


def test_pivot_fixed_values_and_names(resolve):
    spec = (InsightBuilder().add_dataset("c")
            .add_dataset("o", "inner", [join_on("c", "ck", "o", "ck")])
            .add_select("seg").add_select("ck", label="cust").add_select("amt", "o", "sum", "total")
            .set_pivot(rows=["seg"], columns=[{"label": "cust", "values": [1, 2, 3]}], values=["total"])
            .add_order_by("seg").build())
    df = run_insight(spec, resolve)
    assert df.columns == ["seg", "1", "2", "3"]
    assert rows(df) == [("A", 12.0, None, 2.0), ("B", None, 1.0, None)]
    two = (InsightBuilder().add_dataset("o").add_select("ck").add_select("ok", label="k")
           .add_select("amt", aggregate="sum", label="s").add_select("amt", aggregate="max", label="m")
           .set_pivot(rows=["ck"], columns=[{"label": "k", "values": [10]}], values=["s", "m"]).build())
    assert run_insight(two, resolve).columns == ["ck", "10_s", "10_m"]


def test_order_by_unselected_column_and_select_all(resolve):
    spec = (InsightBuilder().add_dataset("o").add_select("ok")
            .add_order_by("amt", direction="desc").set_limit(3).build())
    df = run_insight(spec, resolve)
    assert df.columns == ["ok"] and rows(df) == [(14,), (11,), (10,)]
    everything = InsightBuilder().add_dataset("c").add_filter("tag", "is_null_or_empty", None).build()
    out = run_insight(everything, resolve)
    assert out.columns == ["ck", "seg", "tag"] and sorted(r.ck for r in out.collect()) == [2, 4]


def test_order_by_non_key_in_aggregate_is_rejected(resolve):
    spec = (InsightBuilder().add_dataset("o").add_select("ck").add_select("amt", aggregate="sum", label="s")
            .add_order_by("ok").build())
    with pytest.raises(SpecError):
        run_insight(spec, resolve)


def test_spec_survives_json_roundtrip(resolve):
    import json

    spec = (InsightBuilder().add_dataset("c")
            .add_dataset("o", "left", [join_on("c", "ck", "o", "ck")])
            .add_select("seg").add_select("amt", "o", "sum", "total")
            .add_filter("tag", "is_not_null_or_empty", None)
            .add_order_by("amt", "o", "sum", "desc").set_limit(5).build())
    again = json.loads(json.dumps(spec))
    assert rows(run_insight(again, resolve)) == rows(run_insight(spec, resolve)) == [("A", 14.0)]


def test_pivot_with_having_is_rejected(resolve):
    spec = (InsightBuilder().add_dataset("o").add_select("ck").add_select("ok", label="k")
            .add_select("amt", aggregate="sum", label="s")
            .add_filter_defs([where_def("amt", "o", "greater_than", 1, aggregate="sum")])
            .set_pivot(rows=["ck"], columns=["k"], values=["s"]).build())
    with pytest.raises(SpecError):
        run_insight(spec, resolve)


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_cross_join_needs_the_flag_at_any_size(spark, resolve, threshold):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        plain = InsightBuilder().add_dataset("c").add_dataset("o", "cross").add_select("ck").build()
        with pytest.raises(SpecError):
            run_insight(plain, resolve)
        product = (InsightBuilder().add_dataset("c").add_dataset("o", "cross", allow_product=True)
                   .add_select("ck").add_select("ok", "o").build())
        n = len(rows(run_insight(product, resolve)))
        assert n == resolve("c").count() * resolve("o").count() and n > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_run_chart_uses_the_spec_config(resolve):
    from vantage.plans.insight import run_chart

    spec = (InsightBuilder().add_dataset("o").add_select("ck").add_select("amt", aggregate="sum", label="total")
            .set_config({"type": "pie-chart", "label": {"column": {"key": "ck", "label": "ck"}},
                         "measure": {"column": {"key": "amt", "label": "total"}}}).build())
    out = run_chart(spec, resolve)
    assert out.columns == ["label", "measure"] and out.count() == 4
    with pytest.raises(SpecError):
        run_chart(InsightBuilder().add_dataset("o").add_select("ck").build(), resolve)
