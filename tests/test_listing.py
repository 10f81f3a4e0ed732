import pytest

from vantage.operators import listing as lst
from vantage.operators.validation import validate_records


@pytest.fixture(scope="module")
def res(spark):
    rows = [(str(i), f"c{i % 3}", "dataset" if i % 2 else "insight", f"Name {i} - {'Red' if i % 5 == 0 else 'blue'}")
            for i in range(237)]
    return spark.createDataFrame(rows, "id string, container_id string, resource_type string, name string").repartition(7)


def test_pages_concatenate_to_the_listing(res):
    ordered = [r.id for r in res.orderBy("id").collect()]
    paged = []
    for p in range(1, 6):
        paged += [r.id for r in lst.page(res, p, 50, ["id"]).collect()]
    assert paged == ordered
    assert lst.total(res).collect()[0].total == 237


def test_bulk_page_numbers_match_row_order(res):
    got = {r.id: r.page for r in lst.with_page_numbers(res, 50, ["container_id", "id"]).collect()}
    ordered = [r.id for r in res.orderBy("container_id", "id").collect()]
    assert got == {i: n // 50 + 1 for n, i in enumerate(ordered)}


def test_listing_search_filters(spark, res):
    ra = spark.createDataFrame([("3", "u", "editor"), ("9", "u", "viewer"), ("5", "u", "admin")],
                               "resource_id string, principal_id string, role string")
    got = lst.list_resources(res, "c0", "dataset", "can_edit", principal_id="u", role_assignments=ra)
    assert sorted(r.id for r in got.collect()) == ["3"]
    assert lst.search(res, "RED").count() == 48
    assert lst.search(res, "").count() == 237
    assert lst.filtered_list(res, {"container_id": "c1", "resource_type": None}).count() == 79


def test_validation_order(spark):
    df = spark.createDataFrame([
        (1, "text/plain", 204, "x"), (2, "text/html", 500, "x"), (3, "application/json", 200, "{bad"),
        (4, "application/json; charset=utf-8", 404, '{"data": {"id": 1}}'), (5, "application/json", 200, '{"x": 1}'),
        (6, "application/json", 201, '{"data": {"name": null}}'), (7, "application/json", 200, '{"data": {"id": null}}'),
        (8, "application/json", 200, '{"data": "id"}'),
    ], "rid int, content_type string, status int, body string")
    out = validate_records(df, expected=(200, 201, 204), required_keys=("data", "id"))
    got = {r.rid: r.error for r in out.collect()}
    assert got == {1: None, 2: "http_status", 3: "invalid_json", 4: "http_status", 5: "missing_key:data",
                   6: "missing_key:id", 7: None, 8: "missing_key:id"}


def test_pages_agree_with_bulk_page_numbers(res):
    one = [r.id for r in lst.page(res, 3, 40, ["id"]).collect()]
    bulk = sorted(r.id for r in lst.with_page_numbers(res, 40, ["id"]).filter("page = 3").collect())
    assert sorted(one) == bulk and len(one) == 40


def test_listing_by_tags_and_search(spark, res):
    tags = spark.createDataFrame([("t1", "3"), ("t2", "9"), ("t1", "12")], "tag_id string, resource_id string")
    got = lst.list_resources(res, "c0", "dataset", permission=None, tag_ids=["t1", "t2"], resource_tags=tags)
    assert sorted(r.id for r in got.collect()) == ["3", "9"]
    assert got.columns == res.columns
    red = lst.list_resources(res, "c0", "dataset", permission=None, search="red")
    assert all("Red" in r.name for r in red.collect()) and red.count() > 0
