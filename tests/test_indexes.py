"""Stored pages and search postings give what sorting and scanning give; rights against a plain closure."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vantage.operators import listing as lst
from vantage.operators import rights
from vantage.operators.indexes import PageIndex, SearchIndex


def test_pages_are_those_of_the_sorted_listing(spark, tmp_path):
    rng = random.Random(4)
    rows = [(n, rng.choice([None, 1, 2, 3]), f"x{n}") for n in range(237)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "id int, k int, name string").repartition(5)
    index = PageIndex.build(df, str(tmp_path / "p"), ["k"], parts=6)
    want = [r[0] for r in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0]))]
    assert index.total == 237 and len(index.first) > 1
    for size in (1, 10, 100, 1000):
        pages = [[r.id for r in index.page(n, size).collect()] for n in ((1, 2, -(-237 // size), 500) if size == 1 else range(1, -(-237 // size) + 2))]
        if size > 1:
            assert [i for p in pages for i in p] == want and pages[-1] == []
        else:
            assert pages == [want[:1], want[1:2], want[236:], []]
    assert [r.id for r in index.rows(30, 50).collect()] == want[30:80]
    assert [r.id for r in index.page(3, 20).collect()] == [r.id for r in lst.page(df, 3, 20, ["k"]).collect()]
    plan = index.page(3, 20)._jdf.queryExecution().executedPlan().toString()
    assert "_part" in plan.split("PartitionFilters: [")[1].split("]")[0] and "GreaterThanOrEqual(_pos" in plan
    with pytest.raises(ValueError):
        index.page(0)


def test_page_index_of_nothing(spark, tmp_path):
    index = PageIndex.build(spark.range(0), str(tmp_path / "p"), ["id"])
    assert index.total == 0 and index.page(1).collect() == []


def test_search_index_equals_scan(spark, tmp_path):
    rng = random.Random(6)
    names = ["".join(rng.choice("aAbB é#") for _ in range(rng.randrange(9))) for _ in range(300)] + [None, "", "abc", "İstanbul", "STRASSE"]
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    index = SearchIndex.build(df, str(tmp_path / "s"))
    for text in ["ab", "abA", "AB a", "É#b", "aaa", "zzz", "", None, "a", "stras", " b"]:
        assert sorted(map(tuple, index.search(text).collect()), key=repr) == sorted(map(tuple, lst.search(df, text).collect()), key=repr), text
    plan = index.candidates("abA")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "gram" in plan.split("PushedFilters: [")[1].split("ReadSchema")[0]


def plain_closure(edges):
    pairs = {(a, b) for a, b in edges if a is not None and b is not None}
    while True:
        more = pairs | {(a, d) for a, b in pairs for c, d in pairs if b == c}
        if more == pairs:
            return pairs
        pairs = more


def test_reachable_with_cycles(spark):
    rng = random.Random(7)
    for _ in range(3):
        edges = [(rng.choice("abcdefg"), rng.choice(["a", "b", "c", "d", "e", "u1", "u2", "u3", None])) for _ in range(12)]
        df = spark.createDataFrame(edges, "group_id string, member_id string")
        assert {tuple(r) for r in rights.reachable(df, "group_id", "member_id").collect()} == plain_closure(edges)
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(40)], "a string, b string")
    assert rights.closure(chain, "a", "b").count() == 40 * 41 // 2


def test_effective_roles_against_python(spark):
    rng = random.Random(8)
    roles = ["viewer", "editor", "admin"]
    groups, users, containers, resources = ["g1", "g2", "g3", "g4"], ["u1", "u2", "u3"], ["c1", "c2", "c3"], ["r1", "r2", "r3", "r4"]
    members = [(rng.choice(groups), rng.choice(groups + users)) for _ in range(8)]
    inside = [(rng.choice(containers), rng.choice(containers + resources)) for _ in range(8)]
    given = [(rng.choice(containers + resources + [None]), rng.choice(groups + users + [None]), rng.choice(roles + ["owner", None])) for _ in range(12)]
    held = {}
    in_closure, of_closure = plain_closure(inside), plain_closure(members)
    for r, p, role in given:
        if r is None or p is None or role not in roles:
            continue
        for x in {r} | {b for a, b in in_closure if a == r}:
            for y in {p} | {b for a, b in of_closure if a == p}:
                held[x, y] = max(held.get((x, y), -1), roles.index(role))
    assign = spark.createDataFrame(given, "resource_id string, principal_id string, role string")
    mem = spark.createDataFrame(members, "group_id string, member_id string")
    con = spark.createDataFrame(inside, "container_id string, id string")
    got = {(r.resource_id, r.principal_id): r.role for r in rights.effective_roles(assign, mem, con).collect()}
    assert got == {k: roles[v] for k, v in held.items()}
    res = spark.createDataFrame([(r, "name") for r in resources], "id string, name string")
    may = rights.permitted(res, assign, "can_edit", mem, con, spark.createDataFrame([("u1",), ("u1",), ("u2",)], "principal_id string"))
    assert may.columns == ["principal_id", "id", "name"]
    assert {(r.principal_id, r.id) for r in may.collect()} == {(p, r) for (r, p), s in held.items() if s > 0 and r in resources and p in ("u1", "u2")}
    direct = {(r.resource_id, r.principal_id) for r in rights.effective_roles(assign).collect()}
    assert direct == {(r, p) for r, p, role in given if r and p and role in roles}
    with pytest.raises(ValueError):
        rights.permitted(res, assign, "can_fly")
    assert rights.effective_roles(assign.limit(0), mem, con).where(F.lit(True)).count() == 0


@pytest.mark.parametrize("block_rows", [2, 1024])
def test_permitted_pairs_come_up_once(spark, block_rows):
    """Nested groups, cycles, direct and container assignments, repeated and null keys, against a plain statement;
    the pairs are made last: nothing groups, sorts or joins them."""
    rng = np.random.default_rng(4)
    members = [(f"g{a}", f"g{b}") for a, b in rng.integers(0, 8, (9, 2))] + [(f"g{a}", f"u{b}") for a, b in rng.integers(0, (8, 30), (60, 2))]
    inside = [("c0", "c1"), ("c1", "c0")] + [(f"c{a}", f"r{b}") for a, b in rng.integers(0, (4, 40), (50, 2))]
    on = [f"r{i}" for i in range(40)] + ["c0", "c1", "c2"]
    who = [f"g{i}" for i in range(8)] + [f"u{i}" for i in range(30)]
    roles = ["viewer", "editor", "admin", "other"]
    assign = [(on[a], who[b], roles[c]) for a, b, c in rng.integers(0, (len(on), len(who), 4), (70, 3))]
    res = [(f"r{i}", f"name {i}") for i in range(30)] + [("r3", "again"), (None, "none")]
    make = spark.createDataFrame
    mem = make(members + [(None, "u1"), ("g1", None)], "group_id string, member_id string")
    con = make(inside + [(None, "r1"), ("c1", None)], "container_id string, id string")
    asg = make(assign + assign[:5] + [(None, "u1", "admin"), ("r1", None, "admin")], "resource_id string, principal_id string, role string")
    around, groups = plain_closure(inside), plain_closure(members)
    held = {(r, p) for r, p, role in assign if role in ("editor", "admin")}
    held |= {(i, p) for r, p in held for c, i in around if c == r}
    held |= {(r, m) for r, p in held for g, m in groups if g == p}
    want = sorted((p, r, name) for r, name in res for own, p in held if own == r)
    out = rights.permitted(make(res, "id string, name string"), asg, "can_edit", mem, con, block_rows=block_rows, pairs_per_task=50)
    assert sorted(map(tuple, out.collect())) == want
    top = out._jdf.queryExecution().optimizedPlan().toString().split("Generate explode(ids")[0]
    assert "Join" not in top and "Aggregate" not in top
    some = rights.permitted(make(res, "id string, name string"), asg, "can_edit", mem, con, make([("u3",), ("g2",)], "principal_id string"))
    assert sorted(map(tuple, some.collect())) == [r for r in want if r[0] in ("u3", "g2")]
