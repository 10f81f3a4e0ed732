"""Keyed merges: KPI upserts, nested register entries, column metadata, lookups over all entity types."""

import json
import random

import pytest
from pyspark.sql import functions as F

from vantage.operators import changes as chg
from vantage.operators import listing as lst
from vantage.operators import metadata as md


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_kpi_merge_random_against_python(spark):
    """One update or create per (solution, KPI), whatever number of bodies it has."""
    rng = random.Random(3)
    insights = [(f"i{n:02}", rng.choice(["s1", "s2", None]), f"{rng.choice('ABC')} - old {n}", n) for n in range(14)]
    insights.append(("new-s1-E", "s9", "taken", 99))
    bodies = [(rng.choice(["s1", "s2", None]), rng.choice(["A", "B", "C", "D", "E", None]), n, f"name {n}") for n in range(40)]
    state = {i[0]: list(i) for i in insights}
    latest = {}
    for s, k, n, name in bodies:
        if s is not None and k is not None:
            latest[s, k] = name  # seq ascends
    rejects = [(s, k, "null key") for s, k, _, _ in bodies if s is None or k is None]
    for (s, k), name in latest.items():
        match = min((i[0] for i in insights if i[1] == s and i[2].split(" - ")[0] == k), default=None)
        if match:
            state[match][2] = name
        elif f"new-{s}-{k}" in state:
            rejects.append((s, k, "id exists"))
        else:
            state[f"new-{s}-{k}"] = [f"new-{s}-{k}", s, name, None]
    ins = spark.createDataFrame(insights, "id string, solution_id string, name string, extra int")
    bod = spark.createDataFrame(rng.sample(bodies, len(bodies)), "solution_id string, kpi_id string, seq int, name string")
    new, bad = chg.merge_by_kpi(ins, bod)
    assert new.columns == ins.columns
    assert rows_of(new) == sorted((tuple(r) for r in state.values()), key=repr)
    assert rows_of(bad) == sorted(rejects, key=repr)
    ups = chg.upsert_by_kpi(ins, bod.where("solution_id IS NOT NULL AND kpi_id IS NOT NULL"))
    assert ups.count() == len(latest) == ups.select("id").distinct().count()


def test_kpi_merge_keeps_null_fields_of_a_body(spark):
    """A body that holds a field sets it, to NULL too; a field no body has is kept."""
    ins = spark.createDataFrame([("i1", "s", "A - x", "note"), ("i2", "s", "B - y", "note")], "id string, solution_id string, name string, note string")
    bod = spark.createDataFrame([("s", "A", None, "A - z")], "solution_id string, kpi_id string, note string, name string")
    assert rows_of(chg.merge_by_kpi(ins, bod)[0]) == [("i1", "s", "A - z", None), ("i2", "s", "B - y", "note")]
    empty = bod.limit(0)
    assert rows_of(chg.merge_by_kpi(ins, empty)[0]) == rows_of(ins)


ITEM = "struct<kind:string,who:string,note:string>"


def replay_items(items, changes):
    """The rule of ``merge_nested`` for one record: the last change of each item counts."""
    last = {}
    for seq, op, item in sorted(changes, key=lambda c: c[0]):
        last[item[0], item[1]] = (seq, op, item)
    out, seen = [], set()
    for item in items or []:
        key = (item[0], item[1])
        if key not in last:
            out.append(item)
        elif last[key][1] == "set" and key not in seen:
            out.append(last[key][2])
        seen.add(key)
    return out + [c[2] for c in sorted(last.values()) if c[1] == "set" and (c[2][0], c[2][1]) not in seen]


@pytest.mark.parametrize("nested", [True, False])
def test_nested_merge_random_against_python(spark, nested):
    rng = random.Random(5)

    def item(note):
        return (rng.choice(["a", "b", None]), rng.choice(["x", "y", None]), note)
    state = [(f"r{n}", rng.choice([None, [], [item(f"old {j}") for j in range(rng.randrange(1, 6))]])) for n in range(12)]
    changes = [(f"r{rng.randrange(14)}", n, rng.choice(["set", "set", "remove", "swap", None]), item(f"new {n}")) for n in range(120)]
    df = spark.createDataFrame(state, f"id string, items array<{ITEM}>")
    path = "items"
    if nested:
        df = df.select("id", F.struct(F.lit(1).alias("n"), "items").alias("rest"))
        path = "rest.items"
    new, rejects = chg.merge_nested(df, spark.createDataFrame(rng.sample(changes, 120), f"id string, seq int, op string, item {ITEM}"),
                                    path, ["kind", "who"], key="id")
    assert new.schema.simpleString() == df.schema.simpleString()
    got = {r["id"]: (None if r["items"] is None else [tuple(x) for x in r["items"]]) for r in new.select("id", F.col(path).alias("items")).collect()}
    for name, items in state:
        mine = [(s, o, i) for r, s, o, i in changes if r == name and o in ("set", "remove")]
        assert got[name] == (replay_items(items, mine) if mine else items), name
    known = {r for r, _ in state}
    assert sorted((r.id, r.seq, r.reason) for r in rejects.collect()) == sorted(
        [(r, s, "unknown op") for r, s, o, _ in changes if o not in ("set", "remove")]
        + [(r, s, "absent record") for r, s, o, _ in changes if o in ("set", "remove") and r not in known])


def test_nested_merge_hot_record_is_reduced_before_it_is_gathered(spark):
    state = spark.createDataFrame([("r", [("a", "x", "old")])], f"id string, items array<{ITEM}>")
    many = spark.range(50_000).selectExpr("'r' AS id", "id AS seq", "'set' AS op",
                                          "named_struct('kind', CAST(id % 3 AS STRING), 'who', 'x', 'note', CAST(id AS STRING)) AS item")
    new, _ = chg.merge_nested(state, many, "items", ["kind", "who"], key="id")
    assert [tuple(x) for x in new.first()["items"]] == [
        ("a", "x", "old"), ("2", "x", "49997"), ("0", "x", "49998"), ("1", "x", "49999")]


def test_dpa_update_replaces_and_defaults(spark):
    columns = ("solution_id string, slug string, status string, toggleable boolean, data_processing_confirmed boolean, "
               "has_personal_data string, data_category string, data_type string, person_group string, purpose string, safety_measures string")
    state = chg.dpa_entries_from(spark.createDataFrame([("s", "a", "active", False, True, "yes", "c", "t", "g", "p", "m"),
                                                        ("s", "b", "active", False, True, "yes", "c", "t", "g", "p", "m")], columns))
    requests = spark.createDataFrame([(1, "s", "a", "x", True, True, "no", "c1", "t1", "g1", "p1", "m1"),
                                      (2, "s", "a", None, None, False, "no", "c2", "t2", "g2", "p2", "m2"),
                                      (1, "s", "zz", None, None, False, "no", "c2", "t2", "g2", "p2", "m2")], "seq int, " + columns)
    new, rejects = chg.dpa_update(state, requests)
    assert new.columns == state.columns
    got = {r.slug: r for r in new.collect()}
    assert (got["a"].status, got["a"].toggleable, got["a"].attributes.dataCategory) == ("inactive", True, "c2")
    assert [tuple(x) for x in got["a"].attributes.activityAmendments] == [("t2", "g2", "p2", "m2")]
    assert got["b"].status == "active" and got["b"].attributes.dataCategory == "c"
    assert [(r.slug, r.reason) for r in rejects.collect()] == [("zz", "absent entry")]


DOCUMENTS = [
    ("full", {"metadata": {"schema": {"columns": {"a": {"label": "A", "n": 1, "x": None, "deep": {"k": [1]}}, "b": {}, "c": 3}}}}),
    ("no columns", {"metadata": {"schema": {}}}), ("null columns", {"metadata": {"schema": {"columns": None}}}),
    ("list", {"metadata": {"schema": {"columns": [1]}}}), ("null schema", {"metadata": {"schema": None}}),
    ("no schema", {"metadata": {}}), ("text", {"metadata": "x"}), ("empty", {}), ("array", [1]),
]


def test_metadata_levels_default_to_empty(spark):
    rows = [(n, json.dumps(d)) for n, d in DOCUMENTS] + [("cut", '{"metadata": {"sch'), ("null", None)]
    df = spark.createDataFrame(rows, "dataset_id string, document string")
    got = {r.dataset_id: json.loads(r["columns"]) for r in md.metadata_columns(df).collect()}
    assert got.pop("full") == DOCUMENTS[0][1]["metadata"]["schema"]["columns"]
    assert set(got) == {n for n, _ in rows} - {"full"} and all(v == {} for v in got.values())
    found = {(r.dataset_id, r.column_id): r.metadata for r in md.column_rows(df).collect()}
    assert found == {("full", "a"): {"label": "A", "n": "1", "x": None, "deep": '{"k":[1]}'}, ("full", "b"): {}, ("full", "c"): {}}


def test_metadata_merge_random_against_python(spark):
    rng = random.Random(9)
    catalog = [(f"d{d}", f"c{c}", {"label": f"{d}{c}"}) for d in range(4) for c in range(3)]
    updates = []
    for seq in range(60):
        kind = rng.random()
        body = rng.choice(["[1]", "null", "{", '"x"', None]) if kind < 0.2 else json.dumps(
            {f"c{rng.randrange(5)}": rng.choice([{"v": str(seq)}, {}, 5, None]) for _ in range(rng.randrange(3))})
        updates.append((f"d{rng.randrange(5)}", seq, body))
    state = {(d, c): m for d, c, m in catalog}
    rejects, last = [], {}
    for d, seq, body in updates:
        try:
            parsed = json.loads(body)
        except (TypeError, ValueError):
            parsed = None
        if not isinstance(parsed, dict):
            rejects.append((d, None, seq, "bad payload"))
            continue
        for c, value in parsed.items():
            if isinstance(value, dict):
                last[d, c] = (seq, value)
            else:
                rejects.append((d, c, seq, "bad column"))
    for (d, c), (seq, value) in last.items():
        if (d, c) in state:
            state[d, c] = value
        else:
            rejects.append((d, c, seq, "absent column"))
    new, bad = md.merge_column_metadata(spark.createDataFrame(catalog, "dataset_id string, column_id string, metadata map<string,string>"),
                                        spark.createDataFrame(rng.sample(updates, 60), "dataset_id string, seq int, columns string"))
    assert {(r.dataset_id, r.column_id): r.metadata for r in new.collect()} == state and new.count() == len(state)
    assert rows_of(bad) == sorted(rejects, key=repr)


def test_entity_lookup_shuffles_requests_only(spark, tmp_path):
    entities = spark.range(1000).selectExpr("CASE WHEN id % 2 = 0 THEN 'tag' ELSE 'report' END AS entity_type",
                                            "CAST(id AS STRING) AS key", "CAST(id AS STRING) AS id", "concat('n', id) AS name")
    requests = spark.createDataFrame([("tag", "4"), ("tag", "4"), ("tag", "5"), ("report", "5"), ("group", "4"), (None, "4"), ("tag", None)],
                                     "entity_type string, key string")
    saved = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        index = lst.entity_index(entities, "entity_index_test", str(tmp_path / "index"), buckets=8)
        out = lst.lookup_entities(index, requests)
        assert sorted(((r.entity_type, r.key, r.name, r.found) for r in out.collect()), key=repr) == sorted([
            ("tag", "4", "n4", True), ("tag", "5", None, False), ("report", "5", "n5", True), ("group", "4", None, False),
            (None, "4", None, False), ("tag", None, None, False)], key=repr)
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        catalog_side = plan[plan.rindex("Scan ExistingRDD"):]
        assert "Bucketed: true" in catalog_side and "Exchange" not in catalog_side
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", saved)
        spark.sql("DROP TABLE IF EXISTS entity_index_test")
