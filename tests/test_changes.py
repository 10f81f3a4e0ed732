import json
import random

import pytest

from pyspark.sql import functions as F

from vantage.operators import changes as chg
from vantage.operators import roles

STATE_SCHEMA = "key string, name string, score bigint"
CHANGE_SCHEMA = "key string, seq bigint, op string, payload string"


def replay(state, changes):
    """Sequential reference: apply changes one by one in seq order."""
    cur = {k: dict(v) for k, v in state.items()}
    rejects = []
    for key, seq, op, payload in sorted(changes, key=lambda c: c[1]):
        body = json.loads(payload)
        if op == "create":
            cur[key] = {"name": body.get("name"), "score": body.get("score")}
        elif op == "delete":
            if key in cur:
                del cur[key]
            else:
                rejects.append(seq)
        else:
            if key not in cur:
                rejects.append(seq)
                continue
            for f in ("name", "score"):
                if f in body:
                    cur[key][f] = body[f]
    return cur, sorted(rejects)


def random_case(rng, n_keys=25, n_changes=300):
    state = {f"k{i}": {"name": f"n{i}", "score": i} for i in range(n_keys) if rng.random() < 0.5}
    changes = []
    for seq in rng.sample(range(10 * n_changes), n_changes):
        key = f"k{rng.randrange(n_keys)}"
        op = rng.choices(["create", "update", "delete"], [1, 6, 1])[0]
        body = {}
        if op != "delete":
            if rng.random() < 0.6:
                body["name"] = rng.choice([None, f"v{seq}"])
            if rng.random() < 0.6:
                body["score"] = rng.choice([None, seq])
        changes.append((key, seq, op, json.dumps(body)))
    return state, changes


def test_fold_equals_sequential_replay(spark):
    rng = random.Random(7)
    for _ in range(3):
        state, changes = random_case(rng)
        sdf = spark.createDataFrame([(k, v["name"], v["score"]) for k, v in state.items()], STATE_SCHEMA)
        cdf = spark.createDataFrame(changes, CHANGE_SCHEMA)
        new, rejects = chg.apply_changes(sdf, cdf, bucket_width=97)   # small buckets: exercise the carry
        expected, expected_rejects = replay(state, changes)
        got = {r.key: {"name": r.name, "score": r.score} for r in new.collect()}
        assert got == expected
        assert sorted(r.seq for r in rejects.collect()) == expected_rejects


def test_partial_update_key_presence(spark):
    state = spark.createDataFrame([("a", "x", 1), ("b", "y", 2)], STATE_SCHEMA)
    ups = spark.createDataFrame([("a", 1, '{"score": null}'), ("b", 2, '{"name": "z"}'), ("c", 3, '{"name": "q"}')],
                                "key string, seq bigint, payload string")
    new, rejects = chg.partial_update(state, ups)
    assert sorted(tuple(r) for r in new.collect()) == [("a", "x", None), ("b", "z", 2)]
    assert [r.key for r in rejects.collect()] == ["c"]


def test_create_rejects_existing_and_batch_duplicates(spark):
    state = spark.createDataFrame([("a",)], "id string")
    new = spark.createDataFrame([("a", 0), ("b", 0), ("b", 1), ("c", 5)], "id string, seq int")
    out, rejects = chg.create(state, new, "id")
    assert sorted(r.id for r in out.collect()) == ["a", "b", "c"]
    assert sorted((r.id, r.reason) for r in rejects.collect()) == [("a", "exists"), ("b", "duplicate in batch")]


def test_kpi_match_first_listed_and_missing(spark):
    ins = spark.createDataFrame([("3", "s", "K1 - later"), ("1", "s", "K1 - first"), ("2", "s", "K2"),
                                 ("4", "t", "K1 - other solution")], "id string, solution_id string, name string")
    req = spark.createDataFrame([("s", "K1"), ("s", "K2"), ("s", "K9")], "solution_id string, kpi_id string")
    m = chg.kpi_match(ins, req, order=F.col("id").cast("int"))
    assert sorted(tuple(r) for r in m.collect()) == [("s", "K1", "1"), ("s", "K2", "2"), ("s", "K9", None)]


def test_role_delta_equals_replay(spark):
    rng = random.Random(3)
    assign = {(f"r{i}", f"p{j}"): "viewer" for i in range(5) for j in range(4) if rng.random() < 0.5}
    changes = []
    for seq in range(200):
        pair = (f"r{rng.randrange(5)}", f"p{rng.randrange(4)}")
        changes.append((*pair, seq // 2, rng.choice(["assign", "unassign"]), rng.choice(["viewer", "admin"])))
    expected = dict(assign)
    # equal seq: unassign first, then assign
    for r, p, seq, op, role in sorted(changes, key=lambda c: (c[2], c[3] == "assign")):
        if op == "assign":
            expected[(r, p)] = role
        else:
            expected.pop((r, p), None)
    a = spark.createDataFrame([(r, p, role) for (r, p), role in assign.items()],
                              "resource_id string, principal_id string, role string")
    c = spark.createDataFrame(changes, "resource_id string, principal_id string, seq int, op string, role string")
    got = {(r.resource_id, r.principal_id): r.role for r in roles.role_delta(a, c).collect()}
    # several changes of one pair can share a seq; the replay order among equal (seq, kind) is the
    # input order, the fold's is by role — compare only pairs whose last seq is unambiguous
    last = {}
    for r, p, seq, op, role in changes:
        last.setdefault((r, p), []).append((seq, op == "assign", role))
    for pair, evs in last.items():
        top = max(evs)[:2]
        if sum(1 for e in evs if e[:2] == top) > 1:
            expected.pop(pair, None)
            got.pop(pair, None)
    assert got == expected


def test_stream_fold_equals_batch_fold(spark, tmp_path):
    from vantage.streaming import changes as stream

    rng = random.Random(5)
    state, changes = random_case(rng, n_changes=400)
    sdf = spark.createDataFrame([(k, v["name"], v["score"]) for k, v in state.items()], STATE_SCHEMA)
    cdf = spark.createDataFrame(changes, CHANGE_SCHEMA)
    cdf.repartition(5).write.parquet(str(tmp_path / "src"))          # files in random seq order
    q = stream.start_change_stream(spark, str(tmp_path / "src"), cdf.schema, stream.fields_of(sdf),
                                   str(tmp_path / "fold"), str(tmp_path / "ckpt"), files_per_batch=2)
    q.awaitTermination()
    assert len([p for p in (tmp_path / "fold").iterdir() if p.name.startswith("batch=")]) >= 2
    got = {r.key: (r.name, r.score) for r in stream.current_records(spark, sdf, str(tmp_path / "fold")).collect()}
    expected, _ = replay(state, changes)
    assert got == {k: (v["name"], v["score"]) for k, v in expected.items()}


def test_stream_goes_on_from_its_state(spark, tmp_path):
    """A second run of the query reads new files only, also after the folds were compacted."""
    from vantage.streaming import changes as stream

    rng = random.Random(15)
    state, changes = random_case(rng, n_changes=300)
    sdf = spark.createDataFrame([(k, v["name"], v["score"]) for k, v in state.items()], STATE_SCHEMA)
    for n, part in enumerate((changes[150:], changes[:150])):
        cdf = spark.createDataFrame(part, CHANGE_SCHEMA)
        cdf.coalesce(1).write.mode("append").parquet(str(tmp_path / "src"))
        stream.start_change_stream(spark, str(tmp_path / "src"), cdf.schema, stream.fields_of(sdf),
                                   str(tmp_path / "fold"), str(tmp_path / "ckpt")).awaitTermination()
        if n == 0:
            stream.compact_folds(spark, str(tmp_path / "fold"))
            assert [p.name for p in (tmp_path / "fold").iterdir() if p.name.startswith("batch=")] == ["batch=-1"]
    got = {r.key: (r.name, r.score) for r in stream.current_records(spark, sdf, str(tmp_path / "fold")).collect()}
    expected, _ = replay(state, changes)
    assert got == {k: (v["name"], v["score"]) for k, v in expected.items()}
    assert stream.current_records(spark, sdf, str(tmp_path / "nothing")).count() == sdf.count()


def test_hot_key_fold_across_many_buckets(spark):
    """One key carries most changes (spread over many seq buckets); result equals the replay."""
    rng = random.Random(9)
    state = {"hot": {"name": "h", "score": 0}, "k1": {"name": "a", "score": 1}}
    changes = []
    for seq in range(1200):
        key = "hot" if rng.random() < 0.9 else "k1"
        op = rng.choices(["create", "update", "delete"], [1, 12, 1])[0]
        body = {} if op == "delete" else {"score": seq} if rng.random() < 0.7 else {"name": f"n{seq}"}
        changes.append((key, seq, op, json.dumps(body)))
    sdf = spark.createDataFrame([(k, v["name"], v["score"]) for k, v in state.items()], STATE_SCHEMA)
    cdf = spark.createDataFrame(changes, CHANGE_SCHEMA)
    new, rejects = chg.apply_changes(sdf, cdf, bucket_width=50)      # 24 buckets for the hot key
    expected, expected_rejects = replay(state, changes)
    assert {r.key: {"name": r.name, "score": r.score} for r in new.collect()} == expected
    assert sorted(r.seq for r in rejects.collect()) == expected_rejects


def test_create_without_seq_creates_each_key_once(spark):
    state = spark.createDataFrame([("a", "x")], "id string, name string")
    new = spark.createDataFrame([("b", "q"), ("b", "p"), ("c", "z"), ("c", "z"), ("a", "y")], "id string, name string")
    out, rejects = chg.create(state, new, "id")
    assert sorted(tuple(r) for r in out.collect()) == [("a", "x"), ("b", "p"), ("c", "z")]
    assert sorted((r.id, r.reason) for r in rejects.collect()) == [("a", "exists"), ("b", "duplicate in batch")]


def test_role_assign_without_seq(spark):
    a = spark.createDataFrame([("r1", "p1", "viewer")], "resource_id string, principal_id string, role string")
    one = spark.createDataFrame([("r1", "p1", "editor"), ("r1", "p1", "editor")], a.schema)
    assert [tuple(r) for r in roles.role_assign(a, one).collect()] == [("r1", "p1", "editor")]
    two = spark.createDataFrame([("r1", "p1", "viewer"), ("r1", "p1", "admin")], a.schema)
    with pytest.raises(Exception, match="several roles"):
        roles.role_assign(a, two).collect()


def test_create_ties_and_null_keys(spark):
    state = spark.createDataFrame([], "id string, v string")
    new = spark.createDataFrame([("a", "y", 0), ("a", "x", 0), (None, "n", 1)], "id string, v string, seq int")
    after, rejects = chg.create(state, new, "id")
    assert [tuple(r) for r in after.collect()] == [("a", "x")]
    assert sorted((r.v, r.reason) for r in rejects.collect()) == [("n", "null key"), ("y", "duplicate in batch")]


def test_dpa_entries_defaults(spark):
    req = spark.createDataFrame(
        [("s1", "a", None, None, True, "yes", "c", "t", "staff", "p", "m"),
         ("s1", "b", "active", False, False, "no", "c", "t", "staff", "p", "m")],
        "solution_id string, slug string, status string, toggleable boolean, data_processing_confirmed boolean, "
        "has_personal_data string, data_category string, data_type string, person_group string, purpose string, "
        "safety_measures string")
    got = {r.slug: r for r in chg.dpa_entries_from(req).collect()}
    assert (got["a"].status, got["a"].toggleable) == ("inactive", True)
    assert (got["b"].status, got["b"].toggleable) == ("active", False)
    assert got["a"].attributes.activityAmendments[0].personGroup == "staff"


def test_kpi_match_random_against_python(spark):
    rng = random.Random(21)
    insights = []
    for i in range(200):
        kpi = rng.choice(["K1", "K2", "K3", "K 4", "K-5"])
        name = kpi if rng.random() < 0.2 else f"{kpi} - {rng.choice(['a', 'b - c', ''])}"
        insights.append((str(i), rng.choice(["s1", "s2"]), name, rng.randrange(1000)))
    requests = [(s, k) for s in ("s1", "s2", "s3") for k in ("K1", "K2", "K3", "K 4", "K-5", "K9")]
    expected = {}
    for sol, kpi in requests:
        matches = [(order, iid) for iid, s, name, order in insights if s == sol and name.split(" - ")[0] == kpi]
        expected[(sol, kpi)] = min(matches)[1] if matches else None
    ins = spark.createDataFrame(insights, "id string, solution_id string, name string, pos int")
    req = spark.createDataFrame(requests, "solution_id string, kpi_id string")
    got = {(r.solution_id, r.kpi_id): r.insight_id
           for r in chg.kpi_match(ins, req, order=F.struct(F.col("pos"), F.col("id"))).collect()}
    assert got == expected


def test_faulty_changes_are_rejected_and_change_nothing(spark):
    state = spark.createDataFrame([("a", 5, "x"), ("b", 6, "y")], "key string, score long, name string")
    rows = [("a", 1, "update", '{"score":"abc"}'), ("a", 2, "update", '{"name":"trunc'), ("a", 3, "frobnicate", '{"score":1}'),
            ("a", 4, None, "{}"), ("b", 5, "update", '{"score":null}'), ("b", 6, "update", "[1]"), ("b", 7, "update", None),
            ("c", 8, "create", '{"score":7,"name":[]}'), ("d", 9, "create", '{"score":8}'), ("e", 10, "delete", "junk")]
    changes = spark.createDataFrame(rows, "key string, seq long, op string, payload string")
    new, rejects = chg.apply_changes(state, changes)
    assert sorted(map(tuple, new.collect())) == [("a", 5, "x"), ("b", None, "y"), ("c", 7, "[]"), ("d", 8, None)]
    assert sorted((r.seq, r.reason) for r in rejects.collect()) == [
        (1, "bad value"), (2, "bad payload"), (3, "unknown op"), (4, "unknown op"), (6, "bad payload"), (10, "absent key")]


def test_update_body_sets_the_fields_it_holds(spark):
    state = spark.createDataFrame([("a", 5, "x"), ("b", 6, "y"), ("c", 7, "z")], "key string, score long, name string")
    bodies = spark.createDataFrame([("a", '{"name":"new"}'), ("b", '{"score":null}'), ("c", '{"score":"no"}'), ("d", "{}")],
                                   "key string, payload string")
    assert sorted(map(tuple, chg.update_body(state, bodies).collect())) == [("a", 5, "new"), ("b", None, "y"), ("c", 7, "z")]
