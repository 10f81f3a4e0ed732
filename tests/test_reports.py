import json
import random

import pytest

from vantage.operators import reports as rep
from vantage.functions.jsonwalk import widget_ids as _widget_ids


def random_doc(rng, depth=0):
    if depth > 5 or rng.random() < 0.2:
        return rng.choice(["t", 1, None, True, ""])
    if rng.random() < 0.4:
        return [random_doc(rng, depth + 1) for _ in range(rng.randrange(4))]
    node = {}
    if rng.random() < 0.5:
        node["type"] = rng.choice(["widget", "p", "column", 3])
    if rng.random() < 0.5:
        node["widgetData"] = rng.choice([{"insightId": rng.choice(["a", "b", "c", "", None])}, {}, None])
    if rng.random() < 0.7:
        node["children"] = [random_doc(rng, depth + 1) for _ in range(rng.randrange(4))]
    return node


def walk(doc, out):
    """Plain recursive reference of the extraction rule."""
    if isinstance(doc, dict):
        if doc.get("type") == "widget" and "widgetData" in doc:
            wd = doc["widgetData"]
            iid = wd.get("insightId") if isinstance(wd, dict) else None
            if iid:
                out.add(iid)
        for v in doc.values():
            if isinstance(v, (dict, list)):
                walk(v, out)
    elif isinstance(doc, list):
        for v in doc:
            if isinstance(v, (dict, list)):
                walk(v, out)
    return out


@pytest.mark.parametrize("method", ["map", "sql"])
def test_widget_extraction_equals_walk(spark, method):
    rng = random.Random(11)
    docs = [(f"r{i}", json.dumps(random_doc(rng))) for i in range(150)] + [("bad", "{not json"), ("none", None)]
    df = spark.createDataFrame(docs, "report_id string, structure string")
    got = {(r.report_id, r.insight_id) for r in rep.extract_widgets(spark, df, method=method).collect()}
    expected = {(rid, iid) for rid, text in docs[:150] for iid in walk(json.loads(text), set())}
    assert got == expected


def test_widget_walk_takes_two_levels_at_a_time(spark, monkeypatch):
    """Widgets on odd and even levels, in arrays of arrays; ten levels are one job's work and one written table."""
    def widget(iid, **more):
        return {"type": "widget", "widgetData": {"insightId": iid}, **more}
    doc = {"a": [[widget("w3", x={"y": [widget("w6", z=[{"end": ""}])]})], widget("w2"), [[widget("w4")], 5, None, "s"]],
           "b": widget("w1", type2={"type": "widget"}), "c": {"type": "p", "widgetData": {"insightId": "no"}},
           "d": {"type": "widget", "widgetData": ["no"]}, "e": {"type": "widget", "widgetData": {"insightId": ""}}}
    docs = [("r", json.dumps(doc)), ("r", json.dumps([[widget("w3"), widget("top")], widget("w3")])), (None, json.dumps(widget("w0")))]
    paths = []
    monkeypatch.setattr(rep, "scratch_path", lambda *a, real=rep.scratch_path: paths.append(real(*a)) or paths[-1])
    got = rep.extract_widgets(spark, spark.createDataFrame(docs, "report_id string, structure string"), method="sql").collect()
    expected = [(rid, iid) for rid, text in docs for iid in walk(json.loads(text), set())]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert len(paths) == 1


def test_widget_ids_deep_document():
    doc = {"type": "widget", "widgetData": {"insightId": "top"}}
    for _ in range(3000):       # deeper than Python's recursion limit
        doc = {"children": [doc]}
    assert _widget_ids(doc) == {"top"}


def test_diff_assemble_table(spark):
    cur = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "z")], "report_id string, insight_id string")
    new = spark.createDataFrame([("r1", "b"), ("r1", "c")], "report_id string, insight_id string")
    diff = {tuple(r) for r in rep.reference_diff(cur, new).collect()}
    assert diff == {("r1", "c", "add"), ("r1", "a", "remove")}    # r2 untouched: no new structure
    blocks = spark.createDataFrame([("r", 2, '{"b":2}', "y"), ("r", 1, '{"b":1}', "x"), ("r", 3, '{"b":3}', "x"),
                                    ("r", 4, '{"p":1}', None), ("r", 5, '{"w":""}', "")],
                                   "report_id string, pos int, block string, insight_id string")
    row = rep.assemble(blocks).collect()[0]
    assert row.structure == '{"editorState": [{"b":1}, {"b":2}, {"b":3}, {"p":1}, {"w":""}]}'
    assert row.insights == ["x", "y"]
    rows = spark.createDataFrame([(1, 2, ["c", "d"]), (1, 1, ["h1", "h2"])], "table_id int, row_nr int, cells array<string>")
    block = json.loads(rep.table_blocks(rows).collect()[0].block)
    assert [[c["type"] for c in tr["children"]] for tr in block["children"]] == [["th", "th"], ["td", "td"]]
    assert block["children"][1]["children"][0]["children"] == [{"text": "c"}]
    plain = json.loads(rep.table_blocks(rows, has_header=False).collect()[0].block)
    assert plain["children"][0]["children"][0]["type"] == "td"


def test_assemble_in_sections_concatenates_to_the_whole(spark):
    rows = [("r", pos, f'{{"b":{pos}}}', f"i{pos % 4}") for pos in range(1, 24)]
    blocks = spark.createDataFrame(rows, "report_id string, pos int, block string, insight_id string")
    whole = rep.assemble(blocks).collect()[0]
    parts = sorted(rep.assemble(blocks, section_size=5).collect(), key=lambda r: r.section)
    assert len(parts) == 5
    assert '{"editorState": [' + ", ".join(p.blocks for p in parts) + "]}" == whole.structure
    merged = []
    for p in parts:
        merged += [i for i in p.insights if i not in merged]
    assert merged == whole.insights


def test_assemble_random_against_python(spark):
    rng = random.Random(31)
    rows = []
    for r in range(30):
        for _ in range(rng.randrange(1, 8)):
            pos = rng.randrange(1, 5)                       # ties on purpose
            iid = rng.choice(["a", "b", "c", "", None])
            rows.append((f"r{r}", pos, json.dumps({"b": rng.randrange(100)}), iid))
    rng.shuffle(rows)
    blocks = spark.createDataFrame(rows, "report_id string, pos int, block string, insight_id string")
    got = {r.report_id: (r.structure, list(r.insights)) for r in rep.assemble(blocks).collect()}
    for rid in {r[0] for r in rows}:
        # Spark sorts the (pos, block, insight_id) structs with NULL ids first
        mine = sorted(((p, b, i) for rr, p, b, i in rows if rr == rid),
                      key=lambda t: (t[0], t[1], (t[2] is not None, t[2] or "")))
        structure = '{"editorState": [' + ", ".join(b for _, b, _ in mine) + "]}"
        insights = []
        for _, _, i in mine:
            if i and i not in insights:
                insights.append(i)
        assert got[rid] == (structure, insights), rid


def test_widget_walk_goes_on_with_documents_that_are_still_open(spark):
    """Documents of very different depth: each is followed to its end, in the round it takes."""
    def nested(depth):
        doc = {"type": "widget", "widgetData": {"insightId": f"at{depth}"}}
        for i in range(depth):
            doc = [doc] if i % 2 else {"children": doc, "type": "widget", "widgetData": {"insightId": f"w{i}"}}
        return doc
    depths = [0, 1, 7, 8, 9, 30, 120]
    df = spark.createDataFrame([(f"r{d}", json.dumps(nested(d))) for d in depths], "report_id string, structure string")
    got = {(r.report_id, r.insight_id) for r in rep.extract_widgets(spark, df, method="sql").collect()}
    assert got == {(f"r{d}", iid) for d in depths for iid in walk(nested(d), set())}
    plan = rep.extract_widgets(spark, df, method="sql")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_sections_concatenate_to_the_whole(spark):
    rng = random.Random(8)
    rows = [(f"r{r}", pos, f'{{"b":{pos}}}', rng.choice(["a", "b", "c", "d", "", None])) for r in range(4) for pos in range(1, 30 * r + 2)]
    blocks = spark.createDataFrame(rows, "report_id string, pos int, block string, insight_id string")
    whole = {r.report_id: r for r in rep.assemble(blocks).collect()}
    parts = rep.assemble_sections(blocks, section_size=7).collect()
    for rid, row in whole.items():
        mine = sorted((p for p in parts if p.report_id == rid), key=lambda p: p.section)
        assert '{"editorState": [' + ", ".join(p.blocks for p in mine) + "]}" == row.structure
        assert [i for p in mine for i in p.insights] == list(row.insights)


def test_table_sections_concatenate_to_the_block(spark):
    rows = [(t, n, [f"{t}{n}", 'q"uote']) for t in range(3) for n in range(5, 5 + 9 * t + 1)]
    df = spark.createDataFrame(rows, "table_id int, row_nr int, cells array<string>")
    for header in (True, False):
        blocks = {r.table_id: r.block for r in rep.table_blocks(df, has_header=header).collect()}
        parts = rep.table_sections(df, has_header=header, section_size=4).collect()
        for t, block in blocks.items():
            mine = ",".join(p.rows for p in sorted((p for p in parts if p.table_id == t), key=lambda p: p.section))
            assert block == f'{{"type":"table","id":"t{t}","children":[{mine}]}}'


def test_reference_diff_exchanges_each_list_once(spark):
    """Repeated rows, null keys (which meet nothing) and reports out of scope, with two exchanges and no full join."""
    keys = "report_id string, insight_id string"
    current = spark.createDataFrame([("a", "x"), ("a", "x"), ("a", "y"), ("a", None), (None, "x"), ("b", "x"), ("c", "z")], keys)
    new = spark.createDataFrame([("a", "y"), ("a", "z"), ("a", "z"), ("a", None), (None, "x"), ("c", "w")], keys)
    scope = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "report_id string")
    change = [("a", None, "add"), ("a", None, "remove"), ("a", "x", "remove"), ("a", "z", "add")]
    out = rep.reference_diff(current, new, scope)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(change + [("b", "x", "remove")], key=str)
    assert "FullOuter" not in out._jdf.queryExecution().optimizedPlan().toString()
    out = rep.reference_diff(current, new)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        change + [(None, "x", "add"), ("c", "w", "add"), ("c", "z", "remove")], key=str)
