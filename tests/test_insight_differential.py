"""Random insight specs against DuckDB: the same random choices become a spec for the planner and
SQL text for DuckDB over the same rows."""

import duckdb
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vantage.plans.builder import InsightBuilder, join_on, where_def
from vantage.plans.insight import run_insight

CUST = pd.DataFrame({"ck": [1, 2, 3, 4, 5, 6], "seg": ["A", "B", "A", None, "C", "B"],
                     "score": [10, 20, None, 40, 50, 60]})
ORDERS = pd.DataFrame({"ok": list(range(100, 112)), "ck": [1, 1, 2, 3, 3, 3, 5, 7, 7, 2, 6, 1],
                       "amt": [5.5, 7.0, 1.25, 2.0, None, 3.5, 9.0, 4.0, 4.5, 8.0, 0.5, 2.5],
                       "st": ["F", "O", "F", None, "O", "F", "P", "O", "F", "P", "F", "O"]})

FILTERS = [  # (dataset, column, operator, value, SQL)
    ("c", "seg", "equals", "A", "c.seg = 'A'"),
    ("c", "seg", "is_null", None, "c.seg IS NULL"),
    ("c", "score", "greater_than", 15, "c.score > 15"),
    ("o", "st", "not_equals", "O", "o.st <> 'O'"),
    ("o", "amt", "less_or_equals", 5, "o.amt <= 5"),
    ("o", "st", "is_not_null_or_empty", None, "(o.st IS NOT NULL AND o.st <> '')"),
    ("o", "ok", "like", "10%", "CAST(o.ok AS VARCHAR) LIKE '10%'"),
    ("c", "seg", "not_contains", "B", "NOT contains(c.seg, 'B')"),
    ("c", "seg", "starts_with", "A", "starts_with(c.seg, 'A')"),
    ("o", "amt", "greater_or_equals", 4.0, "o.amt >= 4.0"),
    ("c", "seg", "is_null_or_empty", None, "(c.seg IS NULL OR c.seg = '')"),
]
KEYS = [("c", "seg"), ("o", "st"), ("c", "ck")]
AGGS = [("o", "amt", "sum"), ("o", "ok", "count"), ("o", "amt", "min"), ("o", "amt", "max"),
        ("o", "st", "count_distinct"), ("c", "score", "max")]
SQL_AGG = {"sum": "sum({})", "count": "count({})", "min": "min({})", "max": "max({})",
           "count_distinct": "count(DISTINCT {})"}


@pytest.fixture(scope="module")
def frames(spark):
    return {"c": spark.createDataFrame(CUST.astype(object).where(CUST.notna(), None),
                                       "ck long, seg string, score double"),
            "o": spark.createDataFrame(ORDERS.astype(object).where(ORDERS.notna(), None),
                                       "ok long, ck long, amt double, st string")}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.register("c", CUST.astype({"score": "float64"}))
    c.register("o", ORDERS)
    return c


def _norm(rows):
    def v(x):
        if x is None or (isinstance(x, float) and pd.isna(x)):
            return None
        return round(float(x), 6) if isinstance(x, (int, float)) and not isinstance(x, bool) else x
    return sorted((tuple(v(x) for x in r) for r in rows), key=lambda t: tuple((e is None, str(e)) for e in t))


@settings(max_examples=30, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(how=st.sampled_from(["inner", "left"]),
       filters=st.lists(st.sampled_from(FILTERS), max_size=2, unique=True),
       keys=st.lists(st.sampled_from(KEYS), min_size=1, max_size=2, unique=True),
       aggs=st.lists(st.sampled_from(AGGS), min_size=1, max_size=3, unique=True),
       having=st.booleans())
def test_random_specs_match_duckdb(frames, con, how, filters, keys, aggs, having):
    b = InsightBuilder().add_dataset("c").add_dataset("o", how, [join_on("c", "ck", "o", "ck")])
    select_sql, group_sql = [], []
    for i, (ds, col) in enumerate(keys):
        b.add_select(col, ds, label=f"k{i}")
        select_sql.append(f"{ds}.{col} AS k{i}")
        group_sql.append(f"{ds}.{col}")
    for i, (ds, col, agg) in enumerate(aggs):
        b.add_select(col, ds, agg, f"a{i}")
        select_sql.append(SQL_AGG[agg].format(f"{ds}.{col}") + f" AS a{i}")
    where_sql = []
    for ds, col, op, value, sql in filters:
        b.add_filter(col, op, value, dataset_id=ds)
        where_sql.append(sql)
    having_sql = ""
    if having:
        b.add_filter_defs([where_def("ok", "o", "greater_than", 1, aggregate="count")])
        having_sql = " HAVING count(o.ok) > 1"
    sql = (f"SELECT {', '.join(select_sql)} FROM c {'JOIN' if how == 'inner' else 'LEFT JOIN'} o ON c.ck = o.ck"
           + (f" WHERE {' AND '.join(where_sql)}" if where_sql else "")
           + f" GROUP BY {', '.join(group_sql)}{having_sql}")
    got = run_insight(b.build(), frames.__getitem__)
    want = con.execute(sql).fetchall()
    assert _norm([tuple(r) for r in got.collect()]) == _norm(want), sql


PIVOT_VALUES = ["F", "O", "P"]
PIVOT_SQL = {"sum": "sum(CASE WHEN o.st = '{v}' THEN o.amt END)", "count": "count(CASE WHEN o.st = '{v}' THEN o.ok END)",
             "max": "max(CASE WHEN o.st = '{v}' THEN o.amt END)", "min": "min(CASE WHEN o.st = '{v}' THEN o.amt END)"}


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(row=st.sampled_from([("c", "seg"), ("c", "ck")]),
       measures=st.lists(st.sampled_from(["sum", "count", "max", "min"]), min_size=1, max_size=2, unique=True),
       how=st.sampled_from(["inner", "left"]))
def test_random_pivots_match_duckdb(frames, con, row, measures, how):
    b = (InsightBuilder().add_dataset("c").add_dataset("o", how, [join_on("c", "ck", "o", "ck")])
         .add_select(row[1], row[0], label="r").add_select("st", "o", label="status"))
    for m in measures:
        b.add_select("ok" if m == "count" else "amt", "o", m, m)
    b.set_pivot(rows=["r"], columns=[{"label": "status", "values": PIVOT_VALUES}], values=list(measures))
    got = run_insight(b.build(), frames.__getitem__)
    cols = []
    for v in PIVOT_VALUES:
        for m in measures:
            name = v if len(measures) == 1 else f"{v}_{m}"
            cols.append(PIVOT_SQL[m].format(v=v) + f' AS "{name}"')
    sql = (f"SELECT {row[0]}.{row[1]} AS r, {', '.join(cols)} FROM c "
           f"{'JOIN' if how == 'inner' else 'LEFT JOIN'} o ON c.ck = o.ck GROUP BY {row[0]}.{row[1]}")
    res = con.execute(sql)
    assert got.columns == [d[0] for d in res.description]
    assert _norm([tuple(r) for r in got.collect()]) == _norm(res.fetchall()), sql


ORDERABLE = [("o", "amt", "sum"), ("o", "ok", "count"), ("o", "amt", "max"), ("o", "amt", "min")]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.sampled_from(KEYS), min_size=1, max_size=2, unique=True),
       orders=st.lists(st.tuples(st.sampled_from(ORDERABLE), st.sampled_from(["asc", "desc"])), max_size=2),
       limit=st.integers(min_value=0, max_value=6),
       how=st.sampled_from(["inner", "left"]))
def test_random_order_and_limit_match_duckdb(frames, con, keys, orders, limit, how):
    b = (InsightBuilder().add_dataset("c").add_dataset("o", how, [join_on("c", "ck", "o", "ck")])
         .add_select("amt", "o", "sum", "total"))
    select_sql, group_sql, order_sql = ["sum(o.amt) AS total"], [], []
    for i, (ds, col) in enumerate(keys):
        b.add_select(col, ds, label=f"k{i}")
        select_sql.append(f"{ds}.{col} AS k{i}")
        group_sql.append(f"{ds}.{col}")
    for (ds, col, agg), direction in orders:   # aggregates, selected or not
        b.add_order_by(col, ds, agg, direction)
        order_sql.append(f"{SQL_AGG[agg].format(f'{ds}.{col}')} {direction.upper()} NULLS LAST")
    for ds, col in keys:                         # keys make the order total
        b.add_order_by(col, ds)
        order_sql.append(f"{ds}.{col} ASC NULLS LAST")
    b.set_limit(limit)
    sql = (f"SELECT {', '.join(select_sql)} FROM c {'JOIN' if how == 'inner' else 'LEFT JOIN'} o ON c.ck = o.ck "
           f"GROUP BY {', '.join(group_sql)} ORDER BY {', '.join(order_sql)} LIMIT {limit}")
    got = [tuple(r) for r in run_insight(b.build(), frames.__getitem__).collect()]
    want = con.execute(sql).fetchall()
    norm = lambda rows: [tuple(None if x is None or (isinstance(x, float) and pd.isna(x))
                               else (round(float(x), 6) if isinstance(x, (int, float)) else x) for x in r)
                         for r in rows]
    assert norm(got) == norm(want), sql


REGIONS = pd.DataFrame({"rk": [1, 2, 3], "rname": ["N", "S", "E"]})
CUST_RK = [1, 2, 1, 2, None, 3]   # region of each customer row


@pytest.fixture(scope="module")
def chain_frames(spark, frames):
    c = CUST.assign(rk=CUST_RK)
    return {**frames,
            "c": spark.createDataFrame(c.astype(object).where(c.notna(), None),
                                       "ck long, seg string, score double, rk long"),
            "r": spark.createDataFrame(REGIONS, "rk long, rname string")}


@pytest.fixture(scope="module")
def chain_con():
    c = duckdb.connect()
    c.register("c", CUST.assign(rk=pd.array(CUST_RK, dtype="Int64")).astype({"score": "float64"}))
    c.register("o", ORDERS)
    c.register("r", REGIONS)
    return c


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(order=st.sampled_from(["r-c-o", "c-o-r", "o-c-r"]),
       hows=st.tuples(st.sampled_from(["inner", "left"]), st.sampled_from(["inner", "left"])),
       key=st.sampled_from([("r", "rname"), ("c", "seg"), ("o", "st")]),
       aggs=st.lists(st.sampled_from([("o", "amt", "sum"), ("o", "ok", "count"), ("o", "amt", "max"),
                                      ("o", "amt", "avg")]), min_size=1, max_size=2, unique=True))
def test_random_chains_match_duckdb(chain_frames, chain_con, order, hows, key, aggs):
    conds = {("c", "o"): ("c", "ck", "o", "ck"), ("o", "c"): ("o", "ck", "c", "ck"),
             ("r", "c"): ("r", "rk", "c", "rk"), ("c", "r"): ("c", "rk", "r", "rk")}
    seq = order.split("-")
    b = InsightBuilder().add_dataset(seq[0])
    sql = f"SELECT {key[0]}.{key[1]} AS k"
    from_sql = seq[0]
    for i, ds in enumerate(seq[1:]):
        left = "c" if ds != "c" else seq[0]            # every step joins on the customer table
        lds, lcol, rds, rcol = conds[(left, ds)]
        b.add_dataset(ds, hows[i], [join_on(lds, lcol, rds, rcol)])
        from_sql += f" {'JOIN' if hows[i] == 'inner' else 'LEFT JOIN'} {ds} ON {lds}.{lcol} = {rds}.{rcol}"
    b.add_select(key[1], key[0], label="k")
    for i, (ds, col, agg) in enumerate(aggs):
        b.add_select(col, ds, agg, f"a{i}")
        sql += f", {agg}({ds}.{col}) AS a{i}"
    sql += f" FROM {from_sql} GROUP BY {key[0]}.{key[1]}"
    got = run_insight(b.build(), chain_frames.__getitem__)
    assert _norm([tuple(r) for r in got.collect()]) == _norm(chain_con.execute(sql).fetchall()), sql
