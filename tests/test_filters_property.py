"""Filters against a plain-Python statement of their semantics on random strings."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from vantage.operators.filters import predicate

STRING_OPS = ["equals", "not_equals", "like", "not_like", "starts_with", "ends_with", "contains",
              "not_contains", "is_null", "is_not_null", "greater_than", "less_than", "greater_or_equals",
              "less_or_equals", "is_null_or_empty", "is_not_null_or_empty"]


def like_regex(pattern: str) -> str:
    out, i = [], 0
    while i < len(pattern):
        ch = pattern[i]
        if ch == "\\" and i + 1 < len(pattern):
            out.append(re.escape(pattern[i + 1]))
            i += 2
            continue
        out.append(".*" if ch == "%" else "." if ch == "_" else re.escape(ch))
        i += 1
    return "".join(out)


def expected(op, x, v):
    """True / False / None (SQL NULL) for one row."""
    if op == "is_null":
        return x is None
    if op == "is_not_null":
        return x is not None
    if op == "is_null_or_empty":
        return x is None or x == ""
    if op == "is_not_null_or_empty":
        return x is not None and x != ""
    if x is None:
        return None
    return {
        "equals": x == v, "not_equals": x != v,
        "like": re.fullmatch(like_regex(v), x, re.S) is not None,
        "not_like": re.fullmatch(like_regex(v), x, re.S) is None,
        "starts_with": x.startswith(v), "ends_with": x.endswith(v),
        "contains": v in x, "not_contains": v not in x,
        "greater_than": x.encode() > v.encode(), "less_than": x.encode() < v.encode(),
        "greater_or_equals": x.encode() >= v.encode(), "less_or_equals": x.encode() <= v.encode(),
    }[op]


texts = st.text(alphabet="ab%_ ", max_size=4)
patterns = st.lists(st.sampled_from(["a", "b", "%", "_", " ", "\\%", "\\_"]), max_size=4).map("".join)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), texts), min_size=1, max_size=8), pattern=patterns)
def test_string_filters_match_python_semantics(spark, values, pattern):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    cols = [predicate(F.col("s"), op, pattern, StringType()).alias(op) for op in STRING_OPS]
    rows = {r.i: r for r in df.select("i", *cols).collect()}
    for i, x in enumerate(values):
        for op in STRING_OPS:
            want = expected(op, x, pattern)
            got = rows[i][op]
            assert (got is True) == (want is True), (op, x, pattern, got, want)
