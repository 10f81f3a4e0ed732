"""Record validation against a plain-Python statement of the check order."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vantage.operators.validation import validate_records

EXPECTED = (200, 201)
KEYS = ("data", "id")

leaf = st.one_of(st.none(), st.integers(0, 9), st.sampled_from(["x", "id", "data"]))
doc = st.recursive(leaf, lambda inner: st.one_of(
    st.lists(inner, max_size=2),
    st.dictionaries(st.sampled_from(["data", "id", "meta"]), inner, max_size=3)), max_leaves=6)
body = st.one_of(doc.map(json.dumps), st.sampled_from(["{bad", "", "{\"data\": ", "[1,"]))
record = st.tuples(st.sampled_from(["application/json", "text/plain", "application/json; charset=utf-8"]),
                   st.sampled_from([200, 201, 204, 404, 500]), body)


def expected(content_type, status, text):
    if "application/json" not in content_type:
        return None if status in EXPECTED else "http_status"
    try:
        current = json.loads(text)
    except ValueError:
        return "invalid_json"
    if status not in EXPECTED:
        return "http_status"
    for key in KEYS:
        if not isinstance(current, dict) or key not in current:
            return f"missing_key:{key}"
        current = current[key]
    return None


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(records=st.lists(record, min_size=1, max_size=10))
def test_validation_matches_python(spark, records):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(records)],
                               "rid int, content_type string, status int, body string")
    got = {r.rid: r.error for r in validate_records(df, required_keys=KEYS).collect()}
    for i, (ct, status, text) in enumerate(records):
        assert got[i] == expected(ct, status, text), (ct, status, text)
