import pytest
from pyspark.sql import functions as F

from vantage.operators.filters import predicate
from vantage.plans.spec import SpecError

ROWS = [(1, "abc", True), (2, None, None), (3, "", False), (4, "  ", True), (5, "a%b", False),
        (6, "a_b", None), (7, "ABC", True), (8, "xabcx", False)]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, "id int, s string, b boolean")


def ids(df, op, col="s", value=None):
    dtype = df.schema[col].dataType
    return sorted(r.id for r in df.filter(predicate(F.col(col), op, value, dtype)).collect())


@pytest.mark.parametrize("op,value,expected", [
    ("equals", "abc", [1]),
    ("not_equals", "abc", [3, 4, 5, 6, 7, 8]),          # NULL dropped
    ("like", "a\\%b", [5]),                              # escaped %
    ("like", "a_b", [5, 6]),                             # _ wildcard
    ("not_like", "%b%", [1, 3, 4, 7, 8] if False else [3, 4, 7]),
    ("starts_with", "a", [1, 5, 6]),                     # case-sensitive
    ("ends_with", "c", [1]),
    ("contains", "abc", [1, 8]),
    ("not_contains", "abc", [3, 4, 5, 6, 7]),            # NULL dropped
    ("is_null", None, [2]),
    ("is_not_null", None, [1, 3, 4, 5, 6, 7, 8]),
    ("is_null_or_empty", None, [2, 3]),                  # blank is not empty
    ("is_not_null_or_empty", None, [1, 4, 5, 6, 7, 8]),
    ("greater_than", "abc", [8]),
    ("less_or_equals", "ABC", [3, 4, 7]),
])
def test_string_operators(df, op, value, expected):
    assert ids(df, op, "s", value) == expected


def test_unescaped_percent_is_a_wildcard(df):
    assert ids(df, "like", "s", "a%b") == [5, 6]


@pytest.mark.parametrize("op,expected", [("is_true", [1, 4, 7]), ("is_false", [3, 5, 8]),
                                         ("is_null", [2, 6]), ("is_null_or_empty", [2, 6])])
def test_boolean_operators(df, op, expected):
    assert ids(df, op, "b") == expected


def test_numeric_comparisons(df):
    assert ids(df, "greater_than", "id", 6) == [7, 8]
    assert ids(df, "less_than", "id", 2) == [1]
    assert ids(df, "greater_or_equals", "id", 7) == [7, 8]
    assert ids(df, "like", "id", "%1%") == [1]          # numbers are matched by their text


def test_invalid_operator_and_values(df):
    with pytest.raises(SpecError):
        predicate(F.col("s"), "between", 1)
    with pytest.raises(SpecError):
        predicate(F.col("s"), "equals", None)
    with pytest.raises(SpecError):
        predicate(F.col("s"), "equals", ["a", "b"])
    predicate(F.col("s"), "is_null", "ignored")          # unary operators ignore the value
