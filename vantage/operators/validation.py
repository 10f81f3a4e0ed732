"""Validation of raw records (content type, status code, JSON body, required nested keys),
in the order the reference checks them, as one projection with an ``error`` column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The statuses accepted by default and the error kinds.
DEFAULT_EXPECTED = (200, 201)
JSON_CONTENT_TYPE = "application/json"


def _missing_key(body: Column, keys: tuple[str, ...]) -> Column:
    """First key of the nested path that is absent (a key with a null value counts as present;
    a non-object on the way means the key is absent)."""
    result = F.lit(None).cast("string")
    path = "$"
    checks = []
    for k in keys:
        node = F.get_json_object(body, path) if path != "$" else body
        checks.append((k, F.coalesce(F.array_contains(F.json_object_keys(node), k), F.lit(False))))
        path = f"{path}['{k}']"  # quoted: a key may hold a dot
    # the first failing key wins: build from the last check backwards
    for k, present in reversed(checks):
        result = F.when(~present, F.lit(k)).otherwise(result)
    return result


def validate_records(df: DataFrame, content_type: str = "content_type", status: str = "status",
                     body: str = "body", expected: tuple[int, ...] = DEFAULT_EXPECTED,
                     required_keys: tuple[str, ...] | None = None) -> DataFrame:
    """Adds ``ok`` and ``error``: ``http_status`` (unexpected status), ``invalid_json``,
    ``missing_key:<key>``, or NULL. Non-JSON content with an expected status is valid and empty."""
    is_json = F.coalesce(F.col(content_type).contains(JSON_CONTENT_TYPE), F.lit(False))
    status_ok = F.coalesce(F.col(status).isin(*expected), F.lit(False))  # no status is not an expected one
    parsed_ok = F.try_parse_json(F.col(body)).isNotNull()
    missing = _missing_key(F.col(body), tuple(required_keys)) if required_keys else F.lit(None).cast("string")
    error = (F.when(~is_json, F.when(status_ok, F.lit(None)).otherwise(F.lit("http_status")))
             .when(~parsed_ok, F.lit("invalid_json"))
             .when(~status_ok, F.lit("http_status"))
             .when(missing.isNotNull(), F.concat(F.lit("missing_key:"), missing)))
    return df.withColumn("error", error.cast("string")).withColumn("ok", F.col("error").isNull())
