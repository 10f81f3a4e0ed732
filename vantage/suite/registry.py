"""Registration of suite queries."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn
    return deco


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round double results so that summation order does not change the compared value."""
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


# Averages and quotients can land exactly on a rounding tie, where engines disagree (one rounds
# the shortest decimal form, the other the binary value). Both sides round ``x + NUDGE``: far above
# float error, far below the rounding step, so both land on the same side.
NUDGE = 1e-9


def rounded_ratio(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n) + F.lit(NUDGE), digits) for n in names})
