"""Small column expressions with fixed rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A date-only source timestamp is three dash-separated digit groups and gets the
# midnight UTC suffix appended; the KPI id is the text before the first " - " of a name; a table
# column is shown as a number when its label contains "%" or, lower-cased, "anzahl".
DATE_ONLY_PATTERN = r"^[0-9]+-[0-9]+-[0-9]+$"
MIDNIGHT_SUFFIX = "T00:00:00Z"
KPI_SEPARATOR = " - "
NUMBER_LABEL_MARKERS = ("%", "anzahl")


def normalize_source_timestamp(col: Column) -> Column:
    """``YYYY-MM-DD`` (any three digit groups, no calendar check) → ``…T00:00:00Z``; else unchanged."""
    return F.when(col.rlike(DATE_ONLY_PATTERN), F.concat(col, F.lit(MIDNIGHT_SUFFIX))).otherwise(col)


def kpi_id(name: Column) -> Column:
    """Text before the first separator; the whole name when there is none."""
    return F.substring_index(name, KPI_SEPARATOR, 1)


def display_type(label: Column) -> Column:
    pct, word = NUMBER_LABEL_MARKERS
    return F.when(label.contains(pct) | F.lower(label).contains(word), F.lit("number")).otherwise(F.lit("text"))


def search_match(name: Column, search: str | None) -> Column:
    """Case-insensitive substring search; an empty or missing search keeps every row."""
    if not search:
        return F.lit(True)
    return F.lower(name).contains(search.lower())
