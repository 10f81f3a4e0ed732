"""Column expressions shared by operators (all built-in Spark functions, no UDFs)."""

from vantage.functions.expressions import display_type, kpi_id, normalize_source_timestamp, search_match

__all__ = ["display_type", "kpi_id", "normalize_source_timestamp", "search_match"]
