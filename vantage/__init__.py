"""vantage: insight specifications, parameterised SQL and catalog operations as Spark plans.

Everything here builds lazy DataFrames; nothing is collected to the driver unless a caller
asks for it. See README.md for the module map.
"""

from vantage.session import checkpoint_dir, get_session
from vantage.plans.builder import InsightBuilder, join_on, select_def, where_def
from vantage.plans.insight import run_chart, run_insight
from vantage.plans.sql import execute_sql, export
from vantage.plans.timeout import run_with_timeout
from vantage.operators.charts import chart_frame
from vantage.sources.datasets import DatasetStore
from vantage.sources.tables import TableResolver

__all__ = [
    "get_session", "checkpoint_dir", "InsightBuilder", "join_on", "select_def", "where_def", "run_insight", "run_chart",
    "execute_sql", "export", "run_with_timeout", "chart_frame", "DatasetStore", "TableResolver",
]
