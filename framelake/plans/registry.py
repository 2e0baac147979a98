"""All named queries."""

from framelake.plans import box_queries, frame_queries, report_queries, stream_queries  # noqa: F401
from framelake.plans.catalog import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
