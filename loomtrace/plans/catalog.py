"""All registered queries: importing a module of queries registers them."""

from loomtrace.plans import file_queries, memory_queries, office_queries, replay_queries, store_queries, table_queries, web_queries  # noqa: F401
from loomtrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
