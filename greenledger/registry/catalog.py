"""All registered queries and their SQL."""

from greenledger.registry import (  # noqa: F401
    choice_queries, flow_queries, labor_queries, plan_queries, synth_queries, table_queries,
)
from greenledger.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
