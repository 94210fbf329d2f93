"""The registered queries (one per operator family of the inventory) and their
DuckDB oracle SQL.  Importing this package fills ``QUERIES`` and ``ORACLES``."""

from . import (coerce_queries, flagship, flatten_queries, mapping_queries,  # noqa: F401
               payload_queries, plan_queries, run_queries, write_queries)
from ._base import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
