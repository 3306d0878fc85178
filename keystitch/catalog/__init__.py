"""Registered queries: one per operator of the inventory, each a Spark plan
over the driver's tables (or files Spark writes from them), with a DuckDB twin
where the semantics are expressible in SQL."""

from .registry import QUERIES, ORACLES, register  # noqa: F401
from . import frames, files, workbooks, reports, incremental, odd  # noqa: F401  (registration side effects)
