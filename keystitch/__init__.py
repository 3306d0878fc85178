"""keystitch — feed enrichment on Spark.

Composite-key, first-match, left-outer enrichment of untidy feeds (CSV
directories, workbooks, DataFrames) from a reference table, as DataFrame plans
that Catalyst optimises and AQE re-plans at run time.
"""

import sys as _sys

# Python helpers that run inside tasks (workbook parser, fixture writers) are
# shipped by value with the task, so executors need no installed copy.
try:
    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle
    pass

from .spec import EnrichSpec, DEFAULT_ALIASES, DEFAULT_KEY_COMBINATIONS, DEFAULT_TARGETS
from .plans.headers import (
    NoKeyColumns, MissingReferenceColumns, resolve_headers, detect_keys, missing_targets, plan_layout,
)
from .operators.enrich import (
    enrich, first_per_key, matched, unmatched, distinct_keys, reference_semi, match_stats, where_key,
    missing_key_rows, key_frame,
)

from .job import enrich_directory, run_summary  # noqa: E402
from .streaming.incremental import enrich_incremental, enrich_stream  # noqa: E402

__all__ = [
    "enrich_directory", "run_summary", "enrich_incremental", "enrich_stream",
    "EnrichSpec", "DEFAULT_ALIASES", "DEFAULT_KEY_COMBINATIONS", "DEFAULT_TARGETS",
    "NoKeyColumns", "MissingReferenceColumns", "resolve_headers", "detect_keys", "missing_targets",
    "plan_layout", "enrich", "first_per_key", "matched", "unmatched", "distinct_keys", "reference_semi",
    "match_stats", "where_key", "missing_key_rows", "key_frame",
]
