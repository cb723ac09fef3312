"""Operation messages: evidence ids and error classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: message fragments and defaults of the operation protocol. --
TRANSIENT_MARKERS = [
    "[dbt]",
    "dbt run failed",
    "table or view not found",
    "table_or_view_not_found",
    "unresolved_relation",
    "unresolved_column",
    "analysisexception",
    "no such table",
    "does not exist",
    "not found",
    "path does not exist",
    "metadatachangedexception",
    "concurrentmodificationexception",
    "timeout",
    "timed out",
    "connection refused",
    "temporarily unavailable",
    "dbt failed",
]
DISCOVERY_MISSING_TABLE = "not found in lake tables"
OK = "OPERATION_STATUS_OK"
ALREADY_APPLIED = "OPERATION_STATUS_ALREADY_APPLIED"
TRANSIENT_ERROR = "OPERATION_STATUS_TRANSIENT_ERROR"
PERMANENT_ERROR = "OPERATION_STATUS_PERMANENT_ERROR"
NO_TARGET = "unknown"
NO_PLAN = "no_plan"
NO_IDEMPOTENCY_KEY = "no_idem"
# ------------------------------------------------------------------------------


def _or_default(c: Column, default: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(default))


def evidence_id(target: Column, plan_id: Column, idempotency_key: Column) -> Column:
    """``vault:<target>:<plan>:<idempotency key>`` with defaults for empty parts."""
    return F.concat_ws(
        ":",
        F.lit("vault"),
        _or_default(target, NO_TARGET),
        _or_default(plan_id, NO_PLAN),
        _or_default(idempotency_key, NO_IDEMPOTENCY_KEY),
    )


def is_transient(message: Column) -> Column:
    """Whether a load failure is worth retrying, judged by its message."""
    low = F.lower(F.coalesce(message, F.lit("")))
    found = F.lit(False)
    for marker in TRANSIENT_MARKERS:
        found = found | low.contains(marker)
    return found


def is_transient_discovery(message: Column) -> Column:
    """Whether a discovery failure only means that the table is not there yet."""
    low = F.lower(F.coalesce(message, F.lit("")))
    return low.contains(DISCOVERY_MISSING_TABLE) | (
        low.contains("relation") & low.contains("does not exist")
    )
