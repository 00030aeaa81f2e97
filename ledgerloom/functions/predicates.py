"""Null-aware tests. A missing operand never passes a gate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def unless(condition: Column) -> Column:
    """True where the condition is false or cannot be decided."""
    return ~F.coalesce(condition, F.lit(False))


def null_to_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0).cast("bigint"))


def valid_at(
    effective_from: Column, effective_to: Column, event_time: Column | int
) -> Column:
    """Half-open valid time [from, to); a null end is open."""
    moment = F.lit(event_time) if isinstance(event_time, int) else event_time
    return (effective_from <= moment) & (effective_to.isNull() | (moment < effective_to))


def object_evidence_valid(
    bucket: Column, key: Column, version_id: Column, size_bytes: Column, sha256: Column
) -> Column:
    """Bucket, key and version are non-empty, size is at least 1, sha256 has 64 characters."""
    filled = (F.length(bucket) > 0) & (F.length(key) > 0) & (F.length(version_id) > 0)
    return F.coalesce(filled & (size_bytes >= 1) & (F.length(sha256) == 64), F.lit(False))


def tax_cents(subtotal_cents: Column) -> Column:
    """18 percent of a non-negative subtotal, rounded down, in integer arithmetic."""
    return F.call_function("div", subtotal_cents * F.lit(18).cast("bigint"), F.lit(100).cast("bigint"))
