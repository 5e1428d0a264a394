"""Column expressions over numbers and statuses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..spec import ALERT, OK, STATUSES, WARNING

INFINITY = float("inf")


def nan_to_null(value: Column) -> Column:
    """NaN orders above every number in Spark; null compares as unknown, which is what is wanted."""
    return F.when(~F.isnan(value), value)


def finite(value: Column) -> Column:
    """The value, or null when it is NaN or infinite (NaN fails the test: it sorts above infinity)."""
    return F.when(F.abs(value) < F.lit(INFINITY), value)


def status_of(value: Column, warn: Column, alert: Column) -> Column:
    """Strict comparison: a value exactly on a threshold keeps the milder status; null is OK."""
    clean = nan_to_null(value)
    return F.when(clean > alert, F.lit(ALERT)).when(clean > warn, F.lit(WARNING)).otherwise(F.lit(OK))


def rank_of(status: Column) -> Column:
    return F.when(status == ALERT, 2).when(status == WARNING, 1).otherwise(0)


def label_of(rank: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in STATUSES]), F.coalesce(rank, F.lit(0)) + 1)


def is_finite(value: Column) -> Column:
    return F.abs(value) < F.lit(INFINITY)


def lookup_bin(value: Column, edges: Column) -> Column:
    """Number of (sorted) edges at or below the value, so that both outer bins are open; null without a value or edges."""
    return F.when(value.isNotNull() & edges.isNotNull(), F.size(F.filter(edges, lambda edge: edge <= value)))


def tally(bins: Column, edges: Column) -> Column:
    """Counts of every bin that the edges make, from a map bin -> count; bins not in the map are empty."""
    return F.transform(F.sequence(F.lit(0), F.size(edges)), lambda b: F.coalesce(F.element_at(bins, b), F.lit(0)).cast("bigint"))
