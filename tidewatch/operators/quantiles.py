"""Exact quantiles with linear interpolation, for groups of any size.

`percentile` keeps every distinct value of a group in one task. Here a bounded sketch only
proposes cut points around each wanted rank; the rows are then counted exactly between the cuts,
and values are looked at one by one only inside the few narrow intervals that hold a wanted rank.
A poor sketch would make an interval wider, never a result wrong.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_finite, lookup_bin
from ..session import pinned

_SPLITS = 64  # equal-width pieces of each interval between two cuts


def _cut_points(probs: Sequence[float], accuracy: int) -> list[float]:
    margin = 2.0 / accuracy
    points = {min(max(p + d, 0.0), 1.0) for p in probs for d in (-margin, margin)}
    return sorted(points)


def _piece(value: Column, low: Column, high: Column) -> Column:
    """Which equal-width piece of [low, high) holds the value; 0 in the open outer intervals."""
    width = high - low
    share = F.floor((value - low) / width * F.lit(float(_SPLITS)))
    inside = F.least(F.greatest(share, F.lit(0)), F.lit(_SPLITS - 1))
    usable = low.isNotNull() & high.isNotNull() & (width > 0) & (width < F.lit(float("inf")))
    return F.when(usable, inside).otherwise(F.lit(0)).cast("int")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str, probs: Sequence[float],
                    accuracy: int = 10_000, few_groups: bool = False) -> DataFrame:
    """One row per group: keys, `n` finite values, `quantiles` aligned with `probs`.

    The sketch is written first; it takes one read of the rows, the counts between its points a second one, and the
    values of the few intervals with a wanted rank a third one.

    `few_groups` says that the number of groups is bounded by a declared column list, which makes
    the per-group side tables safe to broadcast; otherwise the optimizer decides from their size.
    """
    keys = list(keys)
    probs = [float(p) for p in probs]
    small = F.broadcast if few_groups else (lambda side: side)

    rows = df.select(*keys, F.col(value).cast("double").alias("_v")).where(is_finite(F.col("_v")))
    cuts = _cut_points(probs, accuracy)
    sketch = pinned(rows.groupBy(*keys).agg(
        F.array_sort(F.array_distinct(F.percentile_approx("_v", cuts, accuracy))).alias("_cuts")))
    slot = lookup_bin(F.col("_v"), F.col("_cuts"))
    located = (
        rows.join(small(sketch), keys)
        .withColumn("_slot", slot)
        .withColumn("_piece", _piece(F.col("_v"), F.get("_cuts", F.col("_slot") - 1),
                                     F.get("_cuts", F.col("_slot"))))
        .drop("_cuts")
    )
    intervals = located.groupBy(*keys, "_slot", "_piece").agg(F.count("*").alias("_count"))

    group = Window.partitionBy(*keys)
    before = group.orderBy("_slot", "_piece").rowsBetween(Window.unboundedPreceding, -1)
    position = [F.lit(p) * (F.col("n") - 1) for p in probs]
    ranks = F.array_distinct(F.concat(
        F.array(*[F.floor(h) for h in position]), F.array(*[F.ceil(h) for h in position])))
    wanted = (
        intervals
        .withColumn("n", F.sum("_count").over(group))
        .withColumn("_base", F.coalesce(F.sum("_count").over(before), F.lit(0)))
        .withColumn("_ranks", F.filter(
            ranks, lambda r: (r >= F.col("_base")) & (r < F.col("_base") + F.col("_count"))))
        .where(F.size("_ranks") > 0)
        .select(*keys, "_slot", "_piece", "n", "_base", "_ranks")
    )

    # Count the values first: carrying the ranks through the aggregate would make it sort-based.
    picked = (
        located.join(small(wanted.select(*keys, "_slot", "_piece")), [*keys, "_slot", "_piece"], "left_semi")
        .groupBy(*keys, "_slot", "_piece", "_v").agg(F.count("*").alias("_count"))
        .join(small(wanted), [*keys, "_slot", "_piece"])
    )
    upto = (Window.partitionBy(*keys, "_slot", "_piece").orderBy("_v")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = (
        picked
        .withColumn("_end", F.col("_base") + F.sum("_count").over(upto))
        .withColumn("_hit", F.explode(F.filter(
            "_ranks", lambda r: (r < F.col("_end")) & (r >= F.col("_end") - F.col("_count")))))
        .groupBy(*keys)
        .agg(F.first("n").alias("n"),
             F.map_from_entries(F.collect_list(F.struct("_hit", "_v"))).alias("_at"))
    )

    def interpolate(position: Column) -> Column:
        low = F.element_at("_at", F.floor(position))
        high = F.element_at("_at", F.ceil(position))
        return low + (high - low) * (position - F.floor(position))

    return found.select(*keys, "n", F.array(*[interpolate(h) for h in position]).alias("quantiles"))
