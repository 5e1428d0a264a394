"""Reference statistics of a training split: profiles, quantile bins, category frequencies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_finite, lookup_bin, nan_to_null, tally
from ..session import pinned
from ..spec import PREDICTION_SERIES, TARGET_SERIES, FeatureSpec
from .quantiles import exact_quantiles
from .shaping import global_position, to_series

PROFILE_PROBS = {"p01": 0.01, "p25": 0.25, "p50": 0.50, "p75": 0.75, "p99": 0.99}


def bin_probs(n_bins: int) -> list[float]:
    return [i / n_bins for i in range(n_bins + 1)]


def _profile_of(series: DataFrame, keys: list[str], marks: DataFrame, probs: Sequence[float]) -> DataFrame:
    value = nan_to_null(F.col("value"))
    stats = series.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    points = [F.get("quantiles", F.lit(list(probs).index(p))).alias(name) for name, p in PROFILE_PROBS.items()]
    return stats.join(marks.select(*keys, *points), keys, "left")


def _edges_of(marks: DataFrame, keys: list[str], probs: Sequence[float], n_bins: int, digits: int | None) -> DataFrame:
    places = [list(probs).index(p) for p in bin_probs(n_bins)]
    points = F.array(*[F.get("quantiles", F.lit(i)) for i in places])
    if digits is not None:
        points = F.transform(points, lambda q: F.round(q, digits))
    distinct = F.array_sort(F.array_distinct(points))
    inner = F.when(F.size(distinct) >= 3, F.slice(distinct, F.lit(2), F.size(distinct) - 2)) \
        .otherwise(F.array().cast("array<double>"))
    return marks.select(*keys, inner.alias("edges"))


def describe_series(series: DataFrame, keys: Sequence[str] = ("series",), accuracy: int = 10_000,
                    few_groups: bool = True) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact percentiles of (keys, value)."""
    keys, probs = list(keys), list(PROFILE_PROBS.values())
    return _profile_of(series, keys, exact_quantiles(series, keys, "value", probs, accuracy, few_groups), probs)


def quantile_edges(series: DataFrame, n_bins: int = 10, digits: int | None = None,
                   keys: Sequence[str] = ("series",), accuracy: int = 10_000,
                   few_groups: bool = True) -> DataFrame:
    """Interior bin edges of every series: de-duplicated quantiles without the two extremes."""
    keys, probs = list(keys), bin_probs(n_bins)
    return _edges_of(exact_quantiles(series, keys, "value", probs, accuracy, few_groups), keys, probs, n_bins, digits)


def profile_and_bins(series: DataFrame, n_bins: int = 10, digits: int | None = None,
                     accuracy: int = 10_000) -> tuple[DataFrame, DataFrame]:
    """(profile, bins) of every series from one set of quantiles."""
    probs = sorted({*bin_probs(n_bins), *PROFILE_PROBS.values()})
    # one row per declared series, needed by the profile, the edges and the counts
    marks = pinned(exact_quantiles(series, ["series"], "value", probs, accuracy, few_groups=True))
    edges = _edges_of(marks, ["series"], probs, n_bins, digits)
    return _profile_of(series, ["series"], marks, probs), _with_freqs(series, edges)


def bin_counts(series: DataFrame, edges: DataFrame, keys: Sequence[str] = (), few_series: bool = True,
               with_edges: bool = False) -> DataFrame:
    """Rows per bin for every (keys, series), as one array; non-finite values are left out.

    The edges say how many bins there are. Counts are folded per bin before the shuffle, which then carries one row
    per task and bin however many rows a key holds.
    """
    side = F.broadcast(edges) if few_series else edges
    binned = (
        series.join(side, "series")
        .where(is_finite(F.col("value")))
        .select(*keys, "series", lookup_bin(F.col("value"), F.col("edges")).alias("_bin"))
    )
    counted = (
        binned.groupBy(*keys, "series", "_bin").agg(F.count("*").alias("_n"))
        .groupBy(*keys, "series").agg(F.map_from_entries(F.collect_list(F.struct("_bin", "_n"))).alias("_tally"))
        .join(side, "series").withColumn("counts", tally(F.col("_tally"), F.col("edges")))
    )
    return counted.select(*keys, "series", "counts", *(["edges"] if with_edges else []))


def as_frequencies(counts):
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, c: a + c)
    return F.transform(counts, lambda c: c / F.greatest(total, F.lit(1)))


def make_bins(series: DataFrame, n_bins: int = 10, digits: int | None = None,
              accuracy: int = 10_000) -> DataFrame:
    """(series, edges, freqs): the reference histogram of every series."""
    return _with_freqs(series, quantile_edges(series, n_bins, digits, accuracy=accuracy))


def _with_freqs(series: DataFrame, edges: DataFrame) -> DataFrame:
    counts = bin_counts(series, edges, with_edges=True)
    return counts.select("series", "edges", as_frequencies(F.col("counts")).alias("freqs"))


def category_frequencies(series: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Share of each lower-case level among the non-null values of (keys, value)."""
    counts = (
        series.select(*keys, F.lower("value").alias("category")).where("category IS NOT NULL")
        .groupBy(*keys, "category").agg(F.count("*").alias("n"))
    )
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    return counts.join(totals, list(keys)).select(
        *keys, "category", "n", (F.col("n") / F.col("_total")).alias("freq"))


def reference_series(train: DataFrame, validation: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Training features and target, and the predictions made on validation, as series."""
    columns = {name: F.col(name) for name in spec.numeric} | {TARGET_SERIES: F.col(spec.target)}
    return to_series(train, [], columns).unionByName(
        to_series(validation, [], {PREDICTION_SERIES: F.col(spec.prediction)}))


def value_counts(series: DataFrame, keys: Sequence[str] = ("feature",)) -> DataFrame:
    """Counts and proportions per level, most frequent first within a key.

    A key with as many levels as rows is sorted over all tasks: places count from the first one of the key.
    """
    counted = category_frequencies(series, keys).withColumn("_less", -F.col("n"))
    placed = global_position(counted, [*keys, "_less", "category"], "_place").drop("_less")
    first = placed.groupBy(*keys).agg(F.min("_place").alias("_first"))
    return placed.join(first, list(keys)).withColumn(
        "position", (F.col("_place") - F.col("_first") + 1).cast("int")).drop("_place", "_first")
