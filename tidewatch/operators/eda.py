"""Exploratory statistics of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import is_finite, nan_to_null
from .moments import pair_moments
from .quantiles import exact_quantiles
from .shaping import to_series


def shape(df: DataFrame) -> DataFrame:
    """(column, type, position, n_rows, n_columns), one row per column."""
    columns = [F.struct(F.lit(name).alias("column"), F.lit(kind).alias("type"), F.lit(i).alias("position"))
               for i, (name, kind) in enumerate(df.dtypes)]
    size = df.agg(F.count("*").alias("n_rows"))
    return size.select(F.explode(F.array(*columns)).alias("c"), "n_rows").select(
        "c.*", "n_rows", F.lit(len(df.columns)).alias("n_columns"))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, n_null) from one aggregate."""
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return nulls.unpivot([], df.columns, "column", "n_null")


def duplicate_summary(df: DataFrame) -> DataFrame:
    """Rows, distinct rows, and rows that repeat an earlier one."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.sum("_n").alias("n_rows"), F.count("*").alias("n_distinct"),
        (F.sum("_n") - F.count("*")).alias("n_duplicates"))


def all_copies(df: DataFrame, chunk: int = 10_000) -> DataFrame:
    """Every row that occurs more than once, with its number of copies.

    Copies are equal, so they are counted with a map-side combine and written out again from the counts: first as
    chunks of at most `chunk` copies, which are spread over the tasks, so that no task writes all copies of one row.
    """
    counts = df.groupBy(*df.columns).agg(F.count("*").alias("n_copies")).where("n_copies > 1")
    chunks = counts.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("n_copies") - 1) / chunk)))).hint("rebalance")
    size = F.least(F.lit(chunk), F.col("n_copies") - F.col("_chunk") * chunk)
    return chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1), size))).drop("_chunk", "_copy")


def _corrected_skewness(value: Column) -> Column:
    n = F.count(value)
    return F.when(n > 2, F.skewness(value) * F.sqrt(n * (n - 1.0)) / (n - 2.0))


def _corrected_kurtosis(value: Column) -> Column:
    n = F.count(value)
    return F.when(n > 3, (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * F.kurtosis(value) + 6.0))


def moments(series: DataFrame, keys: Sequence[str] = ("series",), few_groups: bool = True) -> DataFrame:
    """Mean, median, sample deviation, extremes, bias-corrected skewness and excess kurtosis."""
    value = nan_to_null(F.col("value"))
    stats = series.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"),
        _corrected_skewness(value).alias("skewness"), _corrected_kurtosis(value).alias("kurtosis"))
    middle = exact_quantiles(series, keys, "value", [0.5], few_groups=few_groups)
    return stats.join(middle.select(*keys, F.get("quantiles", F.lit(0)).alias("median")), list(keys), "left")


def log_moments(df: DataFrame, column: str) -> DataFrame:
    """Skewness and kurtosis before and after log1p, one row per scale."""
    both = to_series(df, [], {"raw": F.col(column), "log1p": F.log1p(column)})
    value = nan_to_null(F.col("value"))
    return both.groupBy("series").agg(_corrected_skewness(value).alias("skewness"),
                                      _corrected_kurtosis(value).alias("kurtosis"))


def group_statistics(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Count, mean, median, sample deviation, min and max of a column per group."""
    return moments(df.select(*keys, F.col(column).alias("value")), keys, few_groups=False) \
        .drop("skewness", "kurtosis")


def mean_ratio(df: DataFrame, flag: Column, column: str) -> DataFrame:
    """Mean where the flag holds over the mean where it does not."""
    value = F.col(column)
    return df.agg(F.try_divide(F.avg(F.when(flag, value)), F.avg(F.when(~flag, value))).alias("ratio"))


def correlations(df: DataFrame, columns: Mapping[str, Column] | Sequence[str]) -> DataFrame:
    """(left, right, corr) of every pair, from the co-moments of all pairs; a pair uses the rows where both are known.

    Only one half of the symmetric matrix is computed; the other is mirrored on its few rows. A column without spread has no
    correlation, one with itself is 1.
    """
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}
    # what rounding leaves of a constant column is no spread
    tiny = "greatest(abs(mean_{0}), 1e-150) * greatest(abs(mean_{0}), 1e-150) * n * 1e-28"
    spread = F.when(F.expr(f"m2_left > {tiny.format('left')} and m2_right > {tiny.format('right')}"),
                    F.sqrt("m2_left") * F.sqrt("m2_right"))
    half = pair_moments(df, columns).select("left", "right", F.try_divide("co", spread).alias("corr")).withColumn(
        "corr", F.when(F.col("left") != F.col("right"), F.col("corr")).when(F.col("corr").isNotNull(), 1.0))
    return half.select(F.explode(F.when(F.col("left") == F.col("right"), F.array(F.struct("left", "right"))).otherwise(F.array(
        F.struct("left", "right"), F.struct(F.col("right").alias("left"), F.col("left").alias("right"))))).alias("p"), "corr"
    ).select("p.left", "p.right", "corr")


def target_correlations(df: DataFrame, columns: Mapping[str, Column], target: str, bound: float = 0.5) -> DataFrame:
    """Correlation of every column with the target, ranked, strong ones flagged."""
    wide = df.select(F.col(target).cast("double").alias("_t"), *[e.cast("double").alias(n) for n, e in columns.items()])
    computed = wide.agg(*[F.corr(n, "_t").alias(n) for n in columns])
    order = Window.orderBy(F.desc_nulls_last("corr"), "feature")  # one row per declared column
    return computed.unpivot([], list(columns), "feature", "corr").select(
        "feature", "corr", F.coalesce(F.col("corr") > bound, F.lit(False)).alias("strong"),
        F.row_number().over(order).alias("position"))


def flag_shares(df: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """(flag, n_true, pct_true) of 0/1 columns."""
    long = to_series(df, [], flags, "flag", "value")
    return long.groupBy("flag").agg(F.count_if(F.col("value") == 1).alias("n_true"),
                                    (F.avg("value") * 100).alias("pct_true"))


def iqr_bounds(series: DataFrame) -> DataFrame:
    """Fences 1.5 interquartile ranges outside the quartiles."""
    marks = exact_quantiles(series, ["series"], "value", [0.25, 0.75], few_groups=True)
    q1, q3 = F.get("quantiles", F.lit(0)), F.get("quantiles", F.lit(1))
    return marks.select("series", (q1 - 1.5 * (q3 - q1)).alias("lower"), (q3 + 1.5 * (q3 - q1)).alias("upper"))


def iqr_outliers(series: DataFrame) -> DataFrame:
    """Fences, rows outside them and their share, per series."""
    fenced = series.join(F.broadcast(iqr_bounds(series)), "series")  # one row per declared column
    outside = (F.col("value") < F.col("lower")) | (F.col("value") > F.col("upper"))
    return fenced.groupBy("series").agg(
        F.max("lower").alias("lower"), F.max("upper").alias("upper"), F.count_if(outside).alias("n_outliers"),
        (100.0 * F.count_if(outside) / F.count("*")).alias("pct_outliers"))


def histogram(series: DataFrame, n_bins: int) -> DataFrame:
    """Counts in equal-width bins over the observed range; the last bin is closed, empty bins are kept."""
    clean = series.where(is_finite(F.col("value")))
    limits = clean.groupBy("series").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    width = (F.col("high") - F.col("low")) / n_bins
    at = F.when(width > 0, F.least(F.floor((F.col("value") - F.col("low")) / width), F.lit(n_bins - 1))).otherwise(0)
    counted = clean.join(F.broadcast(limits), "series").groupBy("series", at.cast("int").alias("bin")) \
        .agg(F.count("*").alias("n"))
    frame = limits.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
    return frame.join(counted, ["series", "bin"], "left").select(
        "series", "bin", (F.col("low") + F.col("bin") * width).alias("low"),
        (F.col("low") + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))
