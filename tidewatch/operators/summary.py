"""The two per-batch summaries every check is read from.

Rows are scanned once for all numeric series and once for all categories; contract checks, drift,
and means are then small queries over (batch, series) and (batch, feature, category) counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import is_finite, lookup_bin, nan_to_null, normalize_decimal, tally, to_double
from ..spec import PREDICTION_SERIES, TARGET_SERIES, FeatureSpec
from .shaping import to_series


def coerce_numeric(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Numeric columns as doubles; names of the columns whose text was no number in `unparsed`."""
    textual = [c for c in spec.numeric if c in df.columns and dict(df.dtypes)[c] == "string"]
    plain = [c for c in spec.numeric if c in df.columns and c not in textual]
    failed = [F.when(normalize_decimal(F.col(c)).isNotNull() & to_double(normalize_decimal(F.col(c))).isNull(),
                     F.lit(c)) for c in textual]
    marks = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return df.withColumn("unparsed", marks).withColumns(
        {c: to_double(normalize_decimal(F.col(c))) for c in textual}
        | {c: nan_to_null(F.col(c).cast("double")) for c in plain})


def series_dimension(spec: FeatureSpec, bins: DataFrame | None, spark) -> DataFrame:
    """(series, low, high, edges): one row per declared numeric series, so it is safe to broadcast."""
    bounds = {c: spec.ranges.get(c, (None, None)) for c in spec.numeric}
    bounds[TARGET_SERIES] = spec.target_range or (None, None)
    bounds[PREDICTION_SERIES] = (None, None)
    table = spark.createDataFrame(
        [(name, float(lo) if lo is not None else None, float(hi) if hi is not None else None)
         for name, (lo, hi) in bounds.items()], "series string, low double, high double")
    if bins is None:
        return table.withColumn("edges", F.lit(None).cast("array<double>"))
    return table.join(F.broadcast(bins.select("series", "edges")), "series", "left")


def numeric_summary(rows: DataFrame, spec: FeatureSpec, bins: DataFrame | None = None,
                    keys: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Per (keys, series): rows, nulls, failed casts, out-of-range, extremes, mean, bin counts.

    A row whose `scored` is false has no counterpart in the target file: the contract counts it,
    the histogram and the mean do not.
    """
    present = {c: F.col(c) for c in spec.numeric if c in rows.columns}
    if spec.target in rows.columns:
        present[TARGET_SERIES] = F.col(spec.target)
    if spec.prediction in rows.columns:
        present[PREDICTION_SERIES] = F.col(spec.prediction)
    carried = [c for c in ("unparsed", "scored") if c in rows.columns]

    long = to_series(rows, [*keys, *carried], present)
    value = nan_to_null(F.col("value"))
    scored = F.col("scored") if "scored" in carried else F.lit(True)
    counted = scored | F.col("series").isin(*spec.numeric)
    failed = F.array_contains("unparsed", F.col("series")) if "unparsed" in carried else F.lit(False)
    dimension = series_dimension(spec, bins, rows.sparkSession)
    located = long.join(F.broadcast(dimension), "series").select(
        *keys, "series", F.when(counted, value).alias("v"), counted.alias("_counted"), scored.alias("_scored"),
        failed.alias("_failed"), ((F.col("value") < F.col("low")) | (F.col("value") > F.col("high"))).alias("_out"),
        F.when(scored & is_finite(F.col("value")), lookup_bin(F.col("value"), F.col("edges"))).alias("_bin"))
    scored_value = F.when(F.col("_scored"), F.col("v"))
    # rows are folded per bin first, so the number of bins is the baseline's own
    by_bin = located.groupBy(*keys, "series", "_bin").agg(
        F.count_if("_counted").alias("n_rows"),
        F.count_if(F.col("_counted") & F.col("v").isNull()).alias("n_null"),
        F.count_if("_failed").alias("n_failed"), F.count_if(F.col("v").isNotNull() & F.col("_out")).alias("n_out"),
        F.min("v").alias("min"), F.max("v").alias("max"), F.sum(scored_value).alias("total"),
        F.count(scored_value).alias("n_scored"), F.count("*").alias("n"))
    filled = F.filter(F.collect_list(F.struct("_bin", "n")), lambda entry: entry["_bin"].isNotNull())
    out = by_bin.groupBy(*keys, "series").agg(
        *[F.sum(c).alias(c) for c in ("n_rows", "n_null", "n_failed", "n_out", "total", "n_scored")],
        F.min("min").alias("min"), F.max("max").alias("max"), F.map_from_entries(filled).alias("_tally")
    ).join(F.broadcast(dimension), "series")
    return out.select(
        *keys, "series", "n_rows", "n_null", "n_failed", "n_out", "min", "max",
        F.try_divide("total", "n_scored").alias("mean"), "low", "high",
        F.when(F.col("edges").isNotNull(), tally(F.col("_tally"), F.col("edges"))).alias("counts"))


def category_summary(rows: DataFrame, spec: FeatureSpec,
                     keys: tuple[str, ...] = ("batch_id",)) -> DataFrame:
    """Per (keys, feature, category): rows, and the scored rows among them; null is a category here."""
    present = [c for c in spec.categorical if c in rows.columns]
    carried = ["scored"] if "scored" in rows.columns else []
    long = to_series(rows, [*keys, *carried], present, "feature", "value", "string")
    scored = F.col("scored") if carried else F.lit(True)
    return long.groupBy(*keys, "feature", F.lower("value").alias("category")).agg(
        F.count("*").alias("n_rows"), F.count_if(scored).alias("n"))


def without_missing(summary: DataFrame, missing: DataFrame | None, column: str) -> DataFrame:
    """Drop columns a batch file did not have: they are missing, not full of nulls."""
    if missing is None:
        return summary
    return summary.join(missing.select("batch_id", F.col("column").alias(column)),
                        ["batch_id", column], "left_anti")
