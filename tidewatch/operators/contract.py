"""Data-contract violations, read from the per-batch summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import label_of, rank_of
from ..spec import ALERT, OK, TARGET_SERIES, THRESHOLD_DEFAULTS, WARNING, FeatureSpec
from .shaping import ordinal_of

VIOLATION_KINDS = ("missing_column", "nulls", "not_numeric", "out_of_range", "unknown_category", "row_count_mismatch")
VIOLATION_COLUMNS = ["batch_id", "column", "kind", "severity", "n_rows", "pct_rows", "detail"]


def severity_for_pct(pct: Column, warn: float = THRESHOLD_DEFAULTS["schema_warn_pct"],
                     alert: float = THRESHOLD_DEFAULTS["schema_alert_pct"]) -> Column:
    return F.when(pct > alert, ALERT).when(pct > warn, WARNING).otherwise(OK)


def _share(n: Column, total: Column) -> Column:
    return 100.0 * n / F.greatest(total, F.lit(1))


def _violation(column: Column, kind: str, n: Column, total: Column, detail: Column,
               structural: bool = False) -> Column:
    pct = F.lit(100.0) if structural else _share(n, total)
    severity = F.lit(ALERT) if structural else severity_for_pct(pct)
    return F.struct(
        column.alias("column"), F.lit(kind).alias("kind"), severity.alias("severity"),
        n.cast("bigint").alias("n_rows"), pct.alias("pct_rows"), detail.alias("detail"))


def _emit(df: DataFrame, *candidates: tuple[Column, Column]) -> DataFrame:
    """One output row for every (condition, violation) that holds."""
    found = F.array_compact(F.array(*[F.when(cond, item) for cond, item in candidates]))
    return df.select("batch_id", F.explode(found).alias("v")).select("batch_id", "v.*")


def numeric_violations(summary: DataFrame, spec: FeatureSpec, labelled: DataFrame | None = None) -> DataFrame:
    """nulls, not_numeric and out_of_range of the declared numeric columns and of the target.

    `labelled` lists the batches that brought a target; without it, a target column with no value
    at all counts as absent.
    """
    wanted = [*spec.numeric, TARGET_SERIES]
    checked = summary.where(F.col("series").isin(*wanted))
    is_target = F.col("series") == TARGET_SERIES
    if labelled is None:
        checked = checked.where(~is_target | (F.col("n_null") < F.col("n_rows")))
    else:
        known = labelled.select("batch_id", F.lit(True).alias("_labelled"))
        checked = checked.join(known, "batch_id", "left").where(
            ~is_target | F.coalesce("_labelled", F.lit(False)))
    name = F.when(is_target, F.lit(spec.target)).otherwise(F.col("series"))
    total, nulls, failed = F.col("n_rows"), F.col("n_null"), F.col("n_failed")
    none_parsed = (failed > 0) & (nulls == total)
    missing = F.when(none_parsed, nulls - failed).otherwise(nulls)
    bounds = F.format_string("outside [%s, %s], observed [%s, %s]",
                             *[F.col(c).cast("string") for c in ("low", "high", "min", "max")])
    return _emit(
        checked,
        (missing > 0, _violation(name, "nulls", missing, total, F.lit("null values"))),
        (none_parsed, _violation(name, "not_numeric", total, total, F.lit("no value is a number"), True)),
        (F.col("n_out") > 0, _violation(name, "out_of_range", F.col("n_out"), total, bounds)),
    )


def _against_levels(categories: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Levels of the declared categorical columns with `_unknown`: a level the contract does not list."""
    spark = categories.sparkSession
    known = spark.createDataFrame(
        [(f, level.lower()) for f in spec.categorical for level in spec.levels.get(f, ())],
        "feature string, category string").withColumn("_known", F.lit(True))
    # the declared contract is configuration: one row per allowed level
    marked = categories.where(F.col("feature").isin(*spec.categorical)).join(
        F.broadcast(known), ["feature", "category"], "left")
    restricted = F.col("feature").isin(*spec.levels)
    return marked.withColumn("_unknown", restricted & F.col("category").isNotNull() & F.col("_known").isNull())


def unknown_levels(categories: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(batch_id, column, level, n_rows) of every level that the contract does not list."""
    return _against_levels(categories, spec).where("_unknown").select(
        "batch_id", F.col("feature").alias("column"), F.col("category").alias("level"), "n_rows")


def category_violations(categories: DataFrame, spec: FeatureSpec) -> DataFrame:
    """nulls of the declared categorical columns, and unknown_category of those whose levels the contract lists.

    The detail is a summary; `unknown_levels` has every level.
    """
    unknown = F.col("_unknown")
    marked = _against_levels(categories, spec)
    totals = marked.groupBy("batch_id", "feature").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum(F.when(F.col("category").isNull(), F.col("n_rows")).otherwise(0)).alias("n_null"),
        F.sum(F.when(unknown, F.col("n_rows")).otherwise(0)).alias("n_unknown"), F.count_if(unknown).alias("n_levels"),
        F.min(F.when(unknown, F.col("category"))).alias("first_level"))
    total = F.col("n_rows")
    return _emit(
        totals,
        (F.col("n_null") > 0, _violation(F.col("feature"), "nulls", F.col("n_null"), total, F.lit("null values"))),
        (F.col("n_unknown") > 0, _violation(
            F.col("feature"), "unknown_category", F.col("n_unknown"), total,
            F.format_string("%d levels not in the contract, from %s on", "n_levels", "first_level"))),
    )


def missing_column_violations(batches: DataFrame, spec: FeatureSpec, present: DataFrame) -> DataFrame:
    """One ALERT per declared column that a batch's header does not have.

    `batches` is (batch_id, n_features); `present` is (batch_id, column).
    """
    expected = batches.withColumn("column", F.explode(F.array(*[F.lit(c) for c in spec.features])))
    gone = expected.join(present.select("batch_id", "column"), ["batch_id", "column"], "left_anti")
    item = _violation(F.col("column"), "missing_column", F.col("n_features"), F.col("n_features"),
                      F.lit("column not in the file"), structural=True)
    return _emit(gone, (F.lit(True), item))


def row_count_violations(batches: DataFrame, spec: FeatureSpec) -> DataFrame:
    """ALERT where features and target have different row counts: (batch_id, n_features, n_target)."""
    uneven = F.col("n_target").isNotNull() & (F.col("n_target") != F.col("n_features"))
    item = _violation(
        F.lit(spec.target), "row_count_mismatch", F.abs(F.col("n_target") - F.col("n_features")),
        F.col("n_features"),
        F.format_string("features has %d rows and target %d", F.col("n_features").cast("bigint"),
                        F.col("n_target").cast("bigint")),
        structural=True)
    return _emit(batches, (uneven, item))


def validate_rows(rows: DataFrame, spec: FeatureSpec, labelled: DataFrame | None = None) -> DataFrame:
    """All value checks of rows keyed by batch_id; absent columns are reported for every batch."""
    from .summary import category_summary, coerce_numeric, numeric_summary

    clean = coerce_numeric(rows, spec)
    found = numeric_violations(numeric_summary(clean, spec), spec, labelled)
    if any(c in rows.columns for c in spec.categorical):
        found = found.unionByName(category_violations(category_summary(clean, spec), spec))
    absent = [c for c in spec.features if c not in rows.columns]
    if absent:
        sizes = rows.groupBy("batch_id").agg(F.count("*").alias("n_features"))
        everywhere = sizes.withColumn("column", F.explode(F.array(*[F.lit(c) for c in absent])))
        item = _violation(F.col("column"), "missing_column", F.col("n_features"), F.col("n_features"),
                          F.lit("column not in the file"), structural=True)
        found = found.unionByName(_emit(everywhere, (F.lit(True), item)))
    return found


def worst_severity(violations: DataFrame) -> DataFrame:
    return violations.groupBy("batch_id").agg(label_of(F.max(rank_of(F.col("severity")))).alias("severity"))


def in_contract_order(violations: DataFrame, spec: FeatureSpec) -> DataFrame:
    return violations.orderBy(
        "batch_id", ordinal_of([*spec.features, spec.target], F.col("column")), ordinal_of(VIOLATION_KINDS, F.col("kind")))
