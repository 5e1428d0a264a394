"""Derived features, target transform, row errors and encodings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import Derivations, FeatureSpec
from .shaping import global_position, to_series


MAX_LEVELS = 10_000  # of all categorical inputs together: beyond it one-hot columns make no sensible model


def _flag(condition: Column) -> Column:
    """0/1, with an unknown condition as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def derive_features(df: DataFrame, derived: Derivations) -> DataFrame:
    columns: dict[str, Column] = {}
    for name, number, category, level in derived.interactions:
        columns[name] = F.col(number) * _flag(F.col(category) == level)
    for name, number in derived.squares:
        columns[name] = F.col(number) * F.col(number)
    for name, number, bound in derived.flags:
        columns[name] = _flag(F.col(number) > bound)
    return df.withColumns(columns) if columns else df


def to_log(value: Column) -> Column:
    return F.log1p(value)


def from_log(value: Column) -> Column:
    return F.expm1(value)


def split_features_target(df: DataFrame, target: str, bookkeeping: Sequence[str] = ("id", "created_at")):
    """(features, target) frames without the bookkeeping columns."""
    kept = df.drop(*bookkeeping)
    return kept.drop(target), kept.select(target)


def with_row_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Absolute and percentage error; the latter is null for a zero or missing actual."""
    gap = F.col(actual) - F.col(predicted)
    return df.withColumns({
        "abs_error": F.abs(gap),
        "pct_error": F.abs(F.try_divide(gap, F.nullif(F.col(actual), F.lit(0.0)))) * 100,
    })


def with_provenance(df: DataFrame, model: Mapping[str, str | None], run_id: str, at) -> DataFrame:
    """Model name, version and source, the run, and the time of the run (passed in, never now())."""
    return df.withColumns({
        **{key: F.lit(model.get(key)).cast("string") for key in ("model_name", "model_version", "model_source",
                                                                "model_id")},
        "run_id": F.lit(run_id), "scored_at": F.lit(at).cast("timestamp_ntz"),
    })


def category_levels(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted levels of every categorical model input. They become model columns, so more than MAX_LEVELS are an error."""
    levels = to_series(df, [], columns, "feature", "value", "string").where("value is not null").distinct()
    found = levels.limit(MAX_LEVELS + 1).collect() if columns else []
    if len(found) > MAX_LEVELS:
        raise ValueError(f"the categorical columns have more than {MAX_LEVELS} levels; they cannot all become model columns")
    return {c: sorted(r.value for r in found if r.feature == c) for c in columns}


def one_hot(levels: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Indicator per level but the first; a level not seen in training leaves all of them at zero."""
    return {
        f"{column}_{level}": _flag(F.col(column) == level)
        for column, names in levels.items() for level in names[1:]
    }


def encoded_names(spec: FeatureSpec, levels: Mapping[str, Sequence[str]]) -> list[str]:
    return spec.model_numeric + list(one_hot(levels))


def category_codes(df: DataFrame, column: str) -> DataFrame:
    """Alphabetical code of each level: its position among the distinct levels."""
    levels = df.select(column).where(F.col(column).isNotNull()).distinct()
    codes = global_position(levels, [column], f"{column}_code")
    return df.join(codes, column, "left")


def flag_label(flag: Column, labels: tuple[str, str]) -> Column:
    return F.when(flag == 0, labels[0]).when(flag == 1, labels[1])
