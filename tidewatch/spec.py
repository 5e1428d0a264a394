"""Column roles, data contract and thresholds. Every operator takes these as arguments."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Mapping

OK, WARNING, ALERT = "OK", "WARNING", "ALERT"
STATUSES = (OK, WARNING, ALERT)

TARGET_SERIES = "__target__"
PREDICTION_SERIES = "__prediction__"


@dataclass(frozen=True)
class Derivations:
    """Features computed from raw columns, the same way in training and in scoring."""

    interactions: tuple[tuple[str, str, str, str], ...] = ()  # name, numeric, category, level
    squares: tuple[tuple[str, str], ...] = ()                 # name, numeric
    flags: tuple[tuple[str, str, float], ...] = ()            # name, numeric, strict lower bound

    @property
    def names(self) -> list[str]:
        return [item[0] for group in (self.interactions, self.squares, self.flags) for item in group]


@dataclass(frozen=True)
class FeatureSpec:
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    target: str
    ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    levels: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    target_range: tuple[float, float] | None = None
    prediction: str = "prediction"
    bins: int = 10
    edge_digits: int | None = None
    derived: Derivations = Derivations()

    @property
    def features(self) -> tuple[str, ...]:
        return self.numeric + self.categorical

    @property
    def model_numeric(self) -> list[str]:
        return list(self.numeric) + self.derived.names


# The insurance tables' columns, contract and derived features.
INSURANCE = FeatureSpec(
    numeric=("age", "bmi", "children"),
    categorical=("sex", "smoker", "region"),
    target="charges",
    ranges={"age": (18.0, 100.0), "bmi": (10.0, 60.0), "children": (0.0, 10.0)},
    levels={
        "sex": ("male", "female"),
        "smoker": ("yes", "no"),
        "region": ("northeast", "northwest", "southeast", "southwest"),
    },
    target_range=(100.0, 250_000.0),
    derived=Derivations(
        interactions=(("bmi_smoker", "bmi", "smoker", "yes"), ("age_smoker", "age", "smoker", "yes")),
        squares=(("bmi_squared", "bmi"), ("age_squared", "age")),
        flags=(("bmi_obese", "bmi", 30.0), ("age_senior", "age", 50.0)),
    ),
)

# Default thresholds, and the group of signals each pair decides.
THRESHOLD_DEFAULTS: dict[str, float] = {
    "psi_warn": 0.10,
    "psi_alert": 0.25,
    "perf_warn_ratio": 1.25,
    "perf_alert_ratio": 1.50,
    "r2_warn_drop": 0.05,
    "r2_alert_drop": 0.15,
    "target_shift_warn": 0.25,
    "target_shift_alert": 1.00,
    "schema_warn_pct": 0.0,
    "schema_alert_pct": 1.0,
}
THRESHOLD_GROUPS: dict[str, tuple[str, str]] = {
    "psi": ("psi_warn", "psi_alert"),
    "perf": ("perf_warn_ratio", "perf_alert_ratio"),
    "r2": ("r2_warn_drop", "r2_alert_drop"),
    "target_shift": ("target_shift_warn", "target_shift_alert"),
    "schema": ("schema_warn_pct", "schema_alert_pct"),
}

# Violations that break the contract whatever share of rows they touch.
STRUCTURAL_KINDS = ("missing_column", "not_numeric", "row_count_mismatch")
