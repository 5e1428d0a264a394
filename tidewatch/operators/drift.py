"""Population stability index, numeric and categorical, for all batches and features at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .profile import as_frequencies, bin_counts

SMOOTHING = 1e-6  # fixed value: floor of a frequency before the logarithm


def psi_of(reference: Column, actual: Column, eps: float = SMOOTHING) -> Column:
    """PSI of two aligned frequency arrays; both are floored, then made to sum to one again."""
    def floored(freqs: Column) -> Column:
        return F.transform(freqs, lambda f: F.greatest(f, F.lit(eps)))

    def total(freqs: Column) -> Column:
        return F.aggregate(floored(freqs), F.lit(0.0), lambda s, f: s + f)

    def shares(freqs: Column) -> Column:
        return F.transform(floored(freqs), lambda f: f / total(freqs))

    terms = F.zip_with(shares(reference), shares(actual), lambda r, a: (a - r) * F.ln(a / r))
    return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)


def psi_from_counts(counts: DataFrame, bins: DataFrame, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """PSI of (keys, series, counts) against reference (series, freqs)."""
    total = F.aggregate(F.coalesce("counts", F.array().cast("array<bigint>")), F.lit(0).cast("bigint"),
                        lambda a, c: a + c)
    usable = (F.size("freqs") >= 2) & (total > 0)
    psi = F.when(usable, psi_of(F.col("freqs"), as_frequencies(F.col("counts")))).otherwise(0.0)
    return (
        counts.join(F.broadcast(bins.select("series", "freqs")), "series")
        .select(*keys, "series", psi.alias("psi"))
    )


def psi_numeric(series: DataFrame, bins: DataFrame, keys: Sequence[str] = ("batch_id",)) -> DataFrame:
    """(keys, series, psi). `bins` is (series, edges, freqs), one row per declared column."""
    counts = bin_counts(series, bins.select("series", "edges"), keys)
    seen = series.select(*keys, "series").distinct()
    return psi_from_counts(seen.join(counts, [*keys, "series"], "left"), bins, keys)


def psi_categorical(counts: DataFrame, reference: DataFrame, keys: Sequence[str] = ("batch_id",),
                    eps: float = SMOOTHING) -> DataFrame:
    """PSI over the union of levels from (keys, feature, category, n) and (feature, category, freq).

    With floored shares a = a'/A and r = r'/R the index is sum(a'L)/A - sum(r'L)/R, where
    L = ln a' - ln r'. The sums run over the union of levels. Levels absent from a batch all have
    a' = eps, so their part is the total over the reference minus the matched levels: no batch is
    expanded to every reference level.
    """
    keys = list(keys)
    floor = F.lit(eps)
    clean = counts.where(F.col("category").isNotNull())
    sizes = clean.groupBy(*keys, "feature").agg(F.sum("n").alias("_rows"))

    r_floored = F.greatest(F.coalesce("freq", F.lit(0.0)), floor)
    known = F.col("freq").isNotNull()
    gap = F.ln(floor) - F.ln(r_floored)
    reference_totals = reference.groupBy("feature").agg(
        F.sum(F.greatest("freq", floor)).alias("_r"),
        F.count("*").alias("_levels"),
        F.sum(floor * (F.ln(floor) - F.ln(F.greatest("freq", floor)))).alias("_al"),
        F.sum(F.greatest("freq", floor) * (F.ln(floor) - F.ln(F.greatest("freq", floor)))).alias("_rl"))

    a_floored = F.greatest(F.col("n") / F.col("_rows"), floor)
    log_ratio = F.ln(a_floored) - F.ln(r_floored)
    unseen = ~known
    matched = (
        clean.join(sizes, [*keys, "feature"])
        .join(reference.select("feature", "category", "freq"), ["feature", "category"], "left")
        .groupBy(*keys, "feature").agg(
            F.sum(a_floored).alias("a"),
            F.sum(F.when(unseen, r_floored).otherwise(0.0)).alias("r_extra"),
            F.count_if(known).alias("k"),
            F.sum(a_floored * log_ratio - F.when(known, floor * gap).otherwise(0.0)).alias("al"),
            F.sum(r_floored * log_ratio - F.when(known, r_floored * gap).otherwise(0.0)).alias("rl"))
    )
    total_a = F.col("a") + floor * (F.col("_levels") - F.col("k"))
    total_r = F.col("_r") + F.col("r_extra")
    psi = (F.col("al") + F.col("_al")) / total_a - (F.col("rl") + F.col("_rl")) / total_r
    return matched.join(reference_totals, "feature").select(*keys, "feature", psi.alias("psi"))
