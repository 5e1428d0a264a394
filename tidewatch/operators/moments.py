"""Counts, means and co-moments of all pairs of columns, folded in blocks in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# sums an aggregate holds: with more, Spark gives up generating code for it (spark.sql.codegen.maxFields)
_FIELDS = 90


def _patterns(names: Sequence[str]) -> Column:
    """The known columns of a row as text of zeros and ones."""
    return F.concat(*[F.when(F.col(n).isNotNull(), "1").otherwise("0") for n in names])


def pair_moments(df: DataFrame, columns: Mapping[str, Column], by: Sequence[str] = ()) -> DataFrame:
    """(*by, left, right, n, mean_left, mean_right, m2_left, m2_right, co): one row for each pair, itself included.

    n counts the rows in which both are known; m2 and co are sums of squared and mixed deviations from the means over these
    rows. Sums are taken about a first mean of each column, so that large values lose no digits, and by which columns
    are known: usually one or two patterns, so all pairs of a row share one aggregate. Null, NaN and infinite values are unknown.
    """
    names = list(columns)
    if not names:
        raise ValueError("no columns")
    known = {n: F.when(~F.isnan(e.cast("double")) & (F.abs(e.cast("double")) != float("inf")), e.cast("double"))
             for n, e in columns.items()}
    plain = [f"_{i}" for i in range(len(names))]
    wide = df.select(*by, *[known[n].alias(p) for n, p in zip(names, plain, strict=True)])
    rows = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    centres = wide.agg(*[F.avg(p).alias(p) for p in plain]).first()
    shifted = wide.select(*by, *[(F.col(p) - F.lit(centres[p] or 0.0)).alias(p) for p in plain])
    keyed = shifted.select(*by, _patterns(plain).alias("_known"), *[F.coalesce(p, F.lit(0.0)).alias(p) for p in plain])
    keys = [*by, "_known"]
    sums = {f"s{i}": F.col(p) for i, p in enumerate(plain)} | {f"p{i}_{j}": F.col(plain[i]) * F.col(plain[j]) for i, j in rows}
    parts, todo = None, list(sums)
    while todo:  # few columns: one block, and so one pass
        block, todo = todo[:_FIELDS], todo[_FIELDS:]
        folded = keyed.groupBy(*keys).agg(F.count("*").alias("_n"), *[F.sum(sums[s]).alias(s) for s in block])
        same = [folded[k].eqNullSafe(parts[k]) for k in keys] if parts is not None else []
        parts = folded if parts is None else parts.join(folded, same).select(
            *[parts[k] for k in keys], parts["_n"], *[c for c in parts.columns if c not in (*keys, "_n")], *block)
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"s{i}").alias("si"), F.col(f"s{j}").alias("sj"),
                               F.col(f"p{i}_{i}").alias("pii"), F.col(f"p{j}_{j}").alias("pjj"), F.col(f"p{i}_{j}").alias("pij"))
                      for i, j in rows])
    both = "substring(_known, i + 1, 1) = '1' and substring(_known, j + 1, 1) = '1'"
    long = parts.select(*keys, "_n", F.explode(cells).alias("c")).select(*keys, "_n", "c.*")
    totals = long.groupBy(*by, "i", "j").agg(
        F.coalesce(F.sum(F.when(F.expr(both), F.col("_n"))), F.lit(0)).alias("n"),
        *[F.sum(F.when(F.expr(both), F.col(c))).alias(c) for c in ("si", "sj", "pii", "pjj", "pij")])
    of, about = F.array(*[F.lit(n) for n in names]), F.array(*[F.lit(centres[p] or 0.0) for p in plain])
    return totals.select(
        *by, F.element_at(of, F.col("i") + 1).alias("left"), F.element_at(of, F.col("j") + 1).alias("right"), "n",
        (F.element_at(about, F.col("i") + 1) + F.try_divide("si", "n")).alias("mean_left"),
        (F.element_at(about, F.col("j") + 1) + F.try_divide("sj", "n")).alias("mean_right"),
        (F.col("pii") - F.try_divide(F.col("si") * F.col("si"), F.col("n"))).alias("m2_left"),
        (F.col("pjj") - F.try_divide(F.col("sj") * F.col("sj"), F.col("n"))).alias("m2_right"),
        (F.col("pij") - F.try_divide(F.col("si") * F.col("sj"), F.col("n"))).alias("co"))
