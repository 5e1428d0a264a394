"""Wide rows to one row per (keys, series): k columns then cost one shuffle, not k jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def to_series(df: DataFrame, keys: Sequence[str], columns: Mapping[str, Column] | Sequence[str],
              series: str = "series", value: str = "value", kind: str = "double") -> DataFrame:
    """Unpivot `columns` (name -> expression) into (keys, series, value)."""
    if not isinstance(columns, Mapping):
        columns = {name: F.col(name) for name in columns}
    wide = df.select(*keys, *[expr.cast(kind).alias(name) for name, expr in columns.items()])
    return wide.unpivot(list(keys), list(columns), series, value)


def ordinal_of(names: Sequence[str], column: Column) -> Column:
    """Position of a name in a short declared list (for stable tie-breaks and ordering)."""
    return F.array_position(F.array(*[F.lit(n) for n in names]), column).cast("int")


def global_position(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """Zero-based position in a total order, without sorting everything in one task.

    Rows are range-sorted and written once; each partition then only needs the number of rows in
    the partitions before it.
    """
    from ..session import pinned

    placed = pinned(df.orderBy(*order).withColumn("_part", F.spark_partition_id()))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        placed.withColumn("_at", F.row_number().over(inside)).join(offsets, "_part")
        .withColumn(name, (F.col("_offset") + F.col("_at") - 1).cast("bigint"))
        .drop("_part", "_at", "_offset")
    )
