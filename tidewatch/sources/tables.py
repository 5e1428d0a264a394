"""Tables in and out: training data, samples, baselines, predictions and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import parse_decimal
from ..operators.baseline import Baseline
from ..spec import FeatureSpec


def require_columns(df: DataFrame, expected) -> None:
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"columns missing from the dataset: {missing}")


def prepare_training_rows(raw: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Exact duplicates removed over all columns, then the declared columns only, typed."""
    wanted = [*spec.features, spec.target]
    require_columns(raw, wanted)
    kinds = dict(raw.dtypes)
    numeric = {*spec.numeric, spec.target}
    return raw.dropDuplicates().select(*[
        parse_decimal(F.col(c)).alias(c) if c in numeric and kinds[c] == "string" else F.col(c) for c in wanted])


def ingest_training_csv(spark: SparkSession, path: str, spec: FeatureSpec, table_path: str) -> DataFrame:
    """Add a training CSV, read as text, to the training table, as a partition named by its content.

    The name is a digest over all prepared rows that does not depend on their order, so a retry, or the same rows under
    another file name, replaces what it wrote before instead of doubling it.
    """
    rows = prepare_training_rows(spark.read.option("header", "true").csv(path), spec)
    as_text = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
    sums = rows.agg(F.count("*").alias("n"), *[F.sum(F.xxhash64(as_text, F.lit(k)).cast("decimal(20,0)")).alias(f"h{k}") for k in (0, 1)])
    name = sums.select(F.sha2(F.concat_ws(":", "n", "h0", "h1"), 256)).first()[0]
    rows.write.mode("overwrite").parquet(f"{table_path}/content={name}")
    return spark.read.parquet(table_path).drop("content")


def sample_rows(df: DataFrame, n: int, seed: int | None = None) -> DataFrame:
    """n random rows (a top-n by a random number: no full sort)."""
    return df.orderBy(F.rand(seed) if seed is not None else F.rand()).limit(n)


_BASELINE_PARTS = ("profile", "bins", "freqs", "metrics")


def save_baseline(baseline: Baseline, path: str) -> None:
    """Four Parquet tables partitioned by model; only interior edges are stored, never infinities.

    The partitions of the models written are replaced, so a retried run gives no second row a series; other models stay.
    """
    for part in _BASELINE_PARTS:
        getattr(baseline, part).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("model_id").parquet(
            f"{path}/{part}")


def load_baseline(spark: SparkSession, path: str) -> Baseline:
    def table(part: str) -> DataFrame:
        frame = spark.read.parquet(f"{path}/{part}")
        return frame.withColumn("model_id", F.col("model_id").cast("string"))

    return Baseline(*[table(part) for part in _BASELINE_PARTS])


def baseline_in_use(baselines: Baseline, model_id: str) -> DataFrame:
    """(requested, model_id, exact): the model's own baseline, else the newest one there is."""
    own = F.coalesce(F.bool_or(F.col("model_id") == model_id), F.lit(False))
    newest = F.max_by("model_id", F.struct("created_at", "model_id"))
    return baselines.metrics.agg(own.alias("exact"), newest.alias("newest")).select(
        F.lit(model_id).alias("requested"), F.when(F.col("exact"), F.lit(model_id)).otherwise(F.col("newest")).alias("model_id"),
        "exact")


def append_run(rows: DataFrame, path: str, run_id: str, *partitions: str) -> None:
    """Add a run's rows as its own partition; a retried run replaces what it wrote before, and nothing else."""
    writer = rows.drop("run_id").write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(f"{path}/run_id={run_id}")


def append_predictions(scored: DataFrame, path: str, run_id: str) -> None:
    """Predictions partitioned by run and batch. The rebalance lets AQE split a large batch over many files."""
    append_run(scored.hint("rebalance", "batch_id"), path, run_id, "batch_id")


def write_predictions_csv(scored: DataFrame, path: str, run_id: str) -> None:
    scored.hint("rebalance", "batch_id").write.mode("errorifexists").partitionBy("batch_id") \
        .option("header", "true").csv(f"{path}/run_id={run_id}")


def append_monitoring(rows: DataFrame, path: str, run_id: str) -> None:
    append_run(rows, path, run_id)


def write_report(status: DataFrame, flat: DataFrame, path: str, run_id: str) -> None:
    """Nested report rows as JSON, the flat view as CSV."""
    status.write.mode("errorifexists").json(f"{path}/run_id={run_id}/json")
    flat.write.mode("errorifexists").option("header", "true").csv(f"{path}/run_id={run_id}/csv")


def save_state(state: DataFrame, path: str, run_number: int) -> None:
    """A new snapshot of the alert state; the one being read is never overwritten."""
    state.write.mode("errorifexists").parquet(f"{path}/run_number={run_number}")


def load_state(spark: SparkSession, path: str, run_number: int) -> DataFrame:
    return spark.read.parquet(f"{path}/run_number={run_number}")
