"""Session defaults, and the shared folder that breaks lineage safely."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # call-site capture costs a round trip per column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: the cluster's checkpoint folder, or the warehouse where none is set."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
            or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate")


def with_checkpoints(spark: SparkSession) -> None:
    """Give the context a checkpoint folder if it has none: without one, Spark ML never cuts the lineage of a long boosting,
    and reading hundreds of steps back overflows the stack."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def pinned(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder and read them back.

    Later stages then see the same rows whatever executors are lost, plans start anew from a scan,
    and the columns can still be pruned. Row groups are small, since every writing task holds one in memory.
    """
    path = f"{shared_dir(df.sparkSession)}/pinned-{uuid4().hex}"
    df.write.option("parquet.block.size", 32 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

