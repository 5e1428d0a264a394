"""The corpus pipeline: recognisable language, no copies, no near-copies, no benchmark text, in target proportions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm.common import read_table
from tidewatch.llm.decontaminate import without_contaminated
from tidewatch.llm.exact_dedup import without_duplicates
from tidewatch.llm.language import without_rejected
from tidewatch.llm.mixing import mixed, tempered_shares
from tidewatch.llm.near_dedup import without_near_duplicates
from tidewatch.session import pinned


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised by a clear margin."""
    return without_rejected(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return without_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, 0.8), the one with the smallest doc_id."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return without_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The order in which the documents are read, so that sources keep their target shares."""
    return mixed(docs, tempered_shares(docs))


STAGES = [("language_id", language_id), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("decontamination", decontamination), ("mixing", mixing)]

# compression, MinHash and the schedule are beyond SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again by the next one."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
