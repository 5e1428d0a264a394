"""One query for each operator, over its whole table and with production parameters."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontaminate, secrets
from tidewatch.llm.brown import scored
from tidewatch.llm.common import read_table
from tidewatch.llm.decontaminate import contamination
from tidewatch.llm.exact_dedup import exact_duplicates
from tidewatch.llm.extract import extracted
from tidewatch.llm.kmeans_tree import nearest
from tidewatch.llm.language import identified
from tidewatch.llm.mixing import mixed, tempered_shares
from tidewatch.llm.near_dedup import near_duplicates
from tidewatch.llm.prefix_trie import prefix_trie
from tidewatch.llm.url_filters import captures_of, entries_of, judged
from tidewatch.llm.warc import archived
from tidewatch.llm.whitening import whitened


def op1_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf, "documents"))


def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    return extracted(read_table(spark, sf, "pages"))


def op3_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return scored(read_table(spark, sf, "documents"))


def op4_warc(spark: SparkSession, sf: str) -> DataFrame:
    return archived(read_table(spark, sf, "pages"))


def op5_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf, "documents"), width=3, percent=85)


def op6_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.digest_columns(secrets.secrets(read_table(spark, sf, "documents")))


def op7_language_id(spark: SparkSession, sf: str) -> DataFrame:
    return identified(read_table(spark, sf, "documents"))


def op8_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = read_table(spark, sf, "pages")
    return judged(captures_of(pages), entries_of(pages))


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    return mixed(docs, tempered_shares(docs))


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.digest_columns(contamination(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark")))


def op11_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return prefix_trie(read_table(spark, sf, "conversations"))


def op12_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return nearest(read_table(spark, sf, "embeddings"))


def op13_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitened(read_table(spark, sf, "embeddings"))


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)


QUERIES = {query.__name__: query for query in (
    op1_exact_dedup, op2_html_extraction, op3_lm_scoring, op4_warc, op5_near_dedup, op6_secret_scan, op7_language_id,
    op8_url_filters, op9_mixing, op10_decontaminate, op11_prefix_trie,
    op12_nearest_neighbours, op13_embedding_whitening, pipeline)}
