"""Language identification by compression: the dictionary that helps a text most names its language.

For each language a raw-content zstandard dictionary is made of the words of a bounded sample of labelled rows, the
most frequent ones last, where references are cheapest. A text is reduced to its distinct words, in order, and
compressed once with each dictionary; the smallest result wins, and a narrow margin is a rejection. Only the
dictionaries leave Spark's tables, and their total size is checked before they are broadcast.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, opened, remainder, share, slices

UNKNOWN = "und"
WORD = re.compile(r"[^\W\d_]+")
SCHEMA = "doc_id long, lang_pred string, score double, margin long, rejected boolean"


@dataclass(frozen=True)
class Options:
    """sample_rows: labelled rows a language is learned from (about: a hash picks them), of at most `sample_chars`
    characters each where there are enough of these. dictionary_bytes: size of a dictionary. max_bytes: limit of all dictionaries together.
    min_margin, min_share: bytes, and share of the winner's size, by which the winner must be smaller than the next.
    """

    sample_rows: int = 400
    sample_chars: int = 4096
    dictionary_bytes: int = 64_000
    max_bytes: int = 64 << 20
    min_margin: int = 1
    min_share: float = 0.002
    temperature: float = 3.0


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def dictionaries(docs: DataFrame, trained: Column, text: str, lang: str, doc_id: str, options: Options):
    """{language: (dictionary, labelled rows)} from the rows where `trained` holds and text and language are there.

    Counts cover all rows; the sample is the rows whose hash falls below the wanted share of their language.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(doc_id).cast("string").alias("id"),
                       trained.alias("trained")).where("trained and text is not null and lang is not null")
    short = F.length("text") <= options.sample_chars
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(short).alias("n_short"))
    if counts.count() * options.dictionary_bytes > options.max_bytes:
        raise ValueError(f"the dictionaries of all languages take more than {options.max_bytes} bytes")
    share = F.when(short, options.sample_rows / F.col("n_short")).otherwise(  # long rows fill up where short ones are too few
        (options.sample_rows - F.col("n_short")) / (F.col("n") - F.col("n_short")))
    drawn = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30) < share
    sample = rows.join(F.broadcast(counts), "lang").where(drawn)
    found: dict[str, Counter] = defaultdict(Counter)
    for row in sample.select("lang", "text").toLocalIterator():
        found[row.lang].update(words_of(row.text))
    totals = {row.lang: row.n for row in counts.collect()}
    learned = {}
    for language, n in sorted(totals.items()):
        frequent = sorted(found[language].items(), key=lambda wn: (-wn[1], wn[0]))
        content = " ".join(w for w, _ in reversed(frequent)).encode()
        learned[language] = (content[-options.dictionary_bytes:], n)
    return learned


class Compressors:
    """One compressor for each language; languages with more labelled rows win ties."""

    def __init__(self, learned: dict[str, tuple[bytes, int]], options: Options):
        level = zstandard.ZstdCompressionParameters.from_level(
            6, strategy=zstandard.STRATEGY_BTOPT, min_match=3, window_log=18, write_content_size=False,
            write_checksum=False, write_dict_id=False)
        self.options = options
        self.order = sorted(learned, key=lambda language: (-learned[language][1], language))
        self.by_language = {}
        for language in self.order:
            content = learned[language][0]
            if len(content) >= 8:
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                self.by_language[language] = zstandard.ZstdCompressor(dict_data=known, compression_params=level)
            else:
                self.by_language[language] = zstandard.ZstdCompressor(compression_params=level)

    def predict(self, text: str | None) -> tuple[str, float, int, bool]:
        """(language, score, margin in bytes, rejected)"""
        words = words_of(text or "")
        if not words or not self.order:
            return UNKNOWN, 0.0, 0, True
        body = " ".join(dict.fromkeys(words)).encode("utf-8", "replace")
        sizes = [len(self.by_language[language].compress(body)) for language in self.order]
        best = min(range(len(sizes)), key=lambda k: (sizes[k], k))
        score = 1 / sum(math.exp(-min(700, (size - sizes[best]) / self.options.temperature)) for size in sizes)
        if len(sizes) == 1:
            return self.order[0], score, 0, False
        margin = min(s for k, s in enumerate(sizes) if k != best) - sizes[best]
        narrow = margin < max(self.options.min_margin, self.options.min_share * sizes[best])
        return self.order[best], score, margin, narrow


def predicted(docs: DataFrame, learned: dict[str, tuple[bytes, int]], text: str = "text", doc_id: str = "doc_id",
              options: Options = Options()) -> DataFrame:
    """(doc_id, lang_pred, score, margin, rejected) for every row, from its whole text alone.

    A text that is null or has no letter, and every text if nothing could be learned, is `und` with score 0, rejected. A
    tie goes to the language with more labelled rows, and is rejected. Repeated rows get equal predictions; an empty
    table gives no rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    shared = share(docs.sparkSession, (learned, options))

    def label(batches):
        compressors = Compressors(*opened(shared))
        for batch in slices(batches):
            out = [compressors.predict(t.as_py()) for t in batch.column(1)]
            langs, scores, margins, rejected = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "lang_pred": pa.array(langs, pa.string()),
                "score": pa.array(scores, pa.float64()), "margin": pa.array(margins, pa.int64()),
                "rejected": pa.array(rejected, pa.bool_())})

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("body")).mapInArrow(label, SCHEMA)


def identified(docs: DataFrame, fold: int = 3, held_out: int = 1, text: str = "text", lang: str = "lang",
               doc_id: str = "doc_id", options: Options = Options()) -> DataFrame:
    """Learn from the labelled rows outside the held-out fold, predict all rows; adds held_out."""
    learned = dictionaries(docs, remainder(doc_id, fold) != held_out, text, lang, doc_id, options)
    return predicted(docs, learned, text, doc_id, options).select(
        "doc_id", (remainder("doc_id", fold) == held_out).alias("held_out"), "lang_pred", "score", "margin", "rejected")


def without_rejected(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
                     options: Options = Options()) -> DataFrame:
    """The rows of docs whose language is recognised, with all their columns; learns from all labelled rows."""
    bounded_batches(docs.sparkSession)
    learned = dictionaries(docs, F.lit(True), text, lang, doc_id, options)
    shared, at = share(docs.sparkSession, (learned, options)), docs.columns.index(text)

    def keep(batches):
        compressors = Compressors(*opened(shared))
        for batch in slices(batches):
            yield batch.filter(pa.array([not compressors.predict(t.as_py())[3] for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
