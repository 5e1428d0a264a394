"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned by windows of training words.

Words of the test items become small integers. A text is turned into these integers (-1: no test word), runs of ten
are hashed with whole-array operations, hashes are looked up in the sorted set, and every hit is verified word by word.
A set of more than `block_windows` windows is broadcast in blocks of whole items, one after another: each block's scan adds its
spans to the rows, which are written before the next block is broadcast. So what is broadcast at once has a fixed bound, and a
row stays a row whatever its id and however many blocks there are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches, opened, share, slices
from tidewatch.session import pinned

# fixed value: a word is made of digits, ASCII letters and all characters beyond ASCII
WORD_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256))

SCAN_SCHEMA = "n_words long, spans array<struct<start:int,end:int>>, items array<string>"
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
_FACTORS = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(64)], dtype=np.uint64)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().translate(WORD_BYTES).split()


class WindowSet:
    """The windows of some items: `width` consecutive words, or all words of a shorter item."""

    def __init__(self, items: list[tuple[str, list[bytes]]], width: int):
        self.vocabulary: dict[bytes, int] = {}
        windows: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
            for i in range(max(1, len(ids) - width + 1) if ids else 0):
                windows.setdefault(tuple(ids[i:i + width]), set()).add(item)
        self.by_width = {}
        for size in sorted({len(w) for w in windows}):
            same = [(w, sorted(items)) for w, items in windows.items() if len(w) == size]
            hashes = self._hashes(np.array([w for w, _ in same], dtype=np.int64).ravel(), size)[::size]
            order = np.argsort(hashes, kind="stable")
            self.by_width[size] = (hashes[order], [same[i] for i in order])

    @staticmethod
    def _hashes(ids: np.ndarray, size: int) -> np.ndarray:
        spread = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        spread ^= spread >> np.uint64(29)
        return sum(spread[k:len(ids) - size + 1 + k] * _FACTORS[k] for k in range(size))

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words inside occurrences of windows, merged, and the items these belong to."""
        known = self.vocabulary.get
        ids = np.array([known(w, -1) for w in words], dtype=np.int64)
        starts, items = [], set()
        for size, (hashes, windows) in self.by_width.items():
            if len(ids) < size:
                continue
            # a window with an unknown word cannot match: count unknown words before each position
            unknown = np.concatenate([[0], np.cumsum(ids < 0)])
            possible = np.flatnonzero(unknown[size:] == unknown[:-size])
            if not len(possible):
                continue
            found = self._hashes(ids, size)[possible]
            at = np.searchsorted(hashes, found)
            equal = hashes[np.minimum(at, len(hashes) - 1)] == found
            for start, first in zip(possible[equal], at[equal], strict=True):
                window = tuple(ids[start:start + size])
                same = range(first, np.searchsorted(hashes, hashes[first], "right"))
                exact = next((k for k in same if windows[k][0] == window), None)
                if exact is not None:
                    starts.append((int(start), int(start) + size))
                    items.update(windows[exact][1])
        return merged(starts), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(shared, last: bool):
    """Adds what one block of windows finds to the spans and items of each row; the text goes with the last block."""
    def scan(batches):
        windows = opened(shared)
        for batch in slices(batches):
            ids, texts = batch.column(0), batch.column(1)
            n_words, spans, items = [], [], []
            for text, earlier, known in zip(texts.cast(pa.binary()), batch.column(3), batch.column(4), strict=True):
                words = words_of(text.as_py())
                found, of = windows.find(words)
                n_words.append(len(words))
                spans.append([{"start": s, "end": e} for s, e in merged([*((s["start"], s["end"]) for s in earlier.as_py()), *found])])
                items.append(sorted(of.union(known.as_py())))
            columns = [pa.array(n_words, pa.int64()), pa.array(spans, _SPANS), pa.array(items, pa.list_(pa.string()))]
            names = ["n_words", "spans", "items"]
            yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", *names]) if last else pa.RecordBatch.from_arrays(
                [ids, texts, *columns], ["doc_id", "body", *names])
    return scan


def _item_blocks(benchmark: DataFrame, text: str, item_id: str, width: int, block_windows: int):
    """(list of (item, words), whether it is the last) of at most `block_windows` windows (or a single item), one after another."""
    block, size = [], 0
    rows = benchmark.where(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("string").alias("item"), F.col(text).cast("binary").alias("body"))
    for row in rows.toLocalIterator():
        words = words_of(bytes(row.body) if row.body is not None else None)
        windows = max(1, len(words) - width + 1)
        if block and size + windows > block_windows:
            yield block, False
            block, size = [], 0
        block.append((row.item, words))
        size += windows
    yield block, True


def contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id",
                  bench_text: str = "text", item_id: str = "item_id", width: int = 10,
                  block_windows: int = 200_000) -> DataFrame:
    """(doc_id, n_words, spans, items) for every document: word spans inside test windows, and the items they are from.

    A null or empty text has no words and no spans; an item without words has no windows; items without an id are left
    out. Equal items are all reported, by their ids as text. Every row has its own result, rows that repeat an id or have none
    too; an empty table gives no rows.
    """
    bounded_batches(docs.sparkSession)
    spark, kind = docs.sparkSession, docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("body"), F.lit(0).cast("long").alias("n_words"),
                       F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.array().cast("array<string>").alias("items"))
    for block, last in _item_blocks(benchmark, bench_text, item_id, width, block_windows):
        shared = share(spark, WindowSet(block, width))
        rows = rows.mapInArrow(_scan(shared, last), f"doc_id {kind}, {'' if last else 'body string, '}{SCAN_SCHEMA}")
        if not last:
            rows = pinned(rows)
            shared.destroy()
    return rows


def digest_columns(found: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of what `contamination` found."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + (s["end"] - s["start"]))
    as_text = F.array_join(F.array_sort("items"), ",")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(as_text, 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def _clean(shared, at: int):
    def clean(batches):
        windows = opened(shared)
        for batch in slices(batches):
            texts = batch.column(at).cast(pa.binary())
            yield batch.filter(pa.array([not windows.find(words_of(t.as_py()))[0] for t in texts], pa.bool_()))
    return clean


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", bench_text: str = "text",
                         item_id: str = "item_id", width: int = 10, block_windows: int = 200_000) -> DataFrame:
    """The rows of docs in which no test window occurs, with all their columns; block after block."""
    bounded_batches(docs.sparkSession)
    for block, last in _item_blocks(benchmark, bench_text, item_id, width, block_windows):
        shared = share(docs.sparkSession, WindowSet(block, width))
        docs = docs.mapInArrow(_clean(shared, docs.columns.index(text)), docs.schema)
        if not last:
            docs = pinned(docs)
            shared.destroy()
    return docs


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words of the given spans (as `contamination` counts words) and what stands between them."""
    pieces, at = [], 0
    words = list(re.finditer("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text))
    for start, end in spans:
        pieces.append(text[at:words[start].start()])
        at = words[end - 1].end()
    return "".join(pieces) + text[at:]
