"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every document gets a short fingerprint of its normalised text, written once with its digest.
2. Each sender (a partition of that table) sorts its distinct fingerprints, cuts them by owner (a range of fingerprints)
   and sends every owner one Golomb-coded run of gaps: a few bits a document instead of a text.
3. Each owner decodes its runs, finds the fingerprints that occur more than once, and answers with one bit for each
   fingerprint it was sent.
4. Only texts whose fingerprint is marked are shuffled, and grouping them by their bytes decides. Copies inside a task
   are folded before the shuffle, so a text that a third of all rows share sends one row a task.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import ascii_lower, bit_filter, dropping, passing
from tidewatch.session import pinned

RUN_SCHEMA = "owner int, sender long, n long, coded binary, repeated binary"
REPLY_SCHEMA = "owner int, sender long, marks binary"
_HEAD = "<QB"  # number of gaps, width of a remainder


def golomb_encode(gaps: np.ndarray) -> bytes:
    """Gaps (not negative) as a Golomb code whose parameter is a power of two, chosen by their mean.

    Quotients go into one unary stream and remainders into one of fixed width, so both decode as whole arrays.
    """
    n = len(gaps)
    mean = float(gaps.mean()) if n else 0.0
    width = max(0, int(np.log2(mean * 0.69 + 1e-9))) if mean >= 2 else 0
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    shifts = np.arange(width, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    return struct.pack(_HEAD, n, width) + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def golomb_decode(coded: bytes) -> np.ndarray:
    n, width = struct.unpack_from(_HEAD, coded)
    body = np.frombuffer(coded, dtype=np.uint8, offset=struct.calcsize(_HEAD))
    rest_bytes = (n * width + 7) // 8
    ones = np.flatnonzero(np.unpackbits(body[:len(body) - rest_bytes]))[:n]
    quotients = np.diff(ones, prepend=-1) - 1
    bits = np.unpackbits(body[len(body) - rest_bytes:])[:n * width].reshape(n, width).astype(np.uint64)
    return (quotients.astype(np.uint64) << np.uint64(width)) + (bits << np.arange(width, dtype=np.uint64)).sum(
        axis=1, dtype=np.uint64)


def _run_values(coded: bytes, owner: int, span: int) -> np.ndarray:
    return np.cumsum(golomb_decode(coded), dtype=np.uint64) + np.uint64(owner * span)


def _sender(owners: int, span: int):
    def send(batches):
        parts = [b.column(0).to_numpy(zero_copy_only=False) for b in batches]
        values, counts = np.unique(np.concatenate(parts).astype(np.uint64) if parts else np.array([], np.uint64),
                                   return_counts=True)
        sender = TaskContext.get().partitionId()
        cuts = np.searchsorted(values, np.arange(owners + 1, dtype=np.uint64) * np.uint64(span))
        for owner in np.flatnonzero(np.diff(cuts)):
            own = slice(cuts[owner], cuts[owner + 1])
            gaps = np.diff(values[own], prepend=np.uint64(int(owner) * span))
            yield pa.RecordBatch.from_pydict({
                "owner": pa.array([owner], pa.int32()), "sender": pa.array([sender], pa.int64()),
                "n": pa.array([len(gaps)], pa.int64()), "coded": pa.array([golomb_encode(gaps)], pa.binary()),
                "repeated": pa.array([np.packbits(counts[own] > 1).tobytes()], pa.binary())})
    return send


def _owner(span: int):
    def answer(table: pa.Table) -> pa.Table:
        owner = table.column("owner")[0].as_py()
        runs = [_run_values(c.as_py(), owner, span) for c in table.column("coded")]
        repeated = [np.unpackbits(np.frombuffer(r.as_py(), np.uint8))[:len(run)].astype(bool)
                    for r, run in zip(table.column("repeated"), runs, strict=True)]
        values, where, counts = np.unique(np.concatenate(runs), return_inverse=True, return_counts=True)
        twice = counts > 1
        twice[where[np.concatenate(repeated)]] = True
        marks = np.split(twice[where], np.cumsum([len(r) for r in runs])[:-1])
        return pa.table({"owner": table.column("owner"), "sender": table.column("sender"),
                         "marks": pa.array([np.packbits(m).tobytes() for m in marks], pa.binary())})
    return answer


def _suspects(span: int):
    def decode(batches):
        for batch in batches:
            for owner, coded, marks in zip(*(batch.column(c).to_pylist() for c in ("owner", "coded", "marks")),
                                           strict=True):
                values = _run_values(coded, owner, span)
                marked = np.unpackbits(np.frombuffer(marks, np.uint8))[:len(values)].astype(bool)
                yield pa.RecordBatch.from_pydict({"fingerprint": pa.array(values[marked].astype(np.int64))})
    return decode


def suspects(prints: DataFrame, bits: int, owner_rows: int) -> DataFrame:
    """Fingerprints that more than one row has, found by the exchange; `prints` is a written table."""
    spark = prints.sparkSession
    owners = int(max(2 * spark.sparkContext.defaultParallelism, -(-prints.count() // owner_rows)))
    span = -(-(1 << bits) // owners)
    runs = pinned(prints.select("fingerprint").mapInArrow(_sender(owners, span), RUN_SCHEMA))
    replies = runs.groupBy("owner").applyInArrow(_owner(span), REPLY_SCHEMA)
    returned = runs.select("owner", "sender", "coded").join(replies, ["owner", "sender"])
    return returned.select("owner", "coded", "marks").mapInArrow(_suspects(span), "fingerprint long")


def exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", bits: int = 48,
                     owner_rows: int = 500_000, filter_bits: int = 1 << 26) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) for every row; of equal texts the largest doc_id stays.

    Texts are equal when identical after lower-casing A-Z. A null text is the empty text, so null and empty texts form one
    group. Rows that repeat a doc_id count one by one in group_size and are kept or dropped together. A group without
    any doc_id has a null keep_id and is kept. An empty table gives no rows; other columns are ignored. `bits` is the
    length of a fingerprint (at most 62), `filter_bits` the fixed size of the broadcast filter of suspects.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), ascii_lower(F.col(text)).alias("body"))
    fingerprint = F.shiftrightunsigned(F.xxhash64("body"), 64 - bits)
    prints = pinned(rows.select("doc_id", F.unhex(F.sha2("body", 256)).alias("digest"), fingerprint.alias("fingerprint")))
    marked = pinned(bit_filter(suspects(prints, bits, owner_rows), "fingerprint", filter_bits))
    suspected = passing(rows, fingerprint, marked, filter_bits)
    groups = (suspected.groupBy("body").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
              .where("group_size > 1")
              .select(F.unhex(F.sha2("body", 256)).alias("digest"), F.lit(True).alias("grouped"), "keep_id", "group_size"))
    keep = F.when(F.col("grouped"), F.col("keep_id")).otherwise(F.col("doc_id"))
    return prints.join(groups, "digest", "left").select(
        "doc_id", keep.alias("keep_id"), F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def without_duplicates(docs: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """The rows of docs that `exact_duplicates` keeps, with all their columns."""
    dropped = exact_duplicates(docs, doc_id=doc_id, **options).where("not kept").select(F.col("doc_id").alias(doc_id))
    return dropping(docs, pinned(dropped.distinct()), doc_id)
