"""What several operators share: normal forms, digests, a bounded bit filter, and checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
import pickle
from typing import Any

import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import pinned

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# one row of the bit filter holds as many bits as Spark's bitmap_construct_agg fills
PAGE_BITS = 32_768


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; a null text is the empty one."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo `modulus`; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus



def bit_filter(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """(page, bitmap): the set of `key % bits` as bitmaps of 4 KB, so at most bits / 8 bytes at any size.

    `bits` is a multiple of 32,768. Rows passing the filter are all rows whose key is in the set and, the fuller the
    filter, the more others: it only saves shuffles and never decides anything.
    """
    slot = F.pmod(F.col(key), F.lit(bits))
    return (keys.where(F.col(key).isNotNull())
            .select(F.floor(slot / PAGE_BITS).alias("page"), (slot % PAGE_BITS).alias("slot"))
            .groupBy("page").agg(F.bitmap_construct_agg("slot").alias("bitmap")))


def _marked(df: DataFrame, key: Column, kept: DataFrame, bits: int) -> tuple[DataFrame, str]:
    """df with a column that says whether the row's bit is set, and that column's name, which df does not have.

    A broadcast of at most bits / 8 bytes, and no shuffle of df.
    """
    own = "_f"
    while any(c.lower().startswith(own) for c in df.columns):
        own += "_"
    slot, at, page, bitmap, hit = (own + c for c in ("slot", "at", "page", "bitmap", "hit"))
    pages = F.broadcast(kept.select(F.col("page").alias(page), F.col("bitmap").alias(bitmap)))
    slots = df.withColumn(slot, F.pmod(key, F.lit(bits)))
    marked = slots.withColumn(at, F.floor(F.col(slot) / PAGE_BITS))
    byte = F.conv(F.hex(F.expr(f"substring({bitmap}, int(({slot} % {PAGE_BITS}) div 8) + 1, 1)")), 16, 10).cast("int")
    is_set = F.pmod(F.floor(byte / F.expr(f"power(2, {slot} % 8)")), F.lit(2)) == 1
    return marked.join(pages, F.col(at) == F.col(page), "left").withColumn(
        hit, F.coalesce(is_set, F.lit(False))).drop(slot, at, page, bitmap), hit


def passing(df: DataFrame, key: Column, kept: DataFrame, bits: int) -> DataFrame:
    """The rows of df that pass a `bit_filter`."""
    marked, hit = _marked(df, key, kept, bits)
    return marked.where(hit).drop(hit)


def dropping(df: DataFrame, ids: DataFrame, key: str, bits: int = 1 << 26) -> DataFrame:
    """The rows of df whose key is not among the written table `ids`; rows with a null key stay.

    Only rows that a bit filter of the ids does not clear are shuffled for the exact anti join.
    """
    marked, hit = _marked(df, F.col(key), pinned(bit_filter(ids, key, bits)), bits)
    return marked.where(f"not {hit}").unionByName(marked.where(hit).join(ids, key, "left_anti").select(marked.columns)).drop(hit)


def checked_broadcast(df: DataFrame, row_bytes: int, limit: int = 64 << 20) -> DataFrame:
    """Ask for a broadcast of an already written table only where its counted rows fit into `limit` bytes.

    Beyond the limit the plan is the ordinary shuffled join, with the same result.
    """
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def bounded_batches(spark: SparkSession, size: str = "4m") -> None:
    """Send rows to Python in Arrow batches of about `size`: a batch is held by the JVM and by the worker at once.

    Spark's own 64 MB are hundreds of MB beside the heap where texts are long. A setting of the session's user stays.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, size)


def share(spark: SparkSession, value: Any) -> Broadcast:
    """Broadcast a value whose classes the executors need not be able to import; `opened` gives it back in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(shared: Broadcast) -> Any:
    return pickle.loads(shared.value)


def give_back_memory() -> None:
    """Return freed memory to the system: a Python worker lives on after its task, beside the next stage's JVM work."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def slices(batches, rows: int = 512):
    """Arrow batches in slices of a few rows, so that what a task makes of them at once stays small."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
    give_back_memory()
