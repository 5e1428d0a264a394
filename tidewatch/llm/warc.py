"""WARC in seekable Zstandard bundles: independent frames, a footer seek table, and an index of record offsets.

Tasks write bundles of whole frames into a folder all executors share; a frame holds records up to a size and can be
decompressed alone. The last frame of a bundle is a skippable one with the seek table of the public seekable format, so any
Zstandard reader still reads the bundle as a plain WARC. The index names, for each record, its bundle, its frame and its
offset inside the decompressed frame. A retried task writes under a new name, and only bundles named by the index, which
holds the rows of successful tasks, are read. Reading goes through the index: a task opens a bundle, reads its seek table, then
frame after frame, and takes every record at its offset; a record that is not where the index says, and bytes of a frame that
no record covers, are errors.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm.common import checked_broadcast
from tidewatch.session import pinned, shared_dir

# fixed values of the seekable format
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_TAIL, _ENTRY = "<IBI", "<II"
_TAIL_BYTES, _ENTRY_BYTES = struct.calcsize(_TAIL), struct.calcsize(_ENTRY)

INDEX_SCHEMA = "record_id string, page_id long, bundle string, frame int, offset long, length long"
READ_SCHEMA = ("record_id string, page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
               "refers_to long, bundle string, frame int, offset long, payload binary")


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame that ends a bundle: (compressed size, size) of every frame."""
    entries = b"".join(struct.pack(_ENTRY, *f) for f in frames)
    return struct.pack("<II", SKIPPABLE, len(entries) + _TAIL_BYTES) + entries + struct.pack(_TAIL, len(frames), 0, SEEKABLE)


def read_seek_table(tail: bytes) -> list[tuple[int, int]]:
    """(start in the file, compressed size) of every frame; `tail` is the file, or an end of it that holds the table."""
    count, _, magic = struct.unpack(_TAIL, tail[-_TAIL_BYTES:])
    if magic != SEEKABLE:
        raise ValueError("not a seekable bundle")
    first = len(tail) - _TAIL_BYTES - count * _ENTRY_BYTES
    sizes = [struct.unpack_from(_ENTRY, tail, first + k * _ENTRY_BYTES)[0] for k in range(count)]
    starts, at = [], 0
    for size in sizes:
        starts.append((at, size))
        at += size
    return starts


def record_bytes(record_id: str, page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                 date: str) -> bytes:
    """One WARC 1.1 record. A revisit has no payload, and names the digest and length of the one it stands for."""
    revisit = refers_to is not None
    body = b"" if revisit else payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{record_id}>",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
        if "\r" in url or "\n" in url:
            head.append(f"X-Exact-URL: {json.dumps(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def read_record(frame: bytes, offset: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, offset of the next record) of the record at an offset of a decompressed frame."""
    end = frame.index(b"\r\n\r\n", offset)
    lines = frame[offset:end].decode("utf-8").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {offset}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    start = end + 4
    stop = start + int(headers["Content-Length"])
    return headers, frame[start:stop], stop + 4


def located(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class _Bundle:
    """A bundle being written to a file; frames go out as they fill."""

    def __init__(self, folder: str, frame_bytes: int):
        system, path = located(folder)
        system.create_dir(path, recursive=True)
        self.name, self.frame_bytes = f"bundle-{uuid.uuid4().hex}.warc.zst", frame_bytes
        self.out = system.open_output_stream(f"{path}/{self.name}", compression=None)
        self.compressor = zstandard.ZstdCompressor(level=3)
        self.frames: list[tuple[int, int]] = []
        self.records: list[bytes] = []
        self.size = self.written = 0

    def add(self, record: bytes) -> tuple[int, int]:
        """(frame, offset inside it)"""
        if self.records and self.size + len(record) > self.frame_bytes:
            self.flush()
        at = len(self.frames), self.size
        self.records.append(record)
        self.size += len(record)
        return at

    def flush(self) -> None:
        if self.records:
            frame = self.compressor.compress(b"".join(self.records))
            self.out.write(frame)
            self.frames.append((len(frame), self.size))
            self.written += len(frame)
            self.records, self.size = [], 0

    def close(self) -> None:
        self.flush()
        self.out.write(seek_table(self.frames))
        self.out.close()


def _writer(folder: str, frame_bytes: int, bundle_bytes: int, date: str):
    def write(batches):
        bundle = None
        for batch in batches:
            rows = []
            for page_id, url, payload, digest, refers_to in zip(*batch.columns, strict=True):
                if bundle is None or bundle.written >= bundle_bytes:
                    if bundle is not None:
                        bundle.close()
                    bundle = _Bundle(folder, frame_bytes)
                page, refers = page_id.as_py(), refers_to.as_py()
                record_id = f"urn:page:{page}" if page is not None else f"urn:uuid:{uuid.uuid4()}"
                record = record_bytes(record_id, page, url.as_py(), payload.as_py() or b"", digest.as_py(), refers, date)
                frame, offset = bundle.add(record)
                rows.append((record_id, page, bundle.name, frame, offset, len(record)))
            names = ("record_id", "page_id", "bundle", "frame", "offset", "length")
            types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names)
        if bundle is not None:
            bundle.close()
    return write


def write_bundles(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  frame_bytes: int = 1 << 20, bundle_bytes: int = 32 << 20, revisit_bytes: int = 100,
                  date: datetime = datetime(2024, 1, 1, tzinfo=timezone.utc)) -> DataFrame:
    """Write every page as a record and return the written index (record_id, page_id, bundle, frame, offset, length).

    Of records with equal payloads of at least revisit_bytes bytes the one with the smallest page_id is a response, the
    others revisit it; shorter ones are all responses. A null html is an empty payload. Rows without page_id have a random
    record id; they revisit too where an equal payload has a page_id, and are responses otherwise. Rows that repeat the smallest page_id of their payload are all responses. A bundle is closed
    once it has bundle_bytes, so it is at most a frame larger; a record larger than a frame gets its own.
    """
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    firsts = pinned(rows.where(F.octet_length("payload") >= revisit_bytes).groupBy("digest")
                    .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
                    .select("digest", "first"))
    marked = rows.join(checked_broadcast(firsts, 100), "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))
    stamp = date.strftime("%Y-%m-%dT%H:%M:%SZ")
    return pinned(marked.mapInArrow(_writer(folder, frame_bytes, bundle_bytes, stamp), INDEX_SCHEMA))


class Bundle:
    """A bundle opened for reading: its seek table is read, and frames on demand."""

    def __init__(self, folder: str, name: str):
        system, path = located(folder)
        self.name, self.file = name, system.open_input_file(f"{path}/{name}")
        size = self.file.size()
        tail = self.file.read_at(_TAIL_BYTES, size - _TAIL_BYTES)
        table = _TAIL_BYTES + struct.unpack(_TAIL, tail)[0] * _ENTRY_BYTES
        self.frames = read_seek_table(self.file.read_at(table, size - table))

    def __enter__(self) -> Bundle:
        return self

    def __exit__(self, *error) -> None:
        self.file.close()

    def frame(self, number: int) -> bytes:
        start, size = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self.file.read_at(size, start))


def _record(headers: dict[str, str], payload: bytes, place: dict, bundle: str) -> dict:
    if headers["WARC-Record-ID"][1:-1] != place["record_id"]:
        raise ValueError(f"{bundle} does not hold {place['record_id']} at frame {place['frame']}, offset {place['offset']}")
    refers_to, page, kind = headers.get("WARC-Refers-To"), headers.get("X-Page-ID"), headers["WARC-Type"]
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError(f"payload of {place['record_id']} in {bundle} is damaged")
    exact = headers.get("X-Exact-URL")
    return {"record_id": place["record_id"], "page_id": None if page is None else int(page),
            "url": headers.get("WARC-Target-URI") if exact is None else json.loads(exact),
            "payload_bytes": int(headers["X-Payload-Length"]), "payload_digest": digest, "record_type": kind,
            "refers_to": None if refers_to is None else int(refers_to[1:-1].removeprefix("urn:page:")),
            "bundle": bundle, "frame": place["frame"], "offset": place["offset"], "payload": payload}


def _records(folder: str, name: str, places: list[dict]) -> Iterator[dict]:
    """The records at the places of a bundle, which are in order and must cover the bundle without a gap."""
    number, content, at = -1, b"", 0
    with Bundle(folder, name) as bundle:
        for place in places:
            if place["frame"] != number:
                if at != len(content) or place["frame"] != number + 1:
                    raise ValueError(f"the index leaves out a part of {name} after frame {number}, offset {at}")
                number, content, at = place["frame"], bundle.frame(place["frame"]), 0
            headers, payload, following = read_record(content, place["offset"])
            if place["offset"] != at or following - at != place["length"]:
                raise ValueError(f"the index and {name} differ at frame {number}, offset {at}")
            at = following
            yield _record(headers, payload, place, name)
        if at != len(content) or number + 1 != len(bundle.frames):
            raise ValueError(f"the index leaves out the end of {name}")


def _reader(folder: str, with_payload: bool):
    types = {"record_id": pa.string(), "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(),
             "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64(), "bundle": pa.string(),
             "frame": pa.int32(), "offset": pa.int64(), "payload": pa.binary()}
    schema = pa.schema(list(types.items()))

    def read(batches):
        for batch in batches:
            for name, places in zip(*batch.columns, strict=True):
                rows, size = [], 0
                for record in _records(folder, name.as_py(), places.as_py()):
                    if not with_payload:
                        record["payload"] = None
                    rows.append(record)
                    size += len(record["payload"] or b"")
                    if size > 16 << 20 or len(rows) >= 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)
    return read


def read_bundles(spark: SparkSession, folder: str, index: DataFrame, with_payload: bool = True) -> DataFrame:
    """Every record of the index, read at its place in its bundle; the payload of a revisit is empty.

    Only the index is shuffled: the places of a bundle meet in one row (a bundle has a bounded size), and the task reads that
    file. An empty index gives no rows.
    """
    bundles = index.select("bundle").distinct().count()
    places = F.struct("frame", "offset", "length", "record_id")
    # a number of its own, or adaptive execution would judge by the small index and read all bundles in one task
    by_bundle = (index.repartition(min(max(bundles, 1), 20_000), "bundle").groupBy("bundle")
                 .agg(F.sort_array(F.collect_list(places)).alias("places")))
    return by_bundle.mapInArrow(_reader(folder, with_payload), READ_SCHEMA)


def lookup(folder: str, bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record by its index entry: reads the seek table and that frame only."""
    with Bundle(folder, bundle) as opened:
        headers, payload, _ = read_record(opened.frame(frame), offset)
    return headers, payload


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write all pages into a new folder of the shared directory and read the archives back."""
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    index = write_bundles(pages, folder, **options)
    return read_bundles(spark, folder, index, with_payload=False).drop("payload")
