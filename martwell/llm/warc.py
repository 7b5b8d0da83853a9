"""Seekable Zstandard WARC bundles.

A bundle is a file of independent Zstandard frames, each with a group of WARC
records, and a last skippable frame with the seek table of the seekable
format: compressed and decompressed size of every frame, then their number and
a magic number, so that a reader finds the table from the end of the file.  The
index maps a record to (bundle, frame, offset in the decompressed frame,
length): one record costs a read of the table and of one frame.

Payloads that occur more than once (and have ``min_revisit_bytes``) are stored
once: the page with the largest id is the response, the others are revisits
that name it.  Equal payloads are found by their SHA-256 with a counted
aggregate, so a payload that a third of all pages share reaches the join as one
row per task; the join itself can be split by Spark.

Files are written below the shared folder through pyarrow's file systems
(file, hdfs, s3 ...), under a name that no other attempt of the task uses.  The
index comes from Spark's own committed output, so files of lost or repeated
attempts are never referred to.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martwell.llm.common import ship, steps, stored, table
from martwell.session import new_scratch_dir

# Fixed values of the Zstandard seekable format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

INDEX_DDL = "page_id long, record_id string, bundle string, frame int, frame_offset long, record_bytes long"
READ_DDL = (
    "page_id long, record_id string, url string, record_type string, refers_to long, "
    "payload_bytes long, payload_digest string, payload binary, bundle string, frame int, frame_offset long"
)
_INDEX = pa.schema(
    [("page_id", pa.int64()), ("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32()),
     ("frame_offset", pa.int64()), ("record_bytes", pa.int64())]
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def roles(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with payload, ``is_revisit`` and
    ``refers_to`` (the response's page_id, null for a response).

    A null page_id is smaller than any other; rows that repeat the largest id
    of their payload are all responses, and so are all rows of a payload that
    only null ids have."""
    keyed = pages.withColumn("payload", F.encode(F.coalesce("html", F.lit("")), "UTF-8")).withColumn(
        "key", F.sha2("payload", 256)
    )
    repeated = (
        keyed.filter(F.length("payload") >= min_revisit_bytes)
        .groupBy("key")
        .agg(F.max("page_id").alias("response"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 AND response IS NOT NULL")
        .select("key", "response")
    )
    joined = keyed.join(repeated, "key", "left")
    revisit = F.col("response").isNotNull() & ~F.col("response").eqNullSafe(F.col("page_id"))
    return joined.select(
        "page_id", "url", "payload",
        revisit.alias("is_revisit"),
        F.when(revisit, F.col("response")).alias("refers_to"),
    )


def _line(value: object) -> str:
    """A header value on one line."""
    return "" if value is None else "".join(" " if c in "\r\n" else c for c in str(value))


def warc_record(page_id, url, payload: bytes, revisit: bool, refers_to, number: str) -> tuple[str, bytes]:
    """Record id and bytes of one WARC/1.1 response or revisit record."""
    record_id = f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{number}|{page_id}|{url}')}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha1:{sha1_base32(payload)}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
    ]
    if revisit:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return record_id, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    body = entries + struct.pack("<IBI", len(frames), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


class BundleWriter:
    """Writes records to bundles below a folder, a frame's worth at a time."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int, level: int):
        self.fs, self.folder = pafs.FileSystem.from_uri(folder)
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.out = None
        self.buffer, self.held = bytearray(), []

    def add(self, page_id, record_id: str, data: bytes) -> list[tuple]:
        """Index rows of the frame that this record ends, if it ends one."""
        self.held.append((page_id, record_id, len(self.buffer), len(data)))
        self.buffer += data
        return self.flush() if len(self.buffer) >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        if not self.held:
            return []
        if self.out is None:
            self.name, self.frames, self.written = f"bundle-{uuid.uuid4().hex}.warc.zst", [], 0
            self.out = self.fs.open_output_stream(f"{self.folder}/{self.name}", compression=None)
        packed = self.zstd.compress(bytes(self.buffer))
        self.out.write(packed)
        rows = [(p, r, self.name, len(self.frames), o, n) for p, r, o, n in self.held]
        self.frames.append((len(packed), len(self.buffer)))
        self.written += len(packed)
        self.buffer, self.held = bytearray(), []
        if self.written >= self.bundle_bytes:
            self.end_bundle()
        return rows

    def end_bundle(self) -> None:
        if self.out is not None:
            self.out.write(seek_table(self.frames))
            self.out.close()
            self.out = None


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * len(_INDEX)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _INDEX.types)], schema=_INDEX)


def write_bundles(
    pages: DataFrame,
    folder: str,
    *,
    min_revisit_bytes: int = 0,
    frame_bytes: int = 256 * 1024,
    bundle_bytes: int = 64 * 1024 * 1024,
    level: int = 3,
) -> DataFrame:
    """Write one WARC record per row of ``pages`` (page_id, url, html) into
    bundles below ``folder`` (a URI that all executors see); returns the index
    (``INDEX_DDL``), which is stored as a table beside them.

    Null html is an empty payload; null ids and urls are written as empty
    headers; repeated rows get a record each; other columns are not read; an
    empty table writes no bundle and an empty index.  A record longer than
    ``frame_bytes`` ends the frame that it falls into; a task holds one frame."""
    spark = pages.sparkSession
    ship(spark)
    pafs.FileSystem.from_uri(folder)[0].create_dir(pafs.FileSystem.from_uri(folder)[1], recursive=True)
    told = roles(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), min_revisit_bytes)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder, frame_bytes, bundle_bytes, level)
        task = uuid.uuid4().hex
        number = 0
        for batch in batches:
            for part in steps(batch, 2):
                rows: list[tuple] = []
                for values in zip(*(c.to_pylist() for c in part.columns)):
                    number += 1
                    record_id, data = warc_record(*values, f"{task}-{number}")
                    rows += writer.add(values[0], record_id, data)
                yield _index_batch(rows)
        rows = writer.flush()
        writer.end_bundle()
        yield _index_batch(rows)

    return stored(told.mapInArrow(write, INDEX_DDL), "warc-index")


class SeekableReader:
    """Frames of one bundle by number."""

    def __init__(self, folder: str, name: str):
        fs, path = pafs.FileSystem.from_uri(folder)
        self.file = fs.open_input_file(f"{path}/{name}")
        size = self.file.size()
        count, _, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEKABLE_MAGIC:
            raise ValueError(f"{name}: no seek table at its end")
        table_bytes = 8 * count
        raw = self._at(size - 9 - table_bytes, table_bytes)
        self.frames, at = [], 0
        for i in range(count):
            packed, plain = struct.unpack_from("<II", raw, 8 * i)
            self.frames.append((at, packed, plain))
            at += packed
        self.zstd = zstandard.ZstdDecompressor()

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def frame(self, number: int) -> bytes:
        start, packed, plain = self.frames[number]
        return self.zstd.decompress(self._at(start, packed), max_output_size=plain)

    def close(self) -> None:
        self.file.close()


def parse_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and end of the WARC record at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    version, *lines = data[at:end].decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines)
    n = int(headers["Content-Length"])
    return headers, data[end + 4 : end + 4 + n], end + 4 + n + 4


def _read_row(headers: dict, block: bytes, with_payload: bool) -> tuple:
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = headers["WARC-Type"]
    if kind == "response" and (len(payload) != size or sha1_base32(payload) != digest):
        raise ValueError(f"{headers['WARC-Record-ID']}: the payload does not match its digest")
    page, refers = headers.get("X-Page-ID"), headers.get("X-Refers-To-Page-ID")
    return (
        int(page) if page else None, headers["WARC-Record-ID"], headers.get("WARC-Target-URI") or None, kind,
        int(refers) if refers else None, size, digest, payload if with_payload and kind == "response" else None,
    )


def _rows_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)


_READ = pa.schema(
    [("page_id", pa.int64()), ("record_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
     ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("payload", pa.binary()), ("bundle", pa.string()), ("frame", pa.int32()), ("frame_offset", pa.int64())]
)


def dealt_runs(index: DataFrame) -> DataFrame:
    """(bundle, run): the runs of 16 frames, dealt to tasks one by one."""
    runs = index.groupBy("bundle", F.floor(F.col("frame") / 16).cast("int").alias("run")).agg(F.lit(1).alias("one"))
    # By number and by a hash: dealt by the grouping's own keys the planner would
    # drop it, and adaptive execution would join these few bytes into one task.
    tasks = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return runs.select("bundle", "run").repartition(tasks, F.xxhash64("bundle", "run"))


def read_bundles(index: DataFrame, folder: str, *, with_payload: bool = False) -> DataFrame:
    """All records of the bundles that ``index`` names, parsed from the files
    (``READ_DDL``; a response's payload is checked against its digest).  A task
    holds one frame at a time; a bundle's size is bounded, so frames are dealt
    to tasks by (bundle, run of 16 frames)."""
    ship(index.sparkSession)
    runs = dealt_runs(index)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, run in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                reader = SeekableReader(folder, name)
                for frame in range(run * 16, min(run * 16 + 16, len(reader.frames))):
                    data, at, rows = reader.frame(frame), 0, []
                    while at < len(data):
                        headers, block, end = parse_record(data, at)
                        rows.append((*_read_row(headers, block, with_payload), name, frame, at))
                        at = end
                    yield _rows_batch(rows, _READ)
                reader.close()

    return runs.mapInArrow(read, READ_DDL)


def fetch_records(index: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """The records of ``wanted`` (record_id), each read through the index and
    the seek table: a frame that holds none of them is not decompressed."""
    ship(index.sparkSession)
    places = index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
    places = places.repartition("bundle", "frame").sortWithinPartitions("bundle", "frame", "frame_offset")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = number = reader = data = None
        for batch in batches:
            rows = []
            for b, f, at in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "frame_offset"))):
                if b != name:
                    if reader:
                        reader.close()
                    reader, name, number = SeekableReader(folder, b), b, None
                if f != number:
                    data, number = reader.frame(f), f
                headers, block, _ = parse_record(data, at)
                rows.append((*_read_row(headers, block, True), b, f, at))
            yield _rows_batch(rows, _READ)
        if reader:
            reader.close()

    return places.mapInArrow(read, READ_DDL)


def op2_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch_dir(spark, "warc")
    index = write_bundles(table(spark, sf_dir, "pages"), folder)
    return read_bundles(index, folder).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
