"""WARC archives as seekable Zstandard bundles.

A bundle is a row of independent Zstandard frames, each holding a few whole
records, and a last skippable frame with the seek table of the public seekable
format: for every frame its compressed and its plain size, then the number of
frames, a descriptor and a magic number. Any decoder reads a bundle from front to
back; one that knows the table decodes a single frame. The index maps a record to
its bundle, its frame, and its offset and length in the decoded frame.

Tasks write bundles under names of their own attempt and say in the index which they
wrote. The index is stored before it is used, so a task that runs again leaves at
most a bundle that no index names, and readers follow the index.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentledger.sources.shared import durable, shared_dir

LEAST_SHARED = 100  # bytes from which an equal payload is stored once
FRAME_BYTES, BUNDLE_BYTES, LEVEL = 1 << 18, 1 << 25, 3
# Fixed values of the seekable format: magic numbers of a skippable frame and of the table's end.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "1970-01-01T00:00:00Z"  # pages carry no date

INDEX = "page_id long, bundle string, frame int, start long, length long, frame_start long, frame_length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def plan_records(pages: DataFrame, least: int = LEAST_SHARED) -> DataFrame:
    """`page_id`, `url`, `payload`, `digest`, `refers_to` of every page; the last is null for a response.

    Only counts by digest are grouped, and only digests that repeat are joined, from a
    stored table: Spark can split a digest that very many pages share.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    full = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    shared = durable(
        full.where(F.octet_length("payload") >= least)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
        .where("n > 1 AND first IS NOT NULL")
        .select("digest", "first")
    )
    return full.join(shared, "digest", "left").select(
        "page_id", "url", "payload", "digest", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to")
    )


def _name(page_id: int | None) -> str:
    return "urn:page:" + ("" if page_id is None else str(page_id))


def _line(value: str | None) -> str:
    return " ".join((value or "").split())


def encode(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One record. A revisit carries no payload, but its length and digest."""
    body = payload if refers_to is None else b""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{_name(page_id)}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_line(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <{_name(refers_to)}>",
            f"X-Payload-Length: {len(payload)}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def decode(record: bytes) -> tuple:
    """`RECORD` fields of one record; a response's length and digest are taken from what it holds."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines)
    body = rest[: int(fields["Content-Length"])]
    if version != "WARC/1.1" or rest[len(body) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    number = lambda name: int(x) if (x := fields[name][1:-1].rpartition(":")[2]) else None
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    if fields["WARC-Type"] == "revisit":
        return number("WARC-Record-ID"), int(fields["X-Payload-Length"]), digest, "revisit", number("WARC-Refers-To"), None
    if hashlib.sha256(body).hexdigest() != digest:
        raise ValueError(f"damaged payload in {fields['WARC-Record-ID']}")
    return number("WARC-Record-ID"), len(body), digest, "response", None, body


class Bundle:
    """Frames on their way into one file."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.open: list[bytes] = []
        self.open_bytes = self.bytes = 0
        self.index: list[list] = []
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def add(self, page_id: int | None, record: bytes, frame_bytes: int) -> None:
        if self.open and self.open_bytes + len(record) > frame_bytes:
            self.close_frame()
        self.index.append([page_id, len(self.frames), self.open_bytes, len(record)])
        self.open.append(record)
        self.open_bytes += len(record)

    def close_frame(self) -> None:
        if self.open:
            plain = b"".join(self.open)
            self.frames.append(self.packer.compress(plain))
            self.sizes.append((len(self.frames[-1]), len(plain)))
            self.bytes += len(self.frames[-1])
            self.open, self.open_bytes = [], 0

    def finish(self) -> bytes:
        self.close_frame()
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        foot = table + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(foot)) + foot


def seek_table(bundle: bytes) -> list[tuple[int, int]]:
    """Start and compressed length of every frame, from the bundle's last bytes, which hold the table."""
    count, _, magic = struct.unpack("<IBI", bundle[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    found, at = [], 0
    for size, _ in struct.iter_unpack("<II", bundle[-9 - 8 * count : -9]):
        found.append((at, size))
        at += size
    return found


def _writer(folder: str, frame_bytes: int, bundle_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        kinds = pa.schema([
            ("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("start", pa.int64()),
            ("length", pa.int64()), ("frame_start", pa.int64()), ("frame_length", pa.int64()),
        ])
        count, bundle = 0, Bundle()

        def flush() -> pa.RecordBatch:
            name = f"bundle-{task.partitionId():06d}-{task.taskAttemptId()}-{count:05d}.warc.zst"
            content = bundle.finish()
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(content)
            frames = seek_table(content)
            rows = [(i, name, f, s, n, *frames[f]) for i, f, s, n in bundle.index]
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), kinds)], schema=kinds)

        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                page_id, *rest = (x.as_py() for x in row)
                bundle.add(page_id, encode(page_id, *rest), frame_bytes)
                if bundle.bytes + bundle.open_bytes >= bundle_bytes:
                    yield flush()
                    count, bundle = count + 1, Bundle()
        if bundle.index:
            yield flush()

    return write


def write_archive(
    pages: DataFrame, folder: str, least: int = LEAST_SHARED, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES
) -> DataFrame:
    """Write every page as a record below `folder`, a shared one, and return the stored index of records.

    A frame holds records up to `frame_bytes`, or one longer record; a bundle ends after
    `bundle_bytes`, so a task holds one bundle and one record at a time. Of rows with one payload of `least`
    bytes or more the smallest page_id is the response (all its rows, if it repeats) and the others are
    revisits of it. Null html is empty, a null url is left blank, a row without page_id is a
    response only if no row with that payload has one. An empty table makes no bundle.
    """
    store, base = pyarrow.fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    records = plan_records(pages, least)
    return durable(records.mapInArrow(_writer(folder, frame_bytes, bundle_bytes), INDEX))


def read_frames(file, wanted: Iterable[int]) -> Iterator[tuple[int, bytes]]:
    """Number and plain bytes of the `wanted` frames of an open bundle; only the table and these frames are read."""
    size = file.seek(0, 2)

    def read(start: int, length: int) -> bytes:
        file.seek(start)
        return file.read(length)

    (count,) = struct.unpack("<I", read(size - 9, 4))
    frames = seek_table(read(size - 9 - 8 * count, 9 + 8 * count))
    for number in wanted:
        yield number, zstandard.ZstdDecompressor().decompress(read(*frames[number]))


def _reader(folder: str):
    kinds = pa.schema([
        ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pyarrow.fs.FileSystem.from_uri(folder)
        for batch in batches:
            for bundle, spans in zip(batch.column("bundle").to_pylist(), batch.column("spans").to_pylist()):
                by_frame = {n: list(own) for n, own in groupby(sorted(spans, key=lambda s: (s["frame"], s["start"])), key=lambda s: s["frame"])}
                with store.open_input_file(f"{base}/{bundle}") as file:
                    for number, plain in read_frames(file, by_frame):
                        found = [decode(plain[s["start"] : s["start"] + s["length"]]) for s in by_frame[number]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*found), kinds)], schema=kinds)

    return read


def read_archive(spark: SparkSession, folder: str, index: DataFrame) -> DataFrame:
    """`RECORD` of every row of `index`, decoded frame by frame from the bundles below `folder`.

    `index` may be a part of what `write_archive` returned. The index is grouped by bundle, a task for each where there are that many; each
    opens its bundle and reads the seek table and the frames that are asked for. No bundle is listed, moved or read as a whole.
    """
    spans = index.groupBy("bundle").agg(F.collect_list(F.struct("frame", "start", "length")).alias("spans"))  # bounded by a bundle
    bundles = index.select("bundle").distinct().count()
    return spans.repartition(max(1, bundles), "bundle").mapInArrow(_reader(folder), RECORD)


def archive_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
