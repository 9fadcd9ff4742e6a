"""WARC archives as seekable Zstandard bundles.

A bundle is one file of independent Zstandard frames, each holding a run of whole records, and
at its end a skippable frame with the seek table: per frame its compressed and plain size, in the public
seekable format (magic number 0x8F92EAB1 last). The index maps a record id to (bundle, frame, offset in the
frame), so one record is read by one seek and one frame.

Writing runs in Spark tasks, one bundle after the other per partition. A bundle's name is its content's digest
and it appears by an atomic rename, so a repeated or speculative task leaves the same files behind. Reading
back starts from the bundle files alone: the seek tables give the frames, frames are dealt to tasks. Length and digest of
a response are those of the block as read; a revisit, which has none, gives those of its header.

Records with equal payloads of at least ``min_bytes``: the smallest page_id is a response, the
others are revisits that refer to it. Defined results: a null html is an empty payload, a null url an
empty target; rows that share page_id and payload have the same type and, where the url is the same
too, the same record id; a row with a null page_id revisits the smallest page_id, or is a response
where its payload has none. An empty table gives no bundle and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.session import materialize, shared_folder

FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 64 << 20
SKIPPABLE, SEEK_MAGIC = 0x184D2A5E, 0x8F92EAB1
DATE = "2024-01-01T00:00:00Z"

INDEX = "page_id long, record_id string, bundle string, frame int, offset long, length long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary, bundle string, frame int, offset long"


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path: local, or any that pyarrow reads by URI (s3, gs, hdfs)."""
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), path.removeprefix("file://").removeprefix("file:")
    if "://" in path:
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(page_id: int | None, url: str, payload: bytes, digest: str, refers: int | None) -> bytes:
    """One record; ``refers`` is the page that a revisit refers to, null for a response."""
    kind, block = ("response", payload) if refers is None else ("revisit", b"")
    plain = url.isprintable() and url == url.strip()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}" if plain else f"X-Quoted-Target: {quote(url, safe='')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-ID: {'' if page_id is None else page_id}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if refers is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: {record_id(refers, digest)}",
            f"X-Refers-To-Page: {refers}",
        ]
    lines += ["Content-Type: text/html; charset=utf-8", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def read_record(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """Headers, block and the place after the record that starts at ``at``."""
    end = data.index(b"\r\n\r\n", at)
    head = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
    start = end + 4
    stop = start + int(head["Content-Length"])
    return head, data[start:stop], stop + 4


class _Bundle:
    """Frames of one file while it is written; memory stays below a bundle's compressed size plus a frame."""

    def __init__(self):
        self.out, self.sizes, self.plain, self.index = io.BytesIO(), [], bytearray(), []

    def add(self, key: tuple, record: bytes) -> None:
        if self.plain and len(self.plain) + len(record) > FRAME_BYTES:
            self.close_frame()
        self.index.append((*key, len(self.sizes), len(self.plain), len(record)))
        self.plain += record

    def close_frame(self) -> None:
        if self.plain:
            frame = zstandard.ZstdCompressor(level=3, write_content_size=True).compress(bytes(self.plain))
            self.out.write(frame)
            self.sizes.append((len(frame), len(self.plain)))
            self.plain = bytearray()

    def write(self, folder: str) -> tuple[str, list]:
        self.close_frame()
        table = b"".join(struct.pack("<II", *x) for x in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEK_MAGIC)
        data = self.out.getvalue() + struct.pack("<II", SKIPPABLE, len(table)) + table
        name = f"{hashlib.sha1(data).hexdigest()}.warc.zst"
        fs, root = open_store(folder)
        fs.create_dir(root, recursive=True)
        part = f"{root}/.{name}.{uuid.uuid4().hex}"
        with fs.open_output_stream(part) as f:
            f.write(data)
        fs.move(part, f"{root}/{name}")
        return name, self.index


def write_bundles(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write every page as a record below ``folder``; returns the index (page_id, record_id, bundle, frame, offset, length)."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"),
    )
    heads = materialize(rows.where(F.octet_length("payload") >= min_bytes).select("page_id", F.sha1("payload").alias("digest")), "warc-heads")
    leader = heads.groupBy("digest").agg(F.min("page_id").alias("refers"), F.count("*").alias("n")).where(F.col("n") > 1)
    # The list of revisits is joined by page, so that a payload of many pages is no hot key for the texts.
    revisits = (
        heads.join(leader.select("digest", "refers"), "digest")
        .where(~F.col("page_id").eqNullSafe(F.col("refers")))
        .groupBy(F.col("page_id").alias("_p"), F.col("digest").alias("_d"))
        .agg(F.min("refers").alias("refers"))
    )
    alike = rows["page_id"].eqNullSafe(revisits["_p"]) & (F.sha1(rows["payload"]) == revisits["_d"])
    rows = rows.join(revisits, alike, "left").select("page_id", "url", "payload", "refers")
    return rows.mapInArrow(lambda batches: _write(batches, folder), INDEX)


def _write(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    bundle = _Bundle()
    for batch in batches:
        page_ids, urls, payloads, leaders = batch.columns
        for i in range(batch.num_rows):  # one payload at a time as a Python object
            page, url, payload, refers = page_ids[i].as_py(), urls[i].as_py(), payloads[i].as_py(), leaders[i].as_py()
            digest = _digest(payload)
            bundle.add((page, record_id(page, digest)), _record(page, url, payload, digest, refers))
            if bundle.out.tell() >= BUNDLE_BYTES:
                yield _index(*bundle.write(folder))
                bundle = _Bundle()
    if bundle.index:
        yield _index(*bundle.write(folder))


def _index(name: str, index: list) -> pa.RecordBatch:
    page, rid, frame, offset, length = zip(*index, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(page, pa.int64()), pa.array(rid, pa.string()), pa.array([name] * len(page)), pa.array(frame, pa.int32()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())],
        names=["page_id", "record_id", "bundle", "frame", "offset", "length"],
    )


def seek_table(fs: pafs.FileSystem, path: str) -> list[tuple[int, int, int]]:
    """(start, compressed size, plain size) of every frame, from the end of the file."""
    size = fs.get_file_info(path).size
    with fs.open_input_file(path) as f:
        f.seek(size - 9)
        n, _, magic = struct.unpack("<IBI", f.read(9))
        if magic != SEEK_MAGIC:
            raise ValueError(f"no seek table at the end of {path}")
        f.seek(size - 9 - 8 * n)
        table = struct.unpack(f"<{2 * n}I", f.read(8 * n))
    frames, at = [], 0
    for packed, plain in zip(table[::2], table[1::2], strict=True):
        frames.append((at, packed, plain))
        at += packed
    return frames


def lookup(folder: str, bundle: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record by its index entry: one seek, one frame."""
    fs, root = open_store(folder)
    start, packed, plain = seek_table(fs, f"{root}/{bundle}")[frame]
    with fs.open_input_file(f"{root}/{bundle}") as f:
        f.seek(start)
        data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=plain)
    head, block, _ = read_record(data, offset)
    return head, block


def read_bundles(spark: SparkSession, folder: str, bundles: DataFrame, payloads: bool = True) -> DataFrame:
    """All records of the bundles named in ``bundles`` (column bundle); without ``payloads`` that column is null."""
    frames = bundles.select("bundle").mapInArrow(lambda b: _frames(b, folder), "bundle string, frame int, start long, packed long, plain long")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return frames.repartition(parts, "bundle", "frame").mapInArrow(lambda b: _read(b, folder, payloads), RECORDS)


def _frames(batches, folder):
    fs, root = open_store(folder)
    for batch in batches:
        rows = [(name, i, *frame) for name in batch.column(0).to_pylist() for i, frame in enumerate(seek_table(fs, f"{root}/{name}"))]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["bundle", "frame", "start", "packed", "plain"])


def _read(batches, folder, payloads):
    fs, root = open_store(folder)
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int64()]
    for batch in batches:
        for bundle, frame, start, packed, plain in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            with fs.open_input_file(f"{root}/{bundle}") as f:
                f.seek(start)
                data = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=plain)
            rows, at = [], 0
            while at < len(data):
                begin = at
                head, block, at = read_record(data, at)
                number = lambda x: int(x) if x else None
                if head["WARC-Type"] == "revisit":
                    digest, size = head["WARC-Payload-Digest"].removeprefix("sha1:"), int(head["X-Payload-Length"])
                else:
                    digest, size = _digest(block), len(block)
                rows.append(
                    (number(head["X-Page-ID"]), head["WARC-Target-URI"] if "WARC-Target-URI" in head else unquote(head["X-Quoted-Target"]), head["WARC-Type"], number(head.get("X-Refers-To-Page", "")),
                     digest, size, block if payloads else None, bundle, frame, begin)
                )
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=RECORD_NAMES)


RECORD_NAMES = ["page_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload", "bundle", "frame", "offset"]


def archive(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, payloads: bool = True) -> tuple[DataFrame, DataFrame]:
    """Write the pages and read the archives back: (index, records)."""
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "warc")
    index = materialize(write_bundles(pages, folder, min_bytes), "warc-index")
    return index, read_bundles(spark, folder, index.select("bundle").distinct(), payloads)
