"""WARC archives in seekable Zstandard bundles.

Records are gathered into independent Zstandard frames of about ``FRAME``
bytes; a bundle is a run of frames followed by a seek table in a skippable
frame (the public seekable format), so any frame is found from the file's end
and read alone.  An index table maps every record to (bundle, frame, offset in
the frame, length).

Records of equal payloads of at least ``REVISIT_BYTES`` bytes are stored once:
the one of the largest page id is the response, the others are revisits that
name it.  A revisit keeps the payload's length in its stored HTTP header and
the digest in its WARC header, as the standard's identical-payload profile has
it.

Bundles are written to the shared folder under a name of their own for every
task attempt, and only those in the committed index are read: a lost or
repeated attempt leaves an unused file at most.

Defined cases: null html is the empty payload; a null url leaves the target
out, and characters a header can't hold are percent-encoded; rows that repeat
a page id each have a record, and those that repeat the response's id and
payload are all responses; among equal payloads null ids never are the
response unless all are null; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from abspark.llm.common import bounded_batches, new_folder, staged

FRAME = 1 << 20
BUNDLE = 64 << 20
READ_BYTES = 8 << 20  # of records that one reading task unpacks, about
MOST_TASKS = 20_000
LEVEL = 3
REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the seekable Zstandard format and of the WARC standard.
_SKIPPABLE, _SEEKABLE = 0x184D2A5E, 0x8F92EAB1
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ENTRY, _FOOTER = struct.Struct("<III"), struct.Struct("<IBI")


def open_folder(folder: str):
    """(file system, path) of the shared folder, local or in an object store."""
    from pyarrow import fs

    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:"):
        return fs.LocalFileSystem(), "/" + folder[5:].lstrip("/")
    return fs.FileSystem.from_uri(folder)


def record(page_id, url: str | None, payload: bytes, digest: bytes, refers_to=None, revisit: bool = False) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}",
    ]
    if url is not None:
        head.insert(4, f"WARC-Target-URI: {quote(url, safe=_URL_SAFE)}")
    if revisit:
        head[-1:-1] = [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_name(refers_to)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_URL_SAFE = "%/:?#[]@!$&'()*+,;=-._~"


def _name(page_id) -> str:
    return "<urn:page>" if page_id is None else f"<urn:page:{quote(str(page_id), safe='')}>"


def _page_id(name: str) -> str | None:
    return None if name == "<urn:page>" else unquote(name[10:-1])


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes, int, int]]:
    """(headers, block, offset, length) of every record of a frame."""
    at = 0
    while at < len(data):
        top = data.index(b"\r\n\r\n", at)
        lines = data[at:top].decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        begin = top + 4
        end = begin + int(headers["Content-Length"])
        yield headers, data[begin:end], at, end + 4 - at
        at = end + 4


class BundleWriter:
    """Frames and their seek table for one file."""

    def __init__(self, sink):
        import zstandard

        self.sink, self.frames, self.written = sink, [], 0
        self.packer = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)

    def frame(self, data: bytes) -> None:
        packed = self.packer.compress(data)
        self.sink.write(packed)
        self.written += len(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        table = b"".join(_ENTRY.pack(*f) for f in self.frames)
        self.sink.write(struct.pack("<II", _SKIPPABLE, len(table) + _FOOTER.size))
        self.sink.write(table + _FOOTER.pack(len(self.frames), 0x80, _SEEKABLE))
        self.sink.close()


class BundleReader:
    """Any frame of a bundle by its number, found through the seek table at the file's end."""

    def __init__(self, source):
        import zstandard

        self.source, self.unpacker = source, zstandard.ZstdDecompressor()
        size = source.size()
        source.seek(size - _FOOTER.size)
        count, flags, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != _SEEKABLE or not flags & 0x80:
            raise ValueError("no seek table with checksums at the end of the bundle")
        source.seek(size - _FOOTER.size - count * _ENTRY.size)
        self.table = list(_ENTRY.iter_unpack(source.read(count * _ENTRY.size)))
        self.starts = [0]
        for packed, _, _ in self.table:
            self.starts.append(self.starts[-1] + packed)

    def __len__(self) -> int:
        return len(self.table)

    def frame(self, i: int) -> bytes:
        self.source.seek(self.starts[i])
        data = self.unpacker.decompress(self.source.read(self.table[i][0]))
        if len(data) != self.table[i][1] or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table[i][2]:
            raise ValueError("a frame does not match the seek table")
        return data


def write_archive(pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Write ``pages`` (page_id, url, html); returns the folder and the index table."""
    spark = pages.sparkSession
    bounded_batches(spark, 500)
    folder = folder or new_folder(spark, "warc")
    kind = pages.schema["page_id"].dataType
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha1("html")).withColumn("n", F.octet_length("html"))
    # Summed by digest before the shuffle; only payloads met more than once are kept.
    again = rows.select("page_id", "digest", "n").filter(F.col("n") >= REVISIT_BYTES).groupBy("digest", "n")
    again = again.agg(F.max("page_id").alias("first"), F.count("*").alias("copies")).filter("copies > 1 and first is not null").drop("copies")
    again = staged(again, "responses", folder)  # a table of its own: the join can split a payload of many pages
    rows = rows.join(again, ["digest", "n"], "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    rows = rows.select("page_id", "url", "html", "first", revisit.alias("revisit"))
    schema = T.StructType([T.StructField("page_id", kind), T.StructField("bundle", T.StringType()), T.StructField("frame", T.IntegerType()),
                           T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(f"{folder}/bundles")
        files.create_dir(path, recursive=True)
        part = TaskContext.get().partitionId()
        writer, bundle, frame, held, index = None, "", [], 0, []

        def flush() -> None:
            nonlocal held
            if frame:
                writer.frame(b"".join(frame))
                frame.clear()
                held = 0

        def done() -> pa.RecordBatch:
            nonlocal writer
            flush()
            writer.close()
            writer = None
            columns = list(zip(*index, strict=True))
            index.clear()
            ids = pa.concat_arrays(columns[0])
            return pa.RecordBatch.from_arrays([ids, pa.array(columns[1]), pa.array(columns[2], pa.int32()), pa.array(columns[3], pa.int64()), pa.array(columns[4], pa.int64())], names=names)

        for batch in batches:
            ids, urls, payloads, firsts, revisits = batch.columns
            for i in range(len(ids)):
                if writer is None:
                    bundle = f"part-{part:05d}-{uuid.uuid4().hex}.warc.zst"
                    writer = BundleWriter(files.open_output_stream(f"{path}/{bundle}", compression=None))
                payload = (payloads[i].as_py() or "").encode("utf-8", "surrogatepass")
                data = record(ids[i].as_py(), urls[i].as_py(), payload, hashlib.sha1(payload).digest(), firsts[i].as_py(), revisits[i].as_py())
                index.append((ids.slice(i, 1), bundle, len(writer.frames), held, len(data)))
                frame.append(data)
                held += len(data)
                if held >= FRAME:
                    flush()
                if writer.written >= BUNDLE:
                    yield done()
        if writer is not None:
            yield done()

    return folder, staged(rows.mapInArrow(run, schema), "index", folder)


def _described(headers: dict[str, str], block: bytes) -> tuple:
    top = block.index(b"\r\n\r\n") + 4
    length = int(next(x for x in block[:top].decode().split("\r\n") if x.startswith("Content-Length: "))[16:])
    digest = base64.b32decode(headers["WARC-Payload-Digest"][5:])
    kind = headers["WARC-Type"]
    if kind == "response" and (len(block) - top != length or hashlib.sha1(block[top:]).digest() != digest):
        raise ValueError("a payload does not match its digest")
    return _page_id(headers["WARC-Record-ID"]), length, digest.hex(), kind, _page_id(headers["WARC-Refers-To"]) if kind == "revisit" else None


def _tasks(size: int) -> int:
    return min(MOST_TASKS, 1 + size // READ_BYTES)


def read_archive(index: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record, from the committed bundles themselves."""
    kind = index.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(f"{folder}/bundles")
        for batch in batches:
            for bundle, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with files.open_input_file(f"{path}/{bundle}") as source:
                    found = [_described(h, b) for h, b, _, _ in parse(BundleReader(source).frame(frame))]
                columns = list(zip(*found, strict=True))
                types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["id", "payload_bytes", "payload_digest", "record_type", "first"])

    frames = index.groupBy("bundle", "frame").agg(F.sum("length").alias("bytes"))
    # The list is short, what it stands for is not: as many tasks as the bytes ask for.
    tasks = _tasks(frames.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0])
    out = frames.select("bundle", "frame").repartition(tasks, "bundle", "frame").mapInArrow(run, "id string, payload_bytes long, payload_digest string, record_type string, first string")
    return out.select(F.col("id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("first").cast(kind).alias("refers_to"))


def fetch(index: DataFrame, folder: str, page_ids: DataFrame) -> DataFrame:
    """(page_id, record): the stored records of the wanted ids, each by reading its own frame only."""
    wanted = index.join(page_ids.select("page_id").distinct(), "page_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = open_folder(f"{folder}/bundles")
        for batch in batches:
            out, held, data = [], None, b""
            for _, bundle, frame, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (bundle, frame) != held:
                    with files.open_input_file(f"{path}/{bundle}") as source:
                        held, data = (bundle, frame), BundleReader(source).frame(frame)
                out.append(data[offset : offset + length])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["page_id", "record"])

    schema = T.StructType([index.schema["page_id"], T.StructField("record", T.BinaryType())])
    wanted = staged(wanted.select("page_id", "bundle", "frame", "offset", "length"), "wanted")
    tasks = _tasks(wanted.select("bundle", "frame").distinct().count() * FRAME)
    return wanted.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame").mapInArrow(run, schema)


def op7_warc_bundles(pages: DataFrame) -> DataFrame:
    folder, index = write_archive(pages)
    return read_archive(index, folder)
