"""op7: round trip, seek table, random access."""

import hashlib
import io
from collections import defaultdict

import zstandard

from abspark.llm import warc_bundles as w

PAGE = "p" * 1200


def pages(spark, n=60):
    rows = [(i, f"http://h{i % 3}/ä\r\nX: {i}", f"<p>{i}</p>" * (i * 7)) for i in range(n)]
    rows += [(100, None, None), (101, "u", ""), (102, "u", PAGE), (103, "u", PAGE), (104, "u", PAGE), (105, "u", "short"), (106, "u", "short"), (107, "u", "é漢" * 300000)]
    rows += [(104, "again", PAGE), (None, "null id", PAGE), (None, "null id", "q" * 2000), (None, None, "q" * 2000)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, digest string, n int")


def expected(rows):
    first = defaultdict(list)
    for r in rows:
        first[r.html or ""].append(r.page_id)
    out = []
    for r in rows:
        raw = (r.html or "").encode()
        ids = [i for i in first[r.html or ""] if i is not None]
        top = max(ids) if len(raw) >= 1000 and ids else r.page_id
        kind = "response" if r.page_id == top else "revisit"
        out.append((r.page_id, len(raw), hashlib.sha1(raw).hexdigest(), kind, None if kind == "response" else top))
    return sorted(out, key=str)


def test_read_back_archive(spark):
    docs = pages(spark)
    got = sorted((tuple(r) for r in w.op7_warc_bundles(docs).collect()), key=str)
    assert got == expected(docs.collect())
    assert w.op7_warc_bundles(docs.limit(0)).count() == 0


def test_index_finds_every_record_in_its_frame(spark):
    docs = pages(spark, 20)
    folder, index = w.write_archive(docs)
    assert index.count() == docs.count()
    ids = docs.filter("page_id in (3, 103, 107)").select("page_id")
    got = {r.page_id: bytes(r.record) for r in w.fetch(index, folder, ids).collect()}
    assert set(got) == {3, 103, 107}
    (headers, block, at, length), = w.parse(got[103])
    assert (headers["WARC-Type"], headers["WARC-Refers-To"], at, length) == ("revisit", "<urn:page:104>", 0, len(got[103]))
    assert block.endswith(b"\r\n\r\n") and PAGE.encode() not in block
    (headers, block, *_), = w.parse(got[3])
    assert headers["WARC-Target-URI"] == "http://h0/%C3%A4%0D%0AX:%203" and block.endswith(b"<p>3</p>" * 21)


def test_reading_takes_as_many_tasks_as_the_bytes_ask_for(spark, monkeypatch):
    """The frame list is tiny; adaptive planning must not make one task of it."""
    monkeypatch.setattr(w, "FRAME", 2000)
    monkeypatch.setattr(w, "READ_BYTES", 4000)
    docs = pages(spark, 200)
    folder, index = w.write_archive(docs)
    size = index.agg({"length": "sum"}).first()[0]
    assert size > 10 * w.READ_BYTES
    read = w.read_archive(index, folder)
    assert read.rdd.getNumPartitions() == 1 + size // w.READ_BYTES
    assert read.count() == docs.count()
    got = w.fetch(index, folder, docs.select("page_id"))
    assert got.rdd.getNumPartitions() > 10 and got.count() == docs.filter("page_id is not null").count()


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_bundles_are_plain_zstandard_with_independent_frames():
    class Sink(io.BytesIO):
        def close(self):
            pass

    sink, frames = Sink(), [b"one" * 1000, b"", b"three" * 5]
    writer = w.BundleWriter(sink)
    for f in frames:
        writer.frame(f)
    writer.close()
    reader = w.BundleReader(Source(sink.getvalue()))
    assert [reader.frame(i) for i in (2, 0, 1)] == [frames[2], frames[0], frames[1]]
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(sink.getvalue()), read_across_frames=True)
    assert plain.read() == b"".join(frames)
