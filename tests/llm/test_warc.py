import gzip
import hashlib
import io
import zlib

import pytest
from tests.llm.cases import CLASHING, by_id, prose

from gridscout.llm import warc as A
from gridscout.llm.common import work_folder


def pages(spark, rows):
    clashing = "".join(f", `{c}` int" for c in [*CLASHING, "digest", "first", "payload"])
    full = [(*r, *[0] * (len(CLASHING) + 3)) for r in rows]
    return spark.createDataFrame(full, f"page_id long, url string, html string{clashing}").repartition(3)


def rows():
    long = "<p>" + prose(1, 60) + "é</p>"
    return [
        (5, "http://a/5", long),
        (3, "http://a/3", long),
        (9, "http://a/9", long),
        (4, None, "short"),
        (6, "http://a/x y\r\nWARC-Type: revisit", "short"),
        (7, "http://a/7", None),
        (8, "http://a/8", ""),
        (1, "http://a/1", "\r\n\r\n" * 40 + "日本"),
        (2, "http://a/2", "x" * 300_000),
        (10, "http://a/10", "a" * 99),
        (11, "http://a/11", "a" * 99),
        (12, "http://a/12", "b" * 100),
        (13, "http://a/13", "b" * 100),
        (12, "http://a/12", "b" * 100),
        (None, "http://a/none", long),
        (14, "http://a/14", "é" * 50),
        (15, "http://a/15", "é" * 50),
        (16, None, "the smaller"),
        (16, None, "the smaller and more"),
    ]


def brute():
    texts = {}
    for i, _, html in rows():
        if i is not None:
            texts[i] = min(texts.get(i, html or ""), html or "")
    firsts, out = {}, {}
    for i in sorted(texts):
        data = texts[i].encode()
        first = firsts.setdefault(data, i) if len(data) >= 100 else i
        out[i] = (len(data), hashlib.sha256(data).hexdigest(), "response" if first == i else "revisit", None if first == i else first, data if first == i else None)
    return out


def found(df):
    return {i: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload)) for i, r in by_id(df, "page_id").items()}


def test_round_trip(spark):
    manifest = A.write_warc(pages(spark, rows()), work_folder(spark, "warc"))
    out = A.read_warc(manifest)
    assert found(out) == brute()
    assert all(r.valid for r in out.collect())
    urls = {r.page_id: r.url for r in out.collect()}
    assert urls[4] is None and urls[5] == "http://a/5" and urls[6] == "http://a/x%20y%0D%0AWARC-Type:%20revisit"
    assert sum(r.records for r in manifest.collect()) == len(brute())


def test_small_archives(spark):
    manifest = A.write_warc(pages(spark, rows()), work_folder(spark, "warc"), archive_bytes=1)
    assert manifest.count() == len(brute())
    assert found(A.read_warc(manifest)) == brute()


def test_every_record_is_a_gzip_member(spark):
    from pyarrow import fs

    for r in A.write_warc(pages(spark, rows()), work_folder(spark, "warc")).collect():
        system, path = fs.FileSystem.from_uri(r.archive)
        data = system.open_input_stream(path, compression=None).read()
        assert len(data) == r.bytes
        text = gzip.decompress(data)
        assert text.count(b"WARC/1.1\r\n") == r.records == len(list(A.members(io.BytesIO(data))))


class Trickle(io.BytesIO):
    def read(self, n=-1):
        return super().read(min(n, 7))


def test_reader_at_any_chunk_size():
    data = b"".join(A.record(i, "u", prose(i, 50).encode(), None, "d") for i in range(5))
    assert [A.parse(m)["page_id"] for m in A.members(Trickle(data))] == [0, 1, 2, 3, 4]
    assert list(A.members(io.BytesIO(b""))) == []


def test_broken_archives():
    good = A.record(1, "u", b"payload" * 30, None, "d")
    for bad in (good[:-5], good[:20], b"plain text", good + b"rest"):
        with pytest.raises(A.WarcError):
            [A.parse(m) for m in A.members(io.BytesIO(bad))]
    text = gzip.decompress(good)
    pack = lambda x: list(map(A.parse, A.members(io.BytesIO(gzip.compress(x)))))
    assert pack(text)[0]["valid"]
    assert not pack(text.replace(b"payloadpayload", b"payloadPAYLOAD", 1))[0]["valid"]
    for bad in (text[:-4], text.replace(b"WARC/1.1", b"XXXX/1.1", 1), text.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 1)):
        with pytest.raises(A.WarcError):
            pack(bad)
    assert zlib.crc32(text)


def test_empty_tables(spark):
    manifest = A.write_warc(pages(spark, []), work_folder(spark, "warc"))
    assert manifest.collect() == [] and A.read_warc(manifest).collect() == []
