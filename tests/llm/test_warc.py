import base64
import gzip
import hashlib
import pathlib

import pytest
from pyspark.sql import functions as F

from loomsync.llm import warc

FIELDS = "page_id long, url string, html string, record string"


def _digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


@pytest.fixture
def pages():
    long = "line\r\n" * 9 + "ends in a return\r\r\n" + "é" * 5000 + "\r\nWARC/1.1\r\nContent-Length: 7\r\n\r\n"
    texts = ["<p>one</p>", long, "", None, "<p>one</p>", "\r\n", "\r\n\r\n", "a\r", "x" * 64, "x" * 65, "<p>one</p>", "tail\r\n", long, "\n0\r\n\r\n"]
    rows = [(i, f"http://h/{i}", t, "clash") for i, t in enumerate(texts)]
    return rows + [(4, "http://h/4", "<p>one</p>", "clash"), (None, None, "<p>one</p>", None), (30, "http://h/a b\r\nX: y", "other", None)]


def _written(spark, rows, path, **settings):
    df = spark.createDataFrame(rows, FIELDS)
    warc.write_archives(df, path, **settings)
    return df


@pytest.mark.parametrize("chunk,archive", [(64, 100), (64, 1 << 25), (1 << 16, 1 << 25)])
def test_what_is_written_is_read(spark, pages, tmp_path, chunk, archive):
    path = str(tmp_path / "archives")
    _written(spark, pages, path, chunk=chunk, archive_bytes=archive)
    chunks = warc.read_archives(spark, path, chunk=chunk)
    got = sorted(tuple(r) for r in warc.records(chunks).select(F.coalesce("page_id", F.lit(-1)), "payload_bytes", "payload_digest", "record_type", F.coalesce("refers_to", F.lit(-1))).collect())
    groups = {}
    for i, (page, _, html, _) in enumerate(pages):
        groups.setdefault((html or "").encode(), []).append((-1 if page is None else page, i))
    want = []
    for data, members in groups.items():
        kept = max(members)
        want += [(p, len(data), _digest(data), "response" if (p, i) == kept else "revisit", -1 if (p, i) == kept else kept[0]) for p, i in members]
    assert got == sorted(want)
    payloads = {}
    for r in chunks.where("type = 'response'").orderBy("record", "nth").collect():
        so_far = payloads.setdefault(r["record"], bytearray())
        assert len(r["data"]) <= chunk
        so_far += r["data"]
        assert (r["upto"], r["digest"]) == (len(so_far), _digest(bytes(so_far)))
        assert r["intact"] in ((True,) if r["last"] else (None,))
    assert sorted(map(bytes, payloads.values())) == sorted(groups)


def test_small_payloads_are_all_responses(spark, pages, tmp_path):
    path = str(tmp_path / "archives")
    _written(spark, pages, path, least=11)
    kinds = {(r["payload_bytes"], r["record_type"]) for r in warc.records(warc.read_archives(spark, path, payload=False)).collect()}
    assert (10, "revisit") not in kinds and any(k == "revisit" for _, k in kinds)


def test_bytes_are_a_warc_file(spark, pages, tmp_path):
    path = tmp_path / "archives"
    _written(spark, pages, str(path))
    data = b"".join(gzip.decompress(p.read_bytes()) for p in pathlib.Path(path).glob("*.gz"))
    at, seen = 0, 0
    while at < len(data):
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        assert head.startswith(b"WARC/1.1\r\n") and b"\r\nX: y" not in head
        length = int(next(h for h in head.split(b"\r\n") if h.startswith(b"Content-Length")).split(b":")[1])
        at += len(head) + 4 + length
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4
        seen += 1
    assert seen == len(pages)


def test_other_archives(spark, tmp_path):
    body = b"HTTP/1.1 200 OK\r\nContent-Length: 9\r\n\r\n\x00\xffab\r\ncd\n"
    resource = b"plain bytes without a line end"
    records = [(b"response", b"application/http; msgtype=response", body), (b"warcinfo", b"application/warc-fields", b"a: b\r\n"), (b"resource", b"text/plain", resource), (b"metadata", b"text/plain", b"")]
    data = b"".join(
        gzip.compress(b"WARC/1.0\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:uuid:%d>\r\nContent-Type: %s\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (t, i, c, len(b), b))
        for i, (t, c, b) in enumerate(records)
    )
    (tmp_path / "in.warc.gz").write_bytes(data)
    got = {r["record"]: (r["type"], bytes(r["data"])) for r in warc.read_archives(spark, str(tmp_path / "in.warc.gz")).collect()}
    assert got == {
        "urn:uuid:0": ("response", b"\x00\xffab\r\ncd\n"), "urn:uuid:1": ("warcinfo", b"a: b\r\n"), "urn:uuid:2": ("resource", resource), "urn:uuid:3": ("metadata", b""),
    }
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(gzip.decompress(data)[:250]))
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_archives(spark, str(tmp_path / "cut.warc.gz")).collect()


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "archives")
    _written(spark, [], path)
    assert warc.records(warc.read_archives(spark, path)).count() == 0
