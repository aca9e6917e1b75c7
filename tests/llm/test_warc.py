import base64
import gzip
import hashlib
import os
import tempfile

from ticklake.llm import warc

FAKE = "a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nb"


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, id bigint, payload string")


def back(spark, rows):
    path = tempfile.mkdtemp(prefix="warc-") + "/a"
    warc.write_warc(warc.prepared(pages(spark, [(*r, 7, "clash") for r in rows])), path)
    return path, warc.resolve(warc.read_warc(spark, path))


def expected(rows):
    least = {}
    for i, _, html in rows:
        h = (html or "").encode()
        if i is not None:
            least[h] = min(i, least.get(h, i))
    out = []
    for i, _, html in rows:
        h = (html or "").encode()
        revisit = least.get(h) is not None and least[h] != i
        out.append((i, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "revisit" if revisit else "response", least[h] if revisit else None))
    return out


def key(r):
    return tuple((x is not None, x) for x in r)


def test_round_trip(spark):
    rows = [(3, "http://a/", "same"), (1, "http://b/", "same"), (2, None, "same"), (4, "http://c/\r\nX: 1", "é\r\n\r\nü"), (5, "u", None), (6, "u", ""),
            (7, "u", "long " * 300_000), (8, "u", FAKE), (9, "v", FAKE), (None, "w", "same"), (1, "http://b/", "same"), (None, None, "alone"), (None, None, "alone")]
    path, got = back(spark, rows)
    found = [tuple(r) for r in got.select("id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()]
    assert sorted(found, key=key) == sorted(expected(rows), key=key)
    payloads = {r.id: bytes(r.payload).decode() for r in got.where("record_type = 'response'").collect()}
    assert payloads[8] == FAKE and payloads[4] == "é\r\n\r\nü" and len(payloads[7]) == 1_500_000
    assert got.where("url like '%\n%'").count() == 0


def test_archives_are_well_formed(spark):
    path, _ = back(spark, [(1, "http://a/", "x"), (2, "http://a/", "x"), (3, "http://a/", FAKE)])
    seen = 0
    for name in os.listdir(path):
        if name.startswith("part-"):
            data, at = open(f"{path}/{name}", "rb").read(), 0
            while at < len(data):
                end = data.index(b"\r\n\r\n", at)
                head = dict(line.split(b": ", 1) for line in data[at:end].split(b"\r\n")[1:])
                assert data[at:at + 10] == b"WARC/1.1\r\n" and {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(head)
                at = end + 4 + int(head[b"Content-Length"]) + 4
                assert data[at - 4:at] == b"\r\n\r\n"
                seen += 1
    assert seen == 3


def test_empty(spark):
    _, got = back(spark, [])
    assert got.count() == 0


def test_foreign_compressed_archive_and_rededuplication(spark):
    def record(kind, n, body, more=""):
        block = f"HTTP/1.0 200 OK\r\nContent-Length: {len(body)}\r\n\r\n".encode() + (body if kind == "response" else b"")
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        return (f"WARC/1.1\r\nwarc-type: {kind}\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:{n}>\r\nX-Source-Id: {n}\r\nWARC-Target-URI: http://x/{n}\r\nWARC-Payload-Digest: sha1:{digest}\r\n{more}"
                f"Content-Type: application/http; msgtype=response\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"

    folder = tempfile.mkdtemp(prefix="warc-")
    with open(f"{folder}/x.warc.gz", "wb") as f:  # a member for each record
        for r in (record("response", 5, b"\xff\xfe one"), record("revisit", 2, b"\xff\xfe one", "WARC-Refers-To: <urn:uuid:5>\r\n"), record("revisit", 9, b"lost"), record("response", 7, b"two")):
            f.write(gzip.compress(r))
    got = warc.resolve(warc.read_warc(spark, folder))
    assert {(r.id, r.record_type, r.payload_bytes, r.refers_to) for r in got.collect()} == {
        (5, "response", 6, None), (2, "revisit", 6, 5), (9, "revisit", 4, None), (7, "response", 3, None)}
    fresh = folder + "-new"
    warc.rededuplicate(got, fresh)
    again = warc.resolve(warc.read_warc(spark, fresh)).collect()
    assert {(r.id, r.record_type, r.refers_to) for r in again} == {(2, "response", None), (5, "revisit", 2), (7, "response", None)}
    assert next(bytes(r.payload) for r in again if r.id == 2) == b"\xff\xfe one"
