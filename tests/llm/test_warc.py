"""Operator 10: exact round trips."""

import gzip
import hashlib
import io

import pytest

from starloom.llm import warc

BIG = "<p>é " * 400


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


ROWS = [
    (1, "http://a/1", BIG), (2, "http://a/2", BIG), (3, None, "small"), (4, "http://a b/é", "small"), (5, "", None), (6, "http://c", ""),
    (7, "http://d", BIG + "x"), (8, "http://e", "y" * 999), (9, "http://f", "y" * 999), (10, "http://g", "z" * 1000), (11, "http://h", "z" * 1000),
    (11, "http://h", "z" * 1000), (None, "http://i", "z" * 1000), (12, "http://j", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 50), (13, "http://k\r\nX: y", "\r\n"),
    (14, "http://l", "long " * 300_000),
]


def test_round_trip(spark):
    back = warc.read_archives(warc.write_archives(warc.mark_revisits(pages(spark, ROWS))), with_payload=True).collect()
    keeper = {}
    for i, _, html in ROWS:
        if len((html or "").encode()) >= 1000 and i is not None:
            keeper[html] = max(i, keeper.get(html, i))
    want = []
    for i, _, html in ROWS:
        data = (html or "").encode()
        revisit = html in keeper and keeper[html] != i
        want.append((i is not None, i or 0, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keeper[html] if revisit else -1, b"" if revisit else data))
    got = [(r.page_id is not None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, -1 if r.refers_to is None else r.refers_to, bytes(r.payload or b"")) for r in back]
    assert sorted(got) == sorted(want)


def test_no_pages(spark):
    assert warc.read_archives(warc.write_archives(warc.mark_revisits(pages(spark, [])))).collect() == []


def test_archives_are_gzip_members(spark):
    manifest = warc.write_archives(warc.mark_revisits(pages(spark, ROWS)))
    assert manifest.groupBy().sum("n_records").first()[0] == len(ROWS)
    from starloom.llm.common import open_shared

    for r in manifest.collect():
        with open_shared(r.archive) as f:
            data = f.read()
        assert len(data) == r.n_bytes
        whole = gzip.decompress(data)
        assert whole.startswith(b"WARC/1.1\r\n") and whole.endswith(b"\r\n\r\n")
        for step in (1, 7, 1 << 20):
            assert b"".join(warc.members(io.BytesIO(data), step)) == whole
        assert len([*warc.members(io.BytesIO(data))]) == r.n_records


def test_damage_is_found():
    payload = b"x" * 2000
    record = warc.record(1, "http://a", payload, hashlib.sha1(payload).hexdigest())
    assert warc.parse(record)[2] == payload
    for bad in (record[:-5], record + b"\r\n", record.replace(b"xxxx", b"xxyx", 1), record.replace(b"WARC/", b"WORC/", 1), b""):
        with pytest.raises(ValueError):
            warc.parse(bad)
    with pytest.raises(ValueError):
        [*warc.members(io.BytesIO(warc.member(record)[:-10]))]


def test_clashing_columns(spark):
    odd = spark.createDataFrame([(1, "u", "h", "s", 5)], "page_id long, url string, html string, sha1 string, refers_to int")
    assert warc.read_archives(warc.write_archives(warc.mark_revisits(odd))).first().payload_bytes == 1


def test_foreign_digests_are_read_by_their_label():
    import base64
    import hashlib

    data = b"some payload"
    sha256 = hashlib.sha256(data)
    for good in (f"sha256:{sha256.hexdigest()}", f"SHA-256:{base64.b32encode(sha256.digest()).decode()}", f"sha1:{hashlib.sha1(data).hexdigest().upper()}", "blake9:whatever", None, ""):
        warc._verify("payload", data, good)
    for bad in (f"sha256:{'0' * 64}", "sha1:AAAA", f"md5:{sha256.hexdigest()}"):
        with pytest.raises(ValueError, match="differs"):
            warc._verify("payload", data, bad)
