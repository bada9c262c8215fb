"""Archives: what is written comes back, and damage is found."""

from __future__ import annotations

import base64
import hashlib

import llm_cases as cases
import pytest
import zstandard
from pyspark.sql import functions as F

from tidemark.llm.warc import DICTIONARY_FRAME, frames, page_of, parsed, read_archives, record, write_archives

PAGES = [
    (5, "http://a", "<p>same</p>"),
    (3, "http://b", "<p>same</p>"),
    (9, None, "<p>same</p>"),
    (4, "http://c\r\nX: y", "<p>other é</p>"),
    (6, "http://d", None),
    (7, "http://e", ""),
    (None, "http://f", "<p>same</p>"),
    (None, "http://g", "only without an id"),
    (8, "http://h", "x" * 300_000 + "\r\n\r\nWARC/1.1\r\n"),
    (3, "http://b", "<p>same</p>"),  # a repeated row
    (4, "http://c2", "under a used id"),
    *[(100 + i, f"http://n/{i}", f"<html><body>page {i} with some words {i * 7}</body></html>") for i in range(60)],
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def expected(pages, least_bytes=0):
    first = {}
    for page_id, _, html in pages:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    out = []
    for page_id, url, html in pages:
        html = html or ""
        revisit = len(html.encode()) >= least_bytes and html in first and first[html] != page_id
        url = url and url.replace("\r", "%0D").replace("\n", "%0A")
        out.append((page_id, url, len(html.encode()), digest(html), "revisit" if revisit else "response", first[html] if revisit else None, None if revisit else html))
    return out


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, tmp_path, least):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(3)
    pages = pages.withColumns({c: F.lit("own") for c in (*cases.CLASHING, "content", "first_id", "payload", "archive")})
    folder = str(tmp_path / "w")
    manifest = write_archives(pages, folder, min_revisit_bytes=least, archive_bytes=2000)
    found = read_archives(spark, folder).select(
        page_of("record_id"), "target_uri", "payload_bytes", "payload_digest", "record_type", page_of("refers_to"), F.decode("payload", "UTF-8")
    )
    assert cases.bag(map(tuple, found.collect())) == cases.bag(expected(PAGES, least))
    assert manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    assert manifest.count() > 3 and not list((tmp_path / "w").glob(".*.warc.zst.*"))  # several archives, no drafts
    for path in (tmp_path / "w").glob("*.warc.zst"):
        data = path.read_bytes()
        assert data[:4] == DICTIONARY_FRAME  # enough pages for a dictionary


def test_nothing(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert write_archives(pages, str(tmp_path / "w")).collect() == []
    assert read_archives(spark, str(tmp_path / "w")).collect() == []


def archive(records, dictionary=None, packed=True):
    out = b""
    if dictionary:
        body = zstandard.ZstdCompressor().compress(dictionary) if packed else dictionary
        out = DICTIONARY_FRAME + len(body).to_bytes(4, "little") + body
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    encoder = zstandard.ZstdCompressor(dict_data=known)
    return out + b"".join(encoder.compress(r) for r in records)


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("with_dictionary", [True, False])
def test_frames(packed, with_dictionary):
    records = [record(i, "http://x", b"body %d " % i * (1 + i % 3 * 9000), None, "2020-01-01T00:00:00Z") for i in range(40)]
    dictionary = zstandard.train_dictionary(4096, records * 4).as_bytes() if with_dictionary else None
    data = archive(records, dictionary, packed)
    found = list(frames(data))
    assert [x for _, x in found] == records
    assert all(data[at : at + 4] == b"\x28\xb5\x2f\xfd" for at, _ in found)
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(frames(data[:-3]))


GOOD = record(1, "http://x", b"hello", None, "2020-01-01T00:00:00Z")
DAMAGE = {
    "version": GOOD.replace(b"WARC/1.1", b"WARC/0.9", 1),
    "length": GOOD.replace(b"Content-Length: ", b"Content-Length: 1", 2),
    "cut": GOOD[:-1],
    "payload": GOOD.replace(b"hello", b"hallo"),
    "header": GOOD.replace(b"WARC-Date: ", b"WARC-Date ", 1),
    "missing": GOOD.replace(b"WARC-Date: 2020-01-01T00:00:00Z\r\n", b"", 1),
    "twice": GOOD.replace(b"WARC-Type: response\r\n", b"WARC-Type: response\r\nWARC-Type: response\r\n", 1),
    "text": b"",
}


@pytest.mark.parametrize("kind", DAMAGE)
def test_damaged_records(kind):
    assert parsed(GOOD)["payload"] == b"hello"
    with pytest.raises(ValueError):
        parsed(DAMAGE[kind])


def test_damage_stops_or_is_reported(spark, tmp_path):
    data = archive([GOOD, DAMAGE["payload"], GOOD])
    (tmp_path / "a.warc.zst").write_bytes(data)
    (tmp_path / "b.warc.zst").write_bytes(data[:-2])
    with pytest.raises(Exception, match="block digest differs"):
        read_archives(spark, str(tmp_path)).collect()
    found = read_archives(spark, str(tmp_path), strict=False).collect()
    assert sum(r.problem is None for r in found) == 3 and len(found) == 6
    assert {r.record_type for r in found if r.problem} == {None}
