"""Archives written and read back: ranges of any size, false starts, revisits, broken members."""

import base64
import gzip
import hashlib
import io
import os
import random
import zlib

import pytest
from pyspark.sql import functions as F

from clearbook.llm import warc
from clearbook.llm.queries import QUERIES
from clearbook.session import run_folder

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (4, "http://a/", "same"),
    (2, "http://b/", "same"),
    (9, None, "same"),
    (1, "http://c/\r\nX: y", None),
    (7, "http://d/", ""),
    (3, "http://e/é", "é" * 5000),
    (None, "http://f/", "same"),
    (None, "http://g/", "alone"),
    (5, "http://h/", "twin"),
    (5, "http://h/", "twin"),
    (6, "http://i/", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\x1f"),
    (8, "http://j/", "long " * 200_000),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def plain(rows, least=0):
    first = {}
    for page_id, _, html in rows:
        if page_id is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(page_id, first.get(html or "", page_id))
    result = []
    for page_id, url, html in rows:
        smallest = first.get(html or "")
        refers = smallest if smallest is not None and smallest != page_id else None
        result.append((page_id, len((html or "").encode()), digest(html), "response" if refers is None else "revisit", refers))
    return sorted(result, key=str)


def read_back(spark, path, **how):
    records = warc.outermost(warc.read_archives(spark, path, **how))
    names = [warc.page_of(F.col("record_id")), "payload_bytes", "digest", "record_type", warc.page_of(F.col("refers_to"))]
    return sorted((tuple(r) for r in records.select(*names).collect()), key=str)


def archived(spark, rows, **how):
    path = run_folder(spark, "archives")
    clash = {"digest": F.lit(1), "_hash": F.lit("x"), "payload": F.lit(2), "_first": F.lit(0), "last": F.lit(0)}
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).withColumns(clash), path, **how)
    return path


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    path = archived(spark, ROWS, least_bytes=least)
    for size in (37, 300, 1 << 26):
        assert read_back(spark, path, range_bytes=size) == plain(ROWS, least)
    # Any reader of gzip members sees whole files of records.
    records = 0
    for name in os.listdir(path):
        if name.startswith("part-"):
            with open(f"{path}/{name}", "rb") as file:
                records += gzip.decompress(file.read()).count(b"WARC/1.1\r\nWARC-Type: re") if os.path.getsize(f"{path}/{name}") else 0
    assert records == len(ROWS) + 1
    texts = {r["record_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, path).where("record_type = 'response'").collect()}
    assert texts["<urn:page:8>"] == ROWS[-1][2] and texts["<urn:page:1>"] == ""


def test_of_no_pages(spark):
    path = archived(spark, [])
    assert read_back(spark, path) == []


def test_records_over_16_mib(spark):
    rng = random.Random(1)
    rows = [(1, "u", "".join(rng.choices("abcdefgh", k=1000)) * 17_000), (2, "v", "small")]
    path = archived(spark, rows)
    assert read_back(spark, path, range_bytes=1 << 20) == plain(rows)


def records_in(content, cuts):
    found = []
    for start, stop in zip([0, *cuts], [*cuts, len(content)], strict=True):
        found += list(warc.Range(io.BytesIO(content), start, stop).records())
    return found


def test_every_record_has_one_owner():
    """However a file is cut, each record comes once; magic inside a member, and rubbish between members, are passed over."""
    rng = random.Random(5)
    members = []
    for k in range(30):
        payload = rng.randbytes(rng.choice([0, 1, 400]))
        if k % 5 == 0:
            payload = (warc.MAGIC + rng.randbytes(20)) * 10
        members.append(warc.member(k, "u", payload, len(payload), digest(""), None, level=0))
    broken = members[3][:-9]
    content = b"".join([*members[:10], b"rubbish" + warc.MAGIC * 3, *members[10:20], broken, *members[20:], warc.MAGIC])
    whole = [(at, end) for at, end, _ in records_in(content, [])]
    assert len(whole) == 30 and all(content[at:end] in members for at, end in whole)
    for _ in range(60):
        cuts = sorted(rng.sample(range(1, len(content)), rng.randint(1, 40)))
        assert [(at, end) for at, end, _ in records_in(content, cuts)] == whole
    for at in (whole[4][0] + d for d in range(-3, 4)):
        assert [(a, e) for a, e, _ in records_in(content, [at])] == whole


def test_archive_inside_a_record(spark, tmp_path):
    """A stored archive in a payload is found by the range that starts in it, and left out as not outermost."""
    inner = b"".join(warc.member(k, "in", b"x" * 50, 50, digest(""), None, level=0) for k in range(100, 110))
    outer = [warc.member(k, "out", inner if k == 2 else b"y" * 30, 0, digest(""), None, level=0) for k in range(4)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(outer))
    records = warc.read_archives(spark, str(tmp_path), range_bytes=600)
    assert records.count() > 4
    kept = warc.outermost(records).select(warc.page_of(F.col("record_id"))).collect()
    assert sorted(page for (page,) in kept) == [0, 1, 2, 3]


def test_other_gzip_files_and_headers():
    packed = gzip.compress(b"hello" * 100)
    assert records_in(packed * 3, [5, 50]) == []
    assert warc.parsed(b"WARC/1.0\r\nContent-Length: 99\r\n\r\nshort") is None
    fields = warc.parsed(b"WARC/1.0\r\nWARC-Type: metadata\r\nContent-Length: 4\r\n\r\nabcd\r\n\r\n")
    assert fields["record_type"] == "metadata" and fields["payload"] == b"abcd" and fields["record_id"] is None
    assert zlib.decompress(warc.member(1, "u", None, 7, "D", 2), 31).count(b"\r\n\r\n") == 3


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in QUERIES["op13_warc"](spark, sf_dir).select(*names).collect()), key=str) == plain(rows)
