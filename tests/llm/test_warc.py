import base64
import hashlib
import re
from collections import Counter

import pytest

from quotewright.llm import warc

PAGES = "page_id long, url string, html string, digest string, payload string"


@pytest.fixture
def pages(spark):
    rows = [
        (1, "http://a.example/x", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://b.example/\r\nWARC-Type: bad", None), (4, "u", ""),
        (5, "u", "x" * 200_000), (6, "u", "\r\n\r\nWARC/1.1\r\n"), (6, "u", "\r\n\r\nWARC/1.1\r\n"), (None, "u", "lone"), (None, "u", "<p>é</p>"), (7, "", "\n"),
    ]
    return spark.createDataFrame([(*row, "clash", "clash") for row in rows], PAGES)


@pytest.mark.parametrize("least", [0, 9])
def test_records(spark, tmp_path, pages, least):
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path, min_bytes=least)
    rows = [(row["page_id"], (row["html"] or "").encode()) for row in pages.collect()]
    expected = Counter()
    for page, payload in rows:
        keeper = max((p for p, other in rows if other == payload and p is not None), default=None)
        revisit = page is not None and len(payload) >= least and page < keeper
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        expected[(page, len(payload), digest, "revisit" if revisit else "response", keeper if revisit else None)] += 1
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(map(tuple, warc.read_records(spark, path).select(*names).collect())) == expected
    full = Counter((row["page_id"], bytes(row["payload"])) for row in warc.original_records(spark, path).collect())
    assert full == Counter(rows)
    stored = spark.read.parquet(f"{path}/payloads").count()
    assert stored == len({payload for _, payload in rows})


def test_exported_files_parse(spark, tmp_path, pages):
    path, target = str(tmp_path / "archive"), tmp_path / "warc"
    warc.write_archive(pages, path)
    warc.export_warc(spark, path, str(target))
    found = Counter()
    for file in target.glob("part-*"):
        data = file.read_bytes()
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            fields = dict(line.split(b": ", 1) for line in head.split(b"\r\n")[1:])
            length = int(fields[b"Content-Length"])
            assert head.startswith(b"WARC/1.1\r\n") and rest[length : length + 4] == b"\r\n\r\n"
            found[(fields[b"WARC-Type"].decode(), rest[:length] if fields[b"WARC-Type"] == b"response" else None)] += 1
            data = rest[length + 4 :]
    rows = [bytes(row["payload"]) for row in warc.original_records(spark, path).filter("record_type = 'response'").collect()]
    assert sum(found.values()) == pages.count()
    assert Counter(p for (kind, p), n in found.items() for _ in range(n) if kind == "response") == Counter(rows)


def test_damage_ends_the_job(spark, tmp_path, pages):
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path)
    stored = spark.read.parquet(f"{path}/payloads").collect()
    changed = [(row["content_key"], b"other") for row in stored]
    spark.createDataFrame(changed, "content_key string, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="payload does not have its digest"):
        warc.read_records(spark, path).collect()


def test_no_rows(spark, tmp_path, pages):
    path = str(tmp_path / "archive")
    warc.write_archive(pages.limit(0), path)
    assert warc.read_records(spark, path).count() == 0
