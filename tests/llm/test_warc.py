"""Round trips through archives, and the format itself."""

import gzip
import hashlib

from reelhouse.llm import warc

ROWS = [
    (1, "http://a/1", "x" * 100), (2, "u", "x" * 100), (3, None, "y\r\n\r\nWARC/1.1\r\n" * 20), (4, "a\r\nb", None),
    (5, "a", ""), (None, "n", "x" * 100), (2, "u", "x" * 100), (6, "é: b", "é" * 50), (7, "", "é" * 50),
    (8, "", "x" * 99), (9, "", "x" * 99), (10, "", "\r\n\r\n" * 40), (11, "", "z\0﻿" * 40),
]


def plain(rows):
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        first = min((p for p, _, h in rows if (h or "") == (html or "") and p is not None), default=None)
        again = len(raw) >= 100 and first is not None and (page is None or page > first)
        kind = ("revisit", first) if again else ("response", None)
        out.append((page, len(raw), hashlib.sha256(raw).hexdigest(), *kind))
    return sorted(out, key=repr)


def frame(spark, rows=ROWS):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest")


def test_round_trip(spark):
    assert sorted(map(tuple, warc.round_trip(frame(spark)).collect()), key=repr) == plain(ROWS)


def test_payloads_and_headers_read_back(spark, tmp_path):
    path = warc.write_archives(frame(spark), str(tmp_path))
    rows = warc.read_archives(spark, path).collect()
    got = [(r["page_id"], r["payload"]) for r in rows if r["record_type"] == "response"]
    kinds = {r[0]: r[3] for r in plain(ROWS)}
    assert sorted(got) == sorted((p, h or "") for p, _, h in ROWS if kinds[p] == "response")
    assert {r["url"] for r in rows if r["page_id"] == 4} == {"a%0D%0Ab"}


def test_files_are_valid_warc(spark, tmp_path):
    """Every file is a sequence of records by version line, headers and stated length."""
    path = warc.write_archives(frame(spark), str(tmp_path))
    records = 0
    for name in sorted((tmp_path / path.rsplit("/", 1)[1]).glob("part-*.gz")):
        raw = gzip.decompress(name.read_bytes())
        while raw:
            head, _, rest = raw.partition(b"\r\n\r\n")
            lines = head.split(b"\r\n")
            assert lines[0] == b"WARC/1.1"
            fields = dict(line.split(b": ", 1) for line in lines[1:])
            n = int(fields[b"Content-Length"])
            assert rest[n : n + 4] == b"\r\n\r\n"
            assert (b"WARC-Refers-To" in fields) == (fields[b"WARC-Type"] == b"revisit")
            raw, records = rest[n + 4 :], records + 1
    assert records == len(ROWS)


def test_empty(spark):
    assert warc.round_trip(frame(spark).limit(0)).count() == 0
