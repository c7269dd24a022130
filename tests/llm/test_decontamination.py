"""Hits against brute force, with short items and every case the docstring defines."""

import hashlib
import re

import pytest

from reelhouse.llm import decontamination, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    wanted = {}
    for item, text in items:
        w = words(text)
        m = min(13, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            wanted.setdefault(tuple(w[i : i + m]), set()).add(item)
    sizes = {len(k) for k in wanted}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                at = wanted.get(tuple(w[i : i + m]))
                if at is not None:
                    hit.update(range(i, i + m))
                    found |= at
        names = sorted(str(x) for x in found if x is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


DOCS = [
    (1, "foo BAR é1 zap"), (None, None), (2, ""), (3, "foo bar foo bar baz"), (3, "foo bar foo bar baz"),
    (4, "é1 É1"), (5, " ".join(map(str, range(60)))), (6, "x " * 500 + " ".join(map(str, range(3, 16)))),
    (7, " ".join(map(str, range(12)))), (8, "0 1 2 3 4 5 6 7 8 9 10 11 12, then " * 3),
]
ITEMS = [
    (10, "bar É1"), (2, "foo bar"), (None, "baz"), (11, None), (12, "É1"), (2, "foo bar"), (13, "!"),
    (14, " ".join(map(str, range(20)))), (15, " ".join(map(str, range(13)))),
]


def tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").selectExpr("*", "7 AS items", "0 AS h")
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "'z' AS run")
    return docs, items


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_against_brute_force(spark):
    docs, items = tables(spark)
    assert got(decontamination.digests(docs, items)) == plain(DOCS, ITEMS)


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    docs, items = tables(spark)
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", 0)
    assert got(decontamination.digests(docs, items)) == plain(DOCS, ITEMS)


@pytest.mark.parametrize("limit", [500_000, 0])
def test_a_very_long_text(spark, monkeypatch, limit):
    monkeypatch.setattr(decontamination, "BROADCAST_WINDOWS", limit)
    words = [f"w{i % 9000}" for i in range(20_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[500:520]))]
    items = [(7, " ".join(words[8990:9020])), (8, " ".join(reversed(words[:20])))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(items, "item_id long, text string")
    assert got(decontamination.digests(docs, known)) == plain(rows, items)


def test_removing_documents_and_spans(spark):
    docs, items = tables(spark)
    bad = {r[0] for r in plain(DOCS, ITEMS) if r[5]}
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r[0] for r in kept.collect()), key=repr) == sorted(
        (d for d, _ in DOCS if d not in bad), key=repr
    )
    cut = {r["doc_id"]: r["text"] for r in decontamination.cut_hits(docs, items).collect()}
    assert cut[1] == "é1 zap" and cut[3] == "" and cut[None] is None
    assert cut[5] == " ".join(map(str, range(20, 60)))


def test_empty_tables(spark):
    docs, items = tables(spark)
    assert got(decontamination.digests(docs, items.limit(0))) == plain(DOCS, [])
    assert decontamination.digests(docs.limit(0), items).count() == 0


def test_the_query_runs_whole(spark, documents):
    rows = queries.op3(spark, "/root/testdata/sf0.001").collect()
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()
    want = plain(documents, [(r["item_id"], r["text"]) for r in items])
    assert sorted(map(tuple, rows), key=repr) == want
