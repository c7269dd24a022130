"""Removed bytes against brute force, byte by byte."""

import hashlib
import random
from collections import Counter

import pytest

from reelhouse.llm import queries, repeats


def plain(texts, length=400):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, x in zip(t, gone) if not x)
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def fixture():
    rng = random.Random(5)

    def w(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    parts = [w(n) for n in (380, 399, 400, 401, 450, 700, 2000)]
    texts = [w(300) + p + w(50) for p in parts] + [w(20) + p + w(300) for p in parts]
    texts += [parts[6][100:900] + w(10) + parts[5][200:] + parts[4], "a" * 1500, "a" * 400, "ab" * 700]
    texts += ["b" * 399 + "c" * 399, "", None, w(399), parts[6], parts[6], parts[2] + parts[2]]
    texts += [w(100) + "x" * 900 + w(5000)] + [parts[6][i : i + 420] for i in (0, 3, 50, 1000)]
    return texts


@pytest.mark.parametrize("piece", [repeats.PIECE, 1500])
def test_against_brute_force(spark, monkeypatch, piece):
    monkeypatch.setattr(repeats, "PIECE", piece)
    monkeypatch.setattr(repeats, "_powers", [])
    texts = fixture()
    df = spark.createDataFrame([(i or None, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, open int")
    got = {r["doc_id"]: tuple(r)[1:5] for r in repeats.cut_repeats(df).collect()}
    want = plain([(t or "").encode() for t in texts])
    assert [got[i or None] for i in range(len(texts))] == want


def test_repeated_rows_are_copies_and_kept_text_comes_back(spark):
    rng = random.Random(6)
    long = "".join(rng.choice("pqrs") for _ in range(900))
    df = spark.createDataFrame([(1, long), (1, long), (2, "é" + long[:450] + "é")], "doc_id long, text string")
    rows = sorted((r["doc_id"], r["n_removed"], r["kept"]) for r in repeats.cut_repeats(df, keep=True).collect())
    assert rows == [(1, 900, ""), (1, 900, ""), (2, 450, "éé")]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.cut_repeats(df).count() == 0


def test_query_against_brute_force(spark, documents):
    got = {r["doc_id"]: tuple(r)[1:] for r in queries.op6(spark, "/root/testdata/sf0.001").collect()}
    want = plain([t.encode() for _, t in documents])
    assert [got[i][:-1] for i, _ in documents] == want
    assert [got[i][-1] for i, _ in documents] == [removed > 0 for _, removed, *_ in want]
