"""Held-out accuracy, who teaches, and defined cases."""

import zlib

from reelhouse.llm import compression_quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, held_out):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op9(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    judged = [(r["score"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    good = [s for s, y in judged if y == 1]
    bad = [s for s, y in judged if y == 0]
    above = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))
    assert above > 0.85
    assert sum((s >= 0.5) == (y == 1) for s, y in judged) / len(judged) > 0.85


def test_only_rows_that_may_teach_do(spark, held_out):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(60)] + [(None, "x"), (61, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 3) for i in range(62)], "doc_id long, quality int")
    taught = compression_quality.labelled(docs, labels).collect()
    assert {r["doc_id"] for r in taught} == {i for i in range(60) if i % 3 < 2 and not held_out(i)}


def test_model_and_defined_cases(spark):
    good = [f"the quiet river {i} runs past old stone houses and green fields".encode() for i in range(60)]
    bad = [f"BUY!! NOW!! {i} $$$ CLICK!! HERE!! WIN!! $$$".encode() for i in range(60)]
    model = compression_quality.train(good, bad)
    rows = [(1, "old stone houses run past the river"), (2, "CLICK!! WIN!! $$$ BUY!!"), (3, None), (4, ""), (5, "a" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS score")
    score = {r[0]: r[1] for r in df.select("doc_id", model.score("text")).collect()}
    assert score[1] > 0.5 > score[2]
    assert score[3] == score[4] == model.prior
    assert compression_quality.train(good, []).prior == 0.5


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = compression_quality.fit(docs, labels)
    assert docs.select(model.score("text")).first()[0] == 0.5
    assert docs.limit(0).select(model.score("text")).count() == 0


def test_one_row_of_an_id_teaches_and_bytes_are_bounded(spark, monkeypatch):
    taught = []
    monkeypatch.setattr(compression_quality, "train", lambda good, bad: taught.append((good, bad)))
    rows = [(6, f"text {i}", "clash", i) for i in range(3000)] + [(i, "y" * 100, "clash", 0) for i in (9, 12, 15)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string, h int")
    labels = spark.createDataFrame([(6, 1), (9, 0), (12, 0), (15, 0), (6, 1)], "doc_id long, quality int")
    kept = [i for i in (9, 12, 15) if zlib.crc32(str(i).encode()) % 3 != 1]
    compression_quality.fit(docs, labels)
    assert len(taught[0][0]) == (zlib.crc32(b"6") % 3 != 1) and len(taught[0][1]) == len(kept)
    compression_quality.fit(docs, labels, max_bytes=150)
    assert len(taught[1][1]) == min(1, len(kept))
    compression_quality.fit(docs, labels, per_class=2)
    assert len(taught[2][1]) == min(2, len(kept))
