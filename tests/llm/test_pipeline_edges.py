"""Every stage on odd rows: nulls, empty and very long texts, copies, repeated rows, clashing names, no rows."""

import pytest

import corpus_pipeline

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "_size int, _row string, h int, _copies int, label int, size int, fingerprint string"
)
CLASH = (1, "x", 2, 3, 4, 5, "f")


def odd_rows(spark):
    texts = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(12).collect()
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], *CLASH) for r in texts]
    rows += rows[:2]  # repeated rows
    rows += [(900_001, rows[3][1], "de", None, 1, *CLASH), (900_002, rows[3][1], None, "src0", None, *CLASH)]
    rows += [
        (None, None, None, None, None, *CLASH),
        (None, "", "de", "src1", 0, *CLASH),
        (900_003, "", "de", "src1", 0, *CLASH),
        (900_004, " \n\t", "de", "src1", 3, *CLASH),
        (None, "two words", "en", "src0", 9, *CLASH),
        (900_005, " ".join(f"word{i % 4000}" for i in range(20_000)), "en", "src0", 1, *CLASH),
    ]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_takes_odd_rows(spark, name):
    docs = odd_rows(spark)
    made = dict(corpus_pipeline.STAGES)[name](spark, docs, SF)
    rows = made.collect()
    given = {(r["doc_id"], r["text"]) for r in docs.collect()}
    if name == "token_ids":
        assert len(rows) == docs.count()
        empty = [r for r in rows if r["doc_id"] in (900_003,)]
        assert [r["n_tokens"] for r in empty] == [1]
        return
    assert made.columns == docs.columns and rows
    assert {(r["doc_id"], r["text"]) for r in rows} <= given
    assert all(tuple(r)[5:] == CLASH for r in rows)
    kept = [r["doc_id"] for r in rows]
    if name == "decontaminate":
        assert 900_003 in kept and 900_004 in kept and sum(r["text"] is None for r in rows) == 1
    if name == "mix":
        assert all((r["text"] or "").split() for r in rows)
    if name == "near_duplicates":
        blank = [r for r in rows if not (r["text"] or "").split()]
        copies = [r for r in rows if r["text"] == odd_rows(spark).where("doc_id = 900001").first()["text"]]
        assert len(blank) == 1 and len(copies) <= 1


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stage_takes_an_empty_table(spark, name):
    made = dict(corpus_pipeline.STAGES)[name](spark, odd_rows(spark).where("lang = 'none'"), SF)
    assert made.count() == 0
