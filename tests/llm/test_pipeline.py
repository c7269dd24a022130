"""The pipeline's stages against brute force on what each was given."""

import itertools

import pytest
from test_decontamination import plain as hits
from test_simhash_trie import components, plain_print

import __spark_entry__ as entry
import corpus_pipeline
from reelhouse.llm import compression_quality, mixing
from reelhouse.session import staged

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        made.append(staged(stage(spark, made[-1], SF), f"test-{name}"))
    return made


def rows(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_stages_keep_the_columns(steps):
    assert len(corpus_pipeline.STAGES) == 5
    assert all(df.columns == steps[0].columns for df in steps[:-1])
    assert all(df.dtypes == steps[0].dtypes for df in steps[:-1])


def test_quality(spark, steps):
    model = compression_quality.fit(steps[0], spark.read.parquet(f"{SF}/labels.parquet"))
    scored = steps[0].select("doc_id", model.score("text").alias("s")).collect()
    assert {r["doc_id"] for r in scored if r["s"] >= 0.5} == {i for i, _ in rows(steps[1])}


def test_one_of_each_group_stays(steps):
    given = rows(steps[1])
    groups = components([plain_print(t) for _, t in given])
    assert rows(steps[2]) == [given[i] for i in sorted(set(groups))]


def test_no_contaminated_document_stays(spark, steps):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {r[0] for r in hits(rows(steps[2]), items) if r[5]}
    assert bad and rows(steps[3]) == [r for r in rows(steps[2]) if r[0] not in bad]


def test_documents_come_as_often_as_decided(steps):
    copies = {r["doc_id"]: r["copies"] for r in mixing.decide(steps[3]).collect()}
    got = {i: len(list(g)) for i, g in itertools.groupby(rows(steps[4]), key=lambda r: r[0])}
    assert got == {i: n for i, n in copies.items() if n}


def test_token_file_holds_the_mix(steps):
    last = sorted(steps[5].collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in last] == [i for i, _ in rows(steps[4])]
    assert all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(last, last[1:]))


def test_registered(spark):
    names = entry.queries()
    assert "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)
