"""Codes, the word cache against the tokenizer, and round trips."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from reelhouse.llm import queries, token_file
from reelhouse.llm.huffman import Code, code_lengths

TEXTS = [
    "", "a", " a", "a  b", "a \n b", "x\n  y", "x \ny", "x \n\n y", "don't  stop 's it's", "<|endoftext|> a",
    "é%%% b&&& c. d, e  f", "  ", " \n", "\t a", "a\x1c b", "日本 語", "　 x 1234 ab12!! '' \"q\"", "x.' y", "a…  b",
]


@pytest.mark.parametrize("n", [1, 2, 3, 50, 3000])
def test_codes_decode_and_are_short(n):
    rng = np.random.default_rng(n)
    counts = rng.zipf(1.3, n) % 100_000 + 1
    for limit in (20, max(1, (n - 1).bit_length())):
        lengths = code_lengths(counts, limit)
        assert lengths.max() <= limit and (2.0**-lengths).sum() <= 1
        code = Code(np.sort(rng.choice(60_000, n, replace=False)), lengths)
        for size in (0, 1, 255, 256, 257, 5000):
            ids = rng.choice(code.symbols, size)
            payload, checkpoints = code.encode(ids)
            assert (code.decode(payload, checkpoints, size) == ids).all()
    p = counts / counts.sum()
    average = (p * code_lengths(counts, 20)).sum()
    assert average <= max(1, -(p * np.log2(p)).sum() + 1)


def test_lengths_are_optimal_under_a_limit():
    assert sorted(code_lengths(np.array([1, 1, 2, 4, 8, 16]), 4).tolist()) == [1, 2, 4, 4, 4, 4]


def test_a_block_decodes_from_any_checkpoint():
    rng = np.random.default_rng(7)
    code = Code(np.arange(40), code_lengths(rng.integers(1, 99, 40)))
    ids = rng.integers(0, 40, 1000)
    payload, checkpoints = code.encode(ids)
    assert (code.decode(payload, checkpoints[2:3], 256) == ids[512:768]).all()


def test_words_are_encoded_as_in_the_text():
    plain, cached = Tokenizer.from_file(queries.TOKENIZER), token_file.Encoder(queries.TOKENIZER)
    for text in TEXTS * 2:
        want = plain.encode(text, add_special_tokens=False).ids + [token_file.END_ID]
        assert np.frombuffer(cached.batch([text])[0], cached.dtype).tolist() == want


def test_a_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_file, "CACHE_WORDS", 3)
    plain, cached = Tokenizer.from_file(queries.TOKENIZER), token_file.Encoder(queries.TOKENIZER)
    for ids, text in zip(cached.batch(TEXTS), TEXTS):
        want = plain.encode(text, add_special_tokens=False).ids + [token_file.END_ID]
        assert np.frombuffer(ids, cached.dtype).tolist() == want


def digests(rows):
    """Rows in id order to what the file has to say about them."""
    plain, at, out = Tokenizer.from_file(queries.TOKENIZER), 0, []
    for doc_id, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [token_file.END_ID]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_round_trip(spark, documents):
    rows = queries.op10(spark, "/root/testdata/sf0.001").collect()
    assert sorted(map(tuple, rows)) == digests(documents)


def test_small_blocks_and_ids(spark, documents, tmp_path):
    df = spark.createDataFrame(documents[:40], "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS ids")
    token_file.write_tokens(df, str(tmp_path / "t"), queries.TOKENIZER, block_ids=500)
    assert spark.read.parquet(str(tmp_path / "t/blocks")).count() > 5
    rows = sorted(token_file.read_tokens(spark, str(tmp_path / "t")).collect())
    assert [(r["doc_id"], r["start"], r["n_tokens"]) for r in rows] == [d[:3] for d in digests(documents[:40])]
    assert zlib.crc32(np.array(rows[7]["ids"], "<u4").tobytes()) == digests(documents[:40])[7][3]


def test_odd_rows(spark):
    rows = [(2, None), (None, "a b"), (1, "<|endoftext|>"), (2, "zz"), (2, "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(token_file.round_trip(df, queries.TOKENIZER).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == [None, 1, 2, 2, 2]
    assert token_file.round_trip(df.limit(0), queries.TOKENIZER).count() == 0


def test_words_at_a_line_end_are_learnt_apart():
    plain, cached = Tokenizer.from_file(queries.TOKENIZER), token_file.Encoder(queries.TOKENIZER)
    texts = ["a b\nc", "a b.\nC d", "a 's\n's", "a b\n\nc", "a b\n", "x a\n<b", "a b\r\nc\nd", "é é\nÉ.\n", "b\nc", "a 1\n2", "a b\x85\nc"]
    for text in texts * 2:
        want = plain.encode(text, add_special_tokens=False).ids + [token_file.END_ID]
        assert np.frombuffer(cached.batch([text])[0], cached.dtype).tolist() == want
    cached.batch(["x one", "two"])
    cached.tokenizer = None  # what is known needs no tokenizer
    want = plain.encode("x one\ntwo", add_special_tokens=False).ids + [token_file.END_ID]
    assert np.frombuffer(cached.batch(["x one\ntwo"])[0], cached.dtype).tolist() == want
