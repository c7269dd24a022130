"""The language model against a plain reading of its definition."""

import math
import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reelhouse.llm import katz, queries

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def tokens_of(text):
    return [*(text or "").encode().translate(LOWER).split(), b""]


class Plain:
    """The same model from dictionaries."""

    def __init__(self, texts):
        self.words = Counter(w for t in texts for w in tokens_of(t))
        self.pairs = Counter(p for t in texts for p in zip([b"", *tokens_of(t)], tokens_of(t)))
        self.n, self.v = sum(self.words.values()), len(self.words)
        self.first = Counter()
        self.after = {}
        for (v, w), c in self.pairs.items():
            self.first[v] += c
            self.after.setdefault(v, {})[w] = c
        self.d1 = katz.discounts([sum(c == r for c in self.words.values()) for r in range(1, katz.K + 2)])
        self.d2 = katz.discounts([sum(c == r for c in self.pairs.values()) for r in range(1, katz.K + 2)])

    def share(self, counts, total, rates, c):
        total += not any(x <= katz.K for x in counts.values())
        return c * (rates[c - 1] if c <= katz.K else 1) / total

    def word(self, w):
        if w in self.words:
            return self.share(self.words, self.n, self.d1, self.words[w])
        return 1 - sum(self.share(self.words, self.n, self.d1, c) for c in self.words.values())

    def pair(self, v, w):
        after = self.after.get(v)
        if after is None:
            return self.word(w)
        if w in after:
            return self.share(after, self.first[v], self.d2, after[w])
        left = 1 - sum(self.share(after, self.first[v], self.d2, c) for c in after.values())
        return left / (1 - sum(self.word(x) for x in after)) * self.word(w)

    def score(self, text):
        found = tokens_of(text)
        return sum(math.log10(self.pair(v, w)) for v, w in zip([b"", *found], found))

    def base(self, text):
        return sum(math.log10((self.words[w] + 0.5) / (self.n + 0.5 * (self.v + 1))) for w in tokens_of(text))


def made_texts(seed=3, n=60):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, weights=range(40, 0, -1), k=rng.randint(0, 60))) for _ in range(n)]
    return [*texts, *texts[:5], None, "", " \t\n", "the " * 400, "nie gesehen Wörter ein", "x"]


def run(spark, texts, teaches, **sizes):
    rows = [(i, t, teaches(i), "clash") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "id long, body string, block boolean, words string").repartition(5, "id")
    return katz.learn_and_score(docs, "id", "body", F.col("block"), **sizes)


@pytest.mark.parametrize("sizes", [{}, {"block_tokens": 150, "bucket_pairs": 200, "split": 20}])
def test_scores_equal_the_definition(spark, sizes):
    texts = made_texts()
    model = run(spark, texts, lambda i: i % 4 != 1, **sizes)
    plain = Plain([t for i, t in enumerate(texts) if i % 4 != 1])
    rows = {r["key"]: r for r in model.scores.collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        assert rows[i]["n_tokens"] == len(tokens_of(text))
        assert rows[i]["n_known"] == sum(w in plain.words for w in tokens_of(text))
        assert rows[i]["base_score"] == pytest.approx(plain.base(text), rel=1e-9)
        assert rows[i]["score"] == pytest.approx(plain.score(text), rel=1e-9, abs=1e-9)
    assert (model.unigrams.total, model.unigrams.distinct) == (plain.n, plain.v)


def test_every_context_sums_to_one(spark):
    texts = made_texts(seed=5)
    model = run(spark, texts, lambda i: True, block_tokens=150, bucket_pairs=200, split=20)
    words = {r["id"]: r["c"] for r in model.words.collect()}
    import numpy as np

    share = dict(zip(words, model.unigrams.share(np.array(list(words.values())))))
    assert sum(share.values()) + model.unigrams.left == pytest.approx(1)
    pairs = {}
    for r in model.pairs.collect():
        assert (r["first"], r["second"]) not in pairs.get(r["first"], {})
        pairs.setdefault(r["first"], {})[r["second"]] = r["c"]
    contexts = {r["id"]: r for r in model.contexts.collect()}
    assert set(contexts) == set(pairs)
    for v, after in pairs.items():
        seen = sum(katz._reduced(np.array([c]), model.rates)[0] for c in after.values()) / contexts[v]["total"]
        unseen = model.unigrams.left + sum(p for w, p in share.items() if w not in after)
        assert seen + 10 ** contexts[v]["log_alpha"] * unseen == pytest.approx(1, abs=1e-9)


def test_nothing_to_learn_from_and_nothing_at_all(spark):
    model = run(spark, ["a b", None], lambda i: False)
    assert sorted(tuple(r) for r in model.scores.collect()) == [(0, 3, 0, 0.0, 0.0), (1, 1, 0, 0.0, 0.0)]
    empty = spark.createDataFrame([], "id long, body string")
    assert katz.learn_and_score(empty, "id", "body", F.lit(True)).scores.count() == 0


def test_null_keys_and_repeated_rows(spark):
    docs = spark.createDataFrame([(None, "a b"), (1, "a b"), (1, "a b")], "id long, body string")
    rows = katz.learn_and_score(docs, "id", "body", F.lit(True)).scores.collect()
    assert sorted(str(r["key"]) for r in rows) == ["1", "1", "None"]
    assert len({r["score"] for r in rows}) == 1


def test_discounts_stay_between_zero_and_one():
    assert katz.discounts([0] * 6) == tuple((r - 0.5) / r for r in range(1, 6))
    for counts in ([100, 40, 20, 12, 8, 5], [5, 90, 1, 0, 3, 3], [1, 1, 1, 1, 1, 1]):
        assert all(0 < d < 1 for d in katz.discounts(counts))


def test_query_beats_the_base_on_held_out_texts(spark, documents):
    rows = queries.QUERIES["op13_katz_backoff"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == len(documents)
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in documents}
    plain = Plain([t for i, t in documents if not held[i]])
    texts = dict(documents)
    for r in rows:
        assert r["held_out"] == held[r["doc_id"]]
        assert r["train_tokens"] == plain.n
        assert r["base_score"] == pytest.approx(plain.base(texts[r["doc_id"]]), rel=1e-9)
    for r in rows[:20]:
        assert r["score"] == pytest.approx(plain.score(texts[r["doc_id"]]), rel=1e-9)
    for part in (True, False):
        mine = [r for r in rows if r["held_out"] == part]
        assert sum(r["score"] for r in mine) > sum(r["base_score"] for r in mine)
