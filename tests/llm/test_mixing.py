"""Budgets, targets and the mix."""

import itertools
import random
import re
from collections import Counter

import pytest

from reelhouse.llm import mixing, queries


def test_fit_never_exceeds_and_comes_near():
    rng = random.Random(3)
    for _ in range(200):
        lengths = rng.sample(range(1, 40), rng.randint(1, 6))
        counts = [rng.randint(1, 4) for _ in lengths]
        budget = rng.randint(0, sum(a * c for a, c in zip(lengths, counts)) + 3)
        taken = mixing.fit_budget(lengths, counts, budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        words = sum(t * n for t, n in zip(taken, lengths))
        best = max(
            s
            for pick in itertools.product(*(range(c + 1) for c in counts))
            if (s := sum(k * n for k, n in zip(pick, lengths))) <= budget
        )
        assert best - max(lengths) < words <= best


def test_fit_is_exact_on_large_counts():
    rng = random.Random(4)
    lengths = list(range(3, 900, 2))
    counts = [rng.randint(1, 300) for _ in lengths]
    total = sum(a * c for a, c in zip(lengths, counts))
    for budget in (total // 3, total // 2 + 1, 70_001, total - 40):
        taken = mixing.fit_budget(lengths, counts, budget)
        assert sum(t * n for t, n in zip(taken, lengths)) == budget


@pytest.mark.parametrize("n, longest", [(300, 400), (4000, 20_000), (30_000, 20_000)])
def test_every_length_gives_the_same_share(n, longest):
    """At every size of a source, and for lengths that occur once as for others."""
    rng = random.Random(n)
    found = Counter(rng.randint(1, longest) for _ in range(n))
    lengths, counts = zip(*found.items())
    total = sum(a * c for a, c in found.items())
    for share, phase in ((0.13, 0.0), (0.5, 0.4), (0.9, 0.99)):
        taken = mixing.fit_budget(lengths, counts, int(total * share), phase)
        assert sum(t * a for t, a in zip(taken, lengths)) == int(total * share)
        ranked = sorted(zip(lengths, counts, taken))
        for fifth in range(5):
            part = ranked[len(ranked) * fifth // 5 : len(ranked) * (fifth + 1) // 5]
            words = sum(a * c for a, c, _ in part)
            # The program closes the rest with short documents: at most two of the longest.
            slack = 2 * longest / words + 0.02
            assert abs(sum(a * t for a, _, t in part) / words - share) < slack


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = [s for s in names if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        share = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left} if left else {}
        over = {s for s in left if share[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else share[s] for s in names}
        capped |= over


def check(rows, sizes):
    want = plain_targets(sizes)
    taken = Counter()
    for source, r in rows:
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(want[source])
        assert r["copies"] <= 3
        taken[source] += r["copies"] * r["size"]
    return want, taken


def test_query_meets_every_target(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = mixing.decide(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    assert len(rows) == len(docs)
    sizes = Counter()
    for d in docs.values():
        sizes[d["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", d["text"] or ""))
    want, taken = check([(docs[r["doc_id"]]["source"], r) for r in rows], sizes)
    assert all(abs(taken[s] - want[s]) <= 20 for s in want)
    again = {(r["doc_id"], r["copies"]) for r in mixing.decide(spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert again == {(r["doc_id"], r["copies"]) for r in rows}
    assert queries.op4(spark, sf).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_capped_targets_and_odd_rows(spark):
    rows = [(i, "w " * 10, "a", i) for i in range(3)] + [(i, "w " * 10, "b", i) for i in range(10, 90)]
    rows += [(100, None, "c", 1), (101, " \n", None, 1), (102, "x y z", None, 1), (102, "x y z", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    sizes = {"a": 30, "b": 800, "c": 0, None: 6}
    made = mixing.decide(df).collect()
    source = {r[0]: r[2] for r in rows}
    want, taken = check([(source[r["doc_id"]], r) for r in made], sizes)
    assert want["a"] == 90 and taken["a"] == 90 and want[None] == taken[None]
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns
    assert Counter(r["doc_id"] for r in mixed.collect())[0] == 3


def test_one_length_shared_by_all(spark):
    rows = [(i, "a b c", "x" if i % 3 else "y") for i in range(3000)]
    made = mixing.decide(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken = Counter()
    for r in made:
        taken[r["source_size"]] += r["copies"] * r["size"]
    want = plain_targets({"x": 6000, "y": 3000})
    assert abs(taken[6000] - want["x"]) <= 3 and abs(taken[3000] - want["y"]) <= 3


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.decide(df).count() == 0 and mixing.mix(df).count() == 0
