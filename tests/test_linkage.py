"""Linkage against brute force and golden cases."""

import random

import pytest
from pyspark.sql import functions as F

from reelhouse.functions.text import token_set
from reelhouse.operators import linkage as L
from reelhouse.operators.ranking import rank_within

BANDS = [L.Band("year", 1), L.Band("rt", 2, (None, 0))]
DDL = "key string, words array<string>, lang string, year int, rt int"


def fits(a, b):
    if a[2].lower() != b[2].lower() or a[3] is None or b[3] is None or abs(a[3] - b[3]) > 1:
        return False
    ra, rb = a[4] or 0, b[4] or 0
    return ra == 0 or rb == 0 or abs(ra - rb) <= 2


def jaccard(a, b):
    a, b = set(a), set(b)
    if not a and not b:
        return 1.0
    return len(a & b) / len(a | b) if a and b else 0.0


def link(spark, left, right, threshold=0.6, limit=256):
    sides = [
        spark.createDataFrame(rows, DDL)
        .withColumn("tokens", token_set(F.col("words")))
        .withColumn("lang", F.lower("lang"))
        for rows in (left, right)
    ]
    groups = [L.copy_groups(s, "key", "tokens", ["lang"], BANDS) for s in sides]
    similar = L.similar_groups(*groups, "tokens", ["lang"], BANDS, threshold, limit)
    pairs = L.fuzzy_pairs(*groups, similar)
    group = L.copy_group("tokens", ["lang"], BANDS)
    best = L.best_per_target(pairs, sides[0], "key", group)
    one = L.one_to_one(pairs, *sides, "key", group)
    return pairs, best, one


def as_map(df):
    return {r.target: (r.candidate, r.similarity) for r in df.collect()}


def brute(left, right, threshold=0.6):
    edges = [(jaccard(x[1], y[1]), x, y) for x in left for y in right if fits(x, y)]
    edges = [e for e in edges if e[0] >= threshold]

    def group(x):
        return frozenset(x[1]), x[2].lower(), x[3], x[4]

    least = {}
    for side, rows in enumerate((left, right)):
        for x in rows:
            k = side, group(x)
            least[k] = min(least.get(k, x[0]), x[0])
    best, one, used = {}, {}, set()
    for s, x, y in edges:
        if x[0] not in best or (-s, y[0]) < best[x[0]]:
            best[x[0]] = (-s, y[0])
    order = sorted(
        edges, key=lambda e: (-e[0], least[0, group(e[1])], least[1, group(e[2])], e[1][0], e[2][0])
    )
    for s, x, y in order:
        if x[0] not in one and y[0] not in used:
            one[x[0]] = (y[0], s)
            used.add(y[0])
    return edges, {k: (c, -s) for k, (s, c) in best.items()}, one


@pytest.mark.parametrize("seed, limit", [(0, 256), (1, 3)])
def test_against_brute_force(spark, seed, limit):
    rng = random.Random(seed)
    vocab = "mario super zelda link war star doom quest".split()

    def rows(prefix, n):
        return [
            (
                f"{prefix}{i:03d}",
                [rng.choice(vocab) for _ in range(rng.choice([0, 1, 2, 3, 4]))],
                rng.choice("xX"),
                rng.choice([1990, 1991, 1993, None]),
                rng.choice([None, 0, 90, 91, 95]),
            )
            for i in range(n)
        ]

    left, right = rows("t", 60), rows("c", 60)
    left += [(f"t9{i}", ["hot", "title"], "x", 1990, 90) for i in range(9)]
    right += [(f"c9{i}", ["title", "hot"], "X", 1991, 91) for i in range(5)]
    pairs, best, one = link(spark, left, right, limit=limit)
    edges, want_best, want_one = brute(left, right)
    assert pairs.agg(F.sum(F.expr("n_a * n_b"))).first()[0] == len(edges)
    assert as_map(best) == want_best
    assert as_map(one) == want_one


def movie(key, title, runtime=90):
    return key, title.split(), "x", 1990, runtime


def test_competing_targets_and_ties(spark):
    left = [movie("t1", "a b c d"), movie("t2", "a b c d e"), movie("t3", "q r s")]
    right = [movie("c1", "a b c d e"), movie("c2", "q r s u"), movie("c3", "q r s u", 91)]
    _, _, one = link(spark, left, right)
    # t2 is the exact match; t1 has no other candidate; t3's tie goes to the lower key.
    assert as_map(one) == {"t2": ("c1", 1.0), "t3": ("c2", 0.75)}


def test_just_below_the_threshold_is_dropped(spark):
    _, best, _ = link(spark, [movie("t", "a b c")], [movie("c", "a b c d e f")])
    assert as_map(best) == {}


def test_a_group_of_copies_is_handed_out_in_key_order(spark):
    left = [movie(f"t{i:03d}", "same title") for i in range(300)]
    right = [movie(f"c{i:03d}", "title same") for i in range(200)]
    pairs, _, one = link(spark, left, right, limit=4)
    assert pairs.count() == 1
    assert as_map(one) == {f"t{i:03d}": (f"c{i:03d}", 1.0) for i in range(200)}


def test_no_pairs_give_an_empty_assignment(spark):
    _, _, one = link(spark, [movie("t", "a")], [movie("c", "b")])
    assert one.count() == 0


def test_rank_in_a_hot_group(spark):
    rows = [("hot", i) for i in range(500)] + [("cold", 7), ("cold", 3)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(5)
    got = {(r.g, r.k): r["rank"] for r in rank_within(df, "g", "k", "rank").collect()}
    assert got == {("hot", i): i for i in range(500)} | {("cold", 3): 0, ("cold", 7): 1}


def test_year_band_pairs_once(spark):
    left = spark.createDataFrame([(1990,), (None,)], "a int")
    right = spark.createDataFrame([(y,) for y in (1988, 1989, 1990, 1991, 1992)], "b int")
    assert sorted(r.b for r in L.year_band(left, right, "a", "b").collect()) == [1989, 1990, 1991]


PAIRS = "a string, b string, similarity double, key_a string, key_b string, n_a long, n_b long"


def greedy(pairs):
    """The assignment worked through pair by pair."""
    left_a = {p[0]: p[5] for p in pairs}
    left_b = {p[1]: p[6] for p in pairs}
    from_a, from_b = dict.fromkeys(left_a, 0), dict.fromkeys(left_b, 0)
    found = set()
    for a, b, s, *_ in sorted(pairs, key=lambda p: (-p[2], p[3], p[4])):
        taken = min(left_a[a], left_b[b])
        if taken:
            found.add((a, b, s, taken, from_a[a], from_b[b]))
            left_a[a] -= taken
            left_b[b] -= taken
            from_a[a] += taken
            from_b[b] += taken
    return found


def chain(n, count):
    """A falling path a0 b0 a1 b1 ...: every pair waits for the one before."""
    pairs = []
    for i in range(n):
        a, b = (i + 1) // 2, i // 2
        pairs.append((f"a{a:06}", f"b{b:06}", 1 - i / (2 * n), f"a{a:06}", f"b{b:06}"))
    sizes = {}
    rng = random.Random(n)
    for p in pairs:
        for side in p[:2]:
            sizes.setdefault(side, rng.randint(1, count))
    return [(*p, sizes[p[0]], sizes[p[1]]) for p in pairs]


@pytest.mark.parametrize("count", [1, 5])
def test_a_falling_chain_takes_logarithmic_rounds(spark, monkeypatch, count):
    pairs = chain(10_000, count)
    steps, cut = [], L.cut_lineage
    monkeypatch.setattr(L, "cut_lineage", lambda df: steps.append(1) or cut(df))
    got = L.one_to_one_groups(spark.createDataFrame(pairs, PAIRS)).collect()
    assert {tuple(r) for r in got} == greedy(pairs) and len(got) == len(greedy(pairs))
    assert len(steps) < 30


@pytest.mark.parametrize("seed", range(3))
def test_assignment_of_groups_equals_the_greedy_one(spark, seed):
    rng = random.Random(seed)
    n_a, n_b = {f"a{i}": rng.choice([1, 1, 2, 7]) for i in range(25)}, {f"b{i}": rng.choice([1, 1, 3, 9]) for i in range(25)}
    chosen = rng.sample([(a, b) for a in n_a for b in n_b], 160)
    pairs = [(a, b, rng.choice([0.6, 0.75, 0.8, 1.0]), a, b, n_a[a], n_b[b]) for a, b in chosen]
    got = L.one_to_one_groups(spark.createDataFrame(pairs, PAIRS)).collect()
    assert {tuple(r) for r in got} == greedy(pairs) and len(got) == len(greedy(pairs))
