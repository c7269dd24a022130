"""Fingerprints and components against brute force."""

import itertools
import random

import pytest
import xxhash

from reelhouse.llm import queries, simhash_trie


LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def plain_print(text):
    words = (text or "").encode().translate(LOWER).split()
    runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, budget=2):
    parent = list(range(len(values)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= budget:
            parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(values))]


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("limit", [simhash_trie.NODE_LIMIT, 25])
def test_components_of_any_fingerprints(spark, limit):
    rng = random.Random(1)
    prints = {rng.getrandbits(64) for _ in range(120)} | {0, 1, 3, 7, 15, (1 << 64) - 1}
    for base in list(prints)[:60]:
        for _ in range(4):
            for bit in rng.sample(range(64), rng.choice([1, 2, 3])):
                base ^= 1 << bit
            prints.add(base)
    # A dense cluster that shares its upper bits, so that large nodes are walked down.
    prints |= {0xABCDEF << 40 | rng.getrandbits(12) for _ in range(80)}
    values = sorted(prints)
    df = spark.createDataFrame([(i, signed(v)) for i, v in enumerate(values)], "doc_id long, fp long")
    got = {r["doc_id"]: r["component_id"] for r in simhash_trie.components_of(df, 2, limit).collect()}
    assert [got[i] for i in range(len(values))] == components(values)


def test_edge_cases(spark):
    rows = [(4, None), (3, " \t\n"), (7, "A b"), (6, "a B"), (9, "one two three four"), (9, "one two three four"), (None, "zz")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fp", "2 AS component")
    got = sorted((tuple(r) for r in simhash_trie.near_duplicates(df).collect()), key=repr)
    assert len(got) == len(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[4][1:] == ("0" * 16, 3) and by_id[7][1] == by_id[6][1] and by_id[7][2] == 6
    assert by_id[None][2] is None
    kept = simhash_trie.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [3, 6, 9, None]
    assert simhash_trie.near_duplicates(df.limit(0)).count() == 0


def test_query_against_brute_force(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op8(spark, "/root/testdata/sf0.001").collect()}
    values = [plain_print(t) for _, t in documents]
    assert [rows[i]["fingerprint"] for i, _ in documents] == [f"{v:016x}" for v in values]
    want = components(values)
    assert [rows[i]["component_id"] for i, _ in documents] == [documents[k][0] for k in want]
