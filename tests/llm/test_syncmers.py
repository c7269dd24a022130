"""Fingerprints against the contract and against a plain reading of the definition."""

import hashlib
import random
import re

import xxhash

from reelhouse.llm import queries, syncmers

SF = "/root/testdata/sf0.001"

def chain(parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p, seed)
    return seed

def words(values):
    return [v.to_bytes(8, "little") for v in values]

def plain_anchors(text, k=syncmers.K, s=syncmers.S):
    tokens = re.findall(r"[^\W_]{1,16}", text)
    h = [chain([t.encode()]) for t in tokens]
    if 0 < len(h) < k:
        return [(0, chain([" ".join(tokens).encode()]))]
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    inner = [signed(chain(words(h[i : i + s]))) for i in range(len(h) - s + 1)]
    out = []
    for i in range(len(h) - k + 1):
        run = inner[i : i + k - s + 1]
        if min(run) in (run[0], run[-1]):
            out.append((i, chain(words(h[i : i + k]))))
    return out

def test_anchors_and_fingerprint_follow_the_definition(spark):
    texts = ["one two three four five six seven eight nine ten", "a b", "", "é1 x_y z " * 9, "q" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    made = syncmers.with_anchors(syncmers.with_fingerprint(df, "text", "fp"), "text", "anchors")
    for row in made.collect():
        want = plain_anchors(texts[row["doc_id"]])
        assert [(a["pos"], a["hash"] % (1 << 64)) for a in row["anchors"]] == want
        least = sorted({h >> (64 - 4 * syncmers.DIGITS) for _, h in want})[: syncmers.SKETCH]
        assert row["fp"] == "".join(f"{v:0{syncmers.DIGITS}x}" for v in least)

def test_a_shared_passage_has_the_same_anchors_wherever_it_stands(spark):
    passage = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, passage), (2, "x y z " * 7 + passage + " tail")], "doc_id int, text string")
    a, b = (
        {h["hash"] for h in r["anchors"]}
        for r in syncmers.with_anchors(df, "text", "anchors").orderBy("doc_id").collect()
    )
    assert a and a <= b

def test_query_edits_by_the_next_document(spark, documents):
    rows = {r["doc_id"]: r for r in queries.op1(spark, SF).collect()}
    assert len(rows) == len(documents)
    down = documents[::-1]
    for (i, t), (_, nxt) in zip(down, down[1:] + down[:1]):
        cut = len(t) // 3
        edited = t[: len(t) - cut] + nxt[:cut]
        assert rows[i]["n_chars"] == len(t)
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= rows[i]["near_next"] <= 1
    long = [rows[i] for i, t in documents if len(t) > 600]
    assert all(r["near_edited"] > 0.2 for r in long)
    assert sum(r["near_edited"] > r["near_next"] for r in long) == len(long)
    by_text = {}
    for i, t in documents:
        assert by_text.setdefault(t, rows[i]["fingerprint"]) == rows[i]["fingerprint"]

def test_edge_cases(spark):
    rows = [(5, "a b"), (None, "x"), (None, None), (2, ""), (2, "日本語"), (2, "日本語"), (9, "q " * 50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS fingerprint")
    made = syncmers.edited_pairs(df).collect()
    assert len(made) == len(rows)
    assert {r["text"] for r in made if r["fingerprint"] == ""} == {""}
    like = syncmers.likeness
    pairs = spark.createDataFrame([("", ""), ("", "a" * 12), ("a" * 12, "a" * 12)], "a string, b string")
    assert [r[0] for r in pairs.select(like("a", "b")).collect()] == [1.0, 0.0, 1.0]
    assert syncmers.edited_pairs(df.limit(0)).count() == 0
    assert syncmers.edited_pairs(df.limit(1)).count() == 1


def test_long_texts_that_share_a_passage_share_entries(spark):
    rng = random.Random(9)
    texts = [[f"w{rng.getrandbits(40)}" for _ in range(20_000)] for _ in range(6)]
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join(t[: 3000 * i] + passage + t[3000 * i :])) for i, t in enumerate(texts)]
    rows += [(10, " ".join(texts[0])), (11, " ".join(texts[0][:10_000] + ["other"] + texts[0][10_001:]))]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    prints = {r["doc_id"]: r["fp"] for r in syncmers.with_fingerprint(df, "text", "fp").collect()}
    for i, text in rows[:2]:
        found = sorted({h >> (64 - 4 * syncmers.DIGITS) for _, h in plain_anchors(text)})
        low = [v for v in found if v < (1 << 4 * syncmers.DIGITS) // syncmers.RATE]
        assert prints[i] == "".join(f"{v:0{syncmers.DIGITS}x}" for v in low) and len(low) > 1000
    pairs = [(prints[i], prints[j]) for i in range(6) for j in range(i)]
    near = spark.createDataFrame([*pairs, (prints[10], prints[11])], "a string, b string")
    scores = [r[0] for r in near.select(syncmers.likeness("a", "b")).collect()]
    assert all(0 < s < 0.05 for s in scores[:-1])
    # One word of 20,000 changed: nearly alike, and the change shows or not, but never as a difference.
    assert 0.99 < scores[-1] <= 1


def test_likeness_reaches_as_far_as_the_shorter_print(spark):
    width = syncmers.DIGITS
    many = [f"{v:0{width}x}" for v in range(0, 400, 2)]
    few = [f"{v:0{width}x}" for v in range(0, 20)]
    pairs = [("".join(many), "".join(many[:100])), ("".join(many), "".join(few)), ("".join(few), "".join(few[:10]))]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(syncmers.likeness("a", "b")).collect()]
    # The second pair: all of the short one against as much of the long one as it holds.
    assert got == [1.0, 10 / 200, 10 / 20]
