"""Repairs against a plain search over all edits of one conversation at a time."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from reelhouse.llm import conversation_repair as repair
from reelhouse.llm import structure_queries

BLANKS = " \t\n\x0b\x0c\r"
NAMES = {"u": "user", "a": "assistant"}
# State: the initial written last, "" before the first.
TAKES = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_faults(rows):
    seen, faults = set(), []
    for role, text in rows:
        body = text.rstrip(BLANKS)
        if not body:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("fine" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return faults


def plain_repair(rows):
    """(cost, audit, kept rows) of the least audit among the cheapest: whole audits are compared as strings."""
    faults = plain_faults(rows)
    best = {s: (0, "", ()) if s in ("", "a") else None for s in TAKES}
    best = inserted(best)
    for (role, text), fault in reversed(list(zip(rows, faults))):
        extra = 3 if fault == "truncated" else 0
        now = {}
        for state in TAKES:
            options = []
            if best[state]:
                cost, audit, kept = best[state]
                options.append((cost + 4, "D" + audit, kept))
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in TAKES[state] and best[role[0]]:
                    cost, audit, kept = best[role[0]]
                    options.append((cost + extra, "K" + audit, ((role, text), *kept)))
                for to in TAKES[state].replace("s", ""):
                    cost, audit, kept = best[to]
                    options.append((cost + extra + 3, "R" + audit, ((NAMES[to], text), *kept)))
            now[state] = min(options, key=lambda o: o[:2]) if options else None
        best = inserted(now)
    return best[""]


def inserted(best):
    for _ in range(4):
        for state in TAKES:
            for to in TAKES[state].replace("s", ""):
                if best[to]:
                    cost, audit, kept = best[to]
                    option = (cost + 3, "I" + audit, ((NAMES[to], ""), *kept))
                    if best[state] is None or option[:2] < best[state][:2]:
                        best[state] = option
    return best


def plain(conversations):
    """conv -> the query's columns from (turn, role, text) rows that are in order."""
    found = {}
    for conv, rows in conversations.items():
        texts = [(role, text) for _, role, text in rows]
        faults = plain_faults(texts)
        turns = [t for t, _, _ in rows if t is not None]
        cost, audit, kept = plain_repair(texts)
        near = [a[0][:1] + b[0][:1] for a, b in zip(texts, texts[1:])]
        found[conv] = {
            "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(p not in ("su", "ua", "au") for p in near),
            "cost": cost,
            "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest(),
        }
    return found


def run(spark, rows, every=None):
    schema = "conv_id long, turn long, role string, text string, audit string, rank int, cost int"
    df = spark.createDataFrame([(*r, "clash", 9, 9) for r in rows], schema).repartition(4)
    facts = repair.facts(df)
    ids = spark.createDataFrame([(c,) for c in every or {r[0] for r in rows}], "conv long")
    plans = repair.repair(facts, ids)
    return facts, plans, {r["conv"]: r.asDict() for r in repair.repaired_digests(facts, plans).collect()}


def same(got, want):
    assert set(got) == set(want)
    for conv, expected in want.items():
        assert {k: got[conv][k] for k in expected} == expected, conv


TEXTS = ["Yes.", "No!", "well", " ", "", "Why? \n", "Ü.", "a\x0b", "so be it"]
ROLES = ["user", "assistant", "system", "tool", "", "u", "student"]


def test_random_conversations(spark):
    rng = random.Random(4)
    conversations = {}
    for conv in range(150):
        n = rng.choice([1, 2, 3, 5, 8, 13])
        weights = rng.choice([[8, 8, 1, 1, 0, 0, 0], [1] * 7, [3, 3, 3, 0, 0, 1, 0]])
        conversations[conv] = [
            (t, rng.choices(ROLES, weights)[0], rng.choice(TEXTS)) for t in sorted(rng.sample(range(3 * n), n))
        ]
    rows = [(c, *r) for c, found in conversations.items() for r in found]
    rng.shuffle(rows)
    same(run(spark, rows)[2], plain(conversations))


def test_null_ids_turns_roles_and_texts(spark):
    rows = [
        (None, 1, "user", "Hi."),
        (None, 2, "assistant", "Hi."),
        (1, 5, "user", "b."),
        (1, None, "user", "a."),
        (1, 2, None, "c."),
        (1, 3, "assistant", None),
        (2, None, None, None),
    ]
    want = plain(
        {
            None: [(1, "user", "Hi."), (2, "assistant", "Hi.")],
            1: [(None, "user", "a."), (2, " ", "c."), (3, "assistant", " "), (5, "user", "b.")],
            2: [(None, " ", " ")],
        }
    )
    same(run(spark, rows)[2], want)


def test_repeated_rows_and_ties(spark):
    rows = [(1, 0, "user", "a."), (1, 0, "user", "a."), (1, 0, "assistant", "b."), (1, 1, "user", "a.")]
    got = run(spark, rows)[2][1]
    # Rows of one turn go by role, so the answer comes first; equal rows are duplicates from the second on.
    ordered = [(0, "assistant", "b."), (0, "user", "a."), (0, "user", "a."), (1, "user", "a.")]
    same({1: got}, plain({1: ordered}))


def test_conversations_without_rows_and_empty_tables(spark):
    got = run(spark, [(1, 0, "user", "a.")], every=[1, 2, None])[2]
    assert set(got) == {1, 2, None}
    none = {"gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": ""}
    for conv in (2, None):
        assert {k: got[conv][k] for k in none} == none
        assert got[conv]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    facts = repair.facts(empty)
    plans = repair.repair(facts, facts.select("conv"))
    assert repair.repaired_digests(facts, plans).count() == 0


def test_a_very_long_conversation(spark):
    rng = random.Random(6)
    long = [(t, rng.choice(["user", "assistant"]), rng.choice([f"Line {t}.", "same", ""])) for t in range(3000)]
    rows = [(7, *r) for r in long] + [(8, 0, "user", "x" * 100_000 + ".")]
    facts, plans, got = run(spark, rows)
    same(got, plain({7: long, 8: [(0, "user", "x" * 100_000 + ".")]}))


def test_repaired_rows_follow_the_grammar(spark):
    rng = random.Random(8)
    rows = [(c, t, rng.choice(ROLES[:4]), rng.choice(TEXTS)) for c in range(40) for t in range(rng.randint(1, 9))]
    facts, plans, _ = run(spark, rows)
    left = {}
    for r in repair.repaired_rows(facts, plans).orderBy("conv", "place").collect():
        assert len(left.setdefault(r["conv"], [])) == r["place"]
        left[r["conv"]].append(r["role"][0])
    import re

    assert all(re.fullmatch("(s?(ua)+)?", "".join(roles)) for roles in left.values())


@pytest.mark.parametrize("shuffled", [False, True])
def test_common_endings_are_one_path(shuffled):
    import pyarrow as pa

    signatures = ["AE", "EIEIEI", "IEIEI", "XIEIEI", "EIEIEX", "", "M", "HLHL"]
    order = sorted(signatures, key=lambda s: s[::-1]) if not shuffled else signatures[::-1]
    batch = pa.RecordBatch.from_pydict({"signature": order})
    solved = {r["signature"]: r for b in repair._walk(iter([batch])) for r in b.to_pylist()}
    alone = [next(repair._walk(iter([batch.slice(i, 1)]))).to_pylist()[0] for i in range(len(order))]
    assert solved == {r["signature"]: r for r in alone}


def test_damage_of_the_query(spark):
    df = spark.createDataFrame([(None, None, None, None), (3, 1, "system", "a. b! c?")], "conv_id long, turn long, role string, text string")
    kinds = {r["conv_id"]: r["kind"] for r in structure_queries.damaged(df).select("conv_id", F.col("kind")).collect()}
    import zlib

    want = {None: zlib.crc32(b" : ") % 20, 3: zlib.crc32(b"3:1") % 20}
    assert kinds == {c: k for c, k in want.items() if k != 0}
