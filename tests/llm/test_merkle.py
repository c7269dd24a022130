"""The manifest against a plain recursive reading."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from reelhouse.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, node string, block int"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]]
    return h(*fields)


def levels(nodes, fanout):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([h(*last[i : i + fanout]) for i in range(0, len(last), fanout)])
    return found


def sides(found, at, fanout):
    made = []
    for level in found[:-1]:
        at, own = divmod(at, fanout)
        run = level[at * fanout : (at + 1) * fanout]
        made.append((run[:own], run[own + 1 :]))
    return made


def plain(rows, fanout):
    """(leaf, subroot, root, proof hash) of every row, sorted."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        ordered = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[name] = levels([leaf_of(r) for r in ordered], fanout)
    top = levels([trees[n][-1][0] for n in names], fanout)
    found = []
    for s, name in enumerate(names):
        for at, leaf in enumerate(trees[name][0]):
            path = sides(trees[name], at, fanout) + sides(top, s, fanout)
            proof = h(*(x for left, right in path for x in (*left, *right)))
            found.append((leaf, trees[name][-1][0], top[-1][0], proof))
    return sorted(found)


def rows_of(sizes, seed=1):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for i in range(n):
            rows.append((rng.getrandbits(30), source, rng.choice(["de", None]), i, "T" * (i % 7) + "ü", "clash", 5))
    rng.shuffle(rows)
    return rows


def run(spark, rows, fanout, levels, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    tree = merkle.build(df, fanout=fanout, levels=levels, **more)
    return tree, merkle.audit(tree, fanout, levels).collect()


@pytest.mark.parametrize(
    "fanout, levels, sizes",
    [
        (2, 1, {"a": 1, "b": 2, "c": 3, None: 5, "é": 33, "z": 17, "": 4}),
        (3, 1, {"hot": 200, "b": 1, "c": 10, "d": 9}),
        (4, 2, {f"s{i}": i % 9 + 1 for i in range(70)} | {"s3": 150}),
        (16, 2, {"a": 300, "b": 1, "c": 256, "d": 257}),
        (2, 1, {"only": 13}),
        (2, 1, {"one": 1}),
    ],
)
def test_equals_the_recursive_reading(spark, fanout, levels, sizes):
    rows = rows_of(sizes)
    _, got = run(spark, rows, fanout, levels)
    assert sorted((r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got) == plain(rows, fanout)
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)


def test_changed_rows_are_found(spark):
    rows = rows_of({"a": 40, "b": 3})
    fields = [F.col(f) for f in merkle.FIELDS]
    changed = merkle.digest([*fields[:-1], F.when(F.col("n_chars") % 3 == 0, F.lit("other")).otherwise(F.col("text"))])
    _, got = run(spark, rows, 4, 1, seen=changed)
    odd = {r[0] for r in rows if r[3] % 3 == 0}
    assert {r["key"] for r in got if not r["verified"]} == odd


def test_proofs_are_the_siblings(spark):
    rows = rows_of({"a": 40, "b": 3, "c": 1})
    tree, audited = run(spark, rows, 4, 1)
    hashes = {r["leaf"]: r["proof_sha256"] for r in audited}
    for r in merkle.proofs(tree, 4, 1).collect():
        node, text = r["leaf"], ""
        for step in r["proof"]:
            node = h(step["left"], node, step["right"])
            text += step["left"] + step["right"]
        assert node == r["root"]
        assert h(text) == hashes[r["leaf"]]


def test_null_keys_ties_and_repeated_rows(spark):
    same = (4, "a", None, None, None, "clash", 5)
    rows = [same] * 6 + [(4, "a", "de", 1, "x" * 200_000, None, None), (None, "a", None, 2, "", None, None), (None, None, None, None, None, None, None)]
    _, got = run(spark, rows, 2, 1)
    assert sorted((r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in got) == plain(rows, 2)
    assert sum(r["key"] is None for r in got) == 2


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert merkle.audit(merkle.build(df)).count() == 0
