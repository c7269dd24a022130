"""Rows of `{table: [rows]}` files in pieces against Python's own reader."""

import json
import random

import pytest
from pyspark.sql import types as T

from reelhouse.sources import readers, table_json

NASTY = ['}', '{"', '\\', '"', '\\"}', '], "B": [{', "é \n", "", "[[", "\\\\"]


def made(seed, n):
    rng = random.Random(seed)

    def value(depth):
        kind = rng.randrange(6 if depth else 3)
        if kind < 2:
            return "".join(rng.choices(NASTY, k=rng.randint(0, 3)))
        if kind == 2:
            return rng.choice([None, 1, 2.5, True])
        if kind == 3:
            return [value(depth - 1) for _ in range(rng.randint(0, 3))]
        return {f"k{i}": value(depth - 1) for i in range(rng.randint(0, 3))}

    return {
        name: [{"id": i, "v": value(rng.choice([0, 0, 2])), "w": value(0)} for i in range(k)]
        for name, k in (("A", n), ("none", 0), ('odd "] name', n // 2), ("B", 1), ("last", n), ("void", 0))
    }


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("indent", [None, 2])
def test_rows_equal_the_whole_file_read(spark, tmp_path, small_splits, indent):
    objects = [made(1, 40), made(2, 25), {}, {"A": []}]
    for i, o in enumerate(objects):
        (tmp_path / f"{i}.json").write_text(json.dumps(o, indent=indent, ensure_ascii=i % 2 == 0) + "\n" * (i % 2))
    want = [(i, name, row) for i, o in enumerate(objects) for name, rows in o.items() for row in rows]
    got = [
        (int(r["path"].rsplit("/", 1)[1][0]), r["nth"], r["table"], json.loads(r["row"]))
        for r in table_json.elements(spark, str(tmp_path)).collect()
    ]
    got.sort(key=lambda r: r[:2])
    assert [(i, table, row) for i, _, table, row in got] == want


def test_reader_gives_typed_tables(spark, tmp_path, small_splits):
    rows = [{"name": f"n{i}", "tags": [{"t": "}"}] * (i % 3), "extra": 1} for i in range(60)]
    (tmp_path / "x.json").write_text(json.dumps({"T": rows, "U": [{"name": "only"}]}))
    tags = T.ArrayType(T.StructType([T.StructField("t", T.StringType())]))
    schema = T.StructType([T.StructField("name", T.StringType()), T.StructField("tags", tags)])
    found = readers.multi_table_json(spark, str(tmp_path), {"T": schema, "U": schema, "V": schema})
    got = sorted((r.name, len(r.tags)) for r in found["T"].collect())
    assert got == sorted((r["name"], len(r["tags"])) for r in rows)
    assert [r.name for r in found["U"].collect()] == ["only"] and found["V"].count() == 0


def test_no_piece_is_larger_than_a_row(spark, tmp_path):
    """A file of one line and many rows is read in pieces of one row each."""
    (tmp_path / "x.json").write_text(json.dumps({"T": [{"name": "x" * 50} for _ in range(3000)]}))
    pieces = spark.read.option("lineSep", "}").text(str(tmp_path))
    assert max(len(r.value) for r in pieces.collect()) < 100
    assert table_json.elements(spark, str(tmp_path)).count() == 3000
