"""Scalar functions on golden values."""

import pytest
from pyspark.sql import functions as F

from reelhouse.functions import clean, keys, text, values


def values_of(spark, fn, inputs, ddl="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {ddl}")
    return [r.out for r in rows.select("i", fn(F.col("v")).alias("out")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "fn, cases",
    [
        (
            values.runtime_minutes,
            {"2 h 15 m": 135, "2 h": 120, "45 m": 45, "\\N": None, None: None, "abc": None, "": None,
             "2 h foo": None, "1 h 05 m extra": 65},
        ),
        (
            values.release_year,
            {"Nov 12, 2018": 2018, "TBA": None, None: None, " 1999 ": 1999, "": None, "12": 12, "1.50": None},
        ),
        (values.int_or_null, {"7": 7, " -3 ": -3, "1.5": None, "x": None, None: None}),
        (values.null_marker, {"\\N": None, "N": "N", None: None}),
        (
            clean.clean_characters,
            {'["Self"]': None, '["Self - Host"]': "Host", '["A","B"]': "A,B", "\\N": None, "[]": None,
             None: None, "[\"O'Neil\"]": "ONeil"},
        ),
        (clean.play_method, {"Actress ": "actor", "\\N": None, " Director": "director", None: None}),
        (clean.clean_play_method_older, {'["A" ,"B"]': "A, B", "\\N": None, "[]": None}),
        (
            text.normalize_title,
            {"Amélie^x-y 2001: Zelda's": ["amélie", "xy", "zeldas"], "The 1999 Film": ["the", "film"],
             "é2001": ["é2001"], "2001": [], "a b": ["a", "b"], "snake_case": ["snake_case"]},
        ),
        (
            text.extensive_split,
            {"Spider-Man": ["spider", "man"], "Spider-Man 2": ["spider-man", "2"], "  ": [], "A  b": ["a", "b"]},
        ),
        (text.franchise_tokens, {"The Legend of Zelda II": ["legend", "zelda"], "Part 2": []}),
        (
            text.tokenize_title_older,
            {"The Film (1999)": ["film"], "A: b": ["ab"], "": []},
        ),
        (
            text.slug_to_title,
            {"super-mario-3d-world": "Super Mario 3D World", "l'été-4x4": "L'Été 4X4", "x": "X"},
        ),
        (text.strip, {"  a b \t": "a b", "": ""}),
    ],
)
def test_scalar(spark, fn, cases):
    assert values_of(spark, fn, list(cases)) == list(cases.values())


def test_date_parts(spark):
    rows = spark.createDataFrame([("2024-01-05",), ("",), (None,), ("2024",)], "d string")
    parts = rows.select(*values.date_parts(F.col("d"))).collect()
    assert [tuple(r) for r in parts] == [(2024, 1, 5)] + [(None, None, None)] * 3


def test_score_band_gaps_and_overlap(spark):
    cases = {0.0: "red", 35.0: "red", 35.5: None, 36.0: "yellow", 49.5: None, 50.0: "green",
             80.0: "green", 80.5: "dark-green", 100.0: "dark-green", 101.0: None}
    assert values_of(spark, values.score_band, list(cases), "double") == list(cases.values())


def test_mean_rounds_half_up_exactly(spark):
    rows = spark.createDataFrame([(1, 8), (201, 200), (3, 8)], "t long, n long")
    got = [float(r[0]) for r in rows.select(values.exact_mean(F.col("t"), F.col("n"), 2)).collect()]
    assert got == [0.13, 1.01, 0.38]


def test_composite_key_keeps_columns_and_nulls_apart(spark):
    rows = spark.createDataFrame(
        [("ab", "c"), ("a", "bc"), ("AB", "C"), ("none", None), (None, "none")], "a string, b string"
    )
    ids = [r[0] for r in rows.select(keys.surrogate_id("a", "b")).collect()]
    assert ids[0] == ids[2] and len(set(ids)) == 4


def test_jaccard_of_empty_sets(spark):
    rows = spark.createDataFrame(
        [([], []), (["a"], []), (["a", "b", "a"], ["b", "c"])], "a array<string>, b array<string>"
    )
    got = [r[0] for r in rows.select(text.jaccard(F.col("a"), F.col("b"))).collect()]
    assert got == [1.0, 0.0, pytest.approx(1 / 3)]


def test_token_subset(spark):
    rows = spark.createDataFrame(
        [(["a", "b"], ["a"]), (["a"], ["a"]), (["a"], ["b"]), (["a"], []), (None, ["a"])],
        "a array<string>, b array<string>",
    )
    got = [r[0] for r in rows.select(text.is_token_subset(F.col("a"), F.col("b"))).collect()]
    assert got == [True, False, False, False, False]


def test_common_prefix(spark):
    rows = spark.createDataFrame(
        [(["a", "b", "c"], ["a", "b", "d"]), (["a"], ["a", "b"]), (["x"], ["y"]), ([], ["y"])],
        "a array<string>, b array<string>",
    )
    got = [r[0] for r in rows.select(text.common_prefix(F.col("a"), F.col("b"))).collect()]
    assert got == [["a", "b"], ["a"], [], []]
