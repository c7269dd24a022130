"""Dimensional modelling, filters and integrity."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.operators import entities, filters, quality
from reelhouse.schemas import WAREHOUSE


def test_first_seen_spelling_wins(spark):
    rows = spark.createDataFrame(
        [("b", "ACME", 2, True), ("a", "Acme", 1, False), ("c", None, 3, True)],
        "ref string, name string, seq long, flag boolean",
    )
    got = {r.name: r.flag for r in entities.distinct_entities(rows, ["name"], "seq", ["flag"]).collect()}
    assert got == {"Acme": False, None: True}


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_bridge_weights_sum_to_one_on_any_partitioning(spark, partitions):
    refs = [("m1", g) for g in "abca"] + [("m2", "a")] + [("hot", f"g{i}") for i in range(200)]
    df = spark.createDataFrame(refs, "media_id string, g string").repartition(partitions)
    out = entities.bridge(df, "media_id", "g")
    sums = {r.media_id: (r.n, round(r.s, 9)) for r in out.groupBy("media_id").agg(
        F.count("*").alias("n"), F.sum("weight").alias("s")).collect()}
    assert sums == {"m1": (3, 1.0), "m2": (1, 1.0), "hot": (200, 1.0)}


def test_fact_keeps_the_first_rated_review(spark):
    rows = spark.createDataFrame([("k", None, 1), ("k", 7, 3), ("k", 5, 2)], "k string, rating int, seq long")
    assert [r.rating for r in entities.facts(rows, ["k"], "seq").collect()] == [5]


def test_year_set(spark):
    years = spark.createDataFrame([(2000,), (2001,), (None,)], "release_year int")
    assert sorted(r.year for r in entities.year_set(years).collect()) == [1999, 2000, 2001, 2002]


def test_catalogue_filter(spark):
    rows = [
        ("ok", "movie", "Film", "2000"), ("none", "movie", "None", "2000"), ("one", "movie", "X", "2000"),
        ("blank", "movie", "   ", "2000"), ("marker", "movie", "\\N", "2000"), ("null", "movie", None, "2000"),
        ("episode", "tvEpisode", "Film", "2000"), ("text", "tvSeries", "Film", "abc"),
        ("far", "tvSeries", "Film", "2005"), ("near", "tvMiniSeries", "Film", " 2001 "),
    ]
    titles = spark.createDataFrame(
        rows, "tconst string, titleType string, primaryTitle string, startYear string"
    )
    years = spark.createDataFrame([(2000,), (2001,)], "year int")
    kept = {r.tconst for r in filters.catalogue_acceptable(titles, years).collect()}
    assert kept == {"ok", "none", "near"}


@pytest.mark.parametrize(
    "groups, kept",
    [
        (None, {1, 2, 3}),
        ([], set()),
        ([{"lang": "en"}], {1}),
        ([{"lang": {"en", "fr"}, "original": ["1"]}, {"title": ["C"]}], {1, 3}),
        ([{"absent": ["x"]}], set()),
        ([{"lang": ["e"]}], set()),
    ],
)
def test_whitelist(spark, groups, kept):
    rows = [(1, "en", "1", "A"), (2, "fr", "0", "B"), (3, None, "1", "C")]
    df = spark.createDataFrame(rows, "id int, lang string, original string, title string")
    assert {r.id for r in filters.filter_rows(df, groups).collect()} == kept


def test_row_callback_keeps_on_true_and_maps(spark):
    df = spark.createDataFrame([(i, f"n{i}") for i in range(10)], "id int, name string")
    out = filters.row_callback(
        df, lambda r: r["id"] >= 7, lambda r: {"id": int(r["id"]), "name": r["name"].upper()}
    )
    assert sorted(map(tuple, out.collect())) == [(7, "N7"), (8, "N8"), (9, "N9")]


def test_name_match_is_literal(spark):
    df = spark.createDataFrame([("x", "Michael B"), ("100%", "p"), ("abc", "q")], "r string, p string")
    assert df.where(filters.name_like(F.col("r"), F.col("p"), "Michael")).count() == 1
    assert df.where(filters.name_like(F.col("r"), F.col("p"), "%")).count() == 1


def test_typed_rows_convert_or_refuse(spark):
    table = WAREHOUSE["DIM_TIME"]
    text = spark.createDataFrame([("a", "2024", "01", None)], "id string, year string, month string, day string")
    assert quality.typed_rows(text, table).collect() == [("a", 2024, 1, None)]
    with pytest.raises(quality.IntegrityError):
        quality.typed_rows(text.withColumn("hour", F.lit(1)), table)
    with pytest.raises(Exception, match="DIM_TIME.year"):
        quality.typed_rows(text.withColumn("year", F.lit("soon")), table).collect()


def test_cast_rejects(spark):
    df = spark.createDataFrame([("1", "true"), ("x", "maybe"), ("x", None)], "n string, b string")
    got = quality.cast_rejects(df, {"n": T.IntegerType(), "b": T.BooleanType()})
    assert sorted(map(tuple, got.collect())) == [("b", "maybe", 1), ("n", "x", 2)]
