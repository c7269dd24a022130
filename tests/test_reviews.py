"""Documents per medium hold all reviews, whatever their number."""

from pyspark.sql import functions as F

from reelhouse.operators import reviews
from reelhouse.plans import standins

SF = "/root/testdata/sf0.001"


def test_a_hot_medium_keeps_all_reviews_over_pieces(spark, monkeypatch):
    monkeypatch.setattr(reviews, "REVIEWS_PER_PIECE", 7)
    rows = spark.range(253).select(
        F.when(F.col("id") < 250, "hot").otherwise("cold").alias("media_info_id"),
        F.concat(F.lit("s"), F.col("id") % 2).alias("section_name"),
        F.col("id").cast("decimal(38,0)").alias("seq"),
        F.struct(
            F.concat(F.lit("a"), "id").alias("author"), (F.col("id") % 3 == 0).alias("isCritic")
        ).alias("review"),
    )
    docs = reviews.section_pieces(rows, "media_info_id", "seq")
    counts = docs.groupBy("media_info_id").agg(F.sum(reviews.review_count(docs)).alias("n")).collect()
    assert {r["media_info_id"]: r["n"] for r in counts} == {"hot": 250, "cold": 3}
    got = {}
    for r in reviews.all_reviews(docs, "media_info_id").where("media_info_id = 'hot'").collect():
        got.setdefault((r["source"], r["section_name"]), {})[r["pos"]] = r["review"]["author"]
    for (source, section), by_pos in got.items():
        want = [f"a{i}" for i in range(250) if f"s{i % 2}" == section and (i % 3 > 0) == source]
        assert [by_pos[p] for p in range(len(want))] == want and len(by_pos) == len(want)


def test_one_document_per_part_with_all_reviews(spark):
    docs = standins.media_documents(spark, SF)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    counts = [r[1] for r in docs.groupBy("media_id").agg(F.sum(reviews.review_count(docs))).collect()]
    assert len(counts) == spark.read.parquet(f"{SF}/part.parquet").count()
    assert sum(counts) == lines and max(counts) > reviews.REVIEWS_PER_SECTION


def made_reviews(spark):
    return spark.range(600).select(
        F.when(F.col("id") < 500, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 9)).alias("medium"),
        F.concat(F.lit("s"), F.col("id") % 2).alias("section_name"),
        (F.lit(1000) - F.col("id")).cast("decimal(38,0)").alias("seq"),
        F.concat(F.lit("a"), "id").alias("author"),
        (F.col("id") % 3 == 0).alias("critic"),
    )


def placed_reviews(docs):
    flat = reviews.all_reviews(docs, "medium").select("medium", "source", "section_name", "pos", "review.author")
    return sorted(map(tuple, flat.collect()))


def pieces_of(spark):
    review = F.struct("author", F.col("critic").alias("isCritic"))
    return reviews.section_pieces(made_reviews(spark), "medium", "seq", review)


def test_reviews_are_dealt_out_once_and_short(spark, monkeypatch):
    """One shuffle of rows that are no documents yet; before, rows went through a range, ranks, offsets and two lists."""
    monkeypatch.setattr(reviews, "REVIEWS_PER_PIECE", 7)
    docs = pieces_of(spark)
    assert docs._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert len(placed_reviews(docs)) == 600


def test_media_of_many_reviews_are_ranked_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(reviews, "REVIEWS_PER_PIECE", 7)
    whole = placed_reviews(pieces_of(spark))
    ranked, rank_within = [], reviews.rank_within
    monkeypatch.setattr(reviews, "rank_within", lambda df, *a: ranked.append(df.count()) or rank_within(df, *a))
    monkeypatch.setattr(reviews, "REVIEWS_PER_TASK", 100)
    assert placed_reviews(pieces_of(spark)) == whole
    assert ranked == [500]
