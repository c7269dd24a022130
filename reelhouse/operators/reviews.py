"""Review documents to rows, and rows back to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.functions.keys import surrogate_id
from reelhouse.functions.text import strip
from reelhouse.functions.values import date_parts, release_year, runtime_minutes
from reelhouse.operators.ranking import rank_within
from reelhouse.schemas import REVIEW_PAYLOAD
from reelhouse.session import staged

REVIEWS_PER_SECTION = 20
REVIEWS_PER_PAGE = 10
# Reviews of a section that one piece of a document holds; a longer section goes on in the next piece.
REVIEWS_PER_PIECE = 1000
# A medium with more reviews than this is ranked over several tasks.
REVIEWS_PER_TASK = 100_000

# List of a document's details that names companies, and the role.
COMPANY_LISTS = {
    "developers": "developer",
    "publishers": "publisher",
    "production_companies": "production_companies",
}


def title(docs: DataFrame) -> Column:
    """First non-empty of the three title fields."""
    return F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in ("title", "tv_title", "game_title")])


def with_media_id(docs: DataFrame) -> DataFrame:
    """Add `primary_title` and the media id; a title is unique within its category."""
    return docs.withColumn("primary_title", title(docs)).withColumn(
        "media_id", surrogate_id("category", "primary_title")
    )


def media_info(docs: DataFrame) -> DataFrame:
    """One media row per document."""
    details = F.col("media_details")
    date = F.coalesce(
        F.nullif(details["initial_release_date"], F.lit("")),
        F.nullif(details["release_date"], F.lit("")),
    )
    return docs.select(
        F.col("media_id").alias("id"),
        "media_type",
        "primary_title",
        date.alias("release_date"),
        release_year(date).alias("release_year"),
        runtime_minutes(details["duration"]).cast("double").alias("duration"),
        details["rating"].alias("pegi_mpa_rating"),
        details["summary"].alias("description"),
    )


def document_order(docs_key: str = "media_id") -> Column:
    """Arrival order of a document: any fixed order serves, folders are listed in none."""
    return F.xxhash64(docs_key).cast("decimal(20,0)")


# Positions inside one document fit below this; the document comes above it.
_IN_DOCUMENT = 1 << 53


def _seq(in_document: Column) -> Column:
    above = document_order() * F.lit(_IN_DOCUMENT).cast("decimal(16,0)")
    return (above + in_document.cast("decimal(16,0)")).cast("decimal(38,0)")


def genres(docs: DataFrame) -> DataFrame:
    """(ref_id, seq, genre_title), trimmed, one row per listed genre."""
    return docs.select("media_id", F.posexplode("media_details.genres").alias("_pos", "_g")).select(
        F.col("media_id").alias("ref_id"),
        _seq(F.col("_pos")).alias("seq"),
        strip(F.col("_g")).alias("genre_title"),
    )


def companies(docs: DataFrame) -> DataFrame:
    """(ref_id, seq, company_role, company_name): the three lists as one, tagged."""

    def tag(field: str, role: str) -> Column:
        names = F.coalesce(F.col(f"media_details.{field}"), F.array().cast("array<string>"))
        return F.transform(names, lambda n: F.struct(F.lit(role).alias("role"), n.alias("name")))

    tagged = F.concat(*[tag(field, role) for field, role in COMPANY_LISTS.items()])
    return docs.select("media_id", F.posexplode(tagged).alias("_pos", "_c")).select(
        F.col("media_id").alias("ref_id"),
        _seq(F.col("_pos")).alias("seq"),
        F.col("_c.role").alias("company_role"),
        F.col("_c.name").alias("company_name"),
    )


def all_reviews(docs: DataFrame, *carry: str) -> DataFrame:
    """(carry, source, section_pos, section_name, pos, review): critics first, duplicates kept.

    Of documents in pieces (`section_pieces`), `pos` counts through all pieces of a section.
    """
    pieces = "piece" in docs.columns
    before = F.col("piece") * REVIEWS_PER_PIECE if pieces else F.lit(0)

    def tagged(field: str, source: int) -> Column:
        entries = F.map_entries(F.coalesce(F.col(field), F.create_map().cast(docs.schema[field].dataType)))
        return F.transform(
            entries,
            lambda e: F.struct(
                F.lit(source).alias("source"), e["key"].alias("section"), e["value"].alias("reviews")
            ),
        )

    sections = F.concat(tagged("critic_reviews", 0), tagged("user_reviews", 1))
    return (
        docs.select(*carry, before.alias("_before"), F.posexplode(sections).alias("section_pos", "_s"))
        .select(
            *carry,
            "section_pos",
            "_before",
            F.col("_s.source").alias("source"),
            F.col("_s.section").alias("section_name"),
            F.posexplode("_s.reviews").alias("pos", "review"),
        )
        .withColumn("pos", F.col("_before") + F.col("pos"))
        .drop("_before")
    )


def review_rows(docs: DataFrame) -> DataFrame:
    """One row per review with the natural keys of its dimensions."""
    flat = all_reviews(docs, "media_id", "section_type")
    r = F.col("review")
    year, month, day = date_parts(r["post_date"])
    within = F.shiftleft(F.col("section_pos").cast("long"), 32) + F.col("pos")
    return flat.select(
        F.col("media_id").alias("media_info_id"),
        _seq(within).alias("seq"),
        r["rating"].alias("rating"),
        year.alias("year"),
        month.alias("month"),
        day.alias("day"),
        r["author"].alias("reviewer_username"),
        r["company"].alias("association"),
        r["isCritic"].alias("is_critic"),
        "section_type",
        "section_name",
    )


def review_count(docs: DataFrame) -> Column:
    """Critic and user reviews of a document over all its sections."""

    def total(field: str) -> Column:
        sizes = F.transform(F.map_values(field), lambda v: F.coalesce(F.size(v), F.lit(0)))
        return F.coalesce(F.aggregate(sizes, F.lit(0), lambda a, x: a + x), F.lit(0))

    return total("critic_reviews") + total("user_reviews")


def normalise(payloads: DataFrame, payload: str, is_critic: str, *carry: str) -> DataFrame:
    """Review service replies to review structs: (carry, pos, review).

    A reply carrying an error yields nothing. A critic without a name goes by the
    publication's slug.
    """
    data = F.from_json(F.col(payload), REVIEW_PAYLOAD)
    items = (
        payloads.withColumn("_data", data)
        .where(F.coalesce(F.col("_data._error"), F.lit("")) == "")
        .select(*carry, is_critic, F.posexplode("_data.items").alias("pos", "_i"))
    )
    i = F.col("_i")
    author = F.coalesce(i["author"], F.lit(""))
    slug = F.coalesce(i["publicationSlug"], F.lit(""))
    return items.select(
        *carry,
        "pos",
        F.struct(
            F.when(F.col(is_critic) & (author == ""), slug).otherwise(author).alias("author"),
            i["publicationName"].alias("company"),
            F.coalesce(i["quote"], F.lit("")).alias("quote"),
            i["score"].alias("rating"),
            F.coalesce(i["date"], F.lit("")).alias("post_date"),
            i["url"].alias("full_review_src_url"),
            F.coalesce(i["spoiler"], F.lit(False)).alias("spoiler"),
            F.col(is_critic).alias("isCritic"),
        ).alias("review"),
    )


def first_reviews(
    reviews: DataFrame,
    section: list[str],
    order: str,
    limit: int | None = None,
    per_page: int = REVIEWS_PER_PAGE,
) -> DataFrame:
    """Reviews per section with their rank and page; with a `limit`, only the first so many."""
    rank = F.row_number().over(W.partitionBy(*section).orderBy(order))
    ranked = reviews.withColumn("rank", rank)
    if limit is not None:
        ranked = ranked.where(F.col("rank") <= limit)
    return ranked.withColumn("page", F.floor((F.col("rank") - 1) / per_page).cast("int"))


def section_maps(first: DataFrame, media: list[str], order: str = "rank") -> DataFrame:
    """Attach reviews per section: (media, critic_reviews, user_reviews).

    A list holds all reviews of one document's section, as the document will.
    """
    lists = first.groupBy(*media, "section_name", F.col("review.isCritic").alias("_critic")).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("review").alias("r")))),
            lambda x: x["r"],
        ).alias("_reviews")
    )
    entry = F.struct("section_name", "_reviews")

    def maps(critic: bool) -> Column:
        entries = F.collect_list(F.when(F.col("_critic") == F.lit(critic), entry))
        return F.map_from_entries(F.array_sort(entries))

    return lists.groupBy(*media).agg(
        maps(True).alias("critic_reviews"), maps(False).alias("user_reviews")
    )


def section_pieces(reviews: DataFrame, media: str, order: str, review: Column | None = None) -> DataFrame:
    """All reviews of every medium in pieces: (media, piece, critic_reviews, user_reviews).

    A piece holds `REVIEWS_PER_PIECE` reviews of a section at most, in order, and the next piece goes on
    from there, so that a medium with any number of reviews is no single row. `order` is unique
    within a medium. `review` makes the review of a row where there is no such column yet.

    Rows are dealt out by medium once, short as they are, and ranked and listed where they are; the pieces stay dealt
    by medium. Only media of more than `REVIEWS_PER_TASK` reviews are ranked over several tasks.
    """
    review = F.col("review") if review is None else review
    counts = reviews.groupBy(media).agg(F.count(F.lit(1)).alias("_n"))
    hot = staged(counts.where(F.col("_n") > REVIEWS_PER_TASK).select(media), "hot-media")
    if hot.isEmpty():
        return _pieces_by_medium(reviews, media, order, review)
    usual = _pieces_by_medium(reviews.join(hot, media, "left_anti"), media, order, review)
    section = F.struct(media, "section_name", F.col("review.isCritic").alias("critic"))
    large = reviews.join(hot, media, "left_semi").withColumn("review", review).withColumn("_section", section)
    return usual.unionByName(_pieces(rank_within(large, "_section", order, "_rank"), media))


def _pieces_by_medium(reviews: DataFrame, media: str, order: str, review: Column) -> DataFrame:
    dealt = reviews.repartition(media).withColumn("review", review)
    section = W.partitionBy(media, "section_name", F.col("review.isCritic")).orderBy(order)
    return _pieces(dealt.withColumn("_rank", F.row_number().over(section) - 1), media)


def _pieces(ranked: DataFrame, media: str) -> DataFrame:
    piece = F.floor(F.col("_rank") / REVIEWS_PER_PIECE).cast("int")
    return section_maps(ranked.withColumn("piece", piece), [media, "piece"], "_rank")
