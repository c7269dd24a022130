"""The star-join analytics.

Every query sums and counts ratings before it joins a bridge or a large dimension,
so what is shuffled and fanned out is one row per (media, ...) and not one per
review. Joins that only prove existence are left out: the publish gate has
already checked the foreign keys (`operators.quality`). No side is broadcast by
hint; Spark and AQE choose from measured sizes and split skewed keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.values import SCORE_BANDS, exact_mean, score_band
from reelhouse.operators.filters import name_like
from reelhouse.session import joinable

Star = Mapping[str, DataFrame]


def _totals(facts: DataFrame, *keys: str) -> DataFrame:
    return facts.groupBy(*keys).agg(
        F.sum(F.col("rating").cast("long")).alias("total"), F.count("rating").alias("n")
    )


def _mean() -> Column:
    return (F.sum("total") / F.sum("n")).alias("avg_rating")


def avg_by_genre_platform(
    star: Star, excluded: Sequence[str] = ("Season", "Display")
) -> DataFrame:
    """Mean rating per "genre - section", best first."""
    sections = (
        star["DIM_SECTION"]
        .where(~F.col("section_type").isin(*excluded))
        .select(F.col("id").alias("section_id"), "section_name")
    )
    genres = star["GENRES"].select(F.col("id").alias("genre_id"), "genre_title")
    return (
        _totals(star["FACT_REVIEWS"].join(sections, "section_id"), "media_info_id", "section_name")
        .join(_by_media(star["BRIDGE_MEDIA_GENRE"]), "media_info_id")
        .groupBy("genre_id", "section_name")
        .agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        .join(genres, "genre_id")
        .groupBy(F.concat("genre_title", F.lit(" - "), "section_name").alias("genre_platform"))
        .agg(_mean())
        .orderBy(F.desc("avg_rating"), "genre_platform")
    )


def _by_media(bridge: DataFrame) -> DataFrame:
    return bridge.withColumnRenamed("media_id", "media_info_id")


def avg_by_company(star: Star, roles: Sequence[str] = ("developer",)) -> DataFrame:
    """Mean rating per company among the chosen roles, best first."""
    companies = (
        star["COMPANIES"]
        .where(F.col("company_role").isin(*roles))
        .select(F.col("id").alias("company_id"), "company_name")
    )
    return (
        _by_media(star["BRIDGE_MEDIA_COMPANY"])
        .join(companies, "company_id")
        .join(_totals(star["FACT_REVIEWS"], "media_info_id"), "media_info_id")
        .groupBy(F.col("company_name").alias("company"))
        .agg(_mean())
        .orderBy(F.desc("avg_rating"), "company")
    )


def avg_by_year(star: Star, critics: bool) -> DataFrame:
    """Mean rating per year of the critics or of the users, to two places."""
    reviewers = (
        star["DIM_REVIEWER"]
        .where(F.col("is_critic") == F.lit(critics))
        .select(F.col("id").alias("reviewer_id"))
    )
    years = (
        star["DIM_TIME"]
        .where(F.col("year").isNotNull())
        .select(F.col("id").alias("time_id"), "year")
    )
    return (
        _totals(star["FACT_REVIEWS"].join(years, "time_id"), "reviewer_id", "year")
        .join(reviewers, "reviewer_id", "left_semi")
        .groupBy("year")
        .agg(exact_mean(F.sum("total"), F.sum("n"), 2).alias("avg_rating"))
        .orderBy("year")
    )


def avg_by_name_match(star: Star, word: str = "Michael") -> DataFrame:
    """Mean rating per title that has a role or person with `word` in it, worst first.

    A title counts a review once per matching role row, as the join does.
    """
    matching = (
        star["ROLES"]
        .where(name_like(F.col("role"), F.col("person_name"), word))
        .select(F.col("id").alias("role_id"))
    )
    per_media = (
        star["BRIDGE_MEDIA_ROLE"]
        .join(matching, "role_id", "left_semi")
        .groupBy(F.col("media_id").alias("media_info_id"))
        .agg(F.count(F.lit(1)).alias("roles"))
    )
    titles = star["DIM_MEDIA_INFO"].select(F.col("id").alias("media_info_id"), "primary_title")
    return (
        _totals(star["FACT_REVIEWS"], "media_info_id")
        .join(per_media, "media_info_id")
        .join(titles, "media_info_id")
        .groupBy("primary_title")
        .agg((F.sum(F.expr("total * roles")) / F.sum(F.expr("n * roles"))).alias("avg_rating"))
        .orderBy("avg_rating", "primary_title")
    )


def company_genre_scores(star: Star) -> DataFrame:
    """Σ rating × genre weight per (company, genre)."""
    genres = star["GENRES"].select(F.col("id").alias("genre_id"), "genre_title")
    companies = star["COMPANIES"].select(F.col("id").alias("company_id"), "company_name")
    rated = _totals(star["FACT_REVIEWS"], "media_info_id").select("media_info_id", "total")
    scored = rated.join(_by_media(star["BRIDGE_MEDIA_GENRE"]), "media_info_id").select(
        "media_info_id", "genre_id", (F.col("total") * F.col("weight")).alias("score")
    )
    return (
        scored.join(_by_media(star["BRIDGE_MEDIA_COMPANY"]).drop("weight"), "media_info_id")
        .groupBy("company_id", "genre_id")
        .agg(F.sum("score").alias("score"))
        .join(genres, "genre_id")
        .join(companies, "company_id")
        .groupBy(F.col("company_name").alias("company"), F.col("genre_title").alias("genre"))
        .agg(F.sum("score").alias("weighted_score"))
    )


def best_genre_per_company(star: Star) -> DataFrame:
    """The genre with the highest weighted score of each company; ties by genre name."""
    best = F.min_by("genre", F.struct(-F.col("weighted_score"), F.col("genre")))
    return (
        company_genre_scores(star).groupBy("company").agg(best.alias("best_rated_genre"))
    )


def company_roles(star: Star) -> DataFrame:
    return star["COMPANIES"].select("company_role").distinct()


def company_score_bands(star: Star, roles: Sequence[str] = ("developer",)) -> DataFrame:
    """Mean rating per company with the colour band it falls in."""
    return avg_by_company(star, roles).withColumn("band", score_band(F.col("avg_rating")))


def rating_by_attribute(star: Star, least_ratings: int = 20) -> DataFrame:
    """How far the mean rating of titles with a genre, company or role lies from that of all.

    (kind, attribute, ratings, avg_rating, lift) for attributes with `least_ratings` or more. Ratings are
    summed per title before a bridge fans them out; nothing is paired with anything.
    """
    totals = joinable(_totals(star["FACT_REVIEWS"], "media_info_id"))
    overall = totals.agg(_mean()).first()[0]
    kinds = (
        ("genre", "BRIDGE_MEDIA_GENRE", "genre_id", "GENRES", "genre_title"),
        ("company", "BRIDGE_MEDIA_COMPANY", "company_id", "COMPANIES", "company_name"),
        ("role", "BRIDGE_MEDIA_ROLE", "role_id", "ROLES", "role"),
    )
    parts = []
    for kind, bridge, fk, entity, name in kinds:
        names = star[entity].select(F.col("id").alias(fk), F.col(name).alias("attribute"))
        named = _by_media(star[bridge]).join(names, fk).select("media_info_id", "attribute")
        rated = totals.join(named.distinct(), "media_info_id").groupBy("attribute")
        parts.append(
            rated.agg(F.sum("n").alias("ratings"), _mean())
            .where(F.col("ratings") >= least_ratings)
            .select(F.lit(kind).alias("kind"), "attribute", "ratings", "avg_rating")
        )
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return every.withColumn("lift", F.col("avg_rating") - F.lit(overall))


# The same queries as SQL text over the warehouse tables, for `spark.sql`: totals per title (or
# per title and what else is needed) first, the bridge after them.
_PER_TITLE = "SELECT media_info_id, sum(rating) AS total, count(rating) AS n FROM FACT_REVIEWS GROUP BY 1"
_PER_COMPANY = f"""
    WITH totals AS ({_PER_TITLE})
    SELECT company_name AS company, sum(total) / sum(n) AS avg_rating
    FROM totals, BRIDGE_MEDIA_COMPANY bridge, COMPANIES companies
    WHERE bridge.media_id = media_info_id AND companies.id = company_id
      AND array_contains(:roles, company_role)
    GROUP BY company_name"""
_PER_YEAR = """
    WITH totals AS (
      SELECT reviewer_id, time_id, sum(rating) AS total, count(rating) AS n
      FROM FACT_REVIEWS GROUP BY reviewer_id, time_id)
    SELECT year, round(CAST(sum(total) AS DECIMAL(28, 0)) / sum(n), 2) AS avg_rating
    FROM totals, DIM_TIME times
    WHERE times.id = time_id AND year IS NOT NULL
      AND reviewer_id IN (SELECT id FROM DIM_REVIEWER WHERE is_critic = :critics)
    GROUP BY year ORDER BY year"""
SQL = {
    "avg_by_genre_platform": """
        WITH totals AS (
          SELECT media_info_id, section_name, sum(rating) AS total, count(rating) AS n
          FROM FACT_REVIEWS, DIM_SECTION sections
          WHERE sections.id = section_id AND section_type NOT IN ('Season', 'Display')
          GROUP BY media_info_id, section_name)
        SELECT concat(genre_title, ' - ', section_name) AS genre_platform,
               sum(total) / sum(n) AS avg_rating
        FROM totals, BRIDGE_MEDIA_GENRE bridge, GENRES genres
        WHERE bridge.media_id = media_info_id AND genres.id = genre_id
        GROUP BY genre_title, section_name ORDER BY avg_rating DESC, genre_platform""",
    "avg_by_company": _PER_COMPANY + " ORDER BY avg_rating DESC, company",
    "avg_by_year": _PER_YEAR,
    "avg_by_name_match": f"""
        WITH totals AS ({_PER_TITLE}), matching AS (
          SELECT media_id, count(*) AS roles FROM BRIDGE_MEDIA_ROLE
          WHERE role_id IN (SELECT id FROM ROLES
                            WHERE contains(role, :word) OR contains(person_name, :word))
          GROUP BY media_id)
        SELECT primary_title, sum(total * roles) / sum(n * roles) AS avg_rating
        FROM totals, matching, DIM_MEDIA_INFO media
        WHERE matching.media_id = media_info_id AND media.id = media_info_id
        GROUP BY primary_title ORDER BY avg_rating, primary_title""",
    "best_genre_per_company": f"""
        WITH totals AS ({_PER_TITLE}), scored AS (
          SELECT company_name, genre_title, sum(total * g.weight) AS score
          FROM totals, BRIDGE_MEDIA_GENRE g, BRIDGE_MEDIA_COMPANY c, GENRES genres, COMPANIES companies
          WHERE g.media_id = media_info_id AND c.media_id = media_info_id
            AND genres.id = genre_id AND companies.id = company_id
          GROUP BY company_name, genre_title)
        SELECT company_name AS company,
               min_by(genre_title, struct(-score, genre_title)) AS best_rated_genre
        FROM scored GROUP BY company_name""",
    "company_roles": "SELECT company_role FROM COMPANIES GROUP BY company_role",
    "company_score_bands": f"""
        SELECT *, CASE {" ".join(
            f"WHEN avg_rating BETWEEN {low} AND {high} THEN '{name}'" for low, high, name in SCORE_BANDS
        )} END AS band
        FROM ({_PER_COMPANY})""",
}
