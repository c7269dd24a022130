"""The dashboard queries over the stand-in warehouse."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelhouse.functions.values import exact_mean
from reelhouse.plans import dashboards
from reelhouse.plans.catalog.registry import also, query
from reelhouse.plans.standins import Staged, reviews

WORD = "MACH"


def _rounded(total: str, n: str) -> str:
    """Mean of whole numbers to two places, half up, in whole numbers only."""
    return f"CAST((200 * {total} + {n}) // (2 * {n}) AS DOUBLE) / 100"


def _by_year(critics: str) -> str:
    return f"""
        SELECT "year", {_rounded("sum(rating)", "count(*)")} AS avg_rating
        FROM fact WHERE is_critic = {critics} AND "year" IS NOT NULL
        GROUP BY "year" ORDER BY "year" """


@query(
    "q1_avg_by_genre_platform",
    """
    SELECT genre_title || ' - ' || section_name AS genre_platform, avg(rating) AS avg_rating
    FROM fact JOIN bridge_genre b ON b.media_id = media_info_id
    JOIN genres g ON g.id = b.genre_id
    WHERE section_type NOT IN ('Season', 'Display')
    GROUP BY 1 ORDER BY avg_rating DESC, genre_platform""",
)
def q1(spark, sf):
    return dashboards.avg_by_genre_platform(Staged.of(spark, sf))


_BY_COMPANY = """
    SELECT company_name AS company, avg(rating) AS avg_rating
    FROM fact JOIN bridge_company b ON b.media_id = media_info_id
    JOIN companies c ON c.id = b.company_id
    WHERE company_role IN ('developer')
    GROUP BY 1 ORDER BY avg_rating DESC, company"""


@query("q2_avg_by_company", _BY_COMPANY)
def q2(spark, sf):
    return dashboards.avg_by_company(Staged.of(spark, sf))


def _as_double(df):
    return df.withColumn("avg_rating", F.col("avg_rating").cast("double"))


@query("q3_user_avg_by_year", _by_year("false"))
def q3(spark, sf):
    return _as_double(dashboards.avg_by_year(Staged.of(spark, sf), critics=False))


@query("q4_critic_avg_by_year", _by_year("true"))
def q4(spark, sf):
    return _as_double(dashboards.avg_by_year(Staged.of(spark, sf), critics=True))


@query(
    "q5_avg_by_name_match",
    f"""
    SELECT primary_title, avg(rating) AS avg_rating
    FROM fact JOIN media m ON m.id = media_info_id
    JOIN bridge_role b ON b.media_id = m.id JOIN roles r ON r.id = b.role_id
    WHERE role LIKE '%{WORD}%' OR person_name LIKE '%{WORD}%'
    GROUP BY 1 ORDER BY avg_rating, primary_title""",
)
def q5(spark, sf):
    return dashboards.avg_by_name_match(Staged.of(spark, sf), WORD)


_SCORES = """
    SELECT company_name AS company, genre_title AS genre, sum(rating * bg.weight) AS weighted_score
    FROM fact JOIN bridge_genre bg ON bg.media_id = media_info_id
    JOIN genres g ON g.id = bg.genre_id
    JOIN bridge_company bc ON bc.media_id = media_info_id
    JOIN companies c ON c.id = bc.company_id
    GROUP BY 1, 2"""


@query(
    "q6_best_genre_per_company",
    f"""
    SELECT company, genre AS best_rated_genre
    FROM (SELECT *, row_number() OVER (PARTITION BY company
                 ORDER BY weighted_score DESC, genre) AS rn FROM ({_SCORES}) s)
    WHERE rn = 1""",
)
def q6(spark, sf):
    return dashboards.best_genre_per_company(Staged.of(spark, sf))


@query("q7_company_roles", "SELECT DISTINCT company_role FROM companies")
def q7(spark, sf):
    return dashboards.company_roles(Staged.of(spark, sf))


_BAND = """CASE WHEN avg_rating BETWEEN 0 AND 35 THEN 'red'
    WHEN avg_rating BETWEEN 36 AND 49 THEN 'yellow'
    WHEN avg_rating BETWEEN 50 AND 80 THEN 'green'
    WHEN avg_rating BETWEEN 80 AND 100 THEN 'dark-green' END"""


@query("q8_score_band", f"SELECT *, {_BAND} AS band FROM ({_BY_COMPANY}) q")
def q8(spark, sf):
    return dashboards.company_score_bands(Staged.of(spark, sf))


_ATTRIBUTES = """SELECT DISTINCT 'genre' AS kind, media_id, genre_title AS attribute
        FROM bridge_genre JOIN genres ON genres.id = genre_id
    UNION SELECT 'company', media_id, company_name
        FROM bridge_company JOIN companies ON companies.id = company_id
    UNION SELECT 'role', media_id, role FROM bridge_role JOIN roles ON roles.id = role_id"""


@query(
    "rating_by_attribute",
    f"""
    WITH named AS ({_ATTRIBUTES})
    SELECT kind, attribute, count(rating) AS ratings, avg(rating) AS avg_rating,
           avg(rating) - (SELECT avg(rating) FROM fact) AS lift
    FROM fact JOIN named ON media_id = media_info_id
    GROUP BY kind, attribute HAVING count(rating) >= 20""",
)
def rating_by_attribute(spark, sf):
    return dashboards.rating_by_attribute(Staged.of(spark, sf))


@query("agg_weighted_sum", _SCORES)
def weighted_sum(spark, sf):
    return dashboards.company_genre_scores(Staged.of(spark, sf))


@query(
    "agg_avg",
    "SELECT section_name, avg(rating) AS avg_rating FROM reviews GROUP BY 1",
)
def agg_avg(spark, sf):
    return reviews(spark, sf).groupBy("section_name").agg(F.avg("rating").alias("avg_rating"))


@query(
    "agg_avg_round2",
    f"""SELECT section_name, {_rounded("sum(rating)", "count(*)")} AS avg_rating
    FROM reviews GROUP BY 1""",
)
def agg_avg_round2(spark, sf):
    mean = exact_mean(F.sum("rating"), F.count("rating"), 2).cast("double")
    return reviews(spark, sf).groupBy("section_name").agg(mean.alias("avg_rating"))


_LABEL = "section_type || ' - ' || section_name"


@query(
    "fn_concat_label",
    f"SELECT {_LABEL} AS label, count(*) AS n FROM reviews GROUP BY 1",
)
def concat_label(spark, sf):
    label = F.concat("section_type", F.lit(" - "), "section_name").alias("label")
    return reviews(spark, sf).groupBy(label).agg(F.count(F.lit(1)).alias("n"))


also("join_star", "q1_avg_by_genre_platform")
also("flt_not_in", "q1_avg_by_genre_platform")
also("sort_avg_desc", "q2_avg_by_company")
also("flt_in_param", "q2_avg_by_company")
also("sort_year_asc", "q3_user_avg_by_year")
also("sort_avg_asc", "q5_avg_by_name_match")
also("flt_like_or", "q5_avg_by_name_match")
also("win_row_number_top1", "q6_best_genre_per_company")
also("agg_distinct_param", "q7_company_roles")
