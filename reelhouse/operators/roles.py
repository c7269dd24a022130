"""Contributors of linked titles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions import clean
from reelhouse.operators.entities import distinct_entities, entity_refs
from reelhouse.session import staged

KEY = ("nconst", "play_method", "role")


def contributors(principals: DataFrame, matches: DataFrame) -> DataFrame:
    """Credits of matched titles: distinct (ref_id, nconst, play_method, role), role known.

    `matches(tconst, media_id)` restricts the scan; Spark broadcasts it where its
    measured size allows.
    """
    return (
        principals.join(matches.select("tconst", "media_id"), "tconst")
        .select(
            F.col("media_id").alias("ref_id"),
            "nconst",
            clean.play_method(F.col("category")).alias("play_method"),
            clean.role(F.col("characters"), F.col("job")).alias("role"),
        )
        .dropna(subset=["role"])
        .distinct()
    )


def person_names(entities: DataFrame, names: DataFrame) -> DataFrame:
    """Add `person_name`; who has none in the name file keeps null."""
    known = names.select("nconst", F.col("primaryName").alias("person_name"))
    return entities.join(known, "nconst", "left")


def role_tables(
    principals: DataFrame, names: DataFrame, matches: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ROLES rows, refs, unnamed): roles with a name, media refs to them, and the rest.

    Names are looked up once per distinct role, not per credit.
    """
    # Read three times below, so the credits are scanned once and staged.
    credits = staged(
        contributors(principals, matches).withColumn("seq", F.xxhash64("ref_id")), "credits"
    )
    named = person_names(distinct_entities(credits, KEY, "seq"), names)
    roles = named.where(F.col("person_name").isNotNull())
    refs = entity_refs(credits.withColumnRenamed("ref_id", "media_id"), KEY, "media_id", "role_id")
    kept = refs.join(roles.select(F.col("id").alias("role_id")), "role_id", "left_semi")
    return (
        roles.select("id", "person_name", "play_method", "role"),
        kept,
        named.where(F.col("person_name").isNull()),
    )
