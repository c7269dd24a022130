"""Declared shapes: source documents, catalogue files and the 11-table contract."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, I, D, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_STRINGS = T.ArrayType(S)

REVIEW = _struct(
    author=S,
    company=S,
    quote=S,
    rating=I,
    post_date=S,
    full_review_src_url=S,
    spoiler=B,
    isCritic=B,
)
REVIEW_MAP = T.MapType(S, T.ArrayType(REVIEW))

# One superset for movies, games and series; what a kind lacks is null.
MEDIA_DETAILS = _struct(
    summary=S,
    genres=_STRINGS,
    rating=S,
    release_date=S,
    initial_release_date=S,
    duration=S,
    developers=_STRINGS,
    publishers=_STRINGS,
    production_companies=_STRINGS,
    directed_by=_STRINGS,
    written_by=_STRINGS,
    platforms=_STRINGS,
    number_of_seasons=I,
    cast=T.ArrayType(_struct(name=S, role=S)),
    awards=T.ArrayType(_struct(name=S, summary=S)),
    seasons=T.ArrayType(_struct(season=S, season_slug=S, episodes=I, year=I, metascore=I)),
)

DOCUMENT = _struct(
    title=S,
    tv_title=S,
    game_title=S,
    media_details=MEDIA_DETAILS,
    critic_reviews=REVIEW_MAP,
    user_reviews=REVIEW_MAP,
)

# Review service reply, one per page of reviews.
REVIEW_PAYLOAD = T.StructType(
    [
        T.StructField("_error", S),
        T.StructField("totalResults", I),
        T.StructField(
            "items",
            T.ArrayType(
                _struct(
                    author=S,
                    publicationName=S,
                    publicationSlug=S,
                    quote=S,
                    score=I,
                    date=S,
                    url=S,
                    spoiler=B,
                )
            ),
        ),
    ]
)

# Catalogue files: all text, all columns in file order, pruned at the select.
CATALOGUE = {
    "title.basics": _struct(
        tconst=S,
        titleType=S,
        primaryTitle=S,
        originalTitle=S,
        isAdult=S,
        startYear=S,
        endYear=S,
        runtimeMinutes=S,
        genres=S,
    ),
    "title.principals": _struct(tconst=S, ordering=S, nconst=S, category=S, job=S, characters=S),
    "name.basics": _struct(
        nconst=S,
        primaryName=S,
        birthYear=S,
        deathYear=S,
        primaryProfession=S,
        knownForTitles=S,
    ),
}


@dataclass(frozen=True)
class Table:
    """Contract of one warehouse table."""

    name: str
    columns: dict[str, T.DataType]
    required: tuple[str, ...]
    primary_key: tuple[str, ...] = ("id",)
    foreign_keys: dict[str, str] = field(default_factory=dict)

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(n, t, True) for n, t in self.columns.items()])


def _bridge(name: str, key: str, target: str) -> Table:
    return Table(
        name,
        {"media_id": S, key: S, "weight": D},
        required=("media_id", key, "weight"),
        primary_key=("media_id", key),
        foreign_keys={"media_id": "DIM_MEDIA_INFO", key: target},
    )


# In load order: a table comes after every table it refers to.
WAREHOUSE: dict[str, Table] = {
    t.name: t
    for t in (
        Table(
            "COMPANIES",
            {"id": S, "company_role": S, "company_name": S},
            required=("id", "company_role", "company_name"),
        ),
        Table("GENRES", {"id": S, "genre_title": S}, required=("id", "genre_title")),
        Table(
            "ROLES",
            {"id": S, "person_name": S, "play_method": S, "role": S},
            required=("id", "person_name", "role"),
        ),
        Table(
            "DIM_MEDIA_INFO",
            {
                "id": S,
                "media_type": S,
                "franchise": S,
                "primary_title": S,
                "release_date": S,
                "duration": D,
                "pegi_mpa_rating": S,
                "description": S,
            },
            required=("id", "media_type", "primary_title", "release_date"),
        ),
        Table(
            "DIM_SECTION",
            {"id": S, "section_type": S, "section_group": S, "section_name": S},
            required=("id", "section_type", "section_name"),
        ),
        Table(
            "DIM_REVIEWER",
            {"id": S, "association": S, "is_critic": B, "reviewer_username": S},
            required=("id", "is_critic"),
        ),
        Table("DIM_TIME", {"id": S, "year": I, "month": I, "day": I}, required=("id",)),
        _bridge("BRIDGE_MEDIA_ROLE", "role_id", "ROLES"),
        _bridge("BRIDGE_MEDIA_GENRE", "genre_id", "GENRES"),
        _bridge("BRIDGE_MEDIA_COMPANY", "company_id", "COMPANIES"),
        Table(
            "FACT_REVIEWS",
            {
                "reviewer_id": S,
                "time_id": S,
                "section_id": S,
                "media_info_id": S,
                "rating": I,
            },
            required=("reviewer_id", "time_id", "section_id", "media_info_id", "rating"),
            primary_key=("reviewer_id", "time_id", "section_id", "media_info_id"),
            foreign_keys={
                "reviewer_id": "DIM_REVIEWER",
                "time_id": "DIM_TIME",
                "section_id": "DIM_SECTION",
                "media_info_id": "DIM_MEDIA_INFO",
            },
        ),
    )
}
