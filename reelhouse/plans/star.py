"""From landing documents and catalogue files to the warehouse and the graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.functions.keys import composite_key
from reelhouse.functions.text import normalize_title, token_set
from reelhouse.functions.values import numeric_or_null
from reelhouse.operators import entities, filters, graph, linkage, reviews, roles
from reelhouse.operators.clustering import cluster_attribute
from reelhouse.schemas import WAREHOUSE
from reelhouse.session import cut_lineage, staged
from reelhouse.sources.readers import CORRUPT

TIME_KEY = ("year", "month", "day")
REVIEWER_KEY = ("reviewer_username", "association")
SECTION_KEY = ("section_name", "section_type")
COMPANY_KEY = ("company_name", "company_role")
FACT_KEY = ("reviewer_id", "time_id", "section_id", "media_info_id")

# Sections of these types have no groups of their own.
UNGROUPED_SECTIONS = ("Season", "Display")
LINK_THRESHOLD = 0.6
LINK_BANDS = (linkage.Band("year", 1), linkage.Band("runtime", 2, (None, 0)))


@dataclass(frozen=True)
class Catalogue:
    """The three catalogue files, pruned to the columns in use."""

    titles: DataFrame
    principals: DataFrame
    names: DataFrame


def fact_and_dimensions(rows: DataFrame) -> dict[str, DataFrame]:
    """Review rows to the fact table and its three shared dimensions."""
    sections = entities.distinct_entities(rows, SECTION_KEY, "seq")
    fact = rows
    for keys, fk in (
        (TIME_KEY, "time_id"),
        (REVIEWER_KEY, "reviewer_id"),
        (SECTION_KEY, "section_id"),
    ):
        fact = entities.remap_foreign_key(fact, keys, fk)
    return {
        "DIM_TIME": entities.distinct_entities(rows, TIME_KEY, "seq"),
        "DIM_REVIEWER": entities.distinct_entities(rows, REVIEWER_KEY, "seq", ("is_critic",)),
        "DIM_SECTION": cluster_attribute(
            sections, "section_name", "section_group", "section_type", blacklist=UNGROUPED_SECTIONS
        ),
        "FACT_REVIEWS": entities.facts(
            fact.select(*FACT_KEY, "rating", "seq"), FACT_KEY, "seq"
        ).drop("seq"),
    }


def bridge_table(rows: DataFrame, keys: tuple[str, ...], fk: str) -> DataFrame:
    # A medium's few rows are dealt out once, and short: ids are derived last.
    refs = rows.select(F.col("ref_id").alias("media_id"), composite_key(*keys).alias(fk))
    return entities.bridge(refs.repartition("media_id"), "media_id", fk).withColumn(fk, F.md5(fk))


def link_catalogue(media: DataFrame, titles: DataFrame) -> DataFrame:
    """(tconst, media_id, similarity): one catalogue title per medium at most."""
    years = entities.year_set(filters.linkage_targets(media))
    left = filters.linkage_targets(media).select(
        F.col("id").alias("key"),
        token_set(normalize_title(F.col("primary_title"))).alias("tokens"),
        F.col("release_year").alias("year"),
        F.col("duration").cast("int").alias("runtime"),
    )
    right = filters.catalogue_acceptable(titles, years).select(
        F.col("tconst").alias("key"),
        token_set(normalize_title(F.col("primaryTitle"))).alias("tokens"),
        F.col("startYear").alias("year"),
        numeric_or_null(F.col("runtimeMinutes")).cast("int").alias("runtime"),
    )
    groups = [linkage.copy_groups(side, "key", "tokens", (), LINK_BANDS) for side in (left, right)]
    similar = linkage.similar_groups(*groups, bands=LINK_BANDS, threshold=LINK_THRESHOLD)
    pairs = linkage.fuzzy_pairs(*groups, similar)
    group = linkage.copy_group("tokens", (), LINK_BANDS)
    matched = linkage.one_to_one(pairs, left, right, "key", group)
    return matched.select(
        F.col("candidate").alias("tconst"), F.col("target").alias("media_id"), "similarity"
    )


def build_warehouse(docs: DataFrame, catalogue: Catalogue) -> dict[str, DataFrame]:
    """All 11 warehouse tables, lazy but for staging and the linkage and clustering rounds.

    The documents are parsed once and staged, and so are the credits (`roles.role_tables`): every
    table reads the columns it needs from there. Documents that did not parse are left out;
    `accepted` tells which.
    """
    docs, _ = accepted(docs)
    media = reviews.media_info(docs)
    genre_rows, company_rows = reviews.genres(docs), reviews.companies(docs)
    matches = cut_lineage(link_catalogue(media, catalogue.titles))
    role_rows, role_refs, _ = roles.role_tables(catalogue.principals, catalogue.names, matches)
    return {
        "COMPANIES": entities.distinct_entities(company_rows, COMPANY_KEY, "seq"),
        "GENRES": entities.distinct_entities(genre_rows, ("genre_title",), "seq"),
        "ROLES": role_rows,
        "DIM_MEDIA_INFO": cluster_attribute(
            media, "primary_title", "franchise", "media_type"
        ).drop("release_year"),
        "BRIDGE_MEDIA_GENRE": bridge_table(genre_rows, ("genre_title",), "genre_id"),
        "BRIDGE_MEDIA_COMPANY": bridge_table(company_rows, COMPANY_KEY, "company_id"),
        "BRIDGE_MEDIA_ROLE": entities.bridge(role_refs, "media_id", "role_id"),
        **fact_and_dimensions(reviews.review_rows(docs)),
    }


def document_tables(docs: DataFrame) -> dict[str, DataFrame]:
    """The warehouse tables as far as documents alone give them, for loads batch by batch.

    Contributors come from the catalogue, and groups of names from all media at once: both are left to a build of
    everything, so there are no roles here, and `franchise` and `section_group` are null.
    """
    docs, _ = accepted(docs)
    spark = docs.sparkSession
    genre_rows, company_rows = reviews.genres(docs), reviews.companies(docs)
    rows = staged(reviews.review_rows(docs), "review-rows")
    foreign = {"time_id": TIME_KEY, "reviewer_id": REVIEWER_KEY, "section_id": SECTION_KEY}
    nothing = F.lit(None).cast("string")
    return {
        "COMPANIES": entities.distinct_entities(company_rows, COMPANY_KEY, "seq"),
        "GENRES": entities.distinct_entities(genre_rows, ("genre_title",), "seq"),
        "DIM_MEDIA_INFO": reviews.media_info(docs).drop("release_year").withColumn("franchise", nothing),
        "DIM_TIME": entities.distinct_entities(rows, TIME_KEY, "seq"),
        "DIM_REVIEWER": entities.distinct_entities(rows, REVIEWER_KEY, "seq", ("is_critic",)),
        "DIM_SECTION": entities.distinct_entities(rows, SECTION_KEY, "seq").withColumn("section_group", nothing),
        "BRIDGE_MEDIA_GENRE": bridge_table(genre_rows, ("genre_title",), "genre_id"),
        "BRIDGE_MEDIA_COMPANY": bridge_table(company_rows, COMPANY_KEY, "company_id"),
        "FACT_REVIEWS": entities.facts_by_keys(rows, foreign, "seq", ids=("media_info_id",)),
        **{n: spark.createDataFrame([], WAREHOUSE[n].schema) for n in ("ROLES", "BRIDGE_MEDIA_ROLE")},
    }


def accepted(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents with ids, staged, and the report of those that did not parse: (path, category, record)."""
    parsed = staged(reviews.with_media_id(docs), "documents")
    if CORRUPT not in parsed.columns:
        empty = docs.sparkSession.createDataFrame([], "path string, category string, record string")
        return parsed, empty
    broken = F.col(CORRUPT).isNotNull()
    report = parsed.where(broken).select("path", "category", F.col(CORRUPT).alias("record"))
    return parsed.where(~broken).drop(CORRUPT), report


def build_graph(warehouse: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(nodes, links) before upsert. Names are node ids, as the graph is read by name."""
    media = warehouse["DIM_MEDIA_INFO"].withColumn("seq", F.xxhash64("id")).drop("franchise")
    genre = warehouse["GENRES"].withColumn("seq", F.xxhash64("id"))
    company = warehouse["COMPANIES"].withColumn("seq", F.xxhash64("id"))
    role = warehouse["ROLES"].withColumn("seq", F.xxhash64("id"))
    all_nodes = graph.union_all(
        graph.nodes(media, "primary_title", "Media", drop=("id",)),
        graph.nodes(genre, "genre_title", "Genre"),
        graph.nodes(company, "company_name", "Company", drop=("company_role",)),
        graph.nodes(role, "person_name", "Cast", drop=("role", "play_method")),
    )

    def link(bridge: str, fk: str, targets: DataFrame, name: str, labels, attrs=()) -> DataFrame:
        refs = warehouse[bridge].select("media_id", fk)
        return graph.links(refs, media, targets, "primary_title", name, labels, attrs)

    all_links = graph.union_all(
        link("BRIDGE_MEDIA_GENRE", "genre_id", genre, "genre_title", ("Media", "has_genre", "Genre")),
        link(
            "BRIDGE_MEDIA_COMPANY",
            "company_id",
            company,
            "company_name",
            ("Media", "associated_with", "Company"),
            ("company_role",),
        ),
        link(
            "BRIDGE_MEDIA_ROLE",
            "role_id",
            role,
            "person_name",
            ("Media", "has_cast", "Cast"),
            ("role", "play_method"),
        ),
    )
    return all_nodes, all_links
