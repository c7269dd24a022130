"""Documents and catalogue files to a published warehouse and an upserted graph."""

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import graph
from reelhouse.plans import star
from reelhouse.schemas import DOCUMENT
from reelhouse.sources import sinks
from reelhouse.sources.readers import category_columns


def review(author, rating, critic, company=None, date="2020-01-05"):
    return {"author": author, "company": company, "quote": "q", "rating": rating, "post_date": date,
            "full_review_src_url": None, "spoiler": False, "isCritic": critic}


DOCS = [
    ("GAMES", {"game_title": "Super Mario One", "media_details": {
        "summary": "s", "genres": [" Action ", "action", "Kart"], "developers": ["Nin"], "publishers": ["Nin"],
        "initial_release_date": "Nov 1, 1999"},
        "critic_reviews": {"Switch": [review("Ann", 90, True, "Mag"), review("ann", 10, True, "mag")]},
        "user_reviews": {"Switch": [review("Bob", 7, False, date=""), review("Bob", None, False)]}}),
    ("GAMES", {"game_title": "Super Mario Two", "media_details": {
        "genres": ["Action"], "initial_release_date": "Nov 1, 2001"}}),
    ("MOVIES", {"title": "The Big Film", "media_details": {
        "genres": [], "production_companies": ["Nin"], "release_date": "Nov 12, 2018", "duration": "1 h 30 m"},
        "critic_reviews": {"_default": [review("Ann", 50, True, "Mag")]}, "user_reviews": {}}),
    ("MOVIES", {"title": "Undated", "media_details": {"release_date": "TBA"}}),
]


@pytest.fixture(scope="module")
def warehouse(spark):
    import json

    rows = [(c, json.dumps(d)) for c, d in DOCS]
    docs = spark.createDataFrame(rows, "category string, body string")
    docs = docs.withColumn("d", F.from_json("body", DOCUMENT)).select("category", "d.*")
    media_type, section_type = category_columns(F.col("category"))
    docs = docs.withColumns({"media_type": media_type, "section_type": section_type})
    titles = spark.createDataFrame(
        [("tt1", "movie", "Big Film, The!", "2017", "91"), ("tt2", "movie", "Big Film", "2018", "300"),
         ("tt3", "movie", "The Big Film", "2025", "90"), ("tt4", "tvEpisode", "The Big Film", "2018", "90")],
        "tconst string, titleType string, primaryTitle string, startYear string, runtimeMinutes string")
    principals = spark.createDataFrame(
        [("tt1", "n1", "Actress ", None, '["Eve"]'), ("tt1", "n2", "director", None, None),
         ("tt1", "n3", "writer", "screenplay", None), ("tt3", "n1", "actor", None, '["X"]')],
        "tconst string, nconst string, category string, job string, characters string")
    names = spark.createDataFrame([("n1", "Meryl"), ("n2", "Dee")], "nconst string, primaryName string")
    return star.build_warehouse(docs, star.Catalogue(titles, principals, names))


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_tables(warehouse):
    assert rows_of(warehouse["GENRES"], F.lower("genre_title")) == [("action",), ("kart",)]
    assert rows_of(warehouse["COMPANIES"], "company_role", "company_name") == [
        ("developer", "Nin"), ("production_companies", "Nin"), ("publisher", "Nin")]
    # n2 did nothing that is known, n3 has no name.
    assert rows_of(warehouse["ROLES"], "person_name", "play_method", "role") == [("Meryl", "actor", "Eve")]
    assert rows_of(warehouse["DIM_MEDIA_INFO"], "primary_title", "franchise", "duration") == [
        ("Super Mario One", "super mario", None), ("Super Mario Two", "super mario", None),
        ("The Big Film", None, 90.0), ("Undated", None, None)]
    assert rows_of(warehouse["DIM_TIME"], "year", "month", "day") == [(2020, 1, 5), (None, None, None)]
    # The second spelling of a critic is the same critic, and the first review stays.
    assert rows_of(warehouse["FACT_REVIEWS"], "rating") == [(50,), (7,), (90,)]
    assert rows_of(warehouse["DIM_REVIEWER"], "reviewer_username", "association") == [
        ("Ann", "Mag"), ("Bob", None)]
    assert rows_of(warehouse["BRIDGE_MEDIA_GENRE"], "weight") == [(0.5,), (0.5,), (1.0,)]


def test_publishes_clean(spark, warehouse, tmp_path):
    sinks.publish(spark, warehouse, str(tmp_path))
    counts = {r.table_name: r["rows"] for r in sinks.row_counts(sinks.open_warehouse(spark, str(tmp_path))).collect()}
    assert counts["FACT_REVIEWS"] == 3 and counts["BRIDGE_MEDIA_ROLE"] == 1


def test_graph(warehouse):
    nodes, links = star.build_graph(warehouse)
    merged = graph.upsert_nodes(nodes)
    final = graph.upsert_links(links, merged)
    assert rows_of(final.where("_GRAPH_LINK_LABEL = 'has_cast'"), "_GRAPH_SRC_NODE_ID", "_GRAPH_TRGT_NODE_ID") == [
        ("The Big Film", "Meryl")]
    cast = final.where("_GRAPH_LINK_LABEL = 'has_cast'").first()[graph.ATTRS]
    assert cast == {"role": "Eve", "play_method": "actor"}
    # Developer and publisher of one game are one link; the later role stays.
    made = final.where("_GRAPH_TRGT_NODE_ID = 'Nin' AND _GRAPH_SRC_NODE_ID = 'Super Mario One'").collect()
    assert len(made) == 1 and made[0][graph.ATTRS]["company_role"] in ("developer", "publisher")


NODE_DDL = "_GRAPH_NODE_LABEL string, _GRAPH_NODE_ID string, attrs map<string,string>, seq int"


def test_upsert_keeps_latest_value_per_attribute(spark):
    rows = spark.createDataFrame(
        [("M", "x", {"a": "1", "b": "1"}, 1), ("M", "x", {"a": "2"}, 2), ("N", "x", {}, 1),
         ("M", "y", {"a": None}, 3)], NODE_DDL)
    old = spark.createDataFrame(
        [("M", "x", {"a": "0", "c": "0"}), ("M", "y", {"a": "0"}), ("M", "z", {"q": "1"})],
        "_GRAPH_NODE_LABEL string, _GRAPH_NODE_ID string, attrs map<string,string>")
    got = {(r[0], r[1]): r.attrs for r in graph.upsert_nodes(rows, old).collect()}
    assert got == {("M", "x"): {"a": "2", "b": "1", "c": "0"}, ("N", "x"): {}, ("M", "y"): {}, ("M", "z"): {"q": "1"}}


def test_link_to_a_missing_node_is_dropped(spark):
    nodes = spark.createDataFrame([("M", "x", {}, 1), ("G", "g", {}, 1)], NODE_DDL)
    links = spark.createDataFrame(
        [("M", "x", "has", "G", "g", {"k": "1"}, 1), ("M", "x", "has", "G", "g", {"k": "2"}, 2),
         ("M", "x", "has", "G", "gone", {}, 1), ("G", "x", "has", "G", "g", {}, 1)],
        "_GRAPH_SRC_LABEL string, _GRAPH_SRC_NODE_ID string, _GRAPH_LINK_LABEL string, "
        "_GRAPH_TRGT_LABEL string, _GRAPH_TRGT_NODE_ID string, attrs map<string,string>, seq int")
    got = graph.upsert_links(links, graph.upsert_nodes(nodes)).collect()
    assert [(r._GRAPH_TRGT_NODE_ID, r[graph.ATTRS]) for r in got] == [("g", {"k": "2"})]


def test_stored_graph_is_merged_run_by_run(spark, tmp_path):
    root = str(tmp_path)
    link_ddl = (
        "_GRAPH_SRC_LABEL string, _GRAPH_SRC_NODE_ID string, _GRAPH_LINK_LABEL string, "
        "_GRAPH_TRGT_LABEL string, _GRAPH_TRGT_NODE_ID string, attrs map<string,string>, seq int"
    )

    def link(target, attrs):
        return ("M", "x", "has", "G", target, attrs, 1)

    first_nodes = spark.createDataFrame([("M", "x", {"a": "1"}, 1), ("G", "g", {}, 1)], NODE_DDL)
    first_links = spark.createDataFrame([link("g", {"k": "1", "l": "1"}), link("h", {})], link_ddl)
    sinks.upsert_graph(spark, first_nodes, first_links, root)
    more_nodes = spark.createDataFrame([("M", "x", {"a": "2"}, 1), ("G", "h", {}, 1)], NODE_DDL)
    more_links = spark.createDataFrame([link("g", {"k": "2"}), link("h", {})], link_ddl)
    sinks.upsert_graph(spark, more_nodes, more_links, root)
    nodes, links = sinks.open_graph(spark, root)
    assert {(r[0], r[1]): r.attrs for r in nodes.collect()} == {
        ("M", "x"): {"a": "2"}, ("G", "g"): {}, ("G", "h"): {}}
    assert {r._GRAPH_TRGT_NODE_ID: r[graph.ATTRS] for r in links.collect()} == {
        "g": {"k": "2", "l": "1"}, "h": {}}
