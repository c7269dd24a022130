"""Projections, distinct entities, bridges, windows and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelhouse.functions.keys import surrogate_id
from reelhouse.functions.values import date_parts
from reelhouse.operators import entities, filters, graph, reviews
from reelhouse.operators.clustering import cluster_attribute
from reelhouse.operators.roles import contributors
from reelhouse.plans import standins
from reelhouse.plans.catalog.registry import also, key, query
from reelhouse.session import run_dir
from reelhouse.sources import sinks
from reelhouse.sources.readers import limit_per_group

table = standins.table


@query("prj_title_coalesce", "SELECT p_partkey, primary_title FROM docs")
def title_coalesce(spark, sf):
    docs = standins.documents(spark, sf)
    return docs.select("p_partkey", reviews.title(docs).alias("primary_title"))


@query(
    "prj_media_info",
    """
    SELECT media_id AS id,
           CASE category WHEN 'GAMES' THEN 'Video Game' WHEN 'TV_SHOWS' THEN 'TV Series'
                ELSE 'Movie' END AS media_type,
           primary_title, 'Nov 12, ' || (p_size + 1970) AS release_date,
           CAST(p_size + 1970 AS INTEGER) AS release_year,
           CASE WHEN category = 'MOVIES'
                THEN CAST((p_size // 10) * 60 + p_size % 10 AS DOUBLE) END AS duration,
           'R' || (p_size % 5) AS pegi_mpa_rating, p_brand AS description
    FROM docs""",
)
def media_info(spark, sf):
    return reviews.media_info(standins.documents(spark, sf))


@query(
    "prj_genres",
    """SELECT media_id AS ref_id, genre_title
    FROM docs, unnest(string_split(p_name, ' ')) AS u(genre_title)""",
)
def genres(spark, sf):
    return reviews.genres(standins.documents(spark, sf)).drop("seq")


@query(
    "prj_companies",
    """
    SELECT media_id AS ref_id, 'developer' AS company_role, p_brand AS company_name
    FROM docs WHERE category = 'GAMES'
    UNION ALL SELECT media_id, 'publisher', p_brand FROM docs WHERE category = 'GAMES'
    UNION ALL SELECT media_id, 'publisher', p_type FROM docs WHERE category = 'GAMES'
    UNION ALL SELECT media_id, 'production_companies', p_brand
    FROM docs WHERE category <> 'GAMES'""",
)
def companies(spark, sf):
    return reviews.companies(standins.documents(spark, sf)).drop("seq")


also("set_union_companies", "prj_companies")


@query(
    "prj_reviews_order",
    """
    SELECT media_id AS media_info_id, rating, "year", "month", "day", reviewer_username,
           association, is_critic,
           CASE category WHEN 'GAMES' THEN 'Platform' WHEN 'TV_SHOWS' THEN 'Season'
                ELSE 'Display' END AS section_type,
           section_name
    FROM order_docs JOIN doc_reviews USING (order_key) WHERE media_info_id = """
    + key("p_partkey"),
)
def review_rows(spark, sf):
    return reviews.review_rows(standins.documents(spark, sf, with_reviews=True)).drop("seq")


@query(
    "set_union_reviews_order",
    """
    SELECT p_partkey, CASE WHEN is_critic THEN 0 ELSE 1 END AS source, section_name,
           rank - 1 AS pos, reviewer_username AS author, rating
    FROM order_docs JOIN doc_reviews USING (order_key) WHERE media_info_id = """
    + key("p_partkey"),
)
def union_reviews(spark, sf):
    flat = reviews.all_reviews(standins.documents(spark, sf, with_reviews=True), "p_partkey")
    return flat.select(
        "p_partkey",
        "source",
        "section_name",
        "pos",
        F.col("review.author").alias("author"),
        F.col("review.rating").alias("rating"),
    )


@query(
    "agg_review_count_order",
    """
    SELECT p_partkey, CAST(count(media_info_id) AS INTEGER) AS reviews
    FROM order_docs d LEFT JOIN doc_reviews r
      ON d.order_key = r.order_key AND media_info_id = """
    + key("p_partkey")
    + " GROUP BY p_partkey, d.order_key",
)
def review_count(spark, sf):
    docs = standins.documents(spark, sf, with_reviews=True)
    return docs.select("p_partkey", reviews.review_count(docs).alias("reviews"))


# The survey's operators: one document per medium with all its reviews. Those above take one per part and order.
@query(
    "prj_reviews",
    """
    SELECT media_id AS media_info_id, rating, "year", "month", "day", reviewer_username,
           association, is_critic,
           CASE category WHEN 'GAMES' THEN 'Platform' WHEN 'TV_SHOWS' THEN 'Season'
                ELSE 'Display' END AS section_type,
           section_name
    FROM docs JOIN media_reviews ON media_info_id = """
    + key("p_partkey"),
)
def media_review_rows(spark, sf):
    return reviews.review_rows(standins.media_documents(spark, sf)).drop("seq")


@query(
    "set_union_reviews",
    """
    SELECT p_partkey, CASE WHEN is_critic THEN 0 ELSE 1 END AS source, section_name,
           rank - 1 AS pos, reviewer_username AS author, rating
    FROM docs JOIN media_reviews ON media_info_id = """
    + key("p_partkey"),
)
def media_union_reviews(spark, sf):
    flat = reviews.all_reviews(standins.media_documents(spark, sf), "p_partkey", "piece")
    return flat.select(
        "p_partkey",
        "source",
        "section_name",
        "pos",
        F.col("review.author").alias("author"),
        F.col("review.rating").alias("rating"),
    )


@query(
    "agg_review_count",
    """
    SELECT p_partkey, count(media_info_id) AS reviews
    FROM docs LEFT JOIN reviews ON media_info_id = """
    + key("p_partkey")
    + " GROUP BY p_partkey",
)
def media_review_count(spark, sf):
    docs = standins.media_documents(spark, sf)
    return docs.groupBy("p_partkey").agg(F.sum(reviews.review_count(docs)).alias("reviews"))


@query("prj_drop_columns", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def drop_columns(spark, sf):
    customers = table(spark, sf, "customer")
    return entities.drop_columns(customers, ["c_nationkey", "c_mktsegment", "_id"])


@query(
    "prj_review_normalise",
    """
    SELECT c_custkey, 0 AS pos,
           CASE WHEN c_acctbal > 0 AND c_mktsegment = 'BUILDING' THEN 'slug-' || c_custkey
                WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS author,
           c_mktsegment AS company, '' AS quote, CAST(c_nationkey AS INTEGER) AS rating,
           '' AS post_date, CAST(NULL AS VARCHAR) AS full_review_src_url,
           c_nationkey > 12 AS spoiler, c_acctbal > 0 AS isCritic
    FROM customer WHERE c_mktsegment <> 'MACHINERY'""",
)
def review_normalise(spark, sf):
    c = table(spark, sf, "customer")
    item = F.struct(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("author"),
        F.col("c_mktsegment").alias("publicationName"),
        F.concat(F.lit("slug-"), F.col("c_custkey").cast("string")).alias("publicationSlug"),
        F.col("c_nationkey").alias("score"),
        F.when(F.col("c_nationkey") > 12, True).alias("spoiler"),
    )
    payload = F.to_json(
        F.struct(
            F.when(F.col("c_mktsegment") == "MACHINERY", "gone").alias("_error"),
            F.array(item).alias("items"),
        )
    )
    replies = c.select("c_custkey", payload.alias("payload"), (F.col("c_acctbal") > 0).alias("crit"))
    return reviews.normalise(replies, "payload", "crit", "c_custkey").select(
        "c_custkey", "pos", "review.*"
    )


@query(
    "agg_distinct_entities",
    f"""
    SELECT {key("event_type", "k")} AS id, arg_min(event_type, event_id) AS event_type,
           arg_min(k, event_id) AS k, arg_min("value", event_id) AS "value"
    FROM (SELECT *, CASE WHEN "value" > 5 THEN upper(props) ELSE props END AS k FROM events)
    GROUP BY 1""",
)
def distinct_entities(spark, sf):
    odd_case = F.when(F.col("value") > 5, F.upper("props")).otherwise(F.col("props"))
    rows = table(spark, sf, "events").withColumn("k", odd_case)
    return entities.distinct_entities(rows, ("event_type", "k"), "event_id", ("value",))


@query("dim_genres", "SELECT id, genre_title FROM genres")
def dim_genres(spark, sf):
    return entities.distinct_entities(
        standins.genre_rows(spark, sf), ("genre_title",), ("seq", "pos")
    )


@query("dim_companies", "SELECT id, company_name, company_role FROM companies")
def dim_companies(spark, sf):
    return entities.distinct_entities(
        standins.company_rows(spark, sf), standins.COMPANY_KEY, "seq"
    )


@query(
    "dim_time",
    f"""SELECT DISTINCT {key('"year"', '"month"', '"day"')} AS id, "year", "month", "day"
    FROM reviews""",
)
def dim_time(spark, sf):
    return entities.distinct_entities(standins.time_rows(spark, sf), standins.TIME_KEY, "seq")


@query(
    "dim_reviewer",
    f"""SELECT DISTINCT {key("reviewer_username", "association")} AS id, reviewer_username,
           association, is_critic FROM reviews""",
)
def dim_reviewer(spark, sf):
    return entities.distinct_entities(
        standins.reviews(spark, sf), standins.REVIEWER_KEY, "seq", ("is_critic",)
    )


@query(
    "dim_section",
    f"""SELECT DISTINCT {key("section_name", "section_type")} AS id, section_name, section_type,
           CASE WHEN section_type = 'Platform'
                THEN lower(trim(regexp_replace(section_name, '[^ ]+$', ''))) END AS section_group
    FROM reviews""",
)
def dim_section(spark, sf):
    sections = entities.distinct_entities(
        standins.section_rows(spark, sf), standins.SECTION_KEY, "seq"
    )
    return cluster_attribute(
        sections,
        "section_name",
        "section_group",
        "section_type",
        blacklist=("Season", "Display"),
    )


@query("dim_roles", "SELECT id, person_name, play_method, role FROM roles")
def dim_roles(spark, sf):
    rows = standins.role_rows(spark, sf)
    return entities.distinct_entities(rows, standins.ROLE_KEY, "seq", ("person_name",)).drop(
        "nconst"
    )


@query(
    "agg_year_set",
    """SELECT DISTINCT CAST(year(o_orderdate) + d AS INTEGER) AS "year"
    FROM orders, (VALUES (-1), (0), (1)) AS w(d)""",
)
def agg_year_set(spark, sf):
    orders = table(spark, sf, "orders").select(F.year("o_orderdate").alias("release_year"))
    return entities.year_set(orders)


@query(
    "agg_fact_dedup",
    """SELECT event_type, user_id, day, arg_min("value", event_id) AS "value",
           min(event_id) AS event_id
    FROM (SELECT *, CAST(ts AS DATE) AS day FROM events) GROUP BY 1, 2, 3""",
)
def fact_dedup(spark, sf):
    rows = table(spark, sf, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("day"), "value", "event_id"
    )
    keys = ("user_id", "event_type", "day")
    return entities.keep_first(rows.withColumn("seq", F.col("event_id")), keys, "seq").drop("seq")


also("win_keep_first", "agg_fact_dedup")


@query(
    "agg_role_dedup",
    """SELECT DISTINCT ref_id, nconst, lower(play_method) AS play_method, role FROM role_rows""",
)
def role_dedup(spark, sf):
    """One credit per line of an order; a buyer's nation is credited again with every order."""
    credits = standins.role_credits(spark, sf)
    principals = credits.select(
        F.col("seq").cast("string").alias("tconst"),
        "nconst",
        F.col("play_method").alias("category"),
        F.concat(F.lit('["'), F.col("role"), F.lit('"]')).alias("characters"),
        F.lit(None).cast("string").alias("job"),
    )
    matches = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("tconst"),
        standins.media_id("p_partkey").alias("media_id"),
    )
    return contributors(principals, matches)


@query("agg_bridge_weight", "SELECT media_id, company_id, weight FROM bridge_company")
def bridge_weight(spark, sf):
    return standins.bridge(standins.company_rows(spark, sf), standins.COMPANY_KEY, "company_id")


also("win_count_share", "agg_bridge_weight")
also("fn_reciprocal", "agg_bridge_weight")


@query(
    "join_fk_remap",
    "SELECT reviewer_id, time_id, section_id, media_info_id, rating FROM fact",
)
def fk_remap(spark, sf):
    return standins.star(spark, sf)["FACT_REVIEWS"]


@query(
    "win_reviews_per_section",
    """SELECT media_info_id, section_name, is_critic, rank, page, reviewer_username AS author
    FROM first_reviews""",
)
def reviews_per_section(spark, sf):
    first = reviews.first_reviews(
        standins.structured_reviews(spark, sf),
        ["media_info_id", "section_name", "is_critic"],
        "seq",
        limit=reviews.REVIEWS_PER_SECTION,
    )
    return first.select(
        "media_info_id", "section_name", "is_critic", "rank", "page",
        F.col("review.author").alias("author"),
    )


@query(
    "limit_per_group",
    """SELECT event_type, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) <= 50""",
)
def limit_group(spark, sf):
    return limit_per_group(
        table(spark, sf, "events").select("event_type", "event_id", "ts"),
        ["event_type"],
        ["ts", "event_id"],
        50,
    ).drop("ts")


@query(
    "set_merge_rows",
    "SELECT c_name AS name, c_nationkey AS nation FROM customer "
    "UNION ALL SELECT s_name, s_nationkey FROM supplier",
)
def merge_rows(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")
    )
    return customers.unionByName(suppliers)


@query(
    "ext_section_reviews_order",
    f"""
    SELECT p_partkey, section_name, is_critic, CAST(count(*) AS INTEGER) AS reviews,
           arg_min(reviewer_username, rank) AS first_author,
           arg_max(reviewer_username, rank) AS last_author
    FROM order_docs JOIN doc_reviews USING (order_key)
    WHERE media_info_id = {key("p_partkey")} GROUP BY 1, 2, 3, order_key""",
)
def section_reviews(spark, sf):
    docs = standins.documents(spark, sf, with_reviews=True)
    maps = [("critic_reviews", True), ("user_reviews", False)]
    parts = [
        docs.select(
            "p_partkey",
            F.explode(field).alias("section_name", "r"),
            F.lit(critic).alias("is_critic"),
        )
        for field, critic in maps
    ]
    return parts[0].unionByName(parts[1]).select(
        "p_partkey",
        "section_name",
        "is_critic",
        F.size("r").alias("reviews"),
        F.element_at("r", 1)["author"].alias("first_author"),
        F.element_at("r", -1)["author"].alias("last_author"),
    )




@query(
    "ext_section_reviews",
    f"""
    SELECT p_partkey, section_name, is_critic, count(*) AS reviews,
           arg_min(reviewer_username, rank) AS first_author,
           arg_max(reviewer_username, rank) AS last_author
    FROM docs JOIN media_reviews ON media_info_id = {key("p_partkey")} GROUP BY 1, 2, 3""",
)
def media_section_reviews(spark, sf):
    docs = standins.media_documents(spark, sf)
    maps = [("critic_reviews", True), ("user_reviews", False)]
    parts = [
        docs.select(
            "p_partkey",
            "piece",
            F.explode(field).alias("section_name", "r"),
            F.lit(critic).alias("is_critic"),
        )
        for field, critic in maps
    ]
    sections = parts[0].unionByName(parts[1])
    return sections.groupBy("p_partkey", "section_name", "is_critic").agg(
        F.sum(F.size("r")).alias("reviews"),
        F.min_by(F.element_at("r", 1)["author"], "piece").alias("first_author"),
        F.max_by(F.element_at("r", -1)["author"], "piece").alias("last_author"),
    )


also("fn_map_items", "ext_section_reviews")
for _name in ("prj_reviews", "set_union_reviews", "agg_review_count", "ext_section_reviews", "fn_map_items"):
    also(f"{_name}_media", _name)


@query(
    "prj_graph_entity",
    """SELECT primary_title AS node_id, 'Media' AS label, media_type, description FROM media""",
)
def graph_entity(spark, sf):
    rows = standins.media(spark, sf).select("primary_title", "media_type", "description", "seq")
    nodes = graph.nodes(rows, "primary_title", "Media")
    return nodes.select(
        F.col("_GRAPH_NODE_ID").alias("node_id"),
        F.col("_GRAPH_NODE_LABEL").alias("label"),
        F.col("attrs")["media_type"].alias("media_type"),
        F.col("attrs")["description"].alias("description"),
    )


_MEDIA_NODES = """
    SELECT 'Media' AS label, primary_title AS node_id, arg_max(media_type, part_key) AS media_type,
           arg_max(description, part_key) AS description, CAST(NULL AS VARCHAR) AS company_role
    FROM media GROUP BY 2"""


def _nodes(spark, sf):
    media = standins.media(spark, sf).select("primary_title", "media_type", "description", "seq")
    return graph.nodes(media, "primary_title", "Media")


def _flat(nodes, *names):
    return nodes.select(
        F.col("_GRAPH_NODE_LABEL").alias("label"),
        F.col("_GRAPH_NODE_ID").alias("node_id"),
        *[F.col("attrs")[n].alias(n) for n in names],
    )


@query(
    "graph_media_nodes",
    f"SELECT label, node_id, media_type, description FROM ({_MEDIA_NODES}) m",
)
def media_nodes(spark, sf):
    return _flat(graph.upsert_nodes(_nodes(spark, sf)), "media_type", "description")


@query(
    "sink_graph_nodes_upsert",
    """
    SELECT label, node_id,
           coalesce(arg_max(media_type, (age, part_key)) FILTER (media_type IS NOT NULL), NULL)
             AS media_type,
           arg_max(description, (age, part_key)) FILTER (description IS NOT NULL) AS description,
           max(origin) AS origin
    FROM (SELECT 'Media' AS label, primary_title AS node_id, 1 AS age, part_key, media_type,
                 description, NULL AS origin FROM media
          UNION ALL
          SELECT DISTINCT 'Media', p_name, 0, 0, 'old', NULL, 'kept' FROM part
          UNION ALL
          SELECT 'Media', c_name, 0, 0, 'old', NULL, 'kept' FROM customer) n
    GROUP BY 1, 2""",
)
def nodes_upsert(spark, sf):
    """New media nodes into existing ones: attributes the new rows lack stay."""
    old_names = (
        table(spark, sf, "part")
        .select(F.col("p_name").alias("name"))
        .distinct()
        .unionByName(table(spark, sf, "customer").select(F.col("c_name").alias("name")))
    )
    existing = old_names.select(
        F.lit("Media").alias("_GRAPH_NODE_LABEL"),
        F.col("name").alias("_GRAPH_NODE_ID"),
        F.create_map(F.lit("media_type"), F.lit("old"), F.lit("origin"), F.lit("kept")).alias("attrs"),
    )
    merged = graph.upsert_nodes(_nodes(spark, sf), existing)
    return _flat(merged, "media_type", "description", "origin")


def _media_refs(spark, sf, rows, keys):
    return entities.entity_refs(rows, keys, "ref_id")


def _links(spark, sf, kind):
    media = standins.media(spark, sf)
    if kind == "genre":
        rows, keys, seq = standins.genre_rows(spark, sf), ("genre_title",), ("seq", "pos")
        targets = entities.distinct_entities(rows, keys, seq)
        name, labels, attrs = "genre_title", ("Media", "has_genre", "Genre"), ()
    elif kind == "company":
        rows, keys = standins.company_rows(spark, sf), standins.COMPANY_KEY
        targets = entities.distinct_entities(rows, keys, "seq")
        name, labels = "company_name", ("Media", "associated_with", "Company")
        attrs = ("company_role",)
    else:
        rows, keys = standins.role_rows(spark, sf), standins.ROLE_KEY
        targets = entities.distinct_entities(rows, keys, "seq", ("person_name",))
        name, labels, attrs = "person_name", ("Media", "has_cast", "Cast"), ("role", "play_method")
    # Links of later entities win; entities are numbered by name, role by role.
    numbered = targets.withColumn("seq", F.crc32(F.col("id")).cast("decimal(38,0)"))
    refs = _media_refs(spark, sf, rows, keys)
    return graph.links(refs, media, numbered, "primary_title", name, labels, attrs), targets, name


def _flat_links(df, attrs_col, *names):
    return df.select(
        F.col("_GRAPH_SRC_NODE_ID").alias("source"),
        F.col("_GRAPH_LINK_LABEL").alias("link"),
        F.col("_GRAPH_TRGT_NODE_ID").alias("target"),
        *[F.col(attrs_col)[n].alias(n) for n in names],
    )


@query(
    "join_link_endpoints",
    """SELECT primary_title AS source, 'associated_with' AS link, company_name AS target,
           company_role
    FROM company_rows JOIN media ON media.id = ref_id""",
)
def link_endpoints(spark, sf):
    links, _, _ = _links(spark, sf, "company")
    return _flat_links(links, "attrs", "company_role")


def _graph_sql(rows, link, target, label, extra=""):
    return f"""
    SELECT 'link' AS kind, primary_title AS source, '{link}' AS label, {target} AS target
    FROM {rows} JOIN media ON media.id = ref_id {extra} GROUP BY 2, 4
    UNION ALL
    SELECT DISTINCT 'node', NULL, '{label}', {target} FROM {rows} {extra}"""


def _graph(spark, sf, kind, label):
    links, targets, name = _links(spark, sf, kind)
    nodes = graph.union_all(
        _nodes(spark, sf),
        graph.nodes(targets.select(name, F.lit(0).alias("seq")), name, label),
    )
    merged = graph.upsert_nodes(nodes)
    final = graph.upsert_links(links, merged)
    as_links = final.select(
        F.lit("link").alias("kind"),
        F.col("_GRAPH_SRC_NODE_ID").alias("source"),
        F.col("_GRAPH_LINK_LABEL").alias("label"),
        F.col("_GRAPH_TRGT_NODE_ID").alias("target"),
    )
    as_nodes = merged.where(F.col("_GRAPH_NODE_LABEL") == label).select(
        F.lit("node").alias("kind"),
        F.lit(None).cast("string").alias("source"),
        F.col("_GRAPH_NODE_LABEL").alias("label"),
        F.col("_GRAPH_NODE_ID").alias("target"),
    )
    return as_links.unionByName(as_nodes)


@query("graph_genre", _graph_sql("genre_rows", "has_genre", "genre_title", "Genre"))
def graph_genre(spark, sf):
    return _graph(spark, sf, "genre", "Genre")


@query("graph_company", _graph_sql("company_rows", "associated_with", "company_name", "Company"))
def graph_company(spark, sf):
    return _graph(spark, sf, "company", "Company")


@query("graph_cast", _graph_sql("role_rows", "has_cast", "person_name", "Cast"))
def graph_cast(spark, sf):
    return _graph(spark, sf, "cast", "Cast")


also("graph_upsert", "graph_company")
also("set_union_graph", "graph_cast")


@query(
    "sink_graph_links_upsert",
    """
    SELECT primary_title AS source, 'associated_with' AS link, company_name AS target,
           company_role
    FROM company_rows JOIN media ON media.id = ref_id
    WHERE company_name IN (SELECT s_name FROM supplier WHERE s_acctbal > 0)
    GROUP BY ALL""",
)
def links_upsert(spark, sf):
    """Companies without a node lose their links."""
    links, _, _ = _links(spark, sf, "company")
    present = table(spark, sf, "supplier").where("s_acctbal > 0").select("s_name", F.lit(0).alias("seq"))
    nodes = graph.union_all(_nodes(spark, sf), graph.nodes(present, "s_name", "Company"))
    final = graph.upsert_links(links, graph.upsert_nodes(nodes))
    return _flat_links(final, graph.ATTRS, "company_role")


@query(
    "sink_graph_stored",
    """
    SELECT 'link' AS kind, primary_title AS source, 'associated_with' AS label, company_name AS target,
           NULL AS media_type
    FROM company_rows JOIN media ON media.id = ref_id GROUP BY 2, 4
    UNION ALL
    SELECT DISTINCT 'node', NULL, 'Company', company_name, NULL FROM company_rows
    UNION ALL
    SELECT 'node', NULL, 'Media', primary_title, arg_max(media_type, part_key) FROM media GROUP BY 4""",
)
def graph_stored(spark, sf):
    """The stored graph after two runs: publishers and every medium first, then developers."""
    root = run_dir(spark, "graph")
    links, targets, name = _links(spark, sf, "company")
    media = _nodes(spark, sf)
    companies = graph.nodes(targets.select(name, "company_role", F.lit(0).alias("seq")), name, "Company")
    for role in ("publisher", "developer"):
        nodes = companies.where(F.col("attrs")["company_role"] == role)
        both = graph.union_all(media, nodes) if role == "publisher" else nodes
        sinks.upsert_graph(spark, both, links.where(F.col("attrs")["company_role"] == role), root)
    stored, kept = sinks.open_graph(spark, root)
    as_nodes = stored.select(
        F.lit("node").alias("kind"),
        F.lit(None).cast("string").alias("source"),
        F.col("_GRAPH_NODE_LABEL").alias("label"),
        F.col("_GRAPH_NODE_ID").alias("target"),
        F.col("attrs")["media_type"].alias("media_type"),
    )
    as_links = kept.select(
        F.lit("link").alias("kind"),
        F.col("_GRAPH_SRC_NODE_ID").alias("source"),
        F.col("_GRAPH_LINK_LABEL").alias("label"),
        F.col("_GRAPH_TRGT_NODE_ID").alias("target"),
        F.lit(None).cast("string").alias("media_type"),
    )
    return as_links.unionByName(as_nodes)


@query(
    "join_endpoint_semi",
    """SELECT c_name AS source, n_name AS target FROM customer JOIN nation
       ON c_nationkey = n_nationkey WHERE n_regionkey > 1 AND c_acctbal > 0""",
)
def endpoint_semi(spark, sf):
    customers, nations = table(spark, sf, "customer"), table(spark, sf, "nation")
    links = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.lit("Buyer").alias("_GRAPH_SRC_LABEL"),
        F.col("c_name").alias("_GRAPH_SRC_NODE_ID"),
        F.lit("lives_in").alias("_GRAPH_LINK_LABEL"),
        F.lit("Nation").alias("_GRAPH_TRGT_LABEL"),
        F.col("n_name").alias("_GRAPH_TRGT_NODE_ID"),
    )
    buyers = customers.where("c_acctbal > 0").select("c_name", F.lit(0).alias("seq"))
    places = nations.where("n_regionkey > 1").select("n_name", F.lit(0).alias("seq"))
    nodes = graph.union_all(
        graph.nodes(buyers, "c_name", "Buyer"), graph.nodes(places, "n_name", "Nation")
    )
    kept = graph.with_both_ends(links, nodes)
    return kept.select(
        F.col("_GRAPH_SRC_NODE_ID").alias("source"), F.col("_GRAPH_TRGT_NODE_ID").alias("target")
    )


@query(
    "fn_date_parts",
    """SELECT "year", "month", "day", count(*) AS n FROM reviews GROUP BY 1, 2, 3
    UNION ALL
    SELECT NULL, NULL, NULL, count(*) FROM reviews""",
)
def fn_date_parts(spark, sf):
    dated = standins.reviews(spark, sf).select("post_date")
    both = dated.unionByName(dated.select(F.lit("").alias("post_date")))
    year, month, day = date_parts(F.col("post_date"))
    return both.groupBy(year.alias("year"), month.alias("month"), day.alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "fn_surrogate_id",
    f"SELECT c_custkey, {key('c_name', 'c_mktsegment')} AS id FROM customer",
)
def fn_surrogate_id(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", surrogate_id("c_name", "c_mktsegment").alias("id")
    )


@query(
    "flt_membership",
    """SELECT doc_id, lang, n_chars FROM documents
    WHERE doc_id IN (SELECT doc_id FROM labels)""",
)
def membership(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return filters.membership(docs, table(spark, sf, "labels"), "doc_id")
