"""Linkage, similarity and clustering queries, and the plain joins and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelhouse.functions.text import (
    FRANCHISE_STOPWORDS,
    franchise_tokens,
    normalize_title,
    token_set,
    tokenize_title_older,
)
from reelhouse.operators import clustering, filters, linkage, reviews, roles, setjoin
from reelhouse.operators.components import connected_components
from reelhouse.plans import standins
from reelhouse.plans.catalog.registry import also, normalized, query
from reelhouse.schemas import WAREHOUSE

table = standins.table

# Sentences are compared where their word counts are this close; a count of seven
# stands for an unknown one.
BANDS = (linkage.Band("n_words", 2, (None,)),)
_COUNT = "nullif(len(string_split(sentence, ' ')), 7)"


def _sentences(spark, sf, name, id_col, tokens=normalize_title):
    # A sentence said twice in one text is one row.
    return _named(standins.sentences(spark, sf, name, id_col).distinct(), id_col, tokens)


def _named(rows, id_col, tokens=normalize_title):
    count = F.size(F.split("sentence", " "))
    return rows.select(
        F.concat_ws(":", F.col(id_col).cast("string"), "sentence").alias("key"),
        token_set(tokens(F.col("sentence"))).alias("tokens"),
        F.nullif(count, F.lit(7)).alias("n_words"),
    )


def _linkage(spark, sf, tokens=normalize_title, threshold=0.6):
    left = _sentences(spark, sf, "benchmark", "item_id", tokens)
    right = _sentences(spark, sf, "documents", "doc_id", tokens)
    return _paired(left, right, threshold)


def _paired(left, right, threshold=0.6):
    groups = [linkage.copy_groups(s, "key", "tokens", (), BANDS) for s in (left, right)]
    similar = linkage.similar_groups(*groups, bands=BANDS, threshold=threshold)
    return left, right, groups, linkage.fuzzy_pairs(*groups, similar)


def _older(c: str) -> str:
    """SQL of the older token set."""
    t = rf"regexp_replace(lower({c}), '\b(19|20)\d{{2}}\b', '', 'g')"
    t = rf"regexp_replace({t}, '[\(\[\{{]\s*[\)\]\}}]', '', 'g')"
    t = rf"regexp_replace({t}, '\s*[:;,.\-–—]\s+', '', 'g')"
    split = rf"list_filter(regexp_split_to_array({t}, '\s+'), lambda x: x <> '')"
    return f"list_filter({split}, lambda x: x NOT IN ('the', 'a', 'and', 'as'))"


def _side(rows: str, tokens: str) -> str:
    return f"""SELECT tokens, n_words, count(*) AS n, min(key) AS least_key
        FROM (SELECT id || ':' || sentence AS key, {_COUNT} AS n_words,
                     list_sort(list_distinct({tokens})) AS tokens
              FROM (SELECT DISTINCT id, sentence FROM {rows}))
        GROUP BY 1, 2"""


def _similar(tokens: str, threshold: str) -> str:
    return f"""
    WITH l AS ({_side("wanted", tokens)}), r AS ({_side("offered", tokens)}),
    s AS (SELECT l.tokens AS lt, r.tokens AS rt, l.n_words AS lw, r.n_words AS rw,
                 l.n AS n_a, r.n AS n_b, l.least_key AS key_a, r.least_key AS key_b,
                 len(list_intersect(l.tokens, r.tokens)) AS c
          FROM l JOIN r ON l.n_words IS NULL OR r.n_words IS NULL
                        OR abs(l.n_words - r.n_words) <= 2),
    p AS (SELECT *, CASE WHEN len(lt) + len(rt) = 0 THEN 1.0::DOUBLE
                    ELSE c::DOUBLE / (len(lt) + len(rt) - c) END AS similarity FROM s)
    SELECT * FROM p WHERE similarity >= {threshold}"""


_FUZZY = _similar(normalized("sentence"), "0.6")


@query(
    "join_fuzzy_title",
    _FUZZY.replace("SELECT * FROM p", "SELECT key_a, key_b, n_a, n_b, similarity FROM p"),
)
def fuzzy_title(spark, sf):
    _, _, _, pairs = _linkage(spark, sf)
    return pairs.select("key_a", "key_b", "n_a", "n_b", "similarity")


# Two bands and an exact block at once: a count that is always known and may differ by one, as years do; a length that
# may differ by two or be unknown, as running times are; and the same first letter.
TWO_BANDS = (linkage.Band("year", 1), linkage.Band("runtime", 2, (None, 0)))
LETTER = ("letter",)


def _banded_side(spark, sf, name, id_col):
    rows = standins.sentences(spark, sf, name, id_col).distinct()
    tens = F.floor(F.char_length("sentence") / 10).cast("int")
    return rows.select(
        F.concat_ws(":", F.col(id_col).cast("string"), "sentence").alias("key"),
        token_set(normalize_title(F.col("sentence"))).alias("tokens"),
        F.size(F.split("sentence", " ")).alias("year"),
        F.when(tens % 7 != 3, tens).alias("runtime"),
        F.lower(F.left("sentence", F.lit(1))).alias("letter"),
    )


def _banded(spark, sf):
    left, right = _banded_side(spark, sf, "benchmark", "item_id"), _banded_side(spark, sf, "documents", "doc_id")
    groups = [linkage.copy_groups(s, "key", "tokens", LETTER, TWO_BANDS) for s in (left, right)]
    similar = linkage.similar_groups(*groups, block=LETTER, bands=TWO_BANDS, threshold=0.5)
    return left, linkage.fuzzy_pairs(*groups, similar)


def _banded_rows(rows: str) -> str:
    return f"""SELECT id || ':' || sentence AS key, len(string_split(sentence, ' ')) AS year,
               CASE WHEN length(sentence) // 10 % 7 <> 3 THEN length(sentence) // 10 END AS runtime,
               lower(left(sentence, 1)) AS letter,
               list_sort(list_distinct({normalized("sentence")})) AS tokens
        FROM (SELECT DISTINCT id, sentence FROM {rows})"""


def _banded_groups(rows: str) -> str:
    return f"""SELECT tokens, year, runtime, letter, count(*) AS n, min(key) AS least_key
        FROM ({_banded_rows(rows)}) GROUP BY 1, 2, 3, 4"""


_BANDED = f"""
    WITH l AS ({_banded_groups("wanted")}), r AS ({_banded_groups("offered")}),
    s AS (SELECT l.*, r.tokens AS other, r.n AS n_b, r.least_key AS key_b,
                 len(list_intersect(l.tokens, r.tokens)) AS c
          FROM l JOIN r ON l.letter = r.letter AND abs(l.year - r.year) <= 1
           AND (l.runtime IS NULL OR r.runtime IS NULL OR l.runtime = 0 OR r.runtime = 0
                OR abs(l.runtime - r.runtime) <= 2)),
    p AS (SELECT *, CASE WHEN len(tokens) + len(other) = 0 THEN 1.0::DOUBLE
                    ELSE c::DOUBLE / (len(tokens) + len(other) - c) END AS similarity FROM s)"""


@query(
    "join_runtime_band",
    _BANDED
    + """SELECT least_key AS key_a, key_b, n AS n_a, n_b, similarity FROM p WHERE similarity >= 0.5""",
)
def runtime_band(spark, sf):
    return _banded(spark, sf)[1].select("key_a", "key_b", "n_a", "n_b", "similarity")


@query(
    "join_best_in_bands",
    _BANDED
    + f""",
    best AS (SELECT tokens, year, runtime, letter, max(similarity) AS similarity FROM p
             WHERE similarity >= 0.5 GROUP BY 1, 2, 3, 4),
    pick AS (SELECT p.tokens, p.year, p.runtime, p.letter, p.similarity, min(key_b) AS candidate
             FROM p JOIN best b ON p.tokens = b.tokens AND p.year = b.year AND p.letter = b.letter
              AND p.runtime IS NOT DISTINCT FROM b.runtime AND p.similarity = b.similarity
             GROUP BY 1, 2, 3, 4, 5)
    SELECT key AS target, candidate, similarity
    FROM ({_banded_rows("wanted")}) t JOIN pick k
      ON t.tokens = k.tokens AND t.year = k.year AND t.letter = k.letter
     AND t.runtime IS NOT DISTINCT FROM k.runtime""",
)
def best_in_bands(spark, sf):
    left, pairs = _banded(spark, sf)
    return linkage.best_per_target(pairs, left, "key", linkage.copy_group("tokens", LETTER, TWO_BANDS))


@query(
    "join_best_per_target",
    _similar(_older("sentence"), "0.5").replace(
        "SELECT * FROM p WHERE similarity >= 0.5",
        """, best AS (SELECT lt, lw, max(similarity) AS similarity FROM p
                      WHERE similarity >= 0.5 GROUP BY 1, 2),
        pick AS (SELECT lt, p.lw, similarity, min(key_b) AS candidate
                 FROM p JOIN best USING (lt, similarity)
                 WHERE p.lw IS NOT DISTINCT FROM best.lw GROUP BY 1, 2, 3)
        SELECT id || ':' || sentence AS target, candidate, similarity
        FROM (SELECT DISTINCT id, sentence, """
        + f"{_COUNT} AS n_words, list_sort(list_distinct({_older('sentence')})) AS tokens "
        + """FROM wanted) t
        JOIN pick ON tokens = lt AND n_words IS NOT DISTINCT FROM lw""",
    ),
)
def best_per_target(spark, sf):
    left, _, _, pairs = _linkage(spark, sf, tokenize_title_older, 0.5)
    return linkage.best_per_target(pairs, left, "key", linkage.copy_group("tokens", (), BANDS))


also("win_best_candidate", "join_best_per_target")


def _matches(spark, sf):
    return _assigned(*_linkage(spark, sf))


def _assigned(left, right, _, pairs):
    group = linkage.copy_group("tokens", (), BANDS)
    return linkage.one_to_one(pairs, left, right, "key", group)


# Each round takes the pairs that come first for both their groups of copies, as many rows as
# the smaller side has left, and hands copies out in key order.
_ASSIGNED = (
    _FUZZY.replace("WITH l AS", "WITH RECURSIVE l AS").replace(
        "SELECT * FROM p WHERE similarity >= 0.6",
        """,
    rounds(key_a, key_b, similarity, left_a, left_b, from_a, from_b, taken, at_a, at_b) AS (
      SELECT key_a, key_b, similarity, n_a, n_b, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT
      FROM p WHERE similarity >= 0.6
      UNION ALL
      SELECT key_a, key_b, similarity, left_a - used_a, left_b - used_b, from_a + used_a,
             from_b + used_b, taken, from_a, from_b
      FROM (SELECT *, CAST(sum(taken) OVER (PARTITION BY key_a) AS BIGINT) AS used_a,
                   CAST(sum(taken) OVER (PARTITION BY key_b) AS BIGINT) AS used_b
            FROM (SELECT * REPLACE (CASE WHEN first_a = 1 AND first_b = 1
                                         THEN least(left_a, left_b) ELSE 0 END AS taken)
                  FROM (SELECT *, row_number() OVER (PARTITION BY key_a
                                    ORDER BY similarity DESC, key_a, key_b) AS first_a,
                               row_number() OVER (PARTITION BY key_b
                                    ORDER BY similarity DESC, key_a, key_b) AS first_b
                        FROM rounds WHERE left_a > 0 AND left_b > 0))) AS chosen
    ),
    slots AS (SELECT key_a, key_b, similarity, at_a + i AS rank_a, at_b + i AS rank_b
              FROM (SELECT *, unnest(range(taken)) AS i FROM rounds WHERE taken > 0)),
    matches AS (SELECT a.key AS target, b.key AS candidate, similarity FROM slots
                JOIN (MEMBERS_A) a ON a.least_key = key_a AND a.rank = rank_a
                JOIN (MEMBERS_B) b ON b.least_key = key_b AND b.rank = rank_b)
    """,
    )
)


def _members(rows: str) -> str:
    group = f"PARTITION BY list_sort(list_distinct({normalized('sentence')})), {_COUNT}"
    return f"""SELECT key, min(key) OVER ({group}) AS least_key,
                      row_number() OVER ({group} ORDER BY key) - 1 AS rank
               FROM (SELECT DISTINCT id || ':' || sentence AS key, sentence FROM {rows})"""


_ASSIGNED = _ASSIGNED.replace("MEMBERS_A", _members("wanted")).replace(
    "MEMBERS_B", _members("offered")
)


@query("join_one_to_one_best", _ASSIGNED + "SELECT * FROM matches")
def one_to_one_best(spark, sf):
    return _matches(spark, sf)


@query(
    "agg_match_coverage",
    _ASSIGNED
    + """
    SELECT *, matched::DOUBLE / targets AS coverage
    FROM (SELECT (SELECT count(*) FROM offered) AS scanned,
                 (SELECT count(*) FROM (SELECT DISTINCT id, sentence FROM offered)) AS cleaned,
                 (SELECT count(*) FROM (SELECT DISTINCT id, sentence FROM wanted)) AS targets,
                 (SELECT count(*) FROM matches) AS matched)""",
)
def match_coverage(spark, sf):
    """The linkage from one scan of either side; every count comes from a write the linkage needs anyway."""
    rows, scanned = linkage.counted(standins.sentences(spark, sf, "documents", "doc_id"), "scanned")
    right, cleaned = linkage.counted(_named(rows.distinct(), "doc_id"), "cleaned")
    left, targets = linkage.counted(_sentences(spark, sf, "benchmark", "item_id"), "targets")
    _, matched = linkage.counted(_assigned(*_paired(left, right)), "matched")
    return linkage.match_coverage(spark, scanned, cleaned, targets, matched)


# ---- clustering of sentences within the speaker's role -------------------------------

_STOP = ", ".join(f"'{w}'" for w in FRANCHISE_STOPWORDS)
_WORDS = r"list_filter(regexp_split_to_array(lower(sentence), '\s+'), lambda x: x <> '')"
_SPLIT = f"CASE WHEN len({_WORDS}) = 1 THEN string_split({_WORDS}[1], '-') ELSE {_WORDS} END"
_TOKENS = f"list_filter({_SPLIT}, lambda x: x NOT IN ({_STOP}))"
_NAMES = f"""
    names AS MATERIALIZED (SELECT role, sentence, {_SPLIT} AS words,
                                  list_sort(list_distinct({_TOKENS})) AS tokens FROM spoken),
    sets AS MATERIALIZED (SELECT role, tokens, row_number() OVER (ORDER BY role, tokens) AS id,
                    count(*) AS n FROM names WHERE len(tokens) > 0 GROUP BY role, tokens),
    inv AS MATERIALIZED (SELECT role, id, unnest(tokens) AS t, len(tokens) AS size FROM sets),
    shared AS (SELECT a.id AS a, b.id AS b, a.size + b.size AS total, count(*) AS c
               FROM inv a JOIN inv b ON a.role = b.role AND a.t = b.t AND a.id < b.id
               GROUP BY 1, 2, 3),
    edges AS MATERIALIZED (SELECT a, b, c::DOUBLE / (total - c) AS similarity FROM shared
              WHERE c * THRESHOLD_Q >= (total - c) * THRESHOLD_P)"""


def _names(p: int, q: int) -> str:
    return _NAMES.replace("THRESHOLD_Q", str(q)).replace("THRESHOLD_P", str(p))


# Component of a set: the least id reachable.
_COMPONENTS = """
    sym AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
    reach(a, b) AS (SELECT id, id FROM sets
                    UNION SELECT r.a, e.b FROM reach r JOIN sym e ON r.b = e.a),
    comp AS MATERIALIZED (SELECT a AS id, min(b) AS component FROM reach GROUP BY 1),
    clusters AS (SELECT component, sum(n) AS members FROM comp JOIN sets USING (id)
                 GROUP BY 1 HAVING sum(n) > 1)"""


def _sets(spark, sf):
    spoken = standins.sentences(spark, sf, "conversations", "role")
    named = clustering._named(spoken, "sentence", "role", False).where("size(_tokens) > 0")
    return clustering.token_sets(named)


@query(
    "join_similarity_self",
    f"""WITH {_names(1, 5)}
    SELECT x.role, array_to_string(least(x.tokens, y.tokens), ' ') AS a,
           array_to_string(greatest(x.tokens, y.tokens), ' ') AS b, similarity
    FROM edges JOIN sets x ON x.id = edges.a JOIN sets y ON y.id = edges.b""",
)
def similarity_self(spark, sf):
    """Pairs of distinct token sets of one type with Jaccard ≥ 0.2."""
    sets = _sets(spark, sf)
    side = sets.select(
        F.array("_block").alias("blocks"),
        F.col("_set").alias("id"),
        F.col("_tokens").alias("tokens"),
        F.lit(0).alias("attrs"),
    )
    pairs = setjoin.similar_sets(side, side, 0.2)
    names = sets.select(
        F.col("_set"), F.col("_block").alias("role"), F.array_join("_tokens", " ").alias("name"),
        F.col("_tokens").alias("tokens"),
    )
    x, y = names.alias("x"), names.alias("y")
    return (
        pairs.where("a < b")
        .join(x, F.col("a") == F.col("x._set"))
        .join(y, F.col("b") == F.col("y._set"))
        .select(
            F.col("x.role").alias("role"),
            F.array_join(F.least("x.tokens", "y.tokens"), " ").alias("a"),
            F.array_join(F.greatest("x.tokens", "y.tokens"), " ").alias("b"),
            "similarity",
        )
    )


@query(
    "agg_connected_components",
    f"""WITH RECURSIVE {_names(1, 5)}, {_COMPONENTS}
    SELECT role, array_to_string(tokens, ' ') AS name, size
    FROM sets JOIN comp USING (id) JOIN (
      SELECT component, count(*) AS size FROM comp GROUP BY 1 HAVING count(*) > 1) c
      USING (component)""",
)
def components(spark, sf):
    """Size of the component of every token set that has a similar one."""
    sets = _sets(spark, sf)
    edges = setjoin.linked_sets(
        sets.select(
            F.col("_block").alias("block"), F.col("_set").alias("id"), F.col("_tokens").alias("tokens")
        ),
        0.2,
    )
    found = connected_components(edges)
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return (
        found.join(sizes, "component")
        .join(sets, F.col("node") == F.col("_set"))
        .select(F.col("_block").alias("role"), F.array_join("_tokens", " ").alias("name"), "size")
    )


_LABELS = f"""{_COMPONENTS},
    placed AS MATERIALIZED (SELECT names.*, component, members FROM names
               JOIN sets USING (role, tokens) JOIN comp USING (id)
               JOIN clusters USING (component)),
    at_pos AS (SELECT component, pos, members, count(*) AS n, min(w) AS w, count(DISTINCT w) AS d
               FROM (SELECT component, members, generate_subscripts(words, 1) AS pos,
                            unnest(words) AS w FROM placed) GROUP BY 1, 2, 3),
    broken AS (SELECT component, min(pos) AS pos FROM at_pos WHERE n < members OR d > 1 GROUP BY 1),
    labels AS (SELECT component, string_agg(w, ' ' ORDER BY at_pos.pos) AS label
               FROM at_pos LEFT JOIN broken USING (component)
               WHERE broken.pos IS NULL OR at_pos.pos < broken.pos GROUP BY 1)"""


@query(
    "agg_group_label",
    f"""WITH RECURSIVE {_names(17, 50)}, {_LABELS}
    SELECT CAST(members AS BIGINT) AS members, label FROM clusters LEFT JOIN labels USING (component)""",
)
def group_label(spark, sf):
    spoken = standins.sentences(spark, sf, "conversations", "role")
    members = clustering.cluster_members(spoken, "sentence", "role", 0.34)
    return clustering.cluster_labels(members).select("members", "label")


also("fn_common_prefix", "agg_group_label")


_TITLED = """
    titled AS MATERIALIZED (
      SELECT *, primary_title AS sentence,
             CASE category WHEN 'GAMES' THEN 'Video Game' WHEN 'TV_SHOWS' THEN 'TV Series' ELSE 'Movie' END AS role
      FROM docs)"""


@query(
    "dim_media_info",
    f"""WITH RECURSIVE {_TITLED}, {_names(17, 50).replace("FROM spoken", "FROM titled")}, {_LABELS}
    SELECT media_id AS id, t.role AS media_type, l.label AS franchise, t.sentence AS primary_title,
           'Nov 12, ' || (p_size + 1970) AS release_date,
           CASE WHEN category = 'MOVIES' THEN (p_size // 10 * 60 + p_size % 10)::DOUBLE END AS duration,
           'R' || p_size % 5 AS pegi_mpa_rating, p_brand AS description
    FROM titled t JOIN (SELECT DISTINCT role, sentence, tokens FROM names) n USING (role, sentence)
    LEFT JOIN sets ON sets.role = n.role AND sets.tokens = n.tokens
    LEFT JOIN comp USING (id) LEFT JOIN clusters USING (component)
    LEFT JOIN labels l ON l.component = clusters.component""",
)
def dim_media_info(spark, sf):
    """The whole dimension from documents, franchises by the names media of one type share."""
    media = reviews.media_info(standins.documents(spark, sf)).drop("release_year")
    named = clustering.cluster_attribute(media, "primary_title", "franchise", "media_type", threshold=0.34)
    return named.select(*WAREHOUSE["DIM_MEDIA_INFO"].columns)


also("win_group_broadcast", "dim_media_info")


@query(
    "dim_media_info_sentences",
    f"""WITH RECURSIVE {_names(17, 50)}, {_LABELS}
    SELECT n.role AS media_type, n.sentence AS primary_title, l.label AS franchise
    FROM names n LEFT JOIN sets ON sets.role = n.role AND sets.tokens = n.tokens
    LEFT JOIN comp USING (id) LEFT JOIN clusters USING (component)
    LEFT JOIN labels l ON l.component = clusters.component""",
)
def media_info_sentences(spark, sf):
    spoken = standins.sentences(spark, sf, "conversations", "role").select(
        F.col("role").alias("media_type"), F.col("sentence").alias("primary_title")
    )
    return clustering.cluster_attribute(
        spoken, "primary_title", "franchise", "media_type", threshold=0.34
    )


@query(
    "flt_blacklist_types",
    f"""WITH RECURSIVE {_names(17, 50)}, {_LABELS}
    SELECT n.role AS media_type, n.sentence AS primary_title,
           CASE WHEN n.role = 'user' THEN 'none' ELSE coalesce(l.label, 'none') END AS franchise
    FROM names n LEFT JOIN sets ON sets.role = n.role AND sets.tokens = n.tokens
    LEFT JOIN comp USING (id) LEFT JOIN clusters USING (component)
    LEFT JOIN labels l ON l.component = clusters.component""",
)
def blacklist_types(spark, sf):
    spoken = standins.sentences(spark, sf, "conversations", "role").select(
        F.col("role").alias("media_type"), F.col("sentence").alias("primary_title")
    )
    return clustering.cluster_attribute(
        spoken, "primary_title", "franchise", "media_type", "none", 0.34, blacklist=("user",)
    )


@query(
    "set_token_difference",
    f"""SELECT array_to_string({_TOKENS}, ' ') AS tokens, count(*) AS n FROM spoken GROUP BY 1""",
)
def token_difference(spark, sf):
    spoken = standins.sentences(spark, sf, "conversations")
    tokens = F.array_join(franchise_tokens(F.col("sentence")), " ").alias("tokens")
    return spoken.groupBy(tokens).agg(F.count(F.lit(1)).alias("n"))


also("fn_franchise_tokens", "set_token_difference")


# ---- plain joins and filters -----------------------------------------------------------


@query(
    "join_year_band",
    """
    WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, count(*) AS orders
               FROM orders GROUP BY 1),
    s AS (SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, count(*) AS lines
          FROM lineitem GROUP BY 1)
    SELECT order_year, ship_year, orders, lines FROM o JOIN s
      ON abs(order_year - ship_year) <= 1""",
)
def year_band(spark, sf):
    """Years of orders against years of shipments, one row per pair of years."""
    orders = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("order_year")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    lines = table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("ship_year")).agg(
        F.count(F.lit(1)).alias("lines")
    )
    return linkage.year_band(orders, lines, "order_year", "ship_year").drop("join_year")


@query(
    "flt_runtime_band",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       JOIN part ON l_partkey = p_partkey
       WHERE nullif(p_size, 7) IS NULL OR CAST(l_quantity AS INTEGER) = 0
          OR abs(p_size - CAST(l_quantity AS INTEGER)) <= 2""",
)
def runtime_band(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("runtime"),
    )
    parts = table(spark, sf, "part").select(
        "p_partkey", F.nullif("p_size", F.lit(7)).alias("target_runtime")
    )
    pairs = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return filters.runtime_band(pairs, "target_runtime", "runtime").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"
    )


also("fn_abs_diff_le", "flt_runtime_band")

_PRINCIPALS = """
    SELECT 'tt' || l_partkey AS tconst, 'nm' || o_custkey AS nconst,
           CASE l_returnflag WHEN 'A' THEN ' Actress' WHEN 'N' THEN 'Director' ELSE '\\N' END AS category,
           CASE l_linestatus WHEN 'O' THEN '\\N' ELSE '["' || o_orderpriority || '"]' END AS characters,
           CASE WHEN l_linenumber > 3 THEN '\\N' ELSE 'job ' || l_linenumber END AS job
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

_CONTRIBUTORS = f"""
    SELECT DISTINCT md5('m' || tconst) AS ref_id, nconst,
           CASE category WHEN ' Actress' THEN 'actor' WHEN 'Director' THEN 'director' END
             AS play_method,
           CASE WHEN characters <> '\\N' THEN substr(characters, 3, length(characters) - 4)
                WHEN job <> '\\N' THEN job END AS role
    FROM ({_PRINCIPALS}) p
    WHERE tconst IN (SELECT 'tt' || p_partkey FROM part WHERE p_size > 25)
      AND (characters <> '\\N' OR job <> '\\N')"""


def _principals(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    lines = table(spark, sf, "lineitem")
    marker = F.lit("\\N")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat(F.lit("tt"), F.col("l_partkey").cast("string")).alias("tconst"),
        F.concat(F.lit("nm"), F.col("o_custkey").cast("string")).alias("nconst"),
        F.when(F.col("l_returnflag") == "A", " Actress")
        .when(F.col("l_returnflag") == "N", "Director")
        .otherwise(marker)
        .alias("category"),
        F.when(F.col("l_linestatus") == "O", marker)
        .otherwise(F.concat(F.lit('["'), F.col("o_orderpriority"), F.lit('"]')))
        .alias("characters"),
        F.when(F.col("l_linenumber") > 3, marker)
        .otherwise(F.concat(F.lit("job "), F.col("l_linenumber").cast("string")))
        .alias("job"),
    )


def _catalogue_matches(spark, sf):
    tconst = F.concat(F.lit("tt"), F.col("p_partkey").cast("string"))
    return (
        table(spark, sf, "part")
        .where("p_size > 25")
        .select(tconst.alias("tconst"), F.md5(F.concat(F.lit("m"), tconst)).alias("media_id"))
    )


@query("join_principals", _CONTRIBUTORS)
def principals(spark, sf):
    return roles.contributors(_principals(spark, sf), _catalogue_matches(spark, sf))


@query(
    "join_person_names",
    f"""SELECT DISTINCT person_name, play_method, role
    FROM ({_CONTRIBUTORS}) c
    LEFT JOIN (SELECT 'nm' || c_custkey AS nconst, c_name AS person_name FROM customer
               WHERE c_acctbal > 0) USING (nconst)
    UNION ALL
    SELECT 'unnamed ' || nconst, play_method, role FROM ({_CONTRIBUTORS}) c
    WHERE nconst NOT IN (SELECT 'nm' || c_custkey FROM customer WHERE c_acctbal > 0)
    GROUP BY ALL""".replace("LEFT JOIN", "JOIN"),
)
def person_names(spark, sf):
    names = table(spark, sf, "customer").where("c_acctbal > 0").select(
        F.concat(F.lit("nm"), F.col("c_custkey").cast("string")).alias("nconst"),
        F.col("c_name").alias("primaryName"),
    )
    named, _, unnamed = roles.role_tables(
        _principals(spark, sf), names, _catalogue_matches(spark, sf)
    )
    rejected = unnamed.select(
        F.concat(F.lit("unnamed "), "nconst").alias("person_name"), "play_method", "role"
    )
    return named.drop("id").unionByName(rejected)


@query(
    "flt_catalogue_acceptable",
    """SELECT tconst, "startYear" FROM (
         SELECT o_orderkey AS tconst,
                CASE o_orderstatus WHEN 'F' THEN 'movie' WHEN 'O' THEN 'tvEpisode' ELSE 'tvSeries' END AS t,
                CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(year(o_orderdate) AS INTEGER) END AS "startYear",
                CASE WHEN o_totalprice < 50000 THEN 'X' WHEN o_totalprice < 100000 THEN '   ' ELSE 'Title' END AS title
         FROM orders)
       WHERE t <> 'tvEpisode' AND trim(title) <> '' AND length(title) > 1
         AND "startYear" IN (SELECT p_size + 1970 + d FROM part, (VALUES (-1), (0), (1)) w(d)
                             WHERE p_type = 'SMALL' AND p_size > 27)""",
)
def catalogue_acceptable(spark, sf):
    from reelhouse.operators.entities import year_set

    titles = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("tconst"),
        F.when(F.col("o_orderstatus") == "F", "movie")
        .when(F.col("o_orderstatus") == "O", "tvEpisode")
        .otherwise("tvSeries")
        .alias("titleType"),
        F.when(F.col("o_orderpriority") == "5-LOW", "\\N")
        .otherwise(F.concat(F.lit(" "), F.year("o_orderdate").cast("string")))
        .alias("startYear"),
        F.when(F.col("o_totalprice") < 50000, "X")
        .when(F.col("o_totalprice") < 100000, "   ")
        .otherwise("Title")
        .alias("primaryTitle"),
    )
    media = table(spark, sf, "part").where("p_type = 'SMALL' AND p_size > 27").select(
        (F.col("p_size") + 1970).alias("release_year")
    )
    return filters.catalogue_acceptable(titles, year_set(media)).select("tconst", "startYear")


@query(
    "flt_whitelist_dnf",
    """SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
       WHERE (o_orderstatus IN ('F', 'P') AND o_orderpriority = '2-HIGH')
          OR o_orderpriority IN ('5-LOW')""",
)
def whitelist_dnf(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    groups = [
        {"o_orderstatus": {"F", "P"}, "o_orderpriority": "2-HIGH"},
        {"o_orderpriority": ["5-LOW"]},
        {"no_such_column": ["x"]},
    ]
    return filters.filter_rows(orders, groups)


@query(
    "flt_targets",
    """SELECT id, release_year FROM (
         SELECT media_id AS id, CASE WHEN p_size > 10 THEN CAST(p_size + 1970 AS INTEGER) END AS release_year
         FROM docs WHERE category <> 'GAMES') WHERE release_year IS NOT NULL""",
)
def targets(spark, sf):
    from reelhouse.operators.reviews import media_info

    media = media_info(standins.documents(spark, sf)).withColumn(
        "release_year", F.when(F.col("release_year") > 1980, F.col("release_year"))
    )
    return filters.linkage_targets(media).select("id", "release_year")


@query(
    "flt_dropna_subset",
    "SELECT event_id, \"value\" FROM events WHERE event_type <> 'view'",
)
def dropna_subset(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id", "value", F.nullif("event_type", F.lit("view")).alias("rating")
    )
    return rows.dropna(subset=["rating"]).drop("rating")


@query(
    "flt_row_callback",
    """SELECT event_id, upper(event_type) AS event_type FROM events WHERE "value" > 5""",
)
def row_callback(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "event_type", "value")
    return filters.row_callback(
        rows,
        keep=lambda r: r["value"] > 5,
        convert=lambda r: {"event_id": r["event_id"], "event_type": r["event_type"].upper()},
        schema="event_id long, event_type string",
    )
