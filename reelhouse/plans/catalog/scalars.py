"""Scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelhouse.functions import clean, keys, text, values
from reelhouse.plans import standins
from reelhouse.plans.catalog.registry import also, key, normalized, query
from reelhouse.plans.catalog.joins import _SPLIT, _older

table = standins.table
NULL = "CAST(NULL AS VARCHAR)"


@query(
    "fn_runtime_minutes",
    """SELECT p_partkey,
       CASE WHEN p_type = 'SMALL' THEN p_size // 10 * 60
            WHEN p_type = 'LARGE' THEN p_size % 10
            WHEN p_type = 'PROMO' THEN NULL
            ELSE p_size // 10 * 60 + p_size % 10 END AS minutes FROM part""",
)
def runtime_minutes(spark, sf):
    h = F.concat(F.floor(F.col("p_size") / 10).cast("string"), F.lit(" h"))
    m = F.concat((F.col("p_size") % 10).cast("string"), F.lit(" m"))
    duration = (
        F.when(F.col("p_type") == "SMALL", h)
        .when(F.col("p_type") == "LARGE", m)
        .when(F.col("p_type") == "PROMO", "\\N")
        .otherwise(F.concat_ws(" ", h, m))
    )
    return table(spark, sf, "part").select(
        "p_partkey", values.runtime_minutes(duration).alias("minutes")
    )


@query(
    "fn_release_year",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL
              ELSE CAST(year(o_orderdate) AS INTEGER) END AS release_year FROM orders""",
)
def release_year(spark, sf):
    date = F.concat(F.lit(" "), F.date_format("o_orderdate", "MMM d, yyyy"), F.lit(" "))
    date = F.when(F.col("o_orderstatus") == "P", "TBA soon").otherwise(date)
    return table(spark, sf, "orders").select(
        "o_orderkey", values.release_year(date).alias("release_year")
    )


@query(
    "fn_int_or_null",
    """SELECT event_id, CASE WHEN regexp_full_match(v, '[+-]?\\d+') THEN TRY_CAST(v AS INTEGER) END AS v
    FROM (SELECT event_id, CASE WHEN "value" < 5 THEN CAST(user_id AS VARCHAR)
                 ELSE event_type END AS v FROM events)""",
)
def int_or_null(spark, sf):
    v = F.when(F.col("value") < 5, F.col("user_id").cast("string")).otherwise(F.col("event_type"))
    return table(spark, sf, "events").select("event_id", values.int_or_null(v).alias("v"))


@query(
    "fn_null_marker",
    "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status FROM orders",
)
def null_marker(spark, sf):
    marked = F.when(F.col("o_orderstatus") == "F", "\\N").otherwise(F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", values.null_marker(marked).alias("status"))


@query(
    "fn_to_numeric_coerce",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN 0 ELSE "value" END AS runtime FROM events""",
)
def to_numeric(spark, sf):
    v = F.when(F.col("event_type") == "view", "n/a").otherwise(F.col("value").cast("string"))
    runtime = F.coalesce(values.numeric_or_null(v), F.lit(0.0))
    return table(spark, sf, "events").select("event_id", runtime.alias("runtime"))


def _brackets(c: str) -> str:
    return f"regexp_replace({c}, '^[\\[\\]]+|[\\[\\]]+$', '', 'g')"


_CHARACTERS = """CASE o_orderstatus WHEN 'F' THEN '["Self - ' || o_orderpriority || '"]'
    WHEN 'O' THEN '["Self"]' ELSE '["' || o_orderpriority || '","It''s"]' END"""


def _characters():
    return (
        F.when(
            F.col("o_orderstatus") == "F",
            F.concat(F.lit('["Self - '), "o_orderpriority", F.lit('"]')),
        )
        .when(F.col("o_orderstatus") == "O", '["Self"]')
        .otherwise(F.concat(F.lit('["'), "o_orderpriority", F.lit('","It\'s"]')))
    )


_CLEAN = f"""nullif(nullif(trim(replace(regexp_replace({_brackets(_CHARACTERS)},
    '["'']', '', 'g'), 'Self -', '')), ''), 'Self')"""


@query("fn_clean_characters", f"SELECT o_orderkey, {_CLEAN} AS characters FROM orders")
def clean_characters(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", clean.clean_characters(_characters()).alias("characters")
    )


@query(
    "fn_clean_job",
    "SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS job FROM orders",
)
def clean_job(spark, sf):
    job = F.when(F.col("o_orderpriority") == "5-LOW", "\\N").otherwise(F.col("o_orderpriority"))
    return table(spark, sf, "orders").select("o_orderkey", clean.clean_job(job).alias("job"))


@query(
    "fn_role",
    f"SELECT o_orderkey, coalesce({_CLEAN}, nullif(o_orderpriority, '5-LOW')) AS role FROM orders",
)
def role(spark, sf):
    job = F.when(F.col("o_orderpriority") == "5-LOW", "\\N").otherwise(F.col("o_orderpriority"))
    return table(spark, sf, "orders").select("o_orderkey", clean.role(_characters(), job).alias("role"))


@query(
    "fn_play_method",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'actor' WHEN 'O' THEN NULL
       ELSE lower(o_orderpriority) END AS play_method FROM orders""",
)
def play_method(spark, sf):
    category = (
        F.when(F.col("o_orderstatus") == "F", " Actress ")
        .when(F.col("o_orderstatus") == "O", "\\N")
        .otherwise(F.col("o_orderpriority"))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", clean.play_method(category).alias("play_method")
    )


@query(
    "fn_clean_play_method_v1",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN NULL
       ELSE o_orderpriority || ', ' || o_orderstatus END AS play_method FROM orders""",
)
def play_method_older(spark, sf):
    raw = F.when(F.col("o_orderstatus") == "O", "\\N").otherwise(
        F.concat(F.lit(' ["'), "o_orderpriority", F.lit('" ,  "'), "o_orderstatus", F.lit('"] '))
    )
    return table(spark, sf, "orders").select(
        "o_orderkey", clean.clean_play_method_older(raw).alias("play_method")
    )


@query(
    "fn_normalize_role_v1",
    """SELECT c_custkey,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'self' WHEN 'FURNITURE' THEN 'actor'
            ELSE lower(c_mktsegment) END AS role,
       CASE c_mktsegment WHEN 'BUILDING' THEN c_name ELSE 'x' END AS play_method FROM customer""",
)
def role_older(spark, sf):
    category = (
        F.when(F.col("c_mktsegment") == "BUILDING", " Self")
        .when(F.col("c_mktsegment") == "FURNITURE", "Actress ")
        .otherwise(F.col("c_mktsegment"))
    )
    named = clean.normalize_role_older(category)
    return table(spark, sf, "customer").select(
        "c_custkey",
        named.alias("role"),
        clean.play_method_of_self_older(named, F.lit("x"), F.col("c_name")).alias("play_method"),
    )


@query(
    "fn_normalize_title",
    f"""SELECT doc_id, len({normalized('"text"')}) AS words,
        md5(array_to_string({normalized('"text"')}, ' ')) AS tokens FROM documents""",
)
def normalize_title(spark, sf):
    tokens = text.normalize_title(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", tokens.alias("t")).select(
        "doc_id", F.size("t").cast("long").alias("words"), F.md5(F.array_join("t", " ")).alias("tokens")
    )


@query(
    "fn_tokenize_title_v1",
    f"""SELECT doc_id, md5(array_to_string(list_sort(list_distinct({_older('"text"')})), ' ')) AS tokens
    FROM documents""",
)
def tokenize_older(spark, sf):
    tokens = text.token_set(text.tokenize_title_older(F.col("text")))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(F.array_join(tokens, " ")).alias("tokens")
    )


_JACCARD = """CASE WHEN len(list_distinct(a)) + len(list_distinct(b)) = 0 THEN 1.0::DOUBLE
    ELSE len(list_intersect(a, b))::DOUBLE /
         (len(list_distinct(a)) + len(list_distinct(b)) - len(list_intersect(a, b))) END"""


def _said(column):
    return rf"list_filter(regexp_split_to_array(lower({column}), '\s+'), lambda x: x <> '')"


_TURNS = f"""SELECT x.conv_id, x.turn, {_said('x."text"')} AS a, {_said('y."text"')} AS b
    FROM conversations x JOIN conversations y ON x.conv_id = y.conv_id AND y.turn = x.turn + 1"""


def _turns(spark, sf):
    """Every turn of a conversation with the next one."""
    said = text.words(F.lower("text"))
    turns = table(spark, sf, "conversations").select("conv_id", "turn", said.alias("a"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("a").alias("b"))
    return turns.join(following, ["conv_id", "turn"])


@query("set_token_jaccard", f"SELECT conv_id, turn, {_JACCARD} AS similarity FROM ({_TURNS}) t")
def token_jaccard(spark, sf):
    return _turns(spark, sf).select("conv_id", "turn", text.jaccard(F.col("a"), F.col("b")).alias("similarity"))


also("fn_jaccard", "set_token_jaccard")


@query(
    "set_token_subset",
    f"""SELECT conv_id, turn, len(a) > 0 AND len(b) > 0
        AND len(list_filter(b, lambda x: NOT list_contains(a, x))) = 0
        AND len(list_filter(a, lambda x: NOT list_contains(b, x))) >= 1 AS is_subset
    FROM ({_TURNS}) t""",
)
def token_subset(spark, sf):
    return _turns(spark, sf).select(
        "conv_id", "turn", text.is_token_subset(F.col("a"), F.col("b")).alias("is_subset")
    )


@query(
    "set_distinct_names",
    r"""SELECT conv_id, turn, len(list_distinct(list_filter(
          regexp_split_to_array("text", '\s+'), lambda x: x <> ''))) AS names FROM conversations""",
)
def distinct_names(spark, sf):
    names = F.array_distinct(text.words(F.col("text")))
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", F.size(names).cast("long").alias("names")
    )


@query(
    "fn_extensive_split",
    f"""SELECT array_to_string({_SPLIT}, '|') AS words, count(*) AS n
    FROM (SELECT c_name || ' ' || c_mktsegment AS sentence FROM customer
          UNION ALL SELECT o_orderpriority FROM orders) s GROUP BY 1""",
)
def extensive_split(spark, sf):
    customers = table(spark, sf, "customer").select(F.concat_ws(" ", "c_name", "c_mktsegment").alias("s"))
    both = customers.unionByName(table(spark, sf, "orders").select(F.col("o_orderpriority").alias("s")))
    split = F.array_join(text.extensive_split(F.col("s")), "|").alias("words")
    return both.groupBy(split).agg(F.count(F.lit(1)).alias("n"))


@query(
    "fn_composite_key",
    """SELECT c_custkey, lower(c_name) || chr(1) || coalesce(lower(nullif(c_mktsegment, 'BUILDING')), chr(2))
       AS k FROM customer""",
)
def composite_key(spark, sf):
    k = keys.composite_key("c_name", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return table(spark, sf, "customer").select("c_custkey", k.alias("k"))


@query(
    "fn_slug_title",
    """SELECT p_partkey, upper(p_name[1]) || substr(split_part(p_name, ' ', 1), 2) || ' '
       || upper(split_part(p_name, ' ', 2)[1]) || substr(split_part(p_name, ' ', 2), 2)
       || ' ' || p_size || 'D' AS title FROM part""",
)
def slug_title(spark, sf):
    slug = F.concat(F.translate("p_name", " ", "-"), F.lit("-"), F.col("p_size").cast("string"), F.lit("d"))
    return table(spark, sf, "part").select("p_partkey", text.slug_to_title(slug).alias("title"))


@query("fn_trim", "SELECT p_partkey, p_name AS name FROM part")
def fn_trim(spark, sf):
    padded = F.concat(F.lit(" \t"), "p_name", F.lit("  "))
    return table(spark, sf, "part").select("p_partkey", text.strip(padded).alias("name"))


@query(
    "fn_score_band",
    """SELECT event_id, CASE WHEN v BETWEEN 0 AND 35 THEN 'red' WHEN v BETWEEN 36 AND 49 THEN 'yellow'
              WHEN v BETWEEN 50 AND 80 THEN 'green' WHEN v BETWEEN 80 AND 100 THEN 'dark-green' END AS band
       FROM (SELECT event_id, CAST(regexp_extract(props, '\\d+') AS INTEGER) + 0.5 AS v FROM events)""",
)
def score_band(spark, sf):
    v = F.get_json_object("props", "$.k").cast("int") + 0.5
    return table(spark, sf, "events").select("event_id", values.score_band(v).alias("band"))


@query(
    "fn_json_decode",
    """SELECT event_id, CAST(regexp_extract(props, '\\d+') AS INTEGER) AS k, 'none' AS other FROM events""",
)
def json_decode(spark, sf):
    props = F.from_json("props", "k int, other string")
    return table(spark, sf, "events").select("event_id", props.alias("p")).select(
        "event_id", "p.k", F.coalesce("p.other", F.lit("none")).alias("other")
    )


also("fn_map_get_default", "fn_json_decode")


@query(
    "fn_json_encode",
    """SELECT c_custkey, '{"name":"' || c_name || '","tags":["' || c_mktsegment || '"]}' AS doc FROM customer""",
)
def json_encode(spark, sf):
    doc = F.to_json(F.struct(F.col("c_name").alias("name"), F.array("c_mktsegment").alias("tags")))
    return table(spark, sf, "customer").select("c_custkey", doc.alias("doc"))


@query(
    "fn_nan_to_null",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN NULL ELSE "value" END AS v FROM events""",
)
def nan_to_null(spark, sf):
    raw = F.when(F.col("event_type") == "view", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf, "events").select("event_id", values.nan_to_null(raw).alias("v"))
