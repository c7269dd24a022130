"""Where queries and their SQL counterparts are kept, and SQL shared by many of them."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without SQL it is only checked for rows here and by tests."""

    def register(plan: Query) -> Query:
        if name in QUERIES:
            raise KeyError(f"{name} is registered twice")
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return plan

    return register


def also(name: str, of: str) -> None:
    """A second name for the same function, listed under another heading."""
    QUERIES[name] = QUERIES[of]
    if of in ORACLES:
        ORACLES[name] = ORACLES[of]


def key(*parts: str) -> str:
    """SQL of the surrogate id."""
    folded = ", ".join(f"coalesce(lower(CAST({p} AS VARCHAR)), chr(2))" for p in parts)
    return f"md5(concat_ws(chr(1), {folded}))"


_CTES = {
    "reviews": f"""
        SELECT l_orderkey * 8 + l_linenumber AS seq, l_suppkey AS tie, l_orderkey AS order_key,
               {key("l_partkey")} AS media_info_id,
               CAST(l_quantity AS INTEGER) AS rating,
               CAST(year(l_shipdate) AS INTEGER) AS "year",
               CAST(month(l_shipdate) AS INTEGER) AS "month",
               CAST(day(l_shipdate) AS INTEGER) AS "day",
               strftime(l_shipdate, '%Y-%m-%d') AS post_date,
               c_name AS reviewer_username, c_mktsegment AS association,
               c_acctbal > 0 AS is_critic,
               CASE l_returnflag WHEN 'A' THEN 'Platform' WHEN 'N' THEN 'Season'
                    ELSE 'Display' END AS section_type,
               substr(o_orderpriority, 3) || ' ' || l_linestatus || '-'
                 || substr(o_orderpriority, 1, 1) AS section_name
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey""",
    "fact": f"""
        SELECT reviewer_id, time_id, section_id, media_info_id, rating, reviewer_username,
               association, is_critic, "year", "month", "day", section_type, section_name
        FROM (SELECT *, {key("reviewer_username", "association")} AS reviewer_id,
                     {key('"year"', '"month"', '"day"')} AS time_id,
                     {key("section_name", "section_type")} AS section_id,
                     row_number() OVER (
                       PARTITION BY media_info_id, reviewer_username, association,
                                    "year", "month", "day", section_name, section_type
                       ORDER BY seq, tie) AS rn
              FROM reviews)
        WHERE rn = 1""",
    "media": f"""
        SELECT {key("p_partkey")} AS id, p_partkey AS part_key, p_type AS media_type,
               p_name AS primary_title, 'Nov 12, ' || (p_size + 1970) AS release_date,
               CAST(p_size AS DOUBLE) AS duration, p_brand AS description
        FROM part""",
    "genre_rows": f"""
        SELECT {key("p_partkey")} AS ref_id, p_partkey AS seq, genre_title
        FROM part, unnest(string_split(p_name, ' ')) AS u(genre_title)""",
    "company_rows": f"""
        SELECT {key("p_partkey")} AS ref_id, p_partkey AS seq, 'developer' AS company_role,
               p_brand AS company_name FROM part
        UNION ALL
        SELECT DISTINCT {key("l_partkey")}, l_partkey, 'publisher', s_name
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "role_rows": f"""
        SELECT DISTINCT {key("l_partkey")} AS ref_id, l_partkey AS seq,
               CAST(n_nationkey AS VARCHAR) AS nconst, n_name AS person_name,
               r_name AS play_method, c_mktsegment AS role
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "bridge_genre": f"""
        SELECT media_id, genre_id, 1.0::DOUBLE / count(*) OVER (PARTITION BY media_id) AS weight
        FROM (SELECT DISTINCT ref_id AS media_id, {key("genre_title")} AS genre_id
              FROM genre_rows)""",
    "bridge_company": f"""
        SELECT media_id, company_id, 1.0::DOUBLE / count(*) OVER (PARTITION BY media_id) AS weight
        FROM (SELECT DISTINCT ref_id AS media_id,
                     {key("company_name", "company_role")} AS company_id FROM company_rows)""",
    "bridge_role": f"""
        SELECT media_id, role_id, 1.0::DOUBLE / count(*) OVER (PARTITION BY media_id) AS weight
        FROM (SELECT DISTINCT ref_id AS media_id,
                     {key("nconst", "play_method", "role")} AS role_id FROM role_rows)""",
    "genres": f"""
        SELECT DISTINCT {key("genre_title")} AS id, genre_title FROM genre_rows""",
    "companies": f"""
        SELECT DISTINCT {key("company_name", "company_role")} AS id, company_role, company_name
        FROM company_rows""",
    "roles": f"""
        SELECT DISTINCT {key("nconst", "play_method", "role")} AS id, person_name,
               play_method, role FROM role_rows""",
    # Sentences of whole texts stand in for titles without a shared key.
    "spoken": r"""
        SELECT role, trim(s) AS sentence
        FROM conversations, unnest(regexp_split_to_array("text", '[.\n]+')) AS u(s)
        WHERE trim(s) <> ''""",
    "wanted": r"""
        SELECT item_id AS id, trim(s) AS sentence
        FROM benchmark, unnest(regexp_split_to_array("text", '[.\n]+')) AS u(s)
        WHERE trim(s) <> ''""",
    "offered": r"""
        SELECT doc_id AS id, trim(s) AS sentence
        FROM documents, unnest(regexp_split_to_array("text", '[.\n]+')) AS u(s)
        WHERE trim(s) <> ''""",
    "docs": f"""
        SELECT {key("category", "primary_title")} AS media_id, *
        FROM (SELECT p_partkey, p_name || ' ' || p_partkey AS primary_title, p_brand, p_size,
                     p_name, p_type,
                     CASE WHEN p_type IN ('STANDARD', 'PROMO') THEN 'GAMES'
                          WHEN p_type IN ('SMALL', 'LARGE') THEN 'TV_SHOWS'
                          ELSE 'MOVIES' END AS category
              FROM part)""",
    "order_docs": f"""
        SELECT {key("category", "primary_title")} AS media_id, *
        FROM (SELECT docs.* EXCLUDE (media_id, primary_title), order_key,
                     primary_title || coalesce(' ' || order_key, '') AS primary_title
              FROM docs LEFT JOIN (SELECT DISTINCT media_info_id, order_key FROM reviews)
                ON media_info_id = {key("p_partkey")})""",
    "doc_reviews": """
        SELECT *, CAST(row_number() OVER (
                    PARTITION BY media_info_id, order_key, section_name, is_critic
                    ORDER BY seq, tie) AS INTEGER) AS rank
        FROM reviews""",
    "media_reviews": """
        SELECT *, CAST(row_number() OVER (
                    PARTITION BY media_info_id, section_name, is_critic
                    ORDER BY seq, tie) AS INTEGER) AS rank
        FROM reviews""",
    "first_reviews": """
        SELECT *, CAST((rank - 1) // 10 AS INTEGER) AS page
        FROM (SELECT *, CAST(row_number() OVER (
                       PARTITION BY media_info_id, section_name, is_critic
                       ORDER BY seq, tie) AS INTEGER) AS rank
              FROM reviews)
        WHERE rank <= 20""",
}


def normalized(c: str) -> str:
    """SQL of the linkage tokens."""
    return (
        r"regexp_extract_all(regexp_replace(regexp_replace(lower(" + c + r"), "
        r"'\b(19|20)\d{2}\b', '', 'g'), '[^\p{L}\p{N}_^\s\p{Z}]', '', 'g'), '[\p{L}\p{N}_]+')"
    )


def with_ctes(sql: str) -> str:
    """Put the shared definitions a statement mentions in front of it."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name in _CTES:
            if name not in needed and re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", text):
                add(_CTES[name])
                if name not in needed:
                    needed.append(name)

    add(sql)
    body = sql.strip()
    if not needed:
        return body
    shared = ",\n".join(f"{n} AS ({_CTES[n]})" for n in needed)
    recursive = body.upper().startswith("WITH RECURSIVE")
    if body.upper().startswith("WITH"):
        rest = re.sub(r"(?i)^WITH(\s+RECURSIVE)?", "", body)
        return f"WITH {'RECURSIVE ' if recursive else ''}{shared},{rest}"
    return f"WITH {shared}\n{body}"
