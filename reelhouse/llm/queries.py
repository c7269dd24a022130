"""The corpus operators applied to the given tables, under the names the driver knows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import (
    compression_quality,
    decontamination,
    mixing,
    personal_data,
    repeats,
    simhash_trie,
    structure_queries,
    syncmers,
    token_file,
    url_filter,
    warc,
)
from reelhouse.llm.common import sha256_hex, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = dict(structure_queries.QUERIES)
ORACLES: dict[str, str] = dict(structure_queries.ORACLES)


def query(name: str, sql: str | None = None):
    """Register a query; one that SQL cannot express has none and is tested by brute force."""

    def register(plan):
        QUERIES[name] = plan
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register


@query("op1_syncmers")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are."""
    pairs = syncmers.edited_pairs(table(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        sha256_hex(F.col("edited")).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        syncmers.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        syncmers.likeness("fingerprint", "next_fingerprint").alias("near_next"),
    )


URL_RULES = [
    url_filter.parse_rule("net/", "block"),
    url_filter.parse_rule("example.net/en/", "allow"),
    url_filter.parse_rule("example.com/de/", "block"),
    url_filter.parse_rule("org/fr/", "allow"),
]


@query("op2_url_filter")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's url; the labelled table is what the rules decide."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    model = url_filter.fit(url_filter.rule_labelled(pages, URL_RULES))
    return url_filter.judge(pages, URL_RULES, model).select(
        "page_id", "host", "path", "rule", "verdict"
    )


@query(
    "op3_decontamination",
    r"""
    WITH texts AS (
      SELECT 'd' AS kind, doc_id AS id, text FROM documents
      UNION ALL SELECT 'b', item_id, text FROM benchmark
    ), words AS (
      SELECT kind, id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM texts
    ), item_windows AS (
      SELECT DISTINCT id AS item_id, least(13, len(w)) AS m,
             list_slice(w, i, i + least(13, len(w)) - 1) AS run
      FROM (SELECT id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
            FROM words WHERE kind = 'b' AND len(w) > 0)
    ), lengths AS (SELECT DISTINCT m FROM item_windows),
    doc_runs AS (
      SELECT id AS doc_id, m, i, list_slice(w, i, i + m - 1) AS run
      FROM (SELECT id, w, m, unnest(range(1, len(w) - m + 2)) AS i
            FROM words JOIN lengths ON len(w) >= m WHERE kind = 'd')
    ), hits AS (
      SELECT doc_id, item_id, d.m, i FROM doc_runs d JOIN item_windows b USING (run)
    ), covered AS (
      SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id
    ), listed AS (
      SELECT doc_id, count(*) AS n_items,
             string_agg(item_id, ',' ORDER BY item_id) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hits) GROUP BY doc_id
    )
    SELECT id AS doc_id, CAST(len(w) AS BIGINT) AS n_words,
           CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
    FROM words LEFT JOIN covered ON id = covered.doc_id LEFT JOIN listed ON id = listed.doc_id
    WHERE kind = 'd'
    """,
)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that stand in a window of a benchmark item."""
    return decontamination.digests(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query("op4_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.decide(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


@query("op5_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every document, by rule and with those the trees add."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.find(docs, personal_data.fit(docs))
    return found.select(
        "doc_id",
        *(F.size(f"base_{k}").cast("long").alias(f"n_{k}") for k in personal_data.KINDS),
        sha256_hex(personal_data.listed("base")).alias("base_sha256"),
        personal_data.listed("all").alias("spans"),
    )


@query("op6_repeats")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps once all bytes in repeated strings of 400 are gone."""
    return repeats.cut_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        "kept_sha256",
        (F.col("n_removed") > 0).alias("repeats"),
    )


@query(
    "op7_warc",
    """
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END
             AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
    FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                 sha256(coalesce(html, '')) AS payload_digest,
                 min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
          FROM pages)
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as it reads back from the deduplicated archive."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op8_simhash_trie")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents by fingerprints that differ in two bits at most."""
    return simhash_trie.near_duplicates(table(spark, sf_dir, "documents"))


@query("op9_compression_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; rows whose id hashes to 1 modulo 3 are held out."""
    docs = table(spark, sf_dir, "documents")
    model = compression_quality.fit(docs, table(spark, sf_dir, "labels"))
    scored = docs.select(
        "doc_id",
        compression_quality.held_out("doc_id").alias("held_out"),
        model.score("text").alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@query("op10_token_file")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it reads back from the token file."""
    return token_file.round_trip(table(spark, sf_dir, "documents"), TOKENIZER)
