"""Conversation repair, manifest and language model applied to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import conversation_repair, katz, merkle
from reelhouse.llm.common import lower_ascii, table
from reelhouse.session import staged


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text in DuckDB, which has no function for it."""
    return f"""xor(4294967295, list_reduce(
      list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT for c in string_split({text}, '') if c != '']),
      lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                 lambda r, z: xor(r >> 1, 3988292384 * (r & 1)))))"""


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

REPAIR_SQL = f"""
WITH RECURSIVE hit AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")}
           % 20 AS kind
  FROM conversations
), rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit WHERE kind != 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, {_BLANKS}) AS body, left(role, 1) AS initial
  FROM rows
), faulty AS (
  SELECT *, CASE WHEN body = '' THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS follower
  FROM placed
), counted AS (
  SELECT conv_id, count(*) AS n, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (follower IS NOT NULL AND initial || follower NOT IN ('su', 'ua', 'au')) AS illegal,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM faulty GROUP BY conv_id
), ahead AS (
  SELECT conv_id, n + 1 AS i, [0, 6, 3, 0]::BIGINT[] AS c FROM counted
  UNION ALL
  SELECT conv_id, i, [least(b0, 3 + b2, 6 + b3), least(b1, 3 + b2, 6 + b3), least(b2, 3 + b3), least(b3, 3 + b2)]
  FROM (
    SELECT a.conv_id, f.i,
           least(4 + c[1], r + c[3], CASE initial WHEN 's' THEN k + c[2] WHEN 'u' THEN k + c[3] END) AS b0,
           least(4 + c[2], r + c[3], CASE initial WHEN 'u' THEN k + c[3] END) AS b1,
           least(4 + c[3], r + c[4], CASE initial WHEN 'a' THEN k + c[4] END) AS b2,
           least(4 + c[4], r + c[3], CASE initial WHEN 'u' THEN k + c[3] END) AS b3
    FROM ahead a JOIN (
      SELECT conv_id, i, initial,
             CASE fault WHEN '' THEN 0 WHEN 't' THEN 3 END AS k, 3 + CASE fault WHEN '' THEN 0 WHEN 't' THEN 3 END AS r
      FROM faulty) f ON f.conv_id IS NOT DISTINCT FROM a.conv_id AND f.i = a.i - 1)
), known AS (
  SELECT h.conv_id, h.i, h.c, n.c AS after, f.initial, f.role, f.text, f.fault,
         CASE f.fault WHEN '' THEN 0 WHEN 't' THEN 3 END AS k
  FROM ahead h
  LEFT JOIN ahead n ON n.conv_id IS NOT DISTINCT FROM h.conv_id AND n.i = h.i + 1
  LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM h.conv_id AND f.i = h.i
), walk AS (
  SELECT conv_id, 1::BIGINT AS i, 1 AS q, '' AS audit, []::VARCHAR[] AS kept, NULL::VARCHAR AS e FROM counted
  UNION ALL
  SELECT conv_id, CASE WHEN e = 'I' THEN i ELSE i + 1 END,
         CASE WHEN e = 'D' THEN q WHEN e = 'K' AND initial = 's' THEN 2 ELSE after_q END,
         audit || e,
         CASE e WHEN 'D' THEN kept WHEN 'K' THEN list_append(kept, role || ':' || text)
                WHEN 'I' THEN list_append(kept, wanted || ':') ELSE list_append(kept, wanted || ':' || text) END,
         e
  FROM (
    SELECT w.conv_id, w.i, w.q, w.audit, w.kept, x.initial, x.role, x.text,
           CASE WHEN q = 3 THEN 4 ELSE 3 END AS after_q, CASE WHEN q = 3 THEN 'assistant' ELSE 'user' END AS wanted,
           CASE WHEN x.c[q] = 4 + x.after[q] THEN 'D'
                WHEN x.c[q] = 3 + x.c[CASE WHEN q = 3 THEN 4 ELSE 3 END] THEN 'I'
                WHEN x.initial = 's' AND q = 1 AND x.c[q] = k + x.after[2] THEN 'K'
                WHEN x.initial = CASE WHEN q = 3 THEN 'a' ELSE 'u' END
                     AND x.c[q] = k + x.after[CASE WHEN q = 3 THEN 4 ELSE 3 END] THEN 'K'
                WHEN x.after IS NOT NULL THEN 'R' END AS e
    FROM walk w JOIN known x ON x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.i = w.i)
  WHERE e IS NOT NULL
), ended AS (
  SELECT w.conv_id, arg_max(audit, len(audit)) AS audit, arg_max(kept, len(audit)) AS kept
  FROM walk w GROUP BY w.conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank,
       coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
       coalesce(c.illegal, 0) AS illegal, coalesce(a.c[1], 0) AS cost, coalesce(e.audit, '') AS audit,
       sha256(coalesce(array_to_string(e.kept, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ahead a ON a.conv_id IS NOT DISTINCT FROM o.conv_id AND a.i = 1
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _leaf_sql(text: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    parts = ", ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields)
    return f"sha256(concat({parts}))"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

MERKLE_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, source, {_leaf_sql("text")} AS leaf,
         CASE WHEN {crc32_sql("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {_leaf_sql(_LOWER)} ELSE {_leaf_sql("text")} END AS seen,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS p
  FROM documents
), lower_ AS (
  SELECT source, 0 AS level, list(leaf ORDER BY p) AS nodes FROM leaves GROUP BY source
  UNION ALL
  SELECT source, level + 1,
         [sha256(array_to_string(nodes[i * 16 + 1 : i * 16 + 16], '')) for i in range((len(nodes) + 15) // 16)]
  FROM lower_ WHERE len(nodes) > 1
), subroots AS (
  SELECT source, nodes[1] AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s
  FROM lower_ WHERE len(nodes) = 1
), upper_ AS (
  SELECT 0 AS level, list(subroot ORDER BY s) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1,
         [sha256(array_to_string(nodes[i * 16 + 1 : i * 16 + 16], '')) for i in range((len(nodes) + 15) // 16)]
  FROM upper_ WHERE len(nodes) > 1
), steps AS (
  SELECT doc_id, leaf, level, nodes, p // CAST(16 ** level AS BIGINT) AS nth
  FROM leaves l JOIN lower_ t ON t.source IS NOT DISTINCT FROM l.source AND len(nodes) > 1
  UNION ALL
  SELECT doc_id, leaf, 1000 + level, nodes, s // CAST(16 ** level AS BIGINT)
  FROM leaves l JOIN subroots r ON r.source IS NOT DISTINCT FROM l.source, upper_ WHERE len(nodes) > 1
), sides AS (
  SELECT doc_id, leaf, level, array_to_string(nodes[nth - nth % 16 + 1 : nth], '') AS l,
         array_to_string(nodes[nth + 2 : nth - nth % 16 + 16], '') AS r
  FROM steps
), paths AS (
  SELECT doc_id, leaf, string_agg(l || r, '' ORDER BY level) AS proof,
         list({{'l': l, 'r': r}} ORDER BY level) AS path
  FROM sides GROUP BY doc_id, leaf
), folded AS (
  SELECT l.doc_id, l.leaf, r.subroot, (SELECT nodes[1] FROM upper_ WHERE len(nodes) = 1) AS root,
         sha256(coalesce(proof, '')) AS proof_sha256,
         list_reduce(list_prepend({{'l': seen, 'r': ''}}, coalesce(path, [])),
                     lambda a, b: {{'l': sha256(concat(b.l, a.l, b.r)), 'r': ''}}).l AS folded_root
  FROM leaves l JOIN subroots r ON r.source IS NOT DISTINCT FROM l.source
  LEFT JOIN paths t ON t.doc_id IS NOT DISTINCT FROM l.doc_id AND t.leaf = l.leaf
)
SELECT *, folded_root = root AS verified FROM folded
"""


def damaged(rows: DataFrame) -> DataFrame:
    """The query's damage to `conversations`, by a hash of conversation and turn."""
    space = F.lit(" ")
    name = F.concat_ws(
        ":",
        F.coalesce(F.col("conv_id").cast("string"), space),
        F.coalesce(F.col("turn").cast("string"), space),
    )
    kind = F.crc32(name) % 20
    text = F.coalesce("text", space)
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).alias("copies"),
        kind.alias("kind"),
    ).where("kind != 0")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = conversation_repair.facts(damaged(given), copies=F.col("copies"))
    plans = conversation_repair.repair(rows, given.select(F.col("conv_id").alias("conv")))
    return conversation_repair.repaired_digests(rows, staged(plans, "conv-plans")).select(
        F.col("conv").alias("conv_id"),
        "gaps",
        "blank",
        "duplicate",
        "truncated",
        "illegal",
        "cost",
        "audit",
        "repaired_sha256",
    )


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of all documents, held against a copy in which every fifth text is lower-cased."""
    docs = _small_batches(table(spark, sf_dir, "documents"))
    fields = [F.col(f) for f in merkle.FIELDS]
    tampered = merkle.digest([*fields[:-1], lower_ascii(fields[-1])])
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    seen = F.when(hit, tampered).otherwise(merkle.digest(fields))
    return merkle.audit(merkle.build(docs, seen=seen)).withColumnRenamed("key", "doc_id").select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document; a fifth of the ids teaches nothing."""
    docs = _small_batches(table(spark, sf_dir, "documents"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))
    model = katz.learn_and_score(docs, "doc_id", "text", ~held_out)
    return model.scores.withColumnRenamed("key", "doc_id").select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.unigrams.total).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def _small_batches(df: DataFrame) -> DataFrame:
    """Rows that hold a block each go to Python a few at a time."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return df


QUERIES = {"op11_conversation_repair": op11, "op12_merkle_manifest": op12, "op13_katz_backoff": op13}
ORACLES = {"op11_conversation_repair": REPAIR_SQL, "op12_merkle_manifest": MERKLE_SQL}
