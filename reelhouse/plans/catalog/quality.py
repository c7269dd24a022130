"""Integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.operators import quality
from reelhouse.plans import standins
from reelhouse.plans.catalog.registry import query
from reelhouse.plans.catalog.sources import PUBLISHED_COUNTS, published_root
from reelhouse.sources import sinks

table = standins.table


@query(
    "dq_pk_unique",
    """SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS "rows" FROM events
    GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def pk_unique(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", F.to_date("ts").alias("day"))
    return quality.duplicate_keys(rows, ["user_id", "event_type", "day"])


@query(
    "dq_not_null",
    "SELECT event_id FROM events WHERE event_type = 'view' OR user_id = 7",
)
def not_null(spark, sf):
    rows = table(spark, sf, "events").select(
        "event_id",
        F.nullif("event_type", F.lit("view")).alias("event_type"),
        F.nullif("user_id", F.lit(7)).alias("user_id"),
    )
    return quality.null_violations(rows, ["event_id", "event_type", "user_id"]).select("event_id")


@query(
    "dq_fk",
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def fk(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return quality.orphans(docs, "doc_id", table(spark, sf, "labels"), key="doc_id")


@query(
    "dq_type_cast",
    """SELECT 'v' AS column_name, event_type AS "value", count(*) AS "rows" FROM events
    WHERE event_type IN ('view', 'click') GROUP BY 2
    UNION ALL SELECT 'flag', event_type, count(*) FROM events GROUP BY 2""",
)
def type_cast(spark, sf):
    text = F.when(F.col("event_type").isin("view", "click"), F.col("event_type"))
    rows = table(spark, sf, "events").select(
        F.coalesce(text, F.col("user_id").cast("string")).alias("v"), F.col("event_type").alias("flag")
    )
    return quality.cast_rejects(rows, {"v": T.IntegerType(), "flag": T.BooleanType()})


@query("dq_all_or_nothing", PUBLISHED_COUNTS)
def all_or_nothing(spark, sf):
    """A publish with nulls in a required column is refused; the earlier one stays."""
    root = published_root(spark, sf)
    good = standins.Staged.of(spark, sf)
    genres = good["GENRES"].withColumn("genre_title", F.nullif("genre_title", F.lit("widget")))
    try:
        sinks.publish(spark, {**good, "GENRES": genres}, root)
    except quality.IntegrityError:
        return sinks.row_counts(sinks.open_warehouse(spark, root))
    raise AssertionError("a broken publish was accepted")
