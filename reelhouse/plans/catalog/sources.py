"""Scans and sinks: each writes rows of the given tables out and reads them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.operators import quality
from reelhouse.plans import standins, star
from reelhouse.plans.catalog.registry import key, query
from reelhouse.schemas import WAREHOUSE
from reelhouse.session import run_dir
from reelhouse.sources import readers, sinks
from reelhouse.streaming.incremental import (
    ingest_new_files,
    ingest_warehouse,
    ingested,
    newer_than_marks,
    newest,
)

table = standins.table


def _written_docs(spark, sf):
    path = run_dir(spark, "docs")
    sinks.json_docs(
        standins.documents(spark, sf).select(
            "category", "title", "tv_title", "game_title", "media_details",
            "critic_reviews", "user_reviews",
        ),
        path,
    )
    return path


@query(
    "src_category_json",
    """SELECT category, CASE category WHEN 'GAMES' THEN 'Video Game' WHEN 'TV_SHOWS' THEN 'TV Series'
              ELSE 'Movie' END AS media_type,
           CASE category WHEN 'GAMES' THEN 'Platform' WHEN 'TV_SHOWS' THEN 'Season'
              ELSE 'Display' END AS section_type,
           primary_title, p_brand AS summary, 2 AS genres
    FROM docs""",
)
def category_json(spark, sf):
    docs = readers.category_json(spark, _written_docs(spark, sf), multi_line=False)
    from reelhouse.operators.reviews import title

    return docs.select(
        "category",
        "media_type",
        "section_type",
        title(docs).alias("primary_title"),
        F.col("media_details.summary").alias("summary"),
        F.size("media_details.genres").alias("genres"),
    )


@query(
    "sink_json_docs",
    """SELECT category, count(*) AS docs, CAST(sum(length(primary_title)) AS BIGINT) AS letters
    FROM docs GROUP BY 1""",
)
def json_docs(spark, sf):
    written = spark.read.schema(
        "title string, tv_title string, game_title string, category string"
    ).json(_written_docs(spark, sf))
    from reelhouse.operators.reviews import title

    return written.groupBy("category").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.length(title(written))).alias("letters")
    )


@query(
    "src_tsv_gz",
    """SELECT 'tt' || o_orderkey AS tconst, '"' || o_orderpriority || '" x' AS "primaryTitle",
           CASE WHEN o_orderstatus = 'F' THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS "startYear",
           'None' AS "runtimeMinutes"
    FROM orders""",
)
def tsv_gz(spark, sf):
    path = run_dir(spark, "title.basics")
    titles = table(spark, sf, "orders").select(
        F.concat(F.lit("tt"), F.col("o_orderkey").cast("string")).alias("tconst"),
        F.col("o_orderstatus").alias("titleType"),
        F.concat(F.lit('"'), "o_orderpriority", F.lit('" x')).alias("primaryTitle"),
        F.lit("o").alias("originalTitle"),
        F.lit("0").alias("isAdult"),
        F.when(F.col("o_orderstatus") != "F", F.year("o_orderdate").cast("string")).alias("startYear"),
        F.lit("e").alias("endYear"),
        F.lit("None").alias("runtimeMinutes"),
        F.lit("g").alias("genres"),
    )
    (
        titles.write.option("sep", "\t").option("header", True).option("compression", "gzip")
        .option("nullValue", "\\N").option("quote", "").option("escapeQuotes", False).csv(path)
    )
    return readers.tsv(
        spark, path, "title.basics", ["tconst", "primaryTitle", "startYear", "runtimeMinutes"]
    )


@query(
    "src_delimited_filtered",
    """SELECT c_custkey, c_name, c_mktsegment FROM customer
    WHERE c_mktsegment = 'BUILDING' OR (c_mktsegment = 'FURNITURE' AND c_nationkey IN (1, 2))""",
)
def delimited(spark, sf):
    path = run_dir(spark, "customer-csv")
    customers = table(spark, sf, "customer")
    customers.write.option("sep", ";").option("header", True).csv(path)
    groups = [{"c_mktsegment": "BUILDING"}, {"c_mktsegment": ["FURNITURE"], "c_nationkey": {1, 2}}]
    read = readers.delimited(spark, path, customers.schema, drop=["c_acctbal"], groups=groups)
    return read.drop("c_nationkey")


@query(
    "src_multi_table_json",
    """SELECT 'GENRES' AS table_name, genre AS name, count(*) AS n
    FROM part, unnest(string_split(p_name, ' ')) AS u(genre) GROUP BY 2
    UNION ALL SELECT 'COMPANIES', p_brand, count(*) FROM part GROUP BY 2""",
)
def multi_table_json(spark, sf):
    return _table_counts(spark, sf, multi_line=False)


def _table_counts(spark, sf, multi_line):
    path = run_dir(spark, "tables-json")
    genres = F.transform(F.split("p_name", " "), lambda g: F.struct(g.alias("name")))
    companies = F.array(F.struct(F.col("p_brand").alias("name")))
    table(spark, sf, "part").select(
        F.to_json(F.struct(genres.alias("GENRES"), companies.alias("COMPANIES")))
    ).write.text(path)
    named = T.StructType([T.StructField("name", T.StringType())])
    tables = readers.multi_table_json(
        spark, path, {"GENRES": named, "COMPANIES": named}, multi_line=multi_line
    )
    parts = [
        rows.groupBy(F.lit(name).alias("table_name"), "name").agg(F.count(F.lit(1)).alias("n"))
        for name, rows in tables.items()
    ]
    return parts[0].unionByName(parts[1])


@query(
    "src_multi_table_stream",
    """SELECT 'GENRES' AS table_name, genre AS name, count(*) AS n
    FROM part, unnest(string_split(p_name, ' ')) AS u(genre) GROUP BY 2
    UNION ALL SELECT 'COMPANIES', p_brand, count(*) FROM part GROUP BY 2""",
)
def multi_table_stream(spark, sf):
    """The same files in pieces of a row."""
    return _table_counts(spark, sf, multi_line=True)


@query(
    "src_rows",
    """SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'partial' END AS label,
           count(*) AS orders FROM orders GROUP BY 1""",
)
def rows(spark, sf):
    labels = {"F": {"label": "finished"}, "O": {"label": "open"}, "P": {"label": "partial"}}
    known = readers.rows(spark, labels, "label string, status string", id_col="status")
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return counts.join(known, "status").select("label", "orders")


def _staged(spark, sf):
    stage = run_dir(spark, "stage")
    for name, prefix in (("customer", "c"), ("supplier", "s")):
        part = table(spark, sf, name).select(
            F.col(f"{prefix}_name").alias("name"),
            F.col(f"{prefix}_acctbal").alias("balance"),
            F.monotonically_increasing_id().alias("_id"),
        )
        sinks.stage_append(part, stage, "PEOPLE")
    return stage


_PEOPLE = """SELECT c_name AS name, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_name, s_acctbal FROM supplier"""


@query("sink_stage_append", f"SELECT name, balance, 1 AS copies FROM ({_PEOPLE}) p")
def stage_append(spark, sf):
    staged = spark.read.parquet(f"{_staged(spark, sf)}/PEOPLE")
    return staged.groupBy("name", "balance").agg(F.count("_id").cast("int").alias("copies"))


@query("src_staged_table", _PEOPLE)
def staged_table(spark, sf):
    return readers.staged_table(spark, _staged(spark, sf), "PEOPLE")


@query(
    "src_limit_per_category",
    """SELECT category, primary_title FROM docs
    QUALIFY row_number() OVER (PARTITION BY category ORDER BY p_partkey) <= 25""",
)
def limit_per_category(spark, sf):
    docs = standins.documents(spark, sf).select("category", "primary_title", "p_partkey")
    return readers.limit_per_group(docs, ["category"], ["p_partkey"], 25).drop("p_partkey")


@query("src_pages", "SELECT page_id, url, md5(html) AS html FROM pages")
def pages(spark, sf):
    return readers.pages(spark, f"{sf}/pages.parquet").withColumn("html", F.md5("html"))


@query("inc_file_ingest", "SELECT event_id, ts, user_id, event_type, \"value\", props FROM events")
def file_ingest(spark, sf):
    """Two runs over the same folder; the second finds nothing new."""
    target, checkpoint = run_dir(spark, "ingested"), run_dir(spark, "ingest-state")
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    for _ in range(2):
        ingest_new_files(spark, sf, schema, target, checkpoint, glob="events.parquet")
    return ingested(spark, target)


@query(
    "inc_warehouse_publish",
    f"""
    WITH said AS (
      SELECT o.media_id, category, {key("reviewer_username", "association")} AS reviewer_id,
             {key('"year"', '"month"', '"day"')} AS time_id, section_name, reviewer_username, association, "year",
             "month", "day",
             CASE category WHEN 'GAMES' THEN 'Platform' WHEN 'TV_SHOWS' THEN 'Season' ELSE 'Display' END AS section_type
      FROM order_docs o JOIN reviews r ON r.order_key = o.order_key AND r.media_info_id = {key("p_partkey")}),
    made AS (
      SELECT media_id, 'production_companies' AS company_role, p_brand AS company_name FROM order_docs
      WHERE category <> 'GAMES'
      UNION SELECT media_id, 'developer', p_brand FROM order_docs WHERE category = 'GAMES'
      UNION SELECT media_id, 'publisher', unnest([p_brand, p_type]) FROM order_docs WHERE category = 'GAMES'),
    listed AS (SELECT DISTINCT media_id, genre FROM order_docs, unnest(string_split(p_name, ' ')) AS u(genre))
    SELECT 'COMPANIES' AS table_name, count(DISTINCT (company_role, company_name)) AS "rows" FROM made
    UNION ALL SELECT 'GENRES', count(DISTINCT genre) FROM listed
    UNION ALL SELECT 'ROLES', 0
    UNION ALL SELECT 'DIM_MEDIA_INFO', count(DISTINCT media_id) FROM order_docs
    UNION ALL SELECT 'DIM_SECTION', count(DISTINCT (section_name, section_type)) FROM said
    UNION ALL SELECT 'DIM_REVIEWER', count(DISTINCT reviewer_id) FROM said
    UNION ALL SELECT 'DIM_TIME', count(DISTINCT time_id) FROM said
    UNION ALL SELECT 'BRIDGE_MEDIA_ROLE', 0
    UNION ALL SELECT 'BRIDGE_MEDIA_GENRE', count(*) FROM listed
    UNION ALL SELECT 'BRIDGE_MEDIA_COMPANY', count(*) FROM made
    UNION ALL SELECT 'FACT_REVIEWS', count(DISTINCT (media_id, reviewer_id, time_id, section_name)) FROM said""",
)
def warehouse_stream(spark, sf):
    """Documents of the landing folder into the warehouse in several batches, and a second run that finds none."""
    landing = run_dir(spark, "landing")
    docs = standins.documents(spark, sf, with_reviews=True).select(
        "category", "title", "tv_title", "game_title", "media_details", "critic_reviews", "user_reviews"
    )
    sinks.json_docs(docs, landing)
    files = spark.read.format("binaryFile").load(f"{landing}/*/{readers.DOCUMENT_FILES}").select("path").count()
    root, state = run_dir(spark, "streamed"), run_dir(spark, "streamed-state")
    for _ in range(2):
        ingest_warehouse(
            spark, landing, root, state, star.document_tables, multi_line=False, files_per_batch=-(-files // 3)
        )
    return sinks.row_counts(sinks.open_warehouse(spark, root))


@query(
    "inc_listing_mark",
    """
    WITH middle AS (SELECT min(ts) + (max(ts) - min(ts)) / 2 AS half FROM events),
    marks AS (SELECT event_type, max((ts, event_id)) AS mark FROM events, middle WHERE ts <= half GROUP BY 1)
    SELECT e.event_type, e.event_id, e.user_id FROM events e LEFT JOIN marks m USING (event_type)
    WHERE mark IS NULL OR (e.ts, e.event_id) > mark""",
)
def listing_mark(spark, sf):
    """What a listing of events by type has before the newest item of an earlier run."""
    events = table(spark, sf, "events")
    span = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high"))
    middle = F.expr("low + (high - low) / 2").alias("middle")
    place = F.struct("ts", "event_id")
    earlier = events.where(F.col("ts") <= F.lit(span.select(middle).first()[0]))
    marks = newest(earlier, "event_type", "event_id", place)
    return newer_than_marks(events, marks, "event_type", "event_id", place).select("event_type", "event_id", "user_id")


@query("sink_csv_pipe", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_pipe(spark, sf):
    path = run_dir(spark, "supplier-csv")
    suppliers = table(spark, sf, "supplier")
    sinks.csv_pipe(suppliers.select("s_name", "s_acctbal", "s_suppkey", "s_nationkey"), path, ["s_suppkey"])
    return readers.delimited(
        spark, path, "s_suppkey long, s_name string, s_acctbal double, s_nationkey int", "|"
    )


_ROOTS: dict[tuple[str, str], str] = {}

PUBLISHED_COUNTS = f"""
    SELECT 'COMPANIES' AS table_name, count(*) AS "rows" FROM companies
    UNION ALL SELECT 'GENRES', count(*) FROM genres
    UNION ALL SELECT 'ROLES', count(*) FROM roles
    UNION ALL SELECT 'DIM_MEDIA_INFO', count(*) FROM media
    UNION ALL SELECT 'DIM_SECTION', count(DISTINCT (section_name, section_type)) FROM reviews
    UNION ALL SELECT 'DIM_REVIEWER', count(*) FROM customer
    UNION ALL SELECT 'DIM_TIME', count(DISTINCT ("year", "month", "day")) FROM reviews
    UNION ALL SELECT 'BRIDGE_MEDIA_ROLE', count(*) FROM bridge_role
    UNION ALL SELECT 'BRIDGE_MEDIA_GENRE', count(*) FROM bridge_genre
    UNION ALL SELECT 'BRIDGE_MEDIA_COMPANY', count(*) FROM bridge_company
    UNION ALL SELECT 'FACT_REVIEWS', count(*) FROM fact"""


def published_root(spark, sf) -> str:
    """Folder of a published stand-in warehouse; one per application and input."""
    known = (spark.sparkContext.applicationId, sf)
    if known not in _ROOTS:
        root = run_dir(spark, "published")
        sinks.create_schema(spark, root)
        sinks.publish(spark, standins.Staged.of(spark, sf), root)
        _ROOTS[known] = root
    return _ROOTS[known]


@query("sink_warehouse_publish", PUBLISHED_COUNTS)
def warehouse_publish(spark, sf):
    return sinks.row_counts(sinks.open_warehouse(spark, published_root(spark, sf)))


@query(
    "sink_create_schema",
    f"""SELECT c.table_name, CAST(0 AS BIGINT) AS rows_before, c."rows" AS rows_after FROM ({PUBLISHED_COUNTS}) c""",
)
def create_schema(spark, sf):
    """Empty tables first, then the same tables after the publish."""
    empty = sinks.create_schema(spark, run_dir(spark, "schema"))
    before = sinks.row_counts(empty).withColumnRenamed("rows", "rows_before")
    full = sinks.create_schema(spark, published_root(spark, sf))
    after = sinks.row_counts(full).withColumnRenamed("rows", "rows_after")
    return before.join(after, "table_name")


@query(
    "sink_typed_rows",
    f"""SELECT DISTINCT {key('"year"', '"month"', '"day"')} AS id, "year", "month", "day" FROM reviews""",
)
def typed_rows(spark, sf):
    dims = standins.Staged.of(spark, sf)["DIM_TIME"]
    as_text = dims.select("id", *[F.col(c).cast("string").alias(c) for c in ("day", "month", "year")])
    return quality.typed_rows(as_text, WAREHOUSE["DIM_TIME"])
