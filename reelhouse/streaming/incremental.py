"""Incremental ingest: new landing files by Structured Streaming, new items of a listing by a mark."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.session import scratch, staged
from reelhouse.sources import commits, sinks
from reelhouse.sources.readers import DOCUMENT_FILES, category_json_stream

BATCH = "_batch"


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    file_format: str = "parquet",
    glob: str | None = None,
    options: dict[str, str] | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    files_per_batch: int = 1000,
) -> None:
    """Append every file not ingested before to `target`, then stop.

    The checkpoint remembers the files, so a second run over the same folder adds
    nothing. Each micro-batch overwrites a folder of its own: a batch repeated after
    a failure replaces its first attempt.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    reader = reader.option("maxFilesPerTrigger", files_per_batch).options(**(options or {}))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.load(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = transform(batch) if transform else batch
        rows.write.mode("overwrite").parquet(f"{target}/{BATCH}={batch_id}")

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def ingested(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop(BATCH)


def ingest_warehouse(
    spark: SparkSession,
    landing: str,
    root: str,
    checkpoint: str,
    build: Callable[[DataFrame], Mapping[str, DataFrame]],
    stream: str = "documents",
    multi_line: bool = True,
    files_per_batch: int = 1000,
) -> None:
    """Add the documents of every landing file not seen before to the published warehouse, then stop.

    `build` makes the warehouse tables of one batch. The batch's number is committed together with its rows, so a batch
    that Spark repeats after a crash finds itself in the newest version and changes nothing.
    """
    docs = category_json_stream(spark, landing, multi_line, files_per_batch)

    def load(batch: DataFrame, number: int) -> None:
        with scratch(spark):
            sinks.append(spark, build(batch), root, (stream, number))

    query = (
        docs.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


MARKS = "marks"


def newer_than_marks(
    listing: DataFrame, marks: DataFrame, category: str, item: str, place: Column
) -> DataFrame:
    """What a listing has before the first item that is known of its category.

    `marks` is (category, item). A listing goes from the largest `place` of its category down. A category without a mark, or whose
    marked item is gone from the listing, is new as a whole.
    """
    placed = listing.withColumn("_place", place)
    known = placed.join(marks.select(category, item), [category, item], "left_semi")
    # One row per category.
    seen = staged(known.groupBy(category).agg(F.max("_place").alias("_seen")), "marks")
    return (
        placed.join(seen, category, "left")
        .where(F.col("_seen").isNull() | (F.col("_place") > F.col("_seen")))
        .drop("_place", "_seen")
    )


def newest(listing: DataFrame, category: str, item: str, place: Column) -> DataFrame:
    """(category, item): the first item of every category, the next run's marks."""
    return listing.groupBy(category).agg(F.max_by(item, place).alias(item))


def ingest_since_marks(
    spark: SparkSession,
    landing: str,
    root: str,
    read: Callable[[Sequence[str]], DataFrame],
    glob: str = DOCUMENT_FILES,
) -> int:
    """Load the files of every category folder that come, by descending name, before the one loaded last.

    Files are listed but not opened until they are known to be new. Rows and marks are one version of `root`
    (`commits`), so a run that fails has loaded nothing, and a second run reads no old file.
    `read` turns paths into rows. Returns the version.
    """

    def make(before: commits.Entry) -> commits.Entry | None:
        found = spark.read.format("binaryFile").load(f"{landing}/*/{glob}").select("path")
        listing = found.select(
            "path",
            F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("category"),
            F.regexp_extract("path", r"([^/]+)$", 1).alias("item"),
        )
        marks = before.get(MARKS, {})
        # One entry per category folder.
        known = spark.createDataFrame(list(marks.items()), "category string, item string")
        paths = [
            r["path"]
            for r in newer_than_marks(listing, known, "category", "item", F.col("item")).collect()
        ]
        if not paths:
            return None
        folder = f"rows-{len(before.get('folders', [])):06d}-{uuid.uuid4().hex}"
        read(paths).write.parquet(f"{root}/{folder}")
        first = {r["category"]: r["item"] for r in newest(listing, "category", "item", F.col("item")).collect()}
        return {"folders": [*before.get("folders", []), folder], MARKS: {**marks, **first}}

    return commits.commit(spark, root, make)


def loaded(spark: SparkSession, root: str) -> DataFrame:
    """All rows that `ingest_since_marks` has loaded."""
    return spark.read.parquet(*[f"{root}/{f}" for f in commits.latest(spark, root)[1]["folders"]])
