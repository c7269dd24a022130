"""Scans. Every source has a declared schema; nothing is inferred."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from reelhouse.operators.filters import filter_rows
from reelhouse.schemas import CATALOGUE, DOCUMENT
from reelhouse.sources import table_json

# Landing folder of a category, what its media are and what their
# review sections are. Any other folder holds movies.
CATEGORIES = {
    "GAMES": ("Video Game", "Platform"),
    "TV_SHOWS": ("TV Series", "Season"),
}
OTHER_CATEGORY = ("Movie", "Display")

CORRUPT = "_corrupt_record"

# Documents, plain or as `sinks.json_docs` writes them.
DOCUMENT_FILES = "*.{json,json.gz}"


def spread(df: DataFrame) -> DataFrame:
    """Redistribute a scan that has fewer tasks than the session has cores.

    A gzip file or a file of one row group is read by a single task. Inputs that
    already split widely enough are returned untouched, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def category_columns(category: Column) -> tuple[Column, Column]:
    """(media_type, section_type) of a landing folder."""
    media = section = None
    for name, (kind, part) in CATEGORIES.items():
        hit = category == name
        media = F.when(hit, kind) if media is None else media.when(hit, kind)
        section = F.when(hit, part) if section is None else section.when(hit, part)
    return media.otherwise(OTHER_CATEGORY[0]), section.otherwise(OTHER_CATEGORY[1])


def category_json(spark: SparkSession, root: str, multi_line: bool = True) -> DataFrame:
    """Landing folder of category folders of JSON documents.

    `multi_line` reads one document per file; without it files may hold one
    document per line and split. Files directly below the root are skipped, and so
    are files of another ending. A document that does not parse keeps its text in
    `_corrupt_record`.
    """
    return _documents(spark.read, root, multi_line)


def category_json_stream(
    spark: SparkSession, root: str, multi_line: bool = True, files_per_batch: int = 1000
) -> DataFrame:
    """`category_json` as a stream of the files that are new since the last run."""
    return _documents(spark.readStream.option("maxFilesPerTrigger", files_per_batch), root, multi_line)


def _documents(reader: DataFrameReader | DataStreamReader, root: str, multi_line: bool) -> DataFrame:
    schema = T.StructType([*DOCUMENT.fields, T.StructField(CORRUPT, T.StringType())])
    docs = (
        reader.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(f"{root}/*/{DOCUMENT_FILES}")
        .withColumn("path", F.col("_metadata.file_path"))
    )
    folder = F.regexp_extract("path", r"([^/]+)/[^/]+$", 1)
    category = F.regexp_replace(folder, "^category=", "")
    media_type, section_type = category_columns(F.col("category"))
    return docs.withColumn("category", category).select(
        "*", media_type.alias("media_type"), section_type.alias("section_type")
    )


def tsv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    columns: Sequence[str],
    wide: bool = True,
) -> DataFrame:
    r"""Tab-separated catalogue file, gzipped or not; all text, `\N` is null.

    Quotes are ordinary characters. gzip cannot be split, so the pruned rows are
    spread over the cluster right after the scan (`wide`).
    """
    declared = CATALOGUE[schema] if isinstance(schema, str) else schema
    rows = (
        spark.read.schema(declared)
        .option("sep", "\t")
        .option("header", True)
        .option("nullValue", "\\N")
        .option("quote", "")
        .option("escape", "")
        .option("enforceSchema", True)
        .csv(path)
        .select(*columns)
    )
    return spread(rows) if wide else rows


def delimited(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    delimiter: str = ";",
    drop: Sequence[str] | None = None,
    groups: Sequence[Mapping[str, object]] | None = None,
) -> DataFrame:
    """Delimited file with header; column drop and row whitelist apply in the scan."""
    rows = spark.read.schema(schema).option("sep", delimiter).option("header", True).csv(path)
    return filter_rows(rows, groups, drop)


def multi_table_json(
    spark: SparkSession, path: str, tables: Mapping[str, T.StructType], multi_line: bool = True
) -> dict[str, DataFrame]:
    """One `{table: [rows]}` object per file; one DataFrame per table.

    A file is read in pieces of one row at most (`table_json`), so it may be larger than a task's memory. Without
    `multi_line` every line is an object and is read as one.
    """
    if multi_line:
        return table_json.tables(spark, path, tables)
    schema = T.StructType([T.StructField(n, T.ArrayType(s)) for n, s in tables.items()])
    objects = spark.read.schema(schema).json(path)
    return split_tables(objects, list(tables))


def split_tables(objects: DataFrame, tables: Sequence[str]) -> dict[str, DataFrame]:
    """Rows of every array-of-struct column as a table of its own."""
    return {t: objects.select(F.inline(F.col(t))) for t in tables}


def rows(
    spark: SparkSession,
    data: Iterable[Mapping] | Mapping[str, Mapping],
    schema: T.StructType | str,
    id_col: str | None = None,
) -> DataFrame:
    """In-memory rows: a list of dicts, or `{id: row}` with the id injected as a column."""
    if isinstance(data, Mapping):
        data = [{**row, id_col: key} if id_col else dict(row) for key, row in data.items()]
    data = [dict(row) for row in data]
    if not data:
        raise ValueError("no rows to load")
    return spark.createDataFrame(data, schema)


def staged_table(spark: SparkSession, stage: str, name: str, internal: str = "_id") -> DataFrame:
    """A staged table without its internal id; batches are Spark's partitions."""
    return spark.read.parquet(f"{stage}/{name}").drop(internal)


def limit_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column | str], n: int
) -> DataFrame:
    """First n rows per group in the given order.

    Spark cuts every task's share of a group to n before the shuffle, so a hot
    group costs n rows per task.
    """
    rank = F.row_number().over(W.partitionBy(*group).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def pages(spark: SparkSession, path: str) -> DataFrame:
    """Raw pages (page_id, url, html), the offline form of page fetches."""
    return spread(spark.read.parquet(path).select("page_id", "url", "html"))
