"""Sinks: staging, warehouse publish, delimited and document output."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.operators import graph, quality
from reelhouse.schemas import WAREHOUSE
from reelhouse.session import staged, unbroadcast
from reelhouse.sources import commits


def stage_append(df: DataFrame, stage: str, name: str, rows_per_file: int = 1_000_000) -> None:
    """Append rows to a staging table; a failed write raises."""
    df.write.mode("append").option("maxRecordsPerFile", rows_per_file).parquet(f"{stage}/{name}")


def create_schema(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Empty warehouse tables where none are published yet; returns the current ones."""
    if current_version(spark, root) is None:
        empty = {n: spark.createDataFrame([], t.schema) for n, t in WAREHOUSE.items()}
        publish(spark, empty, root)
    return open_warehouse(spark, root)


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> int:
    """Publish all tables or none, in place of those published before; returns the new version.

    Tables are typed and written to a folder of their own, the integrity checks read them back from there, and only then
    a version names them. A violation raises and leaves the earlier version in place.
    """
    written = _write_tables(spark, tables, root)
    _refuse_broken(spark, root, written)
    entry = {"tables": {name: [path] for name, path in written.items()}}
    # A load of everything is no merge: it takes over what batches are known and replaces the tables.
    return commits.commit(spark, root, lambda before: {"batches": before.get("batches", {}), **entry})


def append(
    spark: SparkSession, tables: Mapping[str, DataFrame], root: str, batch: tuple[str, int] | None = None
) -> int:
    """Add a batch's rows to the published tables, all or none; returns the version that has them.

    A row whose primary key is there already is left out, and so are bridge rows of media that are: a medium is
    loaded once, with the weights of its own document. Only new rows are checked and written, and foreign keys are looked
    up in old and new rows. `batch` is a stream's name and the batch's number: both are recorded with
    the version, so a batch that comes again, after a crash or from a second writer, changes nothing.
    """
    typed = {name: quality.typed_rows(tables[name], contract) for name, contract in WAREHOUSE.items()}

    def make(before: commits.Entry) -> commits.Entry | None:
        done = before.get("batches", {})
        if batch is not None and done.get(batch[0], -1) >= batch[1]:
            return None
        old = {name: _warehouse_table(spark, root, before, name) for name in WAREHOUSE}
        written = _write_tables(spark, typed, root)
        if before.get("tables"):
            written = _only_new(spark, root, written, old)
        _refuse_broken(spark, root, written, old)
        paths = before.get("tables", {})
        made = {"tables": {n: [*paths.get(n, []), path] for n, path in written.items()}, "batches": done}
        if batch is not None:
            made["batches"] = {**done, batch[0]: batch[1]}
        return made

    return commits.commit(spark, root, make)


def _write_tables(spark: SparkSession, tables: Mapping[str, DataFrame], root: str) -> dict[str, str]:
    """Every table in a new folder; returns the folders, relative to the root."""
    name = uuid.uuid4().hex
    for table, contract in WAREHOUSE.items():
        _write_table(quality.typed_rows(tables[table], contract), f"{root}/{name}/{table}")
    return {table: f"{name}/{table}" for table in WAREHOUSE}


def _write_table(rows: DataFrame, path: str) -> None:
    # Ids are hex digits, which zstd halves.
    rows.write.option("compression", "zstd").parquet(path)


def _only_new(
    spark: SparkSession, root: str, written: Mapping[str, str], old: Mapping[str, DataFrame]
) -> dict[str, str]:
    """The written tables without rows that `old` has; tables that have any are written again.

    Rows are looked up by a hash first, in one job, and only those whose hash is there by their keys: what is all
    new shuffles eight bytes a row.
    """
    rows = {n: spark.read.schema(WAREHOUSE[n].schema).parquet(f"{root}/{p}") for n, p in written.items()}
    lookups = {n: [(c.primary_key, old[n].select(*c.primary_key))] for n, c in WAREHOUSE.items()}
    for name in WAREHOUSE:
        if name.startswith("BRIDGE_"):
            media = old["DIM_MEDIA_INFO"].select(F.col("id").alias("media_id"))
            lookups[name].append((("media_id",), media))
    met = [
        known.select(F.xxhash64(*key).alias("_hash"))
        .join(unbroadcast(rows[name].select(F.xxhash64(*key).alias("_hash"))), "_hash", "left_semi")
        .select(F.lit(name).alias("_of"), F.lit(len(key)).alias("_width"), "_hash")
        for name, each in lookups.items()
        for key, known in each
    ]
    again = staged(reduce(DataFrame.unionByName, met), "known")
    # Two lookups per table at most.
    found = {tuple(r) for r in again.select("_of", "_width").distinct().collect()}
    kept = dict(written)
    for name, each in lookups.items():
        fresh = rows[name]
        for key, known in each:
            if (name, len(key)) in found:
                hashes = again.where((F.col("_of") == name) & (F.col("_width") == len(key))).select("_hash")
                seen = known.withColumn("_hash", F.xxhash64(*key)).join(unbroadcast(hashes), "_hash", "left_semi")
                fresh = fresh.join(unbroadcast(seen.drop("_hash")), list(key), "left_anti")
        if fresh is not rows[name]:
            kept[name] = f"{written[name]}-new"
            _write_table(quality.typed_rows(fresh, WAREHOUSE[name]), f"{root}/{kept[name]}")
            commits.remove(spark, f"{root}/{written[name]}")
    return kept


def _refuse_broken(
    spark: SparkSession, root: str, written: Mapping[str, str], known: Mapping[str, DataFrame] | None = None
) -> None:
    fresh = {n: spark.read.schema(WAREHOUSE[n].schema).parquet(f"{root}/{p}") for n, p in written.items()}
    try:
        quality.require_valid(fresh, known)
    except Exception:
        commits.remove(spark, f"{root}/{next(iter(written.values())).split('/')[0]}")
        raise


def current_version(spark: SparkSession, root: str) -> int | None:
    """Number of the newest version; None before the first."""
    return commits.latest(spark, root)[0] or None


def open_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    number, entry = commits.latest(spark, root)
    if not number:
        raise FileNotFoundError(f"nothing published below {root}")
    return {name: _warehouse_table(spark, root, entry, name) for name in WAREHOUSE}


def _warehouse_table(spark: SparkSession, root: str, entry: commits.Entry, name: str) -> DataFrame:
    paths = [f"{root}/{p}" for p in entry.get("tables", {}).get(name, [])]
    schema = WAREHOUSE[name].schema
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


GRAPH_BUCKETS = 64


def upsert_graph(
    spark: SparkSession, nodes: DataFrame, links: DataFrame, root: str, buckets: int = GRAPH_BUCKETS
) -> int:
    """Merge node and link rows into the stored graph; returns the new version.

    Both tables are kept in hash buckets per label, each a folder that the version names. A run reads and
    rewrites the buckets its rows fall in; all others are taken over by name. The number of buckets is
    fixed by the first run. Of two runs at once the later one merges again, into what the other has written.
    """

    def make(before: commits.Entry) -> commits.Entry:
        n = before.get("buckets", buckets)
        name = uuid.uuid4().hex
        fresh = nodes.withColumn(_AT, _bucket(graph.NODE[0], graph.NODE[1:], n))
        old = _graph_rows(spark, root, before, "nodes", _touched(fresh))
        merged = graph.upsert_nodes(fresh.drop(_AT), old)
        made_nodes = {
            **before.get("nodes", {}),
            **_write_buckets(spark, root, f"{name}/nodes", merged, _bucket(graph.NODE[0], graph.NODE[1:], n)),
        }
        entry = {"buckets": n, "nodes": made_nodes, "links": before.get("links", {})}
        # Only nodes in the buckets of the links' ends are read to see whether both ends exist.
        ends = [
            links.select(F.col(a).alias(graph.NODE[0]), F.col(b).alias(graph.NODE[1]))
            for a, b in ((graph.LINK[0], graph.LINK[1]), (graph.LINK[3], graph.LINK[4]))
        ]
        ends = ends[0].unionByName(ends[1]).withColumn(_AT, _bucket(graph.NODE[0], graph.NODE[1:], n))
        at_link = _bucket(graph.LINK[2], [c for c in graph.LINK if c != graph.LINK[2]], n)
        present = graph.with_both_ends(links, _graph_rows(spark, root, entry, "nodes", _touched(ends)))
        old_links = _graph_rows(spark, root, before, "links", _touched(present.withColumn(_AT, at_link)))
        final = graph.merge_attributes(present, graph.LINK, old_links)
        entry["links"] = {
            **entry["links"],
            **_write_buckets(spark, root, f"{name}/links", final, at_link),
        }
        return entry

    return commits.commit(spark, root, make)


_AT = "_bucket"


def _bucket(label: str, ids: Sequence[str], n: int) -> Column:
    """Name of a row's bucket: a hash of its label, and which of the label's `n` buckets it is in."""
    place = F.pmod(F.xxhash64(*ids), F.lit(n))
    return F.concat_ws("-", F.hex(F.xxhash64(label)), place.cast("string"))


def _touched(rows: DataFrame) -> list[str]:
    """Buckets some row falls in: at most as many as there are labels times buckets."""
    return [r[0] for r in rows.select(_AT).distinct().collect()]


def _write_buckets(spark: SparkSession, root: str, folder: str, rows: DataFrame, at: Column) -> dict[str, str]:
    """Write rows by bucket; returns bucket to folder."""
    by_bucket = rows.withColumn(_AT, at)
    by_bucket.repartition(_AT).write.partitionBy(_AT).parquet(f"{root}/{folder}")
    fs, path = commits.hadoop(spark, f"{root}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()]
    return {n.removeprefix(f"{_AT}="): f"{folder}/{n}" for n in names if n.startswith(f"{_AT}=")}


def open_graph(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    number, entry = commits.latest(spark, root)
    if not number:
        raise FileNotFoundError(f"no graph below {root}")
    links = _graph_rows(spark, root, entry, "links")
    return _graph_rows(spark, root, entry, "nodes"), links.withColumnRenamed("attrs", graph.ATTRS)


def _graph_rows(
    spark: SparkSession, root: str, entry: commits.Entry, name: str, only: Sequence[str] | None = None
) -> DataFrame:
    """Stored nodes or links, all or those of the buckets in `only`."""
    columns = graph.NODE if name == "nodes" else graph.LINK
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    schema = schema.add("attrs", T.MapType(T.StringType(), T.StringType()))
    stored = entry.get(name, {})
    paths = [f"{root}/{stored[at]}" for at in (stored if only is None else only) if at in stored]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def csv_pipe(df: DataFrame, path: str, ids: Sequence[str] = ("id",), sep: str = "|") -> None:
    """UTF-8 delimited files with header, id columns first."""
    rest = [c for c in df.columns if c not in set(ids)]
    df.select(*ids, *rest).write.option("sep", sep).option("header", True).option(
        "encoding", "UTF-8"
    ).csv(path)


def json_docs(docs: DataFrame, path: str) -> None:
    """Nested documents, one per line, in a folder per category; nulls stay out.

    Gzipped: the field names of every review are most of the text.
    """
    docs.write.partitionBy("category").option("compression", "gzip").json(path)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows) of every table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows")
        for n, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
