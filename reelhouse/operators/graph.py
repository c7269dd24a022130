"""Property graph: node and link rows, and their upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODE = ["_GRAPH_NODE_LABEL", "_GRAPH_NODE_ID"]
LINK = [
    "_GRAPH_SRC_LABEL",
    "_GRAPH_SRC_NODE_ID",
    "_GRAPH_LINK_LABEL",
    "_GRAPH_TRGT_LABEL",
    "_GRAPH_TRGT_NODE_ID",
]
ATTRS = "_GRAPH_LINK_ATTRIBUTES"


def attributes(names: Sequence[str]) -> Column:
    """Map of attribute name to text."""
    if not names:
        return F.create_map().cast("map<string,string>")
    pairs = [x for n in names for x in (F.lit(n), F.col(n).cast("string"))]
    return F.create_map(*pairs)


def nodes(
    rows: DataFrame, id_col: str, label: str, seq: str = "seq", drop: Sequence[str] = ()
) -> DataFrame:
    """Rows as nodes: the id column names the node, the rest are its attributes."""
    rest = [c for c in rows.columns if c not in {id_col, seq, *drop}]
    return rows.select(
        F.lit(label).alias(NODE[0]),
        F.col(id_col).cast("string").alias(NODE[1]),
        attributes(rest).alias("attrs"),
        F.col(seq).alias("seq"),
    )


def links(
    refs: DataFrame,
    sources: DataFrame,
    targets: DataFrame,
    source_id: str,
    target_id: str,
    labels: tuple[str, str, str],
    link_attributes: Sequence[str] = (),
) -> DataFrame:
    """Links from (ref, id) pairs: source rows by `id` = ref, target rows by `id` = id.

    `labels` are source label, link label, target label. The link attributes are
    taken from the target row, as is `seq`.
    """
    source_label, link_label, target_label = labels
    src = sources.select(F.col("id").alias("_ref"), F.col(source_id).cast("string").alias("_src"))
    trg = targets.select(
        F.col("id").alias("_entity"),
        F.col(target_id).cast("string").alias("_trg"),
        attributes(link_attributes).alias("attrs"),
        "seq",
    )
    pairs = refs.toDF("_ref", "_entity")
    return (
        pairs.join(trg, "_entity")
        .join(src, "_ref")
        .select(
            F.lit(source_label).alias(LINK[0]),
            F.col("_src").alias(LINK[1]),
            F.lit(link_label).alias(LINK[2]),
            F.lit(target_label).alias(LINK[3]),
            F.col("_trg").alias(LINK[4]),
            "attrs",
            "seq",
        )
    )


def union_all(first: DataFrame, *more: DataFrame) -> DataFrame:
    out = first
    for df in more:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def merge_attributes(rows: DataFrame, key: Sequence[str], existing: DataFrame | None = None) -> DataFrame:
    """One row per key; of every attribute the latest value stays, a null removes it.

    `existing` (key, attrs) counts as older than every row. Equal values collapse
    on the map side before the latest is picked, so a node written a billion times
    is one row per task.
    """
    columns = [*key, F.col("attrs"), F.col("seq").cast("decimal(38,0)").alias("seq")]
    fresh = rows.select(*columns, F.lit(1).alias("_age"))
    if existing is not None:
        old = existing.select(*key, "attrs", F.lit(0).cast("decimal(38,0)").alias("seq"), F.lit(0).alias("_age"))
        fresh = fresh.unionByName(old)
    single = fresh.select(*key, "_age", "seq", F.explode_outer("attrs").alias("_k", "_v"))
    variants = single.groupBy(*key, "_age", "_k", "_v").agg(F.max("seq").alias("seq"))
    latest = variants.groupBy(*key, "_k").agg(
        F.max_by("_v", F.struct("_age", "seq", F.col("_v"))).alias("_v")
    )
    # As many entries per key as there are attribute names.
    entries = F.collect_list(F.when(F.col("_v").isNotNull(), F.struct("_k", "_v")))
    return latest.groupBy(*key).agg(F.map_from_entries(F.array_sort(entries)).alias("attrs"))


def upsert_nodes(rows: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return merge_attributes(rows, NODE, existing)


def with_both_ends(rows: DataFrame, nodes_: DataFrame) -> DataFrame:
    """Links whose two end nodes exist."""
    known = nodes_.select(*NODE)
    source = known.toDF(LINK[0], LINK[1])
    target = known.toDF(LINK[3], LINK[4])
    return rows.join(source, LINK[:2], "left_semi").join(target, LINK[3:], "left_semi")


def upsert_links(
    rows: DataFrame, nodes_: DataFrame, existing: DataFrame | None = None
) -> DataFrame:
    """Links by (source, label, target); latest attributes win, dangling ones are dropped."""
    merged = merge_attributes(with_both_ends(rows, nodes_), LINK, existing)
    return merged.withColumnRenamed("attrs", ATTRS)
