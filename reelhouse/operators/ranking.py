"""Row numbers within groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.session import cut_lineage


def rank_within(df: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """0-based rank of every row in its group by `order`, which is unique.

    Rows are range-partitioned on (group, order), so a group too big for one task
    spans several; each task numbers its own share and adds how many rows of the
    group the tasks before it hold.
    """
    ranged = cut_lineage(
        df.repartitionByRange(F.col(group), F.col(order)).withColumn("_part", F.spark_partition_id())
    )
    share = ranged.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    # One row per (group, task): at most as many per group as there are tasks.
    earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = share.select(
        group, "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    )
    local = F.row_number().over(W.partitionBy(group, "_part").orderBy(order)) - 1
    return (
        ranged.withColumn("_local", local)
        .join(offsets, [group, "_part"])
        .withColumn(name, F.col("_local") + F.col("_offset"))
        .drop("_part", "_local", "_offset")
    )
