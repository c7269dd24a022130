"""Joins with an aggregate split a key that a third of all rows share."""

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import components
from reelhouse.session import joinable

LOW = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def low_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in LOW}
    for k, v in LOW.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hub(spark):
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    return spark.range(60_000).repartition(8).select(key.alias("u"), F.col("id").alias("v"))


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_staged_aggregate_lets_the_join_split(spark, low_thresholds):
    rows = hub(spark)
    least = rows.groupBy("u").agg(F.min("v").alias("m"))
    assert "skew=true" not in executed(rows.join(least, "u"))
    assert "skew=true" in executed(rows.join(joinable(least), "u"))


def test_the_star_step_splits_a_hub(spark, low_thresholds, monkeypatch):
    plans, cut = [], components.cut_lineage

    def seen(df):
        plans.append(executed(df))
        return cut(df)

    monkeypatch.setattr(components, "cut_lineage", seen)
    # A third of all edges meet in node 0, the others are pairs; hashed ids keep the files from shrinking.
    node = F.xxhash64("id").bitwiseAND(F.lit((1 << 62) - 1)) + 2
    mate = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(node - 1)
    edges = spark.range(300_000).repartition(16).select(node.alias("u"), mate.alias("v"))
    found = components.connected_components(edges, "u", "v")
    assert any("skew=true" in p for p in plans)
    assert found.where("component = 0").count() == 100_001
