"""Joins over rows of any number leave the driver alone, however small their files look."""

from pyspark.sql import functions as F

from reelhouse.operators import quality
from reelhouse.schemas import WAREHOUSE
from reelhouse.sources import sinks


def media_tables(spark, low, high):
    tables = {n: spark.createDataFrame([], t.schema) for n, t in WAREHOUSE.items()}
    rows = spark.range(low, high).select(F.md5(F.col("id").cast("string")).alias("id"), F.col("id").alias("n"))
    genre = F.md5(F.lit("g"))
    tables["GENRES"] = spark.range(1).select(genre.alias("id"), F.lit("g").alias("genre_title"))
    tables["DIM_MEDIA_INFO"] = rows.select(
        "id", F.lit("Movie").alias("media_type"), F.concat(F.lit("m"), "n").alias("primary_title"),
        F.lit("Nov 12, 1990").alias("release_date"), F.lit("about").alias("description"),
    )
    tables["BRIDGE_MEDIA_GENRE"] = rows.select(
        F.col("id").alias("media_id"), genre.alias("genre_id"), F.lit(1.0).alias("weight")
    )
    return tables


def test_a_publish_broadcasts_no_keys(spark, tmp_path, monkeypatch):
    root, plans, staged, violations = str(tmp_path / "w"), [], sinks.staged, quality.violations

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(sinks, "staged", lambda df, label: staged(seen(df), label))
    monkeypatch.setattr(quality, "violations", lambda *a: seen(violations(*a)))
    sinks.append(spark, media_tables(spark, 0, 50), root)
    sinks.append(spark, media_tables(spark, 30, 70), root)
    assert len(plans) == 3 and not any("Broadcast" in p for p in plans)
    made = sinks.open_warehouse(spark, root)
    assert made["DIM_MEDIA_INFO"].count() == 70 and made["BRIDGE_MEDIA_GENRE"].count() == 70
