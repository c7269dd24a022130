"""What the corpus operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelhouse.session import configure, staged

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; Arrow batches are kept small, since a text may be long."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str | Column) -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else. Pure ASCII takes the faster function."""
    ascii_only = F.char_length(text) == F.octet_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def sha256_hex(text: Column) -> Column:
    """Lower-case hex SHA-256 of a text's UTF-8 bytes."""
    return F.sha2(F.encode(text, "UTF-8"), 256)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """`df` with `name`: the 0-based rank of every row by `order`, nulls first.

    Rows are range-partitioned, so no key is ever one task's work; rows equal in all of `order` stay
    together and are told apart by where they stood. A task's share starts where the shares before it end.
    """
    ranged = staged(
        df.repartitionByRange(*map(F.col, order))
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "numbered",
    )
    part = F.shiftright("_at", 33)  # the id's upper bits are the task, its lower 33 the row
    shares = ranged.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the exchange above.
    offsets = shares.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        ranged.join(F.broadcast(offsets), part == F.col("_part"))
        .withColumn(name, F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + F.col("_offset"))
        .drop("_at", "_part", "_offset")
    )
