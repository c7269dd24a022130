r"""Files that hold one JSON object `{table: [rows]}`, read as a stream of pieces instead of as one value.

Spark's text reader cuts a file of any size behind every closing brace, in as many tasks as it has splits. Whether a
piece begins inside a string follows from how many quotes come before it, and how deep it lies from the brackets outside
strings, so both are running sums: within a split in order, and over the splits' totals. A piece that ends two levels deep
closes a row. A flat row is one piece; the pieces of a row with nested objects are put together again, and no
value is ever larger than one row of a table.

Rows are objects; an array element of another kind is passed over. Files have to be valid JSON in UTF-8, and a table's
name has no closing brace.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.session import staged

_SPLIT = ["path", "split"]
_STRING = r'"(?:[^"\\]|\\.)*"'
# What may stand before a row: the object's own brace, ends and names of tables, commas.
_BEFORE_ROW = rf"(?s)^\s*(?:\{{\s*(?=[\"\}}]))?(?:[\s,\[\]:]|{_STRING})*"
# Depths are counted from 0 outside the object: its tables' rows lie at 3 and end at 2.
_BETWEEN_ROWS = 2


def tables(spark: SparkSession, path: str, schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """One DataFrame per table, from all files of `path`."""
    found = staged(elements(spark, path), "table-json")
    return {
        name: found.where(F.col("table") == name)
        .select(F.from_json("row", schema).alias("r"))
        .select("r.*")
        for name, schema in schemas.items()
    }


def elements(spark: SparkSession, path: str) -> DataFrame:
    """(path, table, nth, row): the text of every row of every table; `nth` counts the rows of a file."""
    pieces = staged(
        spark.read.option("lineSep", "}").text(path).select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("at"),
            "value",
        ),
        "table-json-pieces",
    )
    depths = staged(_with_depth(pieces), "table-json-depths")
    end = F.col("depth") + F.col("before")
    placed = depths.join(_totals(depths, F.sum("delta"), F.sum("before")), _SPLIT).select(
        *_SPLIT, "at", "value", end.alias("end"), (end - F.col("delta")).alias("start")
    )
    closes = (F.col("end") == _BETWEEN_ROWS).cast("long")
    first = F.col("start") <= _BETWEEN_ROWS
    prefix = F.regexp_extract("value", _BEFORE_ROW, 0)
    name = F.regexp_extract(prefix, rf"(?s)({_STRING})\s*:\s*\[[\s]*$", 1)
    named = staged(
        placed.select(
            *_SPLIT,
            "at",
            first.alias("first"),
            F.when(first, F.nullif(name, F.lit(""))).alias("name"),
            F.when(first, F.substr("value", F.length(prefix) + 1)).otherwise(F.col("value")).alias("value"),
            closes.alias("closes"),
            (F.col("end") >= _BETWEEN_ROWS).alias("inside"),
        ),
        "table-json-named",
    )
    carried = _totals(named, F.sum("closes"), F.sum("before")).join(
        _totals(named, F.max_by("name", F.when(F.col("name").isNotNull(), F.col("at"))), F.last("before", True))
        .withColumnRenamed("before", "name_before"),
        _SPLIT,
    )
    order = W.partitionBy(*_SPLIT).orderBy("at")
    rows = (
        named.join(carried, _SPLIT)
        .withColumn("nth", F.col("before") + F.coalesce(F.sum("closes").over(_preceding(order)), F.lit(0)))
        .withColumn("table", F.coalesce(F.last("name", True).over(order), "name_before"))
        .where("inside")
    )
    # Deeper pieces follow a first one that left its row open.
    whole = F.col("first") & (F.col("closes") == 1)
    text = F.concat("value", F.lit("}"))
    flat = rows.where(whole).select("path", "table", "nth", text.alias("row"))
    nested = (
        rows.where(~whole)
        .groupBy("path", "nth")
        .agg(
            F.min_by("table", F.struct("split", "at")).alias("table"),
            F.array_join(F.sort_array(F.collect_list(F.struct("split", "at", text.alias("t"))))["t"], "").alias("row"),
        )
        .select("path", "table", "nth", "row")
    )
    unquoted = F.from_json(F.concat(F.lit("["), "table", F.lit("]")), "array<string>")[0]
    return flat.unionByName(nested).withColumn("table", unquoted)


def _with_depth(pieces: DataFrame) -> DataFrame:
    """Adds `delta`, by how much a piece and the brace behind it change the depth, and `depth`, its sum in the split."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    counted = pieces.withColumn("plain", plain).withColumn("quotes", _count("plain", '"'))
    order = W.partitionBy(*_SPLIT).orderBy("at")
    so_far = F.col("before") + F.coalesce(F.sum("quotes").over(_preceding(order)), F.lit(0))
    opened = counted.join(_totals(counted, F.sum("quotes"), F.sum("before")), _SPLIT).withColumn(
        "in_string", so_far % 2 == 1
    )
    rest = F.when(F.col("in_string"), F.regexp_replace("plain", r'\A[^"]*("|\z)', "")).otherwise(F.col("plain"))
    outside = F.regexp_replace(rest, r'"[^"]*("|\z)', "")
    ends_in_string = F.col("in_string") != (F.col("quotes") % 2 == 1)
    brace = F.when(ends_in_string, 0).otherwise(1)
    delta = F.regexp_count(outside, F.lit(r"[\[{]")) - F.regexp_count(outside, F.lit(r"[\]}]")) - brace
    return opened.select(*_SPLIT, "at", "value", delta.alias("delta")).withColumn(
        "depth", F.sum("delta").over(order)
    )


def _totals(pieces: DataFrame, of_split: Column, of_earlier: Column) -> DataFrame:
    """(path, split, before): what the splits of a file before each one amount to; a row per split."""
    splits = staged(pieces.groupBy(*_SPLIT).agg(of_split.alias("before")), "table-json-splits")
    earlier = of_earlier.over(_preceding(W.partitionBy("path").orderBy("split")))
    none = F.lit(0) if dict(splits.dtypes)["before"] == "bigint" else F.lit(None)
    return splits.select(*_SPLIT, F.coalesce(earlier, none).alias("before"))


def _preceding(order):
    return order.rowsBetween(W.unboundedPreceding, -1)


def _count(column: str, char: str) -> Column:
    return (F.length(column) - F.length(F.replace(F.col(column), F.lit(char), F.lit("")))).cast("long")
