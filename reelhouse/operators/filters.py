"""Row predicates."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from reelhouse.functions.text import strip
from reelhouse.functions.values import NULL_MARKER, numeric_or_null, within_or_unknown

# Catalogue title types that can match a reviewed title.
LINKABLE_TITLE_TYPES = ("movie", "tvSeries", "tvMiniSeries")


def catalogue_acceptable(titles: DataFrame, years: DataFrame) -> DataFrame:
    """Titles of a linkable type and target year whose title says something.

    `years(year int)` comes from `entities.year_set`; Spark broadcasts it by its measured
    size. `startYear` comes out as int.
    """
    start = numeric_or_null(F.col("startYear")).cast("int")
    title = F.nullif(strip(F.col("primaryTitle")), F.lit(NULL_MARKER))
    kept = titles.where(
        F.col("titleType").isin(*LINKABLE_TITLE_TYPES)
        & (title != "")
        & (F.length("primaryTitle") > 1)
    ).withColumn("startYear", start)
    return kept.join(years, kept["startYear"] == years["year"], "left_semi")


def _allowed(values: object) -> list:
    if isinstance(values, (str, bytes)) or not isinstance(values, Iterable):
        return [values]
    return list(values)


def whitelist(
    columns: Sequence[str], groups: Sequence[Mapping[str, object]] | None
) -> Column:
    """A row passes if it matches any group; a group needs all its columns to match.

    No groups keeps everything; a null or missing column never matches.
    """
    if groups is None:
        return F.lit(True)

    def matches(group: Mapping[str, object]) -> Column:
        tests = [
            (F.col(c).isNotNull() & F.col(c).isin(*_allowed(v))) if c in columns else F.lit(False)
            for c, v in group.items()
        ]
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    return reduce(lambda a, b: a | b, [matches(g) for g in groups], F.lit(False))


def filter_rows(
    df: DataFrame,
    groups: Sequence[Mapping[str, object]] | None = None,
    drop: Sequence[str] | None = None,
) -> DataFrame:
    """Drop columns, then keep the rows on the whitelist."""
    kept = df.drop(*(drop or []))
    return kept.where(whitelist(kept.columns, groups))


def membership(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a computed set; Spark picks the join side by measured size."""
    return df.join(keys.select(on).distinct(), on, "left_semi")


def linkage_targets(media: DataFrame) -> DataFrame:
    """Media that can be looked up in the catalogue: no games, year known."""
    return media.where((F.col("media_type") != "Video Game") & F.col("release_year").isNotNull())


def runtime_band(pairs: DataFrame, a: str, b: str, width: int = 2) -> DataFrame:
    return pairs.where(within_or_unknown(F.col(a), F.col(b), width))


def name_like(role: Column, person: Column, word: str) -> Column:
    """Role or person contains the word, taken literally."""
    return role.contains(word) | person.contains(word)


def row_callback(
    df: DataFrame,
    keep: Callable[[dict], bool] | None = None,
    convert: Callable[[dict], dict] | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Opaque Python predicate (True keeps) and row mapper, in Arrow batches.

    Callbacks see plain Python values: integers of any size stay integers, null is None. Only for
    callbacks that cannot be written as columns.
    """
    out_schema = df.schema if schema is None else schema
    if isinstance(out_schema, str):
        out_schema = T.StructType.fromDDL(out_schema)
    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for r in batch.to_pylist() if keep is None or keep(r)]
            out = [convert(r) for r in rows] if convert else rows
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return df.mapInArrow(run, out_schema)
