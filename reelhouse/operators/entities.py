"""Dimensional modelling: distinct entities, foreign keys, bridges, facts.

Arrival order is an explicit column everywhere, best a number: "first seen" is
then a hash aggregation that combines on the map side, so a key holding a third of
the rows costs one value per task and never a sorted window in a single one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.functions.keys import composite_key, surrogate_id

Names = Sequence[str]


def _order(seq: Names | str) -> Column:
    names = [seq] if isinstance(seq, str) else list(seq)
    return F.col(names[0]) if len(names) == 1 else F.struct(*[F.col(n) for n in names])


def keep_first(df: DataFrame, keys: Names, seq: Names | str) -> DataFrame:
    """First row per key by arrival order; column order of the input is kept."""
    key_set = set(keys)
    rest = [c for c in df.columns if c not in key_set]
    first = [F.min_by(F.col(c), _order(seq)).alias(c) for c in rest]
    return df.groupBy(*keys).agg(*first).select(*df.columns)


def distinct_entities(
    rows: DataFrame, keys: Names, seq: Names | str, attributes: Names = ()
) -> DataFrame:
    """One row per case-folded key: id, then key and attribute values as first seen.

    Equal rows collapse first, by hash and on the map side; only the spelling
    variants left over are then grouped under their folded key.
    """
    values = [*keys, *attributes]
    variants = rows.groupBy(*values).agg(F.min(_order(seq)).alias("_seq"))
    first = F.min_by(F.struct(*[F.col(c) for c in values]), F.col("_seq")).alias("_first")
    return (
        variants.groupBy(surrogate_id(*keys).alias("id"))
        .agg(first)
        .select("id", *[F.col(f"_first.{c}").alias(c) for c in values])
    )


def entity_refs(rows: DataFrame, keys: Names, ref: str, id_col: str = "id") -> DataFrame:
    """Which row refers to which entity, un-nested; no shuffle."""
    return rows.select(F.col(ref), surrogate_id(*keys).alias(id_col))


def remap_foreign_key(rows: DataFrame, keys: Names, fk: str) -> DataFrame:
    """Replace natural-key columns by the entity's surrogate id; no shuffle."""
    return rows.withColumn(fk, surrogate_id(*keys)).drop(*keys)


def bridge_by_keys(rows: DataFrame, main: str, main_keys: Names, fk: str, fk_keys: Names) -> DataFrame:
    """`bridge` over natural keys: ids are derived last, as a digest takes more room in a shuffle than its key."""
    refs = rows.select(composite_key(*main_keys).alias(main), composite_key(*fk_keys).alias(fk))
    return bridge(refs, main, fk).withColumns({main: F.md5(main), fk: F.md5(fk)})


def facts_by_keys(
    reviews: DataFrame, foreign: Mapping[str, Names], seq: Names | str, values: Names = ("rating",), ids: Names = ()
) -> DataFrame:
    """(fks, ids, values): `facts` over natural keys, `foreign` naming those of every foreign key; ids are derived last.

    `ids` are foreign keys that the rows have already.
    """
    order = [seq] if isinstance(seq, str) else list(seq)
    keyed = reviews.select(
        *[composite_key(*keys).alias(fk) for fk, keys in foreign.items()], *ids, *values, *order
    )
    first = facts(keyed, [*foreign, *ids], seq).drop(*order)
    return first.withColumns({fk: F.md5(fk) for fk in foreign})


def bridge(refs: DataFrame, main: str, fk: str) -> DataFrame:
    """Distinct (main, fk) pairs, each weighted 1 / number of fks of its main row."""
    n = F.count(F.lit(1)).over(W.partitionBy(main))
    return refs.select(main, fk).distinct().withColumn("weight", F.lit(1.0) / n)


def facts(reviews: DataFrame, keys: Names, seq: Names | str) -> DataFrame:
    """Rated reviews, the first one per key."""
    return keep_first(reviews.dropna(subset=["rating"]), keys, seq)


def year_set(media: DataFrame, year: str = "release_year", width: int = 1) -> DataFrame:
    """Every release year ± width, once.

    A year is four characters of text at most, so the result can never exceed
    about 11 000 rows whatever the input size; callers may broadcast it.
    """
    return (
        media.select(year)
        .where(F.col(year).isNotNull())
        .distinct()
        .select(F.explode(F.sequence(F.col(year) - width, F.col(year) + width)).alias("year"))
        .distinct()
    )


def drop_columns(df: DataFrame, names: Names) -> DataFrame:
    return df.drop(*names)
