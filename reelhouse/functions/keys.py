"""Natural keys and the surrogate ids derived from them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PART_SEPARATOR = "\u0001"
NULL_PART = "\u0002"


def composite_key(*parts: Column | str) -> Column:
    """Case-folded key over several columns; null is a value of its own."""
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    folded = [F.coalesce(F.lower(c.cast("string")), F.lit(NULL_PART)) for c in cols]
    return F.concat_ws(PART_SEPARATOR, *folded)


def packed_id(name: str) -> Column:
    """An id for lookups: a digest as its 16 bytes, any other text as longer bytes of its own."""
    text = F.col(name)
    other = F.encode(F.concat(F.lit(" " * 17), text), "UTF-8")
    return F.when(text.rlike(r"\A[0-9a-f]{32}\z"), F.unhex(text)).otherwise(other)


def surrogate_id(*parts: Column | str) -> Column:
    """Deterministic text id of a natural key.

    Because the id is a pure function of the key, a referencing row computes its
    own foreign key and no lookup join is ever needed.
    """
    return F.md5(composite_key(*parts))
