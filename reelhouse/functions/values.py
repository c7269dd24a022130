"""Numbers, dates and bands out of text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelhouse.functions.text import strip

NULL_MARKER = "\\N"

# Closed score ranges and their band; the first match wins, a value
# between two ranges has no band.
SCORE_BANDS = (
    (0, 35, "red"),
    (36, 49, "yellow"),
    (50, 80, "green"),
    (80, 100, "dark-green"),
)


def null_marker(c: Column) -> Column:
    """The catalogue's null marker becomes null."""
    return F.nullif(c, F.lit(NULL_MARKER))


def int_or_null(c: Column) -> Column:
    """Whole number, or null where the text is none."""
    text = strip(c)
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))


def numeric_or_null(c: Column) -> Column:
    """Any number, or null where the text is none."""
    text = strip(c)
    return F.when(
        text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double")
    )


def runtime_minutes(c: Column) -> Column:
    """Minutes in "2 h 15 m", "2 h" or "45 m"; anything else is null."""
    shape = r"^\s*(?:(\d{1,6})\s*h\s*)?(?:(\d{1,6})\s*m.*)?$"
    hours = F.regexp_extract(c, shape, 1).try_cast("int")
    minutes = F.regexp_extract(c, shape, 2).try_cast("int")
    return F.when(
        hours.isNotNull() | minutes.isNotNull(),
        F.coalesce(hours, F.lit(0)) * 60 + F.coalesce(minutes, F.lit(0)),
    )


def release_year(c: Column) -> Column:
    """Year in the last four characters of a free-text date."""
    return int_or_null(F.right(strip(c), F.lit(4)))


def date_parts(c: Column) -> tuple[Column, Column, Column]:
    """(year, month, day) of "YYYY-MM-DD"; three nulls for empty or other text."""
    parts = F.split(c, "-")
    return tuple(
        F.when(F.size(parts) == 3, int_or_null(F.get(parts, F.lit(i)))) for i in range(3)
    )


def within(a: Column, b: Column, width: float) -> Column:
    """|a − b| ≤ width."""
    return F.abs(a - b) <= width


def within_or_unknown(a: Column, b: Column, width: float) -> Column:
    """As `within`, and true where either side is null or zero."""
    left, right = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    return within(left, right, width) | (left == 0) | (right == 0)


def score_band(c: Column) -> Column:
    band = F.lit(None).cast("string")
    for low, high, name in reversed(SCORE_BANDS):
        band = F.when(c.between(low, high), F.lit(name)).otherwise(band)
    return band


def exact_mean(total: Column, count: Column, places: int) -> Column:
    """Mean of whole numbers rounded half up, computed in decimals."""
    mean = total.cast("decimal(20,0)") / count.cast("decimal(20,0)")
    return F.round(mean, places)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)
