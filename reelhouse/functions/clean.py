"""Cleaning of contributor rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from reelhouse.functions.text import SPACE, strip
from reelhouse.functions.values import null_marker

# Spellings of a play method that mean another one.
PLAY_METHOD_SYNONYMS = {"actress": "actor"}


def _blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_characters(c: Column) -> Column:
    """Character names of a credit: no brackets, quotes or "Self -"; blank is null."""
    inner = F.regexp_replace(null_marker(c), r"^[\[\]]+|[\[\]]+$", "")
    inner = F.regexp_replace(inner, "[\"']", "")
    inner = strip(F.replace(inner, F.lit("Self -"), F.lit("")))
    return F.nullif(_blank_to_null(inner), F.lit("Self"))


def clean_job(c: Column) -> Column:
    return null_marker(c)


def role(characters: Column, job: Column) -> Column:
    """What a person did in a title: the characters, else the job."""
    return F.coalesce(clean_characters(characters), clean_job(job))


def play_method(category: Column) -> Column:
    """Credit category, folded; the null marker is recognised before folding."""
    folded = strip(F.lower(null_marker(strip(category))))
    return _map_synonyms(folded)


def clean_play_method_older(c: Column) -> Column:
    """Older form: brackets and quotes off, one blank after every comma."""
    inner = F.regexp_replace(strip(null_marker(c)), r"^[\[\]]+|[\[\]]+$", "")
    inner = F.regexp_replace(inner, "[\"']", "")
    inner = F.regexp_replace(inner, rf"[{SPACE}]*,[{SPACE}]*", ", ")
    return F.when(inner != "", strip(inner))


def normalize_role_older(category: Column) -> Column:
    """Older form: the folded category is the role."""
    return _map_synonyms(strip(F.lower(category)))


def play_method_of_self_older(role_: Column, method: Column, person: Column) -> Column:
    """Older form: whoever appears as themselves plays themselves."""
    return F.when((role_ == "self") & person.isNotNull(), person).otherwise(method)


def _map_synonyms(c: Column) -> Column:
    mapped = c
    for spelling, meaning in PLAY_METHOD_SYNONYMS.items():
        mapped = F.when(c == spelling, F.lit(meaning)).otherwise(mapped)
    return mapped
