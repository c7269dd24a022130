"""Training corpus from raw documents: five stages, each on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns of
`documents` and any others there are. An empty table stays empty. `run` writes each result as Parquet to the shared folder and reads it again, so a
lost executor never replays more than one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm import (
    compression_quality,
    decontamination,
    mixing,
    queries,
    simhash_trie,
    token_file,
)
from reelhouse.llm.common import table
from reelhouse.session import configure, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for good ones.

    Null and empty texts score the share of good rows the curve was fitted on. Copies are judged alike; rows without an id
    teach nothing and are judged like others.
    """
    model = compression_quality.fit(docs, table(configure(spark), sf_dir, "labels"))
    return docs.where(model.score("text") >= F.lit(0.5))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group.

    Texts without a word share the fingerprint zero, so one of them stays. Of rows that share an id and a text one stays.
    """
    configure(spark)
    return simhash_trie.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item.

    Texts without words stay. Repeated rows stay or go together.
    """
    items = table(configure(spark), sf_dir, "benchmark")
    return decontamination.drop_contaminated(docs, items)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them.

    Texts without words are never taken. Without a source documents are a source of their own; repeated rows are taken
    each for itself.
    """
    configure(spark)
    return mixing.mix(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as token file, read back: where each document starts, its length and its digest.

    Null and empty texts are the end id alone; rows without an id come first, repeated rows as often as they come.
    """
    configure(spark)
    return token_file.round_trip(docs, queries.TOKENIZER)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_ids", token_ids),
]

# Compression, XXH64 and the tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
