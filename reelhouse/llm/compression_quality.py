"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from text labelled good and one from text
labelled bad. A document is compressed with either; the difference of the two sizes over
their sum says which of the two it resembles, and a logistic curve fitted on labelled
documents that neither dictionary has seen turns that into a probability.

Bounds: the model is fitted on at most `per_class` labelled ids of each label with at
most `max_chars` characters each and `max_bytes` bytes together, the first by a hash of their id, so that reruns
agree; of rows that share an id one teaches. Scoring has no bound: every document is compressed as a whole, in blocks of
`BLOCK` bytes, so that the dictionary counts as much at the end of a long text as at its
start and memory does not grow with the text.

Defined cases: null and empty texts score the share of good rows among those the curve was
fitted on. Labels other than 0 and 1, and rows without a text, teach nothing. Without both labels
every document scores 0.5. Columns besides the two named ones are kept or ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.common import whole

PER_CLASS = 3000
MAX_CHARS = 40_000
MAX_BYTES = 48 << 20
DICTIONARY_BYTES = 112_640
BLOCK = 512
LEVEL = 3


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the curve over the difference of sizes."""

    good: bytes
    bad: bytes
    slope: float
    intercept: float
    prior: float

    def score(self, text: str | Column) -> Column:
        """Probability that `text` is of label 1."""
        return _scorer(self)(whole(text))


def labelled(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """The rows that may teach, with their `label`: labelled, not held out, with a text."""
    known = labels.select(
        F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label")
    ).where("label in (0, 1)")
    return (
        docs.where(~held_out("doc_id") & F.col("text").isNotNull())
        .join(known, F.col("doc_id") == F.col("_id"))
        .drop("_id")
    )


def held_out(doc_id: str) -> Column:
    """True for the third of ids that never teaches; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    per_class: int = PER_CLASS,
    max_chars: int = MAX_CHARS,
    max_bytes: int = MAX_BYTES,
) -> QualityModel:
    """Train on a bounded sample of the labelled rows that are not held out."""
    spark = docs.sparkSession
    # Ids first, so that no task carries texts that are not picked; of rows that share an id one teaches.
    short = docs.where(F.char_length("text") <= max_chars).select(
        "doc_id", "text", F.xxhash64("text").alias("_t"), F.octet_length("text").alias("_bytes")
    )
    one = (
        labelled(short, labels, label)
        .groupBy("label", "doc_id")
        .agg(F.min(F.struct("_t", F.col("_bytes").alias("bytes"))).alias("row"))
        .select("label", "doc_id", "row.*", F.xxhash64("doc_id").alias("h"))
    )
    first = W.partitionBy("label").orderBy("h", "doc_id")
    ranked = one.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_class)
    # At most `per_class` rows a label from here on.
    so_far = F.sum("bytes").over(W.partitionBy("label").orderBy("nth"))
    ids = ranked.withColumn("so_far", so_far).where(F.col("so_far") <= max_bytes)
    ids = ids.select("doc_id", "_t", "label", "h").collect()
    if not ids:
        return QualityModel(b"", b"", 0.0, 0.0, 0.5)
    picked = spark.createDataFrame(ids, ids_schema(docs))
    rows = (
        short.join(F.broadcast(picked), ["doc_id", "_t"])
        .select("h", "text", "label")
        .distinct()
        .collect()
    )
    rows.sort()
    texts = {v: [r["text"].encode() for r in rows if r["label"] == v and r["text"]] for v in (0, 1)}
    return train(texts[1], texts[0])


def ids_schema(docs: DataFrame) -> T.StructType:
    """Rows that are picked: id, hash of the text, label, order."""
    kinds = {"doc_id": docs.schema["doc_id"].dataType, "_t": T.LongType(), "label": T.IntegerType(), "h": T.LongType()}
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])


def train(good: list[bytes], bad: list[bytes]) -> QualityModel:
    """Two thirds of each label make its dictionary, the rest fits the curve."""
    if len(good) < 3 or len(bad) < 3:
        return QualityModel(b"", b"", 0.0, 0.0, 0.5)
    teach = {1: [t for i, t in enumerate(good) if i % 3], 0: [t for i, t in enumerate(bad) if i % 3]}
    good_dict, bad_dict = (_dictionary(teach[v]) for v in (1, 0))
    model = QualityModel(good_dict, bad_dict, 0.0, 0.0, 0.5)
    fitted = [(t, 1) for t in good[::3]] + [(t, 0) for t in bad[::3]]
    compare = _Comparer(model)
    x = np.array([compare(t) for t, _ in fitted])
    y = np.array([v for _, v in fitted], dtype=float)
    # Both labels weigh the same while the slope is found, so that a rare one is learnt as well.
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    slope, intercept = _logistic(x, y, weight)
    return QualityModel(good_dict, bad_dict, slope, intercept, float(y.mean()))


def _dictionary(texts: list[bytes]) -> bytes:
    blocks = [t[i : i + BLOCK] for t in texts for i in range(0, len(t), BLOCK)]
    size = min(DICTIONARY_BYTES, max(256, sum(map(len, blocks)) // 8))
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too little to sample from: the text itself serves
        return b"".join(blocks)[-DICTIONARY_BYTES:]


class _Comparer:
    """(bad size - good size) / (bad size + good size) of a text."""

    def __init__(self, model: QualityModel):
        self.good, self.bad = (
            zstandard.ZstdCompressor(
                level=LEVEL,
                dict_data=_precomputed(d),
                write_checksum=False,
                write_content_size=False,
                write_dict_id=False,
            )
            for d in (model.good, model.bad)
        )

    def __call__(self, text: bytes) -> float:
        good = bad = 0
        for i in range(0, len(text), BLOCK):
            block = text[i : i + BLOCK]
            good += len(self.good.compress(block))
            bad += len(self.bad.compress(block))
        return (bad - good) / (bad + good) if text else 0.0


def _precomputed(raw: bytes) -> zstandard.ZstdCompressionDict:
    made = zstandard.ZstdCompressionDict(raw)
    made.precompute_compress(level=LEVEL)
    return made


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Newton steps on the weighted log likelihood with a small ridge."""
    scale = float(np.abs(x).max()) or 1.0
    a = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (weight * (y - p)) - 1e-2 * beta
        hessian = (a * (weight * p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])


def _scorer(model: QualityModel):
    def scores(texts: pd.Series) -> pd.Series:
        if not model.good or not model.bad:
            return pd.Series([model.prior] * len(texts), dtype="float64")
        compare = _Comparer(model)
        made = []
        for text in texts:
            if text:
                z = model.slope * compare(text.encode()) + model.intercept
                made.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
            else:
                made.append(model.prior)
        return pd.Series(made, dtype="float64")

    return F.pandas_udf(scores, "double")
