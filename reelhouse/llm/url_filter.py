"""URL filter: host and path rules, and a logistic regression for urls that no rule fits.

The regression reads hashed character n-grams of host and path. It is trained from a small table of
labelled urls (1 block, 0 allow) on the driver; scoring runs in Arrow batches with one array
of weights of fixed size. N-grams are hashed for a whole batch at once over the joined bytes, so
cost and memory follow the bytes, whatever the length of one url.

Bounds: training takes at most `max_urls` distinct labelled urls, the first by hash, and at most
`MAX_URL_BYTES` bytes in all. Judging has no bound.

Defined cases: a null url, or one without `://`, has an empty host and path; no rule fits it and the method
judges it like any other (the bias decides). Of rules of equal length that fit, the first in order
wins. Without labelled urls the method allows everything. A url labelled both ways counts as block and as allow. Extra
columns are kept; those named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.common import LOWER, UPPER

BITS = 18
SIZES = (2, 3, 4, 5)
MAX_URLS = 8192
MAX_URL_BYTES = 4_000_000
STEPS = 150
RATE = 0.5
RIDGE = 1e-4

_ODD = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Rule:
    """A host with all its subdomains, and a prefix of the path."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rule(text: str, verdict: str) -> Rule:
    """`example.net/en/` to a rule."""
    host, slash, rest = text.partition("/")
    return Rule(host, slash + rest, verdict)


def host_and_path(url: str) -> tuple[Column, Column]:
    """Host, lower-cased in A-Z, and path; both empty without `://`."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def ruled(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """`pages` with host, path, rule and the rule's verdict (null where none fits)."""
    host, path = host_and_path(url)
    split = pages.withColumns({"host": host, "path": path})
    longest = sorted(rules, key=lambda r: -len(r.name))

    def first_fit(of) -> Column:
        made = F.lit(None).cast("string")
        for rule in reversed(longest):
            fits = (
                (F.col("host") == rule.host) | F.col("host").endswith(F.lit("." + rule.host))
            ) & F.col("path").startswith(F.lit(rule.path))
            made = F.when(fits, F.lit(of(rule))).otherwise(made)
        return made

    return split.withColumns(
        {"rule": first_fit(lambda r: r.name), "verdict": first_fit(lambda r: r.verdict)}
    )


def ngrams(hosts: Sequence[str], paths: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of every n-gram; host and path have features of their own."""
    rows, features = [], []
    for part, texts in enumerate((hosts, paths)):
        # Marks at either end, which occur in no UTF-8 text, let an n-gram be a prefix or suffix.
        raw = [b"\xfe" + t.encode() + b"\xff" for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        row = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
        for n in SIZES:
            if len(data) < n:
                continue
            h = np.full(len(data) - n + 1, 31 * part + n, np.uint64)
            with np.errstate(over="ignore"):
                for k in range(n):
                    h = (h ^ data[k : k + len(h)]) * np.uint64(_ODD)
                    h ^= h >> np.uint64(29)
                h = (h * np.uint64(_ODD)) >> np.uint64(64 - BITS)
            inside = row[: len(h)] == row[n - 1 :]
            rows.append(row[: len(h)][inside])
            features.append(h[inside].astype(np.int64))
    return np.concatenate(rows), np.concatenate(features)


@dataclass(frozen=True)
class UrlModel:
    weights: np.ndarray
    bias: float

    def margins(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """Log odds of block; an url's n-grams are averaged, so long urls do not weigh more."""
        rows, features = ngrams(hosts, paths)
        total = np.bincount(rows, self.weights[features], len(hosts))
        return total / np.sqrt(np.maximum(1, np.bincount(rows, minlength=len(hosts)))) + self.bias


def train(hosts: Sequence[str], paths: Sequence[str], block: Sequence[int]) -> UrlModel:
    """Full-batch gradient steps with momentum on the logistic loss; deterministic."""
    weights = np.zeros(1 << BITS)
    if not len(hosts):
        return UrlModel(weights, -1.0)
    rows, features = ngrams(hosts, paths)
    scale = 1 / np.sqrt(np.maximum(1, np.bincount(rows, minlength=len(hosts))))
    y = np.asarray(block, float)
    used, local = np.unique(features, return_inverse=True)
    w, speed, bias = np.zeros(len(used)), np.zeros(len(used)), 0.0
    for _ in range(STEPS):
        z = np.bincount(rows, w[local], len(y)) * scale + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        slope = np.bincount(local, (error * scale)[rows], len(used)) / len(y) + RIDGE * w
        speed = 0.9 * speed - RATE * slope
        w += speed
        bias -= RATE * error.mean()
    weights[used] = w
    return UrlModel(weights, float(bias))


def fit(labelled: DataFrame, max_urls: int = MAX_URLS) -> UrlModel:
    """Train on `labelled` (url, block)."""
    host, path = host_and_path("url")
    picked = (
        labelled.where(F.octet_length("url") <= MAX_URL_BYTES // max_urls)
        .select("url", F.col("block").cast("int").alias("block"))
        .where("block in (0, 1)")
        .distinct()
        .orderBy(F.xxhash64("url"), "url", "block")
        .limit(max_urls)
        .select(host.alias("host"), path.alias("path"), "block")
        .collect()
    )
    return train(
        [r["host"] for r in picked], [r["path"] for r in picked], [r["block"] for r in picked]
    )


def score(model: UrlModel, host: Column, path: Column) -> Column:
    """Probability that an url is to be blocked."""

    def scores(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in parts:
            made = [np.empty(0)]
            for group in _bounded(hosts.tolist(), paths.tolist()):
                z = model.margins(*group)
                made.append(1 / (1 + np.exp(-np.clip(z, -30, 30))))
            yield pd.Series(np.concatenate(made))

    return F.pandas_udf(scores, T.DoubleType())(host, path)


def _bounded(hosts: list[str], paths: list[str], most: int = 1 << 20):
    """Rows in groups of about `most` characters, so that long urls do not add up."""
    start = size = 0
    for i in range(len(hosts)):
        size += len(hosts[i]) + len(paths[i])
        if size > most or i == len(hosts) - 1:
            yield hosts[start : i + 1], paths[start : i + 1]
            start, size = i + 1, 0


def judge(pages: DataFrame, rules: Sequence[Rule], model: UrlModel, url: str = "url") -> DataFrame:
    """`pages` with host, path, rule, score and verdict."""
    found = ruled(pages, rules, url).withColumn("score", score(model, F.col("host"), F.col("path")))
    by_method = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return found.withColumn("verdict", F.coalesce("verdict", by_method))


def rule_labelled(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """A labelled url table from what the rules decide."""
    return (
        ruled(pages, rules, url)
        .where("verdict is not null")
        .select(F.col(url).alias("url"), (F.col("verdict") == "block").cast("int").alias("block"))
    )
