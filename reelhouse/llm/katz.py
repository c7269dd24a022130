"""Bigram language model with Katz backoff, learnt from a corpus and evaluated on the whole of it.

A count of up to `K` is discounted by Good and Turing; what the discounts free goes to what was not seen.

    P(w | v) = d(c(v,w)) c(v,w) / c(v)      where the pair was seen
             = alpha(v) P(w)                where only v was, with alpha(v) such that all sums to one
             = P(w)                         where v begins no pair
    P(w)     = d(c(w)) c(w) / N             where w was seen, else what is left, for all unknown words together

Texts are cut into words; every text ends in one end token, which is also what its first word follows.

Documents are packed into blocks of about `BLOCK_TOKENS` tokens, each with its own short list of words. All that
crosses the network is a block's distinct words and pairs, never a row per token:

1. words: counted over all blocks, numbered from the most frequent down, and sent back to the blocks that hold them.
   A number tells the count as well, by a list of the counts that occur: no more than the root of twice the tokens;
2. pairs: each block sends its distinct known pairs, as numbers, in one packed row per bucket. A bucket adds
   them up, keeps them as its part of the pair table, and answers every block in the order it was asked;
3. contexts: what each bucket knows of a context (counts of counts, probability of the words seen after it) is
   added up by context, which gives the discounts and the exact backoff weights, and goes back to the blocks;
4. score: a block now holds all its words, contexts and pairs need, and evaluates its tokens one document at a time.

A bucket is chosen by context; a context with more than `SPLIT` tokens is split by its second words as well, so that a
frequent word is no task of its own. A pair that every block holds comes to one bucket as one entry per block.

Discounts: Good-Turing where it gives a value between 0 and 1, else (r - 0.5) / r, so that something is always
left. Where no count is small enough to be discounted, the total counts one more. With that every P(. | v)
sums to one, the unknown words included.

Defined cases: null and empty texts are the end token alone. A null key is kept. Repeated rows count and are scored
each. With nothing to learn from, all words are unknown together and each has probability 1. An empty table
gives no rows. Columns other than those named are not read, so their names may clash.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import numbered, whole
from reelhouse.session import run_dir

K = 5
BLOCK_TOKENS = 1 << 20
BUCKET_PAIRS = 1 << 20
SPLIT = 1 << 16

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SEEN = [f"seen{r}" for r in range(1, K + 2)]


@dataclass(frozen=True)
class Discounted:
    """Counts of one order: their total, discounts of counts 1 to K, and what is left for the unseen."""

    total: int
    distinct: int
    rates: tuple[float, ...]
    small: tuple[int, ...]

    @property
    def floor(self) -> int:
        """What counts are divided by: one more than their total if none of them is discounted."""
        return self.total if any(self.small) else self.total + 1

    @property
    def left(self) -> float:
        if not self.total:
            return 1.0
        freed = sum(r * n * (1 - d) for r, (n, d) in enumerate(zip(self.small, self.rates), 1))
        return freed / self.total if any(self.small) else 1 / (self.total + 1)

    def share(self, counts: np.ndarray) -> np.ndarray:
        """Probability of things seen `counts` times, 0 where they were not seen."""
        return _reduced(counts, self.rates) / max(self.floor, 1)


def discounts(counts: list[int]) -> tuple[float, ...]:
    """Rates for 1 to K from how many things were seen 1 to K + 1 times."""
    n = [0, *counts]
    beyond = (K + 1) * n[K + 1] / n[1] if n[1] else 0.0
    rates = []
    for r in range(1, K + 1):
        rate = (r - 0.5) / r
        if n[r] and n[r + 1] and beyond < 1:
            turing = ((r + 1) * n[r + 1] / (r * n[r]) - beyond) / (1 - beyond)
            rate = turing if 0 < turing < 1 else rate
        rates.append(rate)
    return tuple(rates)


@dataclass(frozen=True)
class Katz:
    """The model's tables and the scores of the corpus it was learnt from.

    words (word, id, c); contexts (id, total, log_alpha); pairs (bucket, first, second, c); scores (key, n_tokens,
    n_known, base_score, score). The ids 0 and up number the words; the empty word is the end token.
    """

    unigrams: Discounted
    rates: tuple[float, ...]
    words: DataFrame
    contexts: DataFrame
    pairs: DataFrame
    scores: DataFrame


def learn_and_score(
    docs: DataFrame,
    key: str,
    text: str,
    teaches: Column,
    block_tokens: int = BLOCK_TOKENS,
    bucket_pairs: int = BUCKET_PAIRS,
    split: int = SPLIT,
) -> Katz:
    """Learn from the rows for which `teaches` holds and score every row."""
    kind = docs.schema[key].dataType.simpleString()
    blocks = staged(
        docs.select(F.col(key).alias("key"), whole(text).alias("text"), teaches.alias("teaches")).mapInArrow(
            _encoder(block_tokens),
            "block long, words array<binary>, taught array<int>, keys array<" + kind + ">, "
            "teaches array<boolean>, sizes array<int>, tokens binary",
        ),
        "katz-blocks",
    )
    # Every table below is read more than once, so each is written before it is used.
    held = blocks.select("block", F.posexplode(F.arrays_zip("words", "taught")).alias("pos", "w")).select(
        "block", "pos", F.col("w.words").alias("word"), F.col("w.taught").alias("taught")
    )
    counted = held.groupBy("word").agg(F.sum("taught").alias("c")).where("c > 0")
    counted = staged(counted.withColumn("rare", -F.col("c")), "katz-counts")
    words = staged(numbered(counted, ["rare", "word"], "id").drop("rare"), "katz-words")
    unigrams, counts = _unigrams(words), _Counts.of(words)
    known = staged(
        held.join(words, "word")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("known"))
        .mapInArrow(_packed_known, "block long, pos binary, ids binary"),
        "katz-known",
    )
    entries = blocks.select(F.sum(F.size("taught"))).first()[0] or 0
    buckets = max(1, math.ceil(4 * entries / bucket_pairs))
    answered = staged(
        blocks.select("block", "teaches", "sizes", "tokens")
        .join(known, "block")
        .mapInArrow(
            _asker(counts, buckets, split), "bucket long, block long, first binary, second binary, n binary"
        )
        .groupBy("bucket")
        .applyInArrow(
            _adder(unigrams, counts),
            "bucket long, block long, counts binary, first array<long>, mass array<double>, large array<long>, "
            + ", ".join(f"{s} array<int>" for s in _SEEN)
            + ", opens array<int>, second array<long>, c array<int>",
        ),
        "katz-pairs",
    )
    contexts, rates = _contexts(answered)
    behind = (
        known.mapInArrow(_places_of, "block long, pos int, id long")
        .join(contexts, "id")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "total", "log_alpha"))).alias("contexts"))
    )
    replies = (
        answered.where("block is not null")
        .groupBy("block")
        .agg(F.sort_array(F.collect_list(F.struct("bucket", "counts"))).alias("replies"))
    )
    scores = (
        blocks.select("block", "keys", "sizes", "tokens")
        .join(known, "block", "left")
        .join(behind, "block", "left")
        .join(replies, "block", "left")
        .mapInArrow(
            _scorer(counts, buckets, split, unigrams, rates),
            f"key {kind}, n_tokens long, n_known long, base_score double, score double",
        )
    )
    pairs = answered.where("block is null").select(
        "bucket", F.posexplode("first").alias("nth", "v"), "opens", "second", "c"
    )
    pairs = pairs.select(
        "bucket",
        F.col("v").alias("first"),
        F.explode(
            F.arrays_zip(
                *(
                    F.slice(col, F.element_at("opens", F.col("nth") + 1) + 1, F.element_at("opens", F.col("nth") + 2) - F.element_at("opens", F.col("nth") + 1)).alias(col)
                    for col in ("second", "c")
                )
            )
        ).alias("p"),
    ).select("bucket", "first", "p.second", "p.c")
    return Katz(unigrams, rates, words, contexts, pairs, scores)


@dataclass(frozen=True)
class _Counts:
    """The count of a word from its number: numbers go by falling count."""

    first: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, words: DataFrame) -> _Counts:
        """One entry per count that occurs: n different counts need n (n + 1) / 2 tokens."""
        steps = sorted(tuple(r) for r in words.groupBy("c").agg(F.min("id").alias("id")).select("id", "c").collect())
        first, counts = np.array(steps, dtype=np.int64).reshape(-1, 2).T
        return cls(first, counts)

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        return self.counts[np.searchsorted(self.first, ids, side="right") - 1] if len(ids) else ids


def _unigrams(words: DataFrame) -> Discounted:
    row = words.agg(
        F.sum("c"), F.count(F.lit(1)), *(F.count_if(F.col("c") == r) for r in range(1, K + 2))
    ).first()
    return Discounted(row[0] or 0, row[1], discounts(list(row[2:])), tuple(row[2 : K + 2]))


def _contexts(answered: DataFrame) -> tuple[DataFrame, tuple[float, ...]]:
    """(id, total, log_alpha) of every context, and the discounts of pairs."""
    names = ["first", "mass", "large", *_SEEN]
    parts = answered.where("block is null").select(F.inline(F.arrays_zip(*names)))
    added = staged(
        parts.groupBy(F.col("first").alias("id")).agg(*(F.sum(c).alias(c) for c in names[1:])), "katz-contexts"
    )
    seen = added.agg(*(F.sum(c) for c in _SEEN)).first()
    rates = discounts([n or 0 for n in seen])
    small = [F.col(c) for c in _SEEN[:K]]
    count = sum((r * n for r, n in enumerate(small, 1)), F.col("large"))
    freed = sum((r * n * (1 - d) for r, (n, d) in enumerate(zip(small, rates), 1)), F.lit(0.0))
    discounted = sum(small, F.lit(0)) > 0
    left = F.when(discounted, freed / count).otherwise(1 / (count + 1))
    return staged(
        added.select(
            "id",
            F.when(discounted, count).otherwise(count + 1).alias("total"),
            F.log10(left / (1 - F.col("mass"))).alias("log_alpha"),
        ),
        "katz-contexts",
    ), rates


def _reduced(counts: np.ndarray, rates: tuple[float, ...]) -> np.ndarray:
    rate = np.concatenate([[0.0], rates, [1.0]])
    return rate[np.minimum(counts, K + 1)] * counts


def _log10(x: np.ndarray) -> np.ndarray:
    return np.log10(x, out=np.zeros(len(x)), where=x > 0)


def staged(df: DataFrame, label: str) -> DataFrame:
    """As `session.staged`, in the smaller of Spark's Parquet codecs."""
    path = run_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed with all first bytes first, then all second ones: the upper ones of small numbers are zero."""
    width = numbers.dtype.itemsize
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(packed: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).reshape(-1)


def _packed_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            known = _fields(batch, "known", i)
            yield pa.RecordBatch.from_pydict(
                {
                    "block": [batch.column("block")[i].as_py()],
                    "pos": [_pack(known["pos"].astype("<i4"))],
                    "ids": [_pack(known["id"].astype("<i8"))],
                }
            )


def _places_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for every known word of a block."""
    for batch in batches:
        for row in batch.to_pylist():
            pos, ids = _unpack(row["pos"], "<i4"), _unpack(row["ids"], "<i8")
            blocks = np.full(len(pos), row["block"], dtype=np.int64)
            yield pa.RecordBatch.from_pydict({"block": blocks, "pos": pos, "id": ids})


def _encoder(block_tokens: int):
    """Documents to blocks: distinct words, how often the teaching documents hold each, and tokens as places
    in that list. Place 0 is the end token."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for block in packed(batches):
            yield pa.RecordBatch.from_pydict({"block": [task << 32 | made], **block})
            made += 1

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        places, docs, held, kind = _places(), [], 0, None
        for batch in batches:
            kind = batch.schema.field("key").type
            for key, text, teaches in zip(*(batch.column(c).to_pylist() for c in ("key", "text", "teaches"))):
                found = text.encode().translate(_LOWER).split()
                places_of = np.fromiter(map(places.__getitem__, found), dtype=np.int32, count=len(found))
                docs.append((key, teaches, places_of))
                held += len(found) + 1
                if held >= block_tokens:
                    yield _block(places, docs, kind)
                    places, docs, held = _places(), [], 0
        if docs:
            yield _block(places, docs, kind)

    return encode


def _places() -> defaultdict:
    """Gives each new word the next place."""
    places: defaultdict = defaultdict()
    places.default_factory = places.__len__
    places[b""]
    return places


def _block(places: defaultdict, docs: list[tuple], kind: pa.DataType) -> dict:
    end = np.zeros(1, dtype=np.int32)
    tokens = np.concatenate([part for _, _, places_of in docs for part in (places_of, end)])
    sizes = np.array([len(d[2]) + 1 for d in docs], dtype=np.int32)
    teaches = np.array([d[1] for d in docs])
    taught = np.bincount(tokens[np.repeat(teaches, sizes)], minlength=len(places)).astype(np.int32)
    return {
        "words": pa.array([list(places)], type=pa.list_(pa.binary())),
        "taught": pa.array([taught], type=pa.list_(pa.int32())),
        "keys": pa.array([[d[0] for d in docs]], type=pa.list_(kind)),
        "teaches": pa.array([teaches], type=pa.list_(pa.bool_())),
        "sizes": pa.array([sizes], type=pa.list_(pa.int32())),
        "tokens": pa.array([_pack(tokens)], type=pa.binary()),
    }


class _Opened:
    """A block with the numbers and counts of its known words."""

    def __init__(self, batch: pa.RecordBatch, i: int, counts: _Counts):
        self.block = batch.column("block")[i].as_py()
        self.sizes = _values(batch, "sizes", i)
        self.tokens = _unpack(batch.column("tokens")[i].as_py(), "<i4")
        n = int(self.tokens.max()) + 1
        self.ids = np.full(n, -1, dtype=np.int64)
        self.counts = np.zeros(n, dtype=np.int64)
        if batch.column("pos")[i].is_valid:
            pos, ids = (batch.column(c)[i].as_py() for c in ("pos", "ids"))
            pos, ids = _unpack(pos, "<i4"), _unpack(ids, "<i8")
            self.ids[pos], self.counts[pos] = ids, counts(ids)
        # The token before a text's first is the end token of the one before it, or place 0 at the very start.
        left = np.concatenate([self.tokens[:1] * 0, self.tokens[:-1]]).astype(np.int64)
        self.pairs, self.nth = np.unique(left * n + self.tokens, return_inverse=True)
        self.first, self.second = np.divmod(self.pairs, n)

    def order(self, buckets: int, split: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the pairs of known words, by bucket, and their buckets."""
        asked = np.flatnonzero((self.ids[self.first] >= 0) & (self.ids[self.second] >= 0))
        first, second = self.ids[self.first[asked]], self.ids[self.second[asked]]
        parts = self.counts[self.first[asked]] // split + 1
        bucket = _mixed(first, _mixed(second, 0) % parts) % buckets
        by = np.argsort(bucket, kind="stable")
        return asked[by], bucket[by]


def _mixed(a: np.ndarray, b: np.ndarray | int) -> np.ndarray:
    """A hash of two numbers, 0 and up."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(b).astype(np.uint64) * np.uint64(
        0xC2B2AE3D27D4EB4F
    )
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(17)).astype(np.int64)


def _values(batch: pa.RecordBatch, column: str, i: int) -> np.ndarray:
    return batch.column(column)[i].values.to_numpy(zero_copy_only=False)


def _fields(batch: pa.RecordBatch, column: str, i: int) -> dict[str, np.ndarray] | None:
    """An array of structs as one array per field; None if it is null."""
    cell = batch.column(column)[i]
    if not cell.is_valid:
        return None
    fields = cell.values.type
    return {f.name: cell.values.field(f.name).to_numpy(zero_copy_only=False) for f in fields}


def _asker(counts: _Counts, buckets: int, split: int):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = _Opened(batch, i, counts)
                teaches = np.repeat(_values(batch, "teaches", i).astype(bool), block.sizes)
                n = np.bincount(block.nth[teaches], minlength=len(block.pairs)).astype(np.int32)
                order, bucket = block.order(buckets, split)
                first, second = block.first[order], block.second[order]
                columns = (block.ids[first], block.ids[second], n[order])
                opens = np.flatnonzero(np.diff(bucket, prepend=-1))
                made = [
                    (int(bucket[a]), block.block, *(_pack(c[a:b]) for c in columns))
                    for a, b in zip(opens, [*opens[1:], len(order)])
                ]
                names = ["bucket", "block", "first", "second", "n"]
                if made:
                    yield pa.RecordBatch.from_pydict(dict(zip(names, map(list, zip(*made)))))

    return ask


def _adder(unigrams: Discounted, counts: _Counts):
    """Adds up a bucket's pairs, answers its blocks and keeps its part of the tables."""

    def add(bucket: pa.Table) -> pa.Table:
        read = {
            name: [_unpack(x, kind) for x in bucket.column(name).to_pylist()]
            for name, kind in (("first", "<i8"), ("second", "<i8"), ("n", "<i4"))
        }
        lengths = [len(x) for x in read["n"]]
        first, second, n = (np.concatenate(read[name]) for name in ("first", "second", "n"))
        by = np.lexsort((second, first))
        opens = np.flatnonzero((np.diff(first[by], prepend=-1) != 0) | (np.diff(second[by], prepend=-1) != 0))
        sums = np.add.reduceat(n[by].astype(np.int64), opens)
        found = np.empty(len(n), dtype=np.int64)
        found[by] = np.repeat(sums, np.diff(opens, append=len(n)))
        answers = [_pack(x.astype("<i4")) for x in np.split(found, np.cumsum(lengths)[:-1])]
        kept = opens[sums > 0]
        first, second, c = first[by][kept], second[by][kept], sums[sums > 0]
        starts = np.flatnonzero(np.diff(first, prepend=-1))

        def per_context(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, starts) if len(starts) else x

        table = {
            "first": first[starts],
            "mass": per_context(unigrams.share(counts(second))),
            "large": per_context(np.where(c > K, c, 0)),
            **{s: per_context((c == r).astype(np.int32)) for r, s in enumerate(_SEEN, 1)},
            "opens": np.append(starts, len(first)).astype(np.int32),
            "second": second,
            "c": c.astype(np.int32),
        }
        nulls = [None] * len(answers)
        name = bucket.column("bucket")[0].as_py()
        kinds = {"mass": pa.float64(), "first": pa.int64(), "large": pa.int64(), "second": pa.int64()}
        return pa.table(
            {
                "bucket": pa.array([name] * (len(answers) + 1), type=pa.int64()),
                "block": pa.array([*bucket.column("block").to_pylist(), None], type=pa.int64()),
                "counts": pa.array([*answers, None], type=pa.binary()),
                **{
                    column: pa.array([*nulls, values], type=pa.list_(kinds.get(column, pa.int32())))
                    for column, values in table.items()
                },
            }
        )

    return add


def _scorer(counts: _Counts, buckets: int, split: int, unigrams: Discounted, rates: tuple[float, ...]):
    unknown = math.log10(unigrams.left)
    spread = unigrams.total + 0.5 * (unigrams.distinct + 1)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield scored(batch, i)

    def scored(batch: pa.RecordBatch, i: int) -> pa.RecordBatch:
        block = _Opened(batch, i, counts)
        total = np.zeros(len(block.ids), dtype=np.int64)
        log_alpha = np.zeros(len(block.ids))
        contexts = _fields(batch, "contexts", i)
        if contexts is not None:
            total[contexts["pos"]] = contexts["total"]
            log_alpha[contexts["pos"]] = contexts["log_alpha"]
        found = np.zeros(len(block.pairs), dtype=np.int64)
        replies = batch.column("replies")[i].as_py()
        if replies:
            order, _ = block.order(buckets, split)
            found[order] = np.concatenate([_unpack(r["counts"], "<i4") for r in replies])
        word = np.where(block.counts > 0, _log10(unigrams.share(block.counts)), unknown)
        # The recursion, once per distinct pair: the pair itself, else backoff weight times the word.
        log_p = log_alpha[block.first] + word[block.second]
        seen = np.flatnonzero(found)
        log_p[seen] = np.log10(_reduced(found[seen], rates) / total[block.first[seen]])
        base = np.log10((block.counts + 0.5) / spread)
        starts = np.concatenate([[0], np.cumsum(block.sizes)[:-1]])
        return pa.RecordBatch.from_pydict(
            {
                "key": batch.column("keys")[i].values,
                "n_tokens": block.sizes.astype(np.int64),
                "n_known": np.add.reduceat((block.counts > 0)[block.tokens].astype(np.int64), starts),
                "base_score": np.add.reduceat(base[block.tokens], starts),
                "score": np.add.reduceat(log_p[block.nth.reshape(-1)], starts),
            }
        )

    return score
