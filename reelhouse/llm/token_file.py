"""Token ids of a corpus in one ordered, entropy-coded file set.

Documents are put in id order by ranges, tokenised once and staged; global counts give a canonical
length-limited Huffman code (`huffman.py`), and each task writes its stretch of the order as independent
blocks of whole documents. A block row states where it starts in the corpus, its documents and their
lengths, and the bit offset of every 256th id, so any block, and any stretch within it, can be
decoded by itself. Blocks are rows of Parquet, so Spark's committer keeps half-written ones out and readers
split them.

The tokenizer's words are cached by their text: what stands between two blanks is always
tokenised alone by byte-level pre-tokenizers, so only words a worker has not met are encoded, letters alone
by the tokenizer's model without its pre-tokenizer, and what a single line end divides apart. Texts
with runs of blanks are cut only where a blank follows a non-blank; texts that hold a special token, and
tokenizers of another kind, are encoded as a whole. When the cache holds `CACHE_WORDS` words it becomes the older
one and a new one begins; words that are met again are taken over, so a worker keeps twice that number at most
and what it learns again are words it has not met for long.

Defined cases: null and empty texts are the end id alone. Null ids come first; rows that share an id are
ordered by their text, and repeated rows are written as often as they come. An empty corpus has no blocks. Extra columns
are not written.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.common import whole
from reelhouse.llm.huffman import LIMIT, Code, code_lengths
from reelhouse.session import run_dir

END_ID = 2
BLOCK_IDS = 1 << 18
CACHE_WORDS = 500_000

_ENCODERS: dict[str, Encoder] = {}
# A blank after white space: what no word of letters and no cut at a blank may hide.
_SPACED = [c + " " for c in map(chr, range(0x3001)) if c.isspace()]
_SPACED_ASCII = [pair for pair in _SPACED if pair.isascii()]
_BOUNDARY = re.compile(r"(?<=\S)(?= )")
# The apostrophe may begin a token together with letters.
_PUNCTUATION = string.punctuation.replace("'", "")
_WHITE = re.compile(r"\s")


class _Words(dict):
    """Ids by word; one not met before is learnt when it is looked up."""

    def __init__(self, learn: Callable[[str], bytes]):
        super().__init__()
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class Encoder:
    """Texts to ids through a cache of words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        pre = self.tokenizer.pre_tokenizer
        self.by_words = (
            isinstance(pre, pre_tokenizers.ByteLevel)
            and not pre.add_prefix_space
            and pre.use_regex
            and self.tokenizer.normalizer is None
        )
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if max(size, END_ID + 1) <= 1 << 16 else np.dtype("<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.end = self._packed([END_ID])
        # Words that begin a text, words after a blank, kept without it, and punctuation at their ends.
        self.heads: dict[str, bytes]
        self.cache: dict[str, bytes] = {}
        self.tails: dict[str, bytes]
        self.older: dict[str, bytes]
        self._renew()
        self.line_end = self._encoded("\n")
        alphabet = pre_tokenizers.ByteLevel.alphabet()
        plain = [b for b in range(256) if chr(b) in alphabet]
        others = [b for b in range(256) if chr(b) not in alphabet]
        # Byte-level vocabularies write a byte as itself if it prints, else as a letter from 256 on.
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}

    def batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian, with the end id."""
        made = []
        for text in texts:
            if len(self.heads) + len(self.cache) + len(self.tails) > CACHE_WORDS:
                self._renew()
            words = self._words(text)
            if words is None:
                made.append(self._encoded(text) + self.end)
                continue
            found = [self.heads[words[0]], *map(self.cache.__getitem__, words[1:]), self.end]
            made.append(b"".join(found))
        return made

    def _renew(self) -> None:
        self.older = self.cache
        self.cache, self.heads, self.tails = _Words(self._after_blank), _Words(self._at_start), _Words(self._model_ids)

    def _words(self, text: str) -> list[str] | None:
        """The first word, and those after a blank without it; None if the text is to be encoded as a whole."""
        if not self.by_words or any(s in text for s in self.special):
            return None
        if any(pair in text for pair in (_SPACED_ASCII if text.isascii() else _SPACED)):
            first, *rest = _BOUNDARY.split(text)
            return [first, *(w[1:] for w in rest)]
        return text.split(" ")

    def _at_start(self, word: str) -> bytes:
        return self._learnt(self.heads, word, "")

    def _after_blank(self, word: str) -> bytes:
        ids = self.older.get(word)
        return self._learnt(self.cache, word, " ") if ids is None else ids

    def _learnt(self, known: dict[str, bytes], word: str, blank: str) -> bytes:
        """Letters alone go to the model; punctuation after them and a single line end are runs of their own."""
        stem = word.rstrip(_PUNCTUATION)
        if stem.isalpha():
            return known[stem] + self.tails[word[len(stem) :]] if len(stem) < len(word) else self._model_ids(blank + stem)
        before, _, after = word.partition("\n")
        if before and after and not _WHITE.search(before) and not _WHITE.search(after):
            return known[before] + self.line_end + self.heads[after]
        return self._encoded(blank + word)

    def _encoded(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _model_ids(self, run: str) -> bytes:
        """Ids of a run that the pre-tokenizer would not cut."""
        if run.isascii():
            as_letters = run.replace(" ", self.letters[32])
        else:
            as_letters = run.encode().decode("latin-1").translate(self.letters)
        return self._packed([t.id for t in self.model.tokenize(as_letters)])

    def _packed(self, ids: list[int]) -> bytes:
        """Short lists pack faster this way than through numpy."""
        return struct.pack(f"<{len(ids)}{self.code}", *ids)


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


STAGED = "part int, at long, doc_id long, n_tokens long, ids binary, seen binary"


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Stage (part, at, doc_id, n_tokens, ids): parts in id order, `at` the ids before in the part.

    The last row of a part is no document: its `seen` counts each id of the part.
    """
    spark = docs.sparkSession
    ordered = (
        docs.select("doc_id", whole("text").alias("text"))
        .repartitionByRange(F.col("doc_id"), F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = _encoder(tokenizer), TaskContext.get().partitionId(), 0
        width, seen = encoder.dtype.itemsize, np.zeros(1, np.int64)

        def rows(at, doc_ids, counts, ids, seen):
            parts = pa.array(np.full(len(counts), part, np.int32))
            columns = [parts, pa.array(at), doc_ids, pa.array(counts), pa.array(ids, pa.binary())]
            return pa.RecordBatch.from_arrays(
                [*columns, pa.array(seen, pa.binary())],
                names=["part", "at", "doc_id", "n_tokens", "ids", "seen"],
            )

        for batch in batches:
            made = encoder.batch(batch.column(1).to_pylist())
            now = np.bincount(np.frombuffer(b"".join(made), encoder.dtype), minlength=len(seen))
            now[: len(seen)] += seen
            seen = now
            counts = np.array([len(b) // width for b in made], np.int64)
            ids, nothing = [_planes(b, width) for b in made], [None] * len(made)
            yield rows(at + np.cumsum(counts) - counts, batch.column(0), counts, ids, nothing)
            at += int(counts.sum())
        none = np.zeros(1, np.int64)
        yield rows(none + at, pa.array([None], pa.int64()), none, [b""], [seen.astype("<i8").tobytes()])

    path = run_dir(spark, "token-ids")
    ordered.mapInArrow(tokenize, STAGED).write.option("compression", "zstd").parquet(path)
    return spark.read.schema(STAGED).parquet(path)


def _planes(ids: bytes, width: int) -> bytes:
    """Low bytes first, then higher ones: the staging codec finds more in them."""
    return np.frombuffer(ids, np.uint8).reshape(-1, width).T.tobytes()


def _from_planes(planes: bytes, n: int) -> np.ndarray:
    width = len(planes) // n
    return np.frombuffer(planes, np.uint8).reshape(width, n).T.copy().view(f"<u{width}").ravel()


def global_code(staged_ids: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(id, length) of the ids that occur. There are at most as many as the vocabulary has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in batch.column(0).to_pylist():
                seen = np.frombuffer(part, "<i8")
                ids = np.flatnonzero(seen)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(seen[ids])], names=["id", "n"])

    counted = (
        staged_ids.where("seen is not null")
        .select("seen")
        .mapInArrow(count, "id long, n long")
        .groupBy("id")
        .agg(F.sum("n").alias("n"))
        .orderBy("id")
        .collect()
    )
    lengths = code_lengths(np.array([r["n"] for r in counted], np.int64), limit)
    return staged_ids.sparkSession.createDataFrame(
        [(r["id"], int(k)) for r, k in zip(counted, lengths)], "id long, length int"
    )


BLOCK = (
    "start long, n_ids long, doc_ids array<long>, doc_ids_n array<long>, payload binary, "
    "checkpoints binary"
)


def write_tokens(docs: DataFrame, path: str, tokenizer: str, block_ids: int = BLOCK_IDS) -> None:
    """Write `docs` (doc_id, text) to the folder `path`: `code` and `blocks`."""
    ids = tokenized(docs, tokenizer)
    global_code(ids).coalesce(1).write.parquet(f"{path}/code")
    code = _read_code(docs.sparkSession, path)
    # One row per range of ids; running totals over them.
    sizes = ids.groupBy("part").agg(F.sum("n_tokens").alias("n")).orderBy("part").collect()
    offsets, total = {}, 0
    for row in sizes:
        offsets[row["part"]] = total
        total += row["n"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, np.ndarray, int | None]] = []
        size = 0
        for batch in batches:
            columns = [batch.column(k) for k in range(5)]
            for i in range(batch.num_rows):
                part, at, doc_id, n = (columns[k][i].as_py() for k in range(4))
                start = offsets[part] + at
                if held and (size >= block_ids or start != held[0][0] + size):
                    yield _block(code, held)
                    held, size = [], 0
                held.append((start, _from_planes(columns[4][i].as_py(), n), doc_id))
                size += n
        if held:
            yield _block(code, held)

    ids.where("seen is null").drop("seen").mapInArrow(encode, BLOCK).write.parquet(f"{path}/blocks")


def _block(code: Code, held: list) -> pa.RecordBatch:
    ids = np.concatenate([h[1] for h in held])
    payload, checkpoints = code.encode(ids)
    fields = [
        ("start", pa.int64(), held[0][0]),
        ("n_ids", pa.int64(), len(ids)),
        ("doc_ids", pa.list_(pa.int64()), [h[2] for h in held]),
        ("doc_ids_n", pa.list_(pa.int64()), [len(h[1]) for h in held]),
        ("payload", pa.binary(), payload),
        ("checkpoints", pa.binary(), checkpoints.astype("<i8").tobytes()),
    ]
    return pa.RecordBatch.from_arrays(
        [pa.array([v], t) for _, t, v in fields], names=[name for name, _, _ in fields]
    )


def _read_code(spark: SparkSession, path: str) -> Code:
    rows = spark.read.parquet(f"{path}/code").orderBy("id").collect()  # at most the vocabulary
    return Code(
        np.array([r["id"] for r in rows], np.int64), np.array([r["length"] for r in rows], np.int64)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): every document of the file, ids as an array."""
    return _decoded(spark, path, "ids array<int>", lambda ids: ids.astype(np.int32))


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32): the ids as little-endian 32-bit numbers, by CRC-32."""
    return _decoded(
        spark, path, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes())
    )


def _decoded(spark: SparkSession, path: str, field: str, of) -> DataFrame:
    code = _read_code(spark, path)
    name = field.split()[0]
    kind = pa.int64() if field.endswith("long") else pa.list_(pa.int32())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                block = {c: batch.column(c)[row].as_py() for c in batch.schema.names}
                checkpoints = np.frombuffer(block["checkpoints"], "<i8")
                ids = code.decode(block["payload"], checkpoints, block["n_ids"])
                sizes = np.array(block["doc_ids_n"], np.int64)
                ends = np.cumsum(sizes)
                made = [of(ids[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block["doc_ids"], pa.int64()),
                        pa.array(block["start"] + ends - sizes),
                        pa.array(sizes),
                        pa.array(made, kind),
                    ],
                    names=["doc_id", "start", "n_tokens", name],
                )

    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    # A batch carries few blocks, so that payloads of long documents do not add up.
    return blocks.mapInArrow(decode, f"doc_id long, start long, n_tokens long, {field}")


def round_trip(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the corpus to the shared folder and digest every document read back."""
    spark = docs.sparkSession
    path = run_dir(spark, "tokens")
    write_tokens(docs, path, tokenizer)
    return read_digests(spark, path)
