"""Repeated passages by prefix-free parsing: bytes in any string of 400 that also starts elsewhere.

Parsing. A rolling hash of eight bytes triggers phrase ends, so equal text is cut alike wherever it
stands. Every window of `LENGTH` bytes hangs on the first trigger inside it (in the rare window without one, on
its least rolling hash), so two equal windows hang on their triggers by the same offset: a window is a suffix of the
phrase that ends at the trigger, followed by what the parse goes on with.

Order. Suffixes that begin in one phrase and share their trigger are handled as one block. Two windows are
neighbours in the order of all suffixes, with 400 bytes in common, exactly if they have the same name; names are
128-bit hashes, given by grouping, which pre-aggregates, instead of by sorting, which would gather a passage that
a third of the corpus shares in one place and would write an entry for every byte of the corpus. A block is settled by two names:
of what all its windows share (if nobody else has it, no window is repeated) and of all it spans (if somebody else
has it, every window is). What is left, a few blocks at the two ends of a repeated passage, is split into
blocks of 16 windows and then into single windows, so the result is exact for every byte.

Only names travel in the shuffles, in proportion to the number of phrases; texts are joined to the verdicts once, and
once more a level for documents with unsettled ends. Documents are parsed in pieces of `PIECE` bytes at most.

Defined cases: null texts are empty; texts shorter than `LENGTH` have no window and lose nothing. A repeated row is a
copy like any other: both lose what they share. Null ids are ids. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import whole
from reelhouse.session import staged

LENGTH = 400
WINDOW = 8  # bytes of the rolling hash
PHRASE_BITS = 7  # a phrase is 128 bytes long on average
LEVELS = (256, 16, 1)  # windows in a block
PIECE = 1 << 20
_OVERLAP = LENGTH + LEVELS[0]

_KEY = "doc_id long, tkey long"
_BLOCK = "lo long, n int, d int"  # first window, further windows, offset of the trigger from the first
NAMES = f"{_KEY}, {_BLOCK}, core long, f1 long, f2 long, witness boolean"
STATE = (
    f"{_KEY}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, "
    f"text string, done array<struct<lo:bigint,hi:bigint>>, "
    "open array<struct<lo:bigint,n:int,d:int,witness:boolean>>"
)

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95))
_LETTERS = np.random.default_rng(1).integers(0, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _finish(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX
    return h ^ (h >> np.uint64(29))


class _Powers:
    """Powers of the bases and of their inverses, as far as a piece reaches."""

    def __init__(self) -> None:
        size = PIECE + _OVERLAP + 1
        self.up, self.down = [], []
        for base in _BASES:
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            for powers, factor in ((self.up, base), (self.down, inverse)):
                row = np.full(size, factor, np.uint64)
                row[0] = 1
                powers.append(np.cumprod(row, dtype=np.uint64))


_powers: list[_Powers] = []


class _Names:
    """Hashes of any stretch of one piece."""

    def __init__(self, data: np.ndarray):
        if not _powers:
            _powers.append(_Powers())
        self.sums = []
        for letters, up in zip(_LETTERS, _powers[0].up):
            terms = letters[data] * up[: len(data)]
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)]))

    def of(self, which: int, start: np.ndarray, stop: np.ndarray, salt: np.ndarray) -> np.ndarray:
        s = self.sums[which]
        h = (s[stop] - s[start]) * _powers[0].down[which][start]
        return _finish(_finish(h) ^ salt.astype(np.uint64)).view(np.int64)

    def blocks(self, at: np.ndarray, low: np.ndarray, high: np.ndarray, size: int):
        """Names of blocks: triggers `at`, offsets low..high before them, in blocks of `size`."""
        block = low // size
        core = self.of(0, at - block * size, at - (block + 1) * size + 1 + LENGTH, block)
        shape = low * 4096 + high
        return core, *(self.of(k, at - high, at - low + LENGTH, shape) for k in (0, 1))


def _rolling(data: np.ndarray) -> np.ndarray:
    """A hash of the eight bytes from each position."""
    x = data.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | x[step:] << np.uint64(8 * step)
    return x * _BASES[0]


def parse(data: np.ndarray, usable: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks (trigger, least offset, greatest offset) of the windows that `usable` marks.

    `usable` has an entry for every position at which a window of `data` may start.
    """
    none = np.empty(0, np.int64)
    starts = np.flatnonzero(usable)
    if not len(starts):
        return none, none, none
    h = _rolling(data)
    reach = LENGTH - WINDOW
    triggers = np.flatnonzero(h >> np.uint64(64 - PHRASE_BITS) == 0)
    # The first trigger at or after each start; beyond the last one, none is in reach.
    ends = np.concatenate([triggers, [len(data) + LENGTH]])
    at = np.repeat(ends, np.diff(np.concatenate([[-1], ends])))[: len(usable)][starts]
    bare = np.flatnonzero(at - starts > reach)
    if len(bare):
        bounds = np.flatnonzero(np.diff(starts[bare]) != 1) + 1
        for run in np.split(bare, bounds):
            a, b = starts[run[0]], starts[run[-1]]
            view = np.lib.stride_tricks.sliding_window_view(h[a : b + reach + 1], reach + 1)
            at[run] = starts[run] + view.argmin(axis=1)
    offset = at - starts
    block = offset // LEVELS[0]
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (block[1:] != block[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(starts)]]) - 1
    return at[first], offset[last], offset[first]


def _split(lo: np.ndarray, n: np.ndarray, d: np.ndarray, size: int):
    """Blocks cut at multiples of `size` of their offsets: (owner, trigger, low, high)."""
    high, low = d, d - n
    pieces = high // size - low // size + 1
    owner = np.repeat(np.arange(len(lo)), pieces)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    block = low[owner] // size + nth
    return (
        owner,
        (lo + d)[owner],
        np.maximum(low[owner], block * size),
        np.minimum(high[owner], block * size + size - 1),
    )


def _batch(doc_id, tkey, lo, n, d, names, witness=None) -> pa.RecordBatch:
    columns = [doc_id, pa.array(tkey), pa.array(lo), pa.array(n.astype(np.int32)), pa.array(d.astype(np.int32))]
    columns += [pa.array(x) for x in names]
    columns.append(pa.array(np.zeros(len(lo), bool) if witness is None else witness))
    return pa.RecordBatch.from_arrays(
        columns, names=["doc_id", "tkey", "lo", "n", "d", "core", "f1", "f2", "witness"]
    )


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, int, bytes]]]:
    """Groups of (document, offset, windows, bytes) of about `PIECE` bytes."""
    held, size = [], 0
    for i, text in enumerate(texts):
        windows = len(text) - LENGTH + 1
        for start in range(0, max(windows, 0), PIECE):
            own = min(PIECE, windows - start)
            part = text[start : start + own + LENGTH - 1]
            if size + len(part) > PIECE + LENGTH and held:
                yield held
                held, size = [], 0
            held.append((i, start, own, part))
            size += len(part)
    if held:
        yield held


def _parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.encode() for t in batch.column(2).to_pylist()]
        keys = batch.column(1).to_numpy()
        for group in _pieces(texts):
            data = np.frombuffer(b"".join(p[3] for p in group), np.uint8)
            begin = np.cumsum([0] + [len(p[3]) for p in group])
            usable = np.zeros(len(data) - LENGTH + 1, bool)
            for b, p in zip(begin, group):
                usable[b : b + p[2]] = True
            at, low, high = parse(data, usable)
            names = _Names(data).blocks(at, low, high, LEVELS[0])
            piece = np.searchsorted(begin, at - high, side="right") - 1
            doc = np.array([p[0] for p in group])[piece]
            shift = np.array([p[1] for p in group])[piece] - begin[piece]
            yield _batch(
                batch.column(0).take(pa.array(doc)), keys[doc], at - high + shift, high - low, high, names
            )


def _refine(size: int):
    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = np.frombuffer(batch.column(2)[i].as_py().encode(), np.uint8)
                blocks = batch.column(3)[i].values
                lo, n, d = (blocks.field(k).to_numpy().astype(np.int64) for k in range(3))
                witness = blocks.field(3).to_numpy(zero_copy_only=False)
                for start in range(0, len(text), PIECE):
                    mine = (lo >= start) & (lo < start + PIECE)
                    if not mine.any():
                        continue
                    owner, at, low, high = _split(lo[mine] - start, n[mine], d[mine], size)
                    part = text[start : start + PIECE + _OVERLAP]
                    names = _Names(part).blocks(at, low, high, size)
                    rows = len(owner)
                    yield _batch(
                        batch.column(0)[i : i + 1].take(pa.array(np.zeros(rows, np.int64))),
                        np.full(rows, batch.column(1)[i].as_py()),
                        at - high + start,
                        high - low,
                        high,
                        names,
                        witness[mine][owner],
                    )

    return refine


def _judged(names: DataFrame, last: bool) -> DataFrame:
    """(doc_id, tkey, done, open): per document the windows found repeated and the blocks to split.

    A settled block may hold a window that an unsettled one repeats, so of every settled name beside an unsettled
    block (the same core) one block goes on to the next level as witness.
    """
    # Counts are staged before they are joined: in one stage with the join, they would keep a name
    # that a third of all rows share from being split.
    shared = names.groupBy("core").agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").drop("_c")
    likely = staged(names.join(staged(shared, "pfp-shared"), "core"), "pfp-likely")
    spanned = staged(
        likely.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("_f")).where("_f > 1"), "pfp-spanned"
    )
    found = likely.join(spanned, ["f1", "f2"], "left").withColumn("_repeated", F.col("_f").isNotNull())
    no_block = F.lit(None).cast("struct<lo:bigint,n:int,d:int,witness:boolean>")
    no_span = F.lit(None).cast("struct<lo:bigint,hi:bigint>")
    window_end = F.col("lo") + F.col("n") + LENGTH
    key = ["doc_id", "tkey"]
    if last:
        rows = found.where("_repeated and not witness").select(
            *key, F.struct("lo", window_end.alias("hi")).alias("done"), no_block.alias("open")
        )
    else:
        found = staged(found, "pfp-found")
        done = found.where("_repeated and not witness").select(
            *key, F.struct("lo", window_end.alias("hi")).alias("done"), no_block.alias("open")
        )
        unsettled = found.where("not _repeated and not witness")
        split = unsettled.select(
            *key, no_span.alias("done"), F.struct("lo", "n", "d", "witness").alias("open")
        )
        # Staged for the same reason as the counts above.
        cores = staged(unsettled.select("core").distinct(), "pfp-cores")
        beside = (
            found.where("_repeated or witness")
            .join(cores, "core", "left_semi")
            .groupBy("core", "f1", "f2")
            .agg(F.min(F.struct(*key, "lo", "n", "d")).alias("_w"))
        )
        block = F.struct("_w.lo", "_w.n", "_w.d", F.lit(True).alias("witness"))
        witnesses = beside.select("_w.doc_id", "_w.tkey", no_span.alias("done"), block.alias("open"))
        rows = done.unionByName(split).unionByName(witnesses)
    return rows.groupBy(*key).agg(
        F.collect_set("done").alias("done"), F.collect_set("open").alias("open")
    )


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for lo, hi in sorted(spans):
        if merged and lo <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], hi)
        else:
            merged.append([lo, hi])
    return [(a, b) for a, b in merged]


def _apply(keep: bool):
    """Finish the documents without unsettled blocks; the others keep their text."""
    fields = [
        ("doc_id", pa.int64()),
        ("tkey", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept", pa.string()),
        ("text", pa.string()),
        ("done", pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))),
        (
            "open",
            pa.list_(
                pa.struct(
                    [("lo", pa.int64()), ("n", pa.int32()), ("d", pa.int32()), ("witness", pa.bool_())]
                )
            ),
        ),
    ]

    def finish(doc_id, tkey, text, done, fresh, unsettled):
        spans = _merge([(s["lo"], s["hi"]) for s in (*(done or ()), *(fresh or ()))])
        as_rows = [{"lo": a, "hi": b} for a, b in spans]
        if unsettled:
            return doc_id, tkey, None, None, None, None, None, text, as_rows, unsettled
        raw = text.encode()
        cuts = [0, *(x for span in spans for x in span), len(raw)]
        kept = b"".join(raw[a:b] for a, b in zip(cuts[::2], cuts[1::2]))
        removed = sum(b - a for a, b in spans)
        whole_text = kept.decode(errors="ignore") if keep else None
        digest = hashlib.sha256(kept).hexdigest()
        return doc_id, tkey, len(raw), removed, len(spans), digest, whole_text, None, as_rows, None

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [finish(*row) for row in zip(*(c.to_pylist() for c in batch.columns))]
            columns = zip(*rows) if rows else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, (_, t) in zip(columns, fields)],
                names=[f[0] for f in fields],
            )

    return apply


def _decided(texts: DataFrame, verdicts: DataFrame, keep: bool) -> DataFrame:
    """Join verdicts to `texts` (doc_id, tkey, text, before) and apply them."""
    found = verdicts.withColumnsRenamed({"doc_id": "_id", "tkey": "_tkey"})
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tkey") == F.col("_tkey"))
    joined = texts.join(found, same, "left").select(
        "doc_id", "tkey", "text", "before", "done", "open"
    )
    return staged(joined.mapInArrow(_apply(keep), STATE), "pfp-state")


def cut_repeats(docs: DataFrame, keep: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept, spans), a row per document.

    `spans` are the removed runs of bytes. `kept` is the remaining text if `keep` is set; bytes of a character that is cut
    in two are left out of it.
    """
    keyed = docs.select("doc_id", F.xxhash64(whole("text")).alias("tkey"), whole("text").alias("text"))
    names = staged(keyed.mapInArrow(_parse_all, NAMES), "pfp-names")
    no_spans = F.lit(None).cast("array<struct<lo:bigint,hi:bigint>>")
    state = _decided(keyed.withColumn("before", no_spans), _judged(names, False), keep)
    finished = state.where("text is null")
    for size in LEVELS[1:]:
        unsettled = state.where("text is not null")
        names = unsettled.select("doc_id", "tkey", "text", "open").mapInArrow(_refine(size), NAMES)
        verdicts = _judged(staged(names, "pfp-names"), size == 1)
        before = unsettled.select("doc_id", "tkey", "text", F.col("done").alias("before"))
        state = _decided(before, verdicts, keep)
        finished = finished.unionByName(state.where("text is null"))
    return finished.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        "kept_sha256",
        "kept",
        F.col("done").alias("spans"),
    )
