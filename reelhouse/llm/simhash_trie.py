"""SimHash near-duplicates found by a self-join of a binary trie.

A text's fingerprint has a bit set where more than half of its three-word shingles have it
set in their XXH64. All distinct fingerprints form a binary trie, most significant bit
first. Pairs of trie nodes are walked down together, each with the number of bits in which
their paths differ; a pair beyond the error budget is dropped with all that lies below.

The walk runs on Spark while a node holds more than `NODE_LIMIT` fingerprints (`STRIDE` bits a
step, children paired by equi-joins over the few byte differences the budget allows), and inside a
task below that, where a pair of nodes is two sorted arrays. A task returns a spanning
forest of the links it found, never the links themselves, so a dense cluster costs as many rows as
it has members. Components come from the star steps in `operators/components.py`.

Defined cases: null and empty texts, and texts of blanks only, have the fingerprint zero, which links
like any other. Texts of one or two words have one shingle, the whole. Copies share a
fingerprint and meet the trie once. A null doc_id keeps its row; a component whose ids are all null has a
null id. Repeated rows come back as often as they came in. Further columns of the input
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.common import whole
from reelhouse.operators.components import connected_components
from reelhouse.session import joinable, staged

SEED = 42
SHINGLE = 3
BUDGET = 2
STRIDE = 4
NODE_LIMIT = 8192
BITS = 64

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes) -> int:
    """Unsigned 64-bit SimHash of one UTF-8 text."""
    # bytes.split() takes exactly the six blanks \x20 and \x09-\x0D.
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    if len(words) <= SHINGLE:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[: -SHINGLE]]).tolist()
    stops = (ends[SHINGLE - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, stops)], dtype="<u8")
    set_bits = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i : i + 65536].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    chosen = np.flatnonzero(2 * set_bits > len(hashes)).tolist()
    return sum(1 << b for b in chosen)


@F.pandas_udf(T.LongType())
def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in texts:
        made = np.array([fingerprint(t.encode()) for t in series], dtype=np.uint64)
        yield pd.Series(made.view(np.int64))


def fingerprint_column(text: str | Column) -> Column:
    """The fingerprint as a signed long."""
    return _fingerprints(whole(text))


def hex16(fp: str | Column) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def link_forest(fps: DataFrame, budget: int = BUDGET, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(u, v): edges that connect all distinct fingerprints within `budget` bits of each other.

    `fps` has one column `fp`, distinct. Two fingerprints are connected by the edges exactly if a
    chain of links joins them.
    """
    found: DataFrame | None = None
    frontier = _children_pairs(fps, None, STRIDE, budget)
    for depth in range(STRIDE, BITS + 1, STRIDE):
        path = F.shiftrightunsigned("fp", BITS - depth)
        counts = fps.groupBy(path.alias("node")).agg(F.count(F.lit(1)).alias("size"))
        sized = (
            frontier.join(counts.select(F.col("node").alias("a"), F.col("size").alias("size_a")), "a")
            .join(counts.select(F.col("node").alias("b"), F.col("size").alias("size_b")), "b")
        )
        sized = staged(sized, "trie")
        small = (F.col("size_a") <= node_limit) & (F.col("size_b") <= node_limit)
        if depth == BITS:
            small = F.lit(True)
        pairs = sized.where(small)
        large = sized.where(~small)
        # A node in a small pair may be large only beside a large partner, so arrays stay short.
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        members = (
            fps.select(path.alias("node"), "fp")
            .join(wanted, "node", "left_semi")
            .groupBy("node")
            .agg(F.collect_list("fp").alias("fps"))
        )
        here = (
            pairs.join(members.select(F.col("node").alias("a"), F.col("fps").alias("fps_a")), "a")
            .join(members.select(F.col("node").alias("b"), F.col("fps").alias("fps_b")), "b")
            .select("a", "b", "diff", "fps_a", "fps_b")
            .mapInArrow(_walker(depth, budget), "u long, v long")
        )
        found = here if found is None else found.unionByName(here)
        if large.isEmpty():
            break
        frontier = _children_pairs(fps, large, depth + STRIDE, budget)
    return found


def _children_pairs(
    fps: DataFrame, parents: DataFrame | None, depth: int, budget: int
) -> DataFrame:
    """(a, b, diff): pairs of nodes at `depth` below the pairs `parents`, or below the root."""
    nodes = fps.select(F.shiftrightunsigned("fp", BITS - depth).alias("node")).distinct()
    low = F.lit((1 << STRIDE) - 1)
    masks = F.array(
        *(
            F.struct(F.lit(m).alias("mask"), F.lit(m.bit_count()).alias("more"))
            for m in range(1 << STRIDE)
            if m.bit_count() <= budget
        )
    )
    if parents is None:
        above = nodes.select("node", F.lit(0).alias("a"), F.lit(0).cast("long").alias("b"), F.lit(0).alias("diff"))
    else:
        above = nodes.withColumn("a", F.shiftrightunsigned("node", STRIDE)).join(parents, "a")
    other = F.shiftleft("b", STRIDE).bitwiseOR(F.col("node").bitwiseAND(low).bitwiseXOR(F.col("mask")))
    met = (
        above.select("node", "a", "b", "diff", F.inline(masks))
        .withColumn("diff", F.col("diff") + F.col("more"))
        .where(F.col("diff") <= budget)
        .withColumn("other", other)
        # Below one and the same node, each pair of children is met from either side.
        .where((F.col("a") != F.col("b")) | (F.col("node") <= F.col("other")))
        .join(nodes.select(F.col("node").alias("other")), "other", "left_semi")
    )
    return staged(met.select(F.col("node").alias("a"), F.col("other").alias("b"), "diff"), "trie")


def _walker(depth: int, budget: int):
    def walk(batches):
        import pyarrow as pa

        for batch in batches:
            us, vs = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            columns = [batch.column(i) for i in range(5)]
            for i in range(batch.num_rows):
                a, b, diff = (columns[k][i].as_py() for k in range(3))
                left, right = (
                    np.sort(columns[k][i].values.to_numpy(zero_copy_only=False).view(np.uint64))
                    for k in (3, 4)
                )
                u, v = forest(left, right, a == b, depth, diff, budget)
                us.append(u.view(np.int64))
                vs.append(v.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"]
            )

    return walk


def forest(
    left: np.ndarray, right: np.ndarray, same: bool, depth: int, diff: int, budget: int
) -> tuple[np.ndarray, np.ndarray]:
    """Walk two sorted tries together; edges that connect all pairs within the budget."""
    la, lb = np.array([0]), np.array([0])
    ha, hb = np.array([len(left)]), np.array([len(right)])
    differing = np.array([diff])
    for bit in range(BITS - depth - 1, -1, -1):
        if not len(la):
            break
        middle_a, middle_b = _split(left, la, ha, bit), _split(right, lb, hb, bit)
        parts = []
        for x, y in ((0, 0), (1, 1), (0, 1), (1, 0)):
            a0, a1 = (la, middle_a) if x == 0 else (middle_a, ha)
            b0, b1 = (lb, middle_b) if y == 0 else (middle_b, hb)
            d = differing + (x != y)
            keep = (a0 < a1) & (b0 < b1) & (d <= budget)
            if same:
                keep &= a0 <= b0
            parts.append((a0[keep], a1[keep], b0[keep], b1[keep], d[keep]))
        la, ha, lb, hb, differing = (np.concatenate([p[k] for p in parts]) for k in range(5))
    keep = left[la] != right[lb]
    la, lb = la[keep], lb[keep]
    if not len(la):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return _span(left[la], right[lb])


def _split(keys: np.ndarray, low: np.ndarray, high: np.ndarray, bit: int) -> np.ndarray:
    """Where, within low..high, the keys with this bit set begin."""
    one = np.uint64(1 << bit)
    first = keys[low] & ~np.uint64((1 << (bit + 1)) - 1) | one
    return np.clip(np.searchsorted(keys, first), low, high)


def _span(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node with the least node of its component, instead of all links."""
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = index[: len(u)], index[len(u) :]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def near_duplicates(docs: DataFrame, budget: int = BUDGET, node_limit: int = NODE_LIMIT) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per document."""
    prints = staged(docs.select("doc_id", fingerprint_column("text").alias("fp")), "simhash")
    return components_of(prints, budget, node_limit).select(
        "doc_id", hex16("fp").alias("fingerprint"), "component_id"
    )


def components_of(
    prints: DataFrame, budget: int = BUDGET, node_limit: int = NODE_LIMIT
) -> DataFrame:
    """`prints` (doc_id, fp, ...) with `component`, the least fingerprint of each row's component, and
    `component_id`, its least doc_id."""
    least = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash")
    edges = staged(link_forest(least.select("fp"), budget, node_limit).distinct(), "simhash")
    reached = connected_components(edges, "u", "v")
    linked = least.join(reached, F.col("fp") == F.col("node"))
    named = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    # Fingerprints without a link keep their own least id.
    final = (
        least.join(reached.withColumnRenamed("node", "fp"), "fp", "left")
        .join(joinable(named), "component", "left")
        .select(
            "fp",
            F.coalesce("component", "fp").alias("component"),
            F.when(F.col("component").isNull(), F.col("least"))
            .otherwise(F.col("component_id"))
            .alias("component_id"),
        )
    )
    # Staged, so that both sides of the join come from a shuffle of their own and a fingerprint
    # that a third of all documents share is split.
    return prints.join(staged(final, "simhash"), "fp")


def keep_one(docs: DataFrame, budget: int = BUDGET) -> DataFrame:
    """One document of each component: the one with the least id, of repeated ids the least fingerprint."""
    # The row travels as one value, so that no name of its columns can clash.
    row = F.struct(*docs.columns).alias("row")
    hashed = docs.select(
        "doc_id", fingerprint_column("text").alias("_fp"), F.xxhash64("text").alias("hash"), row
    )
    marked = staged(hashed, "simhash-docs")
    grouped = components_of(marked.select("doc_id", F.col("_fp").alias("fp")), budget)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp")).alias("first")
    kept = grouped.groupBy("component").agg(first).select(
        F.col("first.doc_id").alias("_id"), F.col("first.fp").alias("_kept")
    )
    found = marked.join(
        kept, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_fp") == F.col("_kept"))
    )
    same = W.partitionBy("doc_id", "_fp").orderBy("hash")
    return found.withColumn("nth", F.row_number().over(same)).where("nth = 1").select("row.*")
