"""Mixing sources to target weights by subset-sum budget fitting.

Every source has a target in words. A source is taken whole as often as its target holds it; the budget
that is left is smaller than the source and is fitted exactly where that can be done: documents are
counted by exact length, every length gives the same share of its words, what does not come to a whole document being
carried on to the next length, and a bounded-knapsack dynamic program over what remains of the counts closes the rest,
which is less than two of the longest documents. So a length's chance depends neither on the length nor on the size of
its source. The program sees counts by length only, never documents. Where the carrying starts is
seeded by the source, and which documents of a length are taken by a seeded hash.

What grows with the corpus stays on Spark: counting, the election within a length (by hash
buckets, so that a length that a third of all rows share is no single group), the join of the decision. The
dynamic program runs once per source over its distinct lengths, of which there are at most as many as
the longest document has words; its bit set has a bit for each word of what is left.

Defined cases: a null or blank text has size 0 and is never taken. A null source is a source of its own, last
in order. Repeated rows count and are elected each for itself. A corpus without words takes nothing.
Extra columns are kept by `mix`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.llm.common import whole
from reelhouse.operators.ranking import rank_within
from reelhouse.session import staged

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = 17
HASH_BUCKETS = 1024
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: str | Column) -> Column:
    """Words of the whole text."""
    return F.regexp_count(whole(text), F.lit(WORD)).cast("long")


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """(_source, source_size, target) from `sizes` (_source, size).

    Sources are ranked by code point and weigh `weights` in turn. A target stops at `most` times its
    source's size; what is beyond goes to the others by weight until none is above.
    """
    totals = staged(
        sizes.groupBy("_source").agg(F.sum("size").alias("source_size")).withColumn("_all", F.lit(0)),
        "mix-sources",
    )
    ranked = rank_within(totals, "_all", "_source", "_rank")
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("_rank") % len(weights) + 1).cast("int")
    )
    weighed = staged(
        ranked.select("_source", "source_size", weight.cast("decimal(38,0)").alias("_weight")),
        "mix-sources",
    )
    cap = F.col("source_size").cast("decimal(38,0)") * most
    # The level at which uncapped targets stand per unit of weight, as an exact fraction; each
    # round caps what stands above it, so the level only rises. One aggregate a round.
    level, capped = (0, 1), -1
    while True:
        above = cap * level[1] < F.col("_weight") * level[0]
        n, kept, size, weight_left = weighed.agg(
            F.count(F.when(above, 1)),
            F.sum(F.when(above, cap)),
            F.sum("source_size"),
            F.sum(F.when(~above, F.col("_weight"))),
        ).first()
        if n == capped or not size or not weight_left:
            break
        capped, level = n, (int(size) - int(kept or 0), int(weight_left))
    per_weight = level[0] / level[1]
    return weighed.select(
        "_source",
        "source_size",
        F.least(
            (F.col("source_size") * most).cast("double"), F.col("_weight").cast("double") * per_weight
        ).alias("target"),
    )


def fit_budget(
    lengths: Sequence[int], counts: Sequence[int], budget: int, phase: float = 0.0
) -> list[int]:
    """How many documents of each length to take so that their words come to `budget`.

    Never above it; what the counts left over by the even share can close is closed exactly. `phase`, 0 to 1, shifts
    at which lengths the carried words come to a document.
    """
    order = sorted((n, c, i) for i, (n, c) in enumerate(zip(lengths, counts)) if n > 0 and c > 0)
    total = sum(n * c for n, c, _ in order)
    taken = [0] * len(lengths)
    if budget >= total:
        for _, c, i in order:
            taken[i] = c
        return taken
    if not order:
        return taken
    start = int(phase * order[-1][0])
    if 2 * budget <= total:
        rest = budget - _even(order, taken, budget, start)
        _close(order, taken, rest, rest)
        return taken
    # Above one half the same is done for what is not taken, which then comes to no less than its share.
    spared, spare = [0] * len(lengths), total - budget
    rest = spare - _even(order, spared, spare, start)
    _close(order, spared, rest, rest + order[-1][0])
    for _, c, i in order:
        taken[i] = c - spared[i]
    return taken


def _even(order: list[tuple[int, int, int]], taken: list[int], budget: int, start: int) -> int:
    """The same share of every length, in `taken`; returns its words, below the budget by two documents at most."""
    total = sum(n * c for n, c, _ in order)
    # Words due up to a length less those taken never come to the longest document.
    passed, used = 0, 0
    for n, c, i in order:
        passed += n * c
        due = passed * budget // total - start
        taken[i] = min(c, max(0, due - used) // n)
        used += taken[i] * n
    return used


def _close(order: list[tuple[int, int, int]], taken: list[int], goal: int, limit: int) -> int:
    """Bounded knapsack over the counts not yet taken; sums are bits of one integer.

    Adds documents of `goal` words to `taken`; if that cannot be, of the least sum up to `limit` above it, or else of
    the largest below. For each sum only the piece that first reached it is kept: what is left without the piece was
    reached before it, so going back uses every piece once at most and no count is exceeded.
    """
    mask = (1 << (limit + 1)) - 1
    reached, steps = 1, []
    for n, c, i in order:
        left, piece = c - taken[i], 1
        if n > limit or (reached >> goal) & 1:
            break
        while left > 0:  # 1, 2, 4, ... documents at a time make up every number up to the count
            piece = min(piece, left)
            new = (reached << (n * piece)) & mask & ~reached if n * piece <= limit else 0
            if new:
                reached |= new
                steps.append((new, n, i, piece))
            left -= piece
            piece *= 2
    above = reached >> goal
    best = goal + (above & -above).bit_length() - 1 if above else reached.bit_length() - 1
    at = best
    for new, n, i, piece in reversed(steps):
        if (new >> at) & 1:
            taken[i] += piece
            at -= n * piece
    return best


def _plan(histogram: pd.DataFrame) -> pd.DataFrame:
    """Whole copies and fitted extras of one source's lengths."""
    size, target = int(histogram["source_size"].iloc[0]), histogram["target"].iloc[0]
    budget = min(round(target), MOST_COPIES * size)
    copies = budget // size if size else 0
    extra = fit_budget(
        histogram["size"].tolist(),
        histogram["n"].tolist(),
        budget - copies * size,
        float(histogram["phase"].iloc[0]),
    )
    return histogram.assign(copies=copies, extra=extra)[
        ["_source", "size", "source_size", "target", "copies", "extra"]
    ]


def decide(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """(doc_id, size, source_size, target, copies): how often the mix takes each document."""
    named = F.when(F.col("source").isNull(), "1").otherwise(F.concat(F.lit("0"), "source"))
    u = F.xxhash64(F.lit(seed), "doc_id", F.length("text"))
    sized = staged(
        docs.select(
            "doc_id",
            named.alias("_source"),
            size_of("text").alias("size"),
            u.alias("_u"),
            F.pmod(u, F.lit(HASH_BUCKETS)).cast("int").alias("_bucket"),
        ),
        "mix-sizes",
    )
    wanted = targets(sized, weights)
    buckets = sized.groupBy("_source", "size", "_bucket").agg(F.count(F.lit(1)).alias("_here"))
    histogram = buckets.groupBy("_source", "size").agg(F.sum("_here").alias("n"))
    phase = F.pmod(F.xxhash64(F.lit(seed), "_source"), F.lit(1 << 20)) / (1 << 20)
    planned = (
        histogram.join(wanted, "_source")
        .withColumn("phase", phase)
        .groupBy("_source")
        .applyInPandas(
            _plan,
            "_source string, size long, source_size long, target double, copies long, extra long",
        )
    )
    # Buckets are taken in order until the extras of a length are used up: at most
    # HASH_BUCKETS rows a group.
    before = W.partitionBy("_source", "size").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    shares = (
        buckets.withColumn("_before", F.coalesce(F.sum("_here").over(before), F.lit(0)))
        .join(planned, ["_source", "size"])
        .withColumn("_share", F.greatest(F.lit(0), F.least("_here", F.col("extra") - F.col("_before"))))
        .drop("_before", "extra")
    )
    joined = sized.join(shares, ["_source", "size", "_bucket"])
    whole_bucket = (F.col("_share") == 0) | (F.col("_share") == F.col("_here"))
    settled = joined.where(whole_bucket).withColumn("_more", (F.col("_share") > 0).cast("long"))
    first = F.row_number().over(
        W.partitionBy("_source", "size", "_bucket").orderBy("_u", "doc_id")
    )
    cut = joined.where(~whole_bucket).withColumn("_more", (first <= F.col("_share")).cast("long"))
    return settled.unionByName(cut).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.when(F.col("size") > 0, F.col("copies") + F.col("_more")).otherwise(0).alias("copies"),
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, seed: int = SEED) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of `docs`.

    Rows that share an id and a size share the copies decided for them as evenly as it goes.
    """
    # The row travels as one value, so that no name of its columns can clash.
    named = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col("doc_id").alias("_doc"),
        size_of("text").alias("_size"),
        F.xxhash64("text").alias("_hash"),
    )
    chosen = (
        decide(docs, weights, seed)
        .groupBy(F.col("doc_id").alias("_id"), F.col("size").alias("_words"))
        .agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
        .where("_copies > 0")
    )
    joined = named.join(
        chosen, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_size") == F.col("_words"))
    )
    each = F.floor(F.col("_copies") / F.col("_rows"))
    over = F.col("_copies") % F.col("_rows")
    # Only where repeated rows cannot share evenly does it matter which row is which.
    even = joined.where("_copies % _rows = 0").withColumn("_times", each)
    number = F.row_number().over(W.partitionBy("_id", "_words").orderBy("_hash"))
    uneven = joined.where("_copies % _rows > 0").withColumn(
        "_times", each + (number <= over).cast("long")
    )
    return (
        even.unionByName(uneven)
        .where("_times > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_times")))
        .select("_row.*")
    )
