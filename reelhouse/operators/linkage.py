"""Record linkage of two catalogues without a shared key.

Rows that agree on everything the linkage looks at (tokens, exact block, banded
numbers) are copies and collapse into one group per side first. Candidate pairs,
similarities and the assignment all work on groups; single rows come back only at
the end, one per match. A title carried by a third of all rows is one group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.functions.keys import PART_SEPARATOR, composite_key
from reelhouse.operators.ranking import rank_within
from reelhouse.operators.setjoin import GROUP_LIMIT, similar_sets
from reelhouse.session import cut_lineage, staged

SLOTS_PER_ROW = 10_000


@dataclass(frozen=True)
class Band:
    """|a − b| ≤ width on a whole-number column of both sides.

    `unknown` lists the values that match anything on the other side (null is
    written None); without any, a null matches nothing.
    """

    column: str
    width: int
    unknown: tuple = ()

    def is_unknown(self, c: Column) -> Column:
        tests = [c.isNull() if u is None else F.coalesce(c == u, F.lit(False)) for u in self.unknown]
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    def keys(self, c: Column, asking: bool) -> Column:
        """Join keys under which the two sides of a fitting pair meet exactly once.

        The asking side looks into three neighbouring buckets; unknown values meet
        under keys of their own.
        """
        bucket = F.floor(c / max(self.width, 1)).cast("long")
        known = [bucket - 1, bucket, bucket + 1] if asking else [bucket]
        keys = F.array(*[k.cast("string") for k in known])
        if not self.unknown:
            return F.when(c.isNotNull(), keys).otherwise(F.array().cast("array<string>"))
        no_asker, no_answer = F.lit("asker unknown"), F.lit("answer unknown")
        if asking:
            known, missing = F.array_append(keys, no_answer), F.array(no_asker)
        else:
            known, missing = F.array_append(keys, no_asker), F.array(no_asker, no_answer)
        return F.when(self.is_unknown(c), missing).otherwise(known)

    def fits(self, a: Column, b: Column) -> Column:
        near = F.coalesce(F.abs(a - b) <= self.width, F.lit(False))
        return near | self.is_unknown(a) | self.is_unknown(b) if self.unknown else near


def year_band(left: DataFrame, right: DataFrame, a: str, b: str, width: int = 1) -> DataFrame:
    """Inner join on |a − b| ≤ width as an equi-join on the years around `a`.

    Every fitting pair comes out once, since `b` equals exactly one of them.
    """
    near = left.where(F.col(a).isNotNull()).withColumn(
        "join_year", F.explode(F.sequence(F.col(a) - width, F.col(a) + width))
    )
    return near.join(right, F.col("join_year") == F.col(b))


def _fields(bands: Sequence[Band], block: Sequence[str]) -> list[str]:
    return [*block, *[b.column for b in bands]]


def copy_group(tokens: str, block: Sequence[str], bands: Sequence[Band]) -> Column:
    """Id of the copies a row belongs to; a pure function of the row."""
    return F.md5(F.to_json(F.struct(tokens, *_fields(bands, block)), {"ignoreNullFields": "false"}))


def copy_groups(
    rows: DataFrame, key: str, tokens: str, block: Sequence[str], bands: Sequence[Band]
) -> DataFrame:
    """One row per group of copies: id, size, least key and what they agree on.

    Materialised, since ordering, pairing and scoring all start from it.
    """
    fields = _fields(bands, block)
    return cut_lineage(
        rows.groupBy(copy_group(tokens, block, bands).alias("id"), tokens, *fields).agg(
            F.count(F.lit(1)).alias("n"), F.min(key).alias("least_key")
        )
    )


def _blocked(
    groups: DataFrame, tokens: str, block: Sequence[str], bands: Sequence[Band], asking: bool
) -> DataFrame:
    lists = [b.keys(F.col(b.column), asking) for b in bands]
    # Every combination of one key per band, the exact block in front.
    combined = F.array(composite_key(*block) if block else F.lit(""))
    for keys in lists:
        combined = _combinations(combined, keys)
    attrs = F.struct(*[F.col(b.column) for b in bands], F.lit(0).alias("_"))
    return groups.select(
        combined.alias("blocks"), "id", F.col(tokens).alias("tokens"), attrs.alias("attrs")
    )


def _combinations(prefixes: Column, keys: Column) -> Column:
    pairs = F.transform(
        prefixes, lambda p: F.transform(keys, lambda k: F.concat_ws(PART_SEPARATOR, p, k))
    )
    return F.flatten(pairs)


def similar_groups(
    left: DataFrame,
    right: DataFrame,
    tokens: str = "tokens",
    block: Sequence[str] = (),
    bands: Sequence[Band] = (),
    threshold: float = 0.6,
    group_limit: int = GROUP_LIMIT,
) -> DataFrame:
    """(a, b, similarity) of groups of copies with Jaccard ≥ threshold, same block, fitting bands.

    Blocks are compared with case folded. Cheap conditions are part of the join
    key; token sets are compared only behind them.
    """
    fits = reduce(
        lambda x, y: x & y,
        [b.fits(F.col("attrs_a")[b.column], F.col("attrs_b")[b.column]) for b in bands],
        F.lit(True),
    )
    return similar_sets(
        _blocked(left, tokens, block, bands, asking=True),
        _blocked(right, tokens, block, bands, asking=False),
        threshold,
        fits,
        group_limit,
    )


def fuzzy_pairs(left: DataFrame, right: DataFrame, similar: DataFrame) -> DataFrame:
    """Similar groups with the number of rows and the least key on both sides."""
    a = left.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("least_key").alias("key_a"))
    b = right.select(F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("least_key").alias("key_b"))
    return similar.join(a, "a").join(b, "b")


def best_per_target(pairs: DataFrame, targets: DataFrame, key: str, group: Column) -> DataFrame:
    """(target, candidate, similarity): the most similar candidate of every target.

    Ties go to the lowest candidate key; a candidate may serve several targets.
    """
    best = pairs.groupBy("a").agg(
        F.min(F.struct((-F.col("similarity")).alias("s"), F.col("key_b").alias("k"))).alias("best")
    )
    return targets.select(F.col(key).alias("target"), group.alias("a")).join(best, "a").select(
        "target", F.col("best.k").alias("candidate"), (-F.col("best.s")).alias("similarity")
    )


def one_to_one_groups(pairs: DataFrame) -> DataFrame:
    """Greedy one-to-one assignment between groups: (a, b, similarity, taken, from_a, from_b).

    The order is similarity descending, then least target key, then least candidate key, and every pair takes as many
    rows as the smaller side has left. In every round each group shows its first two pairs. A pair that
    comes first on both sides is settled at once; one that comes first on one side and second on the other waits for
    a single pair, and takes what that leaves. Such chains are contracted by pointer doubling (`_settled`), so a chain
    of any length is settled in one round of logarithmically many steps. Each round uses up at least one group.
    """
    order = F.struct(
        (-F.col("similarity")).alias("s"), F.col("key_a").alias("ka"), F.col("key_b").alias("kb")
    )
    open_ = cut_lineage(
        pairs.select(
            "a",
            "b",
            "similarity",
            order.alias("o"),
            F.col("n_a").alias("left_a"),
            F.col("n_b").alias("left_b"),
            F.lit(0).cast("long").alias("from_a"),
            F.lit(0).cast("long").alias("from_b"),
        )
    )
    rounds: list[DataFrame] = []
    while not open_.isEmpty():
        settled = _settled(open_)
        if settled.isEmpty():
            raise AssertionError("a matching round settled nothing")
        rounds.append(settled.where("taken > 0"))
        # At most two settled pairs a group.
        used_a = settled.groupBy("a").agg(F.sum("taken").alias("_ka"))
        used_b = settled.groupBy("b").agg(F.sum("taken").alias("_kb"))
        ka, kb = (F.coalesce(c, F.lit(0)) for c in ("_ka", "_kb"))
        open_ = cut_lineage(
            open_.join(cut_lineage(used_a), "a", "left")
            .join(cut_lineage(used_b), "b", "left")
            .select(
                "a",
                "b",
                "similarity",
                "o",
                (F.col("left_a") - ka).alias("left_a"),
                (F.col("left_b") - kb).alias("left_b"),
                (F.col("from_a") + ka).alias("from_a"),
                (F.col("from_b") + kb).alias("from_b"),
            )
            .where("left_a > 0 AND left_b > 0")
        )
    if not rounds:
        return open_.withColumn("taken", F.col("left_a")).select(
            "a", "b", "similarity", "taken", "from_a", "from_b"
        )
    return reduce(DataFrame.unionByName, rounds)


def _settled(open_: DataFrame) -> DataFrame:
    """(a, b, similarity, taken, from_a, from_b) of the pairs that this round can settle.

    What a waiting pair takes, as a function of what the pair before it takes, is `-x + c` cut off at `low` and `high`.
    Such functions compose to functions `sign * x + c` of the same form, so a chain is contracted by letting every
    pair point past the pair it points to, twice as far in each step.
    """

    def first_two(side: str) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(side).orderBy("o"))
        return open_.withColumn(f"rank_{side}", rank).where(F.col(f"rank_{side}") <= 2)

    of_a, of_b = cut_lineage(first_two("a")), cut_lineage(first_two("b").select("a", "b", "rank_b"))
    before_a = of_a.where("rank_a = 1").select("a", F.col("b").alias("first_b"))
    before_b = of_b.where("rank_b = 1").select("b", F.col("a").alias("first_a"))
    small = F.least("left_a", "left_b")
    heads, by_a = (F.col("rank_a") + F.col("rank_b") == 2), F.col("rank_a") == 2
    chain = (
        of_a.join(of_b, ["a", "b"])
        .where("rank_a + rank_b < 4")
        .join(before_a, "a")
        .join(before_b, "b")
        .select(
            "a",
            "b",
            "similarity",
            "from_a",
            "from_b",
            by_a.alias("by_a"),
            # The pair waited for, and the one the function below is of.
            F.when(~heads, F.when(by_a, F.col("a")).otherwise(F.col("first_a"))).alias("wait_a"),
            F.when(~heads, F.when(by_a, F.col("first_b")).otherwise(F.col("b"))).alias("wait_b"),
            F.lit(-1).alias("sign"),
            F.when(by_a, F.col("left_a")).otherwise(F.col("left_b")).alias("c"),
            F.when(heads, small).otherwise(F.lit(0)).cast("long").alias("low"),
            small.alias("high"),
        )
        .withColumns({"to_a": F.col("wait_a"), "to_b": F.col("wait_b"), "stuck": F.lit(False)})
    )
    chain = cut_lineage(chain)
    names = ["sign", "c", "low", "high", "to_a", "to_b", "stuck"]
    while not chain.where("to_a is not null and not stuck").isEmpty():
        behind = chain.select(
            F.col("a").alias("to_a"), F.col("b").alias("to_b"), F.struct(*names).alias("p")
        )
        done = F.col("to_a").isNull() | F.col("stuck")
        met = chain.join(behind, ["to_a", "to_b"], "left")
        p, sign, c = F.col("p"), F.col("sign"), F.col("c")
        ends = (sign * p["low"] + c, sign * p["high"] + c)
        cut = [F.greatest("low", F.least("high", f(*ends))) for f in (F.least, F.greatest)]
        past = {
            "sign": sign * p["sign"],
            "c": sign * p["c"] + c,
            "low": cut[0],
            "high": cut[1],
            "to_a": p["to_a"],
            "to_b": p["to_b"],
            "stuck": p["stuck"],
        }
        # A pair that waits for one outside the chains stays where it is.
        chain = cut_lineage(
            met.select(
                *[x for x in chain.columns if x not in names],
                *[
                    F.when(done, F.col(x))
                    .when(p.isNull(), F.lit(True) if x == "stuck" else F.col(x))
                    .otherwise(past[x])
                    .alias(x)
                    for x in names
                ],
            )
        )
    settled = chain.where("to_a is null").withColumn("taken", F.col("low"))
    waited = settled.select(
        F.col("a").alias("wait_a"), F.col("b").alias("wait_b"), F.col("taken").alias("before")
    )
    before = F.coalesce("before", F.lit(0))
    return cut_lineage(
        settled.join(waited, ["wait_a", "wait_b"], "left").select(
            "a",
            "b",
            "similarity",
            "taken",
            F.when(F.col("by_a"), F.col("from_a") + before).otherwise(F.col("from_a")).alias("from_a"),
            F.when(F.col("by_a"), F.col("from_b")).otherwise(F.col("from_b") + before).alias("from_b"),
        )
    )


def _slots(taken: DataFrame) -> DataFrame:
    """One row per matched row pair; long runs are opened in two steps."""
    step = F.lit(SLOTS_PER_ROW).cast("long")
    runs = taken.withColumn("_start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1, step)))
    end = F.least(F.col("_start") + step, F.col("taken")) - 1
    return runs.withColumn("_i", F.explode(F.sequence("_start", end))).select(
        "a",
        "b",
        "similarity",
        (F.col("from_a") + F.col("_i")).alias("rank_a"),
        (F.col("from_b") + F.col("_i")).alias("rank_b"),
    )


def one_to_one(
    pairs: DataFrame,
    left: DataFrame,
    right: DataFrame,
    key: str,
    group: Column,
) -> DataFrame:
    """(target, candidate, similarity): at most one candidate per target and the reverse.

    Copies are handed out in key order. `group` is the copy group expression of
    both sides' rows (`copy_group`).
    """
    slots = _slots(one_to_one_groups(pairs))

    def members(rows: DataFrame, side: str, name: str) -> DataFrame:
        named = rows.select(F.col(key).alias(name), group.alias(side))
        involved = named.join(slots.select(side).distinct(), side, "left_semi")
        return rank_within(involved, side, name, f"rank_{side}")

    return (
        slots.join(members(left, "a", "target"), ["a", "rank_a"])
        .join(members(right, "b", "candidate"), ["b", "rank_b"])
        .select("target", "candidate", "similarity")
    )


def counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """`df` written to the shared folder, and how many rows that write saw.

    The count is an observed metric of the write itself, so nothing is read a second time to be counted. It is taken in
    the stage that writes, where a task counts once however often it runs.
    """
    seen = Observation()
    kept = staged(df.observe(seen, F.count(F.lit(1)).alias("rows")), label)
    return kept, seen.get["rows"]


def match_coverage(
    spark: SparkSession, scanned: int, cleaned: int, targets: int, matched: int
) -> DataFrame:
    """One row: candidate rows scanned and left after cleaning, targets, matches, their share."""
    counts = spark.createDataFrame(
        [(scanned, cleaned, targets, matched)], "scanned long, cleaned long, targets long, matched long"
    )
    return counts.withColumn("coverage", F.col("matched") / F.nullif(F.col("targets"), F.lit(0)))
