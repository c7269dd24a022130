"""Document fingerprints from closed syncmers.

A text is read as a sequence of tokens: runs of letters, marks and digits, cut after `TOKEN_CHARS`
characters, and single characters of scripts written without blanks. A k-mer is `K` tokens in a row. It is a
closed syncmer if the least of the hashes of its inner runs of `S` tokens is the first or the
last of them. Whether a k-mer is one depends on nothing but the k-mer, so two texts that share a passage choose
the same anchors in it, wherever it stands.

`with_anchors` gives every syncmer with its position, for matching passages by position. A fingerprint keeps, of the
distinct syncmer hashes, all in the lowest `1 / RATE` of their range, and the `SKETCH` least where those are fewer. So it
grows with the text: two texts of any length that share a passage of some 60 words nearly always share an entry. `likeness`
compares two fingerprints: of the least hashes of both together, as far down as both reach, the share that both
have. That is an estimate of the Jaccard similarity of the texts' syncmers, and exact while these number less than
`SKETCH`. Built-in functions only.

Defined cases: null and empty texts, and texts without a token, have the fingerprint ''. Two of
those are alike (1), one of those and another are not (0). A text of fewer than `K` tokens has one anchor,
all of it. Equal texts have equal fingerprints. Null ids come last in descending order; rows that
share an id follow each other by text. A single row is its own next document. Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.llm.common import whole

K = 5
S = 2
SKETCH = 64
RATE = 8
DIGITS = 12
TOKEN_CHARS = 16
# Ranges of ids the texts are dealt to, for each shuffle partition.
RANGES_PER_PARTITION = 4
TOKEN = (
    r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}]"
    rf"|[\p{{L}}\p{{M}}\p{{N}}]{{1,{TOKEN_CHARS}}}"
)


def with_anchors(df: DataFrame, text: str, name: str, k: int = K, s: int = S) -> DataFrame:
    """Add array<struct<pos, hash>>: the closed syncmers of `text`, by token position."""
    t, h, inner = f"_{name}_tokens", f"_{name}_hashes", f"_{name}_inner"
    made = df.withColumn(t, F.regexp_extract_all(whole(text), F.lit(TOKEN), F.lit(0)))
    made = made.withColumn(h, F.transform(t, lambda w: F.xxhash64(w)))
    hashes, n = F.col(h), F.size(h)

    def run(i: Column, length: int) -> Column:
        """Hash of `length` tokens from i."""
        return F.xxhash64(*(F.get(hashes, i + j) for j in range(length)))

    at = F.when(n >= s, F.sequence(F.lit(0), n - s)).otherwise(F.array().cast("array<int>"))
    made = made.withColumn(inner, F.transform(at, lambda i: run(i, s)))
    spots = F.when(n >= k, F.sequence(F.lit(0), n - k)).otherwise(F.array().cast("array<int>"))
    last = k - s

    def closed(i: Column) -> Column:
        values = [F.get(F.col(inner), i + j) for j in range(last + 1)]
        least = F.least(*values)
        return (values[0] == least) | (values[last] == least)

    chosen = F.transform(
        F.filter(spots, closed), lambda i: F.struct(i.alias("pos"), run(i, k).alias("hash"))
    )
    short = F.array(F.struct(F.lit(0).alias("pos"), F.xxhash64(F.array_join(t, " ")).alias("hash")))
    none = F.array().cast("array<struct<pos:int,hash:bigint>>")
    return made.withColumn(
        name, F.when(n == 0, none).when(n < k, short).otherwise(chosen)
    ).drop(t, h, inner)


def with_fingerprint(df: DataFrame, text: str, name: str, sketch: int = SKETCH) -> DataFrame:
    """Add the fingerprint of `text`: hex hashes in order, each of `DIGITS` digits."""
    anchored = with_anchors(df, text, f"_{name}_anchors")
    # As unsigned prefixes of equal width, so that text order is number order.
    prefix = F.transform(
        F.col(f"_{name}_anchors"),
        lambda a: F.shiftrightunsigned(a["hash"], 64 - 4 * DIGITS),
    )
    ordered = F.sort_array(F.array_distinct(prefix))
    low = F.size(F.filter(prefix, lambda v: v < (1 << 4 * DIGITS) // RATE))
    # Counted with repeats; where that is too many, the entries themselves tell.
    least = F.slice(ordered, 1, F.greatest(F.lit(sketch), low))
    least = F.filter(least, lambda v, i: (i < sketch) | (v < (1 << 4 * DIGITS) // RATE))
    text_of = F.array_join(
        F.transform(least, lambda v: F.lower(F.lpad(F.hex(v), DIGITS, "0"))), ""
    )
    return anchored.withColumn(name, text_of).drop(f"_{name}_anchors")


def likeness(a: str | Column, b: str | Column, sketch: int = SKETCH) -> Column:
    """How alike two fingerprints are, 0 to 1."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))

    def parts(c: Column) -> Column:
        return F.regexp_extract_all(c, F.lit(rf".{{{DIGITS}}}"), F.lit(0))

    def reach(c: Column) -> Column:
        """How many of its least hashes a fingerprint holds: all there are if it is short."""
        n = F.length(c) / DIGITS
        return F.when(n < sketch, F.lit((1 << 31) - 1)).otherwise(n).cast("int")

    both = F.slice(F.sort_array(F.array_union(parts(a), parts(b))), 1, F.least(reach(a), reach(b)))
    shared = F.size(F.array_intersect(F.array_intersect(parts(a), parts(b)), both))
    return F.when(a == b, F.lit(1.0)).otherwise(
        F.coalesce(shared / F.nullif(F.size(both), F.lit(0)), F.lit(0.0))
    )


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fingerprint, next_text, next_fingerprint), the next by descending id.

    Ids are dealt to ranges of about equal counts and each range is put in order by itself; the first
    document of every range is also sent to the range before, and the first of all to the last.
    """
    spark = docs.sparkSession
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = docs.select("doc_id", whole("text").alias("text"))
    shares = [i / n for i in range(1, n)]
    # n - 1 numbers, whatever the size of the corpus.
    cuts = sorted(set(read.agg(F.percentile_approx("doc_id", shares, 20 * n)).first()[0] or []))
    dealt = read.withColumn("_range", _range_of(cuts))
    keyed = dealt.withColumn("_tie", F.xxhash64("text"))
    order = F.struct(F.coalesce("doc_id", F.lit(-(2**63))), F.col("doc_id").isNotNull(), F.col("_tie"))
    # The first document of each range: n rows at most.
    firsts = keyed.groupBy("_range").agg(F.max(order).alias("_first"))
    before = W.orderBy(F.col("_range").desc())
    back = F.coalesce(
        F.lag("_range").over(before),
        F.min("_range").over(W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)),
    )
    sent = firsts.select("_first", back.alias("_back"))
    both = (
        keyed.withColumn("_order", order)
        .join(F.broadcast(sent), F.col("_order") == F.col("_first"), "left")
        .withColumn(
            "_to",
            F.explode(
                F.array_compact(
                    F.array(
                        F.struct(F.col("_range").alias("range"), F.lit(0).alias("copy")),
                        F.when(
                            F.col("_back").isNotNull(),
                            F.struct(F.col("_back").alias("range"), F.lit(1).alias("copy")),
                        ),
                    )
                )
            ),
        )
        .select("doc_id", "text", "_order", F.col("_to.range").alias("_in"), F.col("_to.copy").alias("_copy"))
        .repartition("_in")
    )
    marked = with_fingerprint(both, "text", "fingerprint")
    following = W.partitionBy("_in").orderBy("_copy", F.col("_order").desc())
    return (
        marked.select(
            "doc_id",
            "text",
            "fingerprint",
            "_copy",
            F.lead("text").over(following).alias("next_text"),
            F.lead("fingerprint").over(following).alias("next_fingerprint"),
        )
        .where("_copy = 0")
        .drop("_copy")
    )


def _range_of(cuts: list[int]) -> Column:
    """Number of cuts not above doc_id, looked up in two steps; null ids come lowest."""
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))

    def literal(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    def not_above(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= F.col("doc_id")))

    block = F.greatest(F.lit(0), not_above(literal(cuts[::step])) - 1) * step
    return block + not_above(F.slice(literal(cuts), block + 1, step))


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Each document against itself with its last third replaced by the start of the next one."""
    n = F.char_length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut)
    )
    paired = with_next(docs).withColumn("edited", edited)
    return with_fingerprint(paired, "edited", "edited_fingerprint")
