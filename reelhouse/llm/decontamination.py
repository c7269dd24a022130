"""Benchmark decontamination: n-gram hits of benchmark items in training documents.

Texts are lower-cased in A-Z and cut into words. A benchmark item's windows are all runs of `WINDOW` of its
words, or the whole item if it has fewer. The windows' hashes are the broadcast set; every run
of a document's words is looked up in it while the words are scanned, and each hit is verified
word by word. Hashes of runs are put together by doubling (1, 2, 4, 8 words, then two
overlapping runs of 8), so a run costs the same whatever its length. Built-in functions only.

The set is broadcast if it has at most `BROADCAST_WINDOWS` windows and `BROADCAST_BYTES` bytes, both
counted first. Beyond that the runs are shuffled, as hashes with their places, where adaptive execution splits a
frequent window, and the words are joined to those whose hash is found. Each document sends its hits and one row of its own
to one aggregate. With a broadcast set documents are scanned once and texts are never shuffled for the report.

Defined cases: null and empty texts have no words and no hits; an item without words has no window. Items
without an id are looked for, but not listed. Repeated document rows come back as often as they came in;
repeated items count once. Without items nothing is hit. Extra columns of either table
are ignored by `report` and kept by the functions that remove.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import lower_ascii, sha256_hex, whole
from reelhouse.session import staged

WINDOW = 13
BROADCAST_WINDOWS = 500_000
BROADCAST_BYTES = 64 << 20
# A document is contaminated if at least this share of its words is hit.
HIT_SHARE = 20
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def with_words(df: DataFrame, name: str = "_words") -> DataFrame:
    """Add the array of normalised words of `text`."""
    return df.withColumn(
        name, F.regexp_extract_all(lower_ascii(whole("text")), F.lit(WORD), F.lit(0))
    )


def with_run_hashes(df: DataFrame, lengths: list[int]) -> tuple[DataFrame, dict[int, str]]:
    """Add, for each length, the array of hashes of all runs of so many words."""
    made = df.withColumn("_run1", F.transform("_words", lambda w: F.xxhash64(w)))
    names, have = {1: "_run1"}, 1

    def joined(source: str, shift: int) -> Column:
        n = F.greatest(F.lit(0), F.size(source) - shift)
        return F.zip_with(
            F.slice(source, 1, n), F.slice(source, shift + 1, n), lambda x, y: F.xxhash64(x, y)
        )

    while have * 2 <= max(lengths, default=1):
        made = made.withColumn(f"_run{2 * have}", joined(f"_run{have}", have))
        have *= 2
        names[have] = f"_run{have}"
    for n in lengths:
        if n not in names:
            half = 1 << (n.bit_length() - 1)
            made = made.withColumn(f"_run{n}", joined(f"_run{half}", n - half))
            names[n] = f"_run{n}"
    return made, names


def windows(items: DataFrame, size: int = WINDOW) -> tuple[DataFrame, list[int]]:
    """Distinct windows (h, length, run, items) and their lengths."""
    spark = items.sparkSession
    read = with_words(items.select("item_id", "text")).withColumn(
        "_length", F.least(F.lit(size), F.size("_words"))
    )
    read = read.where("_length > 0")
    # At most `size` numbers.
    lengths = sorted((r[0] for r in read.select("_length").distinct().collect()), reverse=True)
    if not lengths:
        return spark.createDataFrame([], "h long, length int, run string, items array<string>"), []
    hashed, names = with_run_hashes(read, lengths)
    own = F.coalesce(*(F.when(F.col("_length") == n, F.col(names[n])) for n in lengths))
    each = hashed.select("item_id", "_length", "_words", F.posexplode_outer(own).alias("_at", "h"))
    run = F.concat_ws(" ", F.slice("_words", F.col("_at") + 1, F.col("_length")))
    return (
        each.groupBy("h", F.col("_length").alias("length"), run.alias("run")).agg(
            F.collect_set(F.col("item_id").cast("string")).alias("items")
        ),
        lengths,
    )


def report(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, _text, n_words, n_hit, items, spans, contaminated), a row per document.

    `items` are the ids of the items hit, sorted as strings; `spans` the runs of hit words as
    (start, stop), merged and in order; `_text` a hash of the text.
    """
    wanted, lengths = windows(items, size)
    wanted = staged(wanted, "windows")
    n, n_bytes = wanted.agg(F.count(F.lit(1)), F.sum(F.octet_length("run") + 32)).first()
    small = n <= BROADCAST_WINDOWS and (n_bytes or 0) <= BROADCAST_BYTES
    read = with_words(docs.select("doc_id", "text"))
    read = read.select("doc_id", F.xxhash64(whole("text")).alias("_text"), "_words")
    hashed, names = with_run_hashes(read, lengths)
    # The first element stands for the document itself and matches no window, so the array is never
    # empty. The outer form of explode keeps Spark from testing that below the projections, where it
    # would compute every hash again for the test.
    runs = F.concat(
        F.array(F.lit(None).cast("long")), *(F.col(names[k]) for k in lengths)
    )
    scanned = hashed.select(
        "doc_id",
        "_text",
        # Only a join without a shuffle may carry the words along with every run.
        *(["_words"] if small else []),
        F.size("_words").cast("long").alias("n_words"),
        runs.alias("_runs"),
    )
    each = scanned.select(*[c for c in scanned.columns if c != "_runs"], F.posexplode_outer("_runs").alias("_at", "_h"))
    # Where the runs of a length begin in the joined array.
    start, before = F.lit(None).cast("long"), F.lit(1).cast("long")
    for k in lengths:
        start = F.when(F.col("length") == k, F.col("_at") - before).otherwise(start)
        before = before + F.greatest(F.lit(0), F.col("n_words") - (k - 1))
    inside = (F.col("_start") >= 0) & (F.col("_start") + F.col("length") <= F.col("n_words"))
    seen = F.when(
        F.col("h").isNotNull() & inside,
        F.concat_ws(" ", F.slice("_words", F.col("_start") + 1, F.col("length"))),
    )
    same_hash = F.col("_h") == F.col("h")
    if small:
        found = each.join(F.broadcast(wanted), same_hash, "left").withColumn("_start", start.cast("int"))
        found = found.where((F.col("_at") == 0) | F.col("h").isNotNull())
    else:
        # Runs are shuffled as hashes; words are joined again to the runs whose hash is wanted.
        hashes = each.where(F.col("_h").isNotNull()).join(wanted, same_hash)
        hashes = staged(hashes.withColumn("_start", start.cast("int")), "window-hits")
        texts = read.groupBy("doc_id", "_text").agg(F.first("_words").alias("_words"))
        texts = texts.withColumnsRenamed({"doc_id": "_id", "_text": "_hash"})
        same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
        alone = each.where("_at = 0").select("doc_id", "_text", "n_words", "_at")
        found = hashes.join(texts, same).unionByName(alone, allowMissingColumns=True)
    hit = seen == F.col("run")
    kept = found.select(
        "doc_id",
        "_text",
        F.when(F.col("_at") == 0, F.col("n_words")).alias("n_words"),
        F.when(hit, F.struct("_start", (F.col("_start") + F.col("length")).alias("_stop"))).alias("_span"),
        F.when(hit, F.col("items")).alias("items"),
    )
    grouped = kept.groupBy("doc_id", "_text").agg(
        F.max("n_words").alias("n_words"),
        F.count("n_words").alias("_rows"),
        F.array_sort(F.collect_set("_span")).alias("_hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    merged = grouped.withColumn("spans", _merged(F.col("_hits")))
    counted = merged.withColumn(
        "n_hit",
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + (s["stop"] - s["start"])),
    ).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (HIT_SHARE * F.col("n_hit") >= F.col("n_words"))
    )
    repeated = counted.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), "_rows")))
    return repeated.select(
        "doc_id", "_text", "n_words", "n_hit", "items", "spans", "contaminated"
    )


def _merged(hits: Column) -> Column:
    """Overlapping or touching runs become one; `hits` are sorted."""
    none = F.array().cast("array<struct<start:int,stop:int>>")

    def step(done: Column, hit: Column) -> Column:
        last = F.element_at(done, -1)
        own = F.array(F.struct(hit["_start"].alias("start"), hit["_stop"].alias("stop")))
        longer = F.array(
            F.struct(
                last["start"].alias("start"),
                F.greatest(last["stop"], hit["_stop"]).alias("stop"),
            )
        )
        return (
            F.when(F.size(done) == 0, own)
            .when(hit["_start"] > last["stop"], F.concat(done, own))
            .otherwise(F.concat(F.slice(done, 1, F.size(done) - 1), longer))
        )

    return F.aggregate(hits, none, step)


def digests(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The report with the list of items as count and digest."""
    return report(docs, items).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256_hex(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` without the contaminated ones."""
    bad = (
        report(docs, items)
        .where("contaminated")
        .select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"))
        .distinct()
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(whole("text")) == F.col("_hash"))
    return docs.join(bad, same, "left_anti")


def cut_hits(docs: DataFrame, items: DataFrame) -> DataFrame:
    """`docs` with the words that are hit, and what follows each up to the next word, taken out."""
    hit = (
        report(docs, items)
        .where("n_hit > 0")
        .select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), "spans")
        .dropDuplicates(["_id", "_hash"])
    )
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(whole("text")) == F.col("_hash"))
    words = F.regexp_extract_all("text", F.lit(ANY_CASE_WORD), F.lit(0))
    between = F.split("text", ANY_CASE_WORD, -1)

    def kept(word: Column, i: Column) -> Column:
        inside = F.exists("spans", lambda s: (i >= s["start"]) & (i < s["stop"]))
        return F.when(inside, F.lit("")).otherwise(F.concat(word, F.col("_between")[i + 1]))

    split = docs.join(hit, same, "left").withColumns({"_found": words, "_between": between})
    cut = F.concat(F.col("_between")[0], F.array_join(F.transform("_found", kept), ""))
    return split.withColumn(
        "text", F.when(F.col("spans").isNull(), F.col("text")).otherwise(cut)
    ).select(*docs.columns)
