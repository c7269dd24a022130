"""What keeps large tables in bounds: short rows in shuffles, few pages at once, partitions by size."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelhouse import session
from reelhouse.functions import markup
from reelhouse.functions.keys import packed_id, surrogate_id
from reelhouse.operators import entities, quality
from reelhouse.plans import standins
from reelhouse.schemas import WAREHOUSE


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def review_rows(spark):
    rows = [
        ("Ann", "X", 2001, 7, 3, 10),
        ("ann", "x", 2001, 7, 2, 20),
        (None, "x", 2001, 7, 4, 30),
        (None, "x", 2001, None, 5, 40),
        ("Bob", None, None, 7, 6, None),
    ]
    return spark.createDataFrame(
        rows, "name string, firm string, year int, part_key long, seq long, rating int"
    )


FOREIGN = {"who": ("name", "firm"), "time": ("year",), "media": ("part_key",)}


def test_facts_by_keys_are_the_facts_of_their_ids(review_rows):
    ids = review_rows.select(*[surrogate_id(*k).alias(fk) for fk, k in FOREIGN.items()], "rating", "seq")
    expected = entities.facts(ids, list(FOREIGN), "seq").drop("seq")
    found = entities.facts_by_keys(review_rows, FOREIGN, "seq")
    assert found.columns == expected.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert found.where("rating = 20").count() == 1 and found.count() == 3


def test_ids_are_derived_behind_the_shuffle(review_rows):
    for df in (
        entities.facts_by_keys(review_rows, FOREIGN, "seq"),
        entities.bridge_by_keys(review_rows, "media_id", ("part_key",), "who", ("name", "firm")),
    ):
        _, exchange, behind = plan(df).partition("Exchange")
        assert exchange and "md5" not in behind


def test_bridge_by_keys_is_the_bridge_of_its_ids(review_rows):
    refs = entities.entity_refs(
        review_rows.withColumn("media_id", surrogate_id("part_key")), ("name", "firm"), "media_id", "who"
    )
    expected = entities.bridge(refs, "media_id", "who")
    found = entities.bridge_by_keys(review_rows, "media_id", ("part_key",), "who", ("name", "firm"))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_repeated_keys_are_the_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (None, None), (2, "b")], "a int, b string")
    found = quality.repeated_keys({"twice": (df, ["a", "b"]), "once": (df.distinct(), ["a", "b"])})
    assert list(found) == ["twice"]
    assert {tuple(r) for r in found["twice"].collect()} == {(1, "a", 2), (1, None, 2)}


def test_pages_are_flattened_a_few_at_a_time():
    html = [f"<p class='a b'>{i}</p>" if i % 7 else None for i in range(3 * markup.PAGES_AT_ONCE + 1)]
    pieces = list(markup._flatten_batches(iter([pa.array(html)])))
    assert [len(p) for p in pieces] == [markup.PAGES_AT_ONCE] * 3 + [1]
    nodes = [n for p in pieces for n in p.to_pylist()]
    assert nodes[0] is None and nodes[1][1]["text"] == "1" and nodes[1][0]["classes"] == ["a", "b"]


def test_partitions_grow_with_the_table(spark):
    before = {k: spark.conf.get(k, None) for k in (session._PARTITIONS, session._COALESCED)}
    try:
        session.widen(spark, 1000 * session.BYTES_PER_PARTITION)
        assert spark.conf.get(session._PARTITIONS) == "1000"
        session.widen(spark, 1)
        assert spark.conf.get(session._PARTITIONS) == "1000"
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_documents_of_orders_are_grouped_by_one_shuffle(spark, tmp_path):
    day = F.lit("2001-02-03").cast("timestamp")
    tables = {
        "part": spark.sql("SELECT 1L p_partkey, 'a b' p_name, 'B' p_brand, 'SMALL' p_type, 1 p_size, 1D p_retailprice"),
        "customer": spark.sql("SELECT 1L c_custkey, 'c' c_name, 1 c_nationkey, 1D c_acctbal, 'S' c_mktsegment"),
        "orders": spark.sql("SELECT 1L o_orderkey, 1L o_custkey, '5-LOW' o_orderpriority"),
        "lineitem": spark.range(3).select(
            F.lit(1).cast("long").alias("l_orderkey"), F.lit(1).cast("long").alias("l_partkey"),
            F.lit(1).cast("long").alias("l_suppkey"), F.col("id").cast("int").alias("l_linenumber"),
            (F.col("id") * 1.0).alias("l_quantity"), F.lit("A").alias("l_returnflag"), F.lit("O").alias("l_linestatus"),
            day.alias("l_shipdate"),
        ),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    docs = standins.documents(spark, str(tmp_path), with_reviews=True)
    (row,) = docs.select("critic_reviews", "user_reviews").collect()
    assert [r["rating"] for r in row["critic_reviews"]["LOW O-5"]] == [0, 1, 2] and not row["user_reviews"]
    shuffles = [line for line in plan(docs).splitlines() if "Exchange hashpartitioning(part_key" in line]
    assert len([line for line in shuffles if "order_key" in line]) == 1
    assert not any("section_name" in line.split("]")[0] for line in plan(docs).splitlines() if "Exchange hash" in line)


def test_packed_ids_are_as_many_as_ids(spark):
    digest = "0123456789abcdef" * 2
    ids = [digest, digest.upper(), digest + "\n", digest[:-1], "", " ", " " * 16, " " * 17, "20" * 16, "x" * 32, "é", None]
    df = spark.createDataFrame([(i,) for i in ids], "id string").select("id", packed_id("id").alias("p"))
    packed = {r.id: r.p for r in df.collect()}
    assert len({bytes(p) for i, p in packed.items() if i is not None}) == len(ids) - 1
    assert packed[None] is None and len(packed[digest]) == 16


def test_foreign_keys_are_looked_up_in_half_the_bytes(spark):
    tables = {n: spark.createDataFrame([], t.schema) for n, t in WAREHOUSE.items()}
    rows = 4000
    hexed = F.md5(F.col("id").cast("string"))
    ids = spark.range(rows).select(hexed.alias("id"))
    tables["DIM_MEDIA_INFO"] = ids.selectExpr("id", "'Movie' media_type", "'T' primary_title", "'2000' release_date")
    known = {n: spark.createDataFrame([], t.schema) for n, t in WAREHOUSE.items()}
    sent = quality.violations(tables, known)
    assert "unhex" in plan(sent) and sent.count() == 0
    orphan = spark.createDataFrame([("x", "y", 1.0)], WAREHOUSE["BRIDGE_MEDIA_GENRE"].schema)
    broken = quality.violations({**tables, "BRIDGE_MEDIA_GENRE": orphan}, known)
    assert {(r.rule, r["rows"]) for r in broken.collect()} == {("foreign key media_id", 1), ("foreign key genre_id", 1)}


def test_facts_by_keys_carry_ids(review_rows):
    keyed = review_rows.withColumn("media", surrogate_id("part_key"))
    some = {k: v for k, v in FOREIGN.items() if k != "media"}
    found = entities.facts_by_keys(keyed, some, "seq", ids=("media",)).select("who", "time", "media", "rating")
    expected = entities.facts_by_keys(review_rows, FOREIGN, "seq").select("who", "time", "media", "rating")
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
