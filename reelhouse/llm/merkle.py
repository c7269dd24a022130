"""Merkle manifest of a dataset, built by a butterfly exchange.

Every row is a leaf. The leaves of a group (a source) ascend by key and are hashed in runs of `FANOUT`
until one node, the subroot, is left; the subroots of all groups are hashed likewise to the root.

Aligned blocks of `FANOUT ** levels` leaves are the partitions of the exchange. A block hashes its own
leaves to one node. Then, round by round, the `FANOUT` groups of blocks below one parent swap
their nodes: block i of each group meets block i of the others in a cell, every cell hashes the parent (the
same one, redundantly), and each block takes the run home as the next step of its proof. So after the last
round every block knows the root and the upper proof of its leaves, and nothing is sent down a
tree. Where groups differ in size, the blocks of a smaller one stand in for the blocks it lacks. The rounds go on
across the groups' subroots in the same way. Rounds: the logarithm of blocks, then of groups. A cell has at
most `FANOUT` members, so no task depends on how large a group is.

Defined cases: a null field is hashed as `-`, which no value is. A null group is a group of its own, first in order.
Null keys come first; rows of one key are ordered by their digests; repeated rows are leaves each. A table without
rows has no manifest. Columns that are not hashed are not read, so their names may clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.llm.common import numbered, sha256_hex
from reelhouse.session import staged

FANOUT = 16
LEVELS = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64

_RUN = "struct<own: int, run: array<string>>"


def digest(fields: Sequence[Column]) -> Column:
    """The leaf of a row: SHA-256 of its fields, each with its length, null as `-`."""
    parts = []
    for field in fields:
        value = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return sha256_hex(F.concat(*parts))


def build(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    fields: Sequence[str] = FIELDS,
    seen: Column | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
) -> DataFrame:
    """One row per block: its leaves, the upper proof, its group's subroot and the root.

    `seen` is a digest to hold against the proof of each row, such as that of a later copy; by default the leaf.
    """
    made = digest([F.col(f) for f in fields])
    leaves = staged(
        docs.select(
            # The empty string is the null group: every other one begins with a mark.
            F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("g"),
            F.col(key).alias("key"),
            made.alias("leaf"),
            (made if seen is None else seen).alias("seen"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "merkle-leaves",
    )
    ranked = staged(numbered(leaves, ["g", "key", "leaf", "seen", "row"], "rank"), "merkle-ranked")
    groups = staged(
        ranked.groupBy("g").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")), "merkle-groups"
    )
    groups = staged(numbered(groups, ["g"], "seq"), "merkle-groups")
    size = fanout**levels
    place = F.col("rank") - F.col("first")
    up = F.when(F.col("several"), F.lit(levels))
    blocks = staged(
        ranked.join(groups, "g")
        .withColumn("block", F.floor(place / size))
        .groupBy("seq", "n", "block")
        .agg(F.sort_array(F.collect_list(F.struct("rank", "key", "leaf", "seen"))).alias("leaves")),
        "merkle-blocks",
    ).withColumns({"blocks": F.ceil(F.col("n") / size), "several": F.col("n") > size})
    state = blocks.select(
        "seq",
        "block",
        "blocks",
        _climber(fanout)(F.col("leaves.leaf"), up).alias("node"),
        F.array().cast(f"array<{_RUN}>").alias("path"),
    )
    top = state.agg(F.max("blocks"), F.max("seq")).first()
    state = staged(numbered(state, ["seq", "block"], "at"), "merkle-state")
    span = 1
    while (top[0] or 0) > span:
        state = staged(_swap_within(state, span, fanout), "merkle-round")
        span *= fanout
    state = state.withColumn("subroot", F.col("node"))
    span = 1
    while (top[1] or 0) >= span:
        state = staged(_swap_across(state, span, fanout), "merkle-round")
        span *= fanout
    return blocks.drop("n", "blocks").join(
        state.select("seq", "block", "path", "subroot", F.col("node").alias("root")), ["seq", "block"]
    )


def audit(tree: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of every leaf.

    `folded_root` is what the digest seen and the proof's siblings hash to; it is verified if that is the root.
    """
    out = (
        f"key {_key_type(tree)}, leaf string, subroot string, root string, "
        "proof_sha256 string, folded_root string, verified boolean"
    )

    def rows(block: dict) -> dict:
        made = {name: [] for name in ("key", "leaf", "proof_sha256", "folded_root", "verified")}
        for leaf, sides in _proofs(block, fanout, levels):
            proof = hashlib.sha256()
            node = leaf["seen"]
            for left, right in sides:
                proof.update((left + right).encode())
                node = _hash(left + node + right)
            made["key"].append(leaf["key"])
            made["leaf"].append(leaf["leaf"])
            made["proof_sha256"].append(proof.hexdigest())
            made["folded_root"].append(node)
            made["verified"].append(node == block["root"])
        return made

    return _per_block(tree, out, rows)


def proofs(tree: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> DataFrame:
    """(key, leaf, subroot, root, proof) of every leaf; a proof lists, from the leaf up, the siblings on
    either side, as hex text without blanks."""
    out = (
        f"key {_key_type(tree)}, leaf string, subroot string, root string, "
        "proof array<struct<left: string, right: string>>"
    )

    def rows(block: dict) -> dict:
        made = {"key": [], "leaf": [], "proof": []}
        for leaf, sides in _proofs(block, fanout, levels):
            made["key"].append(leaf["key"])
            made["leaf"].append(leaf["leaf"])
            made["proof"].append([{"left": left, "right": right} for left, right in sides])
        return made

    return _per_block(tree, out, rows)


def _swap_within(state: DataFrame, span: int, fanout: int) -> DataFrame:
    """One round among the blocks of a group, whose nodes stand for `span` blocks each."""
    open_ = F.col("blocks") > span
    team = F.floor(F.col("block") / span)
    parent = F.floor(team / fanout)
    members = F.least(F.lit(span).cast("long"), F.col("blocks") - team * span)
    alone = (F.col("blocks") - parent * fanout * span) <= span
    cells = state.where(open_).select(
        "*",
        team.alias("team"),
        F.concat_ws(".", F.col("seq"), parent).alias("cell"),
        (F.col("block") % span).alias("lane"),
        members.alias("members"),
        F.when(alone, members).otherwise(F.lit(span)).alias("lanes"),
    )
    return _swap(cells, state.columns).unionByName(state.where(~open_))


def _swap_across(state: DataFrame, span: int, fanout: int) -> DataFrame:
    """One round among groups, whose nodes stand for the subroots of `span` groups each."""
    team = F.floor(F.col("seq") / span)
    teams = state.groupBy(team.alias("team")).agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("members")
    )
    teams = staged(teams.withColumn("parent", F.floor(F.col("team") / fanout)), "merkle-teams")
    lanes = teams.groupBy("parent").agg(F.max("members").alias("lanes"))
    teams = staged(teams.join(lanes, "parent"), "merkle-teams")
    cells = (
        state.withColumn("team", team)
        .join(teams, "team")
        .select(
            *state.columns,
            "team",
            F.col("parent").cast("string").alias("cell"),
            (F.col("at") - F.col("first")).alias("lane"),
            "members",
            "lanes",
        )
    )
    return _swap(cells, state.columns)


def _swap(cells: DataFrame, columns: list[str]) -> DataFrame:
    """Members of a cell see each other's nodes, hash them to the parent and keep the run.

    A block stands in, with its node alone, for the lanes that its own smaller team lacks.
    """
    home = [c for c in columns if c != "node"]
    sent = cells.select(
        "cell",
        F.explode(F.sequence(F.col("lane"), F.col("lanes") - 1, F.col("members"))).alias("to"),
        "lane",
        "team",
        "node",
        F.struct(*home).alias("home"),
    ).select(
        "cell",
        "to",
        F.struct(
            "team", "node", F.when(F.col("to") == F.col("lane"), F.col("home")).alias("home")
        ).alias("member"),
    )
    met = sent.groupBy("cell", "to").agg(
        F.array_sort(F.collect_list("member"), lambda a, b: (a["team"] - b["team"]).cast("int")).alias("run")
    )
    nodes = F.col("run.node")
    taken = met.select(
        sha256_hex(F.concat_ws("", nodes)).alias("node"), nodes.alias("nodes"), F.posexplode("run")
    ).where("col.home is not null")
    step = F.struct(F.col("pos").alias("own"), F.col("nodes").alias("run")).cast(_RUN)
    return taken.select("node", "col.home.*", step.alias("_step")).select(
        *[c for c in columns if c != "path"],
        F.concat("path", F.array("_step")).alias("path"),
    ).select(*columns)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _climb(nodes: list[str], fanout: int, levels: int | None) -> list[list[str]]:
    """Every level from the leaves up, `levels` steps, or until one node is left."""
    found = [nodes]
    while len(found) <= levels if levels is not None else len(found[-1]) > 1:
        last = found[-1]
        found.append([_hash("".join(last[i : i + fanout])) for i in range(0, len(last), fanout)])
    return found


def _climber(fanout: int):
    def climb(leaves: pd.Series, levels: pd.Series) -> pd.Series:
        steps = [None if pd.isna(up) else int(up) for up in levels]
        made = [_climb(list(nodes), fanout, up)[-1][0] for nodes, up in zip(leaves, steps)]
        return pd.Series(made, dtype="object")

    return F.pandas_udf(climb, "string")


def _proofs(block: dict, fanout: int, levels: int) -> Iterator[tuple[dict, list[tuple[str, str]]]]:
    """Every leaf of a block with the siblings left and right of its path, level by level."""
    # Only a group of several blocks has its local runs carried up the full number of levels.
    within = _climb([leaf["leaf"] for leaf in block["leaves"]], fanout, levels if block["several"] else None)
    runs = [
        ["".join(level[i : i + fanout]) for i in range(0, len(level), fanout)] for level in within[:-1]
    ]
    upper = []
    for step in block["path"]:
        run, own = "".join(step["run"]), step["own"] * HEX
        upper.append((run[:own], run[own + HEX :]))
    for at, leaf in enumerate(block["leaves"]):
        sides = []
        for level in runs:
            at, own = divmod(at, fanout)
            sides.append((level[at][: own * HEX], level[at][own * HEX + HEX :]))
        yield leaf, sides + upper


def _key_type(tree: DataFrame) -> str:
    return tree.schema["leaves"].dataType.elementType["key"].dataType.simpleString()


def _per_block(tree: DataFrame, schema: str, rows) -> DataFrame:
    """Blocks are opened one at a time inside a task."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.schema.field("leaves").type.value_type.field("key").type
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                made = rows(block)
                n = len(made["key"])
                made["key"] = pa.array(made["key"], type=key)
                made |= {name: [block[name]] * n for name in ("subroot", "root")}
                yield pa.RecordBatch.from_pydict({name: made[name] for name in names})

    names = T.StructType.fromDDL(schema).names
    return tree.mapInArrow(opened, schema)
