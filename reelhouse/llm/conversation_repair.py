"""Conversation structure repair over a suffix-shared automaton.

Every row of a conversation becomes a symbol: the role's initial and the row's fault. The symbols of a
conversation are its signature. The cheapest edits that make the roles read `(s?(ua)+)?` depend on the
signature alone, and what is left to pay at a row on the symbols from there to the end. So equal signatures are
solved once, and so is every common ending: signatures are read from the end, sorted by their reverse and
walked as one automaton whose node is a suffix. A node holds, for each of the four grammar states, the
cost-to-go and the first edit of the best audit, which continues at the node after it; since the
edits that compete there differ in their letter, the least letter settles ties, and a node needs no texts.

Sorting by the reversed signature on Spark puts suffixes that are shared next to each other: a task keeps one
path of the automaton as a stack, and a node is computed once per task that holds it. Only the path
between two neighbouring tasks is computed twice.

Faults, symbols and signatures come from range-partitioned rows (hashes instead of texts), so that a
conversation of any length is split; what reaches one place of it is a letter a row. Texts are shuffled
once, to write the repaired rows, which are streamed conversation by conversation: a digest over a
conversation's text has to pass through one task, but is never held there.

Defined cases: a null role or text counts as one space; a null conversation id is a conversation of its own. Null turns
come first; rows of one turn go by role and then by a digest of role and text, so equal rows stand next to each
other. A role that begins with none of s, u, a can only be rewritten or deleted. A conversation named in
`every` that has no rows is reported with zeros. No rows at all give no result. Columns other
than the four are not read, so their names may clash.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelhouse.session import staged

BLANKS = " \t\n\x0b\x0c\r"
FAULTS = ("fine", "blank", "duplicate", "truncated")
INITIALS = "sua"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# A symbol is a letter: four for each of s, u, a and any other initial, in the order of FAULTS.
_LETTERS = "ABCDEFGHIJKLMNOP"
_MUST_GO = "X"  # blank or duplicate, whatever the role: the automaton need not tell them apart

# Grammar states: nothing yet, after s, after u, after a. What role each one still takes, and what follows.
_WANTED = ("u", "u", "a", "u")
_AFTER = (2, 2, 3, 2)
_ACCEPTS = (True, False, False, True)
_NAMES = {"u": "user", "a": "assistant"}
_NEVER = 1 << 60
_BEGIN = ""
BATCH = 500


def facts(
    rows: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    copies: Column | None = None,
) -> DataFrame:
    """(conv, turn, role, digest, text, n): what the steps below read; a row may count `copies` times."""
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
    return rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        role_.alias("role"),
        # The length keeps role and text apart.
        F.sha2(F.encode(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), "UTF-8"), 256).alias("digest"),
        text_.alias("text"),
        (F.lit(1) if copies is None else copies).cast("int").alias("n"),
    )


def signatures(rows: DataFrame, every: DataFrame) -> DataFrame:
    """(conv, code, gaps) of each conversation in `every` (conv), from `facts`."""
    body = F.rtrim("text", F.lit(BLANKS))
    fault = (
        F.when(body == "", 1).when(F.right(body, F.lit(1)).isin(".", "!", "?"), 0).otherwise(3)
    )
    initial = F.position(F.left("role", F.lit(1)), F.lit(INITIALS)) - 1
    initial = F.when((initial < 0) | (F.col("role") == ""), len(INITIALS)).otherwise(initial)
    # Equal rows of a turn are one row with a count from here on.
    counted = staged(
        rows.groupBy("conv", "turn", "role", "digest", initial.alias("initial"), fault.alias("fault"))
        .agg(F.sum("n").alias("n"))
        .select("*", F.monotonically_increasing_id().alias("row")),
        "conv-facts",
    )
    # The least turn, nulls first: a null inside a struct is the least value.
    first = staged(
        counted.groupBy("conv", "digest").agg(F.min(F.struct("turn")).alias("first")), "conv-first"
    )
    seen = counted.alias("r").join(
        first.alias("f"),
        F.col("r.conv").eqNullSafe(F.col("f.conv")) & (F.col("r.digest") == F.col("f.digest")),
    )
    is_first = F.col("r.turn").eqNullSafe(F.col("first.turn"))
    repeat = F.when(F.col("fault") == 1, 1).otherwise(2)

    def letter(kind: Column) -> Column:
        return F.substring(F.lit(_LETTERS), 4 * F.col("initial") + kind + 1, F.lit(1))

    run = F.concat(
        letter(F.when(is_first, F.col("fault")).otherwise(repeat)),
        F.repeat(letter(repeat), (F.col("n") - 1).cast("int")),
    )
    order = ["conv", "turn", "role", "digest"]
    placed = (
        seen.select("r.*", run.alias("run"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("conv", F.monotonically_increasing_id().alias("at"), "run")
    )
    # A task's share of a conversation, then the shares: at most one a task.
    pieces = (
        placed.groupBy("conv", F.shiftright("at", 33).alias("part"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "run"))).alias("runs"))
        .select("conv", "part", F.concat_ws("", "runs.run").alias("piece"), F.lit(None).cast("long").alias("gap"))
    )
    gaps = counted.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).cast("long").alias("gap")
    )
    nothing = F.lit(None).cast("long")
    return (
        pieces.unionByName(gaps.select("conv", nothing.alias("part"), F.lit("").alias("piece"), "gap"))
        .unionByName(every.select("conv", nothing.alias("part"), F.lit("").alias("piece"), nothing.alias("gap")).distinct())
        .groupBy("conv")
        .agg(
            F.sort_array(F.collect_list(F.struct("part", "piece"))).alias("pieces"),
            F.coalesce(F.max("gap"), F.lit(0)).alias("gaps"),
        )
        .select("conv", F.concat_ws("", "pieces.piece").alias("code"), "gaps")
    )


def solved(codes: DataFrame) -> DataFrame:
    """(signature, cost, audit) of every distinct signature in `codes`, a column `signature`."""
    reverse = F.reverse("signature")
    return (
        codes.select("signature")
        .distinct()
        .withColumn("back", reverse)
        .repartitionByRange("back")
        .sortWithinPartitions("back")
        .select("signature")
        .mapInArrow(_walk, "signature string, cost long, audit string")
    )


def repair(rows: DataFrame, every: DataFrame) -> DataFrame:
    """One row per conversation: gaps, faults, cost and audit of the cheapest edits. `rows` as of `facts`."""
    codes = signatures(rows, every).withColumn("signature", _signature("code"))
    codes = staged(codes, "conv-codes")
    best = staged(solved(codes), "conv-solved")
    return codes.join(best, "signature").select(
        "conv",
        "gaps",
        *(_count(fault).alias(fault) for fault in FAULTS[1:]),
        _illegal().alias("illegal"),
        "cost",
        "audit",
    )


def repaired_rows(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv, place, edit, role, text): the rows each conversation is left with; edit is K, R or I."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, made = 0, []
        for plan, edit, role, text, kind in _replay(batches):
            if edit == _BEGIN:
                place = 0
                continue
            made.append((plan["conv"], place, edit, role, text))
            place += 1
            if len(made) == BATCH:
                yield _batch(made, names, kind)
                made = []
        if made:
            yield _batch(made, names, kind)

    names = ["conv", "place", "edit", "role", "text"]
    conv = rows.schema["conv"].dataType.simpleString()
    return _in_order(rows, plans).mapInArrow(
        opened, f"conv {conv}, place long, edit string, role string, text string"
    )


def repaired_digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """`plans` with repaired_sha256, of the `role:text` of the rows left, joined by newlines."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, made, digest, empty = None, [], hashlib.sha256(), True
        for plan, edit, role, text, kind in _replay(batches):
            if edit == _BEGIN:
                if last is not None:
                    made.append((*(last[c] for c in names[:-1]), digest.hexdigest()))
                if len(made) == BATCH:
                    yield _batch(made, names, kind)
                    made = []
                last, digest, empty = plan, hashlib.sha256(), True
                continue
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
        if last is not None:
            made.append((*(last[c] for c in names[:-1]), digest.hexdigest()))
            yield _batch(made, names, kind)

    names = [*plans.columns, "repaired_sha256"]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plans.schema)
    return _in_order(rows, plans).mapInArrow(opened, f"{types}, repaired_sha256 string")


def _in_order(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Each conversation's plan and then its rows, conversations whole within a partition."""
    plan = plans.withColumn("rank", F.lit(0)).unionByName(
        rows.withColumn("rank", F.lit(1)), allowMissingColumns=True
    )
    return plan.repartition("conv").sortWithinPartitions("conv", "rank", "turn", "role", "digest")


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(plan, edit, role, text, Arrow type of conv), one for each row that is left and one where a plan begins."""
    plan, at, state, kind = None, 0, 0, None

    def added() -> Iterator[tuple]:
        nonlocal at, state
        while plan is not None and plan["audit"][at : at + 1] == "I":
            yield plan, "I", _NAMES[_WANTED[state]], "", kind
            at, state = at + 1, _AFTER[state]

    for batch in batches:
        kind = batch.schema.field("conv").type
        for row in batch.to_pylist():
            if row["rank"] == 0:
                yield from added()
                plan, at, state = row, 0, 0
                yield plan, _BEGIN, None, None, kind
                continue
            for _ in range(row["n"]):
                yield from added()
                edit = plan["audit"][at]
                at += 1
                if edit == "K":
                    state = 1 if row["role"][0] == "s" else _AFTER[state]
                    yield plan, edit, row["role"], row["text"], kind
                elif edit == "R":
                    yield plan, edit, _NAMES[_WANTED[state]], row["text"], kind
                    state = _AFTER[state]
    yield from added()


def _batch(rows: list[tuple], names: list[str], conv: pa.DataType) -> pa.RecordBatch:
    columns = dict(zip(names, map(list, zip(*rows))))
    columns["conv"] = pa.array(columns["conv"], type=conv)
    return pa.RecordBatch.from_pydict(columns)


def _signature(code: str) -> Column:
    return F.translate(code, _letters(1, 2), _MUST_GO * 8)


def _letters(*faults: int) -> str:
    return "".join(_LETTERS[4 * role + fault] for role in range(4) for fault in faults)


def _count(fault: str) -> Column:
    return F.regexp_count("code", F.lit(f"[{_letters(FAULTS.index(fault))}]")).cast("long")


def _illegal() -> Column:
    """Neighbours whose initials are none of su, ua, au."""
    roles = F.translate("code", _LETTERS, "ssssuuuuaaaaoooo")
    legal = F.regexp_count(roles, F.lit("s(?=u)|u(?=a)|a(?=u)"))
    return (F.greatest(F.length("code") - 1, F.lit(0)) - legal).cast("long")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signatures sorted by their reverse: what two neighbours share at the end stays on the stack."""
    nodes, back = [_END], ""
    for batch in batches:
        made = []
        for signature in batch.column("signature").to_pylist():
            reverse = signature[::-1]
            shared = len(os.path.commonprefix([back, reverse]))
            del nodes[shared + 1 :]
            for symbol in reverse[shared:]:
                nodes.append(_node(symbol, nodes[-1]))
            back = reverse
            made.append((signature, nodes[-1][0][0], _audit(nodes)))
        columns = list(map(list, zip(*made))) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, type=t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string()))],
            ["signature", "cost", "audit"],
        )


def _node(symbol: str, after: list[tuple]) -> list[tuple]:
    """(cost-to-go, first edit, state after it) of each grammar state at a row, from those behind it."""
    found = []
    role, fault = (None, 0) if symbol == _MUST_GO else divmod(_LETTERS.index(symbol), 4)
    extra = TRUNCATED if fault == 3 else 0
    for state in range(4):
        options = [(DELETE + after[state][0], "D", state)]
        if role is not None:
            to = _AFTER[state]
            options.append((REROLE + extra + after[to][0], "R", to))
            initial = (INITIALS + "?")[role]
            if initial == _WANTED[state]:
                options.append((extra + after[to][0], "K", to))
            elif initial == "s" and state == 0:
                options.append((extra + after[1][0], "K", 1))
        found.append(min(options))
    return _with_inserts(found)


def _with_inserts(found: list[tuple]) -> list[tuple]:
    # An insert returns to its own state after two, so no cheapest audit has three in a row.
    for _ in range(3):
        found = [
            min(found[state], (INSERT + found[_AFTER[state]][0], "I", _AFTER[state]))
            for state in range(4)
        ]
    return found


_END = _with_inserts([(0 if ends else _NEVER, "", state) for state, ends in enumerate(_ACCEPTS)])


def _audit(nodes: list[list[tuple]]) -> str:
    edits, state, at = [], 0, len(nodes) - 1
    while (step := nodes[at][state])[1]:
        edits.append(step[1])
        state = step[2]
        at -= step[1] != "I"
    return "".join(edits)
