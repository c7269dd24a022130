"""Personal data: rules, high-recall candidates, and boosted trees that choose among them.

Four kinds are found by fixed rules (`base`): e-mail addresses, IPv4 addresses, card numbers, phone
numbers. Generators propose wider, overlapping spans of each kind (addresses written around the at sign,
numbers with other separators); boosted trees score every candidate from its format and from the
words before it, and a threshold per kind, calibrated on a half of the examples the trees have not
seen, decides which are added. What a rule found stays; an added span never overlaps it.

The examples are made, not labelled by the rules, so what the trees learn does not depend on how often a form
is found in the corpus (`teaching`). Positive are addresses and numbers of `SEEDS` a kind, drawn by a fixed seed, and up to
`SEEDS` that the rules find in a sample, both written in forms the rules do not know: at and dot as
words or in brackets, `[.]` between the parts of an address, dots and slashes in card numbers, phone numbers without
a plus. Negative are sentences that end after "at", card numbers with a wrong check digit, parts above 255, lists of
numbers, bare digits, years, thousands, and spans of the other kinds. All stand between words of the sample.

All of the main path is built-in functions: a pattern's matches and the pieces between them give all positions by running
totals, and trees are expressions. The trees themselves are fitted on the driver from counts of distinct feature
vectors of the examples.

Bounds: the sample is the share of documents, by a hash of the id, that comes to `SAMPLE_DOCS` in expectation; `SEEDS` spans
of a kind and the beginnings of `CARRIERS` texts are taken from it, and at most `MAX_VECTORS` distinct vectors of
a kind are used. Searching has no bound.

Patterns begin only where a run of their characters begins, or where the last match ended, and contain
no repeated groups of varying length where a text could make them long, so that neither time nor
stack depends on how long a run is.

Defined cases: null texts are empty and have no spans. Repeated rows are searched each for itself. Examples of
one sort only add nothing. Positions are code points, the end is exclusive. Extra
columns are kept; working columns begin with an underscore.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from reelhouse.llm.common import whole

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 20_000
MAX_VECTORS = 20_000
ROUNDS = 20
RATE = 0.3
PRECISION = 0.95
CONTEXT_CHARS = 24
SEEDS = 300
CARRIERS = 300
SEED = 29

# A separator between two digits, the only place where a card number may have one.
_STRAY = r"(?<![0-9])[\x20-]|[\x20-](?![0-9])"
_LOCAL = "A-Za-z0-9._%+-"
_DOMAIN = "A-Za-z0-9-"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[{_DOMAIN}]++(?:\.[{_DOMAIN}]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9][0-9\x20-]+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a pattern to be worth running.
_GATE = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]",
    "card": r"[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9][\x20-]?[0-9]",
    "phone": r"\+[0-9]",
}
_AT = r"(?:\x20?@\x20?|\x20?[\[({]\x20?at\x20?[\])}]\x20?|\x20at\x20)"
_DOT = r"(?:\x20?\.\x20?|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)"
# A further part does not begin after the end of a sentence.
_MORE = r"(?:\.|\x20\.\x20|\x20?[\[({]\x20?dot\x20?[\])}]\x20?|\x20dot\x20)"
WIDE = {
    "email": rf"(?i)(?<![{_LOCAL}])[{_LOCAL}]++{_AT}[{_DOMAIN}]++{_DOT}[a-z]{{2,24}}(?:{_MORE}[a-z]{{2,24}})?",
    "ip": r"(?<![0-9])[0-9]{1,3}(?:(?:\x20?\.\x20?|\[\.\]|-)[0-9]{1,3}){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{4}[\x20./-]?){3}[0-9]{1,7}(?![0-9])",
    "phone": r"(?<![0-9])(?:(?:\+|00)?[0-9]{1,3}[\x20./-]?)?\(?[0-9]{2,4}\)?[\x20./-]?[0-9]{3,4}[\x20./-]?[0-9]{3,5}(?![0-9])",
}
_WIDE_GATE = {
    "email": r"@|(?i:[\[({]\x20?at|\x20dot\x20)",
    "ip": r"[0-9](?:\x20?\.\x20?|\[\.\]|-)[0-9]",
    "card": r"[0-9]{4}[\x20./-]?[0-9]{4}",
    "phone": r"[0-9]{3}[\x20./-]?[0-9]{3}",
}
# Words that tend to stand before the kinds, in several languages.
_BEFORE = {
    "ctx_mail": r"(?i)(?:e-?mail|mail|contact|courriel|correo)[^A-Za-z]*$",
    "ctx_net": r"(?i)(?:\bip\b|host|server|address|adresse)[^A-Za-z]*$",
    "ctx_card": r"(?i)(?:card|visa|carte|karte|tarjeta)[^A-Za-z]*$",
    "ctx_phone": r"(?i)(?:tel|phone|fon|call|mobile|fax)[^A-Za-z]*$",
}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_BETWEEN = r"[^0-9]+"
_TLD = (
    "com org net edu gov mil int info biz io dev app eu de fr es it uk ch at nl be se no dk fi pl pt cz "
    "ru ua jp cn kr in br mx ar ca us au nz za"
).split()
# What a span looks like, as patterns on it or on what stands around it; none is the test of a rule.
_LOOKS = {
    "bracketed": r"(?i)[\[({]\x20?(?:at|dot|\.)\x20?[\])}]",
    "said_at": r"(?i)\x20at\x20",
    "said_dot": r"(?i)\x20dot\x20",
    "sentence": r"(?<!\x20)\.\x20",
    "tld": rf"[^A-Za-z](?:{'|'.join(_TLD)})$",
    "octets": rf"^{_PART}{_BETWEEN}{_PART}{_BETWEEN}{_PART}{_BETWEEN}{_PART}$",
    "lead": r"^(?:0|\()",
    "thousands": r"^[0-9]{1,3}(?:[.\x20][0-9]{3})+$",
    "years": r"^(?:(?:19|20)[0-9]{2}[\x20./-]?)+$",
}
FEATURES = (
    "chars", "digits", "letters", "marks", "hyphens", "groups", "left", "right", "in_number",
    "checked", *_LOOKS, *_BEFORE,
)


@dataclass(frozen=True)
class Tree:
    """Two levels: a test, and a test for either outcome. A test is (feature, limit): value < limit."""

    root: tuple[str, int]
    sides: tuple[tuple[tuple[str, int], float, float], tuple[tuple[str, int], float, float]]


@dataclass(frozen=True)
class Chooser:
    """Trees of one kind and the score from which a candidate is taken."""

    trees: tuple[Tree, ...] = ()
    start: float = 0.0
    threshold: float = float("inf")

    def score(self, value) -> Column:
        """Log odds; `value` gives the column of a feature."""
        total = F.lit(self.start)
        for tree in self.trees:
            (a, low_a, high_a), (b, low_b, high_b) = tree.sides
            first = F.when(value(a[0]) < a[1], low_a).otherwise(high_a)
            second = F.when(value(b[0]) < b[1], low_b).otherwise(high_b)
            total = total + F.when(value(tree.root[0]) < tree.root[1], first).otherwise(second)
        return total


@dataclass(frozen=True)
class Model:
    choosers: dict[str, Chooser] = field(default_factory=dict)


def _located(df: DataFrame, source: str, name: str, pattern: str, gate: str) -> DataFrame:
    """Add array<struct<start, end, found>>: leftmost matches of `pattern`, none overlapping."""
    found, gaps, steps = f"_{name}_found", f"_{name}_gaps", f"_{name}_steps"
    worth = F.col(source).rlike(gate)
    none = F.array().cast("array<string>")
    made = df.withColumn(
        found, F.when(worth, F.regexp_extract_all(source, F.lit(pattern), F.lit(0))).otherwise(none)
    )
    made = made.withColumn(
        gaps, F.when(F.size(found) > 0, F.split(source, pattern, -1)).otherwise(none)
    )
    pairs = F.zip_with(
        found,
        F.slice(gaps, 1, F.size(found)),
        lambda m, g: F.struct(F.length(g).alias("gap"), F.length(m).alias("n"), m.alias("m")),
    )
    made = made.withColumn(steps, pairs)
    return made.withColumn(name, _running(F.col(steps))).drop(found, gaps, steps)


def _running(steps: Column, block: int = 256) -> Column:
    """Positions by running totals: within blocks, and over the totals of blocks."""
    span = "struct<start:int,end:int,found:string>"
    blocks = F.when(
        F.size(steps) > 0,
        F.transform(
            F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / block).cast("int")),
            lambda b: F.slice(steps, b * block + 1, block),
        ),
    ).otherwise(F.array().cast("array<array<struct<gap:int,n:int,m:string>>>"))

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, s: a + s["gap"] + s["n"])

    begin = F.aggregate(
        blocks,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda a, part: F.struct(
            (a["at"] + total(part)).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")
        ),
        lambda a: a["all"],
    )

    def within(part: Column, at: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(at.alias("at"), F.array().cast(f"array<{span}>").alias("all")),
            lambda a, s: F.struct(
                (a["at"] + s["gap"] + s["n"]).alias("at"),
                F.concat(
                    a["all"],
                    F.array(
                        F.struct(
                            (a["at"] + s["gap"]).alias("start"),
                            (a["at"] + s["gap"] + s["n"]).alias("end"),
                            s["m"].alias("found"),
                        )
                    ),
                ).alias("all"),
            ),
            lambda a: a["all"],
        )

    return F.flatten(F.zip_with(blocks, begin, within))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the sum with every second digit from the right doubled ends in 0."""
    n = F.length(digits)

    def weighed(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    values = F.transform(F.sequence(F.lit(0), n - 1), weighed)
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def _of_kind(function, kind):
    """The function of a span alone; a lambda with a default would be handed the index as well."""
    return lambda span: function(span, kind)


def _valid(span: Column, kind: str) -> Column:
    found = span["found"]
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return found.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    digits = _digits(found)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))


def with_base(docs: DataFrame) -> DataFrame:
    """Add `_base_<kind>`: the spans the rules find in `text`, and `_text`, the whole text."""
    made = docs.withColumn("_text", whole("text"))
    numbers = F.when(
        F.col("_text").rlike(_GATE["card"]), F.regexp_replace("_text", _STRAY, "_")
    ).otherwise(F.lit(""))
    made = made.withColumn("_numbers", numbers)
    for kind in KINDS:
        source = "_numbers" if kind == "card" else "_text"
        made = _located(made, source, f"_all_{kind}", BASE[kind], _GATE[kind])
        made = made.withColumn(
            f"_base_{kind}",
            F.filter(f"_all_{kind}", _of_kind(_valid, kind)),
        ).drop(f"_all_{kind}")
    return made.drop("_numbers")


def with_candidates(docs: DataFrame) -> DataFrame:
    """Add `_wide_<kind>`: candidates with features and whether a rule's span overlaps each."""
    made = docs
    for kind in KINDS:
        name = f"_wide_{kind}"
        made = _located(made, "_text", name, WIDE[kind], _WIDE_GATE[kind])
        made = made.withColumn(name, F.transform(name, _of_kind(_featured, kind)))
    return made


def _featured(span: Column, kind: str) -> Column:
    text, found = F.col("_text"), span["found"]

    def count(pattern: str) -> Column:
        return F.length(found) - F.length(F.regexp_replace(found, pattern, ""))

    at = F.greatest(F.lit(0), span["start"] - CONTEXT_CHARS)
    before = F.substring(text, at + 1, span["start"] - at)
    after = F.substring(text, span["end"] + 1, F.lit(2))
    digits = _digits(found)
    checked = (
        F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(F.lit(False))
        if kind == "card"
        else F.lit(False)
    )
    values = {
        "chars": F.length(found),
        "digits": count("[0-9]"),
        "letters": count("[A-Za-z]"),
        "marks": count(r"[^A-Za-z0-9\x20]"),
        "hyphens": count("-"),
        "groups": count("(?<![0-9])[0-9]"),
        "left": before.rlike(r"[\p{L}\p{N}_]$").cast("int"),
        "right": after.rlike(r"^[\p{L}\p{N}_]").cast("int"),
        "in_number": (before.rlike(r"[0-9][./,:-]$") | after.rlike(r"^[./,:-][0-9]")).cast("int"),
        "checked": checked.cast("int"),
        **{name: found.rlike(pattern).cast("int") for name, pattern in _LOOKS.items()},
        **{name: before.rlike(pattern).cast("int") for name, pattern in _BEFORE.items()},
    }

    taken = F.lit(False)
    for k in KINDS:
        taken = taken | F.exists(
            f"_base_{k}", lambda b: (b["start"] < span["end"]) & (b["end"] > span["start"])
        )
    return F.struct(
        span["start"].alias("start"),
        span["end"].alias("end"),
        taken.alias("taken"),
        *(values[f].cast("int").alias(f) for f in FEATURES),
    )


def _vector(candidate: Column, kind: str) -> Column:
    names = ("start", "end", "taken", *FEATURES)
    return F.struct(F.lit(kind).alias("kind"), *(candidate[f].alias(f) for f in names))


def _chosen(candidate: Column, chooser: Chooser) -> Column:
    return ~candidate["taken"] & (chooser.score(lambda f: candidate[f]) >= chooser.threshold)


def _named(span: Column, kind: str) -> Column:
    return F.concat_ws(":", F.lit(kind), span["start"].cast("string"), span["end"].cast("string"))


def _marked(span: Column, kind: str) -> Column:
    return F.struct(span["start"].alias("start"), span["end"].alias("end"), F.lit(kind).alias("kind"))


def _luhn_digit(digits: str) -> str:
    """The check digit that makes `digits` a card number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 - i % 2)
        total += v - 9 if v > 9 else v
    return str(-total % 10)


def _seeds(rng: random.Random, n: int = SEEDS) -> dict[str, list[str]]:
    """Valid values of each kind."""
    names = "anna ben carla david eva info sales office support marta jo press hello team".split()

    def some(length: int, first: str = "123456789") -> str:
        return rng.choice(first) + "".join(rng.choice("0123456789") for _ in range(length - 1))

    def word() -> str:
        return "".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 5)))

    def name() -> str:
        return rng.choice(names) + rng.choice(("", "." + word(), "_" + word(), some(2)))

    cards = [some(15, "3456") for _ in range(n)]
    return {
        "email": [f"{name()}@{word()}.{rng.choice(_TLD)}" for _ in range(n)],
        "ip": [".".join(str(rng.randint(0, 255)) for _ in range(4)) for _ in range(n)],
        "card": [c + _luhn_digit(c) for c in cards],
        "phone": [some(rng.choice((10, 11, 12))) for _ in range(n)],
    }


def _rewritten(kind: str, value: str, rng: random.Random) -> list[tuple[str, str]]:
    """(words before, span): `value` in forms the rules do not know."""
    if kind == "email":
        local, _, domain = value.partition("@")
        parts = domain.split(".")
        if len(parts) > 3 or not all(re.fullmatch("[a-z]{2,24}", p) for p in parts[1:]):
            return []
        forms = [
            (at, dot)
            for at in (" (at) ", "(at)", " [at] ", "[at]", " {at} ", " at ")
            for dot in (" (dot) ", "(dot)", " [dot] ", "[dot]", " dot ", ".")
        ] + [(" @ ", "."), (" @ ", " . "), ("@", " (dot) "), ("@", " dot "), ("@", "[dot]")]
        # Without brackets always, since these are closest to sentences.
        chosen = [(" at ", " dot "), (" at ", "."), *rng.sample(forms, 3)]
        return [("", local + at + dot.join(parts)) for at, dot in chosen]
    if kind == "ip":
        parts = value.split(".")
        return [("", j.join(parts)) for j in ("[.]", " . ")] + [(rng.choice(("ip ", "host ")), "-".join(parts))]
    digits = re.sub("[^0-9]", "", value)
    if kind == "card":
        fours = [digits[i : i + 4] for i in range(0, 16, 4)]
        return [("", j.join(fours)) for j in "./"] if len(digits) == 16 else []
    n = digits[-10:]
    forms = [
        ("", f"({n[:3]}) {n[3:6]}-{n[6:]}"),
        ("", f"{n[:3]}-{n[3:6]}-{n[6:]}"),
        ("", f"{n[:3]} {n[3:6]} {n[6:]}"),
        ("", f"{n[:3]}.{n[3:6]}.{n[6:]}"),
        ("", f"0{n[:2]} {n[2:6]} {n[6:]}"),
        ("", f"0{n[:2]}/{n[2:6]}{n[6:]}"),
        ("", f"0049 {n[:2]} {n[2:6]} {n[6:]}"),
        (rng.choice(("tel ", "Phone: ", "call ")), f"0{n[:2]} {n[3:]}"),
        (rng.choice(("tel ", "phone ", "fax: ")), n),
    ]
    return rng.sample(forms, 4) if len(n) == 10 else []


def _wrong(kind: str, value: str, words: list[str], rng: random.Random) -> list[tuple[str, str]]:
    """(words before, span): what looks like the kind and is not."""

    def some(length: int) -> str:
        return rng.choice("123456789") + "".join(rng.choice("0123456789") for _ in range(length - 1))

    if kind == "email":
        a, b, c = (rng.choice(words) for _ in range(3))
        ahead = rng.choice(("", "", "", "contact "))
        return [
            (ahead, f"{a} at {b}. {c.capitalize()}"),
            (ahead, f"{a} at {b}. {c.lower()}"),
            (ahead, f"{a} @ {b}. {c.capitalize()}"),
            (ahead, f"{a} at {b}.{c.capitalize()}"),
            (ahead, f"{a} at {b} dot matrix"),
            (ahead, f"{a} at {b}. {rng.choice(_TLD).capitalize()}"),
            (ahead, f"{a} at {b}. {rng.choice(_TLD)}"),
        ]
    if kind == "ip":
        parts = value.split(".")
        beyond = [*parts[:3], str(rng.randint(256, 999))]
        rng.shuffle(beyond)
        first = rng.randint(1, 20)
        return [
            *(("", j.join(beyond)) for j in ("[.]", " . ", "-")),
            ("", "-".join(parts)),
            ("", ". ".join(str(first + i) for i in range(4))),
        ]
    if kind == "card":
        digits = re.sub("[^0-9]", "", value)[:15].ljust(15, "7")
        digits += str((int(_luhn_digit(digits)) + rng.randint(1, 9)) % 10)
        fours = [digits[i : i + 4] for i in range(0, 16, 4)]
        ahead = rng.choice(("", "card "))
        return [(ahead, j.join(fours)) for j in ("", ".", "/", " ")]
    year = rng.randint(1900, 2020)
    ahead = rng.choice(("", "", "", "call "))
    return [
        ("", some(rng.randint(8, 16))),
        ("", some(rng.randint(8, 16))),
        (ahead, " ".join(str(year + i) for i in range(3))),
        (ahead, rng.choice(". ").join((some(rng.randint(2, 3)), some(3), some(3)))),
        (ahead, rng.choice("./").join((some(3), some(3), some(4), some(2)))),
        (ahead, " ".join(some(4) for _ in range(4))),
    ]


def teaching(
    values: dict[str, list[str]], carriers: list[str], seed: int = SEED
) -> list[tuple[int, str, int, int, str, bool]]:
    """(doc_id, text, from, to, kind, good): examples with one span each, from valid values and carrier texts.

    `values` come on top of `SEEDS` made ones of each kind.
    """
    rng = random.Random(seed)
    made = _seeds(rng)
    words = re.findall(r"[A-Za-z]{2,24}", " ".join(carriers)) or "we meet the old house then some more".split()
    rows = []

    def add(kind: str, ahead: str, span: str, good: bool) -> None:
        before = " ".join(rng.choice(words) for _ in range(4)) + " " + ahead
        after = rng.choice((" ", ". ", ", ")) + " ".join(rng.choice(words) for _ in range(3))
        rows.append((len(rows), before + span + after, len(before), len(before) + len(span), kind, good))

    for kind in KINDS:
        for value in made[kind] + sorted(values.get(kind, []))[:SEEDS]:
            for ahead, span in _rewritten(kind, value, rng):
                add(kind, ahead, span, True)
            for ahead, span in _wrong(kind, value, words, rng):
                add(kind, ahead, span, False)
    return rows


def _sampled(docs: DataFrame, sample_docs: int) -> tuple[dict[str, list[str]], list[str]]:
    """Values of each kind that the rules find in a hashed sample, and beginnings of its texts."""
    n = docs.count()
    if not n:
        return {}, []
    share = min(1.0, sample_docs / n)
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    sample = docs.select("doc_id", "text").where(hashed < F.lit(int(share * (1 << 30))))
    order = F.xxhash64(F.lit(SEED), "doc_id", "text")
    heads = sample.select(order.alias("o"), F.substring(whole("text"), 1, 200).alias("t"))
    carriers = [r["t"] for r in heads.orderBy("o", "t").limit(CARRIERS).collect()]
    found = with_base(sample)

    def value(span: Column, kind: str) -> Column:
        v = _digits(span["found"]) if kind == "card" else span["found"]
        return F.struct(F.lit(kind).alias("kind"), v.alias("v"))

    every = F.concat(*(F.transform(f"_base_{k}", _of_kind(value, k)) for k in KINDS))
    short = found.select(F.explode(every).alias("s")).select("s.*").where(F.length("v") <= 64).distinct()
    rank = F.row_number().over(W.partitionBy("kind").orderBy(F.xxhash64("v"), "v"))
    values = {kind: [] for kind in KINDS}
    for r in short.withColumn("rank", rank).where(F.col("rank") <= SEEDS).collect():
        values[r["kind"]].append(r["v"])
    return values, carriers


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit trees and thresholds on made examples between words of a hashed sample of `docs`."""
    rows = teaching(*_sampled(docs, sample_docs))
    names = ("doc_id", "text", "_from", "_to", "_kind", "_good")
    examples = docs.sparkSession.createDataFrame(
        pa.table({name: [r[i] for r in rows] for i, name in enumerate(names)})
    )
    found = with_candidates(with_base(examples))
    every = F.concat(*(F.transform(f"_wide_{k}", _of_kind(_vector, k)) for k in KINDS))
    # Half of the examples fit the trees, the other half the thresholds.
    half = F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int")
    vectors = (
        found.select(half.alias("half"), "_from", "_to", "_kind", "_good", F.explode(every).alias("c"))
        .select("half", "_from", "_to", "_kind", "_good", "c.*")
        .where((F.col("start") < F.col("_to")) & (F.col("end") > F.col("_from")) & ~F.col("taken"))
    )
    exact = (F.col("start") == F.col("_from")) & (F.col("end") == F.col("_to"))
    good = F.col("_good") & (F.col("kind") == F.col("_kind")) & exact
    counted = (
        vectors.groupBy("kind", "half", *FEATURES)
        .agg(F.sum(good.cast("long")).alias("good"), F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "kind", "half", *FEATURES)
        .limit(MAX_VECTORS * len(KINDS))
        .collect()
    )
    models = {}
    for kind in KINDS:
        of_kind = [r for r in counted if r["kind"] == kind][:MAX_VECTORS]
        models[kind] = boost(
            np.array([[r[f] for f in FEATURES] for r in of_kind], float).reshape(-1, len(FEATURES)),
            np.array([r["good"] for r in of_kind], float),
            np.array([r["n"] for r in of_kind], float),
            np.array([r["half"] for r in of_kind], int),
        )
    return Model(models)


def boost(x: np.ndarray, good: np.ndarray, n: np.ndarray, half: np.ndarray) -> Chooser:
    """Gradient boosting of two-level trees on counted vectors, and the calibrated threshold."""
    fit_on = half == 0
    if not good[fit_on].sum() or good[fit_on].sum() == n[fit_on].sum():
        return Chooser()
    rate = good[fit_on].sum() / n[fit_on].sum()
    start = float(np.log(rate / (1 - rate)))
    score, trees = np.full(len(n), start), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-score))
        gradient, curve = good - n * p, n * p * (1 - p)
        gain, root = _best(x, gradient, curve, fit_on)
        if root is None or gain < 1e-6:
            break
        low = x[:, root[0]] < root[1]
        sides = []
        for side in (low, ~low):
            _, test = _best(x, gradient, curve, fit_on & side)
            test = test or root
            below = x[:, test[0]] < test[1]
            values = [
                RATE * float(np.clip(gradient[m].sum() / (curve[m].sum() + 1), -4, 4))
                for m in (fit_on & side & below, fit_on & side & ~below)
            ]
            sides.append(((FEATURES[test[0]], int(np.ceil(test[1]))), *values))
            score = score + np.where(side, np.where(below, *values), 0.0)
        trees.append(Tree((FEATURES[root[0]], int(np.ceil(root[1]))), tuple(sides)))
    return Chooser(tuple(trees), start, _threshold(score[~fit_on], good[~fit_on], n[~fit_on]))


def _best(x, gradient, curve, rows):
    """The test with the greatest gain among `rows`, or none."""
    best, test = 0.0, None
    g, c = gradient[rows], curve[rows]
    whole_gain = g.sum() ** 2 / (c.sum() + 1)
    for f in range(x.shape[1]):
        values = x[rows, f]
        for limit in np.unique(values)[1:]:
            m = values < limit
            gain = (
                g[m].sum() ** 2 / (c[m].sum() + 1) + g[~m].sum() ** 2 / (c[~m].sum() + 1) - whole_gain
            )
            if gain > best + 1e-12:
                best, test = gain, (f, limit)
    return best, test


def _threshold(score: np.ndarray, good: np.ndarray, n: np.ndarray) -> float:
    """The score from which on candidates are right often enough; infinite if there is none.

    The least score that is right often enough both by itself and with all above it, and halfway on to the next
    score below. By itself as well, since how often a form is among the examples says nothing about the corpus.
    """
    values, group = np.unique(np.round(score, 9), return_inverse=True)
    right, all_ = (np.bincount(group, v, len(values)) for v in (good, n))
    above = np.cumsum(right[::-1])[::-1] >= PRECISION * np.cumsum(all_[::-1])[::-1]
    ok = np.flatnonzero(above & (right >= PRECISION * all_))
    if not len(ok):
        return float("inf")
    return float((values[max(ok[0] - 1, 0)] + values[ok[0]]) / 2) - 1e-6


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Add `base_<kind>` and `all_<kind>`, arrays of (start, end) in order."""
    made = with_candidates(with_base(docs))

    def bare(name: str) -> Column:
        return F.transform(name, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))

    for kind in KINDS:
        chooser = model.choosers.get(kind, Chooser())
        base = bare(f"_base_{kind}")
        if chooser.threshold < float("inf"):
            added = F.filter(f"_wide_{kind}", _of_kind(_chosen, chooser))
            made = made.withColumn(f"_wide_{kind}", added)
            every = F.array_sort(F.concat(base, bare(f"_wide_{kind}")))
        else:
            every = base
        made = made.withColumns({f"base_{kind}": base, f"all_{kind}": every})
    drop = [f"_{part}_{kind}" for part in ("base", "wide") for kind in KINDS]
    return made.drop("_text", *drop)


def listed(prefix: str) -> Column:
    """kind:start:end, by kind and start, comma-joined."""
    parts = [
        F.transform(f"{prefix}_{kind}", _of_kind(_named, kind)) for kind in KINDS
    ]
    return F.array_join(F.concat(*parts), ",")


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with every span replaced by its kind in brackets."""
    found = find(docs, model)
    spans = F.array_sort(
        F.concat(
            *(
                F.transform(f"all_{k}", _of_kind(_marked, k)) for k in KINDS
            )
        )
    )
    text = whole("text")
    cut = F.aggregate(
        "_spans",
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda a, s: F.when(s["start"] < a["at"], a).otherwise(
            F.struct(
                s["end"].alias("at"),
                F.concat(
                    a["out"],
                    F.substring(text, a["at"] + 1, s["start"] - a["at"]),
                    F.lit("["),
                    s["kind"],
                    F.lit("]"),
                ).alias("out"),
            )
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    marked = found.withColumn("_spans", spans)
    replaced = F.when(F.size("_spans") > 0, cut).otherwise(F.col("text"))
    return marked.withColumn("text", replaced).select(*docs.columns)
