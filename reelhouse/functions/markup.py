"""Queries over parsed pages.

`parse` turns a page into a flat list of nodes; everything else is a Spark
expression over that list. A node stands at its `pos` in the list and spans the positions
to `last`, so what is inside it is a slice, and a lookup costs the size of its own part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelhouse.functions.text import bind, strip

NODE_LIST = (
    "array<struct<pos:int,last:int,parent:int,tag:string,class:string,"
    "classes:array<string>,attrs:map<string,string>,text:string>>"
)
# The same for Arrow.
_NODES = pa.list_(
    pa.struct(
        [
            ("pos", pa.int32()),
            ("last", pa.int32()),
            ("parent", pa.int32()),
            ("tag", pa.string()),
            ("class", pa.string()),
            ("classes", pa.list_(pa.string())),
            ("attrs", pa.map_(pa.string(), pa.string())),
            ("text", pa.string()),
        ]
    )
)
# Pages flattened at a time: nodes take many times the room of their page.
PAGES_AT_ONCE = 128
TEXT = "#text"
SCRIPT = "#script"
# Elements without content.
VOID = set("area base br col embed hr img input link meta source track wbr".split())


class _Flattener(HTMLParser):
    """Collects nodes in document order; an unclosed element ends with its parent."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[list] = []
        self.open: list[int] = []

    def _add(self, tag, attrs=None, text=None) -> int:
        pos = len(self.nodes)
        attrs = attrs or {}
        parent = self.open[-1] if self.open else -1
        names = attrs.get("class") or ""
        self.nodes.append([pos, pos, parent, tag, names, names.split(), list(attrs.items()), text])
        return pos

    def handle_starttag(self, tag, attrs):
        pos = self._add(tag, {k: v or "" for k, v in attrs})
        if tag not in VOID:
            self.open.append(pos)

    def handle_startendtag(self, tag, attrs):
        self._add(tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag):
        if any(self.nodes[p][3] == tag for p in self.open):
            while self.nodes[self.open[-1]][3] != tag:
                self._close()
            self._close()

    def handle_data(self, data):
        inside = self.nodes[self.open[-1]][3] if self.open else ""
        self._add(SCRIPT if inside in ("script", "style") else TEXT, text=data)

    def _close(self):
        self.nodes[self.open.pop()][1] = len(self.nodes) - 1

    def finish(self) -> list[tuple]:
        self.close()
        while self.open:
            self._close()
        return [tuple(n) for n in self.nodes]


def _flatten(html: str | None) -> list[tuple] | None:
    if html is None:
        return None
    try:
        flattener = _Flattener()
        flattener.feed(html)
        return flattener.finish()
    except Exception:  # a page that breaks the parser is a null list, not a failed task
        return None


def _flatten_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for pages in batches:
        for start in range(0, len(pages), PAGES_AT_ONCE):
            some = pages.slice(start, PAGES_AT_ONCE)
            yield pa.array([_flatten(page.as_py()) for page in some], type=_NODES)


def parse(html: Column) -> Column:
    """Nodes of a page; the one Python step, in Arrow batches handed on in short pieces."""
    return F.arrow_udf(_flatten_batches, T.DataType.fromDDL(NODE_LIST))(html)


def has_class(node: Column, name: str) -> Column:
    return F.array_contains(node["classes"], name)


def is_(tag: str, name: str | None = None, **attrs: str) -> Callable[[Column], Column]:
    """Test for a tag, a class and attribute values."""

    def test(node: Column) -> Column:
        found = node["tag"] == tag
        if name is not None:
            found &= has_class(node, name)
        for key, value in attrs.items():
            found &= F.coalesce(node["attrs"][key.replace("_", "-")] == value, F.lit(False))
        return found

    return test


def _behind(node: Column, start: Column) -> Column:
    return F.coalesce(node["pos"] > start, F.lit(False))


def _inside(node: Column, outer: Column) -> Column:
    return _behind(node, outer["pos"]) & (node["pos"] <= outer["last"])


def find_all(nodes: Column, test: Callable[[Column], Column], within: Column | None = None) -> Column:
    """Nodes passing the test, inside `within` if given; nothing is inside a missing node."""
    if within is None:
        return F.filter(nodes, test)
    return bind(within, lambda w: F.filter(part(nodes, w), test))


def part(nodes: Column, outer: Column) -> Column:
    """The nodes inside a node; none for a missing node."""
    return _stretch(nodes, outer["pos"], outer["last"])


def _stretch(nodes: Column, after: Column, last: Column) -> Column:
    """Nodes behind position `after` up to `last`; null if there is no page."""
    found = F.slice(nodes, after + 2, F.greatest(F.lit(0), last - after))
    return F.when(nodes.isNotNull(), F.coalesce(found, F.array().cast(NODE_LIST)))


def first(found: Column) -> Column:
    return F.get(found, F.lit(0))


def find(nodes: Column, test: Callable[[Column], Column], within: Column | None = None) -> Column:
    return first(find_all(nodes, test, within))


def next_after(nodes: Column, test: Callable[[Column], Column], node: Column) -> Column:
    """First passing node that starts behind the start of `node`."""
    return bind(
        node["pos"], lambda start: first(F.filter(_stretch(nodes, start, F.size(nodes)), test))
    )


def next_sibling(nodes: Column, test: Callable[[Column], Column], node: Column) -> Column:
    """First passing node behind `node` under the same parent."""
    def behind(b: Column) -> Column:
        end = F.when(b["parent"] >= 0, F.get(nodes, b["parent"])["last"]).otherwise(F.size(nodes))
        siblings = _stretch(nodes, b["last"], end)
        return first(F.filter(siblings, lambda n: (n["parent"] == b["parent"]) & test(n)))

    return bind(node, behind)


def descendants(
    nodes: Column,
    outer: Callable[[Column], Column],
    inner: Callable[[Column], Column],
    within: Column | None = None,
) -> Column:
    """Nodes passing `inner` that lie inside some node passing `outer`, in document order."""
    if within is None:
        return inside_any(nodes, inner, find_all(nodes, outer))
    return bind(
        within, lambda w: inside_any(part(nodes, w), inner, F.filter(part(nodes, w), outer))
    )


def inside_any(nodes: Column, test: Callable[[Column], Column], outers: Column) -> Column:
    """Nodes passing the test that lie inside one of the given nodes, in document order."""
    return bind(
        outers,
        lambda os: F.filter(nodes, lambda n: test(n) & F.exists(os, lambda o: _inside(n, o))),
    )


def text(nodes: Column, node: Column, sep: str = "") -> Column:
    """Stripped text pieces inside a node, joined; null for a missing node."""

    def joined(n: Column) -> Column:
        inner = F.filter(part(nodes, n), lambda t: t["tag"] == TEXT)
        pieces = F.transform(inner, lambda t: strip(t["text"]))
        return F.when(n.isNotNull(), F.array_join(F.filter(pieces, lambda p: p != ""), sep))

    return bind(node, joined)


def texts(nodes: Column, found: Column) -> Column:
    return F.transform(found, lambda n: text(nodes, n))
