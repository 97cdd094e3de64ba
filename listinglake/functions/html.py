"""HTML pages as arrays of element rows, queried with column expressions.

``html_nodes`` is the only Python in the HTML path: an Arrow function that turns
each page into a flat, document-ordered list of nodes.  A node knows where its
subtree ends, so "inside of" is a slice and every selection rule stays a Spark
expression.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from listinglake.functions.arrays import first_where, let
from listinglake.functions.text import strip

# Ship the Arrow function by value, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TEXT = "#text"
# Characters of pages whose nodes are Python objects at one time, in bytes.
SLICE_BYTES = 1 << 20
# Texts of attributes that are read once for the pages of a slice, and how long they may be.
KNOWN_TEXTS, KNOWN_CHARS = 4096, 256
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)

# Elements with raw content, start tags, end tags, comments and other markup.
_ATTRS = r"""((?:[^>=]++|=\s*"[^"]*"|=\s*'[^']*'|=)*+)"""
_MARKUP = re.compile(
    rf"<(script|style|template)\b{_ATTRS}>.*?(?:</\1\s*>|\Z)"
    rf"|<([a-z][^\s/>]*){_ATTRS}>"
    r"|</([a-z][^\s/>]*)[^>]*>"
    r"|<!--.*?(?:-->|\Z)|<[!?/][^>]*>",
    re.IGNORECASE | re.DOTALL,
)
_ATTR = re.compile(
    r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?"""
)


class _NodeTable:
    """Column lists of the nodes of many pages, filled page by page.

    An end tag closes the nearest open element of that name and everything opened
    since; an end tag with no such element is ignored.
    """

    def __init__(self, attrs: tuple[str, ...], keep_blanks: bool):
        self.attrs = attrs
        self.keep_blanks = keep_blanks
        self.i: list[int] = []
        self.tag: list[str] = []
        self.end: list[int] = []
        self.depth: list[int] = []
        self.text: list[str | None] = []
        # The wanted attributes of each node, and of each attribute text that was met.
        self.found: list[tuple[str | None, ...]] = []
        self.none = (None,) * len(attrs)
        self.known: dict[str, tuple[str | None, ...]] = {"": self.none}

    def add_page(self, page: str) -> None:
        tags, known = self.tag, self.known
        base, at = len(tags), 0
        stack: list[int] = []
        for m in _MARKUP.finditer(page):
            begin, stop = m.span()
            if begin > at:
                self._add_text(base, len(stack), page[at:begin])
            at = stop
            raw, raw_attrs, start, attrs, closing = m.groups()
            if closing:
                closing = closing.lower()
                for level in range(len(stack) - 1, -1, -1):
                    if tags[stack[level]] == closing:
                        self._close(stack, level, base)
                        break
            elif start:
                start = start.lower()
                found = known.get(attrs)
                self._add(base, start, len(stack), None, self._read(attrs) if found is None else found)
                if start not in VOID_TAGS and not attrs.endswith("/"):
                    stack.append(len(tags) - 1)
            elif raw:
                self._add(base, raw.lower(), len(stack), None, self._read(raw_attrs))
        if at < len(page):
            self._add_text(base, len(stack), page[at:])
        self._close(stack, 0, base)
        self.i.extend(range(len(tags) - base))

    def _add(self, base, tag, depth, text, found):
        self.tag.append(tag)
        self.end.append(len(self.tag) - base)
        self.depth.append(depth)
        self.text.append(text)
        self.found.append(found)

    def _add_text(self, base: int, depth: int, text: str) -> None:
        if self.keep_blanks or not text.isspace():
            self._add(base, TEXT, depth, html.unescape(text) if "&" in text else text, self.none)

    def _close(self, stack: list[int], level: int, base: int) -> None:
        end = len(self.tag) - base
        for at in stack[level:]:
            self.end[at] = end
        del stack[level:]

    def _read(self, text: str) -> tuple[str | None, ...]:
        """Wanted attributes of a tag; class names end up blank-separated."""
        found: dict[str, str] = {}
        lower = text.lower()
        if any(name in lower for name in self.attrs):
            for name, double, single, bare in _ATTR.findall(text):
                name = name.lower()
                if name in self.attrs:
                    value = html.unescape(double or single or bare)
                    found[name] = " ".join(value.split()) if name == "class" else value
        values = tuple(map(found.get, self.attrs)) if found else self.none
        if len(text) <= KNOWN_CHARS and len(self.known) < KNOWN_TEXTS:
            self.known[text] = values
        return values

    def values(self) -> list[tuple[str | None, ...]]:
        """A column for each wanted attribute."""
        return list(zip(*self.found)) if self.found else [()] * len(self.attrs)


def _field(attr: str) -> str:
    return attr.replace("-", "_")


def html_nodes(body: Column, attrs: list[str], keep_blanks: bool = False) -> Column:
    """array<struct(i, tag, end, depth, text, one field per attribute)>.

    ``i`` counts from 0, ``end`` is one past the last descendant.  Only the named
    attributes cross the Python boundary; a dash in a name becomes an underscore.
    Blank text pieces are left out unless asked for; scripts and styles have no text.
    """
    names = tuple(attrs)
    ddl = ", ".join(
        ["i: INT", "tag: STRING", "end: INT", "depth: INT", "text: STRING"]
        + [f"`{_field(a)}`: STRING" for a in names]
    )

    @F.arrow_udf(f"ARRAY<STRUCT<{ddl}>>")
    def flatten(pages: pa.Array) -> pa.Array:
        # Python holds the nodes of a few pages at a time, Arrow the others.
        parts, start, size = [], 0, 0
        for at, length in enumerate(pc.binary_length(pages).to_pylist()):
            size += length or 0
            if size >= SLICE_BYTES:
                parts.append(flatten_slice(pages[start : at + 1]))
                start, size = at + 1, 0
        return pa.concat_arrays([*parts, flatten_slice(pages[start:])])

    def flatten_slice(pages: pa.Array) -> pa.Array:
        rows = _NodeTable(names, keep_blanks)
        offsets: list[int | None] = []
        for page in pages:
            page = page.as_py()
            offsets.append(len(rows.tag) if page is not None else None)
            if page is not None:
                rows.add_page(page)
        offsets.append(len(rows.tag))
        columns = [
            pa.array(rows.i, pa.int32()), pa.array(rows.tag, pa.string()),
            pa.array(rows.end, pa.int32()), pa.array(rows.depth, pa.int32()),
            pa.array(rows.text, pa.string()),
            *[pa.array(v, pa.string()) for v in rows.values()],
        ]
        fields = ["i", "tag", "end", "depth", "text", *map(_field, names)]
        nodes = pa.StructArray.from_arrays(columns, fields)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), nodes)

    return flatten(body)


def inside(nodes: Column, node: Column) -> Column:
    """All descendants of a node, in document order; null node -> null."""
    return let(node, lambda n: F.slice(nodes, n["i"] + 2, n["end"] - n["i"] - 1))


def has_class(node: Column, name: str) -> Column:
    """The class list holds exactly this name."""
    padded = F.concat(F.lit(" "), node["class"], F.lit(" "))
    return F.coalesce(padded.contains(f" {name} "), F.lit(False))


def class_contains(node: Column, part: str) -> Column:
    """Some class name contains this text."""
    return F.coalesce(node["class"].contains(part), F.lit(False))


def is_tag(node: Column, *tags: str) -> Column:
    return node["tag"].isin(list(tags)) if len(tags) > 1 else node["tag"] == tags[0]


def find_all(nodes: Column, test: Callable[[Column], Column]) -> Column:
    return F.filter(nodes, test)


def find(nodes: Column, test: Callable[[Column], Column]) -> Column:
    return first_where(nodes, test)


def join_texts(nodes: Column, separator: str = "") -> Column:
    """Trimmed text pieces of a node list, blank ones dropped, joined."""
    pieces = F.transform(
        F.filter(nodes, lambda n: n["tag"] == TEXT), lambda n: strip(n["text"])
    )
    return F.array_join(F.filter(pieces, lambda t: t != ""), separator)


def text_of(nodes: Column, node: Column, separator: str = "") -> Column:
    """Trimmed text pieces below a node, joined; null node -> null."""
    return join_texts(inside(nodes, node), separator)


def texts_of(nodes: Column, picked: Column, separator: str = "") -> Column:
    """``text_of`` for every picked node."""
    return F.transform(picked, lambda n: text_of(nodes, n, separator))


def markup_text(nodes: Column, node: Column) -> Column:
    """A subtree with every tag replaced by one space and text left as it is.

    Needs nodes taken with ``keep_blanks``.  Between two neighbours the number of
    closing tags is the drop in depth; void elements have no closing tag.
    """

    def depth_after(n: Column) -> Column:
        opens = (n["tag"] != TEXT) & ~n["tag"].isin(sorted(VOID_TAGS))
        return n["depth"] + opens.cast("int")

    def piece(sub: Column) -> Callable[[Column, Column], Column]:
        def render(n: Column, j: Column) -> Column:
            before = F.when(
                j > 0, depth_after(F.get(sub, j - 1)) - n["depth"]
            ).otherwise(0)
            escaped = F.replace(n["text"], F.lit("&"), F.lit("&amp;"))
            escaped = F.replace(escaped, F.lit("<"), F.lit("&lt;"))
            escaped = F.replace(escaped, F.lit(">"), F.lit("&gt;"))
            return F.concat(
                F.repeat(F.lit(" "), before), F.coalesce(escaped, F.lit(" "))
            )

        return render

    return let(
        inside(nodes, node), lambda sub: F.array_join(F.transform(sub, piece(sub)), "")
    )


def label_values(nodes: Column, box: Column, label: str, value: str) -> Column:
    """Label/value pairs in ``p.mb-0`` lines of a box: list<struct(key, value)>.

    A line counts when it holds both a span whose class contains ``label`` and one
    whose class contains ``value``.
    """

    def pair(p: Column) -> Column:
        return let(
            inside(nodes, p),
            lambda line: F.struct(
                F.upper(
                    text_of(
                        nodes,
                        find(line, lambda s: is_tag(s, "span") & class_contains(s, label)),
                    )
                ).alias("key"),
                text_of(
                    nodes,
                    find(line, lambda s: is_tag(s, "span") & class_contains(s, value)),
                ).alias("value"),
            ),
        )

    lines = find_all(
        inside(nodes, box), lambda n: is_tag(n, "p") & has_class(n, "mb-0")
    )
    return F.filter(
        F.transform(lines, pair),
        lambda kv: kv["key"].isNotNull() & kv["value"].isNotNull(),
    )
