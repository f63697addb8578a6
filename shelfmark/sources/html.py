"""Elements of HTML pages: one pass of the standard parser for a page, then array functions.

The parser keeps character references as they stand, as inner texts do.  Elements come in document
order.  A missing end tag closes with its parent; void elements have no content.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements that have no end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Index of an element, its parent and the last element inside it, elements above it; name, class, id; texts; attributes.
ELEMENT = T.StructType(
    [T.StructField(c, T.IntegerType()) for c in ("i", "parent", "last", "level")]
    + [T.StructField(c, T.StringType()) for c in ("tag", "cls", "id", "text", "next_text", "first_text")]
    + [T.StructField("attrs", T.MapType(T.StringType(), T.StringType()))]
)
#: Characters of pages, about, and pages whose elements a task holds at once.
HELD_CHARS, HELD_PAGES = 500_000, 2_000
_ATTRIBUTE = re.compile(r"""\s([^\s=<>/"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.rows: list[dict] = []
        self.open: list[int] = []
        self.names: Counter[str] = Counter()  # of the open elements
        self.closed: list[int | None] = [None]  # for each level the element that closed last and whose next sibling is still to come
        self.texts: list[str] = []
        self.spans: list[list[int]] = []  # of each element in texts
        # What follows an element and what it begins with: a text, the number of an element, or nothing.
        self.next: list[str | int | None] = []
        self.first: list[str | int | None] = []
        self.at = 0

    def updatepos(self, i: int, j: int) -> int:
        """The parser tells its place here; lines are not counted."""
        self.at = j
        return j

    def handle_starttag(self, tag: str, attrs: list) -> None:
        i, parent = len(self.rows), self.open[-1] if self.open else -1
        if attrs and "&" in (raw := self.get_starttag_text() or ""):  # the parser decodes values; here they stay as they stand
            attrs = [(m[1].lower(), m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or "") for m in _ATTRIBUTE.finditer(raw)]
        held = {k: v or "" for k, v in reversed(attrs)}
        before = self.closed[-1]
        if before is not None and self.next[before] is None:
            self.next[before] = i
        self.closed[-1] = None
        if parent >= 0 and self.first[parent] is None:
            self.first[parent] = i
        self.rows.append({"i": i, "parent": parent, "last": i, "level": len(self.open), "tag": tag, "cls": held.get("class"), "id": held.get("id"), "attrs": held})
        self.spans.append([len(self.texts), len(self.texts)])
        self.next.append(None)
        self.first.append(None)
        if tag in VOID:
            self.closed[-1] = i
        else:
            self.open.append(i)
            self.names[tag] += 1
            self.closed.append(None)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        while self.names[tag]:
            if self._close() == tag:
                break

    def _close(self) -> str:
        """Ends the innermost open element."""
        i = self.open.pop()
        self.closed.pop()
        self.closed[-1] = i
        row = self.rows[i]
        row["last"] = len(self.rows) - 1
        self.spans[i][1] = len(self.texts)
        self.names[row["tag"]] -= 1
        return row["tag"]

    def handle_data(self, text: str) -> None:
        """A text of the open element; it follows the element that closed last, unless another one came between."""
        self.texts.append(text)
        before = self.closed[-1]
        if before is not None:
            self.next[before] = (self.next[before] or "") + text
        elif self.open and not isinstance(self.first[self.open[-1]], int):
            self.first[self.open[-1]] = (self.first[self.open[-1]] or "") + text

    def _reference(self, text: str) -> None:
        """A reference as it stands: with a semicolon only where it has one."""
        end = self.at + len(text)
        self.handle_data(text + ";" if self.rawdata[end : end + 1] == ";" else text)

    def handle_entityref(self, name: str) -> None:
        self._reference(f"&{name}")

    def handle_charref(self, name: str) -> None:
        self._reference(f"&#{name}")

    def elements(self) -> list[dict]:
        while self.open:
            self._close()
        texts = ["".join(self.texts[a:b]) for a, b in self.spans]
        for row, text, behind, inner in zip(self.rows, texts, self.next, self.first, strict=True):
            row["text"] = text
            row["next_text"] = texts[behind] if isinstance(behind, int) else behind
            row["first_text"] = texts[inner] if isinstance(inner, int) else inner
        return self.rows


def parse(page: str | None) -> list[dict]:
    """The elements of one page; none for null or for a page that cannot be read."""
    if not page:
        return []
    tree = _Tree()
    try:
        tree.feed(page)
        tree.close()
    except Exception:  # noqa: BLE001  a broken page has no elements and must not end the job
        return []
    return tree.elements()


def _offsets(sizes: list[int]) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(sizes)), pa.int32())


def _arrays(doms: list[list[dict]]) -> pa.Array:
    """The elements of some pages, column by column: rows of nested values would cost as much as the parser."""
    rows = [e for dom in doms for e in dom]
    attrs = [e["attrs"] for e in rows]
    of_map = pa.MapArray.from_arrays(_offsets([len(a) for a in attrs]), pa.array([k for a in attrs for k in a], pa.string()), pa.array([v for a in attrs for v in a.values()], pa.string()))
    columns = [of_map if f.name == "attrs" else pa.array([e[f.name] for e in rows], pa.int32() if f.dataType == T.IntegerType() else pa.string()) for f in ELEMENT]
    return pa.ListArray.from_arrays(_offsets([len(dom) for dom in doms]), pa.StructArray.from_arrays(columns, ELEMENT.names))


@F.arrow_udf(T.ArrayType(ELEMENT))
def elements(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """All elements of each page in document order; a task holds those of some pages only, however many come at once."""
    for pages in batches:
        doms, chars = [], 0
        for page in pages:
            text = page.as_py()
            doms.append(parse(text))
            chars += len(text or "")
            if chars >= HELD_CHARS or len(doms) >= HELD_PAGES:
                yield _arrays(doms)
                doms, chars = [], 0
        if doms:
            yield _arrays(doms)


def by_tag(dom: Column, tag: str) -> Column:
    return F.filter(dom, lambda e: e["tag"] == tag)


def by_class(dom: Column, tag: str, part: str) -> Column:
    """Elements whose class attribute contains a text, as part of a longer name too."""
    return F.filter(dom, lambda e: (e["tag"] == tag) & F.coalesce(e["cls"].contains(part), F.lit(False)))


def by_class_equal(dom: Column, tag: str, cls: str) -> Column:
    return F.filter(dom, lambda e: (e["tag"] == tag) & F.coalesce(e["cls"] == cls, F.lit(False)))


def by_id(dom: Column, id_: str) -> Column:
    return F.get(F.filter(dom, lambda e: F.coalesce(e["id"] == id_, F.lit(False))), 0)


def inside(dom: Column, element: Column) -> Column:
    """The elements within an element, which stand behind it one after another; none if it is null."""
    found = F.slice(dom, element["i"] + 2, element["last"] - element["i"])
    return F.coalesce(found, F.filter(dom, lambda e: F.lit(False)))


def children(dom: Column, element: Column) -> Column:
    return F.filter(inside(dom, element), lambda e: e["parent"] == element["i"])


def first(found: Column) -> Column:
    return F.get(found, 0)


def last(found: Column) -> Column:
    return F.try_element_at(found, F.lit(-1))


def attribute(element: Column, name: str, default: str | None = None) -> Column:
    value = F.try_element_at(element["attrs"], F.lit(name))
    return value if default is None else F.coalesce(value, F.lit(default))


def texts(found: Column) -> Column:
    return F.transform(found, lambda e: e["text"])


def joined_texts(found: Column, separator: str = ", ") -> Column:
    """Trimmed texts, joined; empty for none."""
    return F.array_join(F.transform(found, lambda e: F.regexp_replace(e["text"], r"(?U)^\s+|\s+$", "")), separator)


def label_values(labels: Column) -> Column:
    """(label, value) of elements whose next sibling is the value."""
    return F.transform(labels, lambda e: F.struct(e["text"].alias("label"), e["next_text"].alias("value")))


def row_pairs(dom: Column, table: Column) -> Column:
    """(label, value, title) of the rows of a table that have exactly two cells."""
    cells = lambda row: by_tag(inside(dom, row), "td")
    rows = F.transform(by_tag(inside(dom, table), "tr"), cells)
    two = F.filter(rows, lambda c: F.size(c) == 2)
    trim = lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    return F.transform(two, lambda c: F.struct(trim(c[0]["text"]).alias("label"), trim(c[1]["text"]).alias("value"), attribute(c[1], "title").alias("title")))


def colon_pairs(found: Column) -> Column:
    """(label, value) of elements whose text has exactly one colon."""
    split = F.transform(texts(found), lambda t: F.split(t, ":"))
    two = F.filter(split, lambda p: F.size(p) == 2)
    return F.transform(two, lambda p: F.struct(F.lower(F.trim(p[0])).alias("label"), F.trim(p[1]).alias("value")))


def routed(pairs: Column, labels: list[str], k: int, value: str = "value", exact: tuple[str, ...] = ()) -> Column:
    """The value of the last pair whose first matching label is labels[k]; a label matches where it is contained, or equal if in exact."""
    hit = lambda p, x: (p["label"] == x) if x in exact else F.coalesce(p["label"].contains(x), F.lit(False))

    def mine(p: Column) -> Column:
        cond = hit(p, labels[k])
        for x in labels[:k]:
            cond = cond & ~hit(p, x)
        return cond

    return F.try_element_at(F.filter(pairs, mine), F.lit(-1))[value]
