"""Elements within elements, by a structural join of intervals.

An element is the interval of its page from its own number to that of the last element inside it.  The elements of
a page are sorted by number and read once; a stack holds the ancestors that are open, and a descendant meets those on it.
That is linear in the elements and the pairs, and a page is not held in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def intervals(pages: DataFrame, id_col: str, dom: Column) -> DataFrame:
    """page, start, end, level, tag: a row for each element."""
    each = F.transform(dom, lambda e: F.struct(e["i"].alias("start"), e["last"].alias("end"), e["level"].alias("level"), e["tag"].alias("tag")))
    return pages.select(F.col(id_col).alias("page"), F.explode(each).alias("e")).select("page", "e.*")


def descendants(elements: DataFrame, ancestor: Column, descendant: Column) -> DataFrame:
    """page, ancestor, start, tag, depth: each element that meets descendant within each that meets ancestor, by number, and how far below."""
    kind = elements.schema["page"].dataType.simpleString()
    marked = elements.select("page", "start", "end", "level", "tag", ancestor.alias("outer"), descendant.alias("inner")).where("outer or inner")
    dealt = marked.repartition("page").sortWithinPartitions("page", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, held = None, []  # open ancestors: start, end, level
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for p, start, end, level, tag, outer, inner in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if p != page:
                    page, held = p, []
                while held and held[-1][1] < start:
                    held.pop()
                if inner:
                    for a, _, above in held:
                        for column, value in zip(out, (p, a, start, tag, level - above), strict=True):
                            column.append(value)
                if outer:
                    held.append((start, end, level))
            kinds = [b.schema.field("page").type, pa.int32(), pa.int32(), pa.string(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], ["page", "ancestor", "start", "tag", "depth"])

    return dealt.mapInArrow(run, f"page {kind}, ancestor int, start int, tag string, depth int")
