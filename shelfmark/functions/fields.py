"""Fields taken out of free text: numbers, codes, publishers, parts of urls."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelfmark.functions.text import collapse, parse_int, trim

EM_DASH_PAGES = ("—", " c.")  # a Latin c
HYPHEN_PAGES = ("-", " с.")  # a Cyrillic с


def first_number(c: Column) -> Column:
    """The first run of digits, or null."""
    found = F.regexp_extract(c, r"(?U)\d+", 0)
    return F.when(found != "", found)


def pages_of_bib(bib: Column, separator: str, mark: str) -> Column:
    """The number before the mark in the first part that has it; 0 if there is none."""
    part = F.get(F.filter(F.split(bib, separator), lambda p: p.contains(mark)), 0)
    return parse_int(F.get(F.split(trim(part), " "), 0))


def isbn_of_bib(bib: Column, end: str) -> Column:
    """What follows ISBN up to the end mark; null without it."""
    after = F.get(F.split(bib, "ISBN"), 1)
    return F.get(F.split(trim(after), re.escape(end)), 0)


def publisher_of_bib(bib: Column) -> Column:
    found = F.regexp_extract(bib, "Издательство (.*?),", 1)
    return F.when(found != "", found)


def from_comma_list(c: Column) -> Column:
    """Year, pages and publisher of a comma-parted list: by the ending of a part; the last of a kind wins."""
    parts = F.filter(F.split(F.replace(c, F.lit("&nbsp;"), F.lit("")), ","), lambda p: p != "")
    year = F.filter(parts, lambda p: p.endswith("г."))
    pages = F.filter(parts, lambda p: ~p.endswith("г.") & p.endswith("с."))
    rest = F.filter(parts, lambda p: ~p.endswith("г.") & ~p.endswith("с."))
    last = lambda a: F.try_element_at(a, F.lit(-1))
    return F.struct(
        trim(F.replace(last(year), F.lit("г."), F.lit(""))).alias("year"),
        parse_int(F.replace(last(pages), F.lit("с."), F.lit(""))).alias("pages"),
        trim(last(rest)).alias("publisher"),
    )


def strip_parenthetical(c: Column) -> Column:
    return F.regexp_replace(c, r"\((.*?)\)", "")


def without_label(c: Column, label: str) -> Column:
    return trim(F.replace(c, F.lit(label), F.lit("")))


def last_segment(url: Column, cut: str, take: int = 0) -> Column:
    """A part of the last path segment, cut by a character: the first (0) or the last (-1)."""
    segment = F.element_at(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), -1)
    parts = F.split(segment, re.escape(cut))
    return F.get(parts, 0) if take == 0 else F.element_at(parts, -1)


def segment_before_slash(url: Column) -> Column:
    """The last non-empty path segment, whether or not a slash follows."""
    return F.element_at(F.split(F.regexp_replace(F.try_parse_url(url, F.lit("PATH")), "/$", ""), "/"), -1)


def query_parameter(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def numeric_id(c: Column) -> Column:
    """A 64-bit number in canonical form as text, or null."""
    return c.try_cast("bigint").cast("string")


def path_starts_with(url: Column, prefix: str) -> Column:
    return F.coalesce(F.startswith(F.try_parse_url(url, F.lit("PATH")), F.lit(prefix)), F.lit(False))


@F.pandas_udf(StringType())
def absolute_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """A reference resolved against the address of its page."""
    return pd.Series([None if b is None or h is None else urljoin(b, h) for b, h in zip(base, href, strict=True)], dtype=object)


def _with_initials(author: str | None, bib: str | None) -> str | None:
    if author is None or bib is None or not bib.strip():
        return author
    try:
        found = re.search(rf"(\w\.\w\.)?\W{author}\W(\w\.\w\.)?", bib)
    except re.error:
        return author
    if not found:
        return author
    first, second = found.group(1) or "", found.group(2) or ""
    return f"{author} {(first if first.strip() else second).strip()}"


@F.pandas_udf(StringType())
def with_initials(author: pd.Series, bib: pd.Series) -> pd.Series:
    """An author with the initials that stand next to the name in the description.

    The name is part of a pattern as it stands; where that is no valid pattern the name stays as it is.
    """
    return pd.Series([_with_initials(a, b) for a, b in zip(author, bib, strict=True)], dtype=object)


def normal_space(c: Column) -> Column:
    return collapse(c)
