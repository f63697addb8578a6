"""Schemas of JSON and XML payloads and how they are read.

Numbers are declared as text and cast, since services send them either way.  Names are matched
without regard to case by lower-casing the keys of the payload and of the schema.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fields of each payload, all in lower case.
BIBLIOCLUB_SHORT = "array<struct<id:string,author:string,name:string,isbn:string,publisher:string,year:string,pages:string>>"
BIBLIOROSSICA_PAGE = "struct<books:array<struct<id_book:string>>,count:string>"
BOOKRU_MENU = "array<struct<menu:array<struct<id:string,name:string>>>>"
BOOKRU_CATEGORY = "struct<item:array<struct<id:string>>>"
BOOKRU_BOOK = "array<struct<biblio_desc:string,author:string,pages:string,year:string,pub_name:string,name:string,isbn:string>>"
IPRBOOKSHOP_SEARCH = "struct<count:string,data:array<struct<id:string>>>"
LANBOOK_LIST = "struct<body:struct<items:array<struct<id:string>>,extra:array<struct<id:string>>,total:string>>"
LANBOOK_BOOK = "struct<body:struct<name:string,year:string,authors:string,bibliorecord:string,isbn:string,pages:string,publishername:string>>"
PROFSPO_SEARCH = (
    "struct<info:struct<last_page:string,data:array<struct<authors:string,bibliography:string,id:string,isbn:string,publishers:string,title:string,year:string>>>>"
)
RUCONT_BOOK = (
    "struct<authors:array<string>,efd_id:string,bip_71_2003:string,isbn_issn:string,page_count:string,publisher:string,title:string,year:string,efd_type:string>"
)


def lower_keys(json: Column) -> Column:
    """Lower-cases the keys of a JSON text; values stay."""
    parts = F.regexp_extract_all(json, F.lit(r'"(?:[^"\\]|\\.)*"(?:\s*:)?|[^"]+'), F.lit(0))
    return F.array_join(F.transform(parts, lambda p: F.when(p.rlike(r'(?s)^".*"\s*:$'), F.lower(p)).otherwise(p)), "")


def from_payload(json: Column, schema: str) -> Column:
    """A payload in a schema; null where it is no JSON of that kind."""
    return F.from_json(lower_keys(json), schema)


def json_path(json: Column, path: str) -> Column:
    """The part of a JSON text at a dotted path, as text."""
    return F.get_json_object(json, f"$.{path}")


def sitemap_urls(xml: Column) -> Column:
    """The addresses of a list of pages."""
    return F.transform(F.from_xml(xml, "url array<struct<loc:string>>")["url"], lambda u: F.trim(u["loc"]))


def sitemap_index(xml: Column) -> Column:
    """The addresses of the lists that a sitemap index names."""
    return F.transform(F.from_xml(xml, "sitemap array<struct<loc:string>>")["sitemap"], lambda u: F.trim(u["loc"]))


def category_ids(menu: Column) -> Column:
    """The ids of all menu items but the one of new books."""
    items = F.flatten(F.transform(menu, lambda m: m["menu"]))
    return F.transform(F.filter(items, lambda i: i["id"] != "new"), lambda i: i["id"])
