"""Twelve catalogues: how each one's captured payloads become rows of books.

A connector has a name, the addresses it asks, a function from list payloads to item ids and one from
detail payloads (id, payload) to books.  A payload that cannot be read gives null fields, never a failed
job; rows without a name are kept, rows without an id are not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import fields as X
from shelfmark.functions.text import collapse, is_blank, parse_int, trim
from shelfmark.schema import as_books
from shelfmark.sources import html as H
from shelfmark.sources import payloads as P


@dataclass(frozen=True)
class Connector:
    """ids: list payloads to ids; book: columns of a detail payload; list_is_detail: list payloads hold whole books."""

    name: str
    list_url: str
    book_url: str | None
    ids: Callable[[DataFrame], DataFrame]
    books: Callable[[DataFrame], DataFrame]
    per_page: int | None = None
    list_is_detail: bool = False

    def discover(self, pages: DataFrame) -> DataFrame:
        """ElsName, ExternalId of list payloads (url, payload), each once."""
        found = self.ids(pages).select(F.lit(self.name).alias("ElsName"), F.col("id").cast("string").alias("ExternalId"))
        return found.dropna(subset=["ExternalId"]).dropDuplicates()

    def extract(self, raw: DataFrame) -> DataFrame:
        """Rows of books from detail payloads (id, payload)."""
        found = self.books(raw).withColumn("ElsName", F.lit(self.name)).withColumnRenamed("id", "ExternalId")
        return as_books(found.dropna(subset=["ExternalId"]))


def _dom(raw: DataFrame) -> DataFrame:
    return raw.withColumn("dom", H.elements("payload"))


def _text(element: Column) -> Column:
    return trim(element["text"])


def _links(pages: DataFrame, links: Column) -> DataFrame:
    return pages.select("url", F.explode(links).alias("href")).select(X.absolute_url("url", "href").alias("link"))


def _sitemap(prefix: str | None, id_of: Callable[[Column], Column]) -> Callable[[DataFrame], DataFrame]:
    def ids(pages: DataFrame) -> DataFrame:
        links = pages.select(F.explode(P.sitemap_urls(F.col("payload"))).alias("link"))
        links = links if prefix is None else links.where(X.path_starts_with(F.col("link"), prefix))
        return links.select(X.numeric_id(id_of(F.col("link"))).alias("id"))

    return ids


def _labelled(raw: DataFrame, block: Column, cls: str, fields: list[tuple[str, str]]) -> DataFrame:
    """Fields from labels and the text that follows each: spans two levels below a block."""
    direct = lambda e: F.exists(H.children(F.col("dom"), F.col("block")), lambda c: c["i"] == e["parent"])
    labels = F.filter(H.by_class(H.inside(F.col("dom"), F.col("block")), "span", cls), direct)
    out = raw.withColumn("block", block).withColumn("pairs", H.label_values(labels))
    names = [label for label, _ in fields]
    return out.withColumns({field: trim(H.routed(F.col("pairs"), names, k)) for k, (_, field) in enumerate(fields)})


# --- HTML catalogues ---------------------------------------------------------


def _academia_ids(pages: DataFrame) -> DataFrame:
    pages = _dom(pages)
    dom = F.col("dom")
    hrefs = F.transform(H.by_class(dom, "div", "title-book"), lambda d: H.attribute(H.first(H.by_tag(H.inside(dom, d), "a")), "href"))
    return _links(pages, hrefs).select(X.numeric_id(X.segment_before_slash(F.col("link"))).alias("id"))


def _academia(raw: DataFrame) -> DataFrame:
    dom = F.col("dom")
    out = _labelled(_dom(raw), H.first(H.by_class(dom, "div", "detailed-description")), "bold-text", [("ISBN", "ISBN"), ("Год", "Year"), ("Объем", "_pages")])
    authors = H.by_tag(H.inside(dom, H.first(H.by_class(dom, "div", "author-book"))), "a")
    return out.withColumns({"Name": H.first(H.by_tag(dom, "h1"))["text"], "Authors": H.joined_texts(authors), "Pages": parse_int(F.col("_pages"))})


def _biblioclub_ids(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode(P.from_payload(F.col("payload"), P.BIBLIOCLUB_SHORT)).alias("b")).select(X.numeric_id(F.col("b.id")).alias("id"))


def _biblioclub(raw: DataFrame) -> DataFrame:
    """payload: the short records; bib: the map of descriptions, keyed biblio:id; a missing entry is null."""
    bib = F.col("bib") if "bib" in raw.columns else F.lit(None).cast("string")
    each = raw.select(bib.alias("bibs"), F.explode(P.from_payload(F.col("payload"), P.BIBLIOCLUB_SHORT)).alias("b"))
    descriptions = F.from_json(F.col("bibs"), "map<string,string>")
    return each.select(
        X.numeric_id(F.col("b.id")).alias("id"), F.col("b.author").alias("Authors"), F.try_element_at(descriptions, F.concat(F.lit("biblio:"), "b.id")).alias("Bib"),
        F.col("b.isbn").alias("ISBN"), F.col("b.name").alias("Name"), F.col("b.publisher").alias("Publisher"), F.col("b.year").alias("Year"), parse_int(F.col("b.pages")).alias("Pages"),
    )


def _bibliorossica_ids(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode(P.from_payload(F.col("payload"), P.BIBLIOROSSICA_PAGE)["books"]).alias("b")).select(F.col("b.id_book").alias("id"))


def _bibliorossica(raw: DataFrame) -> DataFrame:
    dom = F.col("dom")
    out = _dom(raw).withColumn("box", H.by_id(dom, "explore_book"))
    inner = H.inside(dom, F.col("box"))
    title = H.inside(dom, H.first(H.by_class(inner, "div", "book_book_title")))
    out = out.withColumn("pairs", H.row_pairs(dom, H.first(H.by_tag(inner, "table"))))
    labels = ["Издатель", "Публикация", "Страниц", "ISBN"]
    of = lambda k, value="value": H.routed(F.col("pairs"), labels, k, value)
    return out.withColumns({
        "Authors": _text(H.first(H.by_tag(title, "strong"))), "Name": _text(H.first(H.by_tag(title, "span"))),
        "Bib": F.coalesce(_text(H.first(H.by_class(inner, "div", "bibliocard_info"))), F.lit("")),
        "Publisher": of(0), "Year": X.first_number(of(1)), "Pages": parse_int(of(2)), "ISBN": F.coalesce(of(3, "title"), of(3)),
    })


def _ibooks(pages: DataFrame) -> DataFrame:
    dom = F.col("dom")
    each = _dom(pages).select("dom", F.explode(H.by_class(dom, "div", "product__descr")).alias("block"))
    inner = H.inside(dom, F.col("block"))
    link = H.first(H.by_class(inner, "a", "product__name"))
    each = each.withColumn("inner", inner).withColumn("link", H.first(H.by_class(F.col("inner"), "a", "product__name"))).where("link is not null")
    inner, link = F.col("inner"), F.col("link")
    holding = lambda cls, label: H.first(F.filter(H.by_class(inner, "div", cls), lambda e: e["text"].contains(label)))["text"]
    about = F.transform(H.by_class(inner, "div", "product__text"), lambda e: e["text"])
    parts = X.from_comma_list(F.array_join(about, ","))
    return each.select(
        F.element_at(F.filter(F.split(H.attribute(link, "href"), "/"), lambda s: s != ""), -1).alias("id"), _text(link).alias("Name"),
        X.without_label(holding("product__article", "ISBN"), "ISBN").alias("ISBN"), X.without_label(holding("product__authors", "Авторы:"), "Авторы:").alias("Authors"),
        _text(H.first(H.by_class(inner, "a", "product__fulltext"))).alias("Bib"), parts["year"].alias("Year"), parts["pages"].alias("Pages"), parts["publisher"].alias("Publisher"),
    )


def _iprbookshop_ids(pages: DataFrame) -> DataFrame:
    return pages.select(F.explode(P.from_payload(F.col("payload"), P.IPRBOOKSHOP_SEARCH)["data"]).alias("b")).select(X.numeric_id(F.col("b.id")).alias("id"))


def _iprbookshop(raw: DataFrame) -> DataFrame:
    dom = F.col("dom")

    def pair(row: Column) -> Column:
        inner = H.inside(dom, row)
        return F.struct(H.first(H.by_tag(inner, "strong"))["text"].alias("label"), H.first(H.by_class(inner, "div", "col-sm-9"))["text"].alias("value"))

    pairs = F.filter(F.transform(H.by_class(dom, "div", "row"), pair), lambda p: ~is_blank(p["label"]))
    out = _dom(raw).withColumn("pairs", pairs)
    labels = ["Издательство", "Авторы", "Год издания", "ISBN"]
    title = H.first(H.by_class(H.inside(dom, H.first(H.by_class(dom, "div", "row-book"))), "h4", "mb-5"))
    of = {f: collapse(H.routed(F.col("pairs"), labels, k)) for k, f in enumerate(("Publisher", "Authors", "Year", "ISBN"))}
    return out.withColumns({"Name": collapse(title["text"]), "Bib": collapse(H.last(H.by_class(dom, "p", "book-description"))["text"]), **of})


def _studentlibrary_ids(pages: DataFrame) -> DataFrame:
    pages = _dom(pages)
    dom = F.col("dom")
    hrefs = F.filter(F.transform(H.by_tag(dom, "a"), lambda a: H.attribute(a, "href")), lambda h: h.contains("/book/"))
    return _links(pages, hrefs).select(X.last_segment(F.col("link"), ".").alias("id"))


def _studentlibrary(raw: DataFrame) -> DataFrame:
    dom = F.col("dom")
    labels = [("Авторы", "Authors"), ("Для каталога", "Bib"), ("Издательство", "Publisher"), ("Год издания", "Year")]
    out = _labelled(_dom(raw), H.first(H.by_class(dom, "div", "book_sticker_book")), "head", labels)
    bib = F.col("Bib")
    return out.withColumns({"Name": H.first(H.by_tag(dom, "h2"))["text"], "Pages": X.pages_of_bib(bib, *X.HYPHEN_PAGES), "ISBN": X.isbn_of_bib(bib, ", ")})


def _urait(raw: DataFrame) -> DataFrame:
    dom = F.col("dom")

    def pair(item: Column, tag: str, prefix: str) -> Column:
        inner = H.inside(dom, item)
        label = F.lower(_text(H.first(H.by_class(inner, tag, f"{prefix}__title"))))
        return F.struct(label.alias("label"), H.joined_texts(H.by_class(inner, tag, f"{prefix}__info")).alias("value"))

    produced = F.transform(H.by_class(dom, "div", "book-about-produce__item"), lambda d: pair(d, "span", "book-about-produce"))
    about = F.transform(H.by_class(dom, "div", "book-about-info__item"), lambda d: pair(d, "div", "book-about-info"))
    out = _dom(raw).withColumns({"produced": produced, "about": about})
    out = out.withColumn("Bib", H.routed(F.col("about"), ["библиографическое описание"], 0))
    labels = ["isbn", "страниц"]
    return out.withColumns({
        "Name": _text(H.first(H.by_class(dom, "h1", "book_title"))), "Authors": trim(H.first(H.by_class(dom, "ul", "creation-info__authors"))["first_text"]),
        "Year": _text(H.first(H.by_class(dom, "div", "creation-info__year"))), "ISBN": H.routed(F.col("produced"), labels, 0, exact=("isbn",)),
        "Pages": parse_int(H.routed(F.col("produced"), labels, 1, exact=("isbn",))), "Publisher": X.publisher_of_bib(F.col("Bib")),
    })


def _znanium(raw: DataFrame) -> DataFrame:
    dom = F.col("dom")
    out = _dom(raw).withColumn("links", H.by_class(H.inside(dom, H.first(H.by_class(dom, "div", "book-single__top-content-right"))), "div", "book-link"))
    links = F.col("links")
    of = lambda label: H.last(F.filter(links, lambda e: e["text"].contains(label)))
    people = lambda e: F.filter(H.by_tag(H.inside(dom, e), "a"), lambda a: a["text"] != "")
    authors = H.last(F.filter(links, lambda e: e["text"].contains("Авторы") & ~e["text"].contains("Издательство")))
    out = out.withColumn("pairs", H.colon_pairs(links))
    labels = ["isbn", "страниц", "год"]
    panel = F.filter(H.by_class(dom, "div", "tab-panel"), lambda e: H.attribute(e, "nav", "") == "bib")
    return out.withColumns({
        "Name": _text(H.first(H.by_class(dom, "h1", "book-single__title"))), "Bib": _text(H.first(panel)), "Publisher": H.first(H.by_tag(H.inside(dom, of("Издательство")), "a"))["text"],
        "Authors": F.when(authors.isNotNull(), H.joined_texts(people(authors))), "ISBN": H.routed(F.col("pairs"), labels, 0, exact=("isbn",)),
        "Pages": parse_int(H.routed(F.col("pairs"), labels, 1, exact=("isbn",))), "Year": H.routed(F.col("pairs"), labels, 2, exact=("isbn",)),
    })


# --- JSON catalogues ---------------------------------------------------------


def _bookru_ids(pages: DataFrame) -> DataFrame:
    item = P.from_payload(P.json_path(F.col("payload"), "pageProps.allServerData"), P.BOOKRU_CATEGORY)["item"]
    return pages.select(F.explode(item).alias("b")).select(X.numeric_id(F.col("b.id")).alias("id"))


def next_data(page: Column) -> Column:
    """The JSON text that a page carries in the element __NEXT_DATA__."""
    found = F.regexp_extract(page, r'(?s)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>', 1)
    return F.when(found != "", found)


def bookru_categories(pages: DataFrame) -> DataFrame:
    """id of every category of a start page's menu."""
    menu = P.from_payload(P.json_path(next_data(F.col("payload")), "props.pageProps.serverMenu"), P.BOOKRU_MENU)
    return pages.select(F.explode(P.category_ids(menu)).alias("id"))


def _bookru(raw: DataFrame) -> DataFrame:
    b = F.get(P.from_payload(P.json_path(F.col("payload"), "pageProps.serverDataBook.item"), P.BOOKRU_BOOK), 0)
    return raw.withColumn("b", b).where("b is not null").select(
        "id", F.col("b.author").alias("Authors"), F.col("b.biblio_desc").alias("Bib"), F.col("b.isbn").alias("ISBN"), F.col("b.name").alias("Name"),
        parse_int(F.col("b.pages")).alias("Pages"), F.col("b.year").alias("Year"), F.col("b.pub_name").alias("Publisher"),
    )


def _lanbook_ids(pages: DataFrame) -> DataFrame:
    body = P.from_payload(F.col("payload"), P.LANBOOK_LIST)["body"]
    both = F.concat(F.coalesce(body["items"], F.array().cast("array<struct<id:string>>")), F.coalesce(body["extra"], F.array().cast("array<struct<id:string>>")))
    return pages.select(F.explode(both).alias("b")).select(X.numeric_id(F.col("b.id")).alias("id"))


def _lanbook(raw: DataFrame) -> DataFrame:
    return raw.withColumn("b", P.from_payload(F.col("payload"), P.LANBOOK_BOOK)["body"]).where("b is not null").select(
        "id", F.col("b.authors").alias("Authors"), F.col("b.bibliorecord").alias("Bib"), F.col("b.isbn").alias("ISBN"), F.col("b.name").alias("Name"),
        parse_int(F.col("b.pages")).alias("Pages"), F.col("b.publishername").alias("Publisher"), F.coalesce("b.year", F.lit("")).alias("Year"),
    )


def _profspo(pages: DataFrame) -> DataFrame:
    each = pages.select(F.explode(P.from_payload(F.col("payload"), P.PROFSPO_SEARCH)["info"]["data"]).alias("b"))
    bib = F.coalesce("b.bibliography", F.lit(""))
    isbn = F.when(is_blank(F.col("b.isbn")), F.coalesce(X.isbn_of_bib(bib, ". "), F.col("b.isbn"))).otherwise(F.col("b.isbn"))
    return each.select(
        X.numeric_id(F.col("b.id")).alias("id"), F.col("b.authors").alias("Authors"), bib.alias("Bib"), isbn.alias("ISBN"), F.col("b.title").alias("Name"),
        F.col("b.year").alias("Year"), F.col("b.publishers").alias("Publisher"), X.pages_of_bib(bib, *X.EM_DASH_PAGES).alias("Pages"),
    )


def profspo_token(page: Column) -> Column:
    """The request token that a page carries in a meta element."""
    meta = F.filter(H.elements(page), lambda e: (e["tag"] == "meta") & F.coalesce(H.attribute(e, "name") == "csrf-token", F.lit(False)))
    return H.attribute(H.first(meta), "content")


def _rucont(raw: DataFrame) -> DataFrame:
    out = raw.withColumn("b", P.from_payload(F.col("payload"), P.RUCONT_BOOK)).where("b is not null")
    each = out.select("id", "b", F.posexplode_outer("b.authors").alias("at", "author"))
    each = each.withColumn("author", X.with_initials(trim(X.strip_parenthetical(F.col("author"))), F.col("b.bip_71_2003")))
    named = F.sort_array(F.collect_list(F.struct("at", "author")))
    joined = each.groupBy("id").agg(F.first("b").alias("b"), F.array_join(F.transform(named, lambda a: a["author"]), ", ").alias("Authors"))
    return joined.select(
        "id", "Authors", F.col("b.bip_71_2003").alias("Bib"), F.col("b.isbn_issn").alias("ISBN"), F.col("b.year").alias("Year"), F.col("b.title").alias("Name"),
        F.col("b.publisher").alias("Publisher"), parse_int(F.col("b.page_count")).alias("Pages"),
    )


CONNECTORS = {
    c.name: c
    for c in (
        Connector("AcademiaMoscow", "https://academia-moscow.ru/catalogue/4831/?PAGEN_1=%d", "https://academia-moscow.ru/catalogue/4831/%s/", _academia_ids, _academia),
        Connector("BiblioClub", "https://biblioclub.ru/services/service.php?page=books&m=GetShortInfo_S&parse&out=json", None, _biblioclub_ids, _biblioclub, 1000, True),
        Connector("BiblioRossica", "http://www.bibliorossica.com/catalog/perPage/50/page/%d/lang/all", "http://www.bibliorossica.com/book.html?currBookId=%s", _bibliorossica_ids, _bibliorossica, 50),
        Connector("BookRu", "https://www.book.ru/book", "https://book.ru/_next/data/%s/book/%s.json?", _bookru_ids, _bookru),
        Connector("IBooks", "https://ibooks.ru/products?page=%d&paging=100", None, lambda p: _ibooks(p).select("id"), _ibooks, 100, True),
        Connector("IprBookShop", "https://www.iprbookshop.ru/", "https://www.iprbookshop.ru/%s.html", _iprbookshop_ids, _iprbookshop, 20),
        Connector("LanBook", "https://e.lanbook.com/api/v2/catalog/books?category=0&limit=1000&page=%d", "https://e.lanbook.com/api/v2/catalog/book/%s", _lanbook_ids, _lanbook, 1000),
        Connector("ProfSpo", "https://profspo.ru/catalog/books/professions-and-specialties/search", None, lambda p: _profspo(p).select("id"), _profspo, None, True),
        Connector("RuCont", "https://rucont.ru/sitemaps/sitemap.xml", "https://lib.rucont.ru/api/efd/%s/full_info", _sitemap("/efd/", lambda u: F.element_at(F.split(F.try_parse_url(u, F.lit("PATH")), "/"), -1)), _rucont),
        Connector("StudentLibrary", "https://www.studentlibrary.ru/ru/catalogue/switch_kit/x-total/-esf2k2z11-year-dec-page-%d.html", "https://www.studentlibrary.ru/book/%s.html", _studentlibrary_ids, _studentlibrary),
        Connector("Urait", "https://urait.ru/sitemap.xml", "https://urait.ru/book/%s", _sitemap("/book/", lambda u: X.last_segment(u, "-", -1)), _urait),
        Connector("Znanium", "https://znanium.com/sitemap.xml", "https://znanium.com/catalog/document?id=%s", _sitemap(None, lambda u: X.query_parameter(u, "id")), _znanium),
    )
}
