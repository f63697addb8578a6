"""A harvest of one catalogue: list pages, ids not stored yet, detail pages, rows of books, batch by batch into the store.

Every step is a table: addresses go through ``get`` (as many requests at a time as asked for), payloads
through the connector.  How a catalogue tells its list pages is a function from a job to the table of their payloads.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import is_blank, trim
from shelfmark.operators.harvest import id_range, new_items, page_numbers, pages_of_pager, pages_of_total
from shelfmark.sources import html as H
from shelfmark.sources import payloads as P
from shelfmark.sources.connectors import CONNECTORS, bookru_categories, next_data, profspo_token
from shelfmark.sources.http import Client, fetch
from shelfmark.plans.metrics import Metrics
from shelfmark.scratch import stash
from shelfmark.sources.store import BookStore

log = logging.getLogger("shelfmark.harvest")

# What every request says of itself, and what one catalogue wants besides.
HEADERS = {
    "Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,image/avif,image/webp,image/apng,*/*;q=0.8,application/signed-exchange;v=b3;q=0.9",
    "Accept-Language": "en-US,en;q=0.9",
    "User-Agent": "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/87.0.4280.88 Safari/537.36",
}
PROFSPO_HEADERS = {"X-Requested-With": "XMLHttpRequest"}
#: The fields of a search form, empty but those named.
PROFSPO_FIELDS = "title authors publishers higher_education year1 year2 profileCode profileId discipline_id collection common page mark discipline _token page".split()
IPRBOOKSHOP_URL = "https://www.iprbookshop.ru/78575"
#: Ids of a request for short records and for descriptions.
BIBLIOCLUB_IDS, BIBLIOCLUB_BIBS = 1000, 50


@dataclass(frozen=True)
class HarvestOptions:
    """Requests at a time, proxy (host:port), books of a batch, first and last id (last excluded), first page."""

    threads: int = 1
    proxy: str = ""
    batch: int = 100
    start_id: int = 1
    end_id: int = 1_000_000
    start_page: int = 1


@dataclass
class Harvest:
    """One run.  get: adds payload and status to a table of addresses (url and, for a POST, form)."""

    name: str
    store: BookStore
    options: HarvestOptions = field(default_factory=HarvestOptions)
    get: Callable[[DataFrame], DataFrame] | None = None
    metrics: Metrics = field(default_factory=Metrics)

    def __post_init__(self) -> None:
        if self.get is None:
            headers = HEADERS | (PROFSPO_HEADERS if self.name == "ProfSpo" else {})
            client = Client(headers, f"http://{self.options.proxy}" if self.options.proxy else "")
            self.get = lambda addresses: fetch(addresses.repartition(max(1, self.options.threads)), client)

    @property
    def connector(self):
        return CONNECTORS[self.name]

    def one(self, url: str, form: Column | None = None) -> DataFrame:
        """The payload of one address."""
        address = self.store.spark.createDataFrame([(url,)], "url string")
        return self.get(address if form is None else address.withColumn("form", form))

    def pages(self, url: str, number: Column, first: DataFrame, form: Callable[[Column], Column] | None = None) -> DataFrame:
        """Payloads of all list pages, whose number the first one tells."""
        numbered = page_numbers(first.select(F.coalesce(number, F.lit(1)).alias("pages")), F.col("pages"), self.options.start_page)
        addresses = numbered.select(F.format_string(url, "page") if "%d" in url else F.lit(url), "page").toDF("url", "page")
        return self.get(addresses.withColumn("form", form(F.col("page"))) if form else addresses)

    def run(self) -> int:
        """Stores the books that are not stored yet; returns their number.  A batch that is not saved is an error."""
        lists = SOURCES[self.name](self)
        if lists is None:
            log.error("%s: no access, nothing is asked", self.name)
            return 0
        # Payloads are written before they are read again: a lost executor must not ask the catalogue a second time and get other pages.
        lists = stash(lists, "lists")
        found = stash(self.metrics.of(new_items(self.connector.discover(lists), self.store.stored_ids(self.name)), f"{self.name}: new items"), "found")
        total = dict((step, value) for step, figure, value in self.metrics.rows() if figure == "rows")[f"{self.name}: new items"]
        log.info("%s: all list pages are read, %d new items", self.name, total)
        batches = max(1, -(-total // max(1, self.options.batch)))
        of = F.pmod(F.xxhash64("ExternalId"), F.lit(batches))
        books = stash(self.details(lists, found).withColumn("batch", of), "details", "batch") if self.connector.list_is_detail else None
        waiting = stash(found.withColumn("batch", of), "batches", "batch") if books is None else None
        for k in range(batches if total else 0):  # each reads its own partition
            rows = books.where(F.col("batch") == k).drop("batch") if books is not None else self.connector.extract(self.raw(waiting.where(F.col("batch") == k).drop("batch")))
            if not self.store.create_many(self.metrics.of(rows, f"{self.name}: batch {k}")):
                raise RuntimeError(f"{self.name}: batch {k} was not saved; a new run goes on from it")
        log.info("%s: all books are saved", self.name)
        self.metrics.report()
        return total

    def details(self, lists: DataFrame, found: DataFrame) -> DataFrame:
        """Books of list payloads that hold whole books, the new ones, each once."""
        books = self.connector.extract(lists)
        return books.join(found, ["ElsName", "ExternalId"], "left_semi").dropDuplicates(["ExternalId"]).select(books.columns)

    def raw(self, some: DataFrame) -> DataFrame:
        """id and payload of detail pages; an address that gives nothing has no row."""
        url = F.format_string(self.connector.book_url.replace("%s", self.build(), 1) if self.name == "BookRu" else self.connector.book_url, "ExternalId")
        got = self.get(some.select(F.col("ExternalId").alias("id"), url.alias("url")))
        return got.where(~is_blank(F.col("payload"))).select("id", "payload")

    def build(self) -> str:
        """The build number that one catalogue has in its addresses."""
        if not hasattr(self, "_build"):
            self._build = self.one(self.connector.list_url).select(P.json_path(next_data(F.col("payload")), "buildId")).first()[0] or ""
        return self._build


def fields(**values: Column) -> Column:
    """A form of (name, value)."""
    return F.array(*[F.struct(F.lit(k).alias("name"), v.cast("string").alias("value")) for k, v in values.items()])


def _by_total(schema: str, total: Callable[[Column], Column]) -> Callable[[Harvest], DataFrame]:
    def source(job: Harvest) -> DataFrame:
        url = job.connector.list_url
        number = pages_of_total(total(P.from_payload(F.col("payload"), schema)).cast("long"), job.connector.per_page)
        return job.pages(url, number, job.one(url % 1))

    return source


def _by_pager(tag: str) -> Callable[[Harvest], DataFrame]:
    def source(job: Harvest) -> DataFrame:
        dom = F.col("dom")
        pager = H.children(dom, H.first(H.by_class(dom, tag, "pagination")))
        first = job.one(job.connector.list_url % 1).withColumn("dom", H.elements("payload"))
        return job.pages(job.connector.list_url, pages_of_pager(H.texts(pager)), first)

    return source


def _by_jump_link(job: Harvest) -> DataFrame:
    first = job.one(job.connector.list_url % 1).withColumn("dom", H.elements("payload"))
    jump = H.first(H.by_class(F.col("dom"), "a", "a_jmp_page"))["text"]
    return job.pages(job.connector.list_url, F.coalesce(trim(jump).try_cast("int"), F.lit(1)), first)


def _sitemap(job: Harvest) -> DataFrame:
    return job.one(job.connector.list_url)


def _sitemap_index(job: Harvest) -> DataFrame:
    """The lists that an index names."""
    return job.get(job.one(job.connector.list_url).select(F.explode(P.sitemap_index(F.col("payload"))).alias("url")))


def _biblioclub(job: Harvest) -> DataFrame:
    """Short records by ranges of ids, then their descriptions, some ids a request."""
    ids = id_range(job.store.spark, job.options.start_id, job.options.end_id).withColumn("batch", F.floor(F.col("id") / BIBLIOCLUB_IDS))
    pair = lambda name, value: F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"))
    form = F.concat(F.array(pair("books_sort", F.lit(1))), F.transform(F.sort_array(F.collect_list("id")), lambda i: pair("books_ids[]", i)))
    short = job.get(ids.groupBy("batch").agg(form.alias("form")).select(F.lit(job.connector.list_url).alias("url"), "form")).select("payload")
    each = short.select(F.explode(F.from_json("payload", "array<string>")).alias("record"))
    each = each.withColumn("id", F.coalesce(F.get_json_object("record", "$.Id"), F.get_json_object("record", "$.id"))).where("id is not null")
    grouped = each.groupBy(F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.lit(-(-(job.options.end_id - job.options.start_id) // BIBLIOCLUB_BIBS)))).alias("batch"))
    listed = grouped.agg(F.concat(F.lit("["), F.array_join(F.collect_list("record"), ","), F.lit("]")).alias("records"), F.array_join(F.collect_list(F.concat(F.lit("biblio:"), "id")), ",").alias("list"))
    asked = job.get(listed.select(F.concat(F.lit("https://biblioclub.ru/index.php?action=blocks&list="), "list").alias("url"), "records"))
    return asked.select("url", F.col("records").alias("payload"), F.col("payload").alias("bib"))


def _iprbookshop(job: Harvest) -> DataFrame:
    form = lambda page: fields(page=page)
    first = job.one(IPRBOOKSHOP_URL, form(F.lit(1)))
    total = P.from_payload(F.col("payload"), P.IPRBOOKSHOP_SEARCH)["count"].cast("long")
    return job.pages(IPRBOOKSHOP_URL, pages_of_total(total, job.connector.per_page), first, form)


def _profspo(job: Harvest) -> DataFrame | None:
    """Search pages, with a token from the catalogue's start page; none without it."""
    token = job.one("https://profspo.ru/catalog/books").select(profspo_token(F.col("payload")).alias("token")).first()[0]
    if not (token or "").strip():
        return None

    def form(page: Column) -> Column:
        value = {"higher_education": F.lit("1"), "_token": F.lit(token)}
        each = [value.get(name, F.lit("")) for name in PROFSPO_FIELDS]
        each[PROFSPO_FIELDS.index("page")], each[-1] = F.lit("1"), page.cast("string")
        return F.array(*[F.struct(F.lit(name).alias("name"), v.alias("value")) for name, v in zip(PROFSPO_FIELDS, each, strict=True)])

    first = job.one(job.connector.list_url, form(F.lit(1)))
    last = P.from_payload(F.col("payload"), P.PROFSPO_SEARCH)["info"]["last_page"].cast("int")
    return job.pages(job.connector.list_url, last, first, form)


def _bookru(job: Harvest) -> DataFrame:
    categories = bookru_categories(job.one(job.connector.list_url))
    return job.get(categories.select(F.format_string(f"https://book.ru/_next/data/{job.build()}/cat/%s.json", "id").alias("url")))


SOURCES: dict[str, Callable[[Harvest], DataFrame | None]] = {
    "AcademiaMoscow": _by_pager("ul"),
    "BiblioClub": _biblioclub,
    "BiblioRossica": _by_total(P.BIBLIOROSSICA_PAGE, lambda p: p["count"]),
    "BookRu": _bookru,
    "IBooks": _by_pager("div"),
    "IprBookShop": _iprbookshop,
    "LanBook": _by_total(P.LANBOOK_LIST, lambda p: p["body"]["total"]),
    "ProfSpo": _profspo,
    "RuCont": _sitemap_index,
    "StudentLibrary": _by_jump_link,
    "Urait": _sitemap,
    "Znanium": _sitemap_index,
}
