"""Every catalogue from its list pages to the store, with captured answers in place of the network."""

import json
import re
import sys

import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from shelfmark.__main__ import main, parser
from shelfmark.plans.harvest import SOURCES, Harvest, HarvestOptions
from shelfmark.sources.connectors import CONNECTORS
from shelfmark.sources.store import BookStore

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import tests


def answer(url, form):
    """What the services say; form: (name, value) of a POST."""
    of = dict(form or [])
    page = re.search(r"(?:PAGEN_1|page|dec-page-|/page/)[=-]?(\d+)", url)
    page = int(of.get("page") or (page[1] if page else 1))
    urls = lambda *links: "<urlset>" + "".join(f"<url><loc>{x}</loc></url>" for x in links) + "</urlset>"
    index = lambda *links: "<sitemapindex>" + "".join(f"<sitemap><loc>{x}</loc></sitemap>" for x in links) + "</sitemapindex>"
    if "academia" in url:
        return f'<ul class="pagination"><li>1</li><li>2</li><li>»</li></ul><div class="title-book"><a href="/catalogue/4831/{page}/">x</a></div>' if "PAGEN" in url else "<h1>N</h1>"
    if "service.php" in url:
        return json.dumps([{"Id": int(v), "Author": "A", "Name": f"N{v}"} for k, v in form if k == "books_ids[]" and int(v) % 2])
    if "action=blocks" in url:
        return json.dumps({x: f"bib {x}" for x in url.split("list=")[1].split(",")})
    if "bibliorossica" in url:
        return json.dumps({"Books": [{"id_book": f"b{page}"}], "Count": 60}) if "catalog" in url else '<div id="explore_book"><div class="book_book_title"><span>N</span></div></div>'
    if url.endswith("book.ru/book"):
        return '<script id="__NEXT_DATA__" type="application/json">' + json.dumps({"buildId": "B1", "props": {"pageProps": {"serverMenu": [{"Menu": [{"Id": "new"}, {"Id": "5"}]}]}}}) + "</script>"
    if "/cat/" in url:
        return json.dumps({"pageProps": {"allServerData": {"Item": [{"Id": 8}]}}}) if "B1/cat/5" in url else None
    if "B1/book/8.json" in url:
        return json.dumps({"pageProps": {"serverDataBook": {"item": [{"name": "N"}]}}})
    if "ibooks" in url:
        return f'<div class="pagination"><a>1</a><a>3</a></div><div class="product__descr"><a class="product__name" href="/b/{page}/">N</a></div>'
    if "iprbookshop" in url:
        return json.dumps({"Count": 25, "Data": [{"Id": page}]}) if form else '<div class="row-book"><h4 class="mb-5">N</h4></div>'
    if "lanbook" in url:
        return json.dumps({"body": {"Items": [{"Id": page}], "Total": 1500}}) if "limit" in url else json.dumps({"body": {"name": "N"}})
    if "profspo.ru/catalog/books" in url and not form:
        return '<meta name="csrf-token" content="T">'
    if "profspo" in url:
        number = [v for k, v in form if k == "page"][-1]
        return json.dumps({"Info": {"last_page": 2, "Data": [{"Id": int(number), "Title": "N"}]}}) if of["_token"] == "T" else None
    if "rucont" in url and "sitemap" in url:
        return index("https://rucont.ru/s1", "https://rucont.ru/s2") if url.endswith("sitemap.xml") else None
    if "rucont.ru/s" in url:
        return urls(f"https://rucont.ru/efd/{url[-1]}")
    if "full_info" in url:
        return json.dumps({"Title": "N", "Authors": ["A"]})
    if "studentlibrary" in url:
        return f'<a class="a_jmp_page">2</a><a href="/book/ISBN{page}.html">x</a>' if "switch_kit" in url else "<h2>N</h2>"
    if "urait" in url:
        return urls("https://urait.ru/book/a-7", "https://urait.ru/book/b-8") if "sitemap" in url else '<h1 class="book_title">N</h1>'
    if url.endswith("znanium.com/sitemap.xml"):
        return index("https://znanium.com/s1")
    if url.endswith("znanium.com/s1"):
        return urls("https://znanium.com/catalog/document?id=5")
    return '<h1 class="book-single__title">N</h1>' if "znanium" in url else None


def get(addresses):
    @F.pandas_udf("string")
    def ask(urls: pd.Series, forms: pd.Series) -> pd.Series:
        return pd.Series([answer(u, None if f is None else [(x["name"], x["value"]) for x in f]) for u, f in zip(urls, forms, strict=True)], dtype=object)

    form = F.col("form") if "form" in addresses.columns else F.lit(None).cast("array<struct<name:string,value:string>>")
    return addresses.withColumn("payload", ask("url", form)).drop("form")


WANT = {
    "AcademiaMoscow": {"1", "2"}, "BiblioClub": {"1", "3", "5"}, "BiblioRossica": {"b1", "b2"}, "BookRu": {"8"}, "IBooks": {"1", "2", "3"}, "IprBookShop": {"1", "2"}, "LanBook": {"1", "2"},
    "ProfSpo": {"1", "2"}, "RuCont": {"1", "2"}, "StudentLibrary": {"ISBN1", "ISBN2"}, "Urait": {"7", "8"}, "Znanium": {"5"},
}


@pytest.mark.parametrize("name", sorted(SOURCES))
def test_harvest(spark, tmp_path, name):
    store = BookStore(spark, str(tmp_path / "books"))
    job = Harvest(name, store, HarvestOptions(batch=2, start_id=1, end_id=7), get)
    assert set(SOURCES) == set(CONNECTORS) and job.run() == len(WANT[name])
    rows = store.all().collect()
    assert {r.ExternalId for r in rows} == WANT[name] and len(rows) == len(WANT[name])
    assert all(r.Name.startswith("N") and r.ElsName == name for r in rows)
    assert name != "BiblioClub" or {r.Bib for r in rows} == {"bib biblio:1", "bib biblio:3", "bib biblio:5"}
    assert Harvest(name, store, HarvestOptions(batch=2, start_id=1, end_id=7), get).run() == 0 and store.all().count() == len(rows)


def test_command_line(spark, tmp_path):
    options = parser().parse_args(["harvest", "LanBook", "--cs", "x"])
    assert (options.th, options.proxy, options.bs, options.db, options.cn, options.si, options.ei, options.sp) == (1, "", 100, "ELS", "Books", 1, 1_000_000, 1)
    assert main(["harvest", "LanBook", "--cs", str(tmp_path), "--sp", "2"], spark, get) == 0
    store = BookStore(spark, str(tmp_path / "ELS" / "Books"))
    assert [r.ExternalId for r in store.all().collect()] == ["2"]
    assert main(["compare", "--cs", str(tmp_path), "--lb", "0.2"], spark) == 0 and store.all().first().Compared
    with pytest.raises(SystemExit):
        parser().parse_args(["compare"])
