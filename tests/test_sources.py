"""HTML, connectors, the store, requests and the stream."""

import json

import pytest

from pyspark.sql import functions as F

from shelfmark.operators.harvest import new_items, page_numbers, pages_of_total
from shelfmark.sources import html as H
from shelfmark.sources import http
from shelfmark.sources.connectors import CONNECTORS, profspo_token
from shelfmark.sources.store import BookStore
from shelfmark.streaming.harvest import harvest, payload_stream


def extract(spark, name, payload, id_="7", **more):
    columns = ["id", "payload", *more]
    row = CONNECTORS[name].extract(spark.createDataFrame([(id_, payload, *more.values())], ", ".join(f"{c} string" for c in columns))).collect()
    assert len(row) == 1 and row[0].ElsName == name
    return row[0]


def discover(spark, name, payload, url="https://c.example/x"):
    return sorted(r.ExternalId for r in CONNECTORS[name].discover(spark.createDataFrame([(url, payload)], "url string, payload string")).collect())


def test_parser_keeps_references_and_siblings():
    dom = H.parse('<p class="a b">x&nbsp;<b>y</b> z<br>w</p><a href="/q?a=1&amp;b">t')
    assert [(e["tag"], e["text"]) for e in dom] == [("p", "x&nbsp;y zw"), ("b", "y"), ("br", ""), ("a", "t")]
    assert dom[1]["next_text"] == " z" and dom[0]["first_text"] == "x&nbsp;" and dom[3]["attrs"]["href"] == "/q?a=1&amp;b"
    assert H.parse(None) == [] and H.parse("") == []


def test_html_catalogues(spark):
    b = extract(spark, "AcademiaMoscow", '<h1>N</h1><div class="author-book"><a>A B</a><a>C</a></div><div class="detailed-description"><p><span class="bold-text">ISBN:</span> 1-2</p><p><span class="bold-text">Год</span>2020</p><p><span class="bold-text">Объем</span> 33</p></div>')
    assert (b.Name, b.Authors, b.ISBN, b.Year, b.Pages) == ("N", "A B, C", "1-2", "2020", 33)
    b = extract(spark, "BiblioRossica", '<div id="explore_book"><div class="book_book_title"><strong>A</strong><span>N</span></div><div class="bibliocard_info"> bib </div><table><tr><td>Издатель</td><td>P</td></tr><tr><td>Публикация</td><td>М., 2011</td></tr><tr><td>Страниц</td><td>x</td></tr><tr><td>ISBN</td><td title="9">8</td></tr><tr><td>one</td></tr></table></div>')
    assert (b.Authors, b.Name, b.Bib, b.Publisher, b.Year, b.Pages, b.ISBN) == ("A", "N", "bib", "P", "2011", 0, "9")
    block = '<div class="product__descr"><a class="product__name" href="/b/12/">N</a><div class="product__article">ISBN 5</div><div class="product__authors">Авторы: A</div><a class="product__fulltext">bib</a><div class="product__text">Питер,&nbsp;2019 г.,320 с.</div></div>'
    assert CONNECTORS["IBooks"].list_is_detail
    b = extract(spark, "IBooks", block)
    assert (b.ExternalId, b.Name, b.ISBN, b.Authors, b.Bib, b.Year, b.Pages, b.Publisher) == ("12", "N", "5", "A", "bib", "2019", 320, "Питер")
    b = extract(spark, "IprBookShop", '<div class="row-book"><h4 class="mb-5"> N </h4></div><p class="book-description">x</p><p class="book-description"> bib  y</p><div class="row"><strong>Издательство</strong><div class="col-sm-9"> P </div></div><div class="row"><strong>Год издания</strong><div class="col-sm-9">2001</div></div>')
    assert (b.Name, b.Bib, b.Publisher, b.Year, b.Authors) == ("N", "bib y", "P", "2001", "")
    b = extract(spark, "StudentLibrary", '<h2>N</h2><div class="book_sticker_book"><p><span class="head">Авторы</span>A</p><p><span class="head">Для каталога</span>N - М., 2010. - 55 с. - ISBN 12-3, x</p></div>')
    assert (b.Name, b.Authors, b.Pages, b.ISBN) == ("N", "A", 55, "12-3")
    b = extract(spark, "Urait", '<h1 class="book_title"> N </h1><ul class="creation-info__authors"><li>A</li></ul><div class="creation-info__year">2020</div><div class="book-about-produce__item"><span class="book-about-produce__title">ISBN</span><span class="book-about-produce__info">1</span><span class="book-about-produce__info">2</span></div><div class="book-about-info__item"><div class="book-about-info__title">Библиографическое описание</div><div class="book-about-info__info">Издательство Юрайт, 2020</div></div>')
    assert (b.Name, b.Authors, b.Year, b.ISBN, b.Publisher) == ("N", "A", "2020", "1, 2", "Юрайт")
    b = extract(spark, "Znanium", '<h1 class="book-single__title">N</h1><div class="tab-panel" nav="bib">bib</div><div class="book-single__top-content-right"><div class="book-link">Издательство: <a>P</a></div><div class="book-link">Авторы: <a>A</a><a>B</a></div><div class="book-link">ISBN: 5</div><div class="book-link">Количество страниц: 12</div><div class="book-link">Год издания: 1999</div></div>')
    assert (b.Name, b.Bib, b.Publisher, b.Authors, b.ISBN, b.Pages, b.Year) == ("N", "bib", "P", "A, B", "5", 12, "1999")


def test_json_catalogues(spark):
    b = extract(spark, "LanBook", json.dumps({"Body": {"Name": "N", "Year": 2020, "Authors": "A", "BiblioRecord": "b", "ISBN": "1", "Pages": "12", "PublisherName": "P"}}))
    assert (b.Name, b.Year, b.Authors, b.Bib, b.ISBN, b.Pages, b.Publisher) == ("N", "2020", "A", "b", "1", 12, "P")
    b = extract(spark, "BookRu", json.dumps({"pageProps": {"serverDataBook": {"item": [{"biblio_desc": "b", "Author": "A", "Pages": None, "Year": "1", "pub_name": "P", "Name": "N", "ISBN": "9"}]}}}))
    assert (b.Bib, b.Authors, b.Pages, b.Publisher, b.Name) == ("b", "A", 0, "P", "N")
    data = [{"Id": 5, "Authors": "A", "Bibliography": "N — М. — 103 c. — ISBN 978-5. — Т", "ISBN": None, "Title": "N", "Year": "1", "Publishers": "P"}]
    b = extract(spark, "ProfSpo", json.dumps({"Info": {"last_page": 3, "Data": data}}))
    assert (b.ExternalId, b.Pages, b.ISBN) == ("5", 103, "978-5")
    b = extract(spark, "RuCont", json.dumps({"Authors": ["Иванов (ред.)", "Ив(анов"], "bip_71_2003": "К / А.Б. Иванов, x", "isbN_ISSN": "1", "page_count": 4, "Publisher": "P", "Title": "N", "Year": "2"}))
    assert (b.Authors, b.Pages, b.Name, b.ISBN) == ("Иванов А.Б., Ив(анов", 4, "N", "1")
    b = extract(spark, "BiblioClub", json.dumps([{"Id": 133, "Author": "A", "Name": "N", "Pages": 103}]), bib=json.dumps({"biblio:133": "b"}))
    assert (b.ExternalId, b.Bib, b.Pages) == ("133", "b", 103)
    assert CONNECTORS["LanBook"].extract(spark.createDataFrame([("1", "no json")], "id string, payload string")).count() <= 1


def test_discovery(spark):
    site = '<urlset><url><loc>https://c.example/{}</loc></url><url><loc>https://c.example/other/9</loc></url></urlset>'
    assert discover(spark, "RuCont", site.format("efd/12")) == ["12"] and discover(spark, "RuCont", site.format("efd/12/")) == []
    assert discover(spark, "Urait", site.format("book/a-007")) == ["7"]
    assert discover(spark, "Znanium", site.format("catalog/document?id=5")) == ["5"]
    assert discover(spark, "AcademiaMoscow", '<div class="title-book"><a href="/catalogue/1/33/">x</a></div><div class="title-book"><a href="/c/abc/">x</a></div>') == ["33"]
    assert discover(spark, "LanBook", '{"body":{"Items":[{"Id":1},{"Id":2}],"Extra":[{"Id":2},{"Id":3}],"Total":3}}') == ["1", "2", "3"]
    assert discover(spark, "BiblioRossica", '{"Books":[{"id_book":"a"}],"Count":1}') == ["a"]
    assert discover(spark, "IprBookShop", '{"Count":1,"Data":[{"Id":"x"},{"Id":4}]}') == ["4"]
    assert discover(spark, "BookRu", '{"pageProps":{"allServerData":{"Item":[{"Id":8}]}}}') == ["8"]
    assert discover(spark, "BiblioClub", '[{"Id":1}]') == ["1"] and discover(spark, "ProfSpo", '{"Info":{"Data":[{"Id":2}]}}') == ["2"]
    assert discover(spark, "StudentLibrary", '<a href="/book/ISBN5.html">x</a><a href="/y">z</a>') == ["ISBN5"]
    page = spark.createDataFrame([('<meta name="csrf-token" content="T">',)], "p string")
    assert page.select(profspo_token(F.col("p"))).first()[0] == "T"


def test_pages(spark):
    rows = spark.createDataFrame([(100,), (0,)], "n int")
    assert [r.page for r in page_numbers(rows.where("n = 100"), pages_of_total(F.col("n"), 50), 2).collect()] == [2, 3]


def test_store(spark, tmp_path):
    store = BookStore(spark, str(tmp_path / "books"))
    assert store.all().count() == 0
    rows = spark.createDataFrame([("1", "A", "n"), (None, "A", "x"), ("2", "B", "m")], "ExternalId string, ElsName string, Name string")
    assert store.create_many(rows) and store.all().count() == 2
    assert [r.ExternalId for r in store.stored_ids("A").collect()] == ["1"]
    found = spark.createDataFrame([("A", "1"), ("A", "3"), ("A", "3"), ("A", None)], "ElsName string, ExternalId string")
    assert [r.ExternalId for r in new_items(found, store.stored_ids("A")).collect()] == ["3"]
    assert store.update(F.col("ExternalId") == "2", Name="k", Compared=True)
    assert {(r.ExternalId, r.Name, r.Compared) for r in store.all().collect()} == {("1", "n", False), ("2", "k", True)}
    assert "ISBN" not in store.read_without("ISBN").columns


def test_store_rewrites_only_what_changes(spark, tmp_path):
    row = "Id string, ElsName string, ExternalId string, Name string"
    store, other = (BookStore(spark, f"{tmp_path}/b") for _ in range(2))
    assert store.update_many(spark.createDataFrame([("x", "new")], "Id string, Name string")) and store.all().count() == 0
    for k in "abc":
        assert store.create_many(spark.createDataFrame([(k, f"E{k}", k, "old"), (f"{k}2", f"E{k}", f"{k}2", None)], row))
    assert store.create_many(spark.createDataFrame([("n", None, "n", "no catalogue"), ("e", "", "e", "")], row)) and store.all().count() == 6
    files = lambda k: {f.name for f in (tmp_path / "b" / f"ElsName=E{k}").glob("*.parquet")}
    before = {k: files(k) for k in "abc"}
    assert store.update_many(spark.createDataFrame([("b", "new"), ("x", "new"), (None, "new")], "Id string, Name string"))
    assert files("a") == before["a"] and files("c") == before["c"] and not files("b") & before["b"]
    want = {"a": "old", "b": "new", "c": "old", "a2": None, "b2": None, "c2": None}
    assert {r.Id: r.Name for r in other.all().collect()} == want
    with pytest.raises(ValueError):
        store.update_many(spark.createDataFrame([("b", "Ea")], "Id string, ElsName string"))
    plan = store.touched(spark.createDataFrame([("b",)], "_key string"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [ElsName" in plan.replace("isnotnull(ElsName", "ElsName")


def test_requests():
    waits = []
    answers = iter([("", 500), OSError(), ("x", 200)])

    def opener(url, data):
        a = next(answers)
        if isinstance(a, OSError):
            raise a
        return a

    assert http.get_text("u", opener, sleep=waits.append) == ("x", 200) and waits == [1.0]
    assert http.get_text("u", lambda u, d: ("", 404)) == ("", 404)
    assert http.get_text("u", lambda u, d: ("", 500), sleep=waits.append) == (None, None)
    assert http.post_form("u", {"a": "1"}, lambda u, d: (d.decode(), 200)) == ("a=1", 200)


def test_stream_equals_batch(spark, tmp_path):
    source, store = tmp_path / "in", BookStore(spark, str(tmp_path / "books"))
    source.mkdir()
    one = lambda i: json.dumps({"id": str(i), "payload": json.dumps({"body": {"name": f"N{i}"}})})
    for k in range(3):
        (source / f"{k}.json").write_text("\n".join(one(i) for i in (k, k + 1)))
    for _ in range(2):
        harvest(payload_stream(spark, str(source), files_per_batch=1), CONNECTORS["LanBook"], store, str(tmp_path / "cp")).awaitTermination()
    assert sorted(r.ExternalId for r in store.all().collect()) == ["0", "1", "2", "3"]
