"""What the review of round 3 found: references, capitals, pages in bounded parts, rows dealt out."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from shelfmark import queries
from shelfmark.functions import text as T
from shelfmark.operators.blocks import common_token_pairs, count_common_token
from shelfmark.operators.near import signatures
from shelfmark.operators.overlap import overlap_pairs
from shelfmark.operators.similar import candidates, near_candidates, with_keys
from shelfmark.plans.compare import derived_books
from shelfmark.schema import as_books
from shelfmark.sources import html as H


def test_a_reference_stands_as_it_is():
    dom = H.parse("<a>x&amp;&am</a><b>&#12;y&#12 z</b><i>&</i>&copy")
    assert [e["text"] for e in dom] == ["x&amp;&am", "&#12;y&#12 z", "&"]
    assert H.parse("&am<b>c</b>&lt;d&lt e<i></i>")[0] | {"attrs": 0} == {"i": 0, "parent": -1, "last": 0, "level": 0, "tag": "b", "cls": None, "id": None, "attrs": 0, "text": "c", "next_text": "&lt;d&lt e", "first_text": "c"}


def test_elements_of_pages_come_in_bounded_parts():
    pages = ["<p a=1>x</p>", None, "", "<ul><li>y</li></ul>"] * 2_000
    parts = list(H.elements.func(iter([pa.array(pages), pa.array(["<b>" + "z" * H.HELD_CHARS + "</b>", "<i>q</i>"])])))
    assert sum(map(len, parts)) == len(pages) + 2 and max(map(len, parts)) <= H.HELD_PAGES
    assert [len(p) for p in parts[-2:]] == [1, 1]
    rows = [[{**e, "attrs": dict(e["attrs"])} for e in dom] for p in parts for dom in p.to_pylist()]
    assert rows[:4] == [H.parse(p) for p in pages[:4]] and rows[-1] == H.parse("<i>q</i>")


def test_many_closed_elements_cost_no_square():
    dom = H.parse("<ul>" + "<li><a>k</a></li>" * 30_000 + "</ul>")
    assert len(dom) == 60_001 and dom[1]["next_text"] == "k" and dom[-1]["next_text"] is None


def test_rows_of_pages_are_dealt_to_all_cores(spark, sf_dir):
    for query in (queries.html_label_pairs, queries.html_children):
        assert query(spark, sf_dir).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_an_initial_is_one_letter(spark, tmp_path):
    letters = {"ß": "ẞ", "ä": "Ä", "ﬁ": "ﬁ", "ᾳ": "ᾼ", "ŉ": "ŉ", "1": "1"}
    got = spark.createDataFrame([(c,) for c in letters], "c string").select("c", T.upper_letter(F.col("c")).alias("u")).collect()
    assert {r.c: r.u for r in got} == letters
    spark.createDataFrame([(6, "Ge ßo sa", "de", "s")], "doc_id long, text string, lang string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    assert derived_books(spark, str(tmp_path)).first().Authors == "Ge ẞ. S."


def test_candidates_of_books_already_compared(spark):
    rows = [("a", "Karlson", True, "river stone"), ("b", "Karlsen", True, "river north"), ("c", "Lee", False, "river"), ("d", "Karlson", False, "light")]
    books = as_books(spark.createDataFrame([(i, "E", i, n, a, c) for i, a, c, n in rows], "Id string, ElsName string, ExternalId string, Name string, Authors string, Compared boolean"))
    pairs = lambda **o: [(r.a, r.b) for r in near_candidates(with_keys(books), **o).collect()]
    assert pairs() == [] and pairs(compared=True) == [("a", "b")]


def test_short_keys_that_share_a_beginning_hardly_meet(spark):
    rng = random.Random(3)
    keys = {"sta" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)}
    marks = signatures(spark.createDataFrame([(k,) for k in keys], "key string"))
    x, y = (marks.where(F.col("role") == r).select("h", F.col("key").alias(k)) for r, k in ((0, "x"), (1, "y")))
    assert x.join(y, "h").where("x <> y").count() < 10_000


def test_names_are_tested_where_books_meet(spark):
    names = ["river stone light", "river stone night", "river house garden window", "one two three four five six", "six five four three ten nine"]
    rows = [(str(i), "E", str(i), n, "Karlson", False) for i, n in enumerate(names)]
    books = as_books(spark.createDataFrame(rows, "Id string, ElsName string, ExternalId string, Name string, Authors string, Compared boolean"))
    keyed = with_keys(books)
    assert {(r.a, r.b) for r in near_candidates(keyed, overlap=0.4).collect()} == {("0", "1"), ("3", "4")}
    assert {(r.a, r.b) for r in near_candidates(keyed).collect()} == {("0", "1"), ("0", "2"), ("1", "2"), ("3", "4")}


def test_pairs_of_frequent_tokens_are_made_once_and_do_not_move(spark):
    rng = random.Random(4)
    sets = {f"{i:03}": sorted({rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 9))}) for i in range(120)}
    keyed = spark.createDataFrame([(i, "".join(t), t) for i, t in sets.items()], "Id string, name_key string, name_tokens array<string>")
    share = {(a, b) for a in sets for b in sets if a < b and set(sets[a]) & set(sets[b])}
    frame = candidates(keyed)
    assert sorted((r.a, r.b) for r in frame.collect()) == sorted(share)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.index("MapInArrow") < plan.index("Exchange") and count_common_token(keyed).agg(F.sum("n")).first()[0] == len(share)
    near = {(r.a, r.b) for r in common_token_pairs(keyed, edit=0.3).collect()}
    assert near <= share and {p for p in share if sets[p[0]] == sets[p[1]]} <= near
    passing = {(a, b) for a, b in share if min(len(sets[a]), len(sets[b])) >= 5 and len(set(sets[a]) & set(sets[b])) >= 0.6 * min(len(sets[a]), len(sets[b])) - 1e-9}
    found = overlap_pairs(keyed)
    assert sorted((r.a, r.b) for r in found.collect()) == sorted(passing)
    assert "HashAggregate" not in found._jdf.queryExecution().executedPlan().toString().split("ShuffledHashJoin")[0]
