"""The index of books, overlap, near keys, dictionaries, structure, stream state and figures against brute force."""

import random
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfmark.functions.score import OVERLAP_BORDER
from shelfmark.operators import overlap, structure
from shelfmark.operators.dictionary import dictionary_hits
from shelfmark.operators.index import BookIndex
from shelfmark.operators.near import near_keys
from shelfmark.operators.similar import similar_edges, with_keys
from shelfmark.plans.compare import compare_new
from shelfmark.plans.metrics import Metrics, Progress
from shelfmark.schema import as_books
from shelfmark.scratch import stash
from shelfmark.sources import html as H
from shelfmark.sources.store import BookStore
from shelfmark.streaming import state


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def books(spark, n, seed=3):
    rng = random.Random(seed)
    words = "river stone north valley ancient harbour light winter bridge garden".split()
    rows = [(f"b{i:03}", f"E{i % 3}", str(i), " ".join(rng.sample(["Karlson", "Petrov", "Petrow", "Lee"], rng.randint(1, 2))), " ".join(rng.sample(words, rng.randint(3, 7))), False) for i in range(n)]
    return as_books(spark.createDataFrame(rows, "Id string, ElsName string, ExternalId string, Authors string, Name string, Compared boolean"))


def test_near_keys_around_the_long_border(spark):
    rng = random.Random(9)
    keys = set()
    for _ in range(8):
        base = [rng.choice("abc") for _ in range(rng.choice([44, 58, 61, 63, 90]))]
        for _ in range(6):
            x = list(base)
            for _ in range(rng.randrange(0, len(x) // 3)):
                x[rng.randrange(len(x))] = rng.choice("abcd")
                if rng.random() < 0.4:
                    x.pop(rng.randrange(len(x)))
            keys.add("".join(x))
    table = spark.createDataFrame([(k,) for k in keys], "key string")
    for border in (0.1, 0.3):
        got = {(r.x, r.y) for r in near_keys(table, border).collect()}
        assert got == {(a, b) for a in keys for b in keys if lev(a, b) / max(len(a), len(b)) <= border}
    with pytest.raises(ValueError):
        near_keys(table, 1.0)


def test_a_very_long_key_is_harmless(spark):
    rng = random.Random(2)
    some = [("".join(rng.choice("abcdefgh") for _ in range(9)),) for _ in range(200)]
    near_keys(spark.createDataFrame(some, "key string")).count()
    began = time.perf_counter()
    near_keys(spark.createDataFrame([*some, ("".join(rng.choice("abcdefgh") for _ in range(5000)),)], "key string")).count()
    assert time.perf_counter() - began < 30


def test_index_in_runs_gives_the_links_of_one(spark, tmp_path):
    keyed = stash(with_keys(books(spark, 45)), "keyed")
    row = lambda df: {(r.from_id, r.to_id, round(r.coeff, 9)) for r in df.collect()}
    want = row(similar_edges(keyed))
    index = BookIndex(spark, str(tmp_path / "index"), buckets=5)
    turn = F.col("ExternalId").cast("int") % 4
    got = row(index.add(keyed.where(turn < 2)))
    # What a run that broke off has left behind is not read, and written over.
    keyed.where(turn == 2).select("Id", "author_keys", "name_key", "name_tokens", F.lit(1).alias("bucket")).write.partitionBy("bucket").parquet(str(tmp_path / "index" / "books" / "run=2"))
    got |= row(index.add(keyed.where(turn == 2)))
    assert row(index.add(keyed.where(turn < 3))) == set()
    got |= row(index.add(keyed.where(turn == 3)))
    assert got == want and len(want) > 50
    figures = {r.run: (r.books, r.keys) for r in index.runs().collect()}
    assert sum(b for b, _ in figures.values()) == keyed.count() and figures[3] == (0, 0)
    assert row(index.add(keyed.limit(0))) == set()


def test_new_books_of_a_store_are_compared_by_the_index(spark, tmp_path):
    store, index = BookStore(spark, str(tmp_path / "books")), BookIndex(spark, str(tmp_path / "index"), buckets=3)
    every = books(spark, 20)
    for part in (F.col("Id") < "b012", F.col("Id") >= "b012"):
        assert store.create_many(every.where(part)) and compare_new(store, index)
    want = Counter(r.from_id for r in similar_edges(with_keys(every)).collect())
    assert {r.Id: r.SimilarCount for r in store.all().collect()} == {f"b{i:03}": want[f"b{i:03}"] for i in range(20)}
    assert store.all().where("not Compared").count() == 0


def test_overlap_pairs(spark, monkeypatch):
    monkeypatch.setattr(overlap, "SALTED", 3)
    rng = random.Random(4)
    sets = {f"{i:03}": rng.sample("abcdefghijklmnop", rng.randint(3, 12)) for i in range(60)}
    keyed = spark.createDataFrame(list(sets.items()), "Id string, name_tokens array<string>")
    for border in (0.0, OVERLAP_BORDER, 0.75):
        got = {(r.a, r.b, round(r.diff, 9)) for r in overlap.overlap_pairs(keyed, border).collect()}
        want = set()
        for a in sets:
            for b in sets:
                n = min(len(sets[a]), len(sets[b]))
                d = 1.0 - len({*sets[a]} & {*sets[b]}) / n
                if a < b and n >= 5 and d <= border:
                    want.add((a, b, round(d, 9)))
        assert got == want


def test_dictionary_hits(spark):
    entries = ["verlag", "verlag en", "verlag en nord", "en", "nord ost", "a b " * 250 + "c", "überall"]
    texts = {1: "der verlag en nord ost überall", 2: "verlagen verlag", 3: "", 4: None, 5: "x " + "a b " * 250 + "c", 6: "en en verlag en", 7: "nordost"}
    want = set()
    for k, t in texts.items():
        w = (t or "").split()
        want |= {(k, i, len(w) - i - len(e.split()), e) for e in entries for i in range(len(w)) if w[i : i + len(e.split())] == e.split()}
    rows = spark.createDataFrame(list(texts.items()), "id long, words string")
    known = spark.createDataFrame([(e,) for e in entries], "entry string")
    for part in (4_000_000, 20):
        assert {tuple(r) for r in dictionary_hits(rows, known, part).collect()} == want
    assert dictionary_hits(rows, known.limit(0)).count() == 0


def test_descendants(spark):
    pages = {1: "<ul><li>a<ul><li><a>x</a></li></ul></li></ul><a>y</a>", 2: "", 3: None, 4: "<ul>" + "<li><a>k</a></li>" * 10_000 + "</ul>", 5: "<li><ul></ul></li>"}
    rows = spark.createDataFrame(list(pages.items()), "id long, html string").select("id", H.elements("html").alias("dom"))
    found = structure.descendants(structure.intervals(rows, "id", F.col("dom")), F.col("tag") == "ul", F.col("tag").isin("li", "a")).collect()
    assert sorted((r.ancestor, r.start, r.tag, r.depth) for r in found if r.page == 1) == [(0, 1, "li", 1), (0, 3, "li", 3), (0, 4, "a", 4), (2, 3, "li", 1), (2, 4, "a", 2)]
    assert Counter((r.page, r.tag, r.depth) for r in found if r.page != 1) == {(4, "li", 1): 10_000, (4, "a", 2): 10_000}


def test_inside_is_a_slice(spark):
    page = "<div><p>1</p><table><tr><td> A </td><td title=t>1</td></tr><tr><td>x</td></tr></table></div><p>2</p>"
    dom = spark.createDataFrame([(page,), (None,)], "html string").select(H.elements("html").alias("dom"))
    of = lambda e: F.transform(e, lambda x: x["tag"])
    got = dom.select(of(H.inside(F.col("dom"), H.first(H.by_tag(F.col("dom"), "div")))).alias("a"), of(H.children(F.col("dom"), H.first(H.by_tag(F.col("dom"), "div")))).alias("b"), H.row_pairs(F.col("dom"), H.first(H.by_tag(F.col("dom"), "table"))).alias("c")).collect()
    assert got[0].a == ["p", "table", "tr", "td", "td", "tr", "td"] and got[0].b == ["p", "table"] and [tuple(x) for x in got[0].c] == [("A", "1", "t")]
    assert not got[1].a and not got[1].b and not got[1].c


def stream(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(path))


def test_count_windows_over_restarts(spark, tmp_path):
    rng = random.Random(1)
    schema = "key string, seq long, item string, done boolean"
    sent, flushed = defaultdict(list), set()
    for turn in range(4):
        rows = []
        for seq in range(turn * 100, turn * 100 + rng.randint(5, 30)):
            key = rng.choice("abc")
            rows.append((key, seq, f"i{seq}", False))
            sent[key].append(f"i{seq}")
        if turn == 3:
            rows += [(k, None, None, True) for k in "ab"]
            flushed = {"a", "b"}
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        writer = state.count_windows(stream(spark, tmp_path / "in", schema), 4).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
        state.run_all(writer, spark)
    got = defaultdict(dict)
    for r in spark.read.parquet(str(tmp_path / "out")).orderBy("seq").collect():
        got[r.key].setdefault(r.batch, []).append(r.item)
    for key, items in sent.items():
        whole = len(items) if key in flushed else len(items) - len(items) % 4
        assert [got[key][b] for b in sorted(got[key])] == [items[i : min(i + 4, whole)] for i in range(0, whole, 4)]
        assert sorted(got[key]) == list(range(len(got[key])))


def test_seen_once_and_messages(spark, tmp_path):
    schema = "ElsName string, ExternalId string"
    told = Progress()
    spark.streams.addListener(told)
    try:
        for ids in ((1, 2, 2, None), (2, 3), (1, 4)):
            spark.createDataFrame([("E", None if i is None else str(i)) for i in ids], schema).write.mode("append").parquet(str(tmp_path / "in"))
            writer = state.seen_once(stream(spark, tmp_path / "in", schema, 100), ["ElsName", "ExternalId"]).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp"))
            state.run_all(writer, spark)
        deadline = time.time() + 20
        while len(told.ended) < 3 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(told)
    assert sorted(r.ExternalId for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3", "4"]
    assert len(told.ended) == 3 and sum(n for _, _, n in told.batches) == 8


def test_figures_cost_no_job(spark):
    def jobs(name, run):
        spark.sparkContext.setJobGroup(name, name)
        run()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    seen = Metrics()
    df = spark.range(1000).repartition(3)
    plain = jobs("plain", lambda: stash(df, "a"))
    observed = jobs("observed", lambda: stash(seen.of(df, "ids", least=F.min("id"), greatest=F.max("id")), "b"))
    assert plain == observed > 0
    assert sorted(seen.rows()) == [("ids", "greatest", 999), ("ids", "least", 0), ("ids", "rows", 1000)]
    assert seen.table(spark).count() == 3
    seen.report()
