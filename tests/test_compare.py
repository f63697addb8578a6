"""The linking of a small catalogue against a plain model with nested loops."""

import random

from pyspark.sql import functions as F

from shelfmark.operators.similar import near_keys, similar_edges, similar_maps, with_keys
from shelfmark.plans.compare import compare
from shelfmark.schema import as_books


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def near(a, b):
    n = max(len(a), len(b))
    return lev(a, b) / n if n and lev(a, b) / n <= 0.3 else None


def model(books):
    links = set()
    for x in books:
        for y in books:
            if x.Id == y.Id or x.Compared or not set(x.name_tokens) & set(y.name_tokens):
                continue
            author = next((d for p in x.author_keys for q in y.author_keys if (d := near(p, q)) is not None), None)
            name = near(x.name_key, y.name_key)
            small = min(len(x.name_tokens), len(y.name_tokens))
            if name is None and small >= 5:
                d = 1 - len(set(x.name_tokens) & set(y.name_tokens)) / small
                name = d if d <= 0.4 else None
            if author is not None and name is not None:
                links |= {(x.Id, y.Id, round((author + name) / 2, 9)), (y.Id, x.Id, round((author + name) / 2, 9))}
    return links


def catalogue(spark):
    rng = random.Random(3)
    people = ["Иван Петров", "Иван Петрв", "Smith J.", "Smit J.", "И. И. Ильин", "Jones K.", ""]
    words = "базы данных методы алгебры графов большие системы анализ теория курс введение".split()
    rows = []
    for i in range(60):
        authors = ", ".join(rng.sample(people, rng.choice([1, 1, 2])))
        name = " ".join(rng.sample(words, rng.choice([2, 4, 6])))
        rows.append((f"b{i:02d}", rng.choice(["A", "B"]), f"{i}", authors, name, i % 4 == 0))
    return as_books(spark.createDataFrame(rows, "Id string, ElsName string, ExternalId string, Authors string, Name string, Compared boolean"))


def test_edges_match_the_model(spark):
    keyed = with_keys(catalogue(spark))
    got = {(r.from_id, r.to_id, round(r.coeff, 9)) for r in similar_edges(keyed).collect()}
    want = model(keyed.collect())
    assert got == want and len(want) > 20
    again = {(r.from_id, r.to_id, round(r.coeff, 9)) for r in similar_edges(keyed.repartition(7, F.rand(1))).collect()}
    assert again == want
    assert {(a, b) for a, b, _ in got} == {(b, a) for a, b, _ in got}


def test_near_keys_lose_nothing(spark):
    rng = random.Random(5)
    keys = {"".join(rng.choice("abcx") for _ in range(rng.randint(0, 11))) for _ in range(250)} | {"петров", "петрв", "п"}
    table = spark.createDataFrame([(k,) for k in keys], "key string")
    for border in (0.0, 0.3, 0.6):
        got = {(r.x, r.y) for r in near_keys(table, border).collect()}
        assert got == {(a, b) for a in keys for b in keys if a and b and lev(a, b) / max(len(a), len(b)) <= border}


def test_maps_keep_stored_links(spark):
    link = [("z", "9", 0.5)]
    rows = [("a", "A", "1", "X Y", "n m", True, {"B": link}), ("b", "B", "2", "X Y", "n m", False, None)]
    schema = "Id string, ElsName string, ExternalId string, Authors string, Name string, Compared boolean, SimilarBooks map<string,array<struct<BookId:string,ExternalId:string,Coeff:double>>>"
    books = as_books(spark.createDataFrame(rows, schema))
    edges = spark.createDataFrame([("a", "b", 0.1), ("b", "a", 0.1)], "from_id string, to_id string, coeff double")
    got = {r.Id: (r.SimilarCount, {k: [tuple(x) for x in v] for k, v in r.SimilarBooks.items()}) for r in similar_maps(books, edges).collect()}
    assert got == {"a": (2, {"B": [("b", "2", 0.1), ("z", "9", 0.5)]}), "b": (1, {"A": [("a", "1", 0.1)]})}


def test_compare_marks_all(spark):
    done = compare(catalogue(spark)).collect()
    assert len(done) == 60 and all(r.Compared for r in done)
    assert all(r.SimilarCount == sum(map(len, r.SimilarBooks.values())) for r in done)
    assert compare(catalogue(spark).limit(0)).count() == 0
