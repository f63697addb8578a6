"""Verdicts of the quality rules recomputed, recall of personal data, and the pipeline's stages on awkward rows."""

import math
import random
import re
import struct

import pytest
import xxhash

from shelfmark.llm import pii, quality_rules


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def one(word):
    return signed(xxhash.xxh64_intdigest(word.encode(), 42))


def two(a, b):
    return signed(xxhash.xxh64_intdigest(struct.pack("<q", b), xxhash.xxh64_intdigest(struct.pack("<q", a), 42)))


def grams(text):
    h = [one(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    return h, [*h, *(two(a, b) for a, b in zip(h, h[1:], strict=False))]


def test_log_ratios_and_verdicts(spark, sf_dir):
    """Every bucket, every document's mean and the threshold, from the rows themselves."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()] + [(None, "w " * 60), (-1, None), (-2, "")]
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    n, folds = quality_rules.BUCKETS, quality_rules.FOLDS
    raw, own = [0] * n, [[0] * n for _ in range(folds)]
    for d, t in docs:
        for g in grams(t)[1]:
            raw[g % n] += 1
            if d in good:
                own[one(t) % folds][g % n] += 1
    whole = [sum(x) for x in zip(*own, strict=True)]

    def table(target):
        a, b = sum(raw), sum(target)
        return [math.log((t / b + r / a / 10) / 1.1 / (r / a)) if r else 0.0 for r, t in zip(raw, target, strict=True)]

    def mean(text, weights):
        h, g = grams(text)
        return sum(weights[x % n] for x in g) / max(1, 2 * len(h) - 1)

    held = [table([w - x for w, x in zip(whole, o, strict=True)]) for o in own]
    scores = sorted(math.floor(mean(t, held[one(t) % folds]) * 10_000) for d, t in docs if d in good and len(grams(t)[0]) >= 50)
    threshold = min(quality_rules.THRESHOLD, scores[max(0, math.ceil(quality_rules.HELD_OUT_SHARE * len(scores)) - 1)] / 10_000)
    weights, got = table(whole), quality_rules.judge(spark.createDataFrame(docs, "doc_id long, text string"), quality_rules.trusted(labels)).collect()
    text_of = dict(docs)
    assert len(got) == len(docs)
    for r in got:
        want = mean(text_of[r.doc_id], weights)
        assert r.log_ratio == pytest.approx(want, abs=2e-9)
        assert r.kept == (not r.base_failed and want >= threshold) or abs(want - threshold) < 1e-8


def test_personal_data_is_found_whole(spark):
    """Recall on planted mentions of every kind; a part of each may not stay."""
    rng = random.Random(1)
    titles = ["Mr", "Mrs.", "Dr", "Prof.", "Herr", "Frau", "Señor", "Sra.", "Sr.", "Don", "Doña", "Madame", "Mme"]
    given = ["Anna", "Juan", "Carlos", "Marie", "Otto"]
    family = ["García", "Smithson", "de la Cruz", "von Bergen", "Núñez", "O'Neill"]
    texts, planted = {}, {}
    for k in range(300):
        names = [*rng.sample(given, rng.randint(0, 2)), rng.choice(family).split(" ")]
        words = [w for x in names for w in ([x] if isinstance(x, str) else x)]
        if words[0].islower():
            words = ["Rosa", *words]
        gap = rng.choice([" ", "  ", "\n", " "])
        title = rng.choice(titles) + gap if len(words) < 2 or rng.random() < 0.7 or words[0] not in (*given, "Rosa") else ""
        mail = f"{'x' * rng.choice([1, 9, 80])}.tail{k}@mail.example.com"
        text = f"was {title}{gap.join(words)}, said {mail} and {words[-1]} left."
        texts[k], planted[k] = text, words
    made = pii.replace_pii(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), b"key").collect()
    for r in made:
        kept = {w.lower() for w in re.findall(r"[\w'’-]+", r.text)}
        for w in planted[r.doc_id]:
            assert w in pii.PARTICLES or w.lower() not in kept, (texts[r.doc_id], r.text)
        assert f"tail{r.doc_id}" not in r.text and "xxxx" not in r.text and r.text.startswith("was ") and r.text.endswith(" left.")
        assert r.entities.count("name:") == 2
    assert len(made) == 300
    for clean in ("The house of May and Mark it was.", "Herr der Ringe", "a@b", "@", "Das Haus Otto"):
        assert pii.replaced(clean, b"key", {})[0] == clean
    assert pii.replaced("Frau Anna Schmidt Haus", b"key", {})[0].endswith(" Haus")


@pytest.fixture(scope="module")
def awkward(spark, sf_dir):
    """Documents with nulls in any column, empty, very long and repeated texts, and columns of the names that operators add."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id % 4 = 0")
    names = ["_h", "_lines", "n_words", "kept", "items", "entities", "n_entities", "contaminated", "text_hash", "component_id", "_rest", "done", "n", "piece"]
    first = docs.orderBy("doc_id").first()
    rows = [(None, None), (None, first.text), (-1, None), (-2, ""), (-3, " \n"), (-4, "long " + "alpha beta gamma delta " * 30_000), (first.doc_id, first.text), (-5, first.text)]
    more = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "cast(null as string) lang", "'s' source", "cast(null as long) n_chars")
    return docs.unionByName(more).selectExpr("*", *[f"concat('{n}', doc_id) as {n}" for n in names])


def test_stages_keep_the_users_columns(spark, sf_dir, awkward):
    import corpus_pipeline

    others = [c for c in awkward.columns if c != "text"]
    before = {repr(tuple(r[c] for c in others)) for r in awkward.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, awkward, sf_dir)
        rows = out.collect()
        assert out.columns == awkward.columns, name
        assert {repr(tuple(r[c] for c in others)) for r in rows} <= before, name
        ids = [r.doc_id for r in rows]
        if name == "quality":
            assert not {-1, -2, -3, -4} & {*ids}
        else:
            assert {-1, -2, -3, -4} <= {*ids} and None in ids, name
        if name == "near_duplicates":
            assert -5 not in ids or min(r.doc_id for r in awkward.where("doc_id is not null").collect()) == -5 or ids.count(-5) == 1
            assert all(ids.count(i) == 1 for i in ids if i is not None)
        if name == "personal_data":
            assert len(rows) == awkward.count()
            assert {r.text for r in rows if r.doc_id in (-1, -2)} == {None, ""}
    pieces = corpus_pipeline.STAGES[-1][1](spark, awkward, sf_dir)
    assert pieces.where("piece = 0").count() == awkward.count()


def test_stages_of_an_empty_table(spark, sf_dir, awkward):
    import corpus_pipeline

    docs = awkward.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_the_key_of_surrogates_stays(spark):
    from shelfmark.llm.queries import pii_key

    assert pii_key(spark) == pii_key(spark) and len(pii_key(spark)) == 64
    spark.conf.set("spark.shelfmark.pii.key", "given")
    try:
        assert pii_key(spark) == b"given"
    finally:
        spark.conf.unset("spark.shelfmark.pii.key")
