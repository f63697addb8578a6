"""Ranked search, mixing and divergence against brute force, on small tables with every awkward row."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import divergence, mixing, search
from shelfmark.llm.common import ALNUM, LETTERS, byte_tokens

WORDS = "the of and Sea Día ñu river x1 2024 stone a-b the the of Ünder straße moon".split()


def corpus(seed, n=60, columns="doc_id long, text string, lang string, source string"):
    """Documents with nulls, blanks, repeated rows, ties, a very long text; and columns that clash with the operators' own."""
    rng = random.Random(seed)
    text = lambda k: rng.choice([" ", "\n", "\t "]).join(rng.choice(WORDS) for _ in range(k))
    rows = [(i, text(rng.randrange(1, 40)), rng.choice(["en", "de", "en"]), f"s{rng.randrange(5)}") for i in range(n)]
    rows += [(n, None, "en", "s1"), (n + 1, "", "de", None), (n + 2, " \n", None, "s9"), (None, "the moon", "en", "s0"), (None, "the moon", "en", "s0"), rows[3], rows[3], (n + 3, text(3000), "en", "s0"), (n + 4, "\x00A\x7fb﻿c", "en", "\U0001f600"), (n + 5, "ab", "en", "￿")]
    return rows, columns


def table(spark, rows, columns, parts=3):
    out = spark.createDataFrame(rows, columns).repartition(parts)
    return out.selectExpr("*", *[f"'x' as {c}" for c in ("key", "id", "row", "no", "size", "n", "term", "shard", "block", "item", "tid", "_bucket", "at", "target")])


def test_byte_tokens_are_the_contracts_patterns():
    texts = ["Ab1-Ä9_ß\x00z", "", "   ", "\x7f\x80é", "ÀA" * 5 + " b" * 50]
    for t in texts:
        low = "".join(c.lower() if c.isascii() else c for c in t)
        for piece in (1 << 20, 3):
            for mask, pattern in ((ALNUM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), (LETTERS, r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")):
                got = [w.decode() for part in byte_tokens(t.encode(), mask, piece) for w in part]
                assert got == re.findall(pattern, low)


# --- Search ---------------------------------------------------------------------------------------


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_search(docs, items, top):
    held = [(r[0], Counter(terms(r[1]))) for r in docs]
    sizes = [sum(c.values()) for _, c in held]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        q = Counter(terms(text))
        scored = []
        for (doc, c), size in zip(held, sizes, strict=True):
            if not size:
                continue
            m = 25 + (75 * size * n) // total
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, k in q.items() if t in c)
            if s > 0:
                scored.append((-s, doc is None, doc, s))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k + 1, x[2], x[3]) for k, x in enumerate(scored[:top])]
    return out


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block_terms": 4}), (3, {"wanted_bytes": 0, "top": 3})])
def test_search(spark, monkeypatch, seed, options):
    rows, columns = corpus(seed)
    items = [(1, "the moon over the river"), (2, "stone 2024 unknownword"), (3, None), (None, "Día x1 sea"), (5, ""), (5, "nothing here"), (5, "and and and of"), (6, rows[7][1])]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(1))
    monkeypatch.setattr(search, "RANGE_BITS", 3)
    build = search.build_index
    monkeypatch.setattr(search, "build_index", lambda *a: build(*a, segment=3))
    got = [tuple(r) for r in search.search(table(spark, rows, columns), asked, **options).collect()]
    want = brute_search(rows, items, options.get("top", search.TOP))
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("shelfmark_")]


def test_search_of_empty_tables(spark):
    rows, columns = corpus(4)
    none = table(spark, [], columns)
    asked = spark.createDataFrame([(1, "the moon")], "item_id long, text string")
    assert search.search(none, asked).collect() == []
    assert search.search(table(spark, rows, columns), asked.limit(0)).collect() == []


# --- Mixing ---------------------------------------------------------------------------------------


def brute_targets(sizes):
    """Sharing and sharing again as the contract says it."""
    names = sorted([s for s in sizes if s is not None], key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: 1 + k % 3 for k, s in enumerate(names)}
    open_, left, out = set(names), float(sum(sizes.values())), {}
    while open_:
        all_weights = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / all_weights > 3 * sizes[s] + 1e-9]
        if not over:
            return out | {s: left * weight[s] / all_weights for s in open_}
        for s in over:
            out[s] = 3.0 * sizes[s]
            open_.remove(s)
        left = sum(sizes.values()) - sum(out.values())
    return out


@pytest.mark.parametrize("block,shard", [(7, 5), (512, 1024), (1, 50)])
def test_mixing(spark, monkeypatch, block, shard):
    monkeypatch.setattr(mixing, "CELL", 16)
    rows, columns = corpus(5)
    rows += [(900 + i, "tiny", None, f"t{i}") for i in range(9)]  # sources that stop at three times their size
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = brute_targets(sizes)
    docs = table(spark, rows, columns)
    taken, spans, sources = mixing.mix_sources(docs, block=block, shard=shard)
    got, spans, sources = taken.collect(), spans.collect(), {r.no: r for r in sources.collect()}
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted((repr(r[0]), size(r[1])) for r in rows)
    used = defaultdict(int)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        used[r.source] += r.taken
    assert all(abs(used[s] - want[s]) <= 0.5 for s in want)
    # Slots are filled without gaps, their number in each shard is fixed, and every pass takes each block once.
    filled = defaultdict(list)
    for s in spans:
        filled[s.shard, s.no, s.j].append((s.at, s.words, s.row, s.word))
    for parts in filled.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(q[1] for q in parts[:k]) for k in range(len(parts))]
    n_slots = Counter(k[0] for k in filled)
    assert sum(n_slots.values()) == sum(r.slots for r in sources.values())
    assert all(n == shard for k, n in n_slots.items() if k != max(n_slots))
    for no, r in sources.items():
        numbers = sorted(j for _, n, j in filled if n == no)
        assert numbers == list(range(r.slots))
        for first in range(0, r.slots - r.blocks + 1, max(r.blocks, 1)):
            one_pass = [p for (_, n, j), parts in filled.items() if n == no and first <= j < first + r.blocks for p in parts]
            words = [(p[2], w) for p in one_pass for w in range(p[3], p[3] + p[1])]
            if first + r.blocks < r.slots:  # the last slot may be cut
                assert len(words) == len(set(words)) == r.source_size
    # A rerun over other partitions gives the same.
    again = mixing.mix_sources(docs.repartition(7), block=block, shard=shard)[0].collect()
    key = lambda rs: sorted(repr((r.doc_id, r.source, r.size, r.taken)) for r in rs)
    assert key(again) == key(got)


def test_mixed_texts(spark):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(i % 11)), None, "ab"[i % 2]) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    _, spans, _ = mixing.mix_sources(docs, block=8, shard=4)
    got = {(r.shard, r.no, r.j): r.text.split() for r in mixing.mixed_texts(docs, spans).collect()}
    want = defaultdict(list)
    for s in sorted(spans.collect(), key=lambda s: s.at):
        want[s.shard, s.no, s.j] += rows[s.doc_id][1].split()[s.word : s.word + s.words]
    assert got == want


def test_draws_are_multinomial(spark):
    """Counts of draws by shard: each source's mean and variance are those of a multinomial, within four standard errors."""
    slots = [3000, 6000, 1000]
    sources = spark.createDataFrame(list(enumerate(slots)), "no long, slots long")
    counts = {(r.shard, r.no): r.n for r in mixing.draw_counts(sources, 50).collect()}
    shards = sum(slots) // 50
    for no, s in enumerate(slots):
        p = s / sum(slots)
        n = np.array([counts.get((k, no), 0) for k in range(shards)])
        assert abs(n.mean() - 50 * p) < 4 * math.sqrt(50 * p * (1 - p) / shards)
        assert 0.6 < n.var() / (50 * p * (1 - p)) < 1.5


def test_permutations(spark):
    for n in (1, 2, 3, 10, 97, 256):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("a"), mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(4)).alias("b"))
        a, b = zip(*df.collect(), strict=True)
        assert sorted(a) == sorted(b) == list(range(n))
        assert n < 10 or a != b


def test_running_and_intervals(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CELL", 4)
    rng = random.Random(6)
    rows = [(k % 3, k, rng.randrange(5)) for k in range(200)]
    got = mixing.running(spark.createDataFrame(rows, "g long, k long, v long"), ["g"], ["k"], "v", "before").collect()
    for g in range(3):
        of = sorted((r.before, r.before + r.v) for r in got if r.g == g)
        assert of[0][0] == 0 and all(a[1] == b[0] for a, b in zip(of, of[1:], strict=False))
    lengths = [5, 0, 1, 30, 2]
    intervals = spark.createDataFrame([(sum(lengths[:k]), n, k) for k, n in enumerate(lengths)], "start long, length long, who long")
    found = mixing.in_intervals(spark.range(sum(lengths)), "id", intervals, "start", "length").collect()
    assert {r.id: r.who for r in found} == {i: k for k, n in enumerate(lengths) for i in range(sum(lengths[:k]), sum(lengths[:k]) + n)}


def test_mixing_of_an_empty_table(spark):
    _, columns = corpus(5)
    for out in mixing.mix_sources(table(spark, [], columns)):
        assert out.collect() == []
    blank = mixing.mix_sources(table(spark, [(1, None, None, "a"), (2, "", None, None)], columns))[0].collect()
    assert sorted((r.doc_id, r.size, r.target, r.taken) for r in blank) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


# --- Divergence -----------------------------------------------------------------------------------


def brute_divergence(rows):
    held = [(r[2] or "", r[3] or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in r[1] or ""))) for r in rows]
    out = []
    for lang in {h[0] for h in held}:
        of = [h for h in held if h[0] == lang]
        df = Counter(t for h in of for t in set(h[2]))
        kept = {t for t in df if df[t] >= 3}
        count = defaultdict(Counter)
        for _, source, ts in of:
            count[source].update(t for t in ts if t in kept)
        whole = sum(count.values(), Counter())
        share = lambda c, t, v=len(kept): 1 + (10**9 * (c[t] + 1)) // (sum(c.values()) + v)
        f = lambda a, b: (a - b) * (a - b) // b
        for s, c in count.items():
            pairs = [(o, sum(f(share(c, t), share(d, t)) for t in kept)) for o, d in count.items() if o != s]
            terms_ = [(t, f(share(c, t), share(whole, t))) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, items in (("pair", pairs), ("term", terms_)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items) if part == "pair" or k < 200]
    return out


@pytest.mark.parametrize("seed,shard_rows", [(7, 4), (8, 1000)])
def test_divergence(spark, monkeypatch, seed, shard_rows):
    rows, columns = corpus(seed, 90)
    if seed == 7:
        monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    got = [tuple(r) for r in divergence.audit_sources(table(spark, rows, columns), shard_rows=shard_rows).collect()]
    assert sorted(got) == sorted(brute_divergence(rows))


def test_divergence_keeps_few_of_many_terms(spark):
    rows = [(i, " ".join(chr(97 + k // 26) + chr(97 + k % 26) for k in range(400)), "en", "ab"[i % 2]) for i in range(6)] + [(9, "aa " * 50, "en", "a")]
    got = [tuple(r) for r in divergence.audit_sources(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), shard_rows=50).collect()]
    assert sorted(got) == sorted(brute_divergence(rows))
    assert sum(r[1] == "b" and r[2] == "term" for r in got) == 200


def test_divergence_of_an_empty_table(spark):
    _, columns = corpus(7)
    assert divergence.audit_sources(table(spark, [], columns)).collect() == []


def test_every_pair_meets_once(spark):
    for g in range(1, 10):
        rows = spark.range(g).select("id", F.explode(divergence.schedule(F.col("id"), F.lit(g).cast("long"))).alias("m")).select("id", "m.round", "m.host").collect()
        assert sorted(tuple(sorted((r.id, r.host))) for r in rows) == [(a, b) for a in range(g) for b in range(a + 1, g)]
        for turn in {r["round"] for r in rows}:
            busy = [x for r in rows if r["round"] == turn for x in (r.id, r.host)]
            assert len(busy) == len(set(busy))


def test_shares_and_vectors():
    rng = np.random.default_rng(1)
    totals = [1, 7, 10**6, 8 * 10**15]
    for total in totals:
        counts = np.unique(rng.integers(0, total, 50, endpoint=True))
        assert divergence.share(counts, total).tolist() == [1 + 10**9 * int(c) // total for c in counts]
    for top in (0, 3, 300, 70_000):
        places = np.flatnonzero(rng.random(top) < 0.3)
        counts = rng.integers(1, 10 ** rng.integers(1, 12), len(places)) if len(places) else places
        a, b = divergence.unpacked(divergence.packed(places, counts))
        assert a.tolist() == places.tolist() and b.tolist() == list(counts)
