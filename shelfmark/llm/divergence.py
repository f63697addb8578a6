"""Audit of how far the sources of a language diverge from one another and from the language.

A group is a language's source; its vector holds how often it uses each of the language's kept terms.  Vectors are
cut into shards by term and compressed, so a shard of one group is all that has to fit anywhere.  The groups of a
language meet in a round-robin tournament: a group stays resident in its partition, and in every round the vector of
its next opponent arrives there.  Each pair meets once, in the partition of one of the two, which evaluates both
directions; half of the meetings are at home.  Partitions keep one resident vector unpacked and read visitors
one after another, in the order of rounds; the shards' sums are added up by pair.

Terms of a group are ranked by local heaps of the shards and then among the heaps' best.

All numbers are 64-bit integers.  A sum over all terms is that of the terms that one of the two uses and, for the
rest, a product, so meetings cost what the two vectors hold and not what the language holds.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import LETTERS, byte_tokens, partitions, stash, trim

#: Documents of a language that hold a kept term, at least; ranks of terms that are told.
LEAST_DOCS, TOP_TERMS = 3, 200
#: Counts that a shard of a language holds, about; distinct terms that a task counts before it sends them on.
SHARD_ROWS, HELD_TERMS = 200_000, 300_000
#: A share is a number of billionths.
DIGITS, STEP = 3, 1000


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term (bytes), n (occurrences), df (documents), parts of sums; and a row without a term for every group that a task has met."""

    def rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> pa.RecordBatch:
        langs, sources, terms, n, df = [], [], [], [], []
        for (lang, source), (uses, docs_with) in held.items():
            langs += [lang] * (len(uses) + 1)
            sources += [source] * (len(uses) + 1)
            terms += [None, *uses]
            n += [0, *uses.values()]
            df += [0, *map(docs_with.__getitem__, uses)]
        arrays = [pa.array(langs, pa.string()), pa.array(sources, pa.string()), pa.array(terms, pa.binary()), pa.array(n, pa.int64()), pa.array(df, pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "df"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for b in batches:
            for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                uses, docs_with = held.setdefault((lang, source), (Counter(), Counter()))
                before, once = len(uses), set()
                for piece in byte_tokens(text.as_buffer(), LETTERS):
                    uses.update(piece)
                    once.update(piece)
                docs_with.update(once)
                size += len(uses) - before
                if size >= HELD_TERMS:
                    yield rows(held)
                    held, size = {}, 0
        if held:
            yield rows(held)
        held = {}
        trim()

    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return docs.select(blank("lang").alias("lang"), blank("source").alias("source"), blank("text").cast("binary").alias("text")).mapInArrow(count, "lang string, source string, term binary, n long, df long")


def share(count: np.ndarray, total: int) -> np.ndarray:
    """1 + count * 10**9 div total, three digits at a time: no product goes beyond 64 bits for totals below 9 * 10**15."""
    rest, out = np.asarray(count, np.int64), np.int64(0)
    for _ in range(DIGITS):
        whole, rest = np.divmod(rest * STEP, np.int64(total))
        out = out * STEP + whole
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """(p - q)**2 div q, by term."""
    d = p - q
    return d * d // q


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as the largest takes."""
    return values.astype(np.min_scalar_type(int(values.max()) if len(values) else 0))


def packed(places: np.ndarray, counts: np.ndarray) -> bytes:
    """A vector: ascending places and how often each is used."""
    a, b = _narrow(np.diff(places, prepend=0)), _narrow(counts)
    return bytes([a.itemsize, b.itemsize]) + zstandard.ZstdCompressor(level=3).compress(a.tobytes() + b.tobytes())


def unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    a, b = blob[0], blob[1]
    raw = zstandard.ZstdDecompressor().decompress(blob[2:]) if len(blob) > 2 else b""
    n = len(raw) // (a + b)
    places = np.frombuffer(raw, f"u{a}", n).astype(np.int64).cumsum()
    return places, np.frombuffer(raw, f"u{b}", n, a * n).astype(np.int64)


def _slices(counts: DataFrame, top: int) -> DataFrame:
    """Of every shard of a language: the vector of every group (no, blob, width), and the best of each group's terms (no, term, value)."""

    def build(table: pa.Table) -> pa.Table:
        lang, shard = table.column("lang")[0].as_py(), table.column("shard")[0].as_py()
        used = table.filter(table.column("term").is_valid())
        coded = used.column("term").combine_chunks().dictionary_encode()
        terms, code = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        of = lambda t, c: t.column(c).to_numpy().astype(np.int64)
        order = np.lexsort((code, of(used, "no")))
        code, no, n, everywhere = code[order], of(used, "no")[order], of(used, "n")[order], of(used, "everywhere")[order]
        facts = {}  # of each group: its words and the language's, kept terms of the language
        for k, words, all_words, kept in zip(*(table.column(c).to_pylist() for c in ("no", "words", "all_words", "kept")), strict=True):
            facts.setdefault(k, (words, all_words, kept))
        out: list[tuple] = []
        for k, (words, all_words, kept) in facts.items():
            a, b = np.searchsorted(no, [k, k + 1])
            out.append((lang, shard, k, packed(code[a:b], n[a:b]), len(terms), None, None))
            if a == b:
                continue
            p, q = share(n[a:b] + 1, words + kept), share(everywhere[a:b] + 1, all_words + kept)
            over = np.flatnonzero(p > q)
            value = divergence(p[over], q[over])
            if len(over) > top:
                least = np.partition(value, len(value) - top)[len(value) - top]
                over, value = over[value >= least], value[value >= least]
            best = heapq.nsmallest(top, zip((-value).tolist(), [terms[c] for c in code[a:b][over]], strict=True))
            out += [(lang, shard, k, None, None, term, -v) for v, term in best]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.int64()]
        names = ["lang", "shard", "no", "blob", "width", "term", "value"]
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return counts.groupBy("lang", "shard").applyInArrow(build, "lang string, shard long, no long, blob binary, width long, term binary, value long")


def schedule(no: Column, groups: Column) -> Column:
    """(round, host): the meetings that a group travels to, in a tournament of so many groups by the circle method.

    Of two groups the one with the smaller number is host if their sum is odd, else the other.  With an
    odd number of groups one has no opponent in each round.
    """
    seats = groups + groups % 2
    turn = seats - 1

    def meeting(r: Column) -> Column:
        across = F.pmod(r - no, turn)
        last = F.when(no == turn, F.pmod(r * (seats / 2).cast("long"), turn)).when(across == no, turn).otherwise(across)
        return F.struct(r.alias("round"), last.alias("host"))

    def travels(m: Column) -> Column:
        smaller = F.least(no, m["host"])
        at = F.when((no + m["host"]) % 2 == 1, smaller).otherwise(F.greatest(no, m["host"]))
        return (m["host"] < groups) & (at == m["host"]) & (m["host"] != no)

    return F.filter(F.transform(F.sequence(F.lit(0).cast("long"), turn - 1), meeting), travels)


def meetings(slices: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b, value: the divergence of group a from group b, in parts by shard."""
    told = slices.join(groups.select("lang", "no", "words", "kept", "groups"), ["lang", "no"])
    home = F.array(F.struct(F.lit(-1).cast("long").alias("round"), F.col("no").alias("host")))
    seated = told.select("lang", "shard", "no", "blob", "width", "words", "kept", F.explode(F.concat(home, schedule(F.col("no"), F.col("groups")))).alias("m"))
    keys = ["lang", "shard", "host"]
    dealt = seated.select("lang", "shard", F.col("m.host").alias("host"), F.col("m.round").alias("round"), "no", "blob", "width", "words", "kept").repartition(partitions(slices.sparkSession), *keys).sortWithinPartitions(*keys, "round")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = used = None
        none = total = width = 0
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                if r["round"] < 0:  # the resident
                    places, counts = unpacked(r["blob"])
                    total, width = r["words"] + r["kept"], r["width"]
                    none = int(share(np.array(1), total)) if total else 1
                    used = share(counts + 1, total) if total else counts
                    own = np.full(width, none, np.int64)
                    own[places] = used
                    continue
                other = r["words"] + r["kept"]
                there = back = 0
                if width:
                    places, counts = unpacked(r["blob"])
                    theirs, blank = share(counts + 1, other), share(np.array(1), other)
                    mine, rest = own[places], width - len(used)
                    there = int(divergence(used, blank).sum() + rest * divergence(np.int64(none), blank) + (divergence(mine, theirs) - divergence(mine, blank)).sum())
                    back = int(divergence(blank, used).sum() + rest * divergence(blank, np.int64(none)) + (divergence(theirs, mine) - divergence(blank, mine)).sum())
                out += [(r["lang"], r["host"], r["no"], there), (r["lang"], r["no"], r["host"], back)]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64()]
            columns = zip(*out, strict=True) if out else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], ["lang", "a", "b", "value"])
        trim()

    return dealt.mapInArrow(meet, "lang string, a long, b long, value long")


def audit_sources(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """lang, source, part, item, value, rank: for every group its distance to each other source of the language (part pair)
    and the terms that it uses more than the language does (part term).

    docs: any table with a text, a language and a source; other columns are not read.  A null text, language or
    source is empty.  A group without terms is one all the same, and so is that of an empty source.  Repeated rows count
    as often as they stand.  A very long text is counted in pieces.  Items of one value are ranked in the order of their
    bytes.  An empty table gives an empty table.  One vector of a shard and its visitors' one at a time are in memory.
    """
    named = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    counted = term_counts(named).groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    of_term = Window.partitionBy("lang", "term")
    known = counted.select("lang", "term", "source", "n", F.sum("df").over(of_term).alias("df"), F.sum("n").over(of_term).alias("everywhere"), (F.min("source").over(of_term) == F.col("source")).alias("first"))
    # Every term of a language once is marked; rows without a term stand for groups.
    kept = stash(known.where((F.col("df") >= least_docs) | F.col("term").isNull()).drop("df"), "terms")
    used = F.col("term").isNotNull()
    langs = kept.groupBy("lang").agg(F.sum("n").alias("all_words"), F.count_if(F.col("first") & used).alias("kept"), F.greatest(F.lit(1), F.ceil(F.count_if(used) / shard_rows)).alias("shards"))
    by_lang = Window.partitionBy("lang")
    numbered = kept.groupBy("lang", "source").agg(F.sum("n").alias("words")).withColumns({"no": (F.row_number().over(by_lang.orderBy("source")) - 1).cast("long"), "groups": F.count(F.lit(1)).over(by_lang)})
    groups = stash(numbered.join(langs, "lang"), "groups")

    facts = groups.select("lang", "source", "no", "words", "all_words", "kept", "shards")
    rows = kept.where(used).select("lang", "source", "term", "n", "everywhere").join(facts, ["lang", "source"]).withColumn("shard", F.pmod(F.xxhash64("term"), "shards"))
    blank = facts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard")).withColumns({"term": F.lit(None).cast("binary"), "n": F.lit(0).cast("long"), "everywhere": F.lit(0).cast("long")})
    columns = ["lang", "shard", "no", "term", "n", "everywhere", "words", "all_words", "kept"]
    cut = stash(_slices(rows.select(columns).unionByName(blank.select(columns)), top_terms), "slices")

    met = meetings(cut.where("blob is not null").select("lang", "shard", "no", "blob", "width"), groups).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    name = groups.select("lang", F.col("no").alias("b"), F.col("source").alias("item"))
    pairs = met.join(name, ["lang", "b"]).select("lang", F.col("a").alias("no"), F.lit("pair").alias("part"), "item", "value")
    terms = cut.where("term is not null").select("lang", "no", F.lit("term").alias("part"), F.col("term").cast("string").alias("item"), "value")
    best = Window.partitionBy("lang", "no").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(best)).unionByName(terms.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top_terms))
    return ranked.join(groups.select("lang", "no", "source"), ["lang", "no"]).select("lang", "source", "part", "item", "value", "rank")
