"""Ranked lexical search by thresholds: TPUT over postings that are partitioned by term.

The index is a bucketed table of postings (term, document, impact), a frequent term's list parted into segments
by document, so no task holds a whole list.  Items are asked in blocks of bounded size, each in three phases:

1. The head of every list is fetched; the sums of what heads say are lower bounds of scores, and the k-th best of an
   item is a bound for its whole ranking.
2. A part of that bound over the item's number of lists is a threshold for all its lists alike: a document that
   is below it in every list can't reach the bound.  Entries at or above the least threshold of any item are
   sent once, to their range of documents, where each item takes its own.  Partial sums give a better bound; a document whose
   partial sum and what lists may still hold below their thresholds come to less is out.  The lower the threshold, the
   more entries are sent and the fewer documents are left.
3. The exact scores of the documents left are looked up in the lists.

Ties with a bound are never cut, so results are those of scoring every document.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import ALNUM, byte_tokens, partitions, scratch_dir, stash, trim

#: Documents of a ranking; postings of a segment of a list; terms of the items of a block, about; bits that number the documents of a range.
TOP, SEGMENT, BLOCK_TERMS, RANGE_BITS = 10, 50_000, 200_000, 12
#: Bytes of the items' terms that are sent along to keep other terms out of the index; with more, it has all terms.
WANTED_BYTES = 32 << 20
#: The threshold's divisor, besides the number of lists.
PART = 4


@dataclass(frozen=True)
class Index:
    """postings (tid, salt, doc, impact) bucketed by tid and salt, lists (tid, term, weight, best, salts) and documents (doc, doc_id, n)."""

    name: str
    postings: DataFrame
    lists: DataFrame
    documents: DataFrame

    def drop(self) -> None:
        """Takes the table of postings out of the session's catalog."""
        self.postings.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def term_uses(rows: DataFrame, wanted: frozenset[bytes] | None = None) -> DataFrame:
    """key, id, n (terms with repeats), terms (bytes), uses of every text of rows (key, id, text), of the wanted terms alone."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, terms, uses, ends = [], [], [], [0]
            for text in b.column(2):
                held: Counter = Counter()
                size = 0
                for piece in byte_tokens(text.as_buffer(), ALNUM) if text.is_valid else ():
                    size += len(piece)
                    held.update(piece if wanted is None else filter(wanted.__contains__, piece))
                n.append(size)
                terms += held.keys()
                uses += held.values()
                ends.append(len(terms))
            at = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(at, pa.array(terms, pa.binary())), pa.ListArray.from_arrays(at, pa.array(uses, pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), *lists], ["key", "id", "n", "terms", "uses"])
        trim()

    return rows.select("key", "id", F.col("text").cast("binary").alias("text")).mapInArrow(run, f"key long, id {kind}, n long, terms array<binary>, uses array<long>")


def _each(used: DataFrame) -> DataFrame:
    """A row (term, uses) for each term."""
    return used.select(*[c for c in used.columns if c not in ("terms", "uses")], F.explode(F.arrays_zip("terms", "uses")).alias("t")).select("*", F.col("t.terms").alias("term"), F.col("t.uses").alias("uses")).drop("t")


def build_index(docs: DataFrame, wanted: frozenset[bytes] | None = None, id_col: str = "doc_id", text_col: str = "text", segment: int = SEGMENT) -> Index:
    """Index of all documents, of the wanted terms or of all.  A posting's impact is all of its score but the term's weight, so it holds for any item."""
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    used = stash(term_uses(rows, wanted), "terms")
    n_docs, n_terms = used.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    share = F.expr(f"bigint(cast(n as decimal(24,0)) * {75 * n_docs} div {max(n_terms, 1)})")  # the product may not fit into 64 bits
    held = _each(used.where("n > 0").withColumn("m", F.lit(100 - 75) + share).select(F.col("key").alias("doc"), "m", "terms", "uses"))
    postings = held.select("term", "doc", F.expr("(1000000000 * uses) div (1000 * uses + 8 * m)").alias("impact"))
    weight = F.floor(F.lit(1000) * F.log((F.lit(2 * n_docs + 2).cast("double")) / (2 * F.col("df") + 1).cast("double")))
    sizes = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("impact").alias("best"))
    lists = stash(sizes.select(F.monotonically_increasing_id().alias("tid"), "term", weight.alias("weight"), "best", F.ceil(F.col("df") / segment).alias("salts")), "lists")
    dealt = postings.join(lists.select("term", "tid", "salts"), "term").select("tid", _salt().alias("salt"), "doc", "impact")
    name, parts = f"shelfmark_{uuid.uuid4().hex}", partitions(spark)
    writer = dealt.repartition(parts, "tid", "salt").write.bucketBy(parts, "tid", "salt").sortBy("tid", "salt")
    writer.option("path", f"{scratch_dir(spark).rstrip('/')}/shelfmark/{name}").saveAsTable(name)
    return Index(name, spark.table(name), lists, used.select(F.col("key").alias("doc"), F.col("id").alias("doc_id"), "n"))


def _salt() -> Column:
    return F.pmod(F.xxhash64("doc"), "salts")


def _kth(scored: DataFrame, score: str, top: int) -> dict[int, int]:
    """The k-th best score of every item of a block that has so many."""
    order = Window.partitionBy("item").orderBy(F.desc(score))
    return {r.item: r[1] for r in scored.select("item", score, F.row_number().over(order).alias("r")).where(F.col("r") <= top).where(F.col("r") == top).select("item", score).collect()}


def _fetch(postings: DataFrame, items: dict[int, list[tuple[int, int, int, int]]], bounds: dict[int, int], top: int) -> DataFrame:
    """item, doc, partial, upper of the documents of every range that may be among the best there.

    items: (tid, gain, least impact, most that an entry below it adds) of each list of an item; bounds: of its ranking, from the heads.
    """
    size = 1 << RANGE_BITS

    def run(table: pa.Table) -> pa.Table:
        tid, doc, impact = (table.column(c).to_numpy() for c in ("tid", "doc", "impact"))
        order = np.lexsort((-impact, tid))
        tid, impact = tid[order], impact[order]
        first, place = int(doc[0]) & ~(size - 1), doc[order] & (size - 1)
        here, begins = np.unique(tid, return_index=True)
        spans = {int(t): (a, b) for t, a, b in zip(here, begins, np.append(begins[1:], len(tid)), strict=True)}
        found: list[tuple[np.ndarray, ...]] = []
        for item, lists in items.items():
            partial, missed = np.zeros(size, np.int64), np.full(size, sum(m for *_, m in lists), np.int64)
            for t, gain, least, most in lists:
                a, b = spans.get(t, (0, 0))
                if a == b or impact[a] < least:
                    continue
                b = a + int(np.searchsorted(-impact[a:b], -least, side="right"))
                partial[place[a:b]] += gain * impact[a:b]
                missed[place[a:b]] -= most
            seen = np.flatnonzero(partial)
            bound = bounds.get(item, 0)
            if len(seen) > top:
                bound = max(bound, np.partition(partial[seen], len(seen) - top)[len(seen) - top])
            seen = seen[partial[seen] + missed[seen] >= bound]
            if len(seen):
                found.append((np.full(len(seen), item), first + seen, partial[seen], partial[seen] + missed[seen]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["item", "doc", "partial", "upper"])

    least: dict[int, int] = {}
    for lists in items.values():
        for t, _, x, _ in lists:
            least[t] = min(x, least.get(t, x))
    spark = postings.sparkSession
    asked = F.broadcast(spark.createDataFrame([(t, x) for t, x in least.items()], "tid long, least long"))  # at most the terms of a block
    sent = postings.join(asked, "tid").where("impact >= least").select("tid", "doc", "impact")
    return sent.groupBy(F.shiftright("doc", RANGE_BITS).alias("range")).applyInArrow(run, "item long, doc long, partial long, upper long")


def _ask(index: Index, asked: DataFrame, top: int) -> DataFrame:
    """item, doc, score: the best documents of a block of items (item, tid, gain, best, salts), ties with the last included."""
    spark = asked.sparkSession
    rows = asked.collect()  # BLOCK_TERMS, about
    if not rows:
        return spark.createDataFrame([], "item long, doc long, score long")
    asked = spark.createDataFrame([tuple(r) for r in rows], asked.schema)
    heads = index.postings.select("tid", "salt", "doc", "impact", F.row_number().over(Window.partitionBy("tid", "salt").orderBy(F.desc("impact"), "doc")).alias("r")).where(F.col("r") <= top)
    said = heads.join(F.broadcast(asked), "tid").groupBy("item", "doc").agg(F.sum(F.col("gain") * F.col("impact")).alias("partial"))
    bound = _kth(said, "partial", top)

    lists: dict[int, list[tuple[int, int, int, int]]] = {}
    for r in rows:
        lists.setdefault(r.item, []).append(r)
    items = {}
    for item, held in lists.items():
        b, m = bound.get(item, 0), PART * len(held)
        least = lambda r, b=b, m=m: -(-b // (m * r.gain))  # noqa: E731  gain * impact >= b / m in whole numbers
        most = lambda r, b=b, m=m: min(r.gain * r.best, (b - 1) // m) if b else 0
        items[item] = [(r.tid, r.gain, least(r), most(r)) for r in held]
    maybe = stash(_fetch(index.postings, items, bound, top), "candidates")
    second = spark.createDataFrame(list(_kth(maybe, "partial", top).items()), "item long, bound long")
    left = maybe.join(F.broadcast(second), "item", "left").where("bound is null or upper >= bound").select("item", "doc")
    looked = left.join(F.broadcast(asked), "item").select("item", "doc", "tid", _salt().alias("salt"), "gain")
    return looked.join(index.postings, ["tid", "salt", "doc"]).groupBy("item", "doc").agg(F.sum(F.col("gain") * F.col("impact")).alias("score"))


def search(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", top: int = TOP, block_terms: int = BLOCK_TERMS, wanted_bytes: int = WANTED_BYTES
) -> DataFrame:
    """item_id, rank, doc_id, score: the best documents of every item, equal scores by ascending id.

    docs and items: any tables with an id and a text; other columns are not read.  A null or empty text has no terms: such a
    document is in no ranking and no count, such an item has none.  Rows are documents and items of their own even if
    ids repeat or are null; a null id comes last among equal scores.  Very long texts are counted in pieces.  A
    document with a score of 0 is not listed, so an item may have fewer rows, or none.  Empty tables give an empty one.
    """
    asked = items.select(F.monotonically_increasing_id().alias("key"), F.col(item_id_col).alias("id"), F.col(item_text_col).alias("text"))
    uses = stash(_each(term_uses(asked)).select(F.col("key").alias("item"), F.col("id").alias("item_id"), "term", "uses"), "items")
    terms = uses.select("term").distinct()
    n, size = terms.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term") + 100), F.lit(0))).first()
    wanted = frozenset(bytes(r.term) for r in terms.collect()) if size <= wanted_bytes else None
    index = build_index(docs, wanted, id_col, text_col)
    try:
        every = uses.join(index.lists, "term").where("weight > 0").select("item", "tid", (F.col("uses") * F.col("weight")).alias("gain"), "best", "salts")
        every = stash(every, "asked")
        parts = max(1, -(-every.count() // block_terms))
        block = F.pmod(F.xxhash64("item"), F.lit(parts))
        best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "doc")
        found = []
        for b in range(parts):
            scored = _ask(index, every.where(block == b), top).join(index.documents.select("doc", "doc_id"), "doc")
            found.append(stash(scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select("item", "rank", "doc_id", "score"), "found"))
    finally:
        index.drop()
    names = uses.select("item", "item_id").distinct()
    return reduce(DataFrame.unionByName, found).join(names, "item").select("item_id", "rank", "doc_id", "score")
