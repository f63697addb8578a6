"""Stupid-backoff scores, computed relationally.

The corpus is cut into blocks of documents.  Each block sends the distinct n-grams it holds, with
how often, to the hash partition they belong to: exploded n-grams, packed by (block, partition).  A
partition sums its count table and joins it back to the n-grams of every block; what a block gets
back is the count of each of its n-grams, and it sums the scores of its documents.

An n-gram is sent once for each block, however often it occurs there, so a frequent one meets in
one partition as many times as there are blocks and not as there are occurrences.  The tables hold
every n-gram of the corpus, those seen once as well.  A document is no evidence for itself: its own
occurrences are taken off the counts when it is scored.

The blocks are a bucketed table, so that only n-grams and counts are shuffled and never words.
Blocks and partitions grow with the root of the corpus, which bounds the number of pairs of them.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import partitions, scratch_dir, trim
from shelfmark.llm.hashing import mix, ngrams, word_hashes

#: Longest n-gram and the weight of a shorter one.
ORDER, ALPHA = 3, 0.4
#: Words of a block and of a hash partition, about, at least; n-grams that a pair of them shares, about, in a large corpus.
BLOCK_WORDS, SHARED = 1_200_000, 25
#: Bits of a hash beyond those that number the words: two n-grams are one by chance once in 2**SPARE.
SPARE = 26


def blocks(docs: DataFrame, id_col: str, text_col: str, block_words: int = BLOCK_WORDS) -> DataFrame:
    """block, doc_ids, ends (words of the documents up to each), vocabulary (hashes, frequent ones first), words (places in it)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def row(ids: list[pa.Array], held: list[np.ndarray]) -> pa.RecordBatch:
        vocabulary, place, uses = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
        by_use = np.argsort(-uses, kind="stable")  # frequent words get small numbers
        vocabulary, place = vocabulary[by_use], np.argsort(by_use)[place]
        ends = np.cumsum([len(w) for w in held]).astype(np.int64)
        flat = pa.concat_arrays(ids)
        values = [
            pa.array([uuid.uuid4().hex]),
            pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat),
            pa.array([ends.tobytes()], pa.binary()),
            pa.array([vocabulary.tobytes()], pa.binary()),
            pa.array([_squeeze(place)], pa.binary()),
            pa.array([int(ends[-1])], pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(values, ["block", "doc_ids", "ends", "vocabulary", "words", "n_words"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[pa.Array] = []
        held: list[np.ndarray] = []
        size = 0
        for b in batches:
            start = 0
            for k, w in enumerate(word_hashes(b.column(1).to_pylist())):
                held.append(w)
                size += len(w)
                if size >= block_words:
                    yield row([*ids, b.column(0).slice(start, k + 1 - start)], held)
                    ids, held, size, start = [], [], 0, k + 1
                    trim()
            ids.append(b.column(0).slice(start))
        if held:
            yield row(ids, held)
        ids, held = [], []
        trim()

    schema = f"block string, doc_ids array<{kind}>, ends binary, vocabulary binary, words binary, n_words long"
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


class Block:
    """A block's words and the hashes of its n-grams; those that would cross documents are left out."""

    def __init__(self, ends: bytes, vocabulary: bytes, words: bytes):
        self.ends = np.frombuffer(ends, np.int64)
        self.words = np.frombuffer(vocabulary, np.uint64)[_loose(words, int(self.ends[-1]) if len(self.ends) else 0)]
        sizes = np.diff(self.ends, prepend=0)
        self.document = np.repeat(np.arange(len(sizes)), sizes)
        self.position = np.arange(len(self.words)) - np.repeat(self.ends - sizes, sizes)
        self.others = len(self.words) - sizes

    def grams(self, n: int, bits: int) -> np.ndarray:
        """The hash, of so many bits, of the n-gram that ends at each word with n - 1 words before it in its document, in order."""
        g = mix(self.words) if n == 1 else (ngrams(self.words, n) + np.uint64(n))[self.position[n - 1 :] >= n - 1]
        return g >> np.uint64(64 - bits)


def _bounds(parts: int, bits: int) -> np.ndarray:
    """Where each partition of the hashes begins: partitions are ranges, so sorted hashes are sorted by partition."""
    return (np.arange(parts) * (2.0**bits / parts)).astype(np.uint64)


def _planes(values: np.ndarray, width: int) -> bytes:
    """Numbers as planes of bytes, compressed where there are some: higher planes hold small numbers and cost little."""
    import zstandard

    raw = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()
    return raw if len(values) < 64 else zstandard.ZstdCompressor(level=1).compress(raw)


def _numbers(raw: bytes, n: int) -> np.ndarray:
    """The n numbers of _planes()."""
    import zstandard

    planes = np.frombuffer(raw if n < 64 else zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, : len(planes) // n] = planes.reshape(-1, n).T
    return out.view("<u8").reshape(-1)


def _width(values: np.ndarray) -> int:
    return max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1


def _squeeze(values: np.ndarray) -> bytes:
    return _planes(values, _width(values))


def _loose(raw: bytes, n: int) -> np.ndarray:
    return _numbers(raw, n).astype(np.int64)


def counts(of: DataFrame, order: int, parts: int, bits: int) -> DataFrame:
    """block, n, part, counts: for the block's n-grams of a partition, in the order of their hashes, how often the corpus has each."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bounds = _bounds(parts, bits)
        for pdf in batches:
            for block, ends, vocabulary, words in zip(pdf["block"], pdf["ends"], pdf["vocabulary"], pdf["words"], strict=True):
                held = Block(ends, vocabulary, words)
                for n in range(1, order + 1):
                    g, c = np.unique(held.grams(n, bits), return_counts=True)
                    at = np.append(np.searchsorted(g, bounds), len(g))
                    some = np.flatnonzero(np.diff(at))
                    spans = [(at[p], at[p + 1]) for p in some]
                    gaps = [_squeeze(np.diff(g[i:j], prepend=bounds[p])) for p, (i, j) in zip(some, spans, strict=True)]
                    own = [b"" if (c[i:j] == 1).all() else _squeeze(c[i:j]) for i, j in spans]
                    yield pd.DataFrame({"block": block, "n": n, "part": some, "size": [j - i for i, j in spans], "grams": gaps, "own": own})
                del held, g, c, gaps, own
                trim()

    def join(pdf: pd.DataFrame) -> pd.DataFrame:
        each = [np.cumsum(_numbers(x, k)) for x, k in zip(pdf["grams"], pdf["size"], strict=True)]
        own = [_loose(x, k) if x else np.ones(k, np.int64) for x, k in zip(pdf["own"], pdf["size"], strict=True)]
        _, place = np.unique(np.concatenate(each), return_inverse=True)
        total = np.bincount(place, np.concatenate(own)).astype(np.int64)
        cut = np.cumsum([len(e) for e in each])[:-1]
        out = pdf[["block", "n", "part", "size"]].assign(counts=[_squeeze(x) for x in np.split(total[place], cut)])
        del each, own, total, place
        trim()
        return out

    sent = of.select("block", "ends", "vocabulary", "words").mapInPandas(send, "block string, n int, part long, size long, grams binary, own binary")
    # As many tasks as the corpus asks for, whatever the session's number; each holds a few (n, part).
    dealt = sent.repartition(max(partitions(of.sparkSession), order * parts), "n", "part")
    return dealt.groupBy("n", "part").applyInPandas(join, "block string, n int, part long, size long, counts binary")


def counted(held: Block, n: int, bits: int, received: np.ndarray, exclude_own: bool) -> np.ndarray:
    """How often the corpus, without the word's document if asked, has the n-gram that ends at each word; 0 where there is none."""
    reach = held.position >= n - 1
    g, document = held.grams(n, bits), held.document[reach]
    order = np.argsort(g, kind="stable")  # documents ascend within an n-gram
    g, document = g[order], document[order]
    fresh = np.append(True, g[1:] != g[:-1])[: len(g)]
    found = received[np.cumsum(fresh) - 1]
    if exclude_own and len(g):
        run = np.cumsum(fresh | np.append(True, document[1:] != document[:-1])) - 1
        found = found - np.bincount(run)[run]
    out = np.zeros(len(held.words), np.int64)
    out[np.flatnonzero(reach)[order]] = found
    return out


def backoff_scores(held: Block, full: dict[int, np.ndarray], total: int, alpha: float, exclude_own: bool) -> np.ndarray:
    """log S of each word; full[n]: the count of the n-gram that ends at each word.

    S(w | u) is the count of u w over that of u where the table has u w, else alpha times S of w after
    one word less of u; at last the word's share of the corpus, a word of no other document counting as one.
    """
    size = total - (len(held.words) - held.others)[held.document] if exclude_own else total
    score = np.log(np.maximum(1, full[1]) / np.maximum(1, size))
    for n in range(2, len(full) + 1):
        have = np.flatnonzero(full[n])  # a word at place p of its document has p words before it
        score[held.position >= n - 1] += np.log(alpha)
        before = full[n - 1][have - 1]
        score[have] = np.log(full[n][have] / np.maximum(before, full[n][have]))
    return score


def _bucketed(df: DataFrame, column: str, buckets: int) -> DataFrame:
    """Writes a table to the shared folder in buckets: a grouping by that column reads it without a shuffle.

    The catalog is only asked for the table once, so that it keeps no name of it: the files are the folder's, and stay.
    """
    spark = df.sparkSession
    name = f"shelfmark_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, column).option("path", f"{scratch_dir(spark).rstrip('/')}/shelfmark/{name}").saveAsTable(name)
    made = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return made


def _input_bytes(docs: DataFrame, text_col: str) -> int:
    """About how large a table is: by what its plan says of the files it reads, else by a sum of the texts' lengths."""
    said = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return said if said < 1 << 50 else docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0


def score_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    alpha: float = ALPHA,
    exclude_own: bool = True,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """doc_id, n_words, log_score (sum over the words), mean_log_score of every row of docs; the corpus is docs itself.

    Null and blank texts have no words, the sum 0 and a null mean.  Null ids and repeated rows are
    scored like others, and a row is evidence for its copies; other columns are not read.  Memory is
    bounded by a block and by a partition.
    """
    spark = docs.sparkSession
    words = _input_bytes(docs.select(id_col, text_col), text_col) // 3  # more than there are
    block_words = max(block_words, isqrt(SHARED * words))
    buckets = min(100_000, max(partitions(spark), 2 * words // block_words, 1))
    # Small partitions of the input are read together, so that blocks are full.
    tasks = max(4 * spark.sparkContext.defaultParallelism, words // block_words)
    of = _bucketed(blocks(docs.coalesce(tasks), id_col, text_col, block_words), "block", buckets)
    total = of.agg(F.sum("n_words")).first()[0] or 0
    parts = max(1, -(-total // block_words))
    bits = min(64, total.bit_length() + SPARE)
    back = counts(of, order, parts, bits)
    kind = docs.schema[id_col].dataType

    def score(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        ids = left.column("doc_ids").chunk(0).values
        row = left.drop_columns(["doc_ids"]).to_pylist()[0]
        held = Block(row["ends"], row["vocabulary"], row["words"])
        got = {n: {} for n in range(1, order + 1)}
        for n, part, size, raw in zip(*(right.column(c).to_pylist() for c in ("n", "part", "size", "counts")), strict=True):
            got[n][part] = _loose(raw, size)
        received = {n: np.concatenate([np.empty(0, np.int64), *(got[n][p] for p in sorted(got[n]))]) for n in got}
        full = {n: counted(held, n, bits, received[n], exclude_own) for n in received}
        s = np.append(0, np.cumsum(backoff_scores(held, full, total, alpha, exclude_own)))
        starts = np.append(0, held.ends[:-1])
        out = pa.table({"doc_id": ids, "n_words": held.ends - starts, "log_score": s[held.ends] - s[starts]})
        del held, got, received, full, s
        trim()
        return out

    schema = f"doc_id {kind.simpleString()}, n_words long, log_score double"
    scored = of.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(score, schema)
    mean = F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words"))
    return scored.select("doc_id", "n_words", F.round("log_score", 6).alias("log_score"), F.round(mean, 9).alias("mean_log_score"))
