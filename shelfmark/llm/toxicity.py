"""Toxicity by compression distance: windows of text are compressed with a dictionary trained on toxic and one on ordinary text.

The ordinary dictionary is trained on windows of ordinary documents.  The toxic one is that dictionary
and, besides, passages of toxic documents: those under byte n-grams that far more toxic than ordinary documents have.
(Without that contrast both dictionaries fill with the same common syllables; see the README for figures.)
Every window of every text is compressed with both; one that comes out shorter with
the toxic dictionary by a calibrated number of bytes is a hit.  The share of hits among a document's windows
becomes a score by rates of toxic documents, made monotone.  The length of a window, the bytes of
a hit and the rates are calibrated on labelled documents that the dictionaries have not seen.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.classifier import isotonic
from shelfmark.llm.hashing import mix, ngrams, word_hashes

#: The sample of labelled documents: at most so many of each class, those whose id has the smallest hash, and of these as many as have so many characters together.
MAX_TRAIN, MAX_CHARS = 2000, 32_000_000
#: Of each FOLDS groups of documents one calibrates and the others train.
FOLDS = 4
#: Bytes of the ordinary dictionary, of the toxic passages, of the lead that both share at the end, of an n-gram.
ORDINARY, TOXIC, LEAD, GRAM = 8000, 3000, 32, 6
#: An n-gram counts as toxic if so many times likelier in toxic documents, and if this share of their groups, three at least, have it.
LIFT, SHARE = 20.0, 0.01
#: Words of a window and bytes of a hit that the calibration chooses from.
WINDOWS, LEAST = (4, 5), range(2, 9)


def normal(text: str | None) -> bytes:
    """Lower-case words between single spaces."""
    return b" " + b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split()) + b" "


def windows(text: bytes, words: int) -> Iterator[bytes]:
    """The windows of so many words that a normal text is made of, in a row."""
    each = text.split()
    return (b" " + b" ".join(each[i : i + words]) + b" " for i in range(0, len(each), words))


class Distance:
    """Bytes that the toxic dictionary saves on a window, in comparison with the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        import zstandard as z

        self.end = ordinary[-LEAD:][:16]  # the last bytes of a window are never searched
        options = dict(strategy=z.STRATEGY_LAZY2, min_match=4, window_log=14, hash_log=13, chain_log=13, search_log=5, target_length=16)
        parameters = z.ZstdCompressionParameters(write_checksum=0, write_content_size=0, write_dict_id=0, **options)

        def compress(content: bytes):
            held = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=parameters)
            return z.ZstdCompressor(dict_data=held, compression_params=parameters).compress

        self.toxic, self.ordinary = compress(ordinary[:-LEAD] + toxic + ordinary[-LEAD:]), compress(ordinary)

    def __call__(self, window: bytes) -> int:
        whole = window + self.end
        return len(self.ordinary(whole)) - len(self.toxic(whole))


@lru_cache(maxsize=2)
def _distance(toxic: bytes, ordinary: bytes) -> Distance:
    """The compressors of this Python worker, which outlive a task."""
    return Distance(toxic, ordinary)


class Model:
    """Two dictionaries, words of a window, bytes of a hit and the score by the share of hits: about 12 kB."""

    def __init__(self, toxic: bytes, ordinary: bytes, words: int, least: int, edges: np.ndarray, rates: np.ndarray):
        self.toxic, self.ordinary, self.words, self.least, self.edges, self.rates = toxic, ordinary, words, least, edges, rates

    def scorer(self):
        distance = _distance(self.toxic, self.ordinary)

        def score(text: str | None) -> float:
            n = hits = 0
            for w in windows(normal(text), self.words):
                n += 1
                hits += distance(w) >= self.least
            return float(self.rates[np.searchsorted(self.edges, hits / max(1, n), side="right") - 1])

        return score


def grams(text: bytes) -> np.ndarray:
    """Every run of GRAM bytes, as a number."""
    raw = np.frombuffer(text, np.uint8).astype(np.uint64)
    out = np.zeros(max(0, len(raw) - GRAM + 1), np.uint64)
    for k in range(GRAM if len(out) else 0):
        out |= raw[k : k + len(out)] << np.uint64(8 * k)
    return out


def _group(text: bytes) -> int:
    """One number for copies and near copies, mostly: the smallest hash of a run of four words."""
    (words,) = word_hashes([text.decode("utf-8", "surrogatepass")])
    runs = ngrams(words, min(4, len(words))) if len(words) else words
    return int(runs.min()) if len(runs) else 0


def _holders(texts: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct n-grams, how many groups have each, and the number of groups; texts: (text, group)."""
    by_group = defaultdict(list)
    for text, group in texts:
        by_group[group].append(np.unique(grams(text)))
    each = [np.unique(np.concatenate(held)) for held in by_group.values()]
    return *np.unique(np.concatenate(each), return_counts=True), len(each)


def toxic_passages(toxic: list[tuple[bytes, int]], ordinary: list[tuple[bytes, int]], size: int) -> bytes:
    """Words of toxic texts under toxic n-grams, those in the most texts last, up to a size."""
    found, n, n_toxic = _holders(toxic)
    others, m, n_ordinary = _holders(ordinary)
    at = np.minimum(np.searchsorted(others, found), len(others) - 1)
    lift = (n / n_toxic) / ((np.where(others[at] == found, m[at], 0) + 0.5) / n_ordinary)
    inner = np.zeros(len(found), bool)  # two words side by side are chance
    for k in range(1, GRAM - 1):
        inner |= (found >> np.uint64(8 * k)) & np.uint64(255) == np.uint64(0x20)
    good = found[(n >= max(3, SHARE * n_toxic)) & (lift >= LIFT) & ~inner]
    passages = defaultdict(set)
    for text, group in toxic if len(good) else ():
        g = grams(text)
        for p in np.flatnonzero(good[np.minimum(np.searchsorted(good, g), len(good) - 1)] == g):
            passages[text[text.rfind(b" ", 0, p + 1) : text.find(b" ", p + GRAM - 1) + 1]].add(group)
    out = b""
    for passage, groups in sorted(passages.items(), key=lambda x: (-len(x[1]), x[0])):
        if len(groups) >= 3 and passage not in out and len(out) + len(passage) <= size:
            out = passage + out
    return out


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """The content of a trained dictionary; the samples themselves if they are too few to train on."""
    import zstandard as z

    try:
        content = z.train_dictionary(size + 300, samples, k=24, d=6).as_bytes()
    except z.ZstdError:
        content = b"".join(dict.fromkeys(samples))
    return content[-size:]


def train(rows: list[tuple[str | None, int]]) -> Model | None:
    """Trains on (text, 0 or 1) of documents; None if a class is missing.

    Copies and near copies count once, so that they do not pass for evidence, and are in one fold.
    """
    texts = [(t := normal(text), _group(t), label) for text, label in rows]
    folds = [mix(np.array([g], np.uint64))[0] % np.uint64(FOLDS) for _, g, _ in texts]
    held_out = [k for k, f in enumerate(folds) if f == 0]
    known = [k for k, f in enumerate(folds) if f != 0]
    if any(len({texts[k][2] for k in some}) < 2 for some in (held_out, known)):  # too few to hold any out
        held_out = known = list(range(len(texts)))
    classes = [[texts[k][:2] for k in known if texts[k][2] == label] for label in (0, 1)]
    if not classes[0] or not classes[1]:
        return None
    samples = sorted({w for text, _ in classes[0] for w in windows(text, 8)}, key=hash_of)
    ordinary = _dictionary(samples, ORDINARY)
    ordinary = b"\x00" * max(0, LEAD - len(ordinary)) + ordinary
    toxic = toxic_passages(classes[1], classes[0], TOXIC)
    distance = Distance(toxic, ordinary)
    labels = np.array([texts[k][2] for k in held_out])
    best: tuple[float, Model] | None = None
    for words in WINDOWS:
        saved = [Counter(map(distance, windows(texts[k][0], words))) for k in held_out]
        total = np.array([max(1, c.total()) for c in saved])
        for least in LEAST:
            share = np.array([sum(n for d, n in c.items() if d >= least) for c in saved]) / total
            edges, at = np.unique(np.append(0.0, share), return_inverse=True)
            n = np.bincount(at[1:], minlength=len(edges)) + 0.02
            rates = isotonic(n, np.bincount(at[1:], labels, len(edges)) + 0.01)
            p = rates[at[1:]]
            likelihood = float(np.log(np.where(labels == 1, p, 1 - p)).sum())
            if best is None or likelihood > best[0]:
                best = (likelihood, Model(toxic, ordinary, words, least, edges, rates))
    return best[1]


def hash_of(window: bytes) -> tuple[int, bytes]:
    """An order that is the same in every run and mixes texts."""
    import zlib

    return zlib.crc32(window), window


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = MAX_TRAIN) -> Model | None:
    """Trains on at most bound labelled documents of each class; labels: doc_id, label.  Their texts reach the driver.

    A document that is labelled both ways counts as toxic.
    """
    known = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    some = [known.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound) for k in (0, 1)]
    chosen = F.broadcast(some[0].unionByName(some[1]))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(chosen, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    along = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # twice the bound of rows at most
    rows = texts.withColumn("size", F.sum(F.coalesce(F.length("text"), F.lit(0))).over(along)).where(F.col("size") <= MAX_CHARS).collect()
    return train([(r.text, r.label) for r in sorted(rows, key=lambda r: r.doc_id)])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", bound: int = MAX_TRAIN) -> DataFrame:
    """doc_id and score (0 to 1) of every row of docs, by the whole text.

    Null and empty texts have no hit and get that score; null ids and repeated rows are scored like
    others; extra columns are not read.  If the labels lack a class, every score is 0.
    """
    model = fit(docs, labels, id_col, text_col, bound)

    @F.pandas_udf("double")
    def each(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model.scorer() if model else lambda text: 0.0
        for texts in batches:
            yield texts.map(score).astype(float)

    return docs.select(F.col(id_col).alias("doc_id"), each(F.col(text_col)).alias("score"))
