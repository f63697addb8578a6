"""Quality classifier: random Fourier features of document statistics, ridge regression, isotonic calibration.

Each text becomes a short vector of statistics in one pass.  Random Fourier features approximate a
Gaussian kernel over them; the normal equations are sums over labelled rows, formed in each
partition and added up, so one small matrix reaches the driver whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stash

#: Random Fourier features, width of the kernel, ridge penalty, bins of the calibration.
FEATURES, WIDTH, RIDGE, BINS, SEED = 256, 5.0, 0.1, 1000, 7
#: One labelled row in so many calibrates.
CALIBRATE = 4

_CLASSES = np.zeros(256, np.uint8)  # 0 letters and bytes above 127
_CLASSES[[0x20, 9, 11, 12, 13]] = 1
_CLASSES[10] = 2
_CLASSES[ord("0") : ord("9") + 1] = 3
_CLASSES[ord("A") : ord("Z") + 1] = 4
_CLASSES[[ord(c) for c in ".,;:?'\"()-"]] = 5
_CLASSES[ord("!")] = 6
_CLASSES[ord("|")] = 7
_CLASSES[[ord(c) for c in "#*$%&<>@=+/\\^~_{}[]`"]] = 8
N_STATISTICS = 18


def statistics(text: str) -> np.ndarray:
    """Shares of character classes, lengths of words and lines, repetition; finite for any text, zero for an empty one."""
    out = np.zeros(N_STATISTICS)
    raw = text.encode("utf-8", "surrogatepass")
    if not raw.strip():
        return out
    codes = _CLASSES.take(np.frombuffer(raw, np.uint8))
    kinds = np.bincount(codes, minlength=9)
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    n, n_words = len(raw), len(words)
    sizes = np.fromiter(map(len, words), np.int64, n_words)
    out[:9] = kinds / n
    out[9] = np.log1p(n_words)
    out[10] = np.log1p(sizes.mean())
    out[11] = np.log1p(sizes.std())
    out[12] = len(set(words)) / n_words
    out[13] = np.log1p(n_words / len(lines))
    out[14] = len(set(lines)) / len(lines)
    pairs = len(set(zip(words, words[1:], strict=False)))
    out[15] = pairs / max(1, n_words - 1)
    out[16] = ((codes[:-1] == 8) & (codes[1:] == 1)).sum() / n_words
    out[17] = sum(x[-1:] in b".!?" for x in lines) / len(lines)
    return out


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and stats of every row of docs; null text counts as empty."""

    @F.pandas_udf("array<double>")
    def each(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t or "") for t in texts], dtype=object)

    return docs.select(F.col(id_col).alias("doc_id"), each(F.col(text_col)).alias("stats"))


def fourier(dims: int, features: int = FEATURES, width: float = WIDTH, seed: int = SEED) -> Callable[[np.ndarray], np.ndarray]:
    """Maps standardised rows to features whose products approximate a Gaussian kernel; a constant comes last."""
    rng = np.random.default_rng(seed)
    w = rng.normal(size=(dims, features)) / width
    b = rng.uniform(0, 2 * np.pi, features)
    return lambda x: np.hstack([np.sqrt(2 / features) * np.cos(x @ w + b), np.ones((len(x), 1))])


def isotonic(total: np.ndarray, positive: np.ndarray) -> np.ndarray:
    """The non-decreasing rates nearest to positive / total in weighted squares; bins without rows take a neighbour's rate."""
    blocks: list[list[float]] = []
    for n, p in zip(total, positive, strict=True):
        blocks.append([n, p, 1])
        while len(blocks) > 1 and blocks[-2][1] * max(blocks[-1][0], 1e-12) >= blocks[-1][1] * max(blocks[-2][0], 1e-12):
            n2, p2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + p2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), p / n if n else 0.0) for n, p, k in blocks])


class Model:
    """Standardisation, weights and calibration: a few kilobytes."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, rates: np.ndarray):
        self.mean, self.scale, self.weights, self.rates = mean, scale, weights, rates
        self.features = fourier(len(mean))

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(np.clip((stats - self.mean) / self.scale, -8, 8)) @ self.weights

    def bins(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(self.raw(stats) * len(self.rates), 0, len(self.rates) - 1).astype(np.int64)

    def score(self, stats: np.ndarray) -> np.ndarray:
        """The calibrated rate, linear between the middles of bins."""
        middles = (np.arange(len(self.rates)) + 0.5) / len(self.rates)
        return np.interp(self.raw(stats), middles, self.rates)


def _stack(pdf: pd.DataFrame) -> np.ndarray:
    return np.array(pdf["stats"].tolist()).reshape(len(pdf), -1)


def fit(stats: DataFrame, labels: DataFrame, ridge: float = RIDGE, bins: int = BINS) -> Model:
    """Fits on stats (doc_id, stats) joined with labels (doc_id, label 0 or 1); all rows that have a label count.

    Sums of each partition are one row for each row of the matrix; what reaches the driver is that
    matrix and the histogram of raw scores.  One row in CALIBRATE, by its statistics, calibrates and the others
    fit; with too few rows for both, all do either.  A document that is labelled both ways counts as 0.
    Without any label every score is 0.5.
    """
    known = labels.where("label is not null and doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
    held = F.pmod(F.xxhash64("stats"), F.lit(CALIBRATE)) == 0
    every = stash(stats.join(known, "doc_id").select("stats", F.col("label").cast("double").alias("label"), held.alias("held")), "labelled")
    both = every.select("held", F.col("label") > 0.5).distinct().count() == 4
    rows, calibrating = (every.where("not held"), every.where("held")) if both else (every, every)
    dims = N_STATISTICS
    moments = rows.select(F.posexplode("stats").alias("k", "x")).groupBy("k").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).collect()
    mean, scale = np.zeros(dims), np.ones(dims)
    for r in moments:
        mean[r.k], scale[r.k] = r.m, max(r.s, 1e-6)
    blank = Model(mean, scale, np.append(np.zeros(FEATURES), 0.5), np.full(bins, 0.5))
    if not moments:
        return blank

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for pdf in batches:
            if len(pdf):
                z = blank.features(np.clip((_stack(pdf) - mean) / scale, -8, 8))
                total += z.T @ np.hstack([z, pdf["label"].to_numpy()[:, None]])
        yield pd.DataFrame({"i": range(len(total)), "v": list(total)})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": pdf["i"].iloc[:1], "v": [np.sum(pdf["v"].tolist(), axis=0)]})

    found = rows.select("stats", "label").mapInPandas(sums, "i int, v array<double>").groupBy("i").applyInPandas(add, "i int, v array<double>").collect()
    total = np.array([r.v for r in sorted(found, key=lambda r: r.i)])
    penalty = np.full(FEATURES + 1, ridge)
    penalty[-1] = 1e-6
    model = Model(mean, scale, np.linalg.solve(total[:, :-1] + np.diag(penalty), total[:, -1]), np.zeros(bins))

    def binned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"bin": model.bins(_stack(pdf)), "label": pdf["label"]})

    counts = calibrating.select("stats", "label").mapInPandas(binned, "bin long, label double").groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("p")).collect()
    n, p = np.zeros(bins), np.zeros(bins)
    for r in counts:
        n[r.bin], p[r.bin] = r.n, r.p
    filled = np.flatnonzero(n)
    rates = np.interp(np.arange(bins), filled, isotonic(n[filled], p[filled]))
    return Model(mean, scale, model.weights, rates)


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every row of docs; labels: doc_id, label of the rows to learn from.

    Only statistics of the text are inputs.  Null and empty texts have all statistics zero and get the
    score of that point; null ids and repeated rows are scored like others; extra columns are not read.
    """
    stats = stash(with_statistics(docs, id_col, text_col), "statistics")
    model = fit(stats, labels)

    @F.pandas_udf("double")
    def score(s: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array(s.tolist()).reshape(len(s), -1)))

    return stats.select("doc_id", score("stats").alias("score"))


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds
