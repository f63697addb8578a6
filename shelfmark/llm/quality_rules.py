"""Quality rules in DataFrame functions only: plain text measures, then a hashed n-gram likelihood ratio.

Unigrams and bigrams are hashed to a fixed number of buckets.  One multinomial is counted on all
documents, one on documents that are trusted; a document's score is the mean of
log p_target(bucket) - log p_raw(bucket) over its n-grams.  The verdict is a threshold on that mean,
lower where trusted documents that were not counted themselves score lower, as they do in a small
corpus: no randomness, every document is judged, and copies of a whole table change no verdict.
"""

from __future__ import annotations

from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import SPACE, SPACES, let, stash, unused, words

#: Buckets of the two multinomials: a table of this size is all that is sent to executors.
BUCKETS = 10_000
#: The target is drawn to the raw distribution by so many per cent of its own n-grams, whatever their number.
SMOOTHING = 10
#: Documents with a lower mean log ratio are rejected, unless held-out trusted documents score lower still.
THRESHOLD = -0.04
#: Folds of trusted documents, by their text; the share of held-out ones that may score below the threshold.
FOLDS, HELD_OUT_SHARE = 4, 0.01
#: At most so many trusted ids are broadcast (about 50 MB); more meet the documents in a shuffle.
MAX_BROADCAST = 1_000_000
#: Up to so many distinct repeated windows are looked up one by one.
MANY = 32


def repeated_words(h: Column, n_words: Column) -> Column:
    """Words in 3-word windows that the text has twice or more, the first included; h: a hash of each word.

    A primitive sort of the windows' hashes shows which ones repeat.  A text without any is done; up
    to MANY distinct ones are looked up for each window; more are found by a sort of places.
    """

    def covered(places: Column) -> Column:
        """Words under windows at ascending places: overlapping windows count a word once."""
        first = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        step = lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n"))
        return F.aggregate(places, first, step, lambda a: a["n"])

    def of_windows(g: Column) -> Column:
        bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(F.lit(63).cast("long")).cast("int"))

        def of_repeated(d: Column) -> Column:
            def of_mask(mask: Column) -> Column:  # one test of a bit spares most look-ups
                places = F.transform(g, lambda x, i: F.when((mask.bitwiseAND(bit(x)) != 0) & F.array_contains(d, x), i))
                return covered(F.filter(places, lambda x: x.isNotNull()))

            few = let(F.aggregate(d, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(bit(x))), of_mask)
            return F.when(F.size(d) == 0, F.lit(0).cast("long")).when(F.size(d) <= MANY, few).otherwise(covered(by_sort(g)))

        repeated = let(F.sort_array(g), lambda s: F.array_distinct(F.filter(s, lambda x, i: x == F.get(s, i + 1))))
        return let(repeated, of_repeated)

    def by_sort(g: Column) -> Column:
        """Places of the windows that repeat, ascending: equal windows are neighbours in an order by hash and place."""
        ordered = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        same = lambda s, i, j: F.coalesce(F.get(s, i)["g"] == F.get(s, j)["g"], F.lit(False))
        flagged = lambda s: F.filter(s, lambda x, i: same(s, i, i - 1) | same(s, i, i + 1))
        return F.sort_array(F.transform(let(ordered, flagged), lambda x: x["i"]))

    windows = F.transform(F.slice(h, 1, F.greatest(n_words - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))
    return F.when(n_words < 4, F.lit(0).cast("long")).otherwise(let(windows, of_windows))


def word_hashes(text: Column) -> Column:
    """A hash of each word, in order."""
    return F.transform(words(text), lambda x: F.xxhash64(x))


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the base measures of a text; null counts as empty.  Columns of their names are replaced, all others pass through."""
    h = unused(docs, "_h")
    return _measured(docs, text_col, h).drop(h)


def _measured(docs: DataFrame, text_col: str, h: str) -> DataFrame:
    """Adds the words' hashes, in a column named h, and the base measures of a text."""
    line = unused(docs, "_lines")
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    out = docs.withColumn(h, word_hashes(text)).withColumn(line, lines).withColumn("n_words", F.size(h).cast("long"))
    out = out.withColumns(
        {
            "word_chars": F.length(reduce(lambda t, c: F.replace(t, F.lit(c), F.lit("")), SPACES, text)).cast("long"),
            "n_symbols": F.when(text.rlike("[#*$%&|<>]"), F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).otherwise(0).cast("long"),
            "n_dup_lines": (F.size(line) - F.size(F.array_distinct(line))).cast("long"),
            "n_repeat_words": repeated_words(F.col(h), F.col("n_words").cast("int")),
        }
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.withColumn("base_failed", failed).drop(line)


def bucket(gram: Column, n: int = BUCKETS) -> Column:
    """The bucket of an n-gram's hash."""
    return F.pmod(gram, F.lit(n)).cast("int")


def _hashed(text: Column) -> Column:
    """word_hashes() behind a condition that is always true: filters stay above it, where they don't split the text again."""
    return F.when(F.monotonically_increasing_id() >= 0, word_hashes(text))


def trusted_documents(docs: DataFrame, trusted_ids: DataFrame, id_col: str, text_col: str, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """_h and fold of every trusted document; copies of a text are in one fold."""
    ids = trusted_ids.select(F.col("id").alias("_id")).dropDuplicates()
    each = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    if ids.count() <= max_broadcast:
        known = each.join(F.broadcast(ids), "_id", "left_semi")
    else:
        known = stash(each.join(ids, "_id", "left_semi"), "trusted")
    return known.select(_hashed(F.col("_text")).alias("_h"), F.pmod(F.xxhash64("_text"), F.lit(FOLDS)).cast("int").alias("fold"))


def histograms(hashed: DataFrame, parts: dict[str, Column], n: int) -> dict[str, list[int]]:
    """The unigrams and bigrams of _h by bucket, for rows of each part; the partial sums of a task are at most n rows."""
    two = F.transform(F.slice("_h", 1, F.greatest(F.size("_h") - 1, F.lit(0))), lambda x, i: F.xxhash64(x, F.get("_h", i + 1)))
    others = [c for c in hashed.columns if c != "_h"]
    each = hashed.select(*others, F.explode(F.concat("_h", two)).alias("g"))
    rows = each.groupBy(bucket(F.col("g"), n).alias("b")).agg(*[F.count_if(c).alias(name) for name, c in parts.items()]).collect()
    found = {name: [0] * n for name in parts}
    for r in rows:
        for name in parts:
            found[name][r.b] += r[name]
    return found


def ratios(raw: list[int], target: list[int]) -> list[float]:
    """log p_target - log p_raw of each bucket; zero where the raw corpus has nothing, and if the target is empty.

    Only proportions count, and quotients of integers are exactly rounded: tenfold counts give the same numbers.
    """
    total_raw, total_target = sum(raw), sum(target)
    if not total_target:
        return [0.0] * len(raw)
    one = lambda r, t: (100 * t * total_raw + SMOOTHING * r * total_target) / ((100 + SMOOTHING) * r * total_target)
    return [log(one(r, t)) if r else 0.0 for r, t in zip(raw, target, strict=True)]


def _counts(docs: DataFrame, known: DataFrame, text_col: str, n: int) -> tuple[list[int], list[list[int]]]:
    """Counts by bucket of all documents, and of the trusted ones of each fold."""
    raw = histograms(docs.select(_hashed(F.col(text_col)).alias("_h")), {"raw": F.lit(True)}, n)["raw"]
    folds = histograms(known, {f"f{k}": F.col("fold") == k for k in range(FOLDS)}, n)
    return raw, list(folds.values())


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = BUCKETS) -> list[float]:
    """log p_target - log p_raw of each bucket; all zero if nothing is trusted."""
    raw, folds = _counts(docs, trusted_documents(docs, trusted_ids, id_col, text_col), text_col, n)
    return ratios(raw, [sum(f) for f in zip(*folds, strict=True)])


def _table(weights: list[float]) -> Column:
    return F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")


def mean_ratio(table: Column, n: int, words: str = "_h") -> Column:
    """The mean of a table of n log ratios over the n-grams of a column of words' hashes."""

    def total(t: Column) -> Column:
        h = F.col(words)
        one = lambda x: F.get(t, bucket(x, n))
        each = F.transform(h, lambda x, i: one(x) + F.when(i + 1 < F.size(h), one(F.xxhash64(x, F.get(h, i + 1)))).otherwise(0.0))
        return F.aggregate(each, F.lit(0.0), lambda a, x: a + x)

    return F.round(let(table, total) / F.greatest(F.lit(1), 2 * F.size(words) - 1), 9)


def held_out_threshold(known: DataFrame, raw: list[int], folds: list[list[int]], threshold: float, n: int) -> float:
    """threshold, or what HELD_OUT_SHARE of the trusted documents score below when their own fold is not counted."""
    whole = [sum(f) for f in zip(*folds, strict=True)]
    table = F.lit(None).cast("array<double>")
    for k, own in enumerate(folds):
        rest = [w - x for w, x in zip(whole, own, strict=True)]
        if any(rest):
            table = F.when(F.col("fold") == k, _table(ratios(raw, rest))).otherwise(table)
    scored = known.select(F.when(F.size("_h") >= 50, F.floor(mean_ratio(table, n) * 10_000)).alias("s"))
    rows = sorted((r.s, r.m) for r in scored.groupBy("s").agg(F.count(F.lit(1)).alias("m")).collect() if r.s is not None)
    least, seen = HELD_OUT_SHARE * sum(m for _, m in rows), 0
    for s, m in rows:
        seen += m
        if seen >= least:
            return min(threshold, s / 10_000)
    return threshold


def trusted(labels: DataFrame) -> DataFrame:
    """The ids of all documents labelled as good."""
    return labels.where("quality = 1 and doc_id is not null").select(F.col("doc_id").alias("id")).dropDuplicates()


def judge(
    docs: DataFrame,
    trusted_ids: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    n: int = BUCKETS,
) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, log_ratio, kept to docs.

    A null text counts as empty and fails (fewer than 50 words); null ids are judged but never
    trusted; repeated rows are judged alike; all other columns pass through, columns of these eight names
    are replaced.  Very long texts are judged whole, and an empty table gives an empty one.
    """
    known = trusted_documents(docs, trusted_ids, id_col, text_col)
    raw, folds = _counts(docs, known, text_col, n)
    threshold = held_out_threshold(known, raw, folds, threshold, n)
    h = unused(docs, "_h")
    out = _measured(docs, text_col, h)
    out = out.withColumn("log_ratio", mean_ratio(_table(ratios(raw, [sum(f) for f in zip(*folds, strict=True)])), n, h))
    # The last conjunct is always true.  It keeps a filter on the verdict from moving below the columns it
    # is made of, where each reference to the words would split the text again.
    verdict = ~F.col("base_failed") & (F.col("log_ratio") >= threshold) & (F.monotonically_increasing_id() >= 0)
    return out.withColumn("kept", verdict).drop(h)
