"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and units become typed placeholders, word for word, so that a question asked again
with other values has the same template.  Windows of the benchmark's templates meet those of the
documents in a hash join; windows of one text and one item that lie on one diagonal are one match.
A match counts as far as its slots are consistent: in the longest run of its windows in which one value of
the item always stands against one value of the document, case and punctuation aside.

An item with fewer windows needs all of them.  One without any, short or all numbers, is met as a whole: by its
template if it has enough literal words, else word for word; one of a few words only by a document that is nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import SPACE, let, stash, unused, words

#: Words of a window, words in it that must be literal, windows that a match needs.
WINDOW, LITERAL, LEAST = 8, 5, 3
#: Items of fewer words are no evidence within a longer document.
SHORT = 4
#: So many rows are broadcast at most (about 40 MB): windows of the benchmark, matched texts.  More meet the documents in a shuffle.
MAX_BROADCAST = 1_000_000

# Units that follow a number.
UNITS = (
    "mm cm m km in ft yd mi mile miles inch inches foot feet g kg mg lb lbs oz t ton tons tonnes gram grams kilogram kilograms "
    "l ml litre litres liter liters gallon gallons s sec second seconds min minute minutes h hr hour hours day days week weeks "
    "month months year years dollar dollars euro euros cent cents pound pounds percent degree degrees watt watts kw kwh volt volts"
).split()
NUM, NAME, UNIT = "0", "1", "2"  # no other word of a template has a digit


def template(text: Column) -> Column:
    """The words of a text's template: lower case without punctuation, with placeholders; one for each word with a letter or digit."""
    numbered = F.regexp_replace(text, rf"(?<![^{SPACE}])[^{SPACE}0-9]*+[0-9][^{SPACE}]*+", NUM)
    named = F.regexp_replace(numbered, rf"(?<=[\p{{L}},;][{SPACE}])\p{{Lu}}\p{{Ll}}[\p{{L}}'’-]*+", NAME)
    unit = "|".join(sorted(UNITS, key=lambda u: (-len(u), u)))
    united = F.regexp_replace(named, rf"(?<=(?:^|[{SPACE}]){NUM}[{SPACE}])(?i:{unit})(?![\p{{L}}\p{{N}}])", UNIT)
    cheap = F.when(text.rlike("[0-9]"), united).otherwise(F.regexp_replace(text, rf"(?<=[\p{{L}},;][{SPACE}])\p{{Lu}}\p{{Ll}}[\p{{L}}'’-]*+", NAME))
    return words(F.lower(F.regexp_replace(cheap, rf"[^\p{{L}}\p{{N}}{SPACE}]+", "")))


def raw_words(text: Column) -> Column:
    """The words that template() has a word for, in lower case without punctuation."""
    bare = F.transform(words(text), lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}\p{N}]+", "")))
    return F.filter(bare, lambda w: w != "")


def window_hashes(w: Column, k: int, seed: str = "") -> Column:
    """A hash of every window of k words."""
    n = F.greatest(F.size(w) - (k - 1), F.lit(0))
    first = [F.lit(seed)] if seed else []
    of_hashes = lambda h: F.transform(F.slice(h, 1, n), lambda x, i: F.xxhash64(*first, x, *[F.get(h, i + j) for j in range(1, k)]))
    return let(F.transform(w, lambda x: F.xxhash64(x)), of_hashes)


def _literals(w: Column) -> Column:
    return F.size(F.filter(w, lambda x: ~x.isin(NUM, NAME, UNIT)))


def benchmark_windows(items: DataFrame, k: int = WINDOW, literal: int = LITERAL, least: int = LEAST) -> DataFrame:
    """hash, item, at, need: every window of the benchmark with enough literal words, and how many a match of its item needs."""
    enough = lambda i: _literals(F.slice("words", i + 1, k)) >= literal
    hashes = F.transform(window_hashes(F.col("words"), k), lambda h, i: F.when(enough(i), F.struct(h.alias("hash"), i.alias("at"))))
    each = items.withColumn("windows", F.filter(hashes, lambda x: x.isNotNull()))
    need = F.least(F.lit(least), F.size("windows")).alias("need")
    return each.select("item", need, F.explode("windows").alias("x")).select("x.hash", "item", "x.at", "need")


def whole_items(items: DataFrame, windows: DataFrame, literal: int = LITERAL, short: int = SHORT) -> DataFrame:
    """hash, item, at, need, and kind: the items without windows, each by one hash of all of it.  kind: words and how they are met."""
    rest = items.where(F.size("words") > 0).join(windows.select("item").distinct(), "item", "left_anti")
    size = F.size("words")
    how = F.when(size < short, "alone").when(_literals(F.col("words")) >= literal, "template").otherwise("verbatim")
    kind = F.concat_ws(" ", size.cast("string"), how)
    hashed = F.transform(F.when(how == "template", F.col("words")).otherwise(F.col("raw")), lambda x: F.xxhash64(x))
    return rest.select("item", hashed.alias("h"), kind.alias("kind")).select("item", "kind", "h", F.lit(0).alias("at"), F.lit(1).alias("need"))


def _one_hash(kind: str) -> Column:
    """The hash of a whole item of a kind, as window_hashes() has it."""
    k = int(kind.split()[0])
    return F.xxhash64(F.lit(kind), *[F.get("h", F.lit(j)) for j in range(k)])


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    k: int = WINDOW,
    literal: int = LITERAL,
    least: int = LEAST,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """Every match of a text and an item: text_hash, item_id, shift (place in the text less that in the item), windows (of
    its longest consistent run), consistent.

    benchmark: item_id, text.  The template windows of texts go straight from the scan into the join;
    only distinct texts with a match move, once, for their slots.
    """
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).dropDuplicates()
    items = items.withColumn("words", template(F.col("text"))).withColumn("raw", raw_words(F.col("text")))
    items = stash(items.select(F.xxhash64("item_id", "text").alias("item"), "item_id", "words", "raw"), "items")
    windows = stash(benchmark_windows(items, k, literal, least), "windows")
    whole = stash(whole_items(items, windows, literal), "whole")
    kinds = sorted(r.kind for r in whole.select("kind").distinct().collect())  # a number of words and one of three ways
    listed = windows.withColumn("span", F.lit(k))
    for kind in kinds:
        one = whole.where(F.col("kind") == kind).select(_one_hash(kind).alias("hash"), "item", "at", "need", F.lit(int(kind.split()[0])).alias("span"))
        listed = listed.unionByName(one)
    if kinds:
        listed = stash(listed, "listed")
    if listed.count() <= max_broadcast:
        listed = F.broadcast(listed)
    keyed = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    placed = lambda h: F.transform(h, lambda x, i: F.struct(i.alias("place"), x.alias("hash")))

    def hashes(w: Column) -> Column:
        each = [placed(window_hashes(w, k))]
        for kind in kinds:
            n, how = kind.split()
            of = placed(window_hashes(w if how == "template" else raw_words(F.col("text")), int(n), kind))
            each.append(F.when(F.size(w) == int(n), of).otherwise(F.slice(of, 1, 0)) if how == "alone" else of)
        return F.concat(*each)

    exploded = keyed.select("text_hash", F.explode(let(template(F.col("text")), hashes)).alias("x")).select("text_hash", "x.place", "x.hash")
    met = exploded.join(listed, "hash").select("text_hash", "item", (F.col("place") - F.col("at")).alias("shift"), "at", "span", "need")
    found = met.groupBy("text_hash", "item", "shift").agg(F.sort_array(F.collect_set(F.struct("at", "span"))).alias("ats"), F.max("need").alias("need"))
    found = stash(found.where(F.size("ats") >= F.col("need")), "matches")
    wanted = stash(found.select("text_hash").distinct(), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= max_broadcast else wanted.hint("shuffle_hash")
    texts = keyed.join(wanted, "text_hash", "left_semi").groupBy("text_hash").agg(F.first("text").alias("text"))
    texts = texts.select("text_hash", raw_words(F.col("text")).alias("doc_raw"))
    both = found.join(texts, "text_hash").join(items.withColumnsRenamed({"words": "item_words", "raw": "item_raw"}), "item")

    def slots(w: Column) -> Column:
        """The values against each other in a window, distinct."""
        pair = lambda j: F.struct(F.get("item_raw", j).alias("item"), F.get("doc_raw", j + F.col("shift")).alias("doc"))
        here = F.filter(F.sequence(w["at"], w["at"] + w["span"] - 1), lambda j: F.get("item_words", j).isin(NUM, NAME, UNIT))
        return F.array_distinct(F.transform(here, pair))

    def step(acc: Column, w: Column) -> Column:
        def judged(p: Column) -> Column:
            own = F.size(F.array_distinct(F.transform(p, lambda x: x["item"]))) == F.size(p)
            clash = F.exists(p, lambda x: F.coalesce(F.try_element_at(acc["values"], x["item"]) != x["doc"], F.lit(False)))
            fresh = F.filter(p, lambda x: ~F.map_contains_key(acc["values"], x["item"]))
            none = F.create_map().cast("map<string,string>")
            values = F.when(own & ~clash, F.map_concat(acc["values"], F.map_from_entries(fresh))).when(own, F.map_from_entries(p)).otherwise(none)
            run = F.when(own & ~clash, acc["run"] + 1).when(own, F.lit(1)).otherwise(F.lit(0))
            return F.struct(values.alias("values"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

        return let(slots(w), judged)

    start = F.struct(F.create_map().cast("map<string,string>").alias("values"), F.lit(0).alias("run"), F.lit(0).alias("best"))
    both = both.withColumn("run", F.aggregate("ats", start, step, lambda acc: acc["best"]))
    return both.select("text_hash", "item_id", "shift", F.col("run").alias("windows"), (F.col("run") >= F.col("need")).alias("consistent"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", max_broadcast: int = MAX_BROADCAST, **options: int) -> DataFrame:
    """Adds contaminated, n_items, items (ids, comma-joined) and n_windows to docs.

    Null and empty texts, and an empty benchmark, match nothing; so do items without a letter or
    digit.  Null ids and repeated rows are judged by their text like others.  All other columns pass
    through; columns of these four names are replaced.
    """
    good = matches(docs, benchmark, text_col, max_broadcast=max_broadcast, **options).where("consistent")
    key = unused(docs, "text_hash")
    each = good.groupBy(F.col("text_hash").alias(key)).agg(
        F.array_join(F.transform(F.sort_array(F.collect_set("item_id")), lambda x: x.cast("string")), ",").alias("items"),
        F.countDistinct("item_id").cast("int").alias("n_items"),
        F.sum("windows").cast("int").alias("n_windows"),
    )
    each = stash(each, "contaminated")
    each = F.broadcast(each) if each.count() <= max_broadcast else each
    base = docs.drop("contaminated", "items", "n_items", "n_windows").withColumn(key, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    out = base.join(each, key, "left").withColumn("contaminated", F.col("n_items").isNotNull()).drop(key)
    return out.fillna({"n_items": 0, "n_windows": 0, "items": ""}, ["n_items", "n_windows", "items"])
