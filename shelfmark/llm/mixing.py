"""Mixing sources to target weights.

The words of a source, document after document, are one stream that is cut into blocks of equal length; its last
words are a shorter block.  A source's target in words fixes how many slots of the mix it fills: whole passes over
its blocks, then a part of one.  Slots are dealt to output shards.  Every slot of a shard draws a source with the
probability of its share of all slots, so a shard's counts of sources are a multinomial draw.  Draws beyond what a
source has to fill are redrawn among those short of it, which is about the root of a source's number of slots, so
that targets are met to the word.  The n-th slot of a source goes through a permutation of the source's block
numbers, another one for every pass, and meets the block's documents in a join by number.

All randomness is a hash of numbers and a seed, so a rerun gives the same mix.  Nothing grows in one task: streams
and draws are numbered in two levels, by buckets and within them; only sums of the whole table reach the driver.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import partitions, stash, words

#: Words of a block, slots of an output shard, times that a source may be repeated, weights of the sources in turn.
BLOCK, SHARD, REPEATS, WEIGHTS = 512, 1024, 3, (1, 2, 3)
#: Numbers of a cell in which draws meet the intervals of the sources; rounds of a permutation.
CELL, ROUNDS = 512, 24
SEED = 20


def running(df: DataFrame, by: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Adds the sum of value over the rows before, in one fixed order of the rows of a group.

    The order is by a hash of the columns of order, then by these; they tell rows apart that are not equal.  A group
    of n rows has about root n buckets, so neither a bucket nor the list of a group's buckets is long.
    """
    if by:
        sized = df.join(df.groupBy(*by).agg(F.ceil(F.sqrt(F.count(F.lit(1)))).alias("_buckets")), by)
    else:
        sized = df.withColumn("_buckets", F.lit(isqrt(df.count()) + 1).cast("long"))
    # Dealt out by bucket in so many words: else the windows are content with rows dealt by group, and a group is one task's.
    dealt = sized.withColumn("_bucket", F.pmod(F.xxhash64(*order), "_buckets")).drop("_buckets").repartition(partitions(df.sparkSession), *by, "_bucket")
    inside = Window.partitionBy(*by, "_bucket").orderBy(*order)
    summed = dealt.withColumn("_inside", F.sum(value).over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col(value))
    totals = dealt.groupBy(*by, "_bucket").agg(F.sum(value).alias("_total"))
    along = Window.partitionBy(*(by or [F.lit(0)])).orderBy("_bucket")
    starts = totals.select(*by, "_bucket", (F.sum("_total").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_total")).alias("_start"))
    return summed.join(starts, [*by, "_bucket"]).withColumn(name, F.col("_start") + F.col("_inside")).drop("_bucket", "_start", "_inside")


def numbered(df: DataFrame, name: str, *order: Column) -> DataFrame:
    """Numbers the rows of a table from 0 in an order: ranges of rows by themselves, each after those before it."""
    ranges = stash(df.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, place = F.shiftright("_at", 33).alias("_part"), F.col("_at").bitwiseAND((1 << 33) - 1)
    sizes = ranges.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))  # a row for each range
    starts = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_start"))
    return ranges.withColumn("_part", part).join(F.broadcast(starts), "_part").withColumn(name, F.col("_start") + place).drop("_at", "_part", "_start")


def in_intervals(points: DataFrame, point: str, intervals: DataFrame, start: str, length: str) -> DataFrame:
    """Points with the columns of the interval that each lies in; intervals lie end to end.

    Both meet in cells of the number line: an interval stands in every cell that it reaches into, and a
    point takes the last one that begins no later.
    """
    kept = [c for c in intervals.columns if c not in (start, length)]
    end = F.col(start) + F.col(length) - 1
    cells = F.explode(F.sequence(F.floor(F.col(start) / CELL), F.floor(end / CELL))).alias("_cell")
    of = F.struct(F.col(start).alias("start"), F.col(length).alias("length"), *kept)
    begins = intervals.where(F.col(length) > 0).select(cells, of.alias("_of")).select("_cell", F.greatest(F.col("_of.start"), F.col("_cell") * CELL).alias("_at"), F.lit(0).alias("_kind"), "_of", F.lit(None).cast(points.schema.simpleString()).alias("_point"))
    asked = points.select(F.floor(F.col(point) / CELL).alias("_cell"), F.col(point).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(begins.schema["_of"].dataType).alias("_of"), F.struct(*points.columns).alias("_point"))
    along = Window.partitionBy("_cell").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = begins.unionByName(asked).withColumn("_of", F.last("_of", ignorenulls=True).over(along)).where("_kind = 1")
    return found.select("_point.*", F.col("_of.start").alias(start), F.col("_of.length").alias(length), *[F.col(f"_of.{c}").alias(c) for c in kept])


def _hash(*parts: Column | int) -> Column:
    """A hash of numbers and the seed."""
    return F.xxhash64(F.lit(SEED).cast("long"), *[(p if isinstance(p, Column) else F.lit(p)).cast("long") for p in parts])


def permuted(x: Column, n: Column, *key: Column) -> Column:
    """The place of x in a keyed permutation of the numbers below n: in every round a number and its mirror image about a point drawn for the round change places or not."""

    def turn(x: Column, r: Column) -> Column:
        image = F.pmod(F.pmod(_hash(1, r, *key), n) - x, n)
        return F.when(_hash(2, r, F.greatest(x, image), *key).bitwiseAND(1) == 1, image).otherwise(x)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), x.cast("long"), turn)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, no (by code point, null last), weight, source_size and target (double, in words) of each source.

    Targets share all words by weight; one beyond so many times its source's size stops there, and the
    excess is shared by weight among the others until none is above.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod("no", F.lit(len(weights))).cast("int"))
    sources = stash(numbered(sizes, "no", F.col("source").asc_nulls_last()).withColumn("weight", turn), "sources")
    most = F.col("source_size") * repeats
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    capped, left, shares = F.lit(False), total, 0
    while True:
        # Two sums a round; a source that is capped stays so, as what the others get only grows.
        held = sources.agg(F.coalesce(F.sum(F.when(capped, most)), F.lit(0)), F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0))).first()
        if (total - held[0], held[1]) == (left, shares) or not held[1]:
            break
        left, shares = total - held[0], held[1]
        capped = most.cast("decimal(38,0)") * F.lit(shares).cast("decimal(38,0)") < F.lit(left).cast("decimal(38,0)") * F.col("weight").cast("decimal(38,0)")
    shared = F.lit(left).cast("double") * F.col("weight") / F.lit(max(shares, 1)).cast("double")
    return sources.withColumn("target", F.when(capped, most.cast("double")).otherwise(shared))


def with_slots(targets: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds goal (the target in whole words), blocks, full (those of full length) and slots that the goal fills."""
    size, goal = F.col("source_size"), F.col("goal")
    passes = F.when(size > 0, F.floor(goal / size)).otherwise(0)
    out = targets.withColumn("goal", F.round("target").cast("long")).withColumns({"blocks": F.ceil(size / block), "full": F.floor(size / block)})
    return out.withColumn("slots", (passes * F.col("blocks") + F.ceil((goal - passes * size) / block)).cast("long"))


def draw_counts(sources: DataFrame, shard: int = SHARD) -> DataFrame:
    """shard, no, n: how often each source is drawn for each output shard; the shard's size in slots is their sum."""
    spark = sources.sparkSession
    total = sources.agg(F.sum("slots")).first()[0] or 0
    laid = running(sources.select("no", "slots"), [], ["no"], "slots", "start")
    slots = spark.range(total).select(F.floor(F.col("id") / shard).alias("shard"), F.pmod(_hash(3, F.col("id")), F.lit(max(total, 1))).alias("at"))
    return in_intervals(slots, "at", laid, "start", "slots").groupBy("shard", "no").agg(F.count(F.lit(1)).alias("n"))


def fill_slots(sources: DataFrame, counts: DataFrame) -> DataFrame:
    """shard, no, j: every slot of the mix with its source and its number among the slots of this source.

    Draws of a source beyond its slots go to sources that were drawn too seldom.
    """
    first = running(counts, ["no"], ["shard"], "n", "first").join(sources.select("no", "slots"), "no")
    kept = F.least(F.col("n"), F.greatest(F.lit(0), F.col("slots") - F.col("first")))
    split = stash(first.withColumn("kept", kept).withColumn("over", F.col("n") - F.col("kept")), "draws")
    own = split.where("kept > 0").select("shard", "no", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("kept") - 1)).alias("j"))
    over = running(split.where("over > 0"), [], ["no", "shard"], "over", "u")
    again = over.select("shard", F.explode(F.sequence(F.col("u"), F.col("u") + F.col("over") - 1)).alias("u"))
    drawn = split.groupBy("no").agg(F.sum("n").alias("drawn"))
    short = sources.join(drawn, "no", "left").select("no", F.coalesce("drawn", F.lit(0)).alias("drawn"), (F.col("slots") - F.coalesce("drawn", F.lit(0))).alias("lack")).where("lack > 0")
    gaps = running(short, [], ["no"], "lack", "gap")
    redrawn = in_intervals(again, "u", gaps, "gap", "lack").select("shard", "no", (F.col("drawn") + F.col("u") - F.col("gap")).alias("j"))
    return own.unionByName(redrawn)


def blocks_of_slots(slots: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """Adds pass, block (its number in the source) and take (words of it, fewer than it has in the last slot of a source)."""
    at = slots.join(sources.select("no", "source_size", "goal", "blocks", "full"), "no").withColumns({"pass": F.floor(F.col("j") / F.col("blocks")), "i": F.pmod("j", "blocks")})
    number = F.when(F.col("i") < F.col("full"), permuted(F.col("i"), F.col("full"), F.col("no"), F.col("pass"))).otherwise(F.col("full"))
    left = F.col("goal") - F.col("pass") * F.col("source_size") - F.col("i") * block
    whole = F.when(F.col("i") < F.col("full"), F.lit(block)).otherwise(F.col("source_size") - F.col("full") * block)
    return at.select("shard", "no", "j", "pass", number.alias("block"), F.least(whole, left).alias("take"))


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, shard: int = SHARD, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Mixes the documents of all sources to their targets.

    docs: any table with an id, a text and a source; other columns are not read, and rows need not be distinct.
    Returns documents (row, doc_id, source, size, source_size, target, taken), spans (shard, no, j, row, doc_id,
    word, words, at: words of the document from word on, from 0, stand at place at of the source's j-th slot) and
    sources (source, no, weight, source_size, target, goal, blocks, full, slots).

    A null or empty text has no words and is taken 0 times.  A null source is one, the last.  Null ids and repeated
    rows are documents like others.  A very long text is as many blocks as it fills.  The words that the mix takes of
    a source are its target, rounded; no document is taken more often than repeats times.  Which equal rows of one id
    and size the words are taken from is left open; the table of documents is the same, row numbers apart.  An
    empty table gives empty tables.
    """
    # A hash of the text is not needed to tell rows apart: of rows equal in id, size and source each place is as good as the other.
    base = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.size(words(F.col(text_col))).cast("long").alias("size"))
    sized = stash(base, "sizes")
    sources = stash(with_slots(source_targets(sized, weights, repeats), block), "targets")
    facts = sources.select(F.col("source").alias("_source"), "no", "source_size", "target")
    placed = sized.join(facts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    stream = running(placed, ["no"], ["doc_id", "size"], "size", "before")
    first, last = F.floor(F.col("before") / block), F.floor((F.col("before") + F.col("size") - 1) / block)
    cut = stream.select("*", F.explode_outer(F.when(F.col("size") > 0, F.sequence(first, last))).alias("block"))
    begin = F.greatest("before", F.col("block") * block)
    end = F.least(F.col("before") + F.col("size"), (F.col("block") + 1) * block)
    pieces = stash(cut.select("row", "doc_id", "source", "size", "no", "source_size", "target", "block", (begin - F.col("before")).alias("word"), (end - begin).alias("words"), (begin - F.col("block") * block).alias("at")), "pieces")
    taken_blocks = stash(blocks_of_slots(fill_slots(sources, draw_counts(sources, shard)), sources, block), "slots")
    part = F.least(F.col("words"), F.coalesce("take", F.lit(0)) - F.col("at"))  # least() passes over nulls: a block that is not drawn takes 0
    met = pieces.join(taken_blocks, ["no", "block"], "left").withColumn("part", F.greatest(part, F.lit(0)))
    by_row = met.groupBy("row", "doc_id", "source", "size", "source_size", "target").agg(F.sum("part").alias("taken"))
    spans = met.where("part > 0").select("shard", "no", "j", "row", "doc_id", "word", F.col("part").alias("words"), "at")
    return by_row, spans, sources


def mixed_texts(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """shard, no, j, text: the mix itself, the words of every slot parted by spaces; ids of docs are unique and not null."""
    held = docs.select(F.col(id_col).alias("doc_id"), words(F.col(text_col)).alias("_w"))
    cut = spans.join(held, "doc_id").select("shard", "no", "j", "at", F.array_join(F.slice("_w", (F.col("word") + 1).cast("int"), F.col("words").cast("int")), " ").alias("t"))
    placed = cut.groupBy("shard", "no", "j").agg(F.sort_array(F.collect_list(F.struct("at", "t"))).alias("_t"))
    return placed.select("shard", "no", "j", F.array_join(F.col("_t.t"), " ").alias("text"))
