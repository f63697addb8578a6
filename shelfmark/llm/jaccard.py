"""Exact n-gram Jaccard join in the metric space of shingle sets.

Jaccard distance is a metric, and two documents link when it is at most r = 0.2.

1. Documents of one shingle set form a class; all further steps see a class once.
2. Unrelated sets all have distance 1, from any pivot, so pivots drawn at random part nothing.
   Pivots are therefore drawn where they are near: any two sets that link share one of their first
   20 % of shingles (in one order of all shingles, frequent ones last), so for each such shingle the
   class with the smallest key is the pivot of its holders.  A pivot's region is all that share a
   leading shingle with it; a document on a boundary is replicated to each of its pivots' regions.
   Within a region, counts by bucket bound every distance from below, in a metric of their own; what
   they hold apart is parted before any set moves.
3. A region that is too large for a task is parted again: pivots within it create Voronoi cells,
   and a document goes to every cell whose pivot is within 2 r of its nearest distance (triangle
   inequality), or to the cell of what is far from all pivots.  A cell that stays too large is
   joined block by block, each pair of blocks in a task of its own.
4. Within a region: the ball of radius r about a pivot is one component.  Only documents in the window
   (r, 2 r] can link to it from outside; they are compared with the ball, which is then done with, and the rest go on
   with the next pivot.
5. The links that are left, a spanning set of all, are joined to components by labels that flow
   and jump in distributed rounds.
6. All links are counted within components, which are parted by pivots as in 3 where they are large: a class counts
   its links in the cell of its nearest pivot, its home, where the windows bring all that can link to it, so each is
   counted once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import partitions, slices, stash, trim
from shelfmark.llm.hashing import mix, shingle_set, word_hashes

#: Words of a shingle; links need 100 * intersection >= SIMILARITY * union.
SHINGLE, SIMILARITY = 5, 80
#: Cells of the counting sketch that tells frequent shingles (one byte each in a task, one bit when sent to executors) and bits of the candidates' filter.
CELLS, FILTER_BITS = 1 << 22, 1 << 24
#: Slices of the sketch and of the filter; groups of tasks whose sketches are summed first, few since sums are four times as long.
SLICES, SHARDS = 64, 32
#: A region with more members or shingles is parted again; so often; with so many pivots.
MAX_MEMBERS, MAX_SHINGLES, DEPTH, PIVOTS = 2000, 4_000_000, 2, 16
#: Buckets of the counts that bound a distance from below, and members of a region that are compared by them in one task.
BUCKETS, MAX_COUNTED = 256, 5000
#: Members that regions go to Python with, about; up to so many members a region's pairs are compared at once, so many at a time.
DEALT_COUNTS, DEALT_SETS, FEW, PAIRS = 2000, 500, 64, 2048
#: Beyond this distance from all pivots a document counts as far.
FAR = 0.6


def set_key(s: np.ndarray) -> int:
    """A 64-bit key of a set of shingles, as a signed long; 0 for the empty set."""
    if not len(s):
        return 0
    x = mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(s))
    return int(mix(np.array([x]))[0].astype(np.int64))


def linked(inter: np.ndarray, a: np.ndarray, b: np.ndarray, similarity: int) -> np.ndarray:
    """Whether sets of sizes a and b with inter common shingles link, in integers."""
    return 100 * inter >= similarity * (a + b - inter)


def _sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    return [shingle_set(w, n) for w in word_hashes(texts)]


def _long(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.int64))


def first_pass(docs: DataFrame, n: int, cells: int) -> DataFrame:
    """doc_id, n, key of each document (part -1), and each task's sketch of shingle counts in slices (parts 0 on)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n", "key", "part", "cells"]
        count, kind = np.zeros(cells, np.uint8), None
        trim()
        for b in slices(batches):
            kind = b.column(0).type
            sets = _sets(b.column(1).to_pylist(), n)
            for s in sets:
                at = (s & np.uint64(cells - 1)).astype(np.int64)
                count[at] = np.minimum(count[at], 254) + 1
            parts = [b.column(0), _long([len(s) for s in sets]), _long([set_key(s) for s in sets]), pa.array([-1] * len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())]
            yield pa.RecordBatch.from_arrays(parts, names)
        if kind is not None and count.any():
            blobs = [x.tobytes() for x in np.split(count, SLICES)]
            zero = _long([0] * SLICES)
            yield pa.RecordBatch.from_arrays([pa.nulls(SLICES, kind), zero, zero, pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())], names)
        trim()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n long, key long, part int, cells binary")


def frequent(sketch: DataFrame, total: int, cells: int) -> bytes:
    """One bit for each cell: whether more shingles fall into it than chance and a few dozen holders explain."""
    mean = total / cells
    least = mean + 4 * mean**0.5 + 16

    def total_of(blobs: pd.Series, kind: type) -> np.ndarray:
        count = np.zeros(cells // SLICES, np.int64)
        for blob in blobs:
            count += np.frombuffer(blob, kind)
        return count

    def some(pdf: pd.DataFrame) -> pd.DataFrame:  # beyond 32 bits a cell is frequent anyway
        count = np.minimum(total_of(pdf["cells"], np.uint8), 2**32 - 1).astype(np.uint32)
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "cells": [count.tobytes()]})

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        count = total_of(pdf["cells"], np.uint32)
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "bits": [np.packbits(count > least, bitorder="little").tobytes()]})

    # Summed in two steps, so that no group holds the sketches of all tasks.
    shard = F.pmod(F.spark_partition_id(), F.lit(SHARDS))
    sums = sketch.groupBy("part", shard.alias("shard")).applyInPandas(some, "part int, cells binary")
    rows = sums.groupBy("part").applyInPandas(add, "part int, bits binary").collect()
    found = {r.part: bytes(r.bits) for r in rows}
    blank = bytes(cells // SLICES // 8)
    return b"".join(found.get(k, blank) for k in range(SLICES))


def _bit(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1


def prefixes(docs: DataFrame, n: int, similarity: int, hot: bytes, cells: int) -> DataFrame:
    """doc_id, key, n, the leading shingles of each document's set (rare ones first, then by hash) and its counts by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(hot, np.uint8)
        for b in slices(batches):
            sets = _sets(b.column(1).to_pylist(), n)
            lead, counts = [], []
            for s in sets:
                counts.append(bucket_counts(s))
                size = len(s) - -(-similarity * len(s) // 100) + 1 if len(s) else 0
                often = _bit(bits, (s & np.uint64(cells - 1)).astype(np.int64)).astype(bool)
                rare = s[~often][:size]
                lead.append((np.concatenate([rare, s[often][: size - len(rare)]]) if len(rare) < size else rare).tobytes())
            parts = [b.column(0), _long([set_key(s) for s in sets]), _long([len(s) for s in sets]), pa.array(lead, pa.binary()), pa.array(counts, pa.binary())]
            yield pa.RecordBatch.from_arrays(parts, ["doc_id", "key", "n", "lead", "counts"])
        trim()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, key long, n long, lead binary, counts binary")


def holders(token: np.ndarray, key: np.ndarray, size: np.ndarray, similarity: int) -> tuple[np.ndarray, np.ndarray]:
    """(region, key): the holders of each shingle with their pivot, itself included.

    Holders are taken by size and parted where the next one is too large to link with any before it; one alone is in no region.
    """
    order = np.lexsort((size, token))
    token, key, size = token[order], key[order], size[order]
    apart = np.ones(len(token), bool)
    apart[1:] = (token[1:] != token[:-1]) | (100 * size[:-1].astype(np.int64) < similarity * size[1:].astype(np.int64))
    start = np.flatnonzero(apart)
    pivot = np.minimum.reduceat(key, start)[np.cumsum(apart) - 1] if len(start) else key  # the smallest key of those that may link
    pairs = np.unique(np.stack([pivot, key], 1)[pivot != key], axis=0)
    own = np.unique(pairs[:, 0])
    return np.append(pairs[:, 0], own), np.append(pairs[:, 1], own)


def members(lead: DataFrame, buckets: int, similarity: int = SIMILARITY) -> DataFrame:
    """(region, key): each class with the pivots of its leading shingles among classes of like sizes, itself included where it is one."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            each = [np.frombuffer(x, np.uint64) for x in pdf["lead"]]
            token = np.concatenate([np.empty(0, np.uint64), *each])
            many = [len(x) for x in each]
            key = np.repeat(pdf["key"].to_numpy(np.int64), many)
            size = np.repeat(pdf["n"].to_numpy(np.int64).astype(np.uint32), many)
            to = (mix(token) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(to, kind="stable")
            token, key, size, to = token[order], key[order], size[order], to[order]
            which, at = np.unique(to, return_index=True)
            cut = [*at.tolist(), len(to)]
            spans = list(zip(cut[:-1], cut[1:], strict=True))
            yield pd.DataFrame({"bucket": which, **{name: [x[i:j].tobytes() for i, j in spans] for name, x in (("tokens", token), ("keys", key), ("sizes", size))}})

    def gather(pdf: pd.DataFrame) -> pd.DataFrame:
        token, key, size = (np.frombuffer(b"".join(pdf[name]), kind) for name, kind in (("tokens", np.uint64), ("keys", np.int64), ("sizes", np.uint32)))
        region, key = holders(token, key, size, similarity)
        return pd.DataFrame({"region": region, "key": key})

    dealt = lead.select("key", "n", "lead").mapInPandas(deal, "bucket long, tokens binary, keys binary, sizes binary")
    return dealt.groupBy("bucket").applyInPandas(gather, "region long, key long").distinct()


def candidate_filter(keys: DataFrame, bits: int) -> bytes:
    """A bit for the hash of each key: a sieve of bounded size before an exact join."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        at = (mix(pdf["key"].to_numpy(np.int64).astype(np.uint64)) % np.uint64(bits // SLICES)).astype(np.int64)
        held = np.zeros(bits // SLICES // 8, np.uint8)
        np.bitwise_or.at(held, at >> 3, (1 << (at & 7)).astype(np.uint8))
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "bits": [held.tobytes()]})

    sliced = keys.withColumn("part", F.pmod("key", F.lit(SLICES)).cast("int"))
    rows = sliced.groupBy("part").applyInPandas(one, "part int, bits binary").collect()
    found = {r.part: bytes(r.bits) for r in rows}
    return b"".join(found.get(k, bytes(bits // SLICES // 8)) for k in range(SLICES))


def candidate_sets(docs: DataFrame, n: int, sieve: bytes, bits: int) -> DataFrame:
    """doc_id, key, shingles of the documents whose key may be a candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(sieve, np.uint8)
        for b in slices(batches):
            sets = _sets(b.column(1).to_pylist(), n)
            key = np.array([set_key(s) for s in sets], np.int64)
            at = (key % SLICES) * (bits // SLICES) + (mix(key.astype(np.uint64)) % np.uint64(bits // SLICES)).astype(np.int64)
            yes = np.flatnonzero(_bit(held, at).astype(bool) & np.array([len(s) > 0 for s in sets], bool))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(yes)), pa.array(key[yes]), pa.array([sets[i].tobytes() for i in yes], pa.binary())], ["doc_id", "key", "shingles"])
        trim()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, key long, shingles binary")


def common(flat: np.ndarray, starts: np.ndarray, probe: np.ndarray) -> np.ndarray:
    """How many shingles of each set, laid end to end in flat, are in the sorted set probe."""
    at = np.searchsorted(probe, flat)
    hit = probe[np.minimum(at, len(probe) - 1)] == flat
    return np.add.reduceat(hit, starts, dtype=np.int64) if len(starts) else np.empty(0, np.int64)


Meet = Callable[[np.ndarray, int], np.ndarray]


def of_sets(sets: list[np.ndarray]) -> Meet:
    """Sizes of the intersections of some sets with one."""

    def meet(some: np.ndarray, one: int) -> np.ndarray:
        starts = np.append(0, np.cumsum([len(sets[i]) for i in some])[:-1])
        return common(np.concatenate([sets[i] for i in some]), starts, sets[one])

    return meet


def of_counts(counts: np.ndarray) -> Meet:
    """Bounds of the intersections from counts by bucket: no two sets share more than the smaller count of each bucket."""
    return lambda some, one: np.minimum(counts[some], counts[one]).sum(1, dtype=np.int64)


def by_region(rows: DataFrame, total: int, most: int, run: Callable[[pd.DataFrame], pd.DataFrame], fields: str) -> DataFrame:
    """run() of the rows of many whole regions at a time, about most of the total rows: most regions have a few members, and a call for each costs more than its work."""
    buckets = max(4 * partitions(rows.sparkSession), -(-total // most))

    def many(pdf: pd.DataFrame) -> pd.DataFrame:
        out = run(pdf)
        if len(pdf) > most:
            trim()
        return out

    return rows.groupBy(F.pmod(F.xxhash64("region"), F.lit(buckets)).alias("bucket")).applyInPandas(many, fields)


def spans_of(pdf: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, np.ndarray]:
    """Rows sorted by region, each key once in it, and the first row and the number of rows of each region."""
    pdf = pdf.drop_duplicates(["region", "key"])
    code = pd.factorize(pdf["region"])[0]
    order = np.argsort(code, kind="stable")
    return pdf.iloc[order], *np.unique(code[order], return_index=True, return_counts=True)[1:]


def least_of(keys: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest key that each one reaches by edges between places left and right."""
    least = keys.copy()
    while True:
        low = np.minimum(least[left], least[right])
        if (low == least[left]).all() and (low == least[right]).all():
            return least
        np.minimum.at(least, left, low)
        np.minimum.at(least, right, low)


def solve_few(keys: np.ndarray, size: np.ndarray, counts: Meet, start: np.ndarray, number: np.ndarray, similarity: int) -> np.ndarray:
    """solve() of many regions of few members each, all of whose pairs are compared at once; a key reaches its own region only."""
    left, right = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for m in np.unique(number[number > 1]):
        i, j = np.triu_indices(m, 1)
        each = start[number == m]
        width = max(1, 16 * PAIRS // len(i))
        for k in range(0, len(each), width):
            a, b = ((each[k : k + width, None] + x).ravel() for x in (i, j))
            like = 100 * np.minimum(size[a], size[b]) >= similarity * np.maximum(size[a], size[b])
            a, b = a[like], b[like]
            for c in range(0, len(a), PAIRS):
                x, y = a[c : c + PAIRS], b[c : c + PAIRS]
                yes = linked(counts(x, y), size[x], size[y], similarity)
                left.append(x[yes])
                right.append(y[yes])
    return least_of(keys, np.concatenate(left), np.concatenate(right))


def solve(keys: np.ndarray, size: np.ndarray, meet: Meet, similarity: int = SIMILARITY) -> np.ndarray:
    """The smallest key of each member's component, by pivots, balls and windows; exact in the metric that meet makes.

    Members are taken by size.  The pivot is the smallest one left, so what links to its ball has at most
    size / t**2, and d(y, pivot) <= 2 r.
    """
    order = np.lexsort((keys, size))
    root = np.arange(len(keys))  # by rank in that order

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    def union(i: int, j: int) -> None:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)

    t = similarity / 100
    ranked = size[order]
    alive = np.arange(len(keys))
    while len(alive):
        p = alive[0]
        near = alive[: np.searchsorted(ranked[alive], ranked[p] / t**2 + 1, side="right")]
        inter = meet(order[near], order[p])
        ball = linked(inter, ranked[near], ranked[p], similarity)
        ball[0] = True
        inside = near[ball]
        for i in inside[1:]:
            union(p, i)
        distance = 1 - inter / (ranked[near] + ranked[p] - inter)
        for y in near[~ball & (distance <= 2 * (1 - t) + 1e-9)]:
            if find(y) != find(p) and linked(meet(order[inside], order[y]), ranked[inside], ranked[y], similarity).any():
                union(p, y)
        alive = np.setdiff1d(alive, inside, assume_unique=True)
    roots = order[np.array([find(i) for i in range(len(keys))], np.int64)]  # of each rank, as a member
    least = keys.copy()
    np.minimum.at(least, roots, keys[order])
    out = np.empty_like(keys)
    out[order] = least[roots]
    return out


def bucket_counts(s: np.ndarray) -> bytes:
    """How many shingles of a set fall into each of BUCKETS: a contraction of the metric, at an eighth of the set's size and less."""
    return np.bincount((s >> np.uint64(40)).astype(np.int64) % BUCKETS, minlength=BUCKETS).astype(np.uint16 if len(s) < 65536 else np.uint32).tobytes()


def _read_counts(raw: list[bytes]) -> tuple[np.ndarray, Meet]:
    """Sizes and bounds from counts by bucket."""
    short = all(len(x) == 2 * BUCKETS for x in raw)
    counts = np.frombuffer(b"".join(raw), np.uint16).reshape(-1, BUCKETS) if short else np.stack([np.frombuffer(x, np.uint16 if len(x) == 2 * BUCKETS else np.uint32).astype(np.int32) for x in raw])
    return counts.sum(1, dtype=np.int64), of_counts(counts)


def fine_codes(s: np.ndarray) -> bytes:
    """A set's shingles as sorted numbers of 16 bits, repeated ones kept: a quarter of its size."""
    return np.sort((s >> np.uint64(16)).astype(np.uint16)).tobytes()


def _read_codes(raw: list[bytes]) -> tuple[np.ndarray, Meet]:
    """Sizes and bounds from fine codes: the k-th of equal numbers meets the k-th, so multisets meet as sets do."""
    sets = []
    for x in raw:
        code = np.frombuffer(x, np.uint16).astype(np.uint64)
        start = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
        nth = np.arange(len(code)) - np.repeat(start, np.diff(np.append(start, len(code))))
        sets.append(code << np.uint64(32) | nth.astype(np.uint64))
    return np.array([len(x) for x in sets], np.int64), of_sets(sets)


def refine(rows: DataFrame, total: int, similarity: int, read: Callable[[list[bytes]], tuple[np.ndarray, Meet]], few: int = 0) -> DataFrame:
    """Parts regions (region, key, bounds), total rows, into what may be linked by a lower bound of the distance; (region, key).

    Both bounds are metrics too, so the same pivots, balls and windows work, on far smaller rows;
    only members of a part of two or more go on.  Regions of at most few members are done together, which bounds
    by counts allow: the meet of two arrays is that of their pairs.
    """
    rows = rows.withColumn("region", F.col("region").cast("string"))
    sizes = rows.groupBy("region").agg(F.count(F.lit(1)).alias("m"))
    large = stash(sizes.where(F.col("m") > MAX_COUNTED).withColumn("w", F.lit(0.0)), "large")
    if large.take(1):
        tagged = rows.join(large, "region", "left")
        blocks = _blocks(tagged.where("m is not null").withColumnRenamed("bounds", "shingles"), MAX_COUNTED)
        rows = tagged.where("m is null").drop("m", "w").unionByName(blocks.withColumnRenamed("shingles", "bounds"))

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, start, number = spans_of(pdf)
        keys, bounds = pdf["key"].to_numpy(np.int64), pdf["bounds"].tolist()
        root = keys.copy()
        held = np.flatnonzero(np.repeat(number <= few, number))
        if len(held):
            size, meet = read([bounds[i] for i in held])
            many = number[number <= few]
            root[held] = solve_few(keys[held], size, meet, np.cumsum(many) - many, many, similarity)
        for i, m in zip(start, number, strict=True):
            if m > max(1, few):
                root[i : i + m] = solve(keys[i : i + m], *read(bounds[i : i + m]), similarity)
        some = np.isin(root, root[root != keys])
        return pd.DataFrame({"region": root[some], "key": keys[some]})

    return stash(by_region(rows, total, DEALT_COUNTS, part, "region long, key long").distinct(), "refined")


def part_regions(rows: DataFrame, similarity: int, depth: int = DEPTH, pivots: int = PIVOTS) -> DataFrame:
    """Parts regions (region string, key, shingles) that are too large by pivots of their own, then by blocks."""
    r = 1 - similarity / 100
    small: list[DataFrame] = []
    for level in range(depth + 1):
        weight = rows.groupBy("region").agg(F.count(F.lit(1)).alias("m"), F.sum(F.length("shingles") / 8).alias("w"))
        large = stash(weight.where((F.col("m") > MAX_MEMBERS) | (F.col("w") > MAX_SHINGLES)), "large")
        if not large.take(1):
            small.append(rows)
            break
        tagged = rows.join(large.select("region", "m", "w"), "region", "left")
        small.append(tagged.where("m is null").drop("m", "w"))
        tagged = tagged.where("m is not null")
        if level == depth:
            small.append(_blocks(tagged, MAX_MEMBERS))
            break
        salt = F.pmod(F.xxhash64("key", F.lit(level)), F.lit(pivots))
        chosen = tagged.groupBy("region", salt.alias("salt")).agg(F.min(F.struct(F.xxhash64("key", F.lit(-level - 1)), "shingles")).alias("x"))
        chosen = chosen.groupBy("region").agg(F.collect_list("x.shingles").alias("pivots"))
        cells = _voronoi(r)
        parted = tagged.drop("m", "w").join(chosen, "region").select("key", "shingles", "region", F.explode(cells("shingles", "pivots")).alias("cell"))
        rows = stash(parted.select(F.concat_ws("/", "region", "cell").alias("region"), "key", "shingles"), "cells")
    out = small[0]
    for x in small[1:]:
        out = out.unionByName(x)
    return out


def _voronoi(r: float):
    @F.pandas_udf("array<int>")
    def cells(shingles: pd.Series, pivots: pd.Series) -> pd.Series:
        out = []
        for s, ps in zip(shingles, pivots, strict=True):
            a = np.frombuffer(s, np.uint64)
            d = []
            for p in ps:
                b = np.frombuffer(p, np.uint64)
                inter = len(np.intersect1d(a, b, assume_unique=True))
                d.append(1 - inter / (len(a) + len(b) - inter))
            least = min(d)
            mine = [j for j, x in enumerate(d) if least < FAR and x <= least + 2 * r + 1e-9]
            out.append([*mine, -1] if least >= FAR - r - 1e-9 else mine)
        return pd.Series(out, dtype=object)

    return cells


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Every pair of blocks of a region as a region of its own, with most members at most, about."""
    n = F.greatest(F.lit(1), F.ceil(F.col("m") / (most / 2)), F.ceil(F.col("w") / (MAX_SHINGLES / 2))).cast("int")
    mine = F.pmod(F.xxhash64("key", F.lit("block")), n).cast("int")
    each = F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.concat_ws("+", F.least(j, mine), F.greatest(j, mine)))
    return rows.select("region", "key", "shingles", F.explode(each).alias("pair")).select(F.concat_ws("#", "region", "pair").alias("region"), "key", "shingles")


def link_sums(sets: list[np.ndarray], weight: np.ndarray, home: np.ndarray, side: np.ndarray, similarity: int) -> np.ndarray:
    """For each member that is at home the weight of the others that it links with; of other sides only, where it has one.

    Shingles that the same members hold are one column with a number, so a family of near copies has few columns.
    """
    m = len(sets)
    size = np.array([len(x) for x in sets], np.int64)
    token = np.concatenate(sets)
    member = np.repeat(np.arange(m), size)
    order = np.argsort(token, kind="stable")
    token, member = token[order], member[order]
    start = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    mark = mix(np.arange(1, m + 1, dtype=np.uint64))
    _, first, times = np.unique(np.add.reduceat(mark[member], start), return_index=True, return_counts=True)
    end = np.append(start[1:], len(token))
    shared = end[first] - start[first] > 1
    first, times = first[shared], times[shared]
    inter = np.zeros((m, m), np.float32)
    width = max(1, 1_000_000 // m)
    for k in range(0, len(first), width):
        some = first[k : k + width]
        held = np.zeros((m, len(some)), np.float32)
        length = end[some] - start[some]
        column = np.repeat(np.arange(len(some)), length)
        held[member[np.arange(length.sum()) + np.repeat(start[some] - np.append(0, np.cumsum(length)[:-1]), length)], column] = 1
        inter += (held * times[k : k + width].astype(np.float32)) @ held.T
    out = np.zeros(m, np.int64)
    for k in range(0, m, 256):  # some rows at a time: in 64-bit integers the whole takes twice the memory of inter for each step
        mine = np.arange(k, min(k + 256, m))
        both = linked(np.rint(inter[mine]).astype(np.int64), size[mine, None], size[None, :], similarity)
        both[np.arange(len(mine)), mine] = False
        both &= (side[mine, None] != side[None, :]) | (side[mine, None] < 0)
        out[mine] = both @ weight
    return np.where(home, out, 0)


def _homes(r: float):
    """The cells of a set: its home and where it visits, for counts of links."""

    @F.pandas_udf("array<struct<cell:int,home:boolean>>")
    def cells(shingles: pd.Series, pivots: pd.Series) -> pd.Series:
        out = []
        for s, ps in zip(shingles, pivots, strict=True):
            a = np.frombuffer(s, np.uint64)
            d = []
            for p in ps:
                b = np.frombuffer(p, np.uint64)
                inter = len(np.intersect1d(a, b, assume_unique=True))
                d.append(1 - inter / (len(a) + len(b) - inter))
            least = min(d)
            mine = -1 if least >= FAR else d.index(least)
            near = [j for j, x in enumerate(d) if x <= least + 2 * r + 1e-9 and x < FAR + r + 1e-9]
            out.append([{"cell": j, "home": j == mine} for j in ([*near, -1] if least >= FAR - r - 1e-9 else near)])
        return pd.Series(out, dtype=object)

    return cells


def count_links(rows: DataFrame, total: int, similarity: int, depth: int = DEPTH, pivots: int = PIVOTS) -> DataFrame:
    """key, n: the documents of other classes that each class links with.  rows: region string, key, copies, shingles; total of them."""
    small: list[DataFrame] = []
    rows = rows.select("region", "key", "copies", F.lit(True).alias("home"), F.lit(-1).alias("side"), "shingles")
    for level in range(depth + 1):
        weight = rows.groupBy("region").agg(F.count(F.lit(1)).alias("m"), F.sum(F.length("shingles") / 8).alias("w"))
        large = stash(weight.where((F.col("m") > MAX_MEMBERS) | (F.col("w") > MAX_SHINGLES)), "large")
        if not large.take(1):
            small.append(rows)
            break
        tagged = rows.join(large, "region", "left")
        small.append(tagged.where("m is null").drop("m", "w"))
        tagged = tagged.where("m is not null")
        dense = None
        if level < depth:
            salt = F.pmod(F.xxhash64("key", F.lit(level)), F.lit(pivots))
            chosen = tagged.groupBy("region", salt.alias("salt")).agg(F.min(F.struct(F.xxhash64("key", F.lit(-level - 1)), "shingles")).alias("x"))
            chosen = chosen.groupBy("region").agg(F.collect_list("x.shingles").alias("pivots"))
            cells = _homes(1 - similarity / 100)
            parted = stash(tagged.join(chosen, "region").withColumn("cells", cells("shingles", "pivots")).drop("pivots"), "cells")
            # Members that are all near each other are in every cell: pivots don't part them, blocks do.
            dense = parted.groupBy("region").agg((F.sum(F.size("cells")) > 4 * F.count(F.lit(1))).alias("dense"))
            parted = parted.join(dense, "region")
            apart = parted.where("not dense").select("region", "key", "copies", "home", "side", "shingles", F.explode("cells").alias("c"))
            rows = apart.select(F.concat_ws("/", "region", "c.cell").alias("region"), "key", "copies", (F.col("home") & F.col("c.home")).alias("home"), "side", "shingles")
            rows = stash(rows, "cells")
            tagged = parted.where("dense").drop("cells", "dense")
        n = F.greatest(F.lit(1), F.ceil(F.col("m") / (MAX_MEMBERS / 2)), F.ceil(F.col("w") / (MAX_SHINGLES / 2))).cast("int")
        mine = F.pmod(F.xxhash64("key", F.lit("block")), n).cast("int")
        pair = lambda j: F.struct(F.concat_ws("+", F.least(j, mine), F.greatest(j, mine)).alias("pair"), F.when(j == mine, -1).otherwise(mine).alias("side"))
        blocks = tagged.withColumn("x", F.explode(F.transform(F.sequence(F.lit(0), n - 1), pair)))
        small.append(blocks.select(F.concat_ws("#", "region", "x.pair").alias("region"), "key", "copies", "home", "x.side", "shingles"))
        if level == depth:
            break
    every = small[0]
    for x in small[1:]:
        every = every.unionByName(x)

    def counted(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, n = pdf["key"].to_numpy(np.int64), np.zeros(len(pdf), np.int64)
        code = pd.factorize(pdf["region"])[0]
        order = np.argsort(code, kind="stable")
        raw, columns = pdf["shingles"].tolist(), [pdf["copies"].to_numpy(np.int64), pdf["home"].to_numpy(bool), pdf["side"].to_numpy(np.int64)]
        for mine in np.split(order, np.cumsum(np.bincount(code))[:-1]):
            if len(mine) > 1:
                n[mine] = link_sums([np.frombuffer(raw[i], np.uint64) for i in mine], *[x[mine] for x in columns], similarity)
        return pd.DataFrame({"key": keys, "n": n})[n > 0]

    return by_region(every, total, DEALT_SETS, counted, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


def components(edges: DataFrame) -> DataFrame:
    """(key, label): the smallest key reachable, for every key of edges (key, root)."""
    both = edges.where("key <> root").select("key", "root")
    both = stash(both.unionByName(both.select(F.col("root").alias("key"), F.col("key").alias("root"))).distinct(), "edges")
    labels = stash(both.groupBy("key").agg(F.min("root").alias("label")).select("key", F.least("key", "label").alias("label")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("key", "root"), "root").groupBy("key").agg(F.min("label").alias("heard"))
        told = labels.join(heard, "key").select("key", F.least("label", "heard").alias("label"), F.col("label").alias("was"))
        up = told.select(F.col("key").alias("label"), F.col("label").alias("up"))
        jumped = told.join(up, "label", "left").select("key", F.least("label", F.coalesce("up", "label")).alias("label"), "was")
        jumped = stash(jumped, "labels")
        labels = jumped.select("key", "label")
        if not jumped.where("label <> was").take(1):
            return labels


def join_ngrams(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE, similarity: int = SIMILARITY, cells: int = CELLS) -> tuple[DataFrame, DataFrame]:
    """Joins near documents: (documents, links).

    documents: doc_id, n_shingles, component_id (smallest id reachable by links, itself included), class_id
    (smallest id of the same set of shingles), class_key, n_links (rows with an id, other than itself, that it links with),
    for every row.  links: (key, root), classes of one component, enough to connect it.  A text without words
    has no shingles, no links and its own id as component and class; fewer words than n are one shingle.  Null ids
    are no smallest id and nobody's link; repeated rows are copies of each other; other columns are not read.
    Texts are read three times and never move.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    first = stash(first_pass(base, n, cells), "sets")
    rows = first.where("part = -1").select("doc_id", "n", "key")
    total = first.where("part = -1").agg(F.sum("n")).first()[0] or 0
    hot = frequent(first.where("part >= 0").select("part", "cells"), total, cells)
    classes = stash(rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("doc_id").alias("copies")), "classes")
    named = classes.where("rep is not null").select("key", F.col("rep").alias("doc_id"))
    lead = prefixes(base, n, similarity, hot, cells).join(named, ["doc_id", "key"], "left_semi")
    lead = stash(lead.select("key", "n", "lead", "counts"), "leading")
    region = stash(members(lead, max(64, 4 * partitions(spark)), similarity), "members")
    region = refine(region.join(lead.select("key", F.col("counts").alias("bounds")), "key"), region.count(), similarity, _read_counts, FEW)
    candidates = stash(region.select("key").distinct().join(named, "key"), "candidates")
    sieve = candidate_filter(candidates.select("key"), FILTER_BITS)
    sets = candidate_sets(base, n, sieve, FILTER_BITS).join(candidates, ["doc_id", "key"], "left_semi").dropDuplicates(["key"])
    sets = stash(sets.select("key", "shingles"), "shingles")

    @F.pandas_udf("binary")
    def codes(shingles: pd.Series) -> pd.Series:
        return shingles.map(lambda x: fine_codes(np.frombuffer(x, np.uint64)))

    region = refine(region.join(sets.select("key", codes("shingles").alias("bounds")), "key"), region.count(), similarity, _read_codes)
    held = region.join(sets, "key").select(F.col("region").cast("string").alias("region"), "key", "shingles")
    held = part_regions(held, similarity)

    def solved(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, start, number = spans_of(pdf)
        keys, sets = pdf["key"].to_numpy(np.int64), [np.frombuffer(x, np.uint64) for x in pdf["shingles"]]
        root = keys.copy()
        for i, m in zip(start, number, strict=True):
            if m > 1:
                some = sets[i : i + m]
                root[i : i + m] = solve(keys[i : i + m], np.array([len(x) for x in some]), of_sets(some), similarity)
        return pd.DataFrame({"key": keys, "root": root})[root != keys]

    links = stash(by_region(held, region.count(), DEALT_SETS, solved, "key long, root long").distinct(), "links")
    labels = components(links)
    labels = stash(labels, "labelled")
    labelled = classes.join(labels, "key").select("key", "label", "rep", "copies")
    least = labelled.groupBy("label").agg(F.min("rep").alias("component"))
    members_of = labelled.join(sets, "key").select(F.col("label").cast("string").alias("region"), "key", "copies", "shingles")
    linked_to = stash(count_links(members_of, labels.count(), similarity), "counted")
    of_class = classes.join(labelled.select("key", "label").join(least, "label").select("key", "component"), "key", "left").join(linked_to, "key", "left")
    of_class = stash(of_class.select("key", F.coalesce("component", "rep").alias("component_id"), F.col("rep").alias("class_id"), (F.col("copies") + F.coalesce("n", F.lit(0))).alias("near")), "components")
    n_links = F.col("near") - F.when(F.col("doc_id").isNotNull(), 1).otherwise(0)
    some = rows.where("n > 0").join(of_class, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "class_id", F.col("key").alias("class_key"), n_links.alias("n_links"))
    own = F.col("doc_id")
    none = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), own.alias("class_id"), F.col("key").alias("class_key"), F.lit(0).cast("long").alias("n_links"))
    return some.unionByName(none), links


def distinct_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options: int) -> DataFrame:
    """The rows of docs that stay when one document of each component does: that of its smallest id.

    Rows with a null id, and texts without words, stay.  Of rows that repeat an id that stays, one stays.
    """
    found, _ = join_ngrams(docs, id_col, text_col, **options)
    kept = stash(found.where("doc_id = component_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")), "kept")
    ids = kept.select(F.col("doc_id").alias(id_col), "n").hint("shuffle_hash")
    out = docs.where(F.col(id_col).isNull())
    if kept.where("n > 1").take(1):
        out = out.unionByName(docs.join(ids.where("n > 1"), id_col, "left_semi").dropDuplicates([id_col]))
        ids = ids.where("n = 1")
    return out.unionByName(docs.join(ids, id_col, "left_semi"))
