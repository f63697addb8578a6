"""Best-fit packing by a configuration linear program over the length histogram.

Texts become token pieces of at most ``capacity`` tokens.  Only the histogram of piece lengths, at
most ``capacity`` numbers, reaches the driver.  There the covering program over configurations (multisets
of lengths that fit one sequence) is solved by multiplicative weights: each round prices every
length, one knapsack dynamic program prices all rooms, and from it come the best configurations with
each of the lengths that are covered least; the prices of what they cover fall.  The solution is
rounded up as far as there are pieces, the program of what is left is solved again, and so on; the
last few pieces go by best fit decreasing.  The plan says which ranks of each length go to which
sequences, so the pieces find their places by their rank in a distributed numbering.
"""

from __future__ import annotations

import binascii
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import lasting, stash, trim
from shelfmark.llm.hashing import CHUNK, hash_spans

CAPACITY = 4096
END_ID = 1
#: Rounds of multiplicative weights of one program, configurations of a round, and programs at most.
ROUNDS, WIDE, PROGRAMS = 30, 160, 10
#: What an uncovered length is worth beyond its tokens, and the share of its scarcest length that a configuration is used for at a time.
BONUS, STEP = 0.02, 0.125
#: Slots of the table of words whose ids a Python worker remembers (about 60 MB); it is emptied when half full.
SLOTS = 1 << 21
#: Pieces of one length that are numbered in one group.
GROUP_ROWS = 250_000

# What bytes are to the splitting of words: white space, letters, digits, other ASCII, all others.
_SPACE, _LETTER, _DIGIT, _OTHER, _WIDE = range(5)
_KIND = np.full(256, _WIDE, np.uint8)
_KIND[:128] = [
    _SPACE if chr(c) in " \t\n\x0b\x0c\r" else _LETTER if chr(c).isalpha() else _DIGIT if chr(c).isdigit() else _OTHER for c in range(128)
]
_LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


@lasting(2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the parts of a buffer that are encoded each on its own.

    The vocabulary knows runs of letters, single digits, runs of other signs and the endings after an
    apostrophe.  A word of ASCII is cut between letters, digits and signs, but not after a lone
    apostrophe; a word with any other character, which may combine with its neighbours, stays whole.
    """
    kind = _KIND.take(buf)
    left, right = np.append(np.uint8(_SPACE), kind), np.append(kind, np.uint8(_SPACE))  # on both sides of each gap
    cut = (left != right) | ((left == _DIGIT) & (right == _DIGIT))
    quote = np.zeros(len(cut), bool)
    quote[1:-1] = (buf[:-1] == 0x27) & (right[1:-1] == _LETTER)
    quote[2:] &= kind[:-1] != _OTHER  # a lone one: what is before it is no sign
    cut &= ~quote
    if (kind == _WIDE).any():
        edge = (left == _SPACE) != (right == _SPACE)
        word = np.cumsum(edge)
        wide = np.zeros(word[-1] + 1, bool)
        wide[word[:-1][kind == _WIDE]] = True
        cut = np.where(wide[word], edge, cut)
    at = np.flatnonzero(cut)
    keep = right[at] != _SPACE
    return at[keep], np.append(at[1:], len(buf))[keep]


class Encoder:
    """Token ids of whole texts.

    With ``by_word`` the vocabulary never joins across white space nor across letters, digits and
    signs, so a text's ids are those of its parts in a row and each distinct part is encoded once, known
    by a 64-bit hash of its lower-cased bytes.  A text with a special token's opening is encoded
    whole, as are all texts without ``by_word``.
    """

    def __init__(self, path: str, by_word: bool):
        self.path, self.by_word = path, by_word
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.slot = np.zeros(SLOTS, np.int32)
        self.held = 0
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.flat, self.used = np.zeros(1 << 18, "<u4"), 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """Where the table has each hash, or the free slot where it belongs."""
        at = (h & np.uint64(SLOTS - 1)).astype(np.int64)
        lost = np.flatnonzero((self.keys[at] != h) & (self.keys[at] != 0))
        while len(lost):
            at[lost] = (at[lost] + 1) & (SLOTS - 1)
            found = self.keys[at[lost]]
            lost = lost[(found != h[lost]) & (found != 0)]
        return at

    def _add(self, hashes: np.ndarray, parts: list[bytes]) -> None:
        texts = [p.decode("utf-8", "surrogatepass") for p in parts]
        for k in range(0, len(texts), 2000):  # the tokenizer's results take a kilobyte each
            for h, e in zip(hashes[k : k + 2000], _tokenizer(self.path).encode_batch_fast(texts[k : k + 2000], add_special_tokens=False), strict=True):
                at = int(h) & (SLOTS - 1)
                while self.keys[at]:
                    at = (at + 1) & (SLOTS - 1)
                n, ids = self.held, e.ids
                if n == len(self.start):
                    self.start, self.size = np.append(self.start, np.zeros_like(self.start)), np.append(self.size, np.zeros_like(self.size))
                while self.used + len(ids) > len(self.flat):
                    self.flat = np.append(self.flat, np.zeros_like(self.flat))
                self.keys[at], self.slot[at] = h, n
                self.start[n], self.size[n] = self.used, len(ids)
                self.flat[self.used : self.used + len(ids)] = ids
                self.used, self.held = self.used + len(ids), n + 1

    def _buffer(self, raw: bytes, ends: np.ndarray) -> list[np.ndarray]:
        """The ids of the texts that end at ends in a buffer of them, each followed by white space."""
        raw = raw.translate(_LOWER)
        buf = np.frombuffer(raw, np.uint8)
        first, last = spans(buf)
        h = hash_spans(buf, first, last) | np.uint64(1)
        at = self._find(h)
        new = np.flatnonzero(self.keys[at] == 0)
        if len(new):
            fresh, where = np.unique(h[new], return_index=True)
            if self.held + len(fresh) > SLOTS // 2:
                self._clear()
                fresh, where = np.unique(h, return_index=True)
                new = np.arange(len(h))
            self._add(fresh, [raw[first[i] : last[i]] for i in new[where]])
            at = self._find(h)
        which = self.slot[at]
        size = self.size[which]
        total = np.append(0, np.cumsum(size))
        ids = self.flat[np.arange(total[-1]) + np.repeat(self.start[which] - total[:-1], size)]
        cut = total[np.searchsorted(first, ends)]
        return np.split(ids, cut[:-1]) if len(cut) else []

    def __call__(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        held: list[bytes] = []
        size = 0

        def flush() -> Iterator[np.ndarray]:
            if held:
                yield from self._buffer(b" ".join(held) + b" ", np.cumsum([len(x) + 1 for x in held]))
                held.clear()

        for text in texts:
            if not self.by_word or "<|" in text:
                yield from flush()
                yield np.array(_tokenizer(self.path).encode(text, add_special_tokens=False).ids, "<u4")
                size = 0
                continue
            raw = text.encode("utf-8", "surrogatepass")
            if len(raw) > CHUNK:
                yield from flush()
                yield np.concatenate([self._buffer(p, np.array([len(p)]))[0] for p in _pieces(raw)])
                size = 0
                continue
            held.append(raw)
            size += len(raw) + 1
            if size >= CHUNK:
                yield from flush()
                size = 0
        yield from flush()


def _pieces(raw: bytes) -> Iterator[bytes]:
    """Cuts a long text at white space of one byte; each piece ends with some."""
    at = 0
    while at < len(raw):
        end = at + CHUNK
        while end < len(raw) and _KIND[raw[end]] != _SPACE:
            end += 1
        yield raw[at:end] + b" "
        at = end


@lasting(2)
def _encoder(path: str, by_word: bool) -> Encoder:
    """The encoder of this Python worker, which outlives a task but not the work of another operator."""
    return Encoder(path, by_word)


def tokenize(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    by_word: bool = True,
    keep_ids: bool = False,
) -> DataFrame:
    """Cuts each text's ids, then END_ID, into pieces: doc_id, piece, start, length, ids_crc32 and, if asked,
    ids (little-endian unsigned 32-bit).

    A null or blank text is the end id alone.  Only texts longer than the capacity are cut, each
    piece but the last full.  Null ids and repeated rows stay as they are; other columns are not read.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim(_encoder, _tokenizer)
        encode = _encoder(tokenizer_path, by_word)
        for b in batches:
            for k in range(0, b.num_rows, 1000):
                some = b.slice(k, 1000)
                rows = [(i, *p) for i, ids in enumerate(encode([t or "" for t in some.column(1).to_pylist()])) for p in pieces_of(ids, capacity, keep_ids)]
                of, *columns = zip(*rows, strict=True)
                types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(of)), *arrays], names)
        trim(_encoder, _tokenizer)

    kind = docs.schema[id_col].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, fields)


def pieces_of(ids: np.ndarray, capacity: int, keep_ids: bool) -> Iterator[tuple]:
    """piece, start, length, crc32 and, if asked, ids of one text's ids and the end id."""
    raw = ids.tobytes() + END_ID.to_bytes(4, "little")
    for k, at in enumerate(range(0, len(raw), 4 * capacity)):
        part = raw[at : at + 4 * capacity]
        one = (k, at // 4, len(part) // 4, binascii.crc32(part))
        yield (*one, part) if keep_ids else one


def best_rooms(prices: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room the most that lengths in it are worth, and the last of them, 0 for an unused token: an unbounded knapsack."""
    value = prices[lengths]
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for c in range(int(lengths[0]), capacity + 1):
        n = upto[c]
        gain = best[c - lengths[:n]] + value[:n]
        k = int(gain.argmax())
        best[c], pick[c] = (gain[k], lengths[k]) if gain[k] > best[c - 1] else (best[c - 1], 0)
    return best, pick


def configuration(first: int, pick: np.ndarray, capacity: int) -> Counter:
    """The best lengths beside a first one."""
    found: Counter = Counter({first: 1} if first else {})
    c = capacity - first
    while c > 0:
        found[int(pick[c])] += 1
        c -= int(pick[c]) or 1
    del found[0]
    return found


def program(counts: Counter, capacity: int, rounds: int, wide: int) -> Counter:
    """A fractional cover of the counts by configurations: how often each is used.

    Multiplicative weights: a round's dynamic program gives the best configuration with each of the
    wide lengths that are covered least, each used as often as its scarcest length allows, and the
    weight of a length falls with its cover.
    """
    lengths = np.array(sorted(counts))
    demand = np.zeros(capacity + 1)
    demand[lengths] = [counts[int(k)] for k in lengths]
    cover = np.zeros(capacity + 1)
    used: Counter = Counter()
    volume, done = float((demand * np.arange(capacity + 1)).sum()), 0.0
    for _ in range(rounds):
        if done >= volume:
            break
        # A length is worth its tokens, and more while it is covered little.
        ratio = cover[lengths] / demand[lengths]
        prices = np.zeros(capacity + 1)
        prices[lengths] = lengths * (1 + BONUS * np.exp(-4 * ratio))
        _, pick = best_rooms(prices, lengths, capacity)
        for first in lengths[np.argsort(ratio - lengths / capacity / 10, kind="stable")][:wide]:
            if cover[first] >= demand[first]:
                continue
            items = configuration(int(first), pick, capacity)
            x = min(demand[k] / n for k, n in items.items()) * STEP
            used[tuple(sorted(items.elements(), reverse=True))] += x
            done += x * sum(k * n for k, n in items.items())
            for k, n in items.items():
                cover[k] += n * x
    return used


def best_fit_decreasing(counts: Counter, capacity: int) -> Counter:
    """Packs a histogram: longest first, each into the fullest sequence that it fits.  Returns configurations with their numbers.

    Sequences that hold the same lengths are counted together, so the work follows the number of
    different contents and not of pieces.
    """
    by_room: list[Counter] = [Counter() for _ in range(capacity + 1)]
    for length in sorted(counts, reverse=True):
        left = counts[length]
        room = length
        while left and room < capacity:
            if by_room[room]:
                content, number = by_room[room].popitem()
                used = min(number, left)
                if number > used:
                    by_room[room][content] = number - used
                by_room[room - length][(*content, length)] += used
                left -= used
                room = max(length, room - length)
            else:
                room += 1
        each = capacity // length
        if left >= each:
            by_room[capacity - each * length][(length,) * each] += left // each
        if left % each:
            by_room[capacity - (left % each) * length][(length,) * (left % each)] += 1
    total: Counter = Counter()
    for held in by_room:
        total.update(held)
    return total


def plan(counts: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS, wide: int = WIDE) -> tuple[Counter, int]:
    """Configurations, as descending tuples of lengths, with how many sequences each gets, and how many pieces the program placed.

    Every piece has a place.  Programs are solved and rounded until one places little of what is left.
    """
    full = counts.get(capacity, 0)
    left = Counter({k: v for k, v in counts.items() if k != capacity and v})
    chosen: Counter = Counter()
    placed = 0
    for _ in range(PROGRAMS):
        if not left:
            break
        volume, before = sum(k * n for k, n in left.items()), left.total()
        used = program(left, capacity, rounds, wide)
        scale = volume / sum(sum(c) * x for c, x in used.items())  # a cover of each piece once, by volume
        # Full sequences first, longer pieces first; rounded up as far as there are pieces.
        for config, x in sorted(used.items(), key=lambda c: (-sum(c[0]), -c[1], c[0])):
            if sum(config) < capacity and volume > 4 * capacity:
                continue
            items = Counter(config)
            number = min(-int(-x * scale // 1), *(left[k] // n for k, n in items.items()))
            if number:
                chosen[config] += number
                left.subtract({k: n * number for k, n in items.items()})
        left = +left
        placed += before - left.total()
        if before - left.total() < before / 20:
            break
    chosen.update(best_fit_decreasing(left, capacity))
    if full:
        chosen[(capacity,)] += full
    return chosen, placed + full


def slots(configs: Counter) -> pd.DataFrame:
    """For each length the ranges of ranks and where they go: rank r of [rank, rank + n) to sequence base + r - rank, at offset."""
    rows, base, rank = [], 0, Counter()
    for config, number in sorted(configs.items()):
        at = 0
        for length in config:
            rows.append((length, rank[length], base, at))
            rank[length] += number
            at += length
        base += number
    return pd.DataFrame(rows, columns=["length", "rank", "base", "offset"]).sort_values(["length", "rank"], ignore_index=True)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, length and any other columns).

    The pieces should be a written table, as from stash(tokenize(...)).  Each length's pieces are
    numbered in salted groups of about GROUP_ROWS rows whose sizes are summed first, so no length,
    however common, meets in one task.
    """
    n_rows = pieces.count()
    salts = max(64, -(-n_rows // GROUP_ROWS))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    sizes = salted.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {int(r.length): int(r.n) for r in sizes.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    table = slots(plan(histogram, capacity)[0])
    by_length = {int(k): g[["rank", "base", "offset"]].to_numpy() for k, g in table.groupby("length")}
    before = sizes.withColumn("_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)))
    before = before.select("length", "_salt", F.coalesce("_before", F.lit(0)).alias("_before"))
    within = Window.partitionBy("length", "_salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("_rank", F.row_number().over(within) - 1).join(before, ["length", "_salt"])
    ranked = ranked.withColumn("_rank", F.col("_rank") + F.col("_before"))

    @F.pandas_udf("struct<sequence_id:long,offset:long>")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        out = np.zeros((len(length), 2), np.int64)
        lengths, ranks = length.to_numpy(), rank.to_numpy()
        for k in np.unique(lengths):
            mine = lengths == k
            ranges = by_length[int(k)]
            at = np.searchsorted(ranges[:, 0], ranks[mine], side="right") - 1
            out[mine, 0] = ranges[at, 1] + ranks[mine] - ranges[at, 0]
            out[mine, 1] = ranges[at, 2]
        return pd.DataFrame(out, columns=["sequence_id", "offset"])

    placed = ranked.withColumn("_place", place("length", "_rank"))
    return placed.select(*pieces.columns, F.col("_place.sequence_id").alias("sequence_id"), F.col("_place.offset").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, keep_ids: bool = False, **names: str) -> DataFrame:
    """Tokenizes and packs; see tokenize() and pack().  An empty table gives no rows."""
    return pack(stash(tokenize(docs, tokenizer_path, capacity=capacity, keep_ids=keep_ids, **names), "pieces"), capacity)
