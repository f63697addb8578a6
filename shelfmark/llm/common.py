"""What the operators of this subpackage share: the shared scratch folder, words and let-bindings in column form."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.scratch import scratch_dir, stash  # noqa: F401  the operators take them from here

#: White space that separates words, as a class for Java, Python and DuckDB regular expressions.
SPACE = r"\x20\x09-\x0D"
#: The same characters, for translate().
SPACES = "\t\n\x0b\x0c\r "


#: Bytes of terms, other bytes as spaces: letters and all that is not ASCII, and the same with digits.
LETTERS = bytes(b if chr(b).isalpha() and b < 128 or b >= 128 else 32 for b in range(256))
ALNUM = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))


def byte_tokens(text: bytes, table: bytes, piece: int = 1 << 20) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in pieces: runs of the bytes that a table keeps, A-Z in lower case.  No term is cut."""
    text = bytes(text).lower().translate(table)  # lower() of bytes is that of ASCII
    start = 0
    while start < len(text):
        end = text.find(b" ", start + piece) if start + piece < len(text) else -1
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def unused(df: DataFrame, name: str) -> str:
    """A column name like name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def set_aside(docs: DataFrame, *read: str) -> tuple[DataFrame, list[Column]]:
    """The columns that an operator reads, and all others in one struct, so that none clashes with a column that it adds; and the columns of docs to select again from its result."""
    rest = [c for c in docs.columns if c not in read]
    held = F.struct(*[F.col(f"`{c}`").alias(c) for c in rest]) if rest else F.lit(None)
    return docs.select(*read, held.alias("_rest")), [F.col(c) if c in read else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns]


#: Caches of this process that outlive a task.
_CACHES: list[Callable] = []


def lasting(maxsize: int) -> Callable[[Callable], Callable]:
    """lru_cache() of what serves the next task of an operator too; the trim() of any other operator empties it."""

    def made(f: Callable) -> Callable:
        _CACHES.append(lru_cache(maxsize)(f))
        return _CACHES[-1]

    return made


def slices(batches: Iterator[Any], rows: int = 1000) -> Iterator[Any]:
    """Record batches in slices of a few rows, so that what is made of one is small, whatever the size of Spark's batches."""
    for b in batches:
        for k in range(0, b.num_rows, rows):
            yield b.slice(k, rows)


def trim(*keep: Callable) -> None:
    """Gives memory that a Python worker has freed back to the system: workers stay idle between stages and keep their peak else.

    The lasting caches go first, but for those to keep: a worker that has served one operator serves others after it.
    """
    import ctypes

    import pyarrow as pa

    for cache in _CACHES:
        if cache not in keep:
            cache.cache_clear()
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give is not None:
        give(0)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, though lambdas in body refer to it for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text: runs of anything but space and \\x09-\\x0D; none for null or blank."""
    spaced = reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(" ")), SPACES[:-1], F.coalesce(text, F.lit("")))
    return F.filter(F.split(spaced, " "), lambda w: w != "")  # one character: split() needs no regular expression


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
