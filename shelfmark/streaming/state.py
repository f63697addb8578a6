"""Streams with state: batches of n rows, and items seen once across runs.

State lies in RocksDB beside the checkpoint, so it is bounded by an executor's disk and a restarted stream goes on from it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep their state in RocksDB."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


class _Window(StatefulProcessor):
    """Holds back the rows that do not fill a batch yet; one of a key's rows may say that it is the last."""

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rest = handle.getListState("rest", "seq long, item string")
        self.next = handle.getValueState("next", "batch long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        came = pd.concat(list(rows))  # of one key in one micro-batch, whose size the source bounds
        fresh = came[~came["done"]].sort_values("seq")
        held = [*(self.rest.get() if self.rest.exists() else ()), *zip(fresh["seq"].tolist(), fresh["item"].tolist(), strict=True)]
        number = self.next.get()[0] if self.next.exists() else 0
        whole = len(held) if came["done"].any() else len(held) - len(held) % self.size
        batches = [number + k // self.size for k in range(whole)]
        self.rest.clear()
        if whole < len(held):
            self.rest.put([(int(s), i) for s, i in held[whole:]])
        self.next.update((number + -(-whole // self.size),))
        if whole:
            text = lambda values: pd.Series(values, dtype=object)
            yield pd.DataFrame({"key": text([key[0]] * whole), "batch": batches, "seq": [int(h[0]) for h in held[:whole]], "item": text([h[1] for h in held[:whole]])})

    def close(self) -> None:
        pass


def count_windows(rows: DataFrame, size: int) -> DataFrame:
    """key, batch, seq, item: the items of every key in batches of exactly so many, in the order of seq within a micro-batch.

    rows: a stream of key (string), seq (long), item (string), done (boolean).  A row that is done is no item: it flushes what is left
    of its key as a smaller batch.  Until then the rest waits, over restarts too.
    """
    return rows.groupBy("key").transformWithStateInPandas(_Window(size), "key string, batch long, seq long, item string", "Append", "None")


def seen_once(items: DataFrame, keys: list[str]) -> DataFrame:
    """The items of a stream whose keys were not seen before, in this run or an earlier one of the same checkpoint; nulls are no key."""
    return items.dropna(subset=keys).dropDuplicates(keys)


def run_all(stream: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Starts a stream over all that is there, with its state in RocksDB, and waits for its end."""
    with rocksdb(spark):
        query = stream.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def numbered(rows: DataFrame, key: Column, seq: Column, item: Column, done: bool = False) -> DataFrame:
    """Rows as count_windows takes them."""
    return rows.select(key.cast("string").alias("key"), seq.cast("long").alias("seq"), item.cast("string").alias("item"), F.lit(done).alias("done"))
