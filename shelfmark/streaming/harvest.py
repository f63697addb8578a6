"""Collecting as a stream: payload files in, books out, each item once across runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.harvest import new_items
from shelfmark.sources.connectors import Connector
from shelfmark.sources.store import BookStore
from shelfmark.streaming.state import rocksdb, seen_once


def payload_stream(spark: SparkSession, path: str, schema: str = "id string, payload string", files_per_batch: int = 100) -> DataFrame:
    """A stream of captured payloads, so many files a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def harvest(payloads: DataFrame, connector: Connector, store: BookStore, checkpoint: str) -> StreamingQuery:
    """Stores the new books of a stream, all that is there, and ends.

    An id that the stream has seen, in this run or an earlier one of the checkpoint, does not come again: that is state in RocksDB.  Only the
    first micro-batch of a run is joined with what is stored, as it may be one that was saved and not noted, and as the store may
    have books from elsewhere; so nothing is added twice, and later micro-batches cost what they hold.
    """
    begun: list[bool] = []

    def save(batch: DataFrame, _: int) -> None:
        books = connector.extract(batch)
        fresh = books.dropna(subset=["ExternalId"]).dropDuplicates(["ElsName", "ExternalId"]) if begun else new_items(books, store.stored_ids(connector.name))
        if not store.create_many(fresh):
            raise RuntimeError("a batch was not saved; the stream goes on from it")
        begun.append(True)

    with rocksdb(store.spark):
        return seen_once(payloads, ["id"]).writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
