"""The store of books: a Parquet table with a partition for each catalogue.

Reads push filters and columns down to the scan, and one of a catalogue reads its partition alone.  An append adds
files.  An update finds the catalogues that hold a changed row by the ids alone and writes only their partitions
anew, by Spark's dynamic overwrite: a failed job leaves the old ones.  Appends may run side by side; an update
wants its catalogues to itself.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.schema import BOOKS, as_books
from shelfmark.scratch import stash

log = logging.getLogger("shelfmark.store")


class BookStore:
    """A table of books in one folder, partitioned by ElsName."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def all(self) -> DataFrame:
        try:
            return self.spark.read.schema(BOOKS).parquet(self.path).select(BOOKS.names)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], BOOKS)

    def read(self, condition: Column | None = None, columns: Iterable[str] | None = None) -> DataFrame:
        """Rows that meet a condition, with some columns."""
        out = self.all() if condition is None else self.all().where(condition)
        return out if columns is None else out.select(*columns)

    def read_without(self, *columns: str) -> DataFrame:
        """All rows without some columns."""
        return self.all().drop(*columns)

    def stored_ids(self, els_name: str) -> DataFrame:
        return self.read(F.col("ElsName") == els_name, ["ElsName", "ExternalId"]).distinct()

    def create_many(self, books: DataFrame) -> bool:
        """Appends rows, those without an id or a catalogue left out; an error is logged and tells False."""
        try:
            good = as_books(books).where("ExternalId is not null and ElsName <> ''")
            good.write.mode("append").partitionBy("ElsName").parquet(self.path)
        except Exception:  # noqa: BLE001  the caller goes on with other batches
            log.exception("books were not saved")
            return False
        return True

    def touched(self, keys: DataFrame, key: str = "Id") -> DataFrame:
        """All rows of the catalogues that hold one of the keys (_key); the partitions of the others are not read."""
        held = self.all().select(F.col(key).alias("_key"), "ElsName").join(keys, "_key", "left_semi")
        names = [r.ElsName for r in held.select("ElsName").distinct().collect()]  # as many as catalogues at most
        return self.all().where(F.col("ElsName").isin(names))

    def update_many(self, changes: DataFrame, key: str = "Id") -> bool:
        """Sets the columns of changes in the rows of the same key; nothing to change is a success.  A book stays in its catalogue."""
        fields = [c for c in changes.columns if c != key]
        if "ElsName" in fields:
            raise ValueError("a book stays in its catalogue")
        try:
            right = stash(changes.select(F.col(key).alias("_key"), F.struct(*fields).alias("_new")).where("_key is not null").dropDuplicates(["_key"]), "changes")
            joined = self.touched(right.select("_key"), key).join(right, F.col(key) == F.col("_key"), "left")
            for c in fields:
                joined = joined.withColumn(c, F.when(F.col("_key").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)))
            anew = stash(as_books(joined), "updated")  # a table can't be written over while it is read
            anew.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("ElsName").parquet(self.path)
        except Exception:  # noqa: BLE001  the old partitions stay
            log.exception("books were not updated")
            return False
        return True

    def update(self, condition: Column, **values: object) -> bool:
        """Sets columns of the rows that meet a condition."""
        found = self.read(condition, ["Id"])
        return self.update_many(found.select("Id", *[F.lit(v).alias(c) for c, v in values.items()]))
