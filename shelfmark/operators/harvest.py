"""Operators of collecting: id ranges, pages, batches, items not yet stored, look-ups, unions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def id_range(spark: SparkSession, start: int, end: int) -> DataFrame:
    """id from start, end exclusive."""
    return spark.range(start, end)


def batches(df: DataFrame, size: int, id_col: str = "id") -> DataFrame:
    """batch, n, least and greatest id of every group of size consecutive ids."""
    grouped = df.groupBy(F.floor(F.col(id_col) / size).alias("batch"))
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias("least"), F.max(id_col).alias("greatest"))


def pages_of_total(total: Column, per_page: int) -> Column:
    """Number of pages by a total: one too many where it divides evenly, as the catalogues are asked."""
    return (F.floor(total / per_page) + 1).cast("int")


def pages_of_pager(texts: Column) -> Column:
    """The greatest number among a pager's texts, where what is no number counts 1; 1 without a pager."""
    numbers = F.transform(texts, lambda t: F.coalesce(F.trim(t).try_cast("int"), F.lit(1)))
    return F.coalesce(F.array_max(numbers), F.lit(1))


def page_numbers(df: DataFrame, pages: Column, start: int = 1) -> DataFrame:
    """A row for each page from start on; none if there are fewer pages."""
    numbers = F.when(pages >= start, F.sequence(F.lit(start), pages)).otherwise(F.array().cast("array<int>"))
    return df.withColumn("page", F.explode(numbers))


def page_urls(df: DataFrame, template: str, column: str = "page") -> DataFrame:
    """Adds url, with the page or id put into a fixed address."""
    return df.withColumn("url", F.format_string(template, F.col(column)))


def new_items(found: DataFrame, stored: DataFrame, keys: Iterable[str] = ("ElsName", "ExternalId")) -> DataFrame:
    """Items not stored yet, each once; nulls are no key and are dropped."""
    keys = list(keys)
    return found.dropna(subset=keys).dropDuplicates(keys).join(stored.select(keys), keys, "left_anti")


def lookup(items: DataFrame, entries: DataFrame, key: Column, strict: bool = False) -> DataFrame:
    """Adds the value of entries (key, value); an item without an entry gets null, or goes if strict."""
    keyed = items.withColumn("_key", key)
    right = entries.select(F.col("key").alias("_key"), "value")
    return keyed.join(right, "_key", "inner" if strict else "left").drop("_key")


def union_distinct(first: DataFrame, second: DataFrame, key: str = "id") -> DataFrame:
    """Items of two lists, each once."""
    return first.unionByName(second).dropDuplicates([key])
