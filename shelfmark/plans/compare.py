"""The comparison of a whole catalogue, and the derived catalogue that queries over the driver's tables use."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.bib import fill_gaps
from shelfmark.functions.score import EDIT_BORDER, OVERLAP_BORDER
from shelfmark.functions.text import upper_letter
from shelfmark.operators.index import BookIndex
from shelfmark.operators.similar import similar_edges, similar_maps, with_keys
from shelfmark.plans.metrics import Metrics
from shelfmark.schema import as_books
from shelfmark.scratch import stash
from shelfmark.sources.store import BookStore


@dataclass(frozen=True)
class CompareOptions:
    """Borders of edit distance and overlap."""

    edit_border: float = EDIT_BORDER
    overlap_border: float = OVERLAP_BORDER


def compare(books: DataFrame, options: CompareOptions = CompareOptions(), metrics: Metrics | None = None) -> DataFrame:
    """Books with gaps filled, links to similar ones, their number and the marker set; books that are not comparable get no links.

    Only books not yet compared are probed, against all; links of the others are kept and added to.  metrics gets the
    numbers of books, of those compared before, and of links.
    """
    seen = metrics or Metrics()
    filled = stash(seen.of(fill_gaps(books), "books", compared=F.count_if("Compared")), "filled")
    edges = stash(seen.of(similar_edges(with_keys(filled), options.edit_border, options.overlap_border), "links"), "edges")
    maps = similar_maps(filled, edges)
    done = filled.drop("SimilarBooks", "SimilarCount", "Compared").join(maps, "Id")
    return as_books(done.withColumn("Compared", F.lit(True)))


_RESULT = ["Id", "Authors", "Publisher", "Name", "SimilarCount", "SimilarBooks", "Compared"]


def compare_store(store: BookStore, options: CompareOptions = CompareOptions(), metrics: Metrics | None = None) -> bool:
    """Compares what a store holds and writes the result to it; descriptions stay as stored."""
    seen = metrics or Metrics()
    done = store.update_many(compare(store.all(), options, seen).select(_RESULT))
    seen.report()
    return done


def compare_new(store: BookStore, index: BookIndex) -> bool:
    """Compares the books of a store that are not compared yet by an index of the others, adds them to it and writes the links of all books they meet.

    Pairs are scored in both directions, so the links do not depend on the runs that books came in.
    """
    books = store.all()
    fresh = stash(fill_gaps(books).where("not Compared"), "fresh")
    edges = index.add(with_keys(fresh))
    met = edges.select(F.col("from_id").alias("Id")).union(fresh.select("Id")).distinct()
    touched = stash(books.join(met, "Id", "left_semi").withColumn("Compared", F.lit(True)), "touched")
    other = books.select("Id", "ElsName", "ExternalId")
    maps = similar_maps(touched, edges, other)
    names = fresh.select("Id", "Authors", "Publisher", "Name").union(touched.join(fresh.select("Id"), "Id", "left_anti").select("Id", "Authors", "Publisher", "Name"))
    return store.update_many(maps.join(names, "Id").withColumn("Compared", F.lit(True)).select(_RESULT))


def derived_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue out of the table of documents.

    The first words of a text are authors: by the id one name of one to five words, two names, or a surname with initials; words
    three to fourteen are the name.  The language gives the publisher, which every fourth book has a branch of.  The description is all
    of it, with a second publisher in every third and with a surname beside initials in every sixth.  Every fifth book has
    blank authors, every third is compared, and every ninth has a stored link.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source")
    words = F.filter(F.split("text", r"[^\p{L}\p{N}]+", 16), lambda w: w != "")  # the first fourteen, one may be empty, and the rest
    of = lambda k: F.col("doc_id") % k
    part = lambda i, n: F.array_join(F.slice("w", i, n), " ")
    initial = lambda i: F.coalesce(F.concat(F.lit(" "), upper_letter(F.left(F.get("w", F.lit(i)), F.lit(1))), F.lit(".")), F.lit(""))
    authors = F.when(of(8) < 5, F.array_join(F.slice("w", F.lit(1), (of(8) + 1).cast("int")), " ")).when(of(8) == 5, F.concat(part(1, 2), F.lit(", "), part(3, 2)))
    authors = authors.when(of(8) == 6, F.concat(part(1, 1), initial(1), initial(2))).otherwise(part(1, 2))
    publisher = F.concat(F.lit("Verlag "), F.col("lang"), F.when(of(4) == 1, " Nord").otherwise(""))
    base = docs.withColumn("w", words).select("doc_id", "lang", "source", authors.alias("a"), part(3, 12).alias("n"), publisher.alias("p"))
    more = F.concat(F.when(of(3) == 1, " Verlag de").otherwise(""), F.when(of(6) == 2, " Zorin A. B.").otherwise(""))
    link = F.struct(F.lpad((F.col("doc_id") + 1).cast("string"), 12, "0").alias("BookId"), (F.col("doc_id") + 1).cast("string").alias("ExternalId"), F.lit(0.125).alias("Coeff"))
    stored = F.when(of(9) == 0, F.create_map(F.lit("stored"), F.array(link)))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return as_books(
        base.repartition(parts, "doc_id").select(
            F.lpad(F.col("doc_id").cast("string"), 12, "0").alias("Id"), F.col("doc_id").cast("string").alias("ExternalId"), F.col("source").alias("ElsName"),
            F.when(of(5) == 0, "").otherwise(F.col("a")).alias("Authors"), F.col("n").alias("Name"), F.col("p").alias("Publisher"),
            F.concat(F.concat_ws(" ", "a", "n", "p"), more).alias("Bib"), (of(3) == 0).alias("Compared"), stored.alias("SimilarBooks"),
        )
    )
