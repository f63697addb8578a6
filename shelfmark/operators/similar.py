"""Similar books: blocking by name tokens and near authors, scoring, symmetric links.

A pair needs a common name token and two author keys within the border, so both are part of the
self-join's key.  Near author keys are found first, among distinct keys.  A book then goes to every
key that is near one of its own and meets the books with that key and the same token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.keys import author_keys, comparable, name_key, name_tokens
from shelfmark.functions.score import EDIT_BORDER, LEAST_TOKENS, OVERLAP_BORDER, book_score, lengths_near
from shelfmark.operators.blocks import common_token_pairs
from shelfmark.operators.near import both_ways, near_keys
from shelfmark.operators.overlap import salted_postings
from shelfmark.schema import BOOKS
from shelfmark.scratch import stash


def with_keys(books: DataFrame) -> DataFrame:
    """Adds author_keys, name_key, name_tokens to the comparable books."""
    keyed = {"author_keys": author_keys(F.col("Authors")), "name_key": name_key(F.col("Name")), "name_tokens": name_tokens(F.col("Name"))}
    return books.where(comparable(F.col("Authors"), F.col("Name"))).withColumns(keyed)


def inverted_index(keyed: DataFrame, id_col: str = "Id") -> DataFrame:
    """(token, id): the postings of all books."""
    return keyed.select(F.explode("name_tokens").alias("token"), F.col(id_col).alias("id"))


def candidates(keyed: DataFrame, id_col: str = "Id") -> DataFrame:
    """Distinct unordered pairs (a, b), a < b, that share a name token."""
    return common_token_pairs(keyed, id_col).select("a", "b")


def near_candidates(keyed: DataFrame, edit: float = EDIT_BORDER, id_col: str = "Id", compared: bool = False, overlap: float | None = None) -> DataFrame:
    """Distinct pairs (a, b), a < b, whose authors pass and whose names share a token.  compared: pairs of two books already compared, too.
    overlap: only pairs whose names pass by edit distance or by this border.

    Tokens are compared by hashes of 32 bits: whoever needs them equal compares the tokens of what is left.
    Names are tested where the books meet, and only what passes moves.
    """
    each = keyed.select(F.col(id_col).alias("id"), F.explode("author_keys").alias("x"))
    near = near_keys(each.select(F.col("x").alias("key")), edit).where("x <= y")
    names = keyed.select(F.col(id_col).alias("id"), F.col("Compared").alias("old"), "name_key", F.transform("name_tokens", lambda t: F.hash(t)).alias("t"), "author_keys")
    right = names.withColumn("y", F.explode("author_keys")).drop("author_keys")
    reached = stash(each.join(near, "x").select("id", "y").distinct(), "reached")  # read twice: near keys are not to be found twice
    left = reached.join(names.drop("author_keys"), "id")
    spark = keyed.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    dealt, every = (side.repartition(parts, "y", "salt") for side in salted_postings(left, right, ["y"], reached))
    a, b = dealt.alias("a"), every.alias("b")
    fresh = F.lit(compared) | ~(F.col("a.old") & F.col("b.old"))
    test = F.arrays_overlap("a.t", "b.t")
    if overlap is not None:
        # Each function once: scores prove what passes.
        longer, smaller = F.greatest(F.length("a.name_key"), F.length("b.name_key")), F.least(F.size("a.t"), F.size("b.t"))
        by_edit = F.when(lengths_near(F.col("a.name_key"), F.col("b.name_key"), edit), F.call_function("levenshtein", F.col("a.name_key"), F.col("b.name_key"), F.ceil(F.lit(edit) * longer).cast("int")) >= 0)
        by_tokens = F.when(smaller >= LEAST_TOKENS, F.size(F.array_intersect("a.t", "b.t")) >= smaller * F.lit(1 - overlap) - 1e-9)
        test = test & (by_tokens.otherwise(False) | by_edit.otherwise(False))
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("y", "salt")]
    pairs = a.join(b.hint("shuffle_hash"), [*same, F.col("a.id") != F.col("b.id"), fresh, test])
    return pairs.select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def comparisons(keyed: DataFrame, edit: float = EDIT_BORDER, overlap: float = OVERLAP_BORDER, id_col: str = "Id") -> DataFrame:
    """Successful comparisons (from_id, to_id, coeff) of books not yet compared with all others.

    A score depends on the direction, so both directions of a pair are scored where both books probe.
    The keys are written once, as blocking and scoring read them eight times and making them may be a long plan.
    """
    keyed = stash(keyed.select(id_col, "Compared", "author_keys", "name_key", "name_tokens"), "keys")
    side = keyed.select(F.col(id_col).alias("id"), F.struct("author_keys", "name_key", "name_tokens").alias("k"), F.col("Compared").alias("old"))
    pairs = near_candidates(keyed, edit, id_col, overlap=overlap)
    both = both_ways(pairs, "a", "b")
    probing = side.where(~F.col("old")).select(F.col("id").alias("a"), F.col("k").alias("ka"))
    other = side.select(F.col("id").alias("b"), F.col("k").alias("kb"))
    scored = both.join(probing, "a").join(other, "b").where(F.arrays_overlap("ka.name_tokens", "kb.name_tokens")).select("a", "b", book_score("ka", "kb", edit, overlap).alias("s")).where("s.success")
    return scored.select(F.col("a").alias("from_id"), F.col("b").alias("to_id"), F.col("s.coeff").alias("coeff"))


def similar_edges(keyed: DataFrame, edit: float = EDIT_BORDER, overlap: float = OVERLAP_BORDER, id_col: str = "Id") -> DataFrame:
    """Directed links (from_id, to_id, coeff): each comparison links both its books with its coefficient.

    Two books of which both probe can have two different links each way.
    """
    forward = comparisons(keyed, edit, overlap, id_col)
    return both_ways(forward, "from_id", "to_id").distinct()


def similar_maps(books: DataFrame, edges: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """Id, SimilarBooks, SimilarCount of every book: new links with those stored for books already compared.  others: the books that links may lead to, if not these."""
    other = (books if others is None else others).select(F.col("Id").alias("to_id"), F.col("ElsName").alias("els"), "ExternalId")
    made = edges.join(other, "to_id").select(F.col("from_id").alias("Id"), "els", F.struct(F.col("to_id").alias("BookId"), "ExternalId", F.col("coeff").alias("Coeff")).alias("link"))
    kept = books.where("Compared").select("Id", F.explode("SimilarBooks").alias("els", "links")).select("Id", "els", F.explode("links").alias("link"))
    links = made.unionByName(kept).groupBy("Id", "els").agg(F.sort_array(F.collect_set("link")).alias("links"))
    maps = links.groupBy("Id").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("els", "links")))).alias("SimilarBooks"), F.sum(F.size("links")).cast("int").alias("SimilarCount")
    )
    empty = F.create_map().cast(BOOKS["SimilarBooks"].dataType)
    out = books.select("Id").join(maps, "Id", "left")
    return out.select("Id", F.coalesce("SimilarBooks", empty).alias("SimilarBooks"), F.coalesce("SimilarCount", F.lit(0)).alias("SimilarCount"))
