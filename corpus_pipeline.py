"""A pipeline over documents: quality rules, near duplicates, benchmark decontamination, surrogates for personal data, packing.

Every stage works on all documents that the one before it kept; each result is written to the
shared folder and read again, so a lost executor costs no more than the stage at work.

All stages but the last return the columns of documents as they are.  Columns that a stage does not read are set aside
in one struct meanwhile, so none can clash with a column that an operator adds, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, jaccard, packing, pii, quality_rules
from shelfmark.llm.common import set_aside, stash, table
from shelfmark.llm.queries import pii_key, tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null, empty and short texts fail the rules and go.  A very long text is judged whole, repeated rows alike.  A null id is
    judged but never trusted; a null in another column stays.  An empty table stays empty.
    """
    held, columns = set_aside(docs, "doc_id", "text")
    judged = quality_rules.judge(held, quality_rules.trusted(table(spark, sf_dir, "labels")))
    return judged.where("kept").select(columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: that of the smallest id.

    Null and empty texts are linked with nothing and stay, as do rows with a null id.  Very long texts are compared whole.  Of
    repeated rows of an id that stays, one stays; of equal texts that of the smallest id.  An empty table stays empty.
    """
    held, columns = set_aside(docs, "doc_id", "text")
    return jaccard.distinct_documents(held).select(columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark, asked as it is or with other values.

    Null and empty texts match nothing and stay.  Very long texts are searched whole; null ids and repeated rows are judged by their text.
    An empty table stays empty, and an empty benchmark drops nothing.
    """
    held, columns = set_aside(docs, "doc_id", "text")
    judged = decontaminate.decontaminate(held, table(spark, sf_dir, "benchmark"))
    return judged.where("not contaminated").select(columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data in their texts.

    A null text stays null, an empty one empty.  Very long texts are replaced whole; repeated rows and values get the same
    surrogates, whatever their id.  An empty table stays empty.  Only the text changes.
    """
    held, columns = set_aside(docs, "doc_id", "text")
    return pii.replace_pii(held, pii_key(spark)).select(columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents with their places in sequences.

    A null or empty text is its end token alone.  Only texts beyond a sequence are cut.  Every row is a document of its own, with a
    null or repeated id too.  An empty table has no pieces.  Other columns are not read.
    """
    return packing.pack_documents(docs.select(F.col("doc_id"), F.col("text")), tokenizer_path(spark))


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: Hashed likelihoods, keyed permutations and a tokenizer have no equivalent in SQL.  Tests compare each stage's rows
#: with brute force on what the stage before kept; of the quality stage, its measures and the labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
