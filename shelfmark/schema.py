"""The table of books and how any table is made to fit it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINK = T.StructType([T.StructField("BookId", T.StringType()), T.StructField("ExternalId", T.StringType()), T.StructField("Coeff", T.DoubleType())])
_TEXT = ("Id", "ExternalId", "ElsName", "Authors", "ISBN", "ISSN", "Publisher", "Name", "Year", "Bib")
BOOKS = T.StructType(
    [T.StructField(c, T.StringType()) for c in _TEXT]
    + [
        T.StructField("Pages", T.IntegerType()),
        T.StructField("SimilarCount", T.IntegerType()),
        T.StructField("Compared", T.BooleanType()),
        T.StructField("SimilarBooks", T.MapType(T.StringType(), T.ArrayType(LINK))),
    ]
)


def stable_id(els_name: Column, external_id: Column) -> Column:
    """The id of a book, a function of its natural key."""
    return F.sha2(F.concat_ws("\u0001", els_name, external_id), 256)


def as_books(df: DataFrame) -> DataFrame:
    """Fits a table to the schema: unknown columns go, missing ones are null (0, false and empty for counts, marker and links)."""
    defaults = {"Pages": F.lit(0), "SimilarCount": F.lit(0), "Compared": F.lit(False), "SimilarBooks": F.create_map().cast(BOOKS["SimilarBooks"].dataType)}
    columns = []
    for f in BOOKS:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if f.name == "Id":
            c = F.coalesce(c, stable_id(F.col("ElsName"), F.col("ExternalId")))
        c = c.cast(f.dataType)
        columns.append((F.coalesce(c, defaults[f.name]) if f.name in defaults else c).alias(f.name))
    return df.select(*columns)
