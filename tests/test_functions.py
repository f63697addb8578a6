"""Golden vectors of the scalar functions, keys and scores."""

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import fields as X
from shelfmark.functions import keys as K
from shelfmark.functions import score as S
from shelfmark.functions import text as T


def values(spark, rows, expression, schema="s string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], schema).select(expression).collect()]


def test_blank(spark):
    assert values(spark, [None, "", "  \t", "a"], T.is_blank(F.col("s"))) == [True, True, True, False]


def test_clean(spark):
    assert values(spark, ["А.Б. Книга, 2-е изд.!", None], T.clean(F.col("s"))) == ["А.Б. Книга е изд.", ""]


def test_name_keys(spark):
    names = [
        "Хищники : комедия в пяти действиях: художественная литература",
        "Хищники: комедия в пяти действиях",
        "Атом и романтика: учебное пособие",
        "Introduction to Data Analysis, 2nd edition 2010",
        "я и ты",
    ]
    assert values(spark, names, K.name_key(F.col("s"))) == ["хщнккмдптдствх", "хщнккмдптдствх", "тк", "ntrdctndtnlyssnddtn", ""]
    assert values(spark, names, K.name_tokens(F.col("s"))) == [
        ["хщнк", "кмд", "пт", "дствх"], ["хщнк", "кмд", "пт", "дствх"], ["тк"], ["ntrdctn", "dt", "nlyss", "nd", "dtn"], [],
    ]


@pytest.mark.parametrize(
    ("authors", "keys"),
    [
        ("Писемский А. Ф.", ["писемскийаф"]),
        ("Иван Иванов", ["ивани", "иванови"]),
        ("А. Ф. Писемский", ["афп", "апф", "фап", "фпа", "писемскийаф", "писемскийфа"]),
        ("Петров П.П.; Под ред. Сидорова С.С.", ["петровпп", "сидоровасс"]),
        ("John Ronald Reuel Tolkien Esq", ["johnrrte"]),
        ("Smith", ["smith"]),
        ("И. И. Ильин", ["иии", "ильинии"]),
        (None, []),
    ],
)
def test_author_keys(spark, authors, keys):
    assert values(spark, [authors], K.author_keys(F.col("s"))) == [keys]


COMPARED = [
    ("Писемский А. Ф.", "Хищники : комедия в пяти действиях: художественная литература", "Писемский А.Ф.", "Хищники: комедия в пяти действиях", True, 0.0),
    ("Smith J.", "Linear algebra methods for large sparse graph problems", "Smith J.", "Large sparse graph problems and linear algebra methods second course", True, 0.0625),
    ("Smith J.", "Databases", "Jones K.", "Databases", False, 0.0),
    ("И. И. Иванов", "Физика", "И. И. Петров", "Физика", False, 0.0),
    ("И. И. Иванов", "Физика", "И. И. Ильин", "Физика", True, 0.0),
    ("Иван Петров, Smith J.", "Databases systems", "Smit J., Иван Петрв", "Databases systems", True, 0.0),
    ("Smit J., Иван Петрв", "Databases systems", "Иван Петров, Smith J.", "Databases systems", True, 0.083333),
]


def test_book_score(spark):
    rows = spark.createDataFrame([(i, *r[:4]) for i, r in enumerate(COMPARED)], "i int, a1 string, n1 string, a2 string, n2 string")
    side = lambda k: F.struct(K.author_keys(F.col(f"a{k}")).alias("author_keys"), K.name_key(F.col(f"n{k}")).alias("name_key"), K.name_tokens(F.col(f"n{k}")).alias("name_tokens"))
    got = rows.select("i", side(1).alias("x"), side(2).alias("y")).select("i", S.book_score("x", "y").alias("s")).orderBy("i").collect()
    assert [(r.s.success, round(r.s.coeff, 6)) for r in got] == [(r[4], r[5]) for r in COMPARED]


def test_tokens_keep_numbers_beyond_32_bits(spark):
    assert values(spark, ["a 12 bc_de 99999999999"], T.tokens(F.col("s"))) == [["bc", "de", "99999999999"]]


def test_digits_and_first_number(spark):
    assert values(spark, ["a1-2", None], T.only_digits(F.col("s"))) == ["12", ""]
    assert values(spark, ["год 2010, 5", "нет"], X.first_number(F.col("s"))) == ["2010", None]


def test_ids(spark):
    urls = ["https://a.example/book/007/", "https://a.example/book/x", "https://a.example/c/b-12"]
    assert values(spark, urls, X.numeric_id(X.segment_before_slash(F.col("s")))) == ["7", None, None]
    assert values(spark, urls, X.numeric_id(X.last_segment(F.col("s"), "-", -1)))[2] == "12"


def test_permutations():
    assert K.permutation_indexes(0) == [] and len(K.permutation_indexes(4)) == 24
