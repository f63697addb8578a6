"""Scalar functions on text, as column expressions.

Every pattern carries (?U): word characters, digits and white space are those of Unicode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stems removed from names wherever they stand, in this order of alternatives; vowels;
# words that say nothing in a bibliographic description; words that are no part of an author's name.
STEMS = (
    "томах|том|часть|частях|части|учебно\\-методический комплекс|практикум|роман|методическ|практическ|сборник|художественн|"
    "литератур|научн|популярн|издание|публицистик|документальн|учебник|учебн|пособ|монограф"
)
VOWELS = "_ёуейиыаоэяиюьъeuoai"
BIB_STOP_WORDS = (
    "https ru book url обращения дата index php page id biblioclub isbn по подписке москва для ресурс lib rucont efd href nbsp система "
    "com библиотечная электронно пользователей лань пособие авториз lanbook учебное санкт петербург университет ред изд издание ил ttp "
    "на www znanium product catalog http books html сайт ipr iprbookshop авторизир lang библиогр монография институт reading ibooks "
    "bookshelf кн им дис др табл медиа инфра de issn of учеб von тип пер"
).split()
AUTHOR_STOP_WORDS = (
    "под при ран ран ред рос гос отв общ гоу пер the нви его бак вып спб ооо вид том кол кол изд авт уфа оон III баш зао чип впо ниц "
    "науч омск урал мгуп сост роль введ сети проф класс пресс омский инфра учебно сборник перевод советом письменная федерации "
    "метрология определение астраханский ростов стандартинформ российская исторического московский пожар атлас научная научный общие "
    "информатика супрамолекулярная института составление экологическое комментарий религиозно введение исторический свободный "
    "оформление исследование научные федерального вторая русская очерк пакет степень научной рабочих общее редактор редакторы "
    "ответственный московского ответственные лабораторный российский председатель составитель россии физика российской россия "
    "всероссийской всероссийская министерство составители главный первый автор ветер учебная редакцией новый практикум общая "
    "комментарий выпуск редакция университет"
).split()

# Letters that have a capital of one letter, where upper() makes several of them, and these capitals.
WIDE = "ßᾀᾁᾂᾃᾄᾅᾆᾇᾐᾑᾒᾓᾔᾕᾖᾗᾠᾡᾢᾣᾤᾥᾦᾧᾳῃῳ"
CAPITALS = "ẞᾈᾉᾊᾋᾌᾍᾎᾏᾘᾙᾚᾛᾜᾝᾞᾟᾨᾩᾪᾫᾬᾭᾮᾯᾼῌῼ"


def upper_letter(c: Column) -> Column:
    """The capital of a letter as one letter; a letter without one stays."""
    upper = F.upper(c)
    return F.when(c.isin(*WIDE), F.translate(c, WIDE, CAPITALS)).when(F.length(upper) == F.length(c), upper).otherwise(c)


def is_blank(c: Column) -> Column:
    """Null, empty or white space only."""
    return F.coalesce(c, F.lit("")).rlike(r"(?U)^\s*$")


def collapse(c: Column) -> Column:
    """Trims and makes every run of white space one space; null becomes empty."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "), "^ | $", "")


def trim(c: Column) -> Column:
    """Removes white space of any kind from both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """Letters, white space and full stops; anything else becomes a space, and runs of white space one space."""
    return collapse(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)[^\p{L}\s.]", " "))


def _without(c: Column, pattern: str) -> Column:
    """Removes a pattern; null and blank become empty.  One reference to the column, so that nested removals don't multiply."""
    return F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?U)\A\s+\z|{pattern}", "")


def remove_stems(c: Column) -> Column:
    """Removes the stems as substrings, in words too."""
    return _without(c, f"(?iU){STEMS}")


def remove_short_words(c: Column) -> Column:
    """Removes words of one or two characters, and every digit."""
    return _without(c, r"(?U)\b\w\w?\b|\d")


def remove_non_word(c: Column) -> Column:
    return _without(c, r"(?U)\W")


def remove_vowels(c: Column) -> Column:
    return _without(c, f"(?iU)[{VOWELS}]")


def only_digits(c: Column) -> Column:
    return _without(c, r"(?U)\D")


def short_clean(c: Column) -> Column:
    return remove_short_words(remove_stems(c))


def full_clean(c: Column) -> Column:
    return remove_vowels(remove_non_word(short_clean(c)))


def split_words(c: Column) -> Column:
    """The parts between single non-word characters that are not blank; none for blank."""
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)\W"), lambda w: w != "")


def tokens(c: Column, longer_than: int = 1) -> Column:
    """The words of a text that are longer than so many characters and no 32-bit number."""
    keep = lambda t: (F.length(t) > longer_than) & ~is_blank(t) & t.try_cast("int").isNull()
    return F.filter(F.split(F.coalesce(c, F.lit("")), r"(?U)[\W_]"), keep)


def is_stop_word(word: Column, stop_words: list[str]) -> Column:
    """Membership that ignores case."""
    return F.lower(word).isin(*sorted({w.lower() for w in stop_words}))


def starts_upper(word: Column) -> Column:
    return word.rlike(r"^\p{Lu}")


def parse_int(c: Column) -> Column:
    """A 32-bit number, or 0 where there is none."""
    return F.coalesce(trim(c).try_cast("int"), F.lit(0))


def split_list(authors: Column) -> Column:
    """The names of a list of authors: parted by comma, semicolon or colon, empty ones dropped."""
    return F.filter(F.split(F.coalesce(authors, F.lit("")), "[,;:]"), lambda a: a != "")


def str_join(parts: Column, separator: str) -> Column:
    """Joins an array; empty for null."""
    return F.array_join(F.coalesce(parts, F.array().cast("array<string>")), separator)


def none_or_empty(parts: Column) -> Column:
    return F.coalesce(F.size(parts), F.lit(0)) <= 0
