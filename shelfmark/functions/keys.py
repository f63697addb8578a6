"""Keys that books are compared by."""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.functions.text import AUTHOR_STOP_WORDS, full_clean, is_blank, is_stop_word, remove_vowels, short_clean, split_list, split_words

#: Names of more words get one key and no permutations.
MOST_PERMUTED = 4


def permutation_indexes(n: int) -> list[tuple[int, ...]]:
    """All orders of n places, lexicographically; none for nothing."""
    return list(permutations(range(n))) if n else []


def abbreviated(words: Column, order: tuple[int, ...]) -> Column:
    """The first word in full and the first character of the others, in the order given."""
    return F.concat(F.get(words, order[0]), *[F.left(F.get(words, i), F.lit(1)) for i in order[1:]])


def first_full_other_first(words: Column) -> Column:
    """The first word and the first characters of the rest; empty for no words."""
    rest = F.transform(F.slice(words, 2, 1_000_000), lambda w: F.left(w, F.lit(1)))
    return F.concat(F.coalesce(F.get(words, 0), F.lit("")), F.array_join(rest, ""))


def is_name_with_initials(words: Column, n: int) -> Column:
    """Exactly n words: one of other than one character, then single characters."""
    rest = F.forall(F.slice(words, 2, 1_000_000), lambda w: F.length(w) == 1)
    return (F.size(words) == n) & (F.length(F.get(words, 0)) != 1) & rest


def keys_of_author(words: Column) -> Column:
    """The keys of one name: one for a surname with initials or a long name, else one for every order of its words."""
    single = is_name_with_initials(words, 2) | is_name_with_initials(words, 3) | (F.size(words) > MOST_PERMUTED)
    out = F.when(F.size(words) == 0, F.array().cast("array<string>")).when(single, F.array(first_full_other_first(words)))
    for n in range(1, MOST_PERMUTED + 1):
        out = out.when(F.size(words) == n, F.array(*[abbreviated(words, p) for p in permutation_indexes(n)]))
    return out


def author_keys(authors: Column) -> Column:
    """The distinct keys of a list of authors in the order of their first appearance, on which scores depend."""

    def words(author: Column) -> Column:
        return F.filter(split_words(author), lambda w: ~is_blank(w) & ~is_stop_word(w, AUTHOR_STOP_WORDS))

    each = F.transform(F.transform(split_list(F.lower(authors)), words), keys_of_author)
    return F.array_distinct(F.flatten(each))


def name_key(name: Column) -> Column:
    return full_clean(F.lower(F.coalesce(name, F.lit(""))))


def name_tokens(name: Column) -> Column:
    return F.array_distinct(split_words(remove_vowels(short_clean(F.lower(F.coalesce(name, F.lit("")))))))


def comparable(authors: Column, name: Column) -> Column:
    """Books without authors or a name take no part."""
    return ~is_blank(authors) & ~is_blank(name)
