"""Surrogates for personal data: keyed, of the same type and format, distinct for distinct values.

Mail addresses, bank and card numbers, network addresses, telephone and social security numbers
and names, after a form of address or by a known given name, with their other mentions, are found in whole texts.  A mention is
made of values: a name of its words but for particles, an address of its local part and domain labels, so what is partly
the same stays partly the same.  A value, in lower case and without punctuation, is replaced by a keyed permutation of
the values of its format: letters stay letters of their script, digits digits, a card number keeps its
length, first digit and check digit, a given name becomes one of its gender and script, any other
name keeps its ending, which carries gender.

A permutation cannot give two values one surrogate.  What it cannot know, that a surrogate is itself
a value of the corpus, is checked in a join of all surrogates with all values: the k-th of the values
of a format whose surrogate is taken gets the k-th free one, by a join on ranks.  A format of words
that is full goes on with a longer one, so surrogates are always distinct; numbers whose format is full are an error.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.common import lasting, stash, trim, unused

#: At most so many values with a surrogate by rank are sent to executors (some 20 MB); more are joined to the texts that hold them.
MAX_BROADCAST = 100_000
#: Candidates that are made in one group, and values that are ranked in one, about.
GROUP = 10_000
#: Texts whose surrogates are handed on at a time.
TEXTS = 1000

# Forms of address before a name, those of languages with two surnames, particles within a name, alphabets,
# the longest domain of a mail address.
TITLES = (
    "Mr Mrs Ms Miss Dr Dra Prof Sir Lady Herr Frau Señor Señora Señorita Sr Sra Srta Don Doña Monsieur Madame Mademoiselle Mme Mlle "
    "Господин Госпожа г-н г-жа"
).split()
TWO_SURNAMES = frozenset("Señor Señora Señorita Sr Sra Srta Don Doña Dra".split())
PARTICLES = frozenset("de del la las los da do dos das di du le van von der den zu y".split())
ALPHABETS = [
    "0123456789",
    "aeiou",
    "bcdfghjklmnpqrstvwxyz",
    "AEIOU",
    "BCDFGHJKLMNPQRSTVWXYZ",
    "àáâäçèéêëíîïñóôöùúûü",
    "ÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ",
    "аеиоуыэюя",
    "бвгджзйклмнпрстфхцчшщ",
    "АЕИОУЭЮЯ",
    "БВГДЖЗКЛМНПРСТФХЦЧШЩ",
]
#: Given names by script and gender, in lower case.  Fixed values.
GIVEN = {
    "latin f": (
        "agnes alice alma amelia anna astrid beatrice camila carla carmen caroline charlotte chloe clara claudia diana elena elisa emilia emma eva flora "
        "frieda gisela greta hannah helga ida inés ingrid irene isabel jane julia karin laura lena lucía luisa maria marie marta mary mónica nina olivia paula petra "
        "pilar rosa ruth sandra sarah silvia sofia sophie susan teresa ursula vera"
    ).split(),
    "latin m": (
        "adam albert alberto alexander andré andrew antonio benjamin boris bruno carlos charles christian daniel david diego edward erik felix fernando "
        "francisco frank fritz george günter hans henri henry hugo jack jacques james jean johannes john jorge josé juan jürgen karl klaus louis luis manuel marc mark "
        "martin michael miguel oscar otto pablo paul pedro peter philippe pierre rafael robert stefan thomas victor walter william wolfgang"
    ).split(),
    "cyrillic f": "алла анна валентина вера галина дарья екатерина елена жанна зоя инна ирина ксения лариса лидия любовь людмила марина мария надежда наталья нина ольга полина раиса светлана софья тамара татьяна юлия".split(),
    "cyrillic m": "александр алексей андрей антон борис вадим василий виктор владимир геннадий глеб григорий денис дмитрий евгений иван игорь кирилл константин леонид максим михаил николай олег павел пётр роман сергей степан юрий".split(),
}
_GIVEN = {name: group for group, names in GIVEN.items() for name in names}
_CLASS = {c: a for a in ALPHABETS for c in a}
DOMAIN_BYTES = 255

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?)*\.[A-Za-z]{2,}")
_CARD = re.compile(r"(?<![\w.+-])[3-6][0-9]{3}(?:[ -]?[0-9]){9,15}(?![\w-])")
_IP = re.compile(r"(?<![\w.])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![\w]|\.[0-9])")
_PHONE = re.compile(
    r"(?<![\w.])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,5}){1,4}|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?!\w)"
)
_SSN = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])")
_IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
_CAPITAL = r"[^\W\d_a-zа-я][\w'’-]+"
_MORE = rf"(?:\s{{1,3}}(?:(?:{'|'.join(sorted(PARTICLES))})\s{{1,3}}){{0,2}}{_CAPITAL})"
_NAME = re.compile(rf"\b({'|'.join(TITLES)})\.?\s{{1,3}}({_CAPITAL}{_MORE}{{0,4}})")
_TITLED = re.compile("|".join(rf"{t}[.\s]" for t in TITLES))
_CALLED = frozenset(n.title() for n in _GIVEN)
_FULL = re.compile(rf"\b()((?:{'|'.join(sorted(_CALLED))}){_MORE}{{1,4}})")
_WORD = re.compile(r"[^\W\d_][\w'’-]+")
_POSSESSIVE = re.compile(r"['’-]+[sS]?\Z")
_DIGIT = re.compile(r"\d")


def luhn(digits: str) -> int:
    """The check digit that completes digits."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 - k % 2)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_check(country: str, rest: str) -> str:
    """The two check digits of an account number."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in rest + country + '00')) % 97:02d}"


def _permute_number(x: int, n: int, key: bytes) -> int:
    """A keyed permutation of range(n): a Feistel network on the next even number of bits, walked until it falls inside."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    size = (half + 7) // 8
    while True:
        a, b = x >> half, x & mask
        for k in range(8):
            f = hashlib.blake2b(b.to_bytes(size, "big") + bytes([k]), key=key, digest_size=max(8, size)).digest()
            a, b = b, a ^ (int.from_bytes(f, "big") & mask)
        x = (a << half) | b
        if x < n:
            return x


@lasting(1 << 16)
def alphabet(c: str) -> str:
    """The characters that c may become: of its list, else of its kind in its part of Unicode; c itself if it is no letter or digit."""
    if c in _CLASS:
        return _CLASS[c]
    kind = unicodedata.category(c)
    if kind not in ("Ll", "Lu", "Lo", "Nd"):
        return c
    block = ord(c) & ~127
    same = (chr(x) for x in range(block, block + 128))
    return "".join(x for x in same if x not in _CLASS and unicodedata.category(x) == kind and (kind != "Ll" or (len(x.upper()) == 1 and x.upper().lower() == x)) or x == c)


#: Numbers up to 255 and places in a list of names are written as characters from here on.
_FIRST = 0x100
_SEP = "\x1f"


def layout(kind: str, value: str) -> tuple[str, list[str], list[int]]:
    """The format of a value: its mode, the alphabet of each place and the value's place in each."""
    if kind == "ip":
        byte = "".join(chr(_FIRST + k) for k in range(256))
        return "ip", [byte] * 4, [int(x) for x in value.split(".")]
    if kind == "card":
        body = [value[0], *[ALPHABETS[0]] * (len(value) - 2)]
        at = [a.index(c) for a, c in zip(body, value, strict=False)]
        off = (int(value[-1]) - luhn(value[:-1]) - 1) % 10
        return ("card", body, at) if off == 9 else ("number", [*body, "012345678"], [*at, off])
    if kind == "phone":
        keep = 2 if value.startswith("+1") or value.startswith("+7") else 3 if value.startswith("+") else 0
        each = [c if k < keep else "23456789" if k == keep and c in "23456789" else alphabet(c) for k, c in enumerate(value)]
    elif kind == "iban":
        value = value[:2] + value[4:]
        each = [*value[:2], *map(alphabet, value[2:])]
    elif kind == "name" and value in _GIVEN:
        names = GIVEN[_GIVEN[value]]
        return f"given {_GIVEN[value]}", ["".join(chr(_FIRST + k) for k in range(len(names)))], [names.index(value)]
    elif kind == "name":
        keep = 2 if len(value) > 4 else 1 if len(value) > 2 else 0
        each = [alphabet(c) if k < len(value) - keep else c for k, c in enumerate(value)]
    else:
        each = [alphabet(c) for c in value]
    return kind, each, [a.index(c) for a, c in zip(each, value, strict=True)]


def written(mode: str, chars: list[str]) -> str:
    """The value that the characters of a format stand for."""
    if mode == "ip":
        return ".".join(str(ord(c) - _FIRST) for c in chars)
    if mode.startswith("given "):
        names = GIVEN[mode.removeprefix("given ")]
        return "-".join(names[ord(c) - _FIRST] for c in chars)
    value = "".join(chars)
    if mode == "card":
        return value + str(luhn(value))
    if mode == "number":
        return value[:-1] + str((luhn(value[:-1]) + 1 + int(value[-1])) % 10)
    return value[:2] + iban_check(value[:2], value[2:]) + value[2:] if mode == "iban" else value


def room(each: list[str]) -> int:
    total = 1
    for a in each:
        total *= len(a)
    return total


def nth(mode: str, each: list[str], n: int, key: bytes, use: str) -> str:
    """Value number n of a format in an order that the key and the use give."""
    own = hashlib.blake2b(_SEP.join([use, mode, *each]).encode("utf-8", "surrogatepass"), key=key, digest_size=32).digest()
    size = room(each)
    n = _permute_number(n, size, own) if size > 1 else 0
    out = []
    for a in reversed(each):
        n, r = divmod(n, len(a))
        out.append(a[r])
    return written(mode, out[::-1])


def longer(mode: str, each: list[str]) -> list[str] | None:
    """The format that goes on where one is full: another name, a syllable before a name's ending, digits after parts of addresses."""
    if mode.startswith("given "):
        return [*each, each[0]]
    if mode == "name":
        kept = 0
        while kept < min(2, len(each)) and len(each[-1 - kept]) == 1:
            kept += 1
        syllable = ALPHABETS[8:6:-1] if any(c in ALPHABETS[7] + ALPHABETS[8] for c in "".join(each)) else [ALPHABETS[2], ALPHABETS[1]]
        return [*each[: len(each) - kept], *syllable, *each[len(each) - kept :]]
    return [*each, ALPHABETS[0], ALPHABETS[0]] if mode in ("local", "domain") else None


@lasting(1 << 16)
def surrogate(kind: str, value: str, key: bytes) -> str:
    """The surrogate of a value by the permutation of its format."""
    mode, each, at = layout(kind, value)
    n = 0
    for a, k in zip(each, at, strict=True):
        n = n * len(a) + k
    return nth(mode, each, n, key, "value")


def values_of(kind: str, mention: str) -> list[tuple[str, str]]:
    """The values that a mention is made of: (kind, value), in order, in lower case and without punctuation."""
    if kind == "email":
        local, _, domain = mention.lower().rpartition("@")
        return [("local", local), *(("domain", x) for x in domain.split(".")[:-1])]
    if kind == "name":
        return [("name", w.lower() if len(w.lower()) == len(w) else w) for w in mention.split() if w not in PARTICLES]
    if kind == "iban":
        return [(kind, mention.replace(" ", ""))]
    return [(kind, re.sub(r"[^0-9+]", "", mention) if kind in ("card", "phone", "ssn") else mention)]


def _cased(mention: str, value: str) -> str:
    """A value in the case of a mention, character by character; what goes beyond it is as its end."""
    upper = [c.isupper() for c in mention]
    upper += [mention.isupper()] * max(0, len(value) - len(upper))
    out = "".join(c.upper() if u and len(c.upper()) == 1 else c for c, u in zip(value, upper, strict=False))
    return re.sub("-(.)", lambda m: "-" + m[1].upper(), out) if upper[:1] == [True] and "-" not in mention else out


def reformat(kind: str, mention: str, made: list[str]) -> str:
    """Puts surrogates of a mention's values into its punctuation and case."""
    if kind == "email":
        value = f"{made[0]}@{'.'.join([*made[1:], mention.lower().rpartition('.')[2]])}"
        return value.upper() if mention.isupper() else value
    if kind == "name":
        left = iter(made)
        return re.sub(r"\S+", lambda m: m[0] if m[0] in PARTICLES else _cased(m[0], next(left)), mention)
    if kind in ("card", "phone", "ssn"):
        left = iter(made[0].removeprefix("+"))
        return "".join(next(left) if c in "0123456789" else c for c in mention)
    if kind == "iban":
        left = iter(made[0])
        return "".join(c if c == " " else next(left) for c in mention)
    return made[0]


def _person(m: re.Match) -> tuple[int, int]:
    """Where a name stands in what follows a form of address (group 1, empty without one) or begins with a given name (group 2).

    Known given names and a surname, or two words at least after a form of address; a second surname where the form of address is
    of a language that has them.  A word behind a particle belongs to the name.  Words beyond are none of it.
    """
    words = [(w.start(), w[0]) for w in re.finditer(r"\S+", m[2])]
    given = 0
    while given < len(words) and words[given][1].lower() in _GIVEN:
        given += 1
    left = max(given + 1, 2) + (m[1] in TWO_SURNAMES and given > 0)
    end, linked = 0, False
    for start, w in words:
        if w in PARTICLES:
            linked = True
            continue
        if not (left or linked):
            break
        left, linked, end = left - (left > 0 and not linked), False, start + len(w)
    at = m.start(2)
    return at, at + len(_POSSESSIVE.sub("", m[2][:end]))


def find(text: str) -> list[tuple[int, int, str]]:
    """Non-overlapping (start, end, kind) by start; an earlier kind of email, iban, card, ip, phone, ssn, name goes first."""
    found: list[tuple[int, int, str]] = []
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text[at + 1 : at + 1 + DOMAIN_BYTES])
        start = at
        while domain and start and text[start - 1] in _LOCAL:
            start -= 1
        while start < at and text[start] in "._%+-":
            start += 1
        if domain and start < at:
            found.append((start, at + 1 + len(domain[0]), "email"))
        at = text.find("@", at + 1)
    if _DIGIT.search(text):
        found += [(*m.span(), "iban") for m in _IBAN.finditer(text) if _valid_iban(m[0])]
        found += [(*m.span(), "card") for m in _CARD.finditer(text) if 13 <= len(re.sub(r"\D", "", m[0])) <= 19]
        found += [(*m.span(), "ip") for m in _IP.finditer(text) if all(int(x) < 256 and str(int(x)) == x for x in m[0].split("."))]
        found += [(*m.span(), "phone") for m in _PHONE.finditer(text) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]
        found += [(*m.span(), "ssn") for m in _SSN.finditer(text)]
    named = [_person(m) for m in _NAME.finditer(text)] if _TITLED.search(text) else []
    if not _CALLED.isdisjoint(text.split()):
        named += [_person(m) for m in _FULL.finditer(text)]
    if named:
        found += [(s, e, "name") for s, e in named]
        known = {w.lower() for s, e in named for w in text[s:e].split() if w not in PARTICLES}
        words = ((m.start(), _POSSESSIVE.sub("", m[0])) for m in _WORD.finditer(text))  # other mentions of the same people
        found += [(s, s + len(w), "name") for s, w in words if w.lower() in known and not w[0].islower()]
    if len(found) < 2:
        return found
    taken: list[tuple[int, int, str]] = []
    for s, e, k in found:  # in the order of kinds
        i = bisect.bisect(taken, (s, e, k))
        if (i == 0 or taken[i - 1][1] <= s) and (i == len(taken) or taken[i][0] >= e):
            taken.insert(i, (s, e, k))
    return taken


def _valid_iban(value: str) -> bool:
    v = value.replace(" ", "")
    return 15 <= len(v) <= 34 and iban_check(v[:2], v[4:]) == v[2:4]


def replaced(text: str, key: bytes, exceptions: dict[tuple[str, str], str]) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with surrogates and the spans found in the original; exceptions: the surrogates that no permutation gives."""
    spans = find(text)
    out, at = [], 0
    for s, e, k in spans:
        made = [exceptions.get(v) or surrogate(*v, key) for v in values_of(k, text[s:e])]
        out += [text[at:s], reformat(k, text[s:e], made)]
        at = e
    return "".join([*out, text[at:]]) if spans else text, spans


def entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The distinct (kind, value) of a table; each batch emits a value once."""

    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        trim()
        for pdf in batches:
            got = {v for t in pdf["text"] if t for s, e, k in find(t) for v in values_of(k, t[s:e])}
            yield pd.DataFrame(sorted(got), columns=["kind", "value"])
        trim()

    return docs.select(F.col(text_col).alias("text")).mapInPandas(each, "kind string, value string").dropDuplicates()


def _ranked(df: DataFrame, salt: Column, order: list[str]) -> DataFrame:
    """Adds rank, from 0, within each format: salted groups are numbered each on its own, so no format meets in one task."""
    salted = df.withColumn("salt", salt)
    sizes = salted.groupBy("format", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("format").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("format", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("format", "salt").orderBy(*order)) - 1
    return salted.withColumn("own", own).join(starts, ["format", "salt"]).withColumn("rank", F.col("own") + F.col("before")).drop("salt", "own", "before")


def resolve(values: DataFrame, key: bytes) -> DataFrame:
    """kind, value, made of the values whose surrogate by permutation is a value of the corpus or another's surrogate.

    values: distinct (kind, value), written.  Nothing is collected but whether any are left.
    """

    @F.pandas_udf("struct<format:string,made:string>")
    def make(kind: pd.Series, value: pd.Series) -> pd.DataFrame:
        made = [surrogate(k, v, key) for k, v in zip(kind, value, strict=True)]
        formats = [_SEP.join([mode, *each]) for mode, each, _ in (layout(k, v) for k, v in zip(kind, value, strict=True))]
        return pd.DataFrame({"format": formats, "made": made}, dtype=object)

    every = stash(values.withColumn("x", make("kind", "value")).select("kind", "value", "x.format", "x.made"), "surrogates")
    real = values.select("kind", F.col("value").alias("made"))
    clash = every.join(real, ["kind", "made"], "left_semi").select("kind", "value")
    twice = every.groupBy("kind", "made").agg(F.min("value").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    later = every.join(twice, ["kind", "made"]).where("value <> first").select("kind", "value")
    todo = stash(every.join(clash.union(later).dropDuplicates(), ["kind", "value"], "left_semi").select("kind", "value", "format", F.lit(0).cast("long").alias("tried")), "colliding")
    done = every.where(F.lit(False)).select("kind", "value", "made")  # no rows from the driver: they would be read by Python workers of another kind
    taken = real.union(every.join(todo, ["kind", "value"], "left_anti").select("kind", "made"))
    while todo.take(1):
        need = todo.groupBy("kind", "format").agg(F.max("tried").alias("tried"), F.count(F.lit(1)).alias("n"))

        def groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for kind, form, tried, n in zip(pdf["kind"], pdf["format"], pdf["tried"], pdf["n"], strict=True):
                    last = min(room(form.split(_SEP)[1:]), 1 << 60, max(4 * int(n) + 64, 8 * int(tried)))
                    starts = list(range(int(tried), last, GROUP))
                    for k in range(0, len(starts), 1000):
                        yield pd.DataFrame({"kind": kind, "format": form, "start": starts[k : k + 1000], "end": [min(x + GROUP, last) for x in starts[k : k + 1000]]})

        def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for kind, form, start, end in zip(pdf["kind"], pdf["format"], pdf["start"], pdf["end"], strict=True):
                    mode, *each = form.split(_SEP)
                    yield pd.DataFrame({"kind": kind, "format": form, "n": range(start, end), "made": [nth(mode, each, n, key, "free") for n in range(start, end)]})

        spans = need.mapInPandas(groups, "kind string, format string, start long, end long").repartition("format", "start")
        free = spans.mapInPandas(candidates, "kind string, format string, n long, made string").join(taken, ["kind", "made"], "left_anti")
        free = stash(free.groupBy("kind", "made").agg(F.min(F.struct("format", "n")).alias("x")).select("kind", "made", "x.format", "x.n"), "free")
        free = _ranked(free, F.floor(F.col("n") / GROUP), ["n"]).select("kind", "format", "rank", "made")
        ranked = _ranked(todo, F.pmod(F.xxhash64("value"), F.lit(max(1, todo.count() // GROUP))), ["value"])
        found = stash(ranked.join(free, ["kind", "format", "rank"], "left").select("kind", "value", "format", "tried", "made"), "ranked")
        got = found.where("made is not null").select("kind", "value", "made")
        done, taken = done.union(got), taken.union(got.select("kind", "made"))

        @F.pandas_udf("struct<format:string,tried:long>")
        def further(form: pd.Series, tried: pd.Series, n: pd.Series) -> pd.DataFrame:
            out = []
            for f, t, k in zip(form, tried, n, strict=True):
                mode, *each = f.split(_SEP)
                last = max(4 * int(k) + 64, 8 * int(t))
                if last >= room(each):
                    more = longer(mode, each)
                    if more is None:
                        raise ValueError(f"a format of {room(each)} values has no room for surrogates: {mode}")
                    out.append((_SEP.join([mode, *more]), 0))
                else:
                    out.append((f, last))
            return pd.DataFrame(out, columns=["format", "tried"])

        rest = found.where("made is null").select("kind", "value", "format").join(need, ["kind", "format"])
        todo = stash(rest.select("kind", "value", further("format", "tried", "n").alias("x")).select("kind", "value", "x.format", "x.tried"), "colliding")
    return stash(done, "exceptions")


def replace_pii(docs: DataFrame, key: bytes, text_col: str = "text", max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """docs with surrogates in text_col and the columns n_entities and entities (kind:start:end in the original, comma-joined).

    All other columns pass through, named as they are; columns of these two names are replaced.  A
    null text stays null with no entities; an empty one stays empty.  Repeated rows and values get the
    same surrogates.  The key, 1 to 64 bytes, is a secret of the caller: without it no surrogate can be
    undone.  Two passes over the texts, which do not move; only distinct values are shuffled.
    """
    if not key:
        raise ValueError("surrogates need a key")
    exceptions = resolve(stash(entities(docs, text_col), "entities"), key)
    result = "struct<text:string,n:int,spans:string>"

    def table(done: list) -> pd.DataFrame:
        spans = [",".join(f"{k}:{s}:{e}" for s, e, k in found) for _, found in done]
        return pd.DataFrame({"text": pd.Series([t for t, _ in done], dtype=object), "n": [len(found) for _, found in done], "spans": pd.Series(spans, dtype=object)})

    if exceptions.count() <= max_broadcast:
        held = {(r.kind, r.value): r.made for r in exceptions.collect()}

        @F.pandas_udf(result)
        def each(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                for k in range(0, len(texts), TEXTS):
                    yield table([(t, []) if t is None else replaced(t, key, held) for t in texts[k : k + TEXTS]])
            trim(surrogate, alphabet)

        base, done = docs, each(F.col(text_col))
    else:

        def mentioned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                rows = {(h, *v) for h, t in zip(pdf["hash"], pdf["text"], strict=True) if t for s, e, k in find(t) for v in values_of(k, t[s:e])}
                yield pd.DataFrame(sorted(rows), columns=["hash", "kind", "value"])

        @F.pandas_udf(result)
        def by_text(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
            for texts, rows in batches:
                for k in range(0, len(texts), TEXTS):
                    maps = ({} if r is None else {(x["kind"], x["value"]): x["made"] for x in r} for r in rows[k : k + TEXTS])
                    yield table([(t, []) if t is None else replaced(t, key, m) for t, m in zip(texts[k : k + TEXTS], maps, strict=True)])
            trim(surrogate, alphabet)

        # Texts are known by a hash; where two share one, both get the exceptions of both, which does no harm.
        texts = docs.select(F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text"))
        held = texts.mapInPandas(mentioned, "hash long, kind string, value string").dropDuplicates().join(exceptions, ["kind", "value"])
        hash_name, rows_name = unused(docs, "hash"), unused(docs, "rows")
        own = held.groupBy(F.col("hash").alias(hash_name)).agg(F.collect_list(F.struct("kind", "value", "made")).alias(rows_name))
        base = docs.withColumn(hash_name, F.xxhash64(text_col)).join(own, hash_name, "left")
        done = by_text(F.col(text_col), F.col(rows_name))

    name = unused(base, "done")
    out = base.withColumn(name, done)
    kept = [F.col(f"{name}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("n_entities", "entities")]
    return out.select(*kept, F.col(f"{name}.n").alias("n_entities"), F.col(f"{name}.spans").alias("entities"))
