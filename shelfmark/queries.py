"""The catalogue's queries over the driver's tables, each with its equivalent in SQL where there is one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import bib as B
from shelfmark.functions import fields as X
from shelfmark.functions import keys as K
from shelfmark.functions import score as S
from shelfmark.functions import text as T
from shelfmark.operators import harvest as V
from shelfmark.operators import similar as M
from shelfmark.operators import structure as N
from shelfmark.operators.blocks import common_token_pairs, count_common_token
from shelfmark.operators.index import BookIndex
from shelfmark.operators.overlap import overlap_candidates, overlap_pairs, ranked_tokens
from shelfmark.plans.compare import compare, derived_books
from shelfmark.plans.metrics import Metrics
from shelfmark.schema import as_books
from shelfmark.scratch import scratch_dir, stash
from shelfmark.sources import html as H
from shelfmark.sources import payloads as P
from shelfmark.sources.store import BookStore
from shelfmark.streaming import state as W

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under a name, with its SQL."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- SQL of the derived catalogue and its keys -----------------------------------------------

_BOOKS = r"""
raw_books AS (SELECT *, list_filter(string_split_regex(text, '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
parts AS (
  SELECT *, CASE WHEN doc_id % 8 < 5 THEN array_to_string(w[1:doc_id % 8 + 1], ' ') WHEN doc_id % 8 = 5 THEN array_to_string(w[1:2], ' ') || ', ' || array_to_string(w[3:4], ' ')
                 WHEN doc_id % 8 = 6 THEN coalesce(w[1], '') || coalesce(' ' || upper(left(w[2], 1)) || '.', '') || coalesce(' ' || upper(left(w[3], 1)) || '.', '') ELSE array_to_string(w[1:2], ' ') END AS a,
         array_to_string(w[3:14], ' ') AS n, 'Verlag ' || lang || CASE WHEN doc_id % 4 = 1 THEN ' Nord' ELSE '' END AS p
  FROM raw_books),
books AS (
  SELECT lpad(CAST(doc_id AS VARCHAR), 12, '0') AS Id, CAST(doc_id AS VARCHAR) AS ExternalId, source AS ElsName,
         CASE WHEN doc_id % 5 = 0 THEN '' ELSE a END AS Authors, n AS Name, p AS Publisher,
         a || ' ' || n || ' ' || p || CASE WHEN doc_id % 3 = 1 THEN ' Verlag de' ELSE '' END || CASE WHEN doc_id % 6 = 2 THEN ' Zorin A. B.' ELSE '' END AS Bib,
         doc_id % 3 = 0 AS Compared, CASE WHEN doc_id % 9 = 0 THEN 1 ELSE 0 END AS stored
  FROM parts)"""
_STOP = ", ".join(f"'{w}'" for w in sorted({w.lower() for w in T.AUTHOR_STOP_WORDS}))


def _name_parts(column: str) -> str:
    """Words of a name that are longer than two characters, without stems and digits."""
    stems = T.STEMS
    kept = f"list_filter(string_split_regex(regexp_replace(lower({column}), '{stems}', '', 'g'), '[^\\p{{L}}\\p{{N}}_]'), lambda t: length(t) > 2)"
    return f"list_transform({kept}, lambda t: regexp_replace(t, '[0-9]', '', 'g'))"


def _first_of_each(items: str, key: str = "x") -> str:
    """A list without later repetitions, in its order; key: what makes two items one."""
    keys = f"list_transform({items}, lambda x: {key})"
    return f"list_filter({items}, lambda x, i: list_position({keys}, {key}) = i)"


def _orders(n: int) -> str:
    """The keys of a name of n words in SQL: the first of each order in full, the others by their first characters."""
    one = lambda p: " || ".join(f"aw[{i + 1}]" if k == 0 else f"left(aw[{i + 1}], 1)" for k, i in enumerate(p))
    return "[" + ", ".join(map(one, K.permutation_indexes(n))) + "]"


def _keys(source: str) -> str:
    """Keys of the comparable books of a table."""
    return rf"""
split_keys AS (
  SELECT *, {_name_parts("Name")} AS parts,
         list_transform(list_filter(string_split_regex(lower(Authors), '[,;:]'), lambda a: a <> ''),
                        lambda a: list_filter(string_split_regex(a, '[^\p{{L}}\p{{N}}_]'), lambda t: t <> '' AND NOT list_contains([{_STOP}], t))) AS aws
  FROM {source}),
all_keys AS (
  SELECT *, flatten(list_transform(aws, lambda aw:
              CASE WHEN len(aw) = 0 THEN CAST([] AS VARCHAR[])
                   WHEN len(aw) > 4 OR len(aw) IN (2, 3) AND length(aw[1]) <> 1 AND len(list_filter(aw[2:], lambda t: length(t) <> 1)) = 0
                     THEN [aw[1] || array_to_string(list_transform(aw[2:], lambda t: left(t, 1)), '')]
                   WHEN len(aw) = 1 THEN {_orders(1)} WHEN len(aw) = 2 THEN {_orders(2)} WHEN len(aw) = 3 THEN {_orders(3)}
                   ELSE {_orders(4)} END)) AS every_key
  FROM split_keys),
keys AS (
  SELECT *, regexp_replace(array_to_string(parts, ''), '[{T.VOWELS}]', '', 'g') AS name_key,
         list_filter(list_transform(parts, lambda t: regexp_replace(t, '[{T.VOWELS}]', '', 'g')), lambda t: t <> '') AS token_list,
         {_first_of_each("every_key")} AS author_keys
  FROM all_keys),
keyed AS (SELECT *, list_distinct(token_list) AS name_tokens FROM keys WHERE trim(Authors) <> '' AND trim(Name) <> '')"""


_KEYS = _keys("books")
# One ASCII character, of none that a key has, for each letter beyond ASCII: a distance in bytes is then one in characters.
_ASCII = "translate({}, 'ßäçèéêíñóöüàâîïôùûúá', 'ABCDEFGHIJKLMNOPQRST')"
_PAIRS = """
posting AS (SELECT DISTINCT Id, unnest(name_tokens) AS token FROM keyed),
candidates AS (SELECT DISTINCT p.Id AS a, q.Id AS b FROM posting p JOIN posting q ON p.token = q.token AND p.Id < q.Id)"""


def _lev(a: str, b: str) -> str:
    longest = f"greatest(length({a}), length({b}))"
    return f"(levenshtein({_ASCII.format(a)}, {_ASCII.format(b)}) / CAST({longest} AS DOUBLE))"


_SCORED = rf"""
directed AS (SELECT a, b FROM candidates UNION ALL SELECT b, a FROM candidates),
first_hit AS (
  SELECT d.a, d.b, arg_min(h.diff, h.i * 1000 + h.j) AS author_diff
  FROM directed d JOIN keyed x ON x.Id = d.a JOIN keyed y ON y.Id = d.b,
       LATERAL (SELECT i, j, {_lev("x.author_keys[i]", "y.author_keys[j]")} AS diff
                FROM (SELECT unnest(range(1, len(x.author_keys) + 1)) AS i) ii, (SELECT unnest(range(1, len(y.author_keys) + 1)) AS j) jj) h
  WHERE h.diff <= 0.3 GROUP BY d.a, d.b),
scored AS (
  SELECT f.a, f.b, f.author_diff, {_lev("x.name_key", "y.name_key")} AS name_diff,
         CASE WHEN least(len(x.name_tokens), len(y.name_tokens)) >= 5
              THEN 1.0 - len(list_intersect(x.name_tokens, y.name_tokens)) / CAST(least(len(x.name_tokens), len(y.name_tokens)) AS DOUBLE) END AS overlap_diff,
         x.Compared AS old_a
  FROM first_hit f JOIN keyed x ON x.Id = f.a JOIN keyed y ON y.Id = f.b),
forward AS (
  SELECT a AS from_id, b AS to_id, (author_diff + CASE WHEN name_diff <= 0.3 THEN name_diff ELSE overlap_diff END) / 2 AS coeff
  FROM scored WHERE NOT old_a AND (name_diff <= 0.3 OR overlap_diff <= 0.4)),
edges AS (SELECT from_id, to_id, coeff FROM forward UNION SELECT to_id, from_id, coeff FROM forward)"""
_LINKING = f"WITH {_BOOKS.strip()}, {_KEYS.strip()}, {_PAIRS.strip()}, {_SCORED.strip()}"

_AUTHORS = rf"""
author_words AS (
  SELECT list_filter(string_split_regex(author, '[^\p{{L}}\p{{N}}]'), lambda x: x <> '' AND try_cast(x AS INTEGER) IS NULL AND regexp_matches(x, '^\p{{Lu}}')
         AND NOT list_contains([{_STOP}], lower(x))) AS ts FROM (SELECT unnest(string_split_regex(Authors, '[,;:]')) AS author FROM books)),
author_dict AS (SELECT DISTINCT author FROM (SELECT unnest(list_filter(ts, lambda x: length(x) > 2)) AS author FROM author_words WHERE len(ts) BETWEEN 2 AND 4))"""
_BIB_STOP = ", ".join(f"'{w}'" for w in sorted({w.lower() for w in T.BIB_STOP_WORDS}))
_W = r"[\p{L}\p{N}_]"


def _beside_initials(pattern: str, name: int, a: int, b: int) -> str:
    """Capitalised words beside capital initials in SQL."""
    of = lambda g: f"regexp_extract_all(rest, '{pattern}', {g})"
    upper = lambda x: f"(coalesce({x}, '') = '' OR regexp_matches(trim({x}), '^\\p{{Lu}}'))"
    good = f"length(x.name) > 2 AND regexp_matches(x.name, '^\\p{{Lu}}') AND NOT list_contains([{_STOP}], lower(x.name)) AND {upper('x.a')} AND {upper('x.b')}"
    zipped = f"list_transform(range(1, len({of(name)}) + 1), lambda i: struct_pack(name := {of(name)}[i], a := {of(a)}[i], b := {of(b)}[i]))"
    return f"list_transform(list_filter({zipped}, lambda x: {good}), lambda x: x.name)"


# Publishers of a description: longest first, of one length that which stands nearer to the end; each is cut out wherever it still stands.
_BIB = rf"""
publisher_dict AS (SELECT DISTINCT lower(Publisher) AS p FROM books),
bib_texts AS (
  SELECT Id, text, ' ' || array_to_string(list_filter(string_split_regex(lower(text), '[^\p{{L}}]'), lambda t: length(t) > 1), ' ') || ' ' AS spoken
  FROM (SELECT Id, trim(regexp_replace(regexp_replace(Bib, '[^\p{{L}}\s.]', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM books)),
bib_hits AS (
  SELECT Id, any_value(text) AS text, coalesce(list(p ORDER BY length(p) DESC, strpos(reverse(spoken), reverse(' ' || p || ' '))) FILTER (WHERE p IS NOT NULL), []) AS hits
  FROM bib_texts LEFT JOIN publisher_dict ON contains(spoken, ' ' || p || ' ') GROUP BY Id),
bib_cut AS (
  SELECT Id, list_reduce(hits, lambda t, q: regexp_replace(t, q, ' ', 'gi'), text) AS rest,
         list_filter(hits, lambda p, i: contains(lower(list_reduce(hits[1:i - 1], lambda t, q: regexp_replace(t, q, ' ', 'gi'), text)), p)) AS found
  FROM bib_hits),
bib_words AS (
  SELECT Id, rest, found, list_filter(string_split_regex(rest, '[^\p{{L}}]'), lambda t: length(t) > 1 AND NOT list_contains([{_BIB_STOP}], lower(t))) AS ts,
         list_concat({_beside_initials(rf"({_W}+)(\s{_W}\.)(\s{_W}\.)?\s", 1, 2, 3)}, {_beside_initials(rf"({_W}\.\s)({_W}\.\s)?({_W}+)", 3, 1, 2)}) AS beside FROM bib_cut),
bib_word AS (SELECT Id, unnest(ts) AS t, generate_subscripts(ts, 1) AS i FROM bib_words),
bib_split AS (
  SELECT Id, coalesce(list(t ORDER BY i) FILTER (WHERE author IS NOT NULL), []) AS known, coalesce(list(t ORDER BY i) FILTER (WHERE author IS NULL), []) AS others
  FROM bib_word LEFT JOIN author_dict ON author = t GROUP BY Id),
bib AS (
  SELECT bib_words.Id, array_to_string(found, ', ') AS bib_publisher,
         CASE WHEN len(known) > 0 THEN array_to_string({_first_of_each("known")}, ', ') ELSE array_to_string({_first_of_each("beside")}, ', ') END AS bib_authors,
         coalesce(CASE WHEN len(known) > 0 THEN array_to_string(others, ' ')
                       ELSE array_to_string(list_filter({_first_of_each("others", "lower(x)")}, lambda x: NOT list_contains(list_transform(beside, lambda y: lower(y)), lower(x))), ' ') END, '') AS bib_name
  FROM bib_words LEFT JOIN bib_split ON bib_split.Id = bib_words.Id),
filled AS (
  SELECT books.* REPLACE (
           CASE WHEN NOT Compared AND trim(Authors) = '' THEN bib_authors ELSE Authors END AS Authors,
           CASE WHEN NOT Compared AND trim(Name) = '' THEN bib_name ELSE Name END AS Name)
  FROM books JOIN bib ON bib.Id = books.Id)"""
_PARSED = f"WITH {_BOOKS.strip()}, {_AUTHORS.strip()}, {_BIB.strip()}"


# --- Sources -----------------------------------------------------------------------------------


@query("q01_stored_ids", f"WITH {_BOOKS.strip()} SELECT ExternalId FROM books WHERE ElsName = 'src1'")
def stored_ids(spark, sf_dir):
    return derived_books(spark, sf_dir).where(F.col("ElsName") == "src1").select("ExternalId")


@query("q02_exclude_projection", f"WITH {_BOOKS.strip()} SELECT ExternalId, ElsName, Authors, Publisher, Name, Bib FROM books")
def exclude_projection(spark, sf_dir):
    return derived_books(spark, sf_dir).drop("ISBN", "ISSN", "Year", "Pages", "Id", "SimilarBooks", "SimilarCount", "Compared")


@query(
    "q03_id_range_batches",
    "SELECT CAST(floor(doc_id / 50.0) AS BIGINT) AS batch, count(*) AS n, min(doc_id) AS least, max(doc_id) AS greatest FROM documents GROUP BY 1",
)
def id_range_batches(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    return V.batches(docs.select(F.col("doc_id").alias("id")), 50)


@query(
    "q04_page_sequence",
    "SELECT source, CAST(p AS INTEGER) AS page, 'https://catalogue.example/' || p AS url FROM (SELECT source, unnest(range(1, count(*) // 10 + 2)) AS p FROM documents GROUP BY source)",
)
def page_sequence(spark, sf_dir):
    total = _table(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    paged = V.page_numbers(total, V.pages_of_total(F.col("n"), 10)).select("source", "page")
    return V.page_urls(paged, "https://catalogue.example/%d")


@query(
    "q05_book_rows",
    "SELECT CAST(o_orderkey AS VARCHAR) AS ExternalId, o_orderstatus AS ElsName, 0 AS Pages, '' AS Year, '' AS Authors FROM orders WHERE o_orderkey IS NOT NULL",
)
def book_rows(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    none = F.lit(None).cast("int")
    rows = orders.select(F.col("o_orderkey").cast("string").alias("ExternalId"), F.col("o_orderstatus").alias("ElsName"), F.coalesce(none, F.lit(0)).alias("Pages"),
                         F.coalesce(none.cast("string"), F.lit("")).alias("Year"), T.str_join(F.lit(None).cast("array<string>"), ", ").alias("Authors"))
    return as_books(rows.dropna(subset=["ExternalId"])).select("ExternalId", "ElsName", "Pages", "Year", "Authors")


# --- HTML ----------------------------------------------------------------------------------------


def _pages(spark, sf_dir):
    return _table(spark, sf_dir, "pages").select("page_id", "url", H.elements("html").alias("dom"))


@query(
    "q06_html_first",
    r"""SELECT page_id, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS title, len(regexp_extract_all(html, '<li>')) AS items,
    regexp_extract(html, '(?s:.*)<a href="[^"]*">([^<]*)</a>', 1) AS last_link FROM pages""",
)
def html_first(spark, sf_dir):
    dom = F.col("dom")
    return _pages(spark, sf_dir).select(
        "page_id", H.first(H.by_tag(dom, "h1"))["text"].alias("title"), F.size(H.by_tag(dom, "li")).cast("long").alias("items"), H.last(H.by_tag(dom, "a"))["text"].alias("last_link")
    )


@query(
    "q07_html_class",
    r"""SELECT page_id, regexp_extract(html, '<div class="ad">([^<]*)</div>', 1) AS ad, CAST(len(regexp_extract_all(html, '<div class="ad">')) AS INTEGER) AS n_equal FROM pages""",
)
def html_class(spark, sf_dir):
    dom = F.col("dom")
    return _pages(spark, sf_dir).select("page_id", H.first(H.by_class(dom, "div", "a"))["text"].alias("ad"), F.size(H.by_class_equal(dom, "div", "ad")).alias("n_equal"))


@query(
    "q08_html_links",
    r"""SELECT page_id, array_to_string(regexp_extract_all(html, '<a href="([^"]*)"', 1), ' ') AS hrefs,
    array_to_string(list_transform(regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a></li>', 1), lambda t: trim(t)), ', ') AS texts,
    regexp_extract(html, '<html lang="([^"]*)"', 1) AS lang FROM pages""",
)
def html_links(spark, sf_dir):
    dom = F.col("dom")
    hrefs = F.array_join(F.transform(H.by_tag(dom, "a"), lambda e: H.attribute(e, "href", "")), " ")
    return _pages(spark, sf_dir).select("page_id", hrefs.alias("hrefs"), H.joined_texts(H.by_tag(dom, "li")).alias("texts"), H.attribute(H.first(H.by_tag(dom, "html")), "lang").alias("lang"))


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows dealt out to all cores: a file of short rows is few splits, however long their pages take."""
    context = rows.sparkSession.sparkContext
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism), key)


@query(
    "q09_html_label_pairs",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS isbn, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y') END AS year, o_orderpriority AS priority, o_orderstatus AS title,
    CAST(o_custkey AS VARCHAR) AS customer FROM orders""",
)
def html_label_pairs(spark, sf_dir):
    """Values beside labels, in rows of two cells and behind a colon, from a page for each order."""
    c = F.col
    year = F.when(c("o_orderkey") % 3 == 0, "").otherwise(F.concat(F.lit('<p><span class="bold-text">Год</span>1900</p><p><span class="bold-text">Год</span> '), F.year("o_orderdate"), F.lit(" </p>")))
    html = F.concat(
        F.lit('<div class="d"><p><span class="bold-text">ISBN</span> '), c("o_orderkey"), F.lit(" </p>"), year, F.lit("</div><table><tr><td>Clerk</td><td>a</td><td>b</td></tr><tr><td> Priority </td><td title="), c("o_orderstatus"), F.lit("> "),
        c("o_orderpriority"), F.lit("</td></tr></table><ul><li>Customer: "), c("o_custkey"), F.lit("</li><li>a: b: c</li></ul>"),
    )
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "o_custkey")
    rows = _dealt(orders, "o_orderkey").select("o_orderkey", H.elements(html).alias("dom"))
    dom = c("dom")
    pairs = rows.select("o_orderkey", H.label_values(H.by_class(dom, "span", "bold-text")).alias("labels"), H.row_pairs(dom, H.first(H.by_tag(dom, "table"))).alias("cells"), H.colon_pairs(H.by_tag(dom, "li")).alias("lines"))
    of = lambda k: T.trim(H.routed(c("labels"), ["ISBN", "Год"], k))
    cells = H.routed(c("cells"), ["Priority"], 0), H.routed(c("cells"), ["Priority"], 0, "title")
    return pairs.select("o_orderkey", of(0).alias("isbn"), of(1).alias("year"), cells[0].alias("priority"), cells[1].alias("title"), H.routed(c("lines"), ["customer"], 0).alias("customer"))


@query(
    "q49_html_children",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS first, CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 + c_custkey % 3 END AS INTEGER) AS n, c_custkey % 5 = 0 AS none FROM customer""",
)
def html_children(spark, sf_dir):
    """The first child and the number of children of the element with an id, from a page for each customer; every fifth page has none."""
    key = F.col("c_custkey")
    name = F.when(key % 5 == 0, "other").otherwise("main")
    more = F.repeat(F.lit("<i>x<u>y</u></i>"), (key % 3).cast("int"))
    html = F.concat(F.lit('<div id="maint"><b>no</b></div><div class="main" id="'), name, F.lit('"><b>'), "c_name", F.lit("</b>"), more, F.lit("</div><p>z</p>"))
    customers = _dealt(_table(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey")
    found = customers.select("c_custkey", H.elements(html).alias("dom")).select("c_custkey", H.children(F.col("dom"), H.by_id(F.col("dom"), "main")).alias("c"))
    return found.select("c_custkey", H.first(F.col("c"))["text"].alias("first"), F.size("c").alias("n"), T.none_or_empty(F.col("c")).alias("none"))


@query("q50_id_range", "SELECT id FROM (SELECT unnest(range(min(o_orderkey), max(o_orderkey) + 11)) AS id FROM orders) WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O')")
def id_range(spark, sf_dir):
    """The ids of a range that are not stored: from the least order to ten beyond the last, without the orders that are not open."""
    orders = _table(spark, sf_dir, "orders")
    least, last = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    stored = orders.where(F.col("o_orderstatus") != "O").select(F.col("o_orderkey").alias("id"))
    return V.new_items(V.id_range(spark, least, last + 11), stored, ["id"])


@query("q10_pager_max", "SELECT p_partkey, CAST(CASE WHEN p_partkey % 7 = 0 THEN 1 ELSE greatest(2, p_size) END AS INTEGER) AS n FROM part")
def pager_max(spark, sf_dir):
    """The last page by the texts of a pager, one for each part; some have no number, and some parts no pager."""
    key = F.col("p_partkey")
    texts = F.when(key % 14 == 0, F.lit(None).cast("string")).when(key % 7 == 0, F.col("p_brand")).otherwise(F.concat(F.lit("1, 2,"), F.col("p_size"), F.lit(","), F.col("p_name"), F.lit(",»")))
    return _table(spark, sf_dir, "part").select("p_partkey", V.pages_of_pager(F.split(texts, ",")).alias("n"))


@query(
    "q45_html_descendants",
    r"""WITH lists AS (SELECT page_id, unnest(regexp_extract_all(html, '(?s)<ul>.*?</ul>')) AS ul FROM pages),
    within AS (SELECT page_id, 'li' AS tag, 1 AS depth, len(regexp_extract_all(ul, '<li>')) AS n FROM lists
               UNION ALL SELECT page_id, 'a', 2, len(regexp_extract_all(ul, '<li><a [^>]*>')) FROM lists)
    SELECT page_id, tag, depth, CAST(sum(n) AS BIGINT) AS n, count(*) AS lists FROM within WHERE n > 0 GROUP BY ALL""",
)
def html_descendants(spark, sf_dir):
    """Items and links below the lists of a page, with their depth."""
    below = N.descendants(N.intervals(_pages(spark, sf_dir), "page_id", F.col("dom")), F.col("tag") == "ul", F.col("tag").isin("li", "a"))
    by_list = below.groupBy("page", "ancestor", "tag", "depth").agg(F.count(F.lit(1)).alias("n"))
    return by_list.groupBy(F.col("page").alias("page_id"), "tag", "depth").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("lists"))


# --- URLs, JSON, XML -----------------------------------------------------------------------------


@query(
    "q11_url_ids",
    r"""WITH p AS (SELECT page_id, url, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
    s AS (SELECT *, regexp_extract(regexp_replace(path, '/$', ''), '([^/]*)$', 1) AS segment FROM p)
    SELECT page_id, CAST(try_cast(split_part(segment, '.', 1) AS BIGINT) AS VARCHAR) AS id, starts_with(path, '/en/') AS english,
           nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page FROM s""",
)
def url_ids(spark, sf_dir):
    url = F.col("url")
    return _table(spark, sf_dir, "pages").select(
        "page_id", X.numeric_id(F.get(F.split(X.segment_before_slash(url), r"\."), 0)).alias("id"), X.path_starts_with(url, "/en/").alias("english"), X.query_parameter(url, "page").alias("page")
    )


@query("q12_sitemap_xml", "SELECT 'https://c.example/book/' || CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment || '-x' ELSE c_mktsegment || '-' || c_custkey END AS link, CASE WHEN c_custkey % 5 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS id FROM customer")
def sitemap_xml(spark, sf_dir):
    """Links and ids of sitemaps, one for each thousand customers."""
    name = F.concat(F.lit("https://c.example/book/"), "c_mktsegment", F.lit("-"), F.when(F.col("c_custkey") % 5 == 0, "x").otherwise(F.col("c_custkey").cast("string")))
    located = _table(spark, sf_dir, "customer").select(F.floor(F.col("c_custkey") / 1000).alias("part"), F.concat(F.lit("<url><loc>"), name, F.lit("</loc></url>")).alias("url"))
    maps = located.groupBy("part").agg(F.concat(F.lit('<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">'), F.array_join(F.collect_list("url"), ""), F.lit("</urlset>")).alias("xml"))
    return maps.select(F.explode(P.sitemap_urls(F.col("xml"))).alias("link")).select("link", X.numeric_id(X.last_segment(F.col("link"), "-", -1)).alias("id"))


@query("q13_json_paths", "SELECT event_id, json_extract_string(props, '$.k') AS k, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS n FROM events")
def json_paths(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", P.json_path(F.col("props"), "k").alias("k"), P.from_payload(F.col("props"), "struct<k:string>")["k"].try_cast("int").alias("n"))


@query("q13b_categories", "SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer")
def categories(spark, sf_dir):
    """Categories of the menus of start pages, one page for each thousand customers, in the two spellings that occur."""
    from shelfmark.sources.connectors import bookru_categories

    key, even = F.col("c_custkey"), F.col("part") % 2 == 0
    as_json = lambda i, n: F.to_json(F.struct(key.cast("string").alias(i), F.col("c_name").alias(n)))
    numbered = _table(spark, sf_dir, "customer").withColumn("part", F.floor(key / 1000))
    each = numbered.select("part", F.when(even, as_json("Id", "Name")).otherwise(as_json("id", "name")).alias("entry"))
    pages = each.groupBy("part").agg(F.array_join(F.collect_list("entry"), ",").alias("entries"))
    menus = F.concat(F.when(even, '{"Menu":[{"Id":"new","Name":"n"},').otherwise('{"menu":[{"id":"new","name":"n"},'), "entries", F.lit("]}"))
    page = F.concat(F.lit('<html><script id="__NEXT_DATA__" type="application/json">{"props":{"pageProps":{"serverMenu":['), menus, F.lit("]}}}</script></html>"))
    return bookru_categories(pages.select(page.alias("payload")))


# --- Joins with what is stored -------------------------------------------------------------------


@query(
    "q14_new_ids_antijoin",
    "SELECT DISTINCT l_orderkey AS id FROM lineitem WHERE l_orderkey IS NOT NULL AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
)
def new_ids(spark, sf_dir):
    found = _table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("id"))
    stored = _table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("id"))
    return V.new_items(found, stored, ["id"])


@query("q15_bib_lookup", "SELECT c_custkey, n_name AS value FROM customer LEFT JOIN nation ON 'nation:' || c_nationkey = 'nation:' || n_nationkey")
def bib_lookup(spark, sf_dir):
    entries = _table(spark, sf_dir, "nation").select(F.concat(F.lit("nation:"), F.col("n_nationkey")).alias("key"), F.col("n_name").alias("value"))
    customers = _table(spark, sf_dir, "customer")
    return V.lookup(customers, entries, F.concat(F.lit("nation:"), F.col("c_nationkey"))).select("c_custkey", "value")


@query(
    "q42_store_updates",
    """SELECT CAST(o_orderkey AS VARCHAR) AS Id, o_orderstatus AS ElsName, CAST(coalesce(n, 0) AS INTEGER) AS Pages, CASE WHEN o_orderstatus = 'O' THEN 'open' END AS Publisher
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey WHERE o_orderkey IS NOT NULL""",
)
def store_updates(spark, sf_dir):
    store = BookStore(spark, f"{scratch_dir(spark).rstrip('/')}/shelfmark/books-{uuid.uuid4().hex}")
    key = F.col("o_orderkey").cast("string")
    orders = _table(spark, sf_dir, "orders").select(key.alias("Id"), key.alias("ExternalId"), F.col("o_orderstatus").alias("ElsName"), F.lit(0).alias("Pages"))
    lines = _table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("Id")).agg(F.count(F.lit(1)).cast("int").alias("Pages"))
    done = F.col("ElsName") == "F"
    steps = [store.create_many(orders.where(done)), store.create_many(orders.where(~done)), store.update_many(lines), store.update(F.col("ElsName") == "O", Publisher="open")]
    if not all(steps):
        raise RuntimeError("the store did not take a change")
    return store.read(columns=["Id", "ElsName", "Pages", "Publisher"])


# --- Streams and figures ---------------------------------------------------------------------------


def _scratch(spark, name):
    return f"{scratch_dir(spark).rstrip('/')}/shelfmark/{name}-{uuid.uuid4().hex}"


def _stream(spark, path, like, files=1_000):
    return spark.readStream.schema(like.schema).option("maxFilesPerTrigger", files).parquet(path)


@query(
    "q46_count_windows",
    """SELECT source AS key, batch, count(*) AS n, min(doc_id) AS least, max(doc_id) AS greatest
    FROM (SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 7 AS batch FROM documents) GROUP BY source, batch""",
)
def count_windows(spark, sf_dir):
    """The documents of every source in batches of seven by a stream; a restarted one hears that sources are complete and flushes the rests."""
    docs = _table(spark, sf_dir, "documents").select("source", "doc_id")
    source, out, state = (_scratch(spark, n) for n in ("arrivals", "windows", "state"))
    rows = W.numbered(docs, F.col("source"), F.col("doc_id"), F.col("doc_id"))
    rows.write.parquet(source)
    done = rows.select("key").distinct().select("key", F.lit(None).cast("long").alias("seq"), F.lit(None).cast("string").alias("item"), F.lit(True).alias("done"))
    for step in (0, 1):
        if step:
            done.write.mode("append").parquet(source)
        batches = W.count_windows(_stream(spark, source, rows), 7)
        W.run_all(batches.writeStream.format("parquet").option("path", out).option("checkpointLocation", state), spark)
    return spark.read.parquet(out).groupBy("key", "batch").agg(F.count(F.lit(1)).alias("n"), F.min("seq").alias("least"), F.max("seq").alias("greatest"))


@query("q47_seen_once", "SELECT event_id, event_type, 1 AS n FROM events")
def seen_once(spark, sf_dir):
    """Events that are replayed with overlap, in two runs of one stream: each is taken once, after the restart too."""
    events = _table(spark, sf_dir, "events").select("event_id", "event_type")
    source, out, state = (_scratch(spark, n) for n in ("replay", "events", "seen"))
    part = F.col("event_id") % 4
    for some in (events.where(part < 2).union(events.where(part == 1)), events.where(part > 0)), (events.where(part == 3), events):
        for rows in some:
            rows.write.mode("append").parquet(source)
        W.run_all(W.seen_once(_stream(spark, source, events, 4), ["event_id"]).writeStream.format("parquet").option("path", out).option("checkpointLocation", state), spark)
    return spark.read.parquet(out).groupBy("event_id", "event_type").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query(
    "q48_metrics",
    f"""WITH {_BOOKS.strip()}, {_KEYS.strip()}, {_PAIRS.strip()}, {_AUTHORS.strip()}
    SELECT 'books' AS step, unnest(['rows', 'least', 'greatest']) AS figure, unnest([count(*), min(doc_id), max(doc_id)]) AS value FROM documents
    UNION ALL SELECT 'comparable', 'rows', count(*) FROM keyed
    UNION ALL SELECT 'publishers', 'rows', count(DISTINCT lower(Publisher)) FROM books
    UNION ALL SELECT 'authors', 'rows', count(*) FROM author_dict
    UNION ALL SELECT 'index', unnest(['rows', 'books']), unnest([count(*), count(*) FILTER (WHERE first)]) FROM (SELECT row_number() OVER (PARTITION BY Id) = 1 AS first FROM posting)""",
)
def metrics(spark, sf_dir):
    """Sizes of the books, dictionaries and index of a comparison, told by the jobs that write them."""
    seen = Metrics()
    number = F.col("ExternalId").cast("long")
    books = stash(seen.of(derived_books(spark, sf_dir), "books", least=F.min(number), greatest=F.max(number)), "books")
    keyed = stash(seen.of(M.with_keys(books), "comparable"), "keyed")
    stash(seen.of(B.publisher_dictionary(books), "publishers"), "publishers")
    stash(seen.of(B.author_dictionary(books), "authors"), "authors")
    postings = keyed.select("Id", F.posexplode("name_tokens").alias("at", "token"))
    stash(seen.of(postings, "index", books=F.count_if(F.col("at") == 0)), "postings")
    return seen.table(spark)


# --- Descriptions --------------------------------------------------------------------------------


@query("q16_publisher_dict", f"WITH {_BOOKS.strip()} SELECT DISTINCT lower(Publisher) AS publisher FROM books")
def publisher_dict(spark, sf_dir):
    return B.publisher_dictionary(derived_books(spark, sf_dir))


@query("q17_author_dict", f"WITH {_BOOKS.strip()}, {_AUTHORS.strip()} SELECT author FROM author_dict")
def author_dict(spark, sf_dir):
    return B.author_dictionary(derived_books(spark, sf_dir))


def _parsed(spark, sf_dir):
    books = derived_books(spark, sf_dir)
    parsed = B.parse_bib(books.select(F.col("Id").alias("id"), "Bib"), B.author_dictionary(books), B.publisher_dictionary(books))
    return parsed.select("id", "bib_authors", "bib_name", "bib_publisher")


@query("q18_bib_publishers", f"{_PARSED} SELECT Id AS id, bib_publisher FROM bib")
def bib_publishers(spark, sf_dir):
    return _parsed(spark, sf_dir).select("id", "bib_publisher")


@query("q19_bib_authors_name", f"{_PARSED} SELECT Id AS id, bib_authors, bib_name FROM bib")
def bib_authors_name(spark, sf_dir):
    return _parsed(spark, sf_dir).select("id", "bib_authors", "bib_name")


@query("q20_bib_fill", f"{_PARSED} SELECT Id AS id, Authors, Name, Publisher FROM filled")
def bib_fill(spark, sf_dir):
    books = derived_books(spark, sf_dir).withColumnRenamed("Id", "id")
    return B.fill_gaps(books).select("id", "Authors", "Name", "Publisher")


@query("q21_comparable", f"WITH {_BOOKS.strip()} SELECT Id, trim(Authors) <> '' AND trim(Name) <> '' AS comparable FROM books")
def comparable(spark, sf_dir):
    return derived_books(spark, sf_dir).select("Id", K.comparable(F.col("Authors"), F.col("Name")).alias("comparable"))


# --- Keys ----------------------------------------------------------------------------------------


@query(
    "q22_full_clean",
    f"SELECT p_partkey, regexp_replace(array_to_string({_name_parts('p_name')}, ''), '[{T.VOWELS}]', '', 'g') AS k FROM part",
)
def full_clean(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", T.full_clean(F.lower("p_name")).alias("k"))


@query("q23_author_keys", f"WITH {_BOOKS.strip()}, {_KEYS.strip()} SELECT Id, array_to_string(author_keys, ',') AS author_keys FROM keyed")
def author_keys(spark, sf_dir):
    return M.with_keys(derived_books(spark, sf_dir)).select("Id", F.array_join("author_keys", ",").alias("author_keys"))


@query("q24_name_key", f"WITH {_BOOKS.strip()}, {_KEYS.strip()} SELECT Id, name_key FROM keyed")
def name_key(spark, sf_dir):
    return M.with_keys(derived_books(spark, sf_dir)).select("Id", "name_key")


@query("q25_name_tokens", f"WITH {_BOOKS.strip()}, {_KEYS.strip()} SELECT Id, array_to_string(list_sort(name_tokens), ' ') AS name_tokens FROM keyed")
def name_tokens(spark, sf_dir):
    return M.with_keys(derived_books(spark, sf_dir)).select("Id", F.array_join(F.sort_array("name_tokens"), " ").alias("name_tokens"))


@query(
    "q26_inverted_index",
    f"WITH {_BOOKS.strip()}, {_KEYS.strip()}, {_PAIRS.strip()} SELECT token, count(*) AS n, min(Id) AS first_id FROM posting GROUP BY token",
)
def inverted_index(spark, sf_dir):
    index = M.inverted_index(M.with_keys(derived_books(spark, sf_dir)))
    return index.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"))


@query("q27_candidates", f"WITH {_BOOKS.strip()}, {_KEYS.strip()}, {_PAIRS.strip()} SELECT a, b FROM candidates")
def candidates(spark, sf_dir):
    return M.candidates(M.with_keys(derived_books(spark, sf_dir)))


# --- Scores --------------------------------------------------------------------------------------


@query(
    "q28_lev_pairs",
    f"WITH {_BOOKS.strip()}, {_KEYS.strip()}, {_PAIRS.strip()}, d AS (SELECT a, b, {_lev('x.name_key', 'y.name_key')} AS diff FROM candidates "
    "JOIN keyed x ON x.Id = a JOIN keyed y ON y.Id = b) SELECT a, b, round(diff, 6) AS diff FROM d WHERE diff <= 0.3",
)
def lev_pairs(spark, sf_dir):
    s = S.name_edit_score(F.col("ka"), F.col("kb"))
    return common_token_pairs(M.with_keys(derived_books(spark, sf_dir)), edit=S.EDIT_BORDER).withColumn("s", s).where("s.success").select("a", "b", F.round("s.diff", 6).alias("diff"))


@query(
    "q29_author_first_hit",
    f"{_LINKING} SELECT a, b, round(author_diff, 6) AS diff FROM first_hit WHERE a < b",
)
def author_first_hit(spark, sf_dir):
    keyed = stash(M.with_keys(derived_books(spark, sf_dir)).select("Id", "Compared", "author_keys", "name_key", "name_tokens"), "keyed")
    side = lambda x: keyed.select(F.col("Id").alias(x), F.col("author_keys").alias(f"k{x}"), F.col("name_tokens").alias(f"t{x}"))
    pairs = M.near_candidates(keyed, compared=True).join(side("a"), "a").join(side("b"), "b").where(F.arrays_overlap("ta", "tb"))
    return pairs.withColumn("s", S.author_score(F.col("ka"), F.col("kb"))).where("s.success").select("a", "b", F.round("s.diff", 6).alias("diff"))


@query(
    "q30_overlap_pairs",
    f"WITH {_BOOKS.strip()}, {_KEYS.strip()}, {_PAIRS.strip()}, d AS (SELECT a, b, 1.0 - len(list_intersect(x.name_tokens, y.name_tokens)) / "
    "CAST(least(len(x.name_tokens), len(y.name_tokens)) AS DOUBLE) AS diff, least(len(x.name_tokens), len(y.name_tokens)) AS n FROM candidates "
    "JOIN keyed x ON x.Id = a JOIN keyed y ON y.Id = b) SELECT a, b, round(diff, 6) AS diff FROM d WHERE n >= 5 AND diff <= 0.4",
)
def overlaps(spark, sf_dir):
    return overlap_pairs(M.with_keys(derived_books(spark, sf_dir))).select("a", "b", F.round("diff", 6).alias("diff"))


@query(
    "q44_overlap_filter",
    f"""WITH {_BOOKS.strip()}, {_KEYS.strip()}, {_PAIRS.strip()},
    each AS (SELECT Id, len(name_tokens) AS size, unnest(name_tokens) AS token FROM keyed WHERE len(name_tokens) >= 5),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY Id ORDER BY n, token) - 1 AS place, CAST(ceil(size * 0.6 - 1e-9) AS INTEGER) AS need
               FROM each JOIN (SELECT token, count(*) AS n FROM each GROUP BY token) USING (token)),
    asked AS (SELECT DISTINCT p.Id AS a, q.Id AS b FROM ranked p JOIN ranked q ON p.token = q.token AND (p.size < q.size OR p.size = q.size AND p.Id < q.Id)
              AND p.place <= p.size - p.need AND least(p.size - p.place, q.size - q.place) >= p.need),
    passed AS (SELECT a, b FROM asked JOIN keyed x ON x.Id = a JOIN keyed y ON y.Id = b WHERE 1.0 - len(list_intersect(x.name_tokens, y.name_tokens)) / CAST(len(x.name_tokens) AS DOUBLE) <= 0.4)
    SELECT 'common token' AS what, count(*) AS pairs FROM candidates JOIN keyed x ON x.Id = a JOIN keyed y ON y.Id = b WHERE least(len(x.name_tokens), len(y.name_tokens)) >= 5
    UNION ALL SELECT 'prefix filter', count(*) FROM asked UNION ALL SELECT 'overlap', count(*) FROM passed""",
)
def overlap_filter(spark, sf_dir):
    """How many pairs have a common token, pass the prefix filter, and pass the test."""
    keyed = stash(M.with_keys(derived_books(spark, sf_dir)).select("Id", "name_key", "name_tokens"), "keyed")
    ranked = stash(ranked_tokens(keyed), "ranked")
    count = lambda df, what: df.agg(F.count(F.lit(1)).alias("pairs")).select(F.lit(what).alias("what"), "pairs")
    any_token = count_common_token(keyed.where(F.size("name_tokens") >= 5)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pairs")).select(F.lit("common token").alias("what"), "pairs")
    return any_token.union(count(overlap_candidates(ranked), "prefix filter")).union(count(overlap_pairs(keyed), "overlap"))


# --- Links ---------------------------------------------------------------------------------------


@query("q31_similar_edges", f"{_LINKING} SELECT from_id, to_id, round(coeff, 6) AS coeff FROM edges")
def similar_edges(spark, sf_dir):
    edges = M.similar_edges(M.with_keys(derived_books(spark, sf_dir)))
    return edges.select("from_id", "to_id", F.round("coeff", 6).alias("coeff"))


@query("q32_similar_count", f"{_LINKING} SELECT Id, CAST(count(from_id) + any_value(stored) AS INTEGER) AS n FROM books LEFT JOIN edges ON from_id = Id GROUP BY Id")
def similar_count(spark, sf_dir):
    books = stash(derived_books(spark, sf_dir), "books")
    maps = M.similar_maps(books, M.similar_edges(M.with_keys(books)))
    return maps.select("Id", F.col("SimilarCount").alias("n"))


@query(
    "q33_similar_map",
    f"{_LINKING} SELECT from_id AS Id, o.ElsName AS els, to_id AS BookId, o.ExternalId, round(coeff, 6) AS coeff FROM edges JOIN books o ON o.Id = to_id "
    "UNION ALL SELECT Id, 'stored', lpad(CAST(CAST(ExternalId AS BIGINT) + 1 AS VARCHAR), 12, '0'), CAST(CAST(ExternalId AS BIGINT) + 1 AS VARCHAR), 0.125 FROM books WHERE stored = 1",
)
def similar_map(spark, sf_dir):
    books = stash(derived_books(spark, sf_dir), "books")
    maps = M.similar_maps(books, M.similar_edges(M.with_keys(books)))
    each = maps.select("Id", F.explode("SimilarBooks").alias("els", "links")).select("Id", "els", F.explode("links").alias("x"))
    return each.select("Id", "els", "x.BookId", "x.ExternalId", F.round("x.Coeff", 6).alias("coeff"))


@query("q34_incremental", f"{_LINKING} SELECT from_id, to_id, round(coeff, 6) AS coeff FROM forward")
def incremental(spark, sf_dir):
    forward = M.comparisons(M.with_keys(derived_books(spark, sf_dir)))
    return forward.select("from_id", "to_id", F.round("coeff", 6).alias("coeff"))


@query("q43_index_deltas", f"{_LINKING.replace('NOT old_a AND ', '')} SELECT from_id, to_id, round(coeff, 6) AS coeff FROM edges")
def index_deltas(spark, sf_dir):
    """Two thirds of the books indexed, the others added in two runs: the links of all three are those of one comparison of all."""
    index = BookIndex(spark, f"{scratch_dir(spark).rstrip('/')}/shelfmark/index-{uuid.uuid4().hex}")
    keyed = stash(M.with_keys(derived_books(spark, sf_dir)), "keyed")
    turn = F.col("ExternalId").cast("long") % 6
    runs = [index.add(keyed.where(part)) for part in (turn % 3 != 2, turn == 2, turn == 5)]
    return runs[0].union(runs[1]).union(runs[2]).distinct().select("from_id", "to_id", F.round("coeff", 6).alias("coeff"))


@query("q35_compared_count", "SELECT source AS ElsName, count(*) FILTER (WHERE doc_id % 3 = 0) AS compared, count(*) AS n FROM documents GROUP BY source")
def compared_count(spark, sf_dir):
    return derived_books(spark, sf_dir).groupBy("ElsName").agg(F.count_if("Compared").alias("compared"), F.count(F.lit(1)).alias("n"))


@query("q36_items_union_extra", "SELECT c_nationkey AS id FROM customer UNION SELECT s_nationkey FROM supplier")
def items_union_extra(spark, sf_dir):
    items = _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("id"))
    return V.union_distinct(items, _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("id")))


@query("q37_only_digits", "SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits FROM customer")
def only_digits(spark, sf_dir):
    return _table(spark, sf_dir, "customer").select("c_custkey", T.only_digits(F.col("c_name")).alias("digits"))


# --- Fields of descriptions ----------------------------------------------------------------------

@query(
    "q38_field_cleanup",
    """SELECT o_orderkey, o_orderstatus || ' ' || o_orderpriority AS c, CASE WHEN o_orderkey % 4 <> 0 THEN strftime(o_orderdate, '%Y') END AS y, ' ' || o_orderpriority || ' ' AS p,
    CAST(o_orderkey AS VARCHAR) AS i, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE CAST(o_orderkey AS INTEGER) END AS n FROM orders""",
)
def field_cleanup(spark, sf_dir):
    c = F.col
    year = F.when(c("o_orderkey") % 4 == 0, "нет").otherwise(F.concat(F.year("o_orderdate"), F.lit(" год, 12")))
    label = F.when(c("o_orderkey") % 2 == 0, "ISBN ").otherwise("")
    raw = _table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("  "), "o_orderstatus", F.lit(" \t "), "o_orderpriority", F.lit("\n")).alias("a"), year.alias("b"), F.concat(F.lit("(ред.) "), "o_orderpriority", F.lit(" (c)")).alias("d"),
        F.concat(label, c("o_orderkey").cast("string")).alias("e"), F.concat(F.lit(" "), "o_orderkey", F.when(c("o_orderstatus") == "F", "x").otherwise(" ")).alias("f"),
    )
    return raw.select("o_orderkey", T.collapse(c("a")).alias("c"), X.first_number(c("b")).alias("y"), X.strip_parenthetical(c("d")).alias("p"), X.without_label(c("e"), "ISBN").alias("i"), T.parse_int(c("f")).alias("n"))


@query(
    "q39_bib_field_regex",
    """WITH o AS (SELECT *, CAST(100 + o_orderkey % 900 AS INTEGER) AS n, strftime(o_orderdate, '%Y') AS y, o_orderkey % 5 = 0 AS bare FROM orders)
    SELECT o_orderkey, CASE WHEN bare THEN 0 ELSE n END AS em, CASE WHEN bare THEN 0 ELSE n END AS hy, CASE WHEN NOT bare THEN '978-' || o_orderkey END AS isbn_dot, CASE WHEN NOT bare THEN '12-' || o_orderkey END AS isbn_comma,
    CASE WHEN NOT bare THEN o_orderpriority END AS pub, CASE WHEN NOT bare THEN y END AS year, CASE WHEN bare THEN 0 ELSE n END AS pages, o_orderpriority AS publisher FROM o""",
)
def bib_field_regex(spark, sf_dir):
    """Fields out of descriptions in four styles, one of each for every order; every fifth has none of the fields."""
    c = F.col
    bare, key, n, y = c("o_orderkey") % 5 == 0, c("o_orderkey").cast("string"), (100 + c("o_orderkey") % 900).cast("string"), F.year("o_orderdate").cast("string")
    bare_or = lambda text, *parts: F.when(bare, text).otherwise(F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))
    raw = _table(spark, sf_dir, "orders").select(
        "o_orderkey", bare_or("isbn 5", "Книга — Москва, ", y, ". — ", n, " c. — ISBN 978-", key, ". — Текст").alias("a"), bare_or("нет", "А. - ", n, " с. - ISBN 12-", key, ", x").alias("b"),
        bare_or(c("o_orderpriority"), "Издательство ", c("o_orderpriority"), ", 2020").alias("d"), bare_or(F.concat(F.lit("Изд, "), "o_orderpriority"), c("o_orderpriority"), ", ", y, " г., ", n, " с.").alias("e"),
    )
    listed = X.from_comma_list(c("e"))
    return raw.select(
        "o_orderkey", X.pages_of_bib(c("a"), *X.EM_DASH_PAGES).alias("em"), X.pages_of_bib(c("b"), *X.HYPHEN_PAGES).alias("hy"), X.isbn_of_bib(c("a"), ". ").alias("isbn_dot"),
        X.isbn_of_bib(c("b"), ", ").alias("isbn_comma"), X.publisher_of_bib(c("d")).alias("pub"), listed["year"].alias("year"), listed["pages"].alias("pages"), listed["publisher"].alias("publisher"),
    )


@query(
    "q40_author_initials",
    f"WITH {_BOOKS.strip()} SELECT doc_id, CASE WHEN doc_id % 3 = 0 OR len(w) = 0 THEN w[1] ELSE w[1] || ' А.Б.' END AS author FROM raw_books",
)
def author_initials(spark, sf_dir):
    """Surnames with the initials that stand beside them in a description, the first words of documents; every third description is missing."""
    docs = _table(spark, sf_dir, "documents")
    first = F.get(F.filter(F.split("text", r"[^\p{L}\p{N}]+", 3), lambda w: w != ""), 0)
    rows = docs.select("doc_id", first.alias("author"))
    bib = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("Книга / А.Б. "), "author", F.lit(". - М.")))
    return rows.select("doc_id", X.with_initials("author", bib).alias("author"))


@query(
    "q41_compare",
    f"{_PARSED}, {_keys('filled').strip()}, {_PAIRS.strip()}, {_SCORED.strip()} SELECT Id, any_value(Authors) AS Authors, any_value(Name) AS Name, "
    "any_value(Publisher) AS Publisher, CAST(count(from_id) + any_value(stored) AS INTEGER) AS SimilarCount, true AS Compared FROM filled LEFT JOIN edges ON from_id = Id GROUP BY Id",
)
def compare_all(spark, sf_dir):
    return compare(derived_books(spark, sf_dir)).select("Id", "Authors", "Name", "Publisher", "SimilarCount", "Compared")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symmetric links between similar books of the derived catalogue."""
    return similar_edges(spark, sf_dir)
