"""The queries of this subpackage: each applies one operator to its whole table, with production parameters."""

from __future__ import annotations

import secrets as secrets_module
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import backoff, classifier, decontaminate, divergence, jaccard, mixing, packing, pii, quality_rules, search, secrets, toxicity, urls
from shelfmark.llm.common import scratch_dir, table, words


def tokenizer_path(spark: SparkSession) -> str:
    """Where the tokenizer's file lies: spark.shelfmark.tokenizer, else the installed package of public tokenizers."""
    found = spark.conf.get("spark.shelfmark.tokenizer", None)
    if found:
        return found
    from public_tokenizers import path

    return path("word_bpe_49k.json")


def op1_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = jaccard.join_ngrams(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


def pii_key(spark: SparkSession) -> bytes:
    """The key of surrogates: that of spark.shelfmark.pii.key, else one that is drawn once for a shared folder and lies there, so that reruns and restarts agree."""
    found = spark.conf.get("spark.shelfmark.pii.key", None)
    if found:
        return found.encode()[:64]
    path = f"{scratch_dir(spark).rstrip('/')}/shelfmark/pii-key"
    fresh = spark.createDataFrame(pa.table({"key": [secrets_module.token_hex(32)]}))  # a row of Arrow needs no Python on executors
    try:
        fresh.coalesce(1).write.mode("error").text(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_ALREADY_EXISTS":
            raise
    return spark.read.text(path).first()[0].encode()


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.replace_pii(docs.select("doc_id", "text"), pii_key(spark)).select("doc_id", "text", "n_entities", "entities")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(spark))


def op4_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score_documents(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = spark.conf.get("spark.shelfmark.ledger", None) or f"{scratch_dir(spark).rstrip('/')}/shelfmark/ledger-{uuid.uuid4().hex}"
    found, _ = secrets.scan_with_ledger(table(spark, sf_dir, "documents"), ledger)
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE_RULES))
    number = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    counts = [number(k) for k in secrets.BASE_RULES]
    digest = F.sha2(secrets.joined(base), 256).alias("base_sha256")
    return found.select(F.col("path").alias("doc_id"), *counts, digest, secrets.joined(F.col("spans")).alias("spans"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    judged = decontaminate.decontaminate(docs.select("doc_id", "text"), benchmark)
    return judged.select("doc_id", "contaminated", "n_items", "items", "n_windows")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judged = quality_rules.judge(docs.select("doc_id", "text"), quality_rules.trusted(labels))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_ratio")


def op8_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = classifier.fold(F.col("doc_id"), 4) == 2
    known = labels.where(~held_out).select("doc_id", F.col("quality").alias("label"))
    scored = classifier.score_quality(docs, known)
    predicted = F.when(F.col("score") >= 0.7, 1).otherwise(0)
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = classifier.fold(F.col("doc_id"), 5) == 0
    known = labels.where(~held_out).select("doc_id", F.col("toxic").alias("label"))
    scored = toxicity.score_toxicity(docs, known)
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


#: The rules of the contract and hosts known for advertisements and fraud.  Fixed values.
URL_RULES = [
    ("block", "com/en/"),
    ("allow", "example.com/en/7"),
    ("block", "net/de/"),
    ("block", "example.net/de/8"),
    ("block", "org/es/"),
]
BAD_SITES = ["spam-farm", "adult-x", "cheap-pills", "ads-track", "casino-win", "free-bets"]
URL_LIST = [f"{site}.example.{top}/" for site in BAD_SITES for top in ("com", "net", "org")]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"), URL_RULES, URL_LIST)


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken, _, _ = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The targets of op12_mixing alone, which SQL can express."""
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("source", F.size(words(F.col("text"))).cast("long").alias("size"))
    return mixing.with_slots(mixing.source_targets(sized)).select("source", "no", "weight", "source_size", "target", "goal")


def measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base measures of op7_quality alone, which SQL can express."""
    measured = quality_rules.measures(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return measured.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard": op1_jaccard,
    "op2_pii": op2_pii,
    "op3_packing": op3_packing,
    "op4_backoff": op4_backoff,
    "op5_secrets": op5_secrets,
    "op6_decontaminate": op6_decontaminate,
    "op7_quality": op7_quality,
    "op8_classifier": op8_classifier,
    "op9_toxicity": op9_toxicity,
    "op10_urls": op10_urls,
    "op11_search": op11_search,
    "op12_mixing": op12_mixing,
    "op13_divergence": op13_divergence,
    "measures_of_quality": measures,
    "targets_of_mixing": targets,
}

_PARTS = r"""
parts AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
canonical AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^(?s:.*)@', ''), ':(80|443)$', ''), '\.$', '') AS listed_host FROM parts)"""


def _secrets_sql() -> str:
    """Spans in SQL: the texts between matches and the matches alternate, so sums of their lengths are places."""
    parts, spans, counts = [], [], []
    every = secrets.BASE_RULES | secrets.MORE_RULES
    for rank, (kind, (pattern, group, least)) in enumerate(every.items()):
        p = pattern.replace("'", "''")
        parts.append(f"regexp_extract_all(text, '{p}', 0) AS m_{kind}, regexp_extract_all(text, '{p}', {group}) AS c_{kind}, string_split_regex(text, '{p}') AS b_{kind}")
        spans.append(
            f"SELECT r, {rank} AS rank, '{kind}' AS kind, s, s + length(m) AS e FROM (SELECT r, length(array_to_string(b_{kind}[1:i], '')) + length(array_to_string(m_{kind}[1:i-1], '')) AS s, "
            f"m_{kind}[i] AS m, c_{kind}[i] AS c FROM (SELECT *, unnest(range(1, len(m_{kind}) + 1)) AS i FROM t)) WHERE length(c) >= {least}"
        )
        if kind in secrets.BASE_RULES:
            counts.append(f"count(*) FILTER (WHERE kind = '{kind}') AS n_{kind}")
    joined = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank){}, '')"
    base = joined.format(f" FILTER (WHERE rank < {len(secrets.BASE_RULES)})")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, {", ".join(parts)} FROM d),
spans AS ({" UNION ALL ".join(spans)})
SELECT any_value(doc_id) AS doc_id, {", ".join(counts)}, sha256({base}) AS base_sha256, {joined.format("")} AS spans
FROM d LEFT JOIN spans USING (r) GROUP BY r"""


ORACLE_SQL: dict[str, str] = {
    "op10_urls": f"""
WITH {_PARTS.strip()},
rules(verdict, h, p) AS (VALUES {", ".join(f"('{v}', '{urls.split_rule(r)[0]}', '{urls.split_rule(r)[1]}')" for v, r in URL_RULES)}),
listed(h) AS (VALUES {", ".join(f"('{urls.split_rule(r)[0]}')" for r in URL_LIST)}),
best AS (
  SELECT page_id, host, path,
    (SELECT max(struct_pack(n := length(h || p), rule := h || p, verdict := verdict)) FROM rules
     WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS hit,
    (SELECT count(*) FROM listed WHERE listed_host = h OR ends_with(listed_host, '.' || h)) AS bad
  FROM canonical)
SELECT page_id, host, path, hit.rule AS rule,
       coalesce(hit.verdict, CASE WHEN bad > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM best""",
    "op1_jaccard": r"""
WITH RECURSIVE
words AS (SELECT row_number() OVER () AS r, doc_id,
                 list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s FROM words),
keyed AS (SELECT r, doc_id, len(s) AS n, md5(array_to_string(list_sort(s), chr(10))) AS k, s FROM sets),
classes AS (SELECT k, any_value(n) AS n, min(doc_id) AS rep, count(*) AS copies, any_value(s) AS s FROM keyed WHERE n > 0 GROUP BY k),
grams AS (SELECT k, n, unnest(s) AS g FROM classes),
pairs AS (SELECT a.k AS a, b.k AS b FROM grams a JOIN grams b ON a.g = b.g AND a.k <> b.k GROUP BY a.k, b.k, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(k, root) AS (SELECT k, k FROM classes UNION SELECT p.b, reach.root FROM reach JOIN pairs p ON p.a = reach.k),
component AS (SELECT reach.k, min(c.rep) AS component_id FROM reach JOIN classes c ON c.k = reach.root GROUP BY reach.k),
near AS (SELECT p.a AS k, sum(c.copies) AS others FROM pairs p JOIN classes c ON c.k = p.b GROUP BY p.a)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles, coalesce(component.component_id, d.doc_id) AS component_id, coalesce(c.rep, d.doc_id) AS class_id,
       CAST(CASE WHEN d.n = 0 THEN 0 ELSE c.copies - 1 + coalesce(near.others, 0) END AS BIGINT) AS n_links
FROM keyed d LEFT JOIN classes c ON c.k = d.k AND d.n > 0 LEFT JOIN component ON component.k = c.k LEFT JOIN near ON near.k = c.k""",
    "measures_of_quality": r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2])) AS g FROM w WHERE len(w) >= 3),
repeated AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM repeated WHERE n > 1) GROUP BY r),
m AS (SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(length(array_to_string(w.w, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
      FROM w LEFT JOIN covered ON covered.r = w.r)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m""",
    "op5_secrets": _secrets_sql(),
    "op11_search": r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT row_number() OVER () AS i, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
total AS (SELECT count(*) AS n, CAST(sum(len(w)) AS HUGEINT) AS l FROM docs WHERE len(w) > 0),
lengths AS (SELECT r, doc_id, w, 25 + (75 * CAST(len(w) AS HUGEINT) * total.n) // total.l AS m FROM docs, total WHERE len(w) > 0),
asked AS (SELECT i, item_id, term, count(*) AS q FROM (SELECT i, item_id, unnest(w) AS term FROM items) GROUP BY i, item_id, term),
held AS (SELECT r, doc_id, m, term, count(*) AS tf FROM (SELECT r, doc_id, m, unnest(w) AS term FROM lengths) WHERE term IN (SELECT term FROM asked) GROUP BY r, doc_id, m, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * total.n + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS weight FROM held, total GROUP BY term, total.n),
scored AS (SELECT i, item_id, r, doc_id, CAST(sum(q * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score FROM asked JOIN held USING (term) JOIN weights USING (term) GROUP BY i, item_id, r, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_divergence": r"""
WITH uses AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)),
kept AS (SELECT lang, term, count(*) AS n FROM uses GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
langs AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM kept GROUP BY lang),
held AS (SELECT lang, source, term, count(*) AS n FROM uses JOIN kept USING (lang, term) GROUP BY lang, source, term),
groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents),
sizes AS (SELECT g.lang, g.source, coalesce(CAST(sum(h.n) AS BIGINT), 0) AS total FROM groups g LEFT JOIN held h USING (lang, source) GROUP BY g.lang, g.source),
p AS (SELECT s.lang, s.source, k.term, coalesce(h.n, 0) AS n, 1 + (1000000000 * (CAST(coalesce(h.n, 0) AS HUGEINT) + 1)) // (s.total + l.v) AS p,
             1 + (1000000000 * (CAST(k.n AS HUGEINT) + 1)) // (l.total + l.v) AS q
      FROM sizes s JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN held h ON h.lang = s.lang AND h.source = s.source AND h.term = k.term),
apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(x.value, 0) AS BIGINT) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
    # Sources by the ratio of limit and weight: one stops at its limit if its share of what those before it leave is more.
    "targets_of_mixing": r"""
WITH sized AS (SELECT source, len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS size FROM documents),
sources AS (SELECT *, 1 + no % 3 AS weight FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM sized GROUP BY source)),
shares AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS left_over, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weights
           FROM sources WINDOW before AS (ORDER BY 3 * source_size / CAST(weight AS DOUBLE), no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
judged AS (SELECT *, 3 * source_size * weights < left_over * weight AS capped FROM shares),
rest AS (SELECT arg_max(left_over, weights) AS left_over, max(weights) AS weights FROM judged WHERE NOT capped)
SELECT source, no, CAST(weight AS BIGINT) AS weight, source_size, target, CAST(round(target) AS BIGINT) AS goal FROM (
  SELECT j.*, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE) ELSE CAST(rest.left_over AS DOUBLE) * weight / CAST(rest.weights AS DOUBLE) END AS target
  FROM judged j LEFT JOIN rest ON true)""",
}
