"""Secret scan with an incremental ledger of blobs, in DataFrame functions only.

Every version of a text is addressed by the SHA-256 of its content.  The ledger holds the findings of
each pair (blob, rule version) that has been scanned; a run scans only pairs that it does not hold,
each once however many paths have the blob, and joins findings back to all paths.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import let, stash

#: Kind, pattern, the group whose length counts and its least length, in code points.  Fixed values.
#: A greedy run is found or dropped whole, so the last two may ask for the length in the pattern.
BASE_RULES = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: What is found besides: private key headers, signed web tokens and prefixed tokens of hosting and chat services.
MORE_RULES = {
    "pem": (r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----", 0, 1),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    "prefixed": (r"\b(?:gh[pousr]_|xox[abprs]-|sk_live_|glpat-)[A-Za-z0-9_-]+", 0, 20),
}
#: A cheap test whether a rule can hit at all: at least as wide as the rule.
GUARDS = {
    "assign": r"(?i:passw|secret|token|api_?key)",
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
    "pem": "PRIVATE KEY-----",
    "jwt": "eyJ",
    "prefixed": r"gh[pousr]_|xox[abprs]-|sk_live_|glpat-",
}
RULE_VERSION = "v1"
#: Findings that are gathered before they are joined to those of a text.
PART = 128
#: So many rows and findings are broadcast at most (some 50 MB); more are joined in a shuffle, salted this often.
MAX_BROADCAST, SALTS = 500_000, 16
_SPAN = "array<struct<kind:string,start:int,end:int>>"


def find_spans(text: Column, kind: str, pattern: str, group: int, least: int, guard: str | None = None) -> Column:
    """Leftmost non-overlapping matches as (kind, start, end) in code points, end exclusive; short ones are dropped.

    The texts between matches and the matches themselves alternate, so running sums of their
    lengths give every place without a search for each.
    """

    def spans(parts: Column) -> Column:
        whole, counted, between = parts["whole"], parts["counted"], parts["between"]
        steps = F.transform(whole, lambda m, i: F.struct(F.length(m).alias("m"), F.length(F.get(between, i)).alias("b"), F.length(F.get(counted, i)).alias("c")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

        def step(acc: Column, s: Column) -> Column:
            begin = acc["at"] + s["b"]
            end = begin + s["m"]
            one = F.array(F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end")))
            return F.struct(end.alias("at"), F.when(s["c"] >= least, F.concat(acc["found"], one)).otherwise(acc["found"]).alias("found"))

        # Appending copies a list, so a part's findings are gathered first: n findings cost n / PART copies of all.
        none = F.array().cast(_SPAN)
        parts = F.transform(F.sequence(F.lit(0), F.size(steps), F.lit(PART)), lambda k: F.slice(steps, k + 1, PART))
        joined = lambda acc, part: F.struct(part["at"].alias("at"), F.concat(acc["found"], part["found"]).alias("found"))
        one = lambda acc, part: let(F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("found")), step), lambda p: joined(acc, p))
        return F.aggregate(parts, start, one, lambda acc: acc["found"])

    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.struct(whole.alias("whole"), counted.alias("counted"), F.split(text, pattern, -1).alias("between"))
    found = let(parts, spans)
    return F.when(text.rlike(guard or pattern), found).otherwise(F.array().cast(_SPAN))


def scan(blobs: DataFrame, rules: Mapping[str, tuple[str, int, int]], text_col: str = "text") -> DataFrame:
    """Adds the column spans: every finding of the rules, by start, then in the order of the rules."""
    each = [find_spans(F.col(text_col), k, *rule, guard=GUARDS.get(k)) for k, rule in rules.items()]
    ranks = F.create_map(*[F.lit(x) for i, k in enumerate(rules) for x in (k, i)])
    ranked = F.transform(F.concat(*each), lambda s: F.struct(s["start"].alias("start"), ranks[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return blobs.withColumn("spans", F.transform(F.sort_array(ranked), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))


def scan_secrets(
    versions: DataFrame,
    ledger: DataFrame | None = None,
    rules: Mapping[str, tuple[str, int, int]] | None = None,
    rule_version: str = RULE_VERSION,
    path_col: str = "doc_id",
    text_col: str = "text",
    max_broadcast: int = MAX_BROADCAST,
) -> tuple[DataFrame, DataFrame]:
    """Findings of every path and the ledger to keep for the next run.

    versions: one row for each path and version (here a document); null text counts as empty, null
    paths and repeated rows stay, other columns are not read.  ledger: blob, rule_version, spans of
    earlier runs, or None.  Returns (path, blob, spans) for every row of versions, and the ledger
    with what this run has scanned.

    Only the smallest path of an unseen blob brings its text to the scan.  The text moves once, in a
    join by path whose other side is small rows, and not at all where few blobs are unseen; copies,
    however many, only move their hash, and their findings come to them.
    """
    rules = {**BASE_RULES, **MORE_RULES} if rules is None else rules
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = versions.select(F.col(path_col).alias("path"), text.alias("text"))
    addressed = stash(rows.select("path", F.sha2("text", 256).alias("blob")), "blobs")
    unseen = addressed.groupBy("blob").agg(F.min("path").alias("path"), F.count(F.lit(1)).alias("copies"))
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == rule_version)
        unseen = unseen.join(seen, "blob", "left_anti")
    unseen = stash(unseen.select("blob", "path"), "unseen")
    few = unseen.count() <= max_broadcast
    sized = (lambda df: F.broadcast(df)) if few else (lambda df: df.hint("shuffle_hash"))
    # A null path joins nothing, so texts that only such rows have are scanned by their own hash.
    wanted = sized(unseen.where("path is not null").select("path", F.col("blob").alias("want")))
    named = rows.where(F.col("path").isNotNull()).join(wanted, "path")
    named = named.where(F.sha2("text", 256) == F.col("want")).select(F.col("want").alias("blob"), "text")
    unnamed = rows.where(F.col("path").isNull()).withColumn("blob", F.sha2("text", 256))
    unnamed = unnamed.join(sized(unseen.where("path is null").select("blob")), "blob", "left_semi").select("blob", "text")
    fresh = scan(named.unionByName(unnamed), rules).select("blob", F.lit(rule_version).alias("rule_version"), "spans")
    fresh = stash(fresh, "scanned").dropDuplicates(["blob"])
    known = fresh if ledger is None else fresh.unionByName(ledger.select(fresh.columns))
    hits = known.where((F.col("rule_version") == rule_version) & (F.size("spans") > 0)).select("blob", "spans")
    size = hits.agg(F.count(F.lit(1)) + F.coalesce(F.sum(F.size("spans")), F.lit(0))).first()[0]
    if size <= max_broadcast:
        found = addressed.join(F.broadcast(hits), "blob", "left")
    else:  # a blob of very many paths is dealt out
        salted = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        found = addressed.withColumn("salt", F.pmod(F.xxhash64("path"), F.lit(SALTS)).cast("int")).join(salted, ["blob", "salt"], "left")
    return found.select("path", "blob", F.coalesce("spans", F.array().cast(_SPAN)).alias("spans")), known


def scan_with_ledger(versions: DataFrame, folder: str, **options) -> tuple[DataFrame, DataFrame]:
    """scan_secrets() with the ledger in a folder, if there is one yet; what is scanned is added to it."""
    spark = versions.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/_SUCCESS")
    held = None
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        held = spark.read.schema(f"blob string, rule_version string, spans {_SPAN}").parquet(folder)
        held = held.dropDuplicates(["blob", "rule_version"])
    found, ledger = scan_secrets(versions, held, **options)
    found = stash(found, "found")
    fresh = ledger if held is None else ledger.join(held.select("blob", "rule_version"), ["blob", "rule_version"], "left_anti")
    fresh.write.mode("append").parquet(folder)
    return found, spark.read.schema(fresh.schema).parquet(folder)


def joined(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
