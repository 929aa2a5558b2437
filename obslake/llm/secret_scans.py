"""Secret scans over a ledger of blobs.

A blob is a distinct text under its SHA-256; a path is a row that holds it, in any version. The
ledger keeps one row for each (rule version, blob) ever scanned, with the spans found. A scan
reads the ledger, matches only blobs that it lacks for the rules' version, appends them, and joins
the ledger back to all paths.

Main path: DataFrame functions only. Copies of a text merge before the shuffle by hash, so a text
held by a third of all rows is scanned once; the join back lets a hot blob's paths be split.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, Window

from obslake.llm.common import fresh_path


class Rule(NamedTuple):
    """Leftmost non-overlapping matches of `pattern` whose group `group` has `least` characters
    or more. `probe` is a pattern found in every text that has such a match."""
    kind: str
    pattern: str
    group: int
    least: int
    probe: str


# fixed values: the three base rules, in their order
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6,
         r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16}"),
    Rule("hex", r"[0-9a-f]+", 0, 24, r"[0-9a-f]{24}"),
)
# rules beyond the base: a PEM private key from its head line to its END line; without one, to the
# last of the base64 lines that follow. Possessive loops keep the matcher off the stack.
_HEAD = r"-----BEGIN [A-Z ]*PRIVATE KEY-----"
_TO_END = r"(?:[^-]++|-(?!----))*+-----END [A-Z ]*PRIVATE KEY-----"
_BODY = (r"""(?:\s*+(?:Proc-Type|DEK-Info):[^\r\n]*+"""
         r"""|(?:[\s"',>#*|]|\\[nrt])*+(?:[A-Za-z0-9+/]{16,}+=*+|[A-Za-z0-9+/]++=++)"""
         r"""|[\x20\t"',]*+(?:\r?\n|(?:\\r)?\\n)[\x20\t>#*|"']*+[A-Za-z0-9+/]++=*+(?=[\x20\t\r"',]*+(?:\n|\\|\z)))*+""")
RULES = (*BASE_RULES, Rule("pem", f"{_HEAD}(?:{_TO_END}|{_BODY})", 0, 27, _HEAD))

CHUNK = 256  # matches, or code points of a text, handled at once
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"
LEDGER = f"blob string, spans {SPAN}, rule_version string"


def rule_version(rules=RULES) -> str:
    return hashlib.sha256(repr([tuple(r) for r in rules]).encode()).hexdigest()[:16]


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of one rule in code points: what lies between matches comes from split(), the matches
    from regexp_extract_all(), both by the same expression; a running sum gives the places."""
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    sizes = F.transform(found, F.length)
    tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    matches = F.arrays_zip(F.slice(gaps, 1, F.size(sizes)).alias("gap"), sizes.alias("size"),
                           F.transform(tested, F.length).alias("part"))

    def place(a, x):
        return F.struct(
            (a["at"] + x["gap"] + x["size"]).alias("at"),
            F.when(x["part"] >= rule.least, F.array_append(a["out"], F.struct(
                (a["at"] + x["gap"]).alias("start"), F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"),
                (a["at"] + x["gap"] + x["size"]).alias("end")))).otherwise(a["out"]).alias("out"))

    # an append copies its array, so matches are placed in chunks, each from where the last one ended
    def chunked(m):
        chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / CHUNK).cast("int")),
                             lambda k: F.slice(m, k * CHUNK + 1, CHUNK))
        return F.aggregate(
            chunks, F.expr(f"cast(array() as array<struct<at:int,out:{SPAN}>>)"),
            lambda done, c: F.array_append(done, F.aggregate(
                c, F.struct(F.coalesce(F.get(done, F.size(done) - 1)["at"], F.lit(0)).alias("at"),
                            F.expr(f"cast(array() as {SPAN})").alias("out")), place)),
            lambda done: F.flatten(F.transform(done, lambda d: d["out"])))
    placed = F.get(F.transform(F.array(matches), lambda m: F.when(F.size(m) > 0, chunked(m))
                               .otherwise(F.expr(f"cast(array() as {SPAN})"))), 0)
    return F.when(F.regexp_like(text, F.lit(rule.probe)), placed).otherwise(F.expr(f"cast(array() as {SPAN})"))


def find_spans(text: Column, rules=RULES) -> Column:
    """All spans of all rules by start, then rule."""
    return F.sort_array(F.concat(*(_spans(text, r, k) for k, r in enumerate(rules))))


def read_ledger(spark, ledger: str, version: str) -> DataFrame | None:
    """Ledger rows of a rule version, one for each blob (an append may have run twice); None: no
    ledger there yet."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs_path):
        return None
    rows = spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule_version") == version)
    return rows.select("blob", "spans").dropDuplicates(["blob"])


def scan(docs: DataFrame, ledger: str, rules=RULES) -> DataFrame:
    """Bring the ledger up to date with docs (column text); return its rows (blob, spans) for
    these rules."""
    spark, version = docs.sparkSession, rule_version(rules)
    blobs = docs.select(blob_of(F.col("text")).alias("blob"), F.coalesce("text", F.lit("")).alias("body")) \
        .groupBy("blob").agg(F.first("body").alias("body"))
    seen = read_ledger(spark, ledger, version)
    unseen = blobs if seen is None else blobs.join(seen, "blob", "left_anti")
    unseen.select("blob", find_spans(F.col("body"), rules).alias("spans"), F.lit(version).alias("rule_version")) \
        .write.mode("append").partitionBy("rule_version").parquet(ledger)
    return read_ledger(spark, ledger, version)


def find_secrets(docs: DataFrame, ledger: str | None = None, rules=RULES) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, blob, spans (all, by start, then rule).

    Without a ledger path a new one is begun in the shared folder. A null text counts as empty
    and has no span; repeated rows are paths of one blob; other columns of docs are ignored.
    """
    found = scan(docs, ledger or fresh_path(docs.sparkSession, "ledger"), rules)
    return docs.select("doc_id", blob_of(F.col("text")).alias("blob")).join(found, "blob", "left").select(
        "doc_id", "blob", F.coalesce("spans", F.expr(f"cast(array() as {SPAN})")).alias("spans"))


def _runs(found: DataFrame) -> DataFrame:
    """(_blob, _runs): runs of overlapping spans of each blob, {start, stop} in order."""
    order = Window.partitionBy("blob").orderBy("start", "end")
    s = found.select("blob", F.inline("spans")) \
        .withColumn("upto", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    s = s.withColumn("run", F.sum(F.when(F.col("start") < F.col("upto"), 0).otherwise(1))
                     .over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return s.groupBy("blob", "run").agg(F.min("start").alias("start"), F.max("end").alias("stop")) \
        .groupBy(F.col("blob").alias("_blob")).agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("_runs"))


def redact(docs: DataFrame, ledger: str | None = None, rules=RULES, mask: str = "[SECRET]") -> DataFrame:
    """docs with each run of overlapping spans in `text` replaced by the mask; all columns stay.
    n_chars, where there is one, follows the text. The work on a text grows with its length and its
    spans, not with their product."""
    found = scan(docs, ledger or fresh_path(docs.sparkSession, "ledger"), rules)
    d = docs.select(F.struct("*").alias("_doc"), blob_of(F.col("text")).alias("_blob")).join(_runs(found), "_blob", "left")
    text = F.col("_doc.text")
    # places are code points, found by counting from a text's start; so only the blocks that a piece lies in are read
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    d = d.withColumn("_blocks", F.when(F.col("_runs").isNotNull(), blocks))

    def piece(start: Column, stop: Column) -> Column:
        first = F.floor(start / CHUNK).cast("int")
        inside = F.slice("_blocks", first + 1, F.greatest(F.floor((stop - 1) / CHUNK).cast("int") - first + 1, F.lit(0)))
        return F.substring(F.array_join(inside, ""), start - first * CHUNK + 1, stop - start)
    before = F.transform("_runs", lambda r, k: F.concat(
        piece(F.coalesce(F.get("_runs", k - 1)["stop"], F.lit(0)), r["start"]), F.lit(mask)))
    cleaned = F.concat(F.array_join(before, ""), piece(F.get("_runs", F.size("_runs") - 1)["stop"], F.length(text)))
    new = F.when(F.col("_runs").isNull(), text).otherwise(cleaned)
    d = d.select("_doc", new.alias("_text"))
    put = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        put["n_chars"] = F.when(F.col("_text") == text, F.col("_doc.n_chars")) \
            .otherwise(F.length("_text")).cast(docs.schema["n_chars"].dataType)
    return d.select(*(put.get(c, F.col(f"_doc.`{c}`")).alias(c) for c in docs.columns))


def listed(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans, and all spans as a string."""
    base = [r.kind for r in BASE_RULES]
    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(listed(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"))
