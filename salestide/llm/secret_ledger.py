"""Secret scanning over an incremental, content-addressed blob ledger.

Every historical version of every path is addressed by the SHA-256 of its
text.  A ledger of (blob, rule, rule version) records what has been scanned;
a run scans each distinct blob once, for the rules whose current version the
ledger does not list, and joins the findings back to all paths that ever
held the blob.  DataFrame functions only: spans are cumulative lengths of
the pieces between matches (``split``) and of the matches
(``regexp_extract_all``), both in code points.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``pattern`` in Java's syntax; ``group`` must have ``least`` characters.
    ``hint`` is a literal that every match contains (a cheap first test)."""

    kind: str
    version: int
    pattern: str
    group: int
    least: int
    hint: str = ""
    base: bool = False

    @property
    def id(self) -> str:
        return f"{self.kind}@{self.version}"


# The rules, in the order in which kinds are listed.
ASSIGN = (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"([A-Za-z0-9+/_.=-]+)")
RULES = (
    Rule("assign", 1, ASSIGN, 2, 6, base=True),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, hint="AKIA", base=True),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24, base=True),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1, hint="PRIVATE KEY-----"),
    Rule("vcs", 1, r"gh[pousr]_[A-Za-z0-9]+", 0, 40, hint="gh"),
)
SPAN = "struct<start:int,rank:int,kind:string,stop:int>"
LEDGER = "blob string, rule string"
FINDINGS = f"blob string, rule string, spans array<{SPAN}>"


def rule_spans(text: Column, rule: Rule, rank: int) -> Column:
    """Spans of ``rule`` in ``text``: leftmost, non-overlapping; matches with
    too short a group are dropped without another try."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else whole
    between = F.split(text, rule.pattern, -1)
    steps = F.arrays_zip(F.slice(F.transform(between, F.length), 1, F.size(whole)).alias("gap"),
                         F.transform(whole, F.length).alias("len"),
                         F.transform(part, F.length).alias("part"))

    def add(acc, x):
        start = acc["at"] + x["gap"]
        stop = start + x["len"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"),
                        F.lit(rule.kind).alias("kind"), stop.alias("stop"))
        found = F.when(x["part"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(stop.alias("at"), found.alias("out"))

    none = F.array().cast(f"array<{SPAN}>")
    spans = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("out")), add,
                        lambda acc: acc["out"])
    test = text.rlike(rule.pattern)
    if rule.hint:
        test = text.contains(rule.hint) & test
    return F.when(test, spans).otherwise(none)


def address(versions: DataFrame, text_col: str = "text") -> DataFrame:
    """``versions`` with ``blob``, the content address (null text: empty)."""
    return versions.withColumn("blob", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None, rules=RULES,
                text_col: str = "text") -> DataFrame:
    """Findings (blob, rule, spans) for the (blob, rule version) pairs that
    ``ledger`` (blob, rule) does not list; one row per new pair, spans empty
    where nothing was found, so the result is also what to add to the ledger.

    Copies of a text are one blob (a partial aggregate before the shuffle);
    an empty table gives no rows.
    """
    blobs = address(versions.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")), "text")
    blobs = blobs.groupBy("blob").agg(F.first("text").alias("text"))
    wanted = F.array(*[F.lit(r.id) for r in rules])
    if ledger is None:
        todo = blobs.withColumn("todo", wanted)
    else:
        seen = ledger.groupBy("blob").agg(F.collect_set("rule").alias("seen"))
        todo = blobs.join(seen, "blob", "left").select(
            "blob", "text",
            F.when(F.col("seen").isNull(), wanted)
            .otherwise(F.array_except(wanted, F.col("seen"))).alias("todo")).where(F.size("todo") > 0)
    none = F.lit(None).cast(f"struct<rule:string,spans:array<{SPAN}>>")
    per_rule = F.array(*[
        F.when(F.array_contains("todo", F.lit(r.id)),
               F.struct(F.lit(r.id).alias("rule"), rule_spans(F.col("text"), r, i).alias("spans")))
        .otherwise(none) for i, r in enumerate(rules)])
    return todo.select("blob", F.explode(F.filter(per_rule, lambda x: x.isNotNull())).alias("f")).select(
        "blob", "f.rule", "f.spans")


def _text_of(spans: Column) -> Column:
    return F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _of_kind(kind: str) -> Column:
    return F.filter("all", lambda s: s["kind"] == kind)


def findings_by_path(versions: DataFrame, findings: DataFrame, rules=RULES, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Every row of ``versions`` with what was found in its blob.

    Columns: doc_id, n_assign, n_access, n_hex, base_sha256, spans.  A null
    text is an empty one; a row without findings has counts 0, spans '' and
    the SHA-256 of ''.  Repeated rows and null ids are kept; other columns
    are ignored.  ``findings`` may hold older rule versions: only the
    current version of each rule counts.
    """
    current = [r.id for r in rules]
    by_blob = findings.where(F.col("rule").isin(current)).groupBy("blob").agg(
        F.sort_array(F.flatten(F.collect_list("spans"))).alias("all"))
    base_kinds = [r.kind for r in rules if r.base]
    base = F.filter("all", lambda s: s["kind"].isin(base_kinds))
    digest = by_blob.where(F.size("all") > 0).select(
        "blob", *[F.size(_of_kind(k)).cast("long").alias(f"n_{k}") for k in base_kinds],
        F.sha2(_text_of(base), 256).alias("base_sha256"), _text_of(F.col("all")).alias("spans"))
    rows = address(versions.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), "text")
    return rows.select("doc_id", "blob").join(digest, "blob", "left").select(
        "doc_id", *[F.coalesce(f"n_{k}", F.lit(0).cast("long")).alias(f"n_{k}") for k in base_kinds],
        F.coalesce("base_sha256", F.sha2(F.lit(""), 256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))
