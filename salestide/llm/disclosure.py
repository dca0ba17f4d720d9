"""Personal data and the terms that give it away.

Personal data (e-mail, IP address, card, phone) is found by patterns and
checks.  Corpus co-occurrence then estimates how strongly a term reveals such
an entity: with n(t, e) the texts that hold both t and e, n(t) the texts with
t, n(e) the texts with e and N all texts,

    disclosure(t, e) = c * n(t, e) / n(t)              (share of t that points to e)
    information(t, e) = log2(c * n(t, e) * N / (n(t) * n(e)))      (bits)

where c = 1 - 2^-k while only k < ``Settings.firm`` distinct texts hold both,
and 1 from there on: an entity in one or two texts counts too, at a discount.
A term that exceeds the thresholds is generalised, and removed from the
higher threshold on, wherever it stands in a text with the entity.  Rows
without personal data are never changed.

Counts cover every row, and whole texts; characters of mentions belong to no
term.  n(t, e) <= n(e), so a pair with n(t) beyond n(e) / ``generalise`` is
dropped before pairs are formed, and entities that stand in the same texts
are one group, counted once.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from salestide.llm.common import materialised

KINDS = ("email", "ip", "card", "phone")
TERM = "term"

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_TERM = re.compile(r"[^\W\d_]{3,}")


@dataclass(frozen=True)
class Settings:
    firm: int = 3             # distinct texts with both from which their number is not discounted
    generalise: float = 0.5   # disclosure from which a term is generalised ...
    remove: float = 0.9       # ... and removed
    min_bits: float = 4.0     # information from which a term counts at all
    flush: int = 400_000      # terms counted in a task before partial sums are passed on
    common: int = 1000        # a term in more than 1 of so many rows is looked up, not joined


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    for m in _DOTTED.finditer(text):
        at, parts = m.start(), m[0].split(".")
        starts = []
        for p in parts:
            starts.append(at)
            at += len(p) + 1
        i = 0
        while i + 3 < len(parts):
            four = parts[i:i + 4]
            if not all(four):
                i += 1
                continue
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield starts[i], starts[i + 3] + len(parts[i + 3])
            i += 4


def find(text: str | None) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start; leftmost,
    non-overlapping per kind, failing matches dropped without another try."""
    if not text:
        return []
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    out += [(1, a, b) for a, b in addresses(text)]
    for m in _DIGITS.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def entity(kind: int, value: str) -> bytes:
    """The protected entity behind a mention: its normal form, digested."""
    plain = value.lower() if kind < 2 else re.sub(r"[^0-9]", "", value)
    return hashlib.blake2b(f"{kind}:{plain}".encode(), digest_size=12).digest()


def text_key(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def term_places(text: str, found: list[tuple[int, int, int]]) -> Iterator[tuple[str, int, int]]:
    """(term, start, end) of every term of ``text`` clear of the mentions."""
    starts, ends = [], []   # mentions as disjoint intervals
    for a, b in sorted({(a, b) for _, a, b in found}):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    for m in _TERM.finditer(text):
        x, y = m.span()
        i = bisect_right(starts, x) - 1
        if (i >= 0 and ends[i] > x) or (i + 1 < len(starts) and starts[i + 1] < y):
            continue
        yield m[0].lower(), x, y


def text_terms(text: str) -> set[str]:
    found = find(text)
    if found:
        return {t for t, _, _ in term_places(text, found)}
    return {t.lower() for t in set(_TERM.findall(text))}


@F.pandas_udf(BinaryType())
def _holder_key(texts: pd.Series) -> pd.Series:
    """The text's key if it holds personal data, else null."""
    return pd.Series([text_key(t) if find(t) else None for t in texts], dtype=object)


# Spark copies a deterministic function into the filter on its result: each
# task would run it twice, in two Python workers
_holder_key = _holder_key.asNondeterministic()


def _holders(docs: DataFrame) -> DataFrame:
    """(key, text, copies) of every distinct text with personal data."""
    return (docs.select("text", _holder_key("text").alias("key")).where(F.col("key").isNotNull())
            .groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies")))


def _groups(held: DataFrame) -> DataFrame:
    """(key, copies, who, n_entity): the groups of entities of each text.
    Entities that stand in the same texts have the same counts with every
    term: they are one group, named by the XOR of the keys' hashes."""
    @F.pandas_udf("array<binary>")
    def entities(texts: pd.Series) -> pd.Series:
        return pd.Series([sorted({entity(k, t[a:b]) for k, a, b in find(t)}) for t in texts], dtype=object)

    each = materialised(held.select("key", "copies", F.explode(entities("text")).alias("entity")))
    sets = each.groupBy("entity").agg(
        F.count("*").alias("texts"), F.sum("copies").alias("n_entity"),
        F.bit_xor(F.xxhash64("key")).alias("x"), F.bit_xor(F.xxhash64("key", F.lit(1))).alias("y"))
    who = F.concat_ws(":", "texts", "x", "y")
    return each.join(sets, "entity").select("key", "copies", who.alias("who"), "n_entity").distinct()


def _term_texts(docs: DataFrame, s: Settings) -> DataFrame:
    """(term, n_term): in how many rows each term stands, over the whole corpus."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for p in parts:
            for text in p.text:
                if text:
                    counts.update(text_terms(text))
                if len(counts) > s.flush:
                    yield pd.DataFrame({"term": list(counts), "n": list(counts.values())})
                    counts.clear()
        yield pd.DataFrame({"term": list(counts), "n": list(counts.values())}).astype(
            {"term": object, "n": "int64"})

    return (docs.select("text").mapInPandas(run, "term string, n long")
            .groupBy("term").agg(F.sum("n").alias("n_term")))


def _pairs(docs: DataFrame, held: DataFrame, s: Settings) -> DataFrame:
    """(key, copies, who, n_entity, term, n_term, n_rows): every group and
    term of each text, without the pairs that n(e) and n(t) rule out."""
    groups = materialised(_groups(held))
    n_term = materialised(_term_texts(docs, s))
    n_rows = docs.agg(F.count("text")).first()[0]
    # at most ``common`` times the mean number of terms a text
    known = held.sparkSession.sparkContext.broadcast(
        {r.term: r.n_term for r in n_term.where(F.col("n_term") > max(100, n_rows // s.common)).collect()})

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = known.value
        for p in parts:
            for key, text, most in zip(p.key, p.text, p.most):
                terms = [t for t in text_terms(text) if common.get(t, 0) * s.generalise <= most]
                yield pd.DataFrame({"key": [key] * len(terms), "term": terms, "most": most}).astype(
                    {"term": object, "most": "int64"})

    most = groups.groupBy("key").agg(F.max("n_entity").alias("most"))
    terms = (held.select("key", "text").join(most, "key").mapInPandas(run, "key binary, term string, most long")
             .join(n_term, "term").where(F.col("n_term") * s.generalise <= F.col("most")).drop("most"))
    return terms.join(groups, "key").where(F.col("n_term") * s.generalise <= F.col("n_entity")).withColumn(
        "n_rows", F.lit(n_rows))


def revealing_terms(pairs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(who, term, disclosure, bits, remove) of the pairs above the thresholds."""
    both = pairs.groupBy("who", "term").agg(
        F.count("*").alias("texts"), F.sum("copies").alias("n"),
        *[F.max(c).alias(c) for c in ("n_entity", "n_term", "n_rows")])
    # distinct texts behind it: copies do not make a term more telling
    sure = F.when(F.col("texts") < s.firm, 1 - F.pow(F.lit(0.5), F.col("texts"))).otherwise(1.0)
    n = sure * F.col("n")
    bits = F.log2(n * F.col("n_rows") / (F.col("n_term") * F.col("n_entity")))
    return both.select("who", "term", (n / F.col("n_term")).alias("disclosure"), bits.alias("bits")).where(
        (F.col("disclosure") >= s.generalise) & (F.col("bits") >= s.min_bits)).withColumn(
        "remove", F.col("disclosure") >= s.remove)


def term_spans(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(key, terms): for each text with personal data, the spans of the terms
    that reveal one of its entities, by start: array of (start, stop, remove)."""
    held = materialised(_holders(docs))
    pairs = materialised(_pairs(docs, held, s))
    bad = revealing_terms(pairs, s)
    hits = pairs.join(bad, ["who", "term"]).groupBy("key", "term").agg(F.max("remove").alias("remove"))
    hits = hits.groupBy("key").agg(F.collect_list(F.struct("term", "remove")).alias("hits"))

    @F.pandas_udf("array<struct<start:int,stop:int,remove:boolean>>")
    def places(texts: pd.Series, hits: pd.Series) -> pd.Series:
        out = []
        for t, h in zip(texts, hits):
            gone = {x["term"]: bool(x["remove"]) for x in h}
            out.append([{"start": a, "stop": b, "remove": gone[w]}
                        for w, a, b in term_places(t, find(t)) if w in gone])
        return pd.Series(out, dtype=object)

    return held.join(hits, "key").select("key", places("text", "hits").alias("terms"))


def scan(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every
    row.  A null or empty text has no spans; null ids and repeated rows are
    kept; an empty table gives no rows; other columns are ignored.
    ``spans`` lists the base spans by kind, then the term spans by start."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            rows = []
            for doc_id, text in zip(p.doc_id, p.text):
                found = find(text)
                base = ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in found)
                n = [sum(k == i for k, _, _ in found) for i in range(4)]
                rows.append((doc_id, *n, hashlib.sha256(base.encode()).hexdigest(), base,
                             text_key(text or "")))
            yield pd.DataFrame(rows, columns=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256",
                                              "base", "key"]).astype({"doc_id": "Int64"})

    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
             "base string, key binary")
    extra = term_spans(docs, s).select("key", F.array_join(F.transform("terms", lambda x: F.concat_ws(
        ":", F.lit(TERM), x["start"].cast("string"), x["stop"].cast("string"))), ",").alias("extra"))
    return base.join(extra, "key", "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
        F.concat_ws(",", F.when(F.col("base") != "", F.col("base")), "extra").alias("spans"))


def rewrite(text: str, found: list[tuple[int, int, int]], terms) -> str:
    """``text`` with mentions generalised to their kind and revealing terms
    generalised to [TERM] or removed; overlapping mentions merge, the first names them."""
    edits = sorted([(a, b, f"[{KINDS[k].upper()}]") for k, a, b in found]
                   + [(int(a), int(b), "" if gone else "[TERM]") for a, b, gone in terms])
    out, at = [], 0
    for a, b, new in edits:
        if a < at:
            at = max(at, b)
            continue
        out += [text[at:a], new]
        at = b
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` with rewritten texts, all columns and rows kept.  Only rows
    with personal data are joined with the term spans; the others pass as they are."""
    marked = docs.withColumn("__key", _holder_key("text"))
    # written, so that no task both places the terms and rewrites, in two workers
    spans = materialised(term_spans(docs, s)).withColumnRenamed("key", "__key").withColumnRenamed("terms", "__terms")

    @F.pandas_udf("string")
    def rewritten(texts: pd.Series, terms: pd.Series) -> pd.Series:
        return pd.Series([
            rewrite(t, find(t), [] if e is None else [(x["start"], x["stop"], x["remove"]) for x in e])
            for t, e in zip(texts, terms)], dtype=object)

    clean = marked.where(F.col("__key").isNull()).select(*docs.columns)
    joined = marked.where(F.col("__key").isNotNull()).join(spans, "__key", "left")
    return clean.unionByName(
        joined.withColumn("text", rewritten("text", "__terms")).select(*docs.columns))
