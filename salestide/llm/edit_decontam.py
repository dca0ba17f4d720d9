"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ from a passage of a document by
k = floor(rate * m) edits.  It is cut into k + 1 pieces: k edits leave at
least one of them untouched, so every passage within the budget holds one
piece exactly.  All pieces are found in one pass (Aho-Corasick); around each
hit, Myers' bit-parallel distance between the item and the best substring
decides.  Matching ignores case and the kind and amount of white space.

Items are a stated query set: they are taken in blocks of bounded size, each
block broadcast and matched against every whole text.  No shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERROR_RATE = 0.07
EXACT_BELOW = 24            # items shorter than this are matched without edits
BLOCK_CHARS = 2_000_000     # characters of items broadcast together

_WORD = re.compile(r"\S+")


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def cut(text: str, n: int) -> list[tuple[int, str]]:
    """``text`` in ``n`` pieces of near equal length, with their offsets."""
    at = [len(text) * i // n for i in range(n + 1)]
    return [(a, text[a:b]) for a, b in zip(at, at[1:])]


def myers(masks: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """(smallest edit distance of the pattern to a substring of ``text``, its
    first end); one step of a few integer operations per character."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for i, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = (ph << 1) & full
        pv = ((mh << 1) & full) | (full & ~(xv | ph))
        mv = ph & xv
        if score < best:
            best, end = score, i
    return best, end


def masks_of(pattern: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(pattern):
        out[c] = out.get(c, 0) | 1 << i
    return out


@dataclass
class Matcher:
    """The pieces of a block of items, compiled on first use in each worker."""

    items: list[tuple[int, str]]      # (item_id, normal text)
    rate: float = ERROR_RATE
    ready: tuple = field(default=(), repr=False)

    def __getstate__(self):
        return {**self.__dict__, "ready": ()}

    def budget(self, m: int) -> int:
        return 0 if m < EXACT_BELOW else int(self.rate * m + 1e-9)

    def _compile(self):
        found: dict[str, list[tuple[int, int]]] = {}
        patterns = []
        for n, (_, text) in enumerate(self.items):
            k = self.budget(len(text))
            patterns.append((text, k, masks_of(text), masks_of(text[::-1])))
            for at, piece in cut(text, k + 1):
                found.setdefault(piece, []).append((n, at))
        machine = ahocorasick.Automaton()
        for piece, where in found.items():
            machine.add_word(piece, (len(piece), where))
        if found:
            machine.make_automaton()
        self.ready = (machine if found else None, patterns)

    def matches(self, plain: str) -> list[tuple[int, int, int, int]]:
        """(item_id, distance, start, stop) of the best passage of each item
        found in the normal text ``plain`` (ties: the first)."""
        if not self.ready:
            self._compile()
        machine, patterns = self.ready
        if machine is None:
            return []
        best: dict[int, tuple[int, int, int]] = {}
        tried: dict[int, tuple[int, int]] = {}    # the stretch searched last for an item
        for last, (size, where) in machine.iter(plain):
            for n, at in where:
                text, k, masks, reverse = patterns[n]
                m = len(text)
                start = last + 1 - size - at
                lo, hi = max(0, start - k), min(len(plain), start + m + k)
                if n in best and best[n][0] == 0:
                    continue
                if n in tried and tried[n][0] <= lo and hi <= tried[n][1]:
                    continue
                tried[n] = (lo, hi)
                d, end = myers(masks, m, plain[lo:hi])
                if d > k or (n in best and best[n][0] <= d):
                    continue
                stop = lo + end
                _, length = myers(reverse, m, plain[max(0, stop - m - k):stop][::-1])
                best[n] = (d, stop - length, stop)
        return sorted((self.items[n][0], *found) for n, found in best.items())


def blocks(items: DataFrame, limit: int = BLOCK_CHARS) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of at most ``limit`` characters (one item at
    least), streamed through the driver.  Null and blank texts are no items;
    equal texts under several ids are all kept."""
    block, size = [], 0
    for row in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        text = normal(row.text)
        if not text:
            continue
        if block and size + len(text) > limit:
            yield block
            block, size = [], 0
        block.append((row.item_id, text))
        size += len(text)
    if block:
        yield block


def original_span(text: str, start: int, stop: int) -> tuple[int, int]:
    """Where a span of the normal text lies in ``text``."""
    at, a, b = 0, 0, len(text)
    for m in _WORD.finditer(text):
        size = len(m[0].lower())
        if at <= start < at + size + 1:
            a = min(m.end(), m.start() + start - at)
        if at < stop <= at + size + 1:
            b = min(m.end(), m.start() + stop - at)
            break
        at += size + 1
    return a, b


def contaminations(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """doc_id, item_id, distance, start, stop: for each row of ``docs`` and
    item, its best passage within the budget (code points of the text, stop
    exclusive).  Clean rows, null and empty texts give no rows; repeated rows
    give repeated rows; null ids are kept; other columns are ignored; without
    items or documents the result is empty."""
    schema = "doc_id long, item_id long, distance int, start int, stop int"
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    result = None
    for block in blocks(items):
        shared = spark.sparkContext.broadcast(Matcher(block, rate))

        def run(parts: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for p in parts:
                out = []
                for doc_id, text in zip(p.doc_id, p.text):
                    for item, d, a, b in shared.value.matches(normal(text)):
                        out.append((doc_id, item, d, *original_span(text, a, b)))
                yield pd.DataFrame(out, columns=["doc_id", "item_id", "distance", "start", "stop"]).astype(
                    {"doc_id": "Int64", "item_id": "Int64"})

        part = rows.mapInPandas(run, schema)
        result = part if result is None else result.unionByName(part)
    return spark.createDataFrame([], schema) if result is None else result


def drop_contaminated(docs: DataFrame, items: DataFrame, rate: float = ERROR_RATE) -> DataFrame:
    """``docs`` without the rows that hold a passage of an item; same columns."""
    for block in blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(Matcher(block, rate))

        @F.pandas_udf("boolean")
        def clean(texts: pd.Series) -> pd.Series:
            return pd.Series([not shared.value.matches(normal(t)) for t in texts], dtype=bool)

        docs = docs.where(clean("text"))
    return docs
