"""Toxicity scores by a factorization machine over hashed terms.

Terms are the distinct lower-case words of a text and their prefixes and
endings (in bytes), hashed into a fixed space, whole batches of texts at once.  A second-order factorization machine,

    logit = b + sum_i w_i + sum_{i<j} <v_i, v_j>      over the terms present,

learns pairwise interactions (an insult beside a group mention) that additive
weights miss.  It is fitted on a bounded, documented sample of labelled rows
(``Settings.sample``); scoring runs over every whole text on the executors
with the fitted model broadcast (its size is bounded by ``Settings.kept``).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salestide.llm.grams import U, mix, stream

PREFIXES, ENDING = (4, 5, 6), 4    # bytes of a word's prefixes and ending that are terms
PIECE = 1 << 20                    # bytes of text hashed at once
PLACES_AT_ONCE = 1 << 20           # places of terms sorted at once
ROWS_AT_ONCE = 1024                # sampled texts whose terms are counted at once

# words are runs of ASCII letters, digits and underscores, and of other characters' bytes
_WORD_BYTE = np.zeros(256, bool)
_WORD_BYTE[48:58] = _WORD_BYTE[97:123] = _WORD_BYTE[95] = _WORD_BYTE[128:] = True
_PLACES = 1 << 12                  # bytes of a word with a weight of their own
_WEIGHTS = stream(_PLACES, 11) | U(1)


@dataclass(frozen=True)
class Settings:
    sample: int = 16_000     # labelled rows used for fitting, at most
    bits: int = 20           # hash space of the terms
    min_docs: int = 4        # a term is kept if this many sampled texts hold it ...
    min_z: float = 4.0       # ... and its rate differs between the classes by so many deviations
    min_pair_z: float = 6.0  # ... or does so among the texts with such a term
    kept: int = 50_000       # terms kept, at most (the strongest)
    factors: int = 8
    epochs: int = 12
    batch: int = 128
    rate: float = 0.1
    decay: float = 1e-4
    seed: int = 7


@dataclass
class Model:
    """``terms``: kept hash values, sorted; weights ``w`` and factors ``v`` beside them."""

    bits: int
    terms: np.ndarray
    w: np.ndarray
    v: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        return float(self.scores([text])[0])

    def scores(self, texts) -> np.ndarray:
        """The probability of label 1 of each text, in batches of ``PIECE``
        bytes; the pairwise sum is taken as (|sum v|^2 - sum |v|^2) / 2."""
        place = np.full((1 << self.bits) + 1, -1, np.int32)
        place[self.terms] = np.arange(len(self.terms))
        out, a = np.full(len(texts), float(self.bias)), 0
        for part in _batches(texts):
            doc, term = terms_of(part, self.bits)
            at = place[term]
            doc, at = doc[at >= 0], at[at >= 0]
            if len(at):
                v = self.v[at]
                first = np.flatnonzero(np.diff(doc, prepend=-1))
                sums = np.add.reduceat(v, first)
                squares = np.add.reduceat((v * v).sum(axis=1), first)
                out[a + doc[first]] += np.add.reduceat(self.w[at], first) + 0.5 * (
                    (sums * sums).sum(axis=1) - squares)
            a += len(part)
        return 1.0 / (1.0 + np.exp(-np.clip(out, -30.0, 30.0)))


def _batches(texts) -> Iterator[list]:
    batch, held = [], 0
    for t in texts:
        batch.append(t)
        held += len(t or "")
        if held >= PIECE:
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def _word_terms(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(first byte of the word, 64-bit hash) of every term of every word of
    ``data``: the word, its prefixes and its ending, where it is longer."""
    raw = np.frombuffer(data, np.uint8)
    word = _WORD_BYTE[raw]
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.empty(0, np.int64), np.empty(0, U)
    size = end - start
    at = np.flatnonzero(word)
    offset = np.cumsum(size) - size
    within = at - np.repeat(start, size)
    with np.errstate(over="ignore"):
        # places beyond the table take a weight that still depends on where they are
        far = mix((within // _PLACES).astype(U)) | U(1) if size.max() > _PLACES else U(1)
        part = (raw[at].astype(U) + U(1)) * _WEIGHTS[within % _PLACES] * far
        starts, hashes = [start], [mix(np.add.reduceat(part, offset) + size.astype(U) * U(0x9E3779B97F4A7C15))]
        for n in PREFIXES:
            longer = size > n
            first = offset[longer]
            total = part[first].copy()
            for j in range(1, n):
                total += part[first + j]
            starts.append(start[longer])
            hashes.append(mix(total + U(n * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)))
        longer = size > ENDING
        last = end[longer]
        total = np.zeros(len(last), U)
        for j in range(ENDING):
            total += (raw[last - ENDING + j].astype(U) + U(1)) * _WEIGHTS[j]
        starts.append(start[longer])
        hashes.append(mix(total + U(0xA0761D6478BD642F)))
    return np.concatenate(starts), np.concatenate(hashes)


def terms_of(texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hashed term) of the distinct terms of each text, sorted."""
    data = [(t or "").lower().encode("utf-8", "surrogatepass") for t in texts]
    begins = np.cumsum([0] + [len(t) + 1 for t in data])
    whole, found, a = b"\n".join(data), [], 0
    while a < len(whole):
        b = a + PIECE
        while b < len(whole) and _WORD_BYTE[whole[b]]:     # pieces end between words
            b += 1
        start, h = _word_terms(whole[a:b])
        doc = np.searchsorted(begins, start + a, side="right") - 1
        found.append(np.unique((doc.astype(np.int64) << bits) | (h >> U(64 - bits)).astype(np.int64)))
        a = b
    keys = found[0] if len(found) == 1 else np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
    return keys >> bits, keys & ((1 << bits) - 1)


def text_terms(text: str | None, bits: int) -> np.ndarray:
    return terms_of([text], bits)[1].astype(np.int32)


def _deviations(every: np.ndarray, toxic: np.ndarray, n: int, n1: int) -> np.ndarray:
    """By how many deviations each term's rate differs between the classes."""
    p = (every + 1) / (n + 2)
    return (toxic - n1 * every / n) / np.sqrt(n1 * p * (1 - p) * max(1e-9, 1 - n1 / n) + 0.25)


def _counts(rows: list[np.ndarray], size: int) -> np.ndarray:
    """In how many rows each of ``size`` terms is; some rows at a time, as
    counting needs eight bytes a term."""
    total = np.zeros(size, np.int64)
    for a in range(0, len(rows), ROWS_AT_ONCE):
        part = np.bincount(np.concatenate(rows[a:a + ROWS_AT_ONCE]), minlength=size)
        total = part if not a else total + part
    return total


def _together(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The terms of all rows in one new array, and where each row begins in it."""
    start = np.cumsum([0] + [len(r) for r in rows])
    flat = np.empty(start[-1], np.int32)
    for a, b, r in zip(start, start[1:], rows):
        flat[a:b] = r
    return flat, start


def _each(flat: np.ndarray, start: np.ndarray) -> list[np.ndarray]:
    return [flat[a:b] for a, b in zip(start, start[1:])]


def _keep(flat: np.ndarray, start: np.ndarray, terms: np.ndarray, size: int) -> np.ndarray:
    """Puts the places of those terms that are among ``terms`` to the front of
    ``flat``, in its own memory and in order; where each row begins then."""
    place = np.full(size, -1, np.int32)
    place[terms] = np.arange(len(terms))
    begins, filled = np.zeros_like(start), 0
    for i in range(0, len(start) - 1, ROWS_AT_ONCE):
        mine = start[i:i + ROWS_AT_ONCE + 1]
        at = place[flat[mine[0]:mine[-1]]]
        kept = at >= 0
        begins[i:i + len(mine)] = filled + np.concatenate([[0], np.cumsum(kept)])[mine - mine[0]]
        flat[filled:begins[i + len(mine) - 1]] = at[kept]
        filled = begins[i + len(mine) - 1]
    return begins


def _select(rows: list[np.ndarray], y: np.ndarray, terms: np.ndarray, s: Settings) -> np.ndarray:
    """Which of ``terms`` (rows have their places) have a rate that differs
    significantly in the two classes, over all texts or among the texts with
    a term that does over all (its partners in a pair, however weak alone);
    the strongest, in order of place."""
    every = _counts(rows, len(terms))

    def deviations(texts: np.ndarray) -> np.ndarray:
        toxic = texts[y[texts] > 0]
        count = [_counts([rows[i] for i in part], len(terms)) for part in (toxic, texts[y[texts] <= 0])]
        n = count[0] + count[1]
        return np.where(n >= s.min_docs, np.abs(_deviations(n, count[0], len(texts), max(1, len(toxic)))), 0)

    z = deviations(np.arange(len(rows)))
    strong = z >= s.min_z
    first = np.flatnonzero(strong)
    # as many terms at a time as are in some millions of places
    for some in np.split(first, np.flatnonzero(np.diff(np.cumsum(every[first]) // PLACES_AT_ONCE)) + 1):
        wanted = np.zeros(len(terms), bool)
        wanted[some] = True
        held = [r[wanted[r]] for r in rows]
        flat, doc = np.concatenate(held), np.repeat(np.arange(len(held), dtype=np.int32), [len(r) for r in held])
        by = np.argsort(flat, kind="stable")
        for texts in np.split(doc[by], np.flatnonzero(np.diff(flat[by])) + 1):
            if 0 < y[texts].sum() < len(texts):
                beside = deviations(texts)
                z = np.where(beside >= s.min_pair_z, np.maximum(z, beside), z)
                strong |= beside >= s.min_pair_z
    strong = np.flatnonzero(strong)
    return np.sort(strong[np.argsort(-z[strong], kind="stable")][: s.kept])


def fit_rows(rows: list[np.ndarray], y: np.ndarray, s: Settings = Settings()) -> Model:
    """Fit the machine by mini-batch AdaGrad on hashed rows with 0/1 labels."""
    return _fit(*_together(rows), y, s)


def _fit(flat: np.ndarray, start: np.ndarray, y: np.ndarray, s: Settings) -> Model:
    """``fit_rows`` in the memory of ``flat`` (which is overwritten): the
    driver holds the sampled terms once."""
    y = np.asarray(y, dtype=float)
    n1 = float(y.sum())
    prior = float(np.log((n1 + 0.5) / (len(y) - n1 + 0.5))) if len(y) else -2.0
    terms = np.empty(0, np.int64)
    if len(flat):
        terms = np.flatnonzero(_counts(_each(flat, start), 1 << s.bits) >= s.min_docs)
        start = _keep(flat, start, terms, 1 << s.bits)
        chosen = _select(_each(flat, start), y, terms, s)
        start = _keep(flat, start, chosen, len(terms))
        terms = terms[chosen]
    rng = np.random.default_rng(s.seed)
    w = np.zeros(len(terms))
    v = rng.normal(0, 0.02, (len(terms), s.factors))
    if not len(terms) or n1 in (0, len(y)):
        return Model(s.bits, terms, w, v * 0, prior)
    rows = _each(flat, start)
    gw, gv, gb, bias = np.full(len(w), 1e-2), np.full(v.shape, 1e-2), 1e-2, prior
    for _ in range(s.epochs):
        order = rng.permutation(len(rows))
        for a in range(0, len(order), s.batch):
            part = order[a:a + s.batch]
            size = np.array([len(rows[i]) for i in part])
            idx = np.concatenate([rows[i] for i in part]).astype(np.int64)
            doc, some = np.repeat(np.arange(len(part)), size), size > 0
            first = (np.cumsum(size) - size)[some]
            vi = v[idx]
            sums, half = np.zeros((len(part), s.factors)), np.zeros(len(part))
            if len(idx):
                sums[some] = np.add.reduceat(vi, first)
                half[some] = np.add.reduceat(w[idx] - 0.5 * (vi * vi).sum(axis=1), first)
            z = np.clip(bias + half + 0.5 * (sums * sums).sum(axis=1), -30, 30)
            err = (1 / (1 + np.exp(-z)) - y[part]) / len(part)
            gb += err.sum() ** 2
            bias -= s.rate * err.sum() / np.sqrt(gb)
            if not len(idx):
                continue
            by = np.argsort(idx, kind="stable")        # the places of each term together
            term, whose = idx[by], doc[by]
            edge = np.flatnonzero(np.diff(term, prepend=-1))
            used, share = term[edge], err[whose]
            dw = np.add.reduceat(share, edge) + s.decay * w[used]
            dv = np.add.reduceat(share[:, None] * (sums[whose] - vi[by]), edge) + s.decay * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            w[used] -= s.rate * dw / np.sqrt(gw[used])
            v[used] -= s.rate * dv / np.sqrt(gv[used])
    return Model(s.bits, terms, w, v, bias)


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: CRC-32 of the id as text, modulo 5, is 0 (null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Fit on at most ``s.sample`` labelled texts that are not held out, taken
    in the order of a hash of their id.  Null ids, labels or texts are
    skipped; a repeated id counts once (toxic if any of its labels is).
    Without labels of both kinds, every score is the prior."""
    chosen = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                           & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.max("toxic").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(s.sample))
    rows = (docs.where(F.col("text").isNotNull()).select("doc_id", "text")
            .join(F.broadcast(chosen), "doc_id"))  # at most s.sample ids
    bits = s.bits

    def hashed(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            yield pd.DataFrame({"doc_id": p.doc_id, "y": p.y,
                                "terms": [text_terms(t, bits).tobytes() for t in p.text]})

    once = rows.mapInPandas(hashed, "doc_id long, y int, terms binary").groupBy("doc_id").agg(
        F.max(F.struct("terms", "y")).alias("r"))
    # one row for each of at most s.sample ids; a row has 2**bits terms at most.
    # Arrow, so that the terms are held once: as Row objects they were held
    # three times, pickled on the way
    found = once.select("doc_id", "r.y", "r.terms").toArrow()
    order = np.argsort(found["doc_id"].to_numpy(), kind="stable")
    terms, y = found["terms"], found["y"].to_numpy()[order]
    flat, start = _together([np.frombuffer(terms[int(i)].as_buffer(), np.int32) for i in order])
    del found, terms
    pa.default_memory_pool().release_unused()      # Arrow would keep it while the model is fitted
    return _fit(flat, start, y, s)


def score_column(spark, model: Model, text: Column) -> Column:
    """The score of ``text`` (0 to 1; empty and null texts: the bias alone)."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(texts.tolist()), dtype="float64")

    return scores(text)


def score_documents(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row (repeated rows and
    null ids kept, other columns ignored, empty table: no rows)."""
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         score_column(docs.sparkSession, model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; same columns."""
    return docs.where(score_column(docs.sparkSession, model, F.col("text")) < threshold)
