"""Target-distribution importance resampling over hashed word n-grams.

Features are the runs of one to three words of a text; a feature's bucket is
the CRC-32 of its bytes modulo the number of buckets.  Two bags of buckets,
raw and target, give every bucket a gain (a scaled log ratio); a text weighs
the sum of its features' gains, an array look-up a feature.  The draw without
replacement takes the largest weights after Gumbel noise that depends on the
id alone.

The k-th largest key is found by a distributed quickselect: random pivots
split the keys that may still be the k-th, an exact count of the rows before,
on and between the pivots tells which part holds it, and only that part goes
on.  Only the winners are sorted, by ranges.

CRC-32 is linear, so the checksum of a run of words follows from those of its
words: no run is ever written out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.llm.common import materialised, numbered

BUCKETS = 10_000
RUN = 3                # words of the longest run
MIN_WORDS = 20         # texts that take part in the draw
PERCENT = 5
SEED = 42
PIVOTS = 32            # wanted in each round of the quickselect
PIECE = 1 << 20        # bytes of text whose words are found at once
SHORT = 64             # lengths with a table of their own

# bytes that belong to words after lower-casing A-Z: digits, a-z, all above ASCII
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def _linear(size: int) -> np.ndarray:
    """[4][256]: what each byte of a checksum becomes after ``size`` zero bytes."""
    zero = zlib.crc32(bytes(size))
    return np.array([[zlib.crc32(bytes(size), v << (8 * k)) ^ zero for v in range(256)] for k in range(4)],
                    np.uint32)


class Checksums:
    """CRC-32 of words and of runs of words, for whole arrays."""

    def __init__(self):
        zeros = [bytes(i) for i in range(SHORT + 1)]
        self.zero = np.array([zlib.crc32(z) for z in zeros], np.uint32)
        # a byte followed by i others, in a word of zeros otherwise
        self.byte = np.array([[zlib.crc32(bytes([v]) + zeros[i]) for v in range(256)] for i in range(SHORT)],
                             np.uint32) ^ self.zero[1:, None]
        self.after = np.stack([_linear(i) for i in range(SHORT + 1)])
        self.doubled = {}

    def _apply(self, table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        return (table[0][crc & 255] ^ table[1][(crc >> 8) & 255]
                ^ table[2][(crc >> 16) & 255] ^ table[3][crc >> 24])

    def shift(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The part of ``crc`` in the checksum of its bytes and ``size`` more."""
        flat = self.after.reshape(-1)
        at = np.minimum(size, SHORT).astype(np.int64) * 1024
        out = (flat[at + (crc & 255)] ^ flat[at + 256 + ((crc >> 8) & 255)]
               ^ flat[at + 512 + ((crc >> 16) & 255)] ^ flat[at + 768 + (crc >> 24)])
        far = np.flatnonzero(size > SHORT)
        rest = size[far].astype(np.int64) - SHORT
        bit = 0
        while len(far) and (rest >> bit).any():
            if bit not in self.doubled:
                self.doubled[bit] = _linear(1 << bit)
            on = ((rest >> bit) & 1).astype(bool)
            out[far[on]] = self._apply(self.doubled[bit], out[far[on]])
            bit += 1
        return out

    def words(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(checksum, size, first byte) of every word of ``data``, found piece
        by piece; pieces end between words."""
        raw = _LOWER[np.frombuffer(data, np.uint8)]
        crcs, sizes, begins, a = [], [], [], 0
        while a < len(raw):
            b = a + PIECE
            while b < len(raw):
                gap = np.flatnonzero(~_IS_WORD[raw[b:b + PIECE]])
                if len(gap):
                    b += int(gap[0])
                    break
                b += PIECE
            part = raw[a:b]
            word = _IS_WORD[part]
            edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=np.int8(0), append=np.int8(0)))
            start, end = edge[0::2], edge[1::2]
            size = end - start
            if len(start):
                at = np.flatnonzero(word)
                left = np.repeat(end, size) - 1 - at     # bytes of the word that follow
                bits = self.byte.reshape(-1)[np.minimum(left, SHORT - 1) * 256 + part[at]]
                crc = np.bitwise_xor.reduceat(bits, np.cumsum(size) - size) ^ self.zero[np.minimum(size, SHORT)]
                for i in np.flatnonzero(size > SHORT):
                    crc[i] = zlib.crc32(part[start[i]:end[i]].tobytes())
                crcs.append(crc)
                sizes.append(size)
                begins.append(start + a)
            a = b
        if not crcs:
            return np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(crcs), np.concatenate(sizes), np.concatenate(begins)

    def features(self, texts: list[bytes]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """Per run length, (checksums, text number) of all runs; and the
        number of words of each text."""
        crc, size, begin = self.words(b"\n".join(texts))
        first = np.cumsum([0] + [len(t) + 1 for t in texts])
        owner = np.searchsorted(first, begin, side="right") - 1
        n_words = np.bincount(owner, minlength=len(texts))
        out, run = [(crc, owner)], crc
        if len(crc):
            blank = np.full(len(crc), zlib.crc32(b" "), np.uint32)
            spaced = self.shift(blank, size) ^ crc       # the word with a space before it
            for k in range(1, RUN):
                if len(crc) <= k:
                    break
                run = self.shift(run[:len(crc) - k], size[k:] + 1) ^ spaced[k:]
                same = owner[k:] == owner[:len(crc) - k]
                out.append((run[same], owner[k:][same]))
        return out, n_words


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of about ``PIECE`` bytes of text (a longer text alone)."""
    for batch in batches:
        texts = [(t or "").encode("utf-8", "surrogatepass") for t in batch.column(column).to_pylist()]
        a, held = 0, 0
        for b, t in enumerate(texts):
            if b > a and held + len(t) > PIECE:
                yield batch.slice(a, b - a), texts[a:b]
                a, held = b, 0
            held += len(t)
        if a < len(texts):
            yield batch.slice(a), texts[a:]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all ``texts`` fall into each bucket: one array a
    task, summed by bucket on the executors; ``buckets`` numbers are returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, total = Checksums(), np.zeros(buckets, np.int64)
        for _, part in _batches(batches, 0):
            for crc, _ in sums.features(part)[0]:
                total += np.bincount(crc % buckets, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(
            F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain, floor(1000 ln(smoothed target share / smoothed raw share))."""
    all_raw, all_target, n = float(raw.sum()), float(target.sum()), float(len(raw))
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_raw + n) / ((s + 1.0) * (all_target + n))))
                     for s, t in zip(raw.tolist(), target.tolist())], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)      # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, of = Checksums(), shared.value
        for batch, part in _batches(batches, 1):
            runs, n_words = sums.features(part)
            n, weight = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            for crc, owner in runs:
                n += np.bincount(owner, minlength=len(part))
                np.add.at(weight, owner, of[crc % len(of)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words), pa.array(n), pa.array(weight)],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")


def _before(key: tuple[int, int, int, int], strictly: bool):
    """Rows whose key (score falling, the rest rising) comes before ``key``, or on it."""
    score, *rest = key
    later = F.lit(not strictly)
    for name, value in reversed(list(zip(("id", "n_features", "row"), rest))):
        later = (F.col(name) < value) | ((F.col(name) == value) & later)
    return (F.col("score") > score) | ((F.col("score") == score) & later)


def kth_key(rows: DataFrame, k: int, n: int, pivots: int = PIVOTS) -> tuple[int, int, int, int]:
    """The ``k``-th (from 1) of the ``n`` composite keys (score, id,
    n_features, row) of ``rows``; keys are unique.  Each round draws about
    ``pivots`` random keys of the part that is left and counts it three ways
    about each of them."""
    names = ("score", "id", "n_features", "row")
    low, high, left, skipped, seed = None, None, n, 0, SEED
    while True:
        part = rows
        if low is not None:
            part = part.where(~_before(low, False))
        if high is not None:
            part = part.where(_before(high, True))
        drawn, odds = [], max(1, left // pivots)
        while not drawn:      # an unlucky draw is repeated with better odds
            seed += 1
            drawn = part.where(F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(odds)) == 0).select(*names).collect()
            odds = max(1, odds // 2)
        keys = sorted((tuple(r) for r in drawn), key=lambda r: (-r[0], *r[1:]))
        place = sum(((~_before(p, True)).cast("int") + (~_before(p, False)).cast("int") for p in keys), F.lit(0))
        counts = dict(part.groupBy(place.alias("place")).count().collect())
        for at in range(2 * len(keys) + 1):
            here = counts.get(at, 0)
            if skipped + here >= k:
                break
            skipped += here
        if at % 2:
            return keys[at // 2]
        low = keys[at // 2 - 1] if at else low
        high = keys[at // 2] if at // 2 < len(keys) else high
        left = here


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row of ``docs``.

    ``rank`` counts the drawn rows from 1 (null: not drawn): floor(percent *
    N / 100) of the N rows with ``min_words`` words or more.  Null and empty
    texts have no features (weight 0); null ids are kept, count as the empty
    id in the noise and come last among ties; repeated rows are rows of their
    own; other columns are ignored; an empty table gives no rows, an empty
    ``target`` a target without features.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
                                  .cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")
    base = materialised(weigh(docs, gain).select(
        "doc_id", "n_words", "n_features", "weight", (F.col("weight") + noise).alias("score"),
        F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("id"), F.monotonically_increasing_id().alias("row")))
    able = base.where(F.col("n_words") >= min_words)
    n = able.count()
    k = percent * n // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not k:
        return base.select(*columns, unranked)
    won = (F.col("n_words") >= min_words) & _before(kth_key(able, k, n), False)
    ranked = numbered(base.where(won), "rank", F.desc("score"), F.asc("id"), F.asc("n_features"), F.asc("row"))
    return ranked.select(*columns, F.col("rank").cast("long")).unionByName(
        base.where(~won).select(*columns, unranked))
