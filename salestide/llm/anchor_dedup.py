"""Substring de-duplication with fixed-block anchors.

Each document's words are cut into non-overlapping blocks of half a window;
the blocks are the reference index.  Every rolling half-window probes it: a
repeat of at least one window always contains a whole block of its earlier
copy.  Where a probe hits a block that stands elsewhere too, the hit is
extended: the windows around it are compared, and runs of equal windows are
the maximal exact repeats.  A word is removed if a window that covers it
starts earlier somewhere (smaller id, or the same document, earlier).

How it is spread: documents are dealt to chunks by a hash of their id.  A
chunk sends each distinct key once, sorted and delta-coded, to the bucket
that owns its key range; the bucket answers one bit per key.  A third of all
rows being copies therefore costs each chunk one key per window, whatever the
number of copies, and no task sees a group of copies or of candidate pairs.
Probe keys have 48 bits (a false hit only costs a comparison); windows are
compared by 96 bits of independent hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.llm.common import partitions
from salestide.llm.grams import U, mix, windows, words_of

WINDOW = 20
KEY_BITS = 48
HASH_BYTES = 2_000_000      # of text hashed at a time in a task
_SCHEMA = "bucket int, chunk int, body binary"


class Chunk:
    """The documents of a chunk in order (id, then text; equal rows once) and their words."""

    def __init__(self, table: pa.Table, window: int):
        ids = table.column("doc_id").to_pylist()
        texts = [t or b"" for t in table.column("text").cast(pa.binary()).to_pylist()]
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is not None, ids[i] or 0, texts[i]))
        self.rows: list[list[int]] = []      # the input rows of each document
        for i in order:
            last = self.rows[-1][0] if self.rows else None
            if last is not None and ids[last] == ids[i] and texts[last] == texts[i]:
                self.rows[-1].append(i)
            else:
                self.rows.append([i])
        self.ids = [ids[r[0]] for r in self.rows]
        self.texts = [texts[r[0]] for r in self.rows]
        parts, counts, batch, size = [], [], [], 0
        for n, t in enumerate(self.texts):
            batch.append(t)
            size += len(t)
            if size >= HASH_BYTES or n + 1 == len(self.texts):
                words = words_of(batch)
                parts.append(words.hashes)
                counts.append(np.diff(words.first))
                batch, size = [], 0
        self.words = np.concatenate(parts) if parts else np.empty(0, U)
        self.n_words = np.concatenate(counts) if counts else np.empty(0, np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n_words)]).astype(np.int64)
        self.doc = np.repeat(np.arange(len(self.ids)), self.n_words)
        self.window, self.half = window, window // 2

    def starts(self, k: int) -> np.ndarray:
        """Positions where a run of ``k`` words of one document begins."""
        n = len(self.words) - k + 1
        return np.flatnonzero(self.doc[:n] == self.doc[k - 1:]) if n > 0 else np.empty(0, np.int64)

    def probes(self):
        """(starts, sorted distinct keys, number of the key at each start, is it a
        block, does it come more than once) of the rolling half-windows."""
        at = self.starts(self.half)
        keys = windows(self.words, self.half, seed=self.half)[at] >> U(64 - KEY_BITS)
        distinct, number, count = np.unique(keys, return_inverse=True, return_counts=True)
        block = np.zeros(len(distinct), bool)
        block[number[(at - self.first[self.doc[at]]) % self.half == 0]] = True
        return at, distinct, number, block, count > 1

    def candidates(self, at: np.ndarray, hit: np.ndarray):
        """(starts, hash, check) of the windows that hold a hit half-window."""
        mark = np.zeros(len(self.words) + 1, np.int64)
        mark[at + 1] = hit
        total = np.concatenate([np.cumsum(mark), [0]])
        starts = self.starts(self.window)
        starts = starts[total[starts + self.window - self.half + 1] > total[starts]]
        h = windows(self.words, self.window, seed=self.window)[starts]
        with np.errstate(over="ignore"):
            other = windows(mix(self.words + U(0x5851F42D4C957F2D)), self.window, seed=3)[starts]
        return starts, h, (other >> U(32)).astype(np.uint32)


def _edges(n_buckets: int) -> np.ndarray:
    return np.array([(b << KEY_BITS) // n_buckets for b in range(n_buckets + 1)], dtype=U)


def _split(keys: np.ndarray, n_buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, from, to) of the sorted 48-bit ``keys``, for buckets that get any."""
    cut = np.searchsorted(keys, _edges(n_buckets))
    return [(b, int(x), int(y)) for b, (x, y) in enumerate(zip(cut, cut[1:])) if y > x]


def _pack(keys: np.ndarray) -> bytes:
    step = np.diff(keys, prepend=keys[:1])
    if step.max() < U(1 << 32):
        return b"\x04" + keys[:1].tobytes() + step.astype(np.uint32).tobytes()
    return b"\x08" + keys.tobytes()


def _unpack(body: bytes, n: int) -> tuple[np.ndarray, bytes]:
    if body[0] == 8:
        return np.frombuffer(body, U, n, 1), body[1 + 8 * n:]
    first = np.frombuffer(body, U, 1, 1)
    return first + np.cumsum(np.frombuffer(body, np.uint32, n, 9), dtype=U), body[9 + 4 * n:]


def _bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def _flags(body: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(body, np.uint8), count=n).astype(bool)


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    cols = list(zip(*rows)) or [[], [], []]
    return pa.table({"bucket": pa.array(cols[0], pa.int32()), "chunk": pa.array(cols[1], pa.int32()),
                     "body": pa.array(cols[2], pa.binary())})


def _size(n: int) -> bytes:
    return int(n).to_bytes(8, "little")


def _sized(body: bytes) -> tuple[int, bytes]:
    return int.from_bytes(body[:8], "little"), body[8:]


def _groups(keys: tuple[np.ndarray, ...]):
    """(order, group number in that order) of rows grouped by ``keys``."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    return order, np.cumsum(new)


def _own_keys(window: int, n_buckets: int):
    def send(key, table):
        chunk = Chunk(table, window)
        _, keys, _, block, again = chunk.probes()
        return _table([(b, key[0].as_py(), _size(y - x) + _pack(keys[x:y]) + _bits(block[x:y]) + _bits(again[x:y]))
                       for b, x, y in _split(keys, n_buckets)])
    return send


def _match_keys(key, table):
    """A bucket of the index: a key is a hit if it is a block and comes more than once."""
    keys, block, again, sizes = [], [], [], []
    for body in table.column("body").to_pylist():
        n, body = _sized(body)
        k, body = _unpack(body, n)
        keys.append(k)
        block.append(_flags(body[:-(-n // 8)], n))
        again.append(_flags(body[-(-n // 8):], n))
        sizes.append(n)
    order, group = _groups((np.concatenate(keys),))
    block, again = np.concatenate(block)[order], np.concatenate(again)[order]
    hit = (np.bincount(group, block) > 0) & (np.bincount(group, 1 + again) > 1)
    out = np.empty(len(order), bool)
    out[order] = hit[group]
    return _answers(key, table, out, sizes)


def _answers(key, table: pa.Table, flags: np.ndarray, sizes: list[int]) -> pa.Table:
    ends = np.cumsum(sizes)
    return _table([(key[0].as_py(), c, _bits(flags[e - n:e]))
                   for c, n, e in zip(table.column("chunk").to_pylist(), sizes, ends)])


def _hits(chunk: Chunk, answers: dict[int, bytes], n_buckets: int):
    at, keys, number, _, _ = chunk.probes()
    hit = np.zeros(len(keys), bool)
    for b, x, y in _split(keys, n_buckets):
        hit[x:y] = _flags(answers[b], y - x)
    return at, hit[number]


def _distinct(chunk: Chunk, answers: dict[int, bytes], n_buckets: int):
    """Candidate windows: starts, the number of each one's key, and per key its
    hash, check and first candidate (keys in hash order)."""
    starts, h, check = chunk.candidates(*_hits(chunk, answers, n_buckets))
    order, group = _groups((h, check))
    number = np.empty(len(order), np.int64)
    number[order] = group
    firsts = order[np.flatnonzero(np.diff(group, prepend=-1))] if len(order) else order
    return starts, number, h[firsts], check[firsts], firsts


def _by_bucket(table: pa.Table) -> dict[int, bytes]:
    return dict(zip(table.column("bucket").to_pylist(), table.column("body").to_pylist()))


_LEAST = -(1 << 63)


def _own_windows(window: int, n_buckets: int):
    def send(key, docs, answers):
        if not docs.num_rows:
            return _table([])
        chunk = Chunk(docs, window)
        starts, _, h, check, firsts = _distinct(chunk, _by_bucket(answers), n_buckets)
        ids = np.array([_LEAST if i is None else i for i in chunk.ids], np.int64)
        low = ids[chunk.doc[starts[firsts]]]
        rows = []
        for b, x, y in _split(h >> U(64 - KEY_BITS), n_buckets):
            base = int(low[x:y].min())
            wide = int(low[x:y].max()) - base >= 1 << 32
            who = low[x:y].tobytes() if wide else (low[x:y] - base).astype(np.uint32).tobytes()
            rows.append((b, key[0].as_py(), _size(y - x) + h[x:y].tobytes() + check[x:y].tobytes()
                         + (b"\x08" if wide else b"\x04" + np.int64(base).tobytes()) + who))
        return _table(rows)
    return send


def _match_windows(key, table):
    """Whether another chunk holds the window in a smaller document."""
    hs, checks, ids, sizes = [], [], [], []
    for body in table.column("body").to_pylist():
        n, body = _sized(body)
        hs.append(np.frombuffer(body, U, n))
        checks.append(np.frombuffer(body, np.uint32, n, 8 * n))
        rest = body[12 * n:]
        ids.append(np.frombuffer(rest, np.int64, n, 1) if rest[0] == 8 else
                   np.frombuffer(rest, np.int64, 1, 1) + np.frombuffer(rest, np.uint32, n, 9))
        sizes.append(n)
    order, group = _groups((np.concatenate(hs), np.concatenate(checks)))
    low = np.concatenate(ids)[order]
    least = np.minimum.reduceat(low, np.flatnonzero(np.diff(group, prepend=-1)))
    out = np.empty(len(order), bool)
    out[order] = low > least[group]
    return _answers(key, table, out, sizes)


def _removed(window: int, n_buckets: int):
    """Per row: words, removed words and the digest of what is kept."""
    def finish(key, docs, answers):
        out: list[tuple] = [()] * docs.num_rows
        if docs.num_rows:
            chunk = Chunk(docs, window)
            kinds = answers.column("kind").to_pylist()
            hits = _by_bucket(answers.filter(pa.array([k == 0 for k in kinds], pa.bool_())))
            earlier = _by_bucket(answers.filter(pa.array([k == 1 for k in kinds], pa.bool_())))
            starts, number, h, _, firsts = _distinct(chunk, hits, n_buckets)
            seen = np.zeros(len(h), bool)
            for b, x, y in _split(h >> U(64 - KEY_BITS), n_buckets):
                seen[x:y] = _flags(earlier[b], y - x)
            first = np.zeros(len(starts), bool)
            first[firsts] = True
            gone = starts[seen[number] | ~first]
            mark = np.zeros(len(chunk.words) + 1, np.int64)
            np.add.at(mark, gone, 1)
            np.add.at(mark, gone + window, -1)
            covered = np.cumsum(mark)[:-1] > 0
            for d, rows in enumerate(chunk.rows):
                a, b = chunk.first[d], chunk.first[d + 1]
                words = chunk.texts[d].split()   # splits bytes at the same white space
                cover = covered[a:b]
                n = int(cover.sum())
                if n:
                    words = [w for w, c in zip(words, cover.tolist()) if not c]
                digest = hashlib.sha256(b" ".join(words)).hexdigest()
                for i in rows:
                    out[i] = (chunk.ids[d], int(b - a), n, digest)
        cols = list(zip(*out)) or [[], [], [], []]
        return pa.table({"doc_id": pa.array(cols[0], pa.int64()), "n_words": pa.array(cols[1], pa.int64()),
                         "n_removed": pa.array(cols[2], pa.int64()),
                         "kept_sha256": pa.array(cols[3], pa.string())})
    return finish


def remove_repeats(docs: DataFrame, window: int = WINDOW, n_chunks: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row of ``docs``.

    Null and empty texts have no words (the digest is that of nothing); a
    null id comes before all others; rows with one id are one place in the
    order, told apart by their text, and repeated rows are one document;
    texts shorter than a window lose nothing; other columns are ignored; an
    empty table gives no rows.  ``n_chunks`` follows the session's shuffle
    partitions, so a chunk's size does not grow with the data.
    """
    parts = partitions(docs.sparkSession)
    n_chunks = n_chunks or 2 * parts
    chunked = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text",
        F.pmod(F.xxhash64(F.col("doc_id").cast("long")), F.lit(n_chunks)).cast("int").alias("chunk"))
    by_chunk = chunked.groupBy("chunk")
    keys = by_chunk.applyInArrow(_own_keys(window, parts), _SCHEMA)
    hits = keys.groupBy("bucket").applyInArrow(_match_keys, _SCHEMA)
    found = by_chunk.cogroup(hits.groupBy("chunk")).applyInArrow(_own_windows(window, parts), _SCHEMA)
    earlier = found.groupBy("bucket").applyInArrow(_match_windows, _SCHEMA)
    answers = hits.withColumn("kind", F.lit(0)).unionByName(earlier.withColumn("kind", F.lit(1)))
    return by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(
        _removed(window, parts), "doc_id long, n_words long, n_removed long, kept_sha256 string")
