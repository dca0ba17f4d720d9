"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Pieces and log scores come from a SentencePiece model file (its path is a
parameter; nothing is trained).  The trie holds the UTF-8 bytes of the normal
pieces in two integer arrays (``base``, ``check``); the Viterbi search walks
it from every character and keeps the best score per position.  A character
that no piece covers falls back to its byte pieces.  Spaces are written with
the marker U+2581 and one is put before the text; a literal U+2581 goes
through byte fallback, so decoding gives back every text exactly.

No piece of such a model has a space after another character, so the best
segmentation splits before every run of spaces; the split parts are solved
once each and kept in a bounded cache.  (A model that has such pieces is
solved over whole texts.)
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARKER = "▁"
UNKNOWN_PENALTY = 10.0     # below the lowest score, as in SentencePiece
CACHED, CACHED_CHARS = 120_000, 48   # parts kept, twice (recent and before), and how long

_PARTS = re.compile(" *[^ ]+| +")


def double_array(keys: dict[bytes, int]) -> tuple[array, array, array]:
    """(base, check, value) of a trie over byte strings: from state s, byte c
    leads to t = base[s] + c + 1 if check[t] == s; value[t] is the id that
    ends there, or -1.  States are placed breadth-first at the first fit."""
    tree: list[dict[int, int]] = [{}]
    ends: dict[int, int] = {}
    for key, i in keys.items():
        at = 0
        for c in key:
            nxt = tree[at].get(c)
            if nxt is None:
                nxt = tree[at][c] = len(tree)
                tree.append({})
            at = nxt
        ends[at] = i
    size = 1024
    base, check, value = array("i", [0]) * size, array("i", [-1]) * size, array("i", [-1]) * size
    check[0] = 0
    first, queue = 1, deque([(0, 0)])
    value[0] = ends.get(0, -1)
    while queue:
        node, state = queue.popleft()
        codes = sorted(c + 1 for c in tree[node])
        if not codes:
            continue
        at = max(first, codes[0])
        begun, taken = at, 0
        while True:
            offset = at - codes[0]
            if offset + 257 >= size:
                grow = size
                base.extend(array("i", [0]) * grow)
                check.extend(array("i", [-1]) * grow)
                value.extend(array("i", [-1]) * grow)
                size += grow
            if check[at] >= 0:
                taken += 1
            elif all(check[offset + c] < 0 for c in codes):
                break
            at += 1
        if taken >= 0.9 * (at - begun + 1):
            first = at  # a stretch this full is not searched again
        base[state] = offset
        for c in codes:
            t, child = offset + c, tree[node][c - 1]
            check[t], value[t] = state, ends.get(child, -1)
            queue.append((child, t))
    return base, check, value


@dataclass
class Pieces:
    """A compiled model: the trie, the score of each id, the bytes each id
    decodes to, and the ids of the 256 byte pieces."""

    base: array
    check: array
    value: array
    scores: list[float]
    decoded: list[bytes]
    byte_ids: list[int]
    unknown: float
    by_words: bool
    longest: int             # bytes of the longest piece
    walk: tuple = ()
    cache: dict = field(default_factory=dict, repr=False)
    before: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "cache": {}, "before": {}, "walk": ()}

    @classmethod
    def compile(cls, pieces: list[tuple[str, float, str]]) -> "Pieces":
        """From (piece, score, kind) in id order, kind one of normal, byte, other."""
        normal = {p.replace(MARKER, " ").encode(): i for i, (p, _, k) in enumerate(pieces) if k == "normal"}
        byte_ids = [-1] * 256
        decoded = []
        for i, (p, _, k) in enumerate(pieces):
            if k == "byte":
                byte_ids[int(p[3:5], 16)] = i
                decoded.append(bytes([int(p[3:5], 16)]))
            else:
                decoded.append(p.replace(MARKER, " ").encode() if k == "normal" else b"")
        if min(byte_ids) < 0:
            raise ValueError("byte fallback needs a piece for each of the 256 bytes")
        low = min((s for _, s, k in pieces if k == "normal"), default=0.0)
        return cls(*double_array(normal), [s for _, s, _ in pieces], decoded, byte_ids,
                   low - UNKNOWN_PENALTY, not any(re.search(rb"[^ ] ", p) for p in normal),
                   max(map(len, normal), default=1))

    @classmethod
    def load(cls, path: str) -> "Pieces":
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)

        def kind(i: int) -> str:
            if sp.is_byte(i):
                return "byte"
            return "other" if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) else "normal"

        return cls.compile([(sp.id_to_piece(i), sp.get_score(i), kind(i))
                            for i in range(sp.get_piece_size())])

    def segment(self, part: str) -> bytes:
        """Best ids of ``part`` (spaces as they are), as native 32-bit integers."""
        data = part.encode("utf-8", "surrogatepass")
        if not self.walk:
            # plain lists are faster to index, and the guard ends every walk
            self.walk = (self.base.tolist() + [0] * 257, self.check.tolist() + [-1] * 257,
                         self.value.tolist() + [-1] * 257)
        base, check, value = self.walk
        scores, unknown = self.scores, self.unknown
        n = len(data)
        best = [float("-inf")] * (n + 1)
        back = [0] * (n + 1)     # start of the piece that ends here
        ids = [-1] * (n + 1)     # -1: a character through byte fallback
        best[0] = 0.0
        at = 0
        while at < n:
            here, lead = best[at], data[at]
            after = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            state, j, single = 0, at, False
            for c in data[at:at + self.longest]:
                t = base[state] + c + 1
                if check[t] != state:
                    break
                state = t
                j += 1
                i = value[t]
                if i >= 0:
                    s = here + scores[i]
                    if s > best[j]:
                        best[j] = s
                        back[j] = at
                        ids[j] = i
                    if j == after:
                        single = True
            if not single and here + unknown > best[after]:
                best[after], back[after], ids[after] = here + unknown, at, -1
            at = after
        out = []
        while n:
            a, i = back[n], ids[n]
            if i >= 0:
                out.append(i)
            else:
                out.extend(self.byte_ids[b] for b in reversed(data[a:n]))
            n = a
        out.reverse()
        return array("i", out).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        if not self.by_words:
            return np.frombuffer(self.segment(" " + text), np.int32)
        recent, out = self.cache, []
        for part in _PARTS.findall(" " + text):
            ids = recent.get(part)
            if ids is None:
                ids = self.before.get(part) or self.segment(part)
                if len(part) <= CACHED_CHARS:
                    if len(recent) >= CACHED:   # what is not asked for again goes
                        self.before = recent
                        recent = self.cache = {}
                    recent[part] = ids
            out.append(ids)
        return np.frombuffer(b"".join(out), np.int32)

    def decode(self, ids) -> str:
        data = b"".join(map(self.decoded.__getitem__, ids))
        return data[1:].decode("utf-8", "surrogatepass")


def _flat(counts: list[int], ids: list[np.ndarray], valid: list[bool]) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    values = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
    return pa.ListArray.from_arrays(pa.array(offsets), values,
                                    mask=pa.array([not v for v in valid]))


def encode_documents(docs: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id, n_pieces, ids and round_trip (decoding gives the text back) of
    every row.  Null text: null ids, 0 pieces, round_trip true; empty text:
    no ids.  Null ids and repeated rows are kept, other columns ignored, an
    empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for whole in batches:
            for a in range(0, whole.num_rows, 400):
                batch = whole.slice(a, 400)
                texts = batch.column(1).to_pylist()
                ids = [p.encode(t) if t else np.empty(0, np.int32) for t in texts]
                counts = [len(i) for i in ids]
                same = [p.decode(i.tolist()) == (t or "") for i, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts, pa.int64()),
                     _flat(counts, ids, [t is not None for t in texts]), pa.array(same, pa.bool_())],
                    names=["doc_id", "n_pieces", "ids", "round_trip"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def decode_documents(encoded: DataFrame, pieces: Pieces) -> DataFrame:
    """doc_id and text from doc_id and ids (null ids: null text)."""
    shared = encoded.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if i is None else shared.value.decode(i) for i in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
