"""Alignment of two tokenizations of the same texts by their byte ends.

Each tokenization of a text is the rising list of the byte offsets at which
its tokens end.  The shorter list of the two drives a galloping search into
the longer: from the last place found, steps of 1, 2, 4... until an end is
not smaller, then a binary search inside the last step.  The ends found in
both lists cut the text into groups of tokens that cover the same bytes; the
ranks of two neighbouring ends bound the range of tokens that overlap the
token between them, so all links follow without comparing pairs.

How often two ids are linked is counted by document over the whole corpus.
Tasks work on chunks of documents.  A chunk's distinct links are a small
dictionary: the chunk writes its documents' links as places in it.  Only
dictionaries are exploded, counted and joined with the counts; a chunk's
documents then meet its counted dictionary.  No link of a document travels by
itself, and nothing is collected.

The tokenizers are given as files and only applied.  Texts are encoded in
parts cut before a space after other text, where neither tokenizer has a token
across (byte-level BPE splits there first, and no sentence piece has a space
after another character); a part that comes again is encoded once.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.session import scratch_path

BATCH_CHARS = 1 << 19      # characters encoded together (a longer text alone)
CACHED, CACHED_CHARS = 200_000, 48     # parts kept by a worker, twice (recent and before), and how long
JOINED_CHARS = 1 << 16     # characters of new parts encoded as one text
CHUNK_CHARS = 1 << 22      # characters of the documents that share a dictionary
BLOCK = 1 << 18            # tokens whose links are written out at once
MARKER = "\u2581"          # a space in sentence pieces
SHIFT = 32                 # a link: first id * 2**SHIFT + second id


def byte_of_character() -> dict[str, int]:
    """Byte-level BPE writes every byte as one character: printable Latin-1
    characters stand for themselves, the other bytes, in order, for the
    characters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@dataclass
class Tokenizers:
    """Both tokenizers: what travels are their files' contents."""

    first: str                  # a ``tokenizers`` JSON file (byte-level BPE)
    second: bytes               # a ``sentencepiece`` model
    loaded: list = field(default_factory=list, repr=False)
    cache: dict = field(default_factory=dict, repr=False)
    before: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"first": self.first, "second": self.second, "loaded": [], "cache": {}, "before": {}}

    @classmethod
    def load(cls, first: str, second: str) -> "Tokenizers":
        with open(first, encoding="utf-8") as a, open(second, "rb") as b:
            return cls(a.read(), b.read())

    def parts(self):
        if not self.loaded:
            import sentencepiece
            from tokenizers import Tokenizer
            a = Tokenizer.from_str(self.first)
            a.encode_special_tokens = True
            b = sentencepiece.SentencePieceProcessor(model_proto=self.second)
            plain = byte_of_character()
            of_a = [b""] * (max(a.get_vocab().values()) + 1)
            for token, i in a.get_vocab().items():
                of_a[i] = bytes(plain[c] for c in token) if all(c in plain for c in token) else token.encode()
            of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i)
                    else b.id_to_piece(i).replace(MARKER, " ").encode() for i in range(b.get_piece_size())]
            self.loaded = [a, b, Vocabulary(of_a, "|"), Vocabulary(of_b, ";")]
        return self.loaded

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Both id lists of every text (none of them empty); (empty, empty)
        where either doesn't give back the bytes of a space and the text."""
        cut_ = [cut(t) for t in texts]
        known = {p for parts in cut_ for p in parts}     # of these texts
        recent, before = self.cache, self.before
        known = {p: recent.get(p) or before.get(p) for p in known}
        self._encode([p for p, ids in known.items() if ids is None], known)
        recent.update((p, ids) for p, ids in known.items() if len(p) <= CACHED_CHARS)
        if len(recent) > CACHED:      # what is not asked for again goes
            self.cache, self.before = {}, recent
        out = []
        for parts in cut_:
            a, b, same = zip(*map(known.__getitem__, parts))
            whole = all(same)
            out.append(tuple(np.frombuffer(b"".join(x) if whole else b"", np.int32).astype(np.int64) for x in (a, b)))
        return out

    def _encode(self, parts: list[str], known: dict) -> None:
        """(ids, ids, whether both give back the bytes) of parts without
        their first space, into ``known``.  Parts that may stand before
        another one are encoded as one text, and its tokens dealt out."""
        single, joined, held = [], [], 0
        for p in parts:
            if not p or p[-1].isspace() or p[-1] == MARKER or len(p) > CACHED_CHARS:
                single.append(p)
                continue
            joined.append(p)
            held += len(p)
            if held > JOINED_CHARS:
                single += self._together(joined, known)
                joined, held = [], 0
        single += self._together(joined, known)
        a, b, of_a, of_b = self.parts()
        first = a.encode_batch_fast([" " + p for p in single], add_special_tokens=False)
        for p, x, y in zip(single, first, b.encode(single, num_threads=1)):
            x, data = x.ids, (" " + p).encode("utf-8", "surrogatepass")
            known[p] = (np.array(x, np.int32).tobytes(), np.array(y, np.int32).tobytes(),
                        of_a.joined(x) == data and of_b.joined(y) == data)

    def _together(self, parts: list[str], known: dict) -> list[str]:
        """``parts`` encoded as one text; those to be encoded one by one
        (all of them where the bytes don't come back)."""
        if not parts:
            return []
        a, b, of_a, of_b = self.parts()
        text = " ".join(parts)
        x, y = a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, b.encode(text)
        data = (" " + text).encode("utf-8", "surrogatepass")
        if of_a.joined(x) != data or of_b.joined(y) != data:
            return parts
        ends = np.cumsum([len(p.encode("utf-8", "surrogatepass")) + 1 for p in parts])
        dealt = []
        for ids, of in ((x, of_a), (y, of_b)):
            ids = np.array(ids, np.int32)
            at = np.searchsorted(np.cumsum(of.sizes[ids]), ends) + 1
            raw, at = ids.tobytes(), (at * 4).tolist()
            dealt.append([raw[i:j] for i, j in zip([0, *at], at)])
        known.update((p, (i, j, True)) for p, i, j in zip(parts, *dealt))
        return []


class Vocabulary:
    """Bytes, sizes and decimal names of the ids of one tokenizer."""

    def __init__(self, tokens: list[bytes], closing: str):
        self.tokens = tokens
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        # name of id i inside a group at 2i, at the end of one at 2i + 1
        self.names = np.array([f"{i}{c}" for i in range(len(tokens)) for c in (",", closing)], object)

    def joined(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def cut(text: str) -> list[str]:
    """``text`` in parts, cut at (and without) each space that follows a
    character which is neither white space nor the marker, and doesn't end
    the text."""
    words = text.split(" ")
    out, part, last = [], words[0], len(words) - 1
    for i in range(1, last + 1):
        word = words[i]
        end = part[-1:]
        if not end or end.isspace() or end == MARKER or (i == last and not word):
            part = f"{part} {word}"
        else:
            out.append(part)
            part = word
    out.append(part)
    return out


def gallop(short: list[int], long: list[int]) -> list[int]:
    """For each entry of ``short``, how many of ``long`` are smaller (both rising)."""
    out, at, n = [], 0, len(long)
    long = [*long, float("inf")]
    for x in short:
        if long[at] < x:
            at += 1
            if long[at] < x:
                low, step = at + 1, 2
                probe = at + 1
                while probe < n and long[probe] < x:
                    low = probe + 1
                    step *= 2
                    probe = at + step - 1
                at = bisect_left(long, x, low, min(probe, n))
        out.append(at)
    return out


@dataclass
class Aligned:
    """Two id lists of one text, aligned.  ``driver`` is the shorter list:
    token i of it overlaps tokens ``low[i]`` to ``high[i]`` of the other."""

    a: np.ndarray
    b: np.ndarray
    a_drives: bool
    low: np.ndarray
    high: np.ndarray
    meets: np.ndarray          # where the driver's token ends a group

    @classmethod
    def of(cls, a: np.ndarray, b: np.ndarray, of_a: Vocabulary, of_b: Vocabulary) -> "Aligned":
        ends_a, ends_b = np.cumsum(of_a.sizes[a]), np.cumsum(of_b.sizes[b])
        a_drives = len(a) <= len(b)
        drive, other = (ends_a, ends_b) if a_drives else (ends_b, ends_a)
        high = np.array(gallop(drive.tolist(), other.tolist()), np.int64)
        meets = other[high] == drive if len(high) else np.empty(0, bool)
        low = np.zeros_like(high)
        low[1:] = high[:-1] + meets[:-1]
        return cls(a, b, a_drives, low, high, meets)

    @property
    def n_links(self) -> int:
        return int((self.high - self.low + 1).sum())

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct links, rising, and how often each occurs."""
        drive, other = (self.a, self.b) if self.a_drives else (self.b, self.a)
        found, times = [], []
        for s in range(0, len(drive), BLOCK):
            low, n = self.low[s:s + BLOCK], (self.high - self.low)[s:s + BLOCK] + 1
            left = np.repeat(drive[s:s + BLOCK], n)
            right = other[np.arange(int(n.sum())) + np.repeat(low - (np.cumsum(n) - n), n)]
            a, b = (left, right) if self.a_drives else (right, left)
            pairs, counts = np.unique((a << SHIFT) + b, return_counts=True)
            found.append(pairs)
            times.append(counts)
        if len(found) == 1:
            return found[0], times[0]
        pairs, back = np.unique(np.concatenate(found), return_inverse=True)
        return pairs, np.bincount(back, np.concatenate(times)).astype(np.int64)

    def written(self, of_a: Vocabulary, of_b: Vocabulary) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        closes = np.flatnonzero(self.meets)
        ends = (closes, self.high[closes]) if self.a_drives else (self.high[closes], closes)
        out = np.empty(len(self.a) + len(self.b), object)
        first, second = (np.concatenate([[-1], e]) for e in ends)
        for ids, end, before, names in ((self.a, first, second[:-1], of_a.names),
                                        (self.b, second, first[1:], of_b.names)):
            last = np.zeros(len(ids), np.int64)
            last[end[1:]] = 1
            # tokens of the other list that stand before this group's tokens
            out[np.arange(len(ids)) + np.repeat(before + 1, np.diff(end))] = names[2 * ids + last]
        return "".join(out.tolist())[:-1]


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str]]]:
    """(doc_id, text) rows of about ``BATCH_CHARS`` characters (a longer text alone)."""
    rows, held = [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            t = t or ""
            if rows and held + len(t) > BATCH_CHARS:
                yield rows
                rows, held = [], 0
            rows.append((i, t))
            held += len(t)
    if rows:
        yield rows


_LINKED = ("chunk long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups_sha256 string, steps binary, times binary, links array<long>, held array<long>")
_NAMES = [c.split()[0] for c in _LINKED.split(", ")]
_TYPES = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.binary(), pa.binary(),
          pa.list_(pa.int64()), pa.list_(pa.int64())]


class _Chunk:
    """The documents of a chunk, and its dictionary of links."""

    def __init__(self, number: int):
        self.number, self.rows, self.links, self.chars = number, [], [], 0

    def add(self, row: tuple, links: tuple[np.ndarray, np.ndarray] | None, chars: int):
        self.rows.append((row, None if links is None else links[1]))
        self.links.append(np.empty(0, np.int64) if links is None else links[0])
        self.chars += chars

    def batch(self) -> pa.RecordBatch:
        """Rows of kind 0, a document each: its links as steps between places
        in the dictionary.  One row of kind 1: the dictionary, and how many
        of these documents hold each link."""
        every, place = np.unique(np.concatenate(self.links), return_inverse=True)
        held = np.bincount(place, minlength=len(every))
        out, s = [], 0
        for (row, times), links in zip(self.rows, self.links):
            at = place[s:s + len(links)]
            s += len(links)
            steps = np.diff(at, prepend=0).astype(np.int32).tobytes()
            out.append((self.number, 0, *row, steps, b"" if times is None else times.astype(np.int32).tobytes(),
                        None, None))
        out.append((self.number, 1, *[None] * 8, every, held))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)


def link_chunks(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """Documents with their alignment, and the dictionary of every chunk."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizers)   # bounded by the vocabularies

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        *_, of_a, of_b = t.parts()
        number = TaskContext.get().partitionId() << 32
        chunk = _Chunk(number)
        for rows in _batches(batches):
            filled = [x for _, x in rows if x]
            ids = iter(t.encode(filled) if filled else ())
            for i, text in rows:
                a, b = next(ids) if text else ((), ())
                if len(a):
                    found = Aligned.of(a, b, of_a, of_b)
                    written = hashlib.sha256(found.written(of_a, of_b).encode()).hexdigest()
                    row = (i, len(a), len(b), int(found.meets.sum()), found.n_links, written)
                    chunk.add(row, found.links(), len(text))
                else:
                    chunk.add((i, 0, 0, 0, 0, ""), None, len(text))
            if chunk.chars >= CHUNK_CHARS:
                yield chunk.batch()
                number += 1
                chunk = _Chunk(number)
        if chunk.rows:
            yield chunk.batch()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _LINKED)


def link_counts(linked: DataFrame) -> DataFrame:
    """chunk, place, n and best of every entry of every dictionary: by how
    many documents of the corpus the link is held, and whether that is the
    most of all links of its first id."""
    entries = linked.where("kind = 1").select(
        "chunk", F.posexplode(F.arrays_zip("links", "held")).alias("place", "entry")).select(
        "chunk", "place", F.col("entry.links").alias("link"), F.col("entry.held").alias("held"))
    counts = entries.groupBy("link").agg(F.sum("held").alias("n")).withColumn("first", F.shiftright("link", SHIFT))
    most = counts.groupBy("first").agg(F.max("n").alias("most"))
    # one row for an id of the first vocabulary at most
    known = counts.join(F.broadcast(most), "first").select("link", "n", (F.col("n") == F.col("most")).alias("best"))
    return entries.join(known, "link").select("chunk", "place", "n", "best")


def align(docs: DataFrame, tokenizers: Tokenizers) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256 of every row of ``docs``.

    Null and empty texts, and texts that either tokenizer doesn't give back,
    have no tokens: zeros and an empty ``groups_sha256``.  Null ids are kept;
    repeated rows are documents of their own in the counts; other columns are
    ignored; an empty table gives no rows.  The aligned chunks are written to
    the shared scratch folder once, so a lost executor costs no encoding.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "token-align")
    link_chunks(docs, tokenizers).write.parquet(path)

    def linked():
        return spark.read.schema(_LINKED).parquet(path)

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        size = right.num_rows
        n, best = np.zeros(size, np.int64), np.zeros(size, bool)
        place = right.column("place").to_numpy()
        n[place] = right.column("n").to_numpy()
        best[place] = right.column("best").to_numpy(zero_copy_only=False)
        sums, hits = [], []
        for steps, times in zip(left.column("steps").to_pylist(), left.column("times").to_pylist()):
            at, t = np.cumsum(np.frombuffer(steps, np.int32)), np.frombuffer(times, np.int32).astype(np.int64)
            sums.append(int((n[at] * t).sum()))
            hits.append(int(t[best[at]].sum()))
        kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
        return pa.table([*(left.column(c) for c in kept), pa.array(hits, pa.int64()), pa.array(sums, pa.int64()),
                         left.column("groups_sha256")], names=[*kept, "n_best", "count_sum", "groups_sha256"])

    texts = linked().where("kind = 0").drop("kind", "links", "held")
    return texts.groupBy("chunk").cogroup(link_counts(linked()).groupBy("chunk")).applyInArrow(
        score, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
               "groups_sha256 string")
