"""Sharding by minimax contiguous partition.

Rows with equal text form one atomic group.  Groups are ordered by a 64-bit
hash of the text; the smallest capacity for which a greedy left-to-right
sweep needs at most ``n_shards`` shards is found by binary search, and the
ordered groups are cut there.

The ordered sizes never reach the driver.  It sees a bounded histogram over
the hash (2**16 bins: bytes, largest group, number of groups).  A bin that
holds several groups is treated as divisible for a lower bound of the
capacity and as atomic for an upper bound; only the bins in which a cut may
fall are split further, by the next bits of the hash, until every cut falls
between two groups.  The capacity is then the exact optimum.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.llm.common import materialised

ROW_OVERHEAD = 16      # bytes counted for each row besides its text
FIRST_BITS, MORE_BITS = 16, 8
SLOT_ROWS = 50_000     # rows numbered together
MIN_BUCKETS = 16


@dataclass
class Segments:
    """Contiguous key ranges in order: ``lo`` is the first key of a range."""

    lo: np.ndarray
    shift: np.ndarray
    size: np.ndarray
    largest: np.ndarray
    groups: np.ndarray

    @classmethod
    def of(cls, rows) -> "Segments":
        a = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
        return cls(*(a[:, i] for i in range(5)))

    def rows(self):
        return list(zip(self.lo.tolist(), self.shift.tolist(), self.size.tolist(),
                        self.largest.tolist(), self.groups.tolist()))


def _sweep(seg: Segments, capacity: int, n_shards: int, divisible: bool) -> list[int] | None:
    """Greedy cuts (byte positions) under ``capacity``; None if more than
    ``n_shards`` shards are needed.  Ranges of several groups are either
    divisible at any byte or not at all."""
    ends = np.cumsum(seg.size)
    total, at, cuts = int(ends[-1]), 0, []
    while at + capacity < total:
        limit = at + capacity
        i = int(np.searchsorted(ends, limit, side="right"))
        start = int(ends[i] - seg.size[i])
        cut = limit if divisible and seg.groups[i] > 1 else start
        if cut <= at or len(cuts) + 2 > n_shards:
            return None
        cuts.append(cut)
        at = cut
    return cuts


def _smallest(seg: Segments, n_shards: int, divisible: bool, low: int) -> tuple[int, list[int]]:
    high = int(seg.size.sum())
    low = max(low, 1)
    while low < high:
        mid = (low + high) // 2
        if _sweep(seg, mid, n_shards, divisible) is None:
            low = mid + 1
        else:
            high = mid
    return low, _sweep(seg, low, n_shards, divisible)


def _spread(seg: Segments, capacity: int, n_shards: int, greedy: list[int]) -> list[int]:
    """Cuts under the same capacity, each near the mean of what is left, so
    that one huge group does not leave shards empty; the greedy cuts where
    that does not fit."""
    starts = np.concatenate([[0], np.cumsum(seg.size)])
    total, at, cuts = int(starts[-1]), 0, []
    for left in range(n_shards, 1, -1):
        aim = at + (total - at) / left
        lo = int(np.searchsorted(starts, at, side="right"))
        hi = int(np.searchsorted(starts, at + capacity, side="right"))
        if hi <= lo:
            return greedy
        around = starts[lo:hi]
        cut = int(around[np.argmin(np.abs(around - aim))])
        if cut >= total:
            break
        cuts.append(cut)
        at = cut
    return cuts if total - at <= capacity else greedy


def _histogram(groups: DataFrame, shift: int):
    lo = F.shiftleft(F.shiftright("key", shift), shift) if shift else F.col("key")
    return groups.groupBy(lo.alias("lo")).agg(
        F.sum("size").alias("size"), F.max("size").alias("largest"), F.count("*").alias("n"))


def plan_cuts(groups: DataFrame, n_shards: int) -> tuple[int, list[int]]:
    """(smallest feasible capacity, first key of every shard but the first)
    for ``groups`` (key long, size long), ordered by key."""
    shift = 64 - FIRST_BITS
    seg = Segments.of((r.lo, shift, r.size, r.largest, r.n)
                      for r in _histogram(groups, shift).collect())
    if not len(seg.lo):
        return 0, []
    while True:
        floor = int(seg.largest.max())
        low, cuts = _smallest(seg, n_shards, True, floor)
        starts = np.cumsum(seg.size) - seg.size
        if np.isin(cuts, starts).all():
            cuts = _spread(seg, low, n_shards, cuts)
            return low, [int(seg.lo[np.searchsorted(starts, c)]) for c in cuts]
        high, _ = _smallest(seg, n_shards, False, low)
        # where each cut may lie, for any capacity between the bounds
        wide = _sweep(seg, high, n_shards, True)
        wide += [int(seg.size.sum())] * (len(cuts) - len(wide))
        split = np.zeros(len(seg.lo), dtype=bool)
        for a, b in zip(cuts, wide):
            i = np.searchsorted(starts, min(a, b), side="right") - 1
            j = np.searchsorted(starts, max(a, b), side="right")
            split[i:j] = True
        split &= seg.groups > 1
        kept = [r for r, s in zip(seg.rows(), split) if not s]
        for shift in sorted(set(seg.shift[split].tolist())):
            parts = seg.lo[split & (seg.shift == shift)].tolist()
            finer = max(0, shift - MORE_BITS)
            inside = groups.where(F.shiftleft(F.shiftright("key", shift), shift).isin(parts))
            kept += [(r.lo, finer, r.size, r.largest, r.n)
                     for r in _histogram(inside, finer).collect()]
        seg = Segments.of(kept)


def shard_documents(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Shard, slot, size and text checksum of every row of ``docs``.

    Shards are near equal in bytes (law ``bytes``): the largest is the
    minimax optimum over the hash order.  Equal texts share a shard.  A null
    text counts as empty (size 16, checksum 0) and shares the group of empty
    texts; null ids are kept; repeated rows are numbered apart; an empty
    table gives no rows.  Other columns are ignored.  Slots run from 0
    without gaps in each shard; rows are numbered in sub-buckets of a shard
    (hash of the id) whose offsets come from their counts, so neither a
    shard nor a group of copies is ever sorted in one task.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = materialised(docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("key")))
    groups = base.groupBy("key").agg(F.sum("size").alias("size"))
    _, cuts = plan_cuts(groups, n_shards)
    buckets = max(MIN_BUCKETS, -(-base.count() // (n_shards * SLOT_ROWS)))
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    placed = base.select(
        "*", F.size(F.filter(bounds, lambda c: c <= F.col("key"))).alias("shard"),
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(buckets)).cast("int").alias("bucket"))
    from pyspark.sql import Window
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n")).select(
        "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("shard", "bucket").orderBy("doc_id", "key")
    numbered = placed.withColumn("within", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["shard", "bucket"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("within")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
