"""Nearest neighbours by inner product over balanced posting lists.

Vectors get one more component, sqrt(M^2 - |x|^2) with M the largest norm, so
that the largest inner product is the smallest distance.  Balanced k-means on
a bounded sample gives the centroids of the posting lists; every vector is
then posted to its nearest list and, where it lies near a boundary, to the
next ones too.  A small-world graph over the centroids, held in memory, is
searched best-first for the lists of a vector or query; a query visits the
lists whose distance is within a ratio of the nearest one.

Posting lists are dealt out in parts of bounded size, so a crowded list is
never one task.  Equal vectors are one query, and of equal candidates only
the k + 1 smallest ids can be in any answer: both are reduced before any
shuffle of vectors.  Scores are double-precision inner products of the
original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salestide.llm.common import materialised


@dataclass(frozen=True)
class Settings:
    k: int = 20
    sample: int = 20_000        # vectors the centroids are fitted on, at most
    list_rows: int = 200        # aimed at; lists grow once ``most_lists`` is reached
    most_lists: int = 2_048     # bounds the centroids broadcast
    iterations: int = 8
    balance: float = 0.3        # weight of the size penalty in k-means
    neighbours: int = 16        # edges of a centroid in the graph
    beam: int = 96              # centroids kept while searching for a query ...
    post_beam: int = 24         # ... and for a vector to post
    copies: int = 4             # lists a vector is posted to, at most
    boundary: float = 1.1       # ... while no farther than this times the nearest
    probes: int = 64            # lists a query visits, at most
    ratio: float = 1.25         # ... while no farther than this times the nearest
    part_rows: int = 50_000     # rows of a list in one task, at most
    seed: int = 11


def balanced_centroids(x: np.ndarray, n: int, s: Settings) -> np.ndarray:
    """k-means whose assignment cost grows with a list's size."""
    rng = np.random.default_rng(s.seed)
    x = np.unique(x, axis=0)
    n = min(n, len(x))
    c = x[rng.choice(len(x), n, replace=False)].copy()
    penalty = np.zeros(n)
    for _ in range(s.iterations):
        d = _distances(x, c)
        near = np.argmin(d + penalty, axis=1)
        size = np.bincount(near, minlength=n)
        scale = float(np.mean(d[np.arange(len(x)), near]))
        penalty = 0.5 * penalty + 0.5 * s.balance * scale * (size / (len(x) / n) - 1)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None],
                     x[rng.choice(len(x), n)])
    return c


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2.0 * (x @ c.T)
    return np.maximum(d, 0.0)


@dataclass
class CentroidGraph:
    """Centroids, and for each a fixed number of edges: nearest ones, and a
    few far ones that keep the graph connected."""

    points: np.ndarray
    edges: np.ndarray
    entry: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, s: Settings) -> "CentroidGraph":
        n = len(points)
        rng = np.random.default_rng(s.seed + 1)
        width = min(s.neighbours, n)
        near = np.empty((n, width), np.int64)
        for a in range(0, n, 512):
            near[a:a + 512] = np.argsort(_distances(points[a:a + 512], points), axis=1, kind="stable")[:, :width]
        ring = np.stack([(np.arange(n) + 1) % n, (np.arange(n) - 1) % n], axis=1)
        far = rng.integers(0, n, (n, 4))
        entry = np.unique(rng.integers(0, n, min(n, 16)))
        return cls(points, np.concatenate([near, ring, far], axis=1), entry)

    def search(self, x: np.ndarray, beam: int, want: int) -> tuple[np.ndarray, np.ndarray]:
        """(lists, squared distances) of the ``want`` nearest centroids found
        for each row of ``x``, nearest first; all rows step together."""
        n, rows = len(self.points), np.arange(len(x))[:, None]
        beam = min(max(beam, want), n)
        want = min(want, n)
        seen = np.zeros((len(x), n), bool)
        norms = (x * x).sum(axis=1)[:, None]
        sizes = (self.points * self.points).sum(axis=1)

        def distance(at: np.ndarray) -> np.ndarray:
            return np.maximum(norms + sizes[at] - 2.0 * np.einsum("rd,rkd->rk", x, self.points[at]), 0.0)

        at = np.repeat(self.entry[None, :], len(x), axis=0)
        seen[rows, at] = True
        dist, done = distance(at), np.zeros(at.shape, bool)
        while True:
            open_ = np.where(done, np.inf, dist)
            pick = np.argmin(open_, axis=1)
            best = open_[rows[:, 0], pick]
            if not np.isfinite(best).any():
                break
            done[rows[:, 0], pick] = True
            new = self.edges[at[rows[:, 0], pick]]
            fresh = ~seen[rows, new] & np.isfinite(best)[:, None]
            # one of several equal edges is enough
            order = np.sort(np.where(fresh, new, n), axis=1)
            order[:, 1:][order[:, 1:] == order[:, :-1]] = n
            fresh, new = order < n, np.minimum(order, n - 1)
            seen[np.broadcast_to(rows, new.shape)[fresh], new[fresh]] = True
            d = np.where(fresh, distance(new), np.inf)
            at = np.concatenate([at, new], axis=1)
            dist = np.concatenate([dist, d], axis=1)
            done = np.concatenate([done, ~fresh], axis=1)
            if at.shape[1] > beam:
                keep = np.argpartition(dist, beam - 1, axis=1)[:, :beam]
                at, dist, done = at[rows, keep], dist[rows, keep], done[rows, keep]
        order = np.argsort(dist, axis=1, kind="stable")[:, :want]
        return at[rows, order], dist[rows, order]


@dataclass
class Index:
    graph: CentroidGraph
    norm: float                # the largest norm
    settings: Settings

    def lifted(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm ** 2 - (x * x).sum(axis=1), 0.0))
        return np.concatenate([x, rest[:, None]], axis=1)

    def _near(self, x: np.ndarray, want: int, ratio: float, beam: int):
        """(first row, lists, which of them lie within the ratio) by batches of rows."""
        for a in range(0, len(x), 256):
            at, d = self.graph.search(x[a:a + 256], beam, want)
            ok = (d <= d[:, :1] * ratio ** 2 + 1e-12) & np.isfinite(d)
            ok[:, 0] = True
            yield a, at, ok

    def postings(self, x: np.ndarray):
        s = self.settings
        for a, at, ok in self._near(self.lifted(x), s.copies, s.boundary, s.post_beam):
            for r, c in zip(*np.nonzero(ok)):
                yield a + int(r), int(at[r, c])

    def visits(self, x: np.ndarray, rows_of: np.ndarray):
        """The lists of queries, which point where the best vector could lie.
        Lists are added, at last all, until they are sure to hold k other vectors."""
        s = self.settings
        need = s.copies * (s.k + 1)
        norms = np.sqrt((x * x).sum(axis=1))[:, None]
        aimed = np.concatenate([x * (self.norm / norms), np.zeros((len(x), 1))], axis=1)
        for a, at, ok in self._near(aimed, s.probes, s.ratio, s.beam):
            before = np.cumsum(rows_of[at], axis=1) - rows_of[at]
            ok |= before < need
            for r in range(len(at)):
                few = rows_of[at[r]].sum() < need
                for c in (range(len(rows_of)) if few else at[r][ok[r]]):
                    yield a + r, int(c)


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v): one row per id (the smallest vector, should an id have
    several), without null ids and without vectors that are null, zero, of
    another than the most frequent dimension, or hold a null or non-finite component."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine & F.exists("v", lambda x: x != 0.0))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), F.desc("w")).first()
    return rows.where(F.size("v") == (width.w if width else 0))


def fit(rows: DataFrame, s: Settings = Settings()) -> Index | None:
    """Centroids from at most ``s.sample`` vectors (first by a hash of the id)."""
    stats = rows.agg(F.count("*").alias("n"),
                     F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    if not stats.n:
        return None
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(s.sample).collect()
    index = Index(None, float(np.sqrt(stats.m)), s)
    x = index.lifted(np.array([r.v for r in taken], dtype=float))
    lists = int(np.clip(round(stats.n / s.list_rows), 1, s.most_lists))
    index.graph = CentroidGraph.build(balanced_centroids(x, lists, s), s)
    return index


def _matrix(column) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(len(column), -1)


def best_of(q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple[int, int, float]]:
    """(query number, id, score) of the ``k`` best rows of ``x`` per row of
    ``q``, ties to the smaller id; each score is summed in one fixed order."""
    for a in range(0, len(q), 64):
        rough = q[a:a + 64] @ x.T
        cut = np.partition(rough, max(0, len(x) - k), axis=1)[:, max(0, len(x) - k)]
        slack = 1e-9 * (1.0 + np.abs(cut))
        for i, row in enumerate(rough):
            near = np.flatnonzero(row >= cut[i] - slack[i])
            score = (x[near] * q[a + i]).sum(axis=1)
            for j in np.lexsort((ids[near], -score))[:k]:
                yield a + i, int(ids[near[j]]), float(score[j])


def nearest(vectors: DataFrame, queries: DataFrame, s: Settings = Settings(), id_col: str = "vec_id",
            vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the ``s.k`` nearest of ``vectors``
    for each row of ``queries``, itself left out; all of them if fewer.

    What takes no part is described in ``usable``; other columns are ignored;
    without vectors or queries the result is empty.
    """
    spark, k = vectors.sparkSession, s.k + 1   # one more: the query itself may be among them
    schema = "query_id long, rank int, vec_id long, score double"
    rows = materialised(usable(vectors, id_col, vec_col))
    index = fit(rows, s)
    if index is None:
        return spark.createDataFrame([], schema)
    shared = spark.sparkContext.broadcast(index)   # bounded by Settings.most_lists
    equal = Window.partitionBy("v").orderBy("vec_id")
    distinct = rows.withColumn("nth", F.row_number().over(equal)).where(F.col("nth") <= k).drop("nth")

    def post(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            hit = list(shared.value.postings(_matrix(p.v))) if len(p) else []
            i = [r for r, _ in hit]
            yield pd.DataFrame({"list": [c for _, c in hit], "vec_id": p.vec_id.to_numpy()[i],
                                "v": p.v.to_numpy()[i]})

    posted = materialised(distinct.mapInPandas(post, "list int, vec_id long, v array<double>"))
    size = {r.list: r["count"] for r in posted.groupBy("list").count().collect()}  # most_lists rows
    rows_each = min(max(256, sum(size.values()) // max(1, len(size))), s.part_rows)
    parts_of = {c: -(-n // rows_each) for c, n in size.items()}
    rows_of = np.array([size.get(c, 0) for c in range(len(index.graph.points))])
    n_parts = F.create_map(*[F.lit(x) for kv in parts_of.items() for x in kv])
    dealt = posted.withColumn("part", F.pmod(F.xxhash64("vec_id"), n_parts[F.col("list")]).cast("int"))

    asked = usable(queries, id_col, vec_col).select(F.col("vec_id").alias("query_id"), "v")
    asked = materialised(asked)
    ask = asked.groupBy("v").agg(F.min("query_id").alias("q"))

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            hit = [(r, c, part) for r, c in (shared.value.visits(_matrix(p.v), rows_of) if len(p) else ())
                   for part in range(parts_of.get(c, 0))]
            i = [r for r, _, _ in hit]
            yield pd.DataFrame({"list": [c for _, c, _ in hit], "part": [x for _, _, x in hit],
                                "q": p.q.to_numpy()[i], "v": p.v.to_numpy()[i]})

    visits = ask.mapInPandas(visit, "list int, part int, q long, v array<double>")

    def scan(data: pd.DataFrame, query: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(query):
            return pd.DataFrame({"q": [], "vec_id": [], "score": []}).astype(
                {"q": "int64", "vec_id": "int64", "score": "float64"})
        found = list(best_of(_matrix(query.v), data.vec_id.to_numpy(), _matrix(data.v), k))
        q = query.q.to_numpy()
        return pd.DataFrame({"q": [q[i] for i, _, _ in found], "vec_id": [j for _, j, _ in found],
                             "score": [x for _, _, x in found]})

    found = dealt.groupBy("list", "part").cogroup(visits.groupBy("list", "part")).applyInPandas(
        scan, "q long, vec_id long, score double").dropDuplicates(["q", "vec_id"])
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k).drop("n")
    members = asked.join(ask, "v").select("query_id", "q")
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (members.join(top, "q").where(F.col("query_id") != F.col("vec_id"))
            .withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= s.k)
            .select("query_id", "rank", "vec_id", "score"))
