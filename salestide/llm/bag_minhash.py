"""Near-duplicates by BagMinHash over word-shingle multisets.

Every text is a multiset of five-word shingles.  BagMinHash gives each
component i of a signature the first point of a Poisson process over
(time, weight, component): an element of weight w owns the points whose
weight coordinate is below w, so two texts agree in a component with
probability sum(min) / sum(max), the weighted Jaccard similarity, without
bias.  The weight axis is discretised into the intervals [0,1), [1,2), [2,4),
[4,8) ..., each with its own process of a rate equal to its length; an element
starts only the intervals it reaches, drops points above its weight, and stops
as soon as its next point comes later than the worst component so far.

Signatures are banded.  In each bucket the member that meets most others in
all buckets is the pivot; every other member is compared with it exactly, on
the texts.  What a pivot's own links leave apart is compared further only
where it can matter: two members x, y of different components with pivot p
share at most

    min(|x & p|, |y & p|) + |(x - p) & (y - p)|

shingles, so a pair is verified only if this reaches the threshold's share of
both sizes, and the second term comes from an index of the few shingles that
members have beyond their pivot.  So no bucket is expanded into all pairs,
and no link between components is lost.

Equal texts are one node from the start (a partial aggregate); nothing is
collected to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salestide.llm.common import materialised
from salestide.llm.components import connected
from salestide.llm.grams import U, grams, mix, words_of


@dataclass(frozen=True)
class Settings:
    words: int = 5
    threshold: float = 0.8
    bands: int = 32
    rows: int = 4
    batch_bytes: int = 1_000_000   # of text hashed together in a task

    @property
    def size(self) -> int:
        return self.bands * self.rows


def signatures(doc: np.ndarray, gram: np.ndarray, weight: np.ndarray, n_docs: int, m: int,
               capped: bool = True) -> np.ndarray:
    """(n_docs, m) BagMinHash signatures of the multisets given as parallel
    arrays: text number, shingle hash, integer weight of at least 1.

    Intervals that lie wholly below a weight come first, the longest (of the
    fastest process) first of all: they bring the worst component down, so
    that neither slow processes nor partly covered intervals, whose points
    above the weight are dropped, run for long.  The order changes no minimum.
    At first no point later than ``cap`` is drawn, by which time all components
    of a text have met one but for a chance of about e**-8; a text that has
    not is drawn again without (so the cap changes no minimum, either)."""
    sig = np.full(n_docs * m, np.inf)
    worst = np.full(n_docs, np.inf)
    whole = 2.0 ** np.floor(np.log2(np.maximum(weight, 1)))
    rate = np.bincount(doc, whole, n_docs)
    cap = m * (np.log(m) + 8) / np.maximum(rate, 1e-9) if capped else worst.copy()
    top = int(weight.max(initial=1)).bit_length()
    for covered in (True, False):
        for j in range(top, -1, -1):
            low, high = (0, 1) if j == 0 else (1 << (j - 1), 1 << j)
            keep = weight >= high if covered else (weight > low) & (weight < high)
            d, w = doc[keep], weight[keep]
            with np.errstate(over="ignore"):
                seed = mix(gram[keep] + U((j + 1) * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF))
            time, step = np.zeros(len(d)), 0
            while len(d):
                step += 1
                with np.errstate(over="ignore"):
                    r = mix(seed + U(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
                time = time - np.log(((r >> U(11)).astype(float) + 0.5) * 2.0 ** -53) / (high - low)
                live = time < np.minimum(worst, cap)[d]
                if not live.all():
                    d, w, seed, time, r = (x[live] for x in (d, w, seed, time, r))
                with np.errstate(over="ignore"):
                    place = (mix(r + U(0xA0761D6478BD642F)) >> U(11)).astype(np.int64) % m
                if covered:
                    np.minimum.at(sig, d * m + place, time)
                else:
                    with np.errstate(over="ignore"):
                        y = (mix(r ^ U(0xE7037ED1A0B428DB)) >> U(11)).astype(float) * 2.0 ** -53
                    below = low + (high - low) * y < w
                    np.minimum.at(sig, d[below] * m + place[below], time[below])
                worst = sig.reshape(n_docs, m).max(axis=1)
        if covered and capped:
            open_ = np.isinf(worst) & (rate > 0)
            if open_.any():   # the partly covered intervals need a finite worst component
                again, number = np.flatnonzero(open_), np.cumsum(open_) - 1
                mine = open_[doc]
                sig.reshape(n_docs, m)[again] = signatures(
                    number[doc[mine]], gram[mine], weight[mine], len(again), m, capped=False)
                worst = sig.reshape(n_docs, m).max(axis=1)
    return sig.reshape(n_docs, m)


def _buckets(texts: list[str], s: Settings) -> list[np.ndarray]:
    """The band keys of each text; none for a text without words."""
    words = words_of([t.lower().encode("utf-8", "surrogatepass") for t in texts])
    ds, gs, ws = [], [], []
    for i in range(len(texts)):
        g, c = np.unique(grams(words, i, s.words), return_counts=True)
        ds.append(np.full(len(g), i))
        gs.append(g)
        ws.append(c)
    doc, gram, weight = (np.concatenate(x) for x in (ds, gs, ws))
    sig = signatures(doc.astype(np.int64), gram.astype(U), weight.astype(np.int64), len(texts), s.size)
    bits = sig.view(U).reshape(len(texts), s.bands, s.rows)
    with np.errstate(over="ignore"):
        key = np.arange(1, s.bands + 1, dtype=U) * U(0x8CB92BA72F3D8DD7)
        for r in range(s.rows):
            key = mix(key * U(0xD1342543DE82EF95) + bits[:, :, r])
    return [k.view(np.int64) if len(g) else np.empty(0, np.int64) for k, g in zip(key, gs)]


def _batches(texts, limit: int) -> Iterator[list[int]]:
    batch, size = [], 0
    for i, t in enumerate(texts):
        batch.append(i)
        size += len(t or "") + 1
        if size >= limit:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def band_keys(nodes: DataFrame, s: Settings) -> DataFrame:
    """(node, keys): the bucket of each band; nodes: (node, text)."""
    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            for batch in _batches(p.text, s.batch_bytes):
                keys = _buckets([p.text[i] for i in batch], s)
                yield pd.DataFrame({"node": [p.node[i] for i in batch], "keys": keys})

    return nodes.select("node", "text").mapInPandas(run, "node binary, keys array<long>")


def _counts(text: str, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of a text, sorted, and how often each comes."""
    words = words_of([text.lower().encode("utf-8", "surrogatepass")])
    return np.unique(grams(words, 0, k).view(np.int64), return_counts=True)


def _shared(a, b) -> tuple[int, np.ndarray, np.ndarray]:
    """(multiset overlap, shingles that ``a`` has more often than ``b``, by how much)."""
    (x, m), (y, n) = a, b
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    other = np.where(y[at] == x, n[at], 0)
    more = m - other
    return int(np.minimum(m, other).sum()), x[more > 0], more[more > 0]


def _compared(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """``pairs`` (a, b) with ``shared`` (the multiset overlap), ``n_a`` and
    ``n_b`` (the sizes), and what a has beyond b (``gram``, ``c`` times)."""

    @F.pandas_udf("shared int, n_a int, n_b int, gram array<long>, c array<int>")
    def compare(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        kept: dict = {}

        def of(text: str):
            got = kept.get(text)
            if got is None:
                if len(kept) > 256:
                    kept.clear()
                got = kept[text] = _counts(text, s.words)
            return got

        rows = []
        for x, y in zip(a, b):
            x, y = of(x), of(y)
            n, g, c = _shared(x, y)
            rows.append((n, int(x[1].sum()), int(y[1].sum()), g, c.astype(np.int32)))
        return pd.DataFrame(rows, columns=["shared", "n_a", "n_b", "gram", "c"])

    one = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(one, "a").join(two, "b")
    return both.withColumn("r", compare("text_a", "text_b")).select("a", "b", "r.*")


def _reaches(shared, n_a, n_b, s: Settings):
    """Jaccard >= t, written on the overlap and the two sizes."""
    t = s.threshold / (1 + s.threshold)
    return shared >= (n_a + n_b) * F.lit(t) - 1e-9


def _linked(compared: DataFrame, s: Settings) -> DataFrame:
    return compared.where(_reaches(F.col("shared"), F.col("n_a"), F.col("n_b"), s)).select("a", "b")


def _usable(text_col: str = "text"):
    return F.col(text_col).rlike(r"[^\x20\t-\r]")


def _known(rows: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node, component) of the rows with an id and words, written;
    and the component, class_id, node of the kept row and class_size of each class."""
    node = F.unhex(F.md5("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & _usable()).withColumn("node", node)
    texts = rows.groupBy("node").agg(F.first("text").alias("text"))
    known = materialised(rows.select("doc_id", "node").join(_components(texts, s), "node", "left").select(
        "doc_id", "node", F.coalesce("component", "node").alias("component")))
    # written first, so that a join deals both sides anew and can split a large class
    classes = materialised(known.groupBy("component").agg(
        F.min(F.struct("doc_id", "node")).alias("first"), F.count("*").alias("class_size")).select(
        "component", F.col("first.doc_id").alias("class_id"), F.col("first.node").alias("node"), "class_size"))
    return known, classes


def _rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def near_duplicates(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, class_id and class_size (rows of the class) of every row.

    ``class_id`` is the smallest id of the connected component of texts
    linked by a weighted Jaccard similarity of at least ``s.threshold`` (equal
    texts are linked).  Case and white space do not count; a text with fewer words than a shingle is one shingle; a
    null, empty or blank text is a class of its own, as is a row with a null
    id (class_id null).  Repeated rows share a class.  Other columns are
    ignored; an empty table gives no rows.
    """
    rows = _rows(docs, id_col, text_col)
    known, classes = _known(rows, s)
    alone = rows.where(~F.coalesce(F.col("doc_id").isNotNull() & _usable(), F.lit(False))).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))
    return known.join(classes.drop("node"), "component").select("doc_id", "class_id", "class_size").unionByName(alone)


def one_per_class(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that stay: of each class one row, of its smallest
    id (of several texts under that id, always the same one); rows with a null
    id all stay, of equal rows without words one.  Same columns."""
    _, classes = _known(_rows(docs), s)
    keep = classes.select(F.col("class_id").alias("id"), "node")
    named = docs.where("doc_id is not null").select(
        F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"),
        F.unhex(F.md5("text")).alias("node"), F.coalesce(_usable(), F.lit(False)).alias("usable"))
    # each by itself (a text is usable or not), so that the joined rows stay where they are
    stay, blank = (x.dropDuplicates(["id", "node"]) for x in (
        named.where("usable").join(keep, ["id", "node"], "left_semi"), named.where("not usable")))
    return stay.unionByName(blank).select("row.*").unionByName(docs.where(F.col("doc_id").isNull()))


def _components(texts: DataFrame, s: Settings) -> DataFrame:
    """(node, component) of the linked nodes."""
    signed = materialised(band_keys(texts, s))
    each = signed.select("node", F.explode("keys").alias("bucket"))
    size = each.groupBy("bucket").agg(F.count("*").alias("met")).where(F.col("met") > 1)
    keys = materialised(each.join(size, "bucket"))
    popular = keys.groupBy("node").agg(F.sum("met").alias("popular"))
    pivots = keys.join(popular, "node").groupBy("bucket").agg(
        F.max(F.struct("popular", "node")).alias("p")).select("bucket", F.col("p.node").alias("pivot"))
    member = materialised(keys.select("bucket", "node").join(pivots, "bucket"))
    pairs = member.where(F.col("node") != F.col("pivot")).select(
        F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    some = materialised(texts.join(keys.select("node").distinct(), "node", "left_semi"))
    compared = materialised(_compared(pairs, some, s))
    edges = _linked(compared, s)
    labels = connected(edges)

    # members of buckets that still hold several components, by pivot
    marked = member.join(labels, "node", "left").select(
        "bucket", "node", "pivot", F.coalesce("component", "node").alias("component"))
    mixed = marked.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(
        F.col("lo") != F.col("hi")).select("bucket")
    apart = marked.join(mixed, "bucket").select("pivot", "node", "component").distinct()
    with_pivot = compared.select(F.col("a").alias("node"), F.col("b").alias("pivot"), "shared",
                                 F.col("n_a").alias("n"), "gram", "c")
    own = compared.groupBy(F.col("b").alias("node")).agg(F.first("n_b").alias("n")).select(
        "node", F.col("node").alias("pivot"), F.col("n").alias("shared"), "n",
        F.array().cast("array<long>").alias("gram"), F.array().cast("array<int>").alias("c"))
    apart = materialised(apart.join(with_pivot.unionByName(own), ["node", "pivot"]))
    again = _within_reach(apart.drop("gram", "c"), s).unionByName(_beyond_pivot(apart, s)).distinct()
    more = materialised(_linked(_compared(materialised(again), some, s), s))
    if more.isEmpty():
        return labels
    # the new links join components: only those are joined again
    name = labels.select(F.col("node"), F.col("component").alias("of"))
    for side in ("a", "b"):
        more = more.join(name.withColumnRenamed("node", side), side, "left").withColumn(
            side, F.coalesce("of", side)).drop("of")
    merged = materialised(connected(more.select("a", "b")).select("node", F.col("component").alias("into")))
    old = labels.join(merged.withColumnRenamed("node", "component"), "component", "left").select(
        "node", F.coalesce("into", "component").alias("component"))
    return old.unionByName(merged.join(labels, "node", "left_anti").select("node", F.col("into").alias("component")))


def _pair(x: DataFrame, y: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``x`` beside rows of ``y`` (columns with a suffix 2) of another component."""
    other = y.select(*on, *[F.col(c).alias(c + "2") for c in y.columns if c not in on])
    return x.join(other, on).where(F.col("component") < F.col("component2"))


def _within_reach(apart: DataFrame, s: Settings) -> DataFrame:
    """Pairs whose overlaps with the pivot alone could reach the threshold."""
    least = apart.groupBy("pivot").agg(F.min("n").alias("least"))
    alive = apart.join(least, "pivot").where(_reaches(F.col("shared"), F.col("n"), F.col("least"), s)).drop("least")
    both = _pair(alive, alive, ["pivot"]).where(
        _reaches(F.least("shared", "shared2"), F.col("n"), F.col("n2"), s))
    return both.select(F.col("node").alias("a"), F.col("node2").alias("b"))


def _beyond_pivot(apart: DataFrame, s: Settings) -> DataFrame:
    """Pairs that share shingles beyond their pivot, enough to reach the threshold."""
    extra = apart.select("node", "pivot", "component", F.explode(F.arrays_zip("gram", "c")).alias("g")).select(
        "node", "pivot", "component", "g.gram", "g.c")
    # only a shingle that members of two components have can count; a member
    # whose overlap with the pivot plus all of those stays out of reach of the
    # smallest member has no partner
    crossing = extra.groupBy("pivot", "gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where(
        F.col("lo") != F.col("hi")).select("pivot", "gram")
    extra = materialised(extra.join(crossing, ["pivot", "gram"]))
    most = extra.groupBy("node", "pivot").agg(F.sum("c").alias("most"))
    least = apart.groupBy("pivot").agg(F.min("n").alias("least"))
    alive = apart.select("node", "pivot", "shared", "n").join(most, ["node", "pivot"]).join(least, "pivot").where(
        _reaches(F.col("shared") + F.col("most"), F.col("n"), F.col("least"), s)).drop("least")
    extra = materialised(extra.join(alive, ["node", "pivot"]))
    both = _pair(extra, extra, ["pivot", "gram"]).where(_reaches(
        F.least("shared", "shared2") + F.least("most", "most2"), F.col("n"), F.col("n2"), s))
    both = both.groupBy("node", "node2", "pivot").agg(
        F.sum(F.least("c", "c2")).alias("more"), F.first(F.least("shared", "shared2")).alias("at_most"),
        F.first("n").alias("n"), F.first("n2").alias("n2"))
    return both.where(_reaches(F.col("at_most") + F.col("more"), F.col("n"), F.col("n2"), s)).select(
        F.col("node").alias("a"), F.col("node2").alias("b"))
