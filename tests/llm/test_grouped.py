"""Operators that compare rows with each other, against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from salestide.llm import anchor_dedup, bag_minhash, grams, minimax_shards, posting_ann
from salestide.llm.components import connected
from tests.llm.cases import collected, docs, edge_rows, text, words


# -- substring de-duplication ---------------------------------------------------


def plain_repeats(rows, window):
    """Per (id, text): words, removed, digest; equal rows are one document."""
    order = sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    seen, out, place = {}, {}, {}
    for i, t in order:
        place.setdefault(i, len(place))
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        cover = [False] * len(w)
        for a in range(len(w) - window + 1):
            k = tuple(w[a:a + window])
            if k in seen:
                cover[a:a + window] = [True] * window
            seen.setdefault(k, i)
        kept = " ".join(x for x, c in zip(w, cover) if not c)
        out[(i, t)] = (i, len(w), sum(cover), hashlib.sha256(kept.encode()).hexdigest())
    return out


def repeat_rows():
    passage = text(900, 33)
    rows = edge_rows([(100 + i, f"{text(i, 7 + i)} {passage}\n\t{text(i + 40, i)}") for i in range(15)])
    rows += [(200 + i, text(77, 45)) for i in range(12)]                      # exact copies
    rows += [(300, " ".join(words(5, 25) * 3)), (301, "a " * 100), (302, "b c " * 40)]
    r = random.Random(9)
    for i in range(20):                                                       # patched together
        parts = [words(500 + r.randrange(4), 60)[a:a + r.randint(5, 40)] for a in range(0, 60, 20)]
        rows.append((400 + i, " ".join(x for p in parts for x in p)))
    return rows


@pytest.mark.parametrize("window", [20, 8])
def test_repeats_against_brute_force(spark, window):
    rows = repeat_rows()
    got = collected(anchor_dedup.remove_repeats(docs(spark, rows), window=window))
    want = plain_repeats(rows, window)
    assert got == sorted((want[r] for r in rows), key=repr)
    assert sum(r[2] for r in got) > 500


def test_repeats_do_not_depend_on_chunks(spark):
    d = docs(spark, repeat_rows())
    assert collected(anchor_dedup.remove_repeats(d, n_chunks=1)) == collected(
        anchor_dedup.remove_repeats(d, n_chunks=50))
    assert anchor_dedup.remove_repeats(docs(spark, [])).count() == 0


def test_packed_keys_round_trip():
    for keys in ([5], [1, 2, 2 ** 47], list(range(0, 10 ** 6, 997))):
        k = np.array(keys, dtype=np.uint64)
        back, rest = anchor_dedup._unpack(anchor_dedup._pack(k) + b"tail", len(k))
        assert back.tolist() == keys and rest == b"tail"


def test_words_split_like_the_pattern():
    for t in ["", " ", "a", " a\tb\x0bc\x0cd\re\nf ", "é x 漢字", "a  b"]:
        w = grams.words_of([t.encode(), b"next word"])
        assert np.diff(w.first).tolist() == [len(re.findall(r"[^\x20\x09-\x0D]+", t)), 2]
        assert len(t.encode().split()) == np.diff(w.first)[0]


# -- near-duplicates ------------------------------------------------------------


def bag(t, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", t.lower())
    return collections.Counter(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def plain_classes(rows, threshold=0.8):
    """Smallest id of the component of every usable text."""
    texts = sorted({t for i, t in rows if i is not None and t and t.strip(" \t\n\r\x0b\x0c")})
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = sum((bags[a] & bags[b]).values())
            if both >= threshold * sum((bags[a] | bags[b]).values()):
                root[find(a)] = find(b)
    low = {}
    for i, t in rows:
        if i is not None and t in texts:
            r = find(texts.index(t))
            low[r] = min(low.get(r, i), i)
    return {t: low[find(k)] for k, t in enumerate(texts)}


def near_rows():
    r = random.Random(11)
    rows = edge_rows()
    for f in range(6):       # families with edits from few to many, and chains of copies of copies
        base = words(700 + f, 120)
        for i in range(25):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3, 5, 8])):
                w[r.randrange(len(w))] = f"edit{r.randrange(9)}"
            if r.random() < 0.2:
                w = w[: r.randint(95, 119)]
            if r.random() < 0.3:
                base = w
            rows.append((1000 + 100 * f + i, " ".join(w)))
    rows += [(5000 + i, " ".join(words(800, 9) * (8 + i))) for i in range(6)]     # weights differ
    rows += [(6000, "one two"), (6001, "One  TWO"), (6002, "one two three")]
    return rows


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows()
    got = bag_minhash.near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    want = plain_classes(rows)
    expected = sorted(((i, want.get(t, i) if i is not None else None) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.class_id) for r in got), key=repr) == expected
    size = collections.Counter(c for i, c in expected if i is not None)
    assert all(r.class_size == size[r.class_id] for r in got if r.doc_id is not None and r.doc_id != 6)


def test_signatures_are_unbiased():
    rng = np.random.default_rng(2)
    off = []
    for _ in range(20):
        g = rng.integers(1, 2 ** 63, 150).astype(np.uint64)
        a = rng.integers(1, 9, 150)
        b = np.maximum(0, a + rng.integers(-3, 4, 150))
        k = b > 0
        sig = bag_minhash.signatures(np.concatenate([np.zeros(150, int), np.ones(k.sum(), int)]),
                                     np.concatenate([g, g[k]]), np.concatenate([a, b[k]]), 2, 1024)
        off.append((sig[0] == sig[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(off)) < 0.01 and np.max(np.abs(off)) < 0.07


def test_one_per_class_keeps_columns_and_clean_rows(spark):
    rows = near_rows()
    d = docs(spark, rows)
    kept = bag_minhash.one_per_class(d)
    assert kept.columns == d.columns
    want = plain_classes(rows)
    ids = {i for i, t in rows if i is not None and want.get(t, i) == i}
    got = [r.doc_id for r in kept.select("doc_id").collect()]
    assert sorted(i for i in got if i is not None) == sorted(ids) and got.count(None) == 1
    assert bag_minhash.one_per_class(docs(spark, [])).count() == 0


def test_one_per_class_decides_by_id_and_text(spark):
    a, b = text(70, 40), text(71, 40)
    c = a + " and one more"
    rows = [(2, b), (5, a), (5, b), (7, c), (7, c), (8, a), (9, None), (9, None), (None, b), (10, "")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("row", "id", "node", "usable", "__key"):
        d = d.withColumn(name, F.concat(F.lit(f"{name}-"), F.col("doc_id").cast("string")))
    kept = bag_minhash.one_per_class(d)
    assert kept.columns == d.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    assert got == sorted([(2, b), (5, a), (9, None), (None, b), (10, "")], key=repr)
    assert all(r["__key"] == f"__key-{r.doc_id}" for r in kept.collect() if r.doc_id is not None)


def test_components_against_union_find(spark):
    r = random.Random(12)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(150)] + [(i, i + 1) for i in range(300, 340)]
    edges += [(500, 500 + i) for i in range(1, 60)]
    df = spark.createDataFrame(edges, "a long, b long")
    low = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in range(400):
        for a, b in edges:
            if a != b:
                low[a] = low[b] = min(low[a], low[b])
    assert dict(map(tuple, connected(df).collect())) == low
    assert connected(df.limit(0)).count() == 0


# -- nearest neighbours ---------------------------------------------------------


def vectors(spark, rows):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for c in ("list", "part", "v", "q", "score", "n", "nth", "label"):
        df = df.withColumn(c, F.lit("x"))
    return df


def plain_nearest(rows, k, dim):
    fine = {}
    for i, v in rows:
        if i is not None and v and None not in v and len(v) == dim and np.isfinite(v).all() and np.any(v):
            fine[i] = min(fine.get(i, v), v)
    out = {}
    ids = np.array(sorted(fine))
    x = np.array([fine[i] for i in ids])
    for q in (i for i in fine if i % 20 == 0):
        s = (x * np.array(fine[q])).sum(axis=1)
        o = [int(j) for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in o]
    return out


def ann_rows():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(12, 16))
    rows = [(i, (centre[i % 12] * rng.uniform(0.5, 2) + 0.3 * rng.normal(size=16)).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[7][1]) for i in range(300)]                    # one hot vector
    rows += [(3000, None), (3020, [0.0] * 16), (3040, [float("nan")] * 16), (3060, [1.0] * 4),
             (None, [1.0] * 16), (3080, [None] + [1.0] * 15), (40, rows[40][1])]
    return rows


def test_nearest_against_brute_force(spark):
    rows = ann_rows()
    d = vectors(spark, rows)
    got = collections.defaultdict(list)
    for r in posting_ann.nearest(d, d.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect():
        assert r.rank == len(got[r.query_id]) + 1
        got[r.query_id].append((r.vec_id, r.score))
    want = plain_nearest(rows, 20, 16)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    score = {(q, i): s for q, v in want.items() for i, s in v}
    hit = sum((q, i) in score for q, v in got.items() for i, _ in v)
    assert hit / (20 * len(want)) >= 0.9
    assert all(abs(score[q, i] - s) < 1e-12 for q, v in got.items() for i, s in v if (q, i) in score)
    assert all(v == sorted(v, key=lambda x: (-x[1], x[0])) for v in got.values())
    # equal vectors: a copy's neighbours are the other copies with the smallest ids
    assert [i for i, _ in got[2000]][:3] == [i for i, _ in want[2000]][:3]


def test_nearest_with_few_vectors(spark):
    rows = [(i, [1.0 + i, 2.0]) for i in range(0, 60, 20)] + [(7, [0.0, 0.0])]
    d = vectors(spark, rows)
    got = collected(posting_ann.nearest(d, d.where("vec_id % 20 = 0")))
    assert [r[:3] for r in got] == [(0, 1, 40), (0, 2, 20), (20, 1, 40), (20, 2, 0), (40, 1, 20), (40, 2, 0)]
    empty = d.limit(0)
    assert posting_ann.nearest(empty, empty).count() == 0


# -- sharding -------------------------------------------------------------------


def plain_capacity(sizes, n):
    """Smallest capacity of ``n`` contiguous parts, by dynamic programming."""
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(n):
        new = list(best)
        for j in range(1, len(sizes) + 1):
            run = 0
            for i in range(j, 0, -1):
                run += sizes[i - 1]
                if run >= new[j]:
                    break
                new[j] = min(new[j], max(best[i - 1], run))
        best = new
    return best[-1]


@pytest.mark.parametrize("n", [1, 3, 8, 40])
def test_capacity_is_the_optimum(spark, n):
    r = random.Random(n)
    keys = sorted({r.randrange(-2 ** 63, 2 ** 63) for _ in range(90)} | {i for i in range(60)})
    sizes = [r.choice([16, 20, 500, 40]) for _ in keys]
    groups = spark.createDataFrame(list(zip(keys, sizes)), "key long, size long")
    capacity, cuts = minimax_shards.plan_cuts(groups, n)
    assert capacity == plain_capacity(sizes, n)
    total = collections.Counter()
    for k, s in zip(keys, sizes):
        total[sum(c <= k for c in cuts)] += s
    assert max(total.values()) <= capacity and max(total) < n


def test_shards_and_slots(spark):
    import zlib
    rows = edge_rows([(i, text(i, 5)) for i in range(100, 400)] + [(i, "copy of one") for i in range(500, 700)])
    got = minimax_shards.shard_documents(docs(spark, rows), n_shards=7).collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and set(by) <= set(range(7))
    text_of = {i: (t or "") for i, t in rows if i is not None}
    for r in got:
        if r.doc_id is not None:
            data = text_of[r.doc_id].encode()
            assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        assert r.law == "bytes" and r.grown_shard is None
    where = collections.defaultdict(set)
    for r in got:
        if r.doc_id is not None:
            where[text_of[r.doc_id]].add(r.shard)
    assert all(len(v) == 1 for v in where.values())
    assert minimax_shards.shard_documents(docs(spark, [])).count() == 0


def test_one_huge_group_leaves_no_shard_empty(spark):
    rows = [(i, "same text " * 30) for i in range(400)] + [(1000 + i, text(i, 20)) for i in range(400)]
    got = minimax_shards.shard_documents(docs(spark, rows), n_shards=8).groupBy("shard").count().collect()
    assert len(got) == 8


def test_rows_that_stay_are_dealt_once(spark):
    df = docs(spark, edge_rows())
    above, found = [], 0
    for line in bag_minhash.one_per_class(df)._jdf.queryExecution().executedPlan().toString().splitlines():
        name = re.search(r"[A-Za-z]+", line)
        while above and above[-1][0] >= name.start():
            above.pop()
        if "LeftSemi" in line:
            found += 1
            assert not [n for _, n in above if n.endswith("Exchange")]
        above.append((name.start(), name[0]))
    assert found == 1
