"""Importance resampling against a plain version."""

import collections
import hashlib
import math
import random
import re
import zlib

from pyspark.sql import functions as F

from salestide.llm import importance_resample as ir
from tests.llm.cases import collected, docs, edge_rows, text

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(t):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return len(w), [zlib.crc32(" ".join(w[i:i + k]).encode()) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def plain_resample(rows, target, percent=5, buckets=10_000):
    s, t = collections.Counter(), collections.Counter()
    for _, x in rows:
        s.update(c % buckets for c in plain_features(x)[1])
    for x in target:
        t.update(c % buckets for c in plain_features(x)[1])
    S, T = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * (S + buckets) / ((s[b] + 1.0) * (T + buckets))))

    out, able = [], []
    for i, x in rows:
        n, crcs = plain_features(x)
        weight = sum(gain(c % buckets) for c in crcs)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(crcs), weight, score))
        if n >= 20:
            able.append((-score, i is None, i or 0, len(out) - 1))
    drawn = {r[-1]: k for k, r in enumerate(sorted(able)[:percent * len(able) // 100], 1)}
    return sorted(((*r, drawn.get(j)) for j, r in enumerate(out)), key=repr)


def test_checksums_of_runs_without_writing_them():
    r = random.Random(3)
    texts = ["".join(r.choice(["a", "B", "é", "漢", "0", " ", ".", "\n", "q" * r.choice([1, 70, 400])])
                     for _ in range(r.randint(0, 60))) for _ in range(120)] + ["", " . "]
    runs, n_words = ir.Checksums().features([t.encode() for t in texts])
    got = collections.defaultdict(list)
    for crc, owner in runs:
        for c, o in zip(crc.tolist(), owner.tolist()):
            got[o].append(c)
    for i, t in enumerate(texts):
        n, want = plain_features(t)
        assert (n_words[i], sorted(got[i])) == (n, sorted(want))


def test_pieces_of_a_long_text_end_between_words(monkeypatch):
    t = (text(4, 3000) + " " + "y" * 3000 + " " + text(5, 300)).encode()
    whole = ir.Checksums().words(t)
    monkeypatch.setattr(ir, "PIECE", 512)
    assert all((a == b).all() for a, b in zip(whole, ir.Checksums().words(t)))


def test_resample_matches_the_plain_version(spark):
    rows = edge_rows([(100 + i, text(i % 37, 15 + i % 40)) for i in range(300)])
    target = [text(3), text(8, 200), None, ""]
    df = spark.createDataFrame([(t,) for t in target], "text string")
    got = collected(ir.resample(docs(spark, rows), df))
    assert got == plain_resample(rows, target)
    assert sum(r[-1] is not None for r in got) == 5 * sum(plain_features(t)[0] >= 20 for _, t in rows) // 100


def test_empty_tables(spark):
    empty, rows = docs(spark, []), docs(spark, [(1, text(1)), (2, None)])
    assert ir.resample(empty, empty).collect() == []
    assert [r["rank"] for r in ir.resample(rows, empty, percent=100).orderBy("doc_id").collect()] == [1, None]


def test_quickselect_finds_every_place(spark):
    """Ties in the score, in the id and in both; each k, few pivots."""
    r = random.Random(5)
    keys = [(r.randint(0, 6), r.randint(0, 3), r.randint(0, 1), i) for i in range(60)]
    df = spark.createDataFrame(keys, "score long, id long, n_features long, row long").cache()
    want = sorted(keys, key=lambda k: (-k[0], *k[1:]))
    for k in (1, 2, 17, 30, 59, 60):
        assert ir.kth_key(df, k, len(keys), pivots=2) == want[k - 1]


def test_repeated_rows_are_drawn_apart(spark):
    rows = [(7, text(1, 30))] * 40
    got = ir.resample(docs(spark, rows), spark.createDataFrame([(text(1),)], "text string"), percent=50)
    assert sorted(r["rank"] for r in got.where(F.col("rank").isNotNull()).collect()) == list(range(1, 21))
