"""Entropy balancing of sources against a plain version."""

import collections
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from salestide.llm import entropy_mix as em
from tests.llm.cases import collected, text

WORD = re.compile("[^\x20\x09-\x0D]+")
SF = "/root/testdata/sf0.001"


def plain_targets(sizes, cap=3):
    """Resharing step by step; ``sizes`` by source, None last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, got, stopped = sum(sizes.values()), {}, set()
    while True:
        free = [s for s in order if s not in stopped]
        left = total - sum(cap * sizes[s] for s in stopped)
        got = {s: cap * sizes[s] if s in stopped else left * weight[s] / sum(weight[f] for f in free) for s in order}
        new = {s for s in free if got[s] > cap * sizes[s]}
        if not new:
            return got
        stopped |= new


def plain_duals(sizes, target, cap=3):
    """Bisection for the rates of one source."""
    low, high = -50.0, 50.0
    mean = sum(sizes) / len(sizes)
    for _ in range(200):
        mid = (low + high) / 2
        if sum(c * min(cap, math.exp(min(mid * c / mean, 9))) for c in sizes) < target:
            low = mid
        else:
            high = mid
    return [min(cap, math.exp(min(low * c / mean, 9))) for c in sizes]


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for c in ("tag", "size", "n", "m", "rate", "place", "weight", "salt", "at", "from", "target"):
        df = df.withColumn(c, F.lit(f"x-{c}"))
    return df


def some_rows(seed=1, n=400):
    r = random.Random(seed)
    rows = [(i, r.choices(["a", "b", "B", "é", None], [9, 3, 2, 1, 1])[0], text(i, int(r.paretovariate(1.1) * 4)))
            for i in range(n)]
    return rows + [(5000, "empty", ""), (5001, "empty", None), (None, "a", text(3)), (7, "a", text(3))]


def check(rows, got, within):
    """Everything the contract says; ``within``: error of a source's words in
    shares of its target, besides half a text."""
    sizes, source_of = collections.Counter(), {}
    for _, s, t in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = plain_targets(dict(sizes))
    taken, ids = collections.Counter(), collections.Counter()
    expected = collections.Counter((i, len(WORD.findall(t or ""))) for i, _, t in rows)
    for r in got:
        assert r["taken"] == 0 if not r["size"] else r["taken"] % r["size"] == 0
        assert 0 <= r["taken"] <= 3 * r["size"]
        ids[r.doc_id, r["size"]] += 1
        taken[r.source_size, round(r["target"], 3)] += r["taken"]
    assert ids == expected
    for s, total in sizes.items():
        mine = [k for k in sizes if (sizes[k], round(want[k], 3)) == (total, round(want[s], 3))]
        assert abs(taken[total, round(want[s], 3)] - len(mine) * want[s]) <= len(mine) * (within * want[s] + 12), s


def test_mix_reaches_its_targets(spark):
    rows = some_rows()
    check(rows, em.mix(table(spark, rows)).collect(), 0.005)


def test_reruns_agree_however_rows_are_dealt(spark):
    df = table(spark, some_rows(2))
    first = collected(em.mix(df))
    assert first == collected(em.mix(df.repartition(7, F.rand(3))))


def test_many_classes_join_in_parts(spark, monkeypatch):
    df = table(spark, some_rows(3, 150))
    first = collected(em.mix(df))
    monkeypatch.setattr(em, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(em, "CHUNK", 2)
    assert first == collected(em.mix(df))


def test_cells_split_a_class_exactly(spark, monkeypatch):
    monkeypatch.setattr(em, "CELL", 10)
    rows = [(i, "a" if i % 4 else "b", "same text") for i in range(300)] + [(1000, "b", "one")] * 50
    got = em.mix(table(spark, rows)).collect()
    check(rows, got, 0.005)


def test_rates_are_the_tilted_ones(spark):
    sizes = [3, 3, 10, 40, 41, 200, 5]
    classes = spark.createDataFrame([(t, s, sizes.count(s)) for t in "xyz" for s in set(sizes)],
                                    "tag string, size long, n long")
    wanted = {"x": 0.4 * sum(sizes), "y": 2.5 * sum(sizes), "z": 3.0 * sum(sizes)}
    df = spark.createDataFrame(list(wanted.items()), "tag string, target double")
    got = {(r.tag, r["size"]): r["rate"] / em.UNIT for r in em.balance(classes, df).collect()}
    for t in wanted:
        for s, r in zip(sizes, plain_duals(sizes, wanted[t])):
            assert got[t, s] == pytest.approx(r, abs=1e-4)


def test_targets_stop_and_reshare(spark):
    sizes = {"a": 10, "b": 1000, "c": 5000, "d": 1, "e": 0, "f": 90}
    df = spark.createDataFrame([("a" + s, n) for s, n in sizes.items()], "tag string, source_size long")
    got = {r.tag[1:]: r.target for r in em.targets(df).collect()}
    want = plain_targets(sizes)
    assert got == pytest.approx(want) and sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_empty_tables(spark):
    assert em.mix(table(spark, [])).collect() == []
    got = em.mix(table(spark, [(1, "a", None), (2, None, " ")])).collect()
    assert [(r["size"], r.source_size, r["target"], r["taken"]) for r in got] == [(0, 0, 0.0, 0)] * 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="stored tables not present")
def test_op12_over_the_stored_documents(spark):
    from salestide.llm import queries
    rows = [(r.doc_id, r.source, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    check(rows, queries.QUERIES["op12_entropy_mix"](spark, SF).collect(), 0.005)
