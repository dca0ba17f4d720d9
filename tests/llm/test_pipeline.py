"""The pipeline end to end, its registration and the queries' oracles."""

import os
import random

import pytest

import corpus_pipeline
from salestide.llm import queries
from tests.compare import compare, duck
from tests.llm.cases import text

SF = "/root/testdata/sf0.001"
stored = pytest.mark.skipif(not os.path.isdir(SF), reason="stored tables not present")


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert names["pipeline"] is corpus_pipeline.run
    assert set(queries.ORACLES) <= set(queries.QUERIES)


@stored
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_oracles(spark, name):
    status, detail, _n, _s = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLES[name], SF)
    assert status == "MATCH", detail


def planted(spark, folder):
    """Clean documents, toxic ones, near copies, a leak and personal data."""
    r = random.Random(1)
    rows = [(i, text(i, 80)) for i in range(300)]
    rows += [(1000 + i, " ".join(sorted(text(2000 + i, 60).split() + ["vermin"] * 3, key=lambda _: r.random())))
             for i in range(120)]
    rows += [(2000 + i, rows[i][1] + " tail") for i in range(10)]
    rows += [(3000, f"{text(71, 40)} {text(9000, 30)} {text(72, 40)}")]
    rows += [(4000, f"{text(81, 40)} reach me at kim@mail.example.com please {text(82, 40)}")]
    rows += [(5000, ""), (5001, None)]
    labels = [(i, 0) for i in range(300)] + [(1000 + i, 1) for i in range(120)]
    for name, df in (
            ("documents", spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                                "doc_id long, text string, lang string, source string, n_chars long")),
            ("labels", spark.createDataFrame(labels, "doc_id long, toxic int")),
            ("benchmark", spark.createDataFrame([(1, text(9000, 30)), (2, text(9001, 30))],
                                                "item_id long, text string"))):
        df.write.parquet(f"{folder}/{name}.parquet")
    return rows


def test_pipeline_stages_take_effect(spark, tmp_path):
    rows = planted(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    seen = {}
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert n == 4 or out.columns == columns
        out.write.parquet(f"{tmp_path}/stage{n}")
        docs = spark.read.parquet(f"{tmp_path}/stage{n}")
        seen[name] = {r.doc_id: r.asDict() for r in docs.collect()}
    assert not [i for i in seen["toxicity"] if 1000 <= i < 2000] and set(range(300)) <= set(seen["toxicity"])
    gone = set(seen["toxicity"]) - set(seen["near_dedup"])
    assert gone == {2000 + i for i in range(10)}
    assert set(seen["near_dedup"]) - set(seen["decontamination"]) == {3000}
    clean = {i: t for i, t in rows if i < 300}
    assert all(seen["pii"][i]["text"] == t for i, t in clean.items())
    assert "[EMAIL]" in seen["pii"][4000]["text"] and "kim@" not in seen["pii"][4000]["text"]
    assert seen["pii"][4000]["n_chars"] == len(seen["pii"][4000]["text"])
    last = seen["sentencepiece"]
    assert set(last) == set(seen["pii"]) and all(r["round_trip"] for r in last.values())


def test_run_returns_the_last_stage(spark, tmp_path):
    planted(spark, str(tmp_path))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_pieces", "ids", "round_trip"] and out.count() == 303
