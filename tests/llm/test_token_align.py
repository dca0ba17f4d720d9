"""Token alignment against a plain version."""

import collections
import hashlib
import os
import random

import numpy as np
import pytest

from salestide.llm import token_align as ta
from tests.llm.cases import collected, docs, edge_rows, text

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizers():
    return ta.Tokenizers.load(str(P.path("byte_bpe_50k.json")), str(P.path("piece_bpe_32k.model")))


def plain_rows(rows):
    """The contract, from whole texts and all pairs of tokens of a group."""
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(str(P.path("byte_bpe_50k.json")))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=str(P.path("piece_bpe_32k.model")))
    bs = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(c): c for c in bs}
    for c in range(256):
        if c not in bs:
            char[chr(256 + sum(x not in bs for x in range(c)))] = c

    def bytes_a(i):
        return bytes(char[c] for c in a.id_to_token(i))

    def bytes_b(i):
        p = b.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()

    def spans(tokens):
        out, at = [], 0
        for i, t in tokens:
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    docs_, held = [], collections.Counter()
    for i, t in rows:
        data = (" " + (t or "")).encode()
        x = [(k, bytes_a(k)) for k in a.encode(" " + t, add_special_tokens=False).ids] if t else []
        y = [(k, bytes_b(k)) for k in b.encode(t)] if t else []
        if b"".join(k for _, k in x) != data or b"".join(k for _, k in y) != data:
            docs_.append((i, [], [], [], []))
            continue
        x, y = spans(x), spans(y)
        ends = sorted({e for *_, e in x} & {e for *_, e in y})
        groups = [([k for k, _, e in x if s < e <= f], [k for k, _, e in y if s < e <= f])
                  for s, f in zip([0, *ends], ends)] if len(data) < 5000 else None
        links, j = [], 0
        for k, s, e in x:
            while y[j][2] <= s:
                j += 1
            m = j
            while m < len(y) and y[m][1] < e:
                links.append((k, y[m][0]))
                m += 1
        held.update(set(links))
        docs_.append((i, x, y, groups if groups is not None else ends, links))
    most = collections.Counter()
    for (k, _), n in held.items():
        most[k] = max(most[k], n)
    out = []
    for i, x, y, groups, links in docs_:
        sha = ""
        if x and isinstance(groups[0], tuple):
            sha = hashlib.sha256(";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h))
                                          for g, h in groups).encode()).hexdigest()
        out.append((i, len(x), len(y), len(groups), len(links), sum(held[p] == most[p[0]] for p in links),
                    sum(held[p] for p in links), sha))
    return sorted(out, key=repr)


def agree(got, want):
    assert [r[:-1] for r in got] == [r[:-1] for r in want]
    assert all(g[-1] == w[-1] for g, w in zip(got, want) if w[-1] or not w[1])


ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "  two  spaces ", " lead", "tail ", "a\tb\nc\r\n\r\nd", "▁ mark ▁▁",
       "é ñ 漢字 🤦🏼‍♂️ ​﻿", "don't we'll I'M", " nbsp　wide", "x", " ", "ﬁ ﬀ ²", "\x00\x01 null",
       "    indented = [1, 2,   3]"]


def test_gallop_counts_smaller_entries():
    r = random.Random(1)
    for _ in range(300):
        long = sorted(r.sample(range(400), r.randint(0, 80)))
        short = sorted(r.sample(range(400), r.randint(0, 40)))
        assert ta.gallop(short, long) == [sum(y < x for y in long) for x in short]


def test_parts_encode_as_whole_texts_do(tokenizers):
    r = random.Random(2)
    texts = [" ".join(r.choice([*ODD, text(i, 8), "", " "]) for i in range(30)) for _ in range(60)]
    assert all(" ".join(ta.cut(t)) == t for t in texts) and any(len(ta.cut(t)) > 30 for t in texts)
    a, b, of_a, of_b = tokenizers.parts()
    for t, (x, y) in zip(texts, tokenizers.encode(texts)):
        whole = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        data = (" " + t).encode()
        if of_a.joined(whole[0]) != data or of_b.joined(whole[1]) != data:
            whole = [], []
        assert (x.tolist(), y.tolist()) == tuple(whole)


def test_align_matches_the_plain_version(spark, tokenizers, monkeypatch):
    rows = edge_rows([(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, text(i % 9, 40)) for i in range(60)])
    agree(collected(ta.align(docs(spark, rows).repartition(3), tokenizers)), plain_rows(rows))


def test_chunks_and_blocks_of_any_size(tokenizers, monkeypatch):
    monkeypatch.setattr(ta, "BLOCK", 7)
    *_, of_a, of_b = tokenizers.parts()
    (a, b), = tokenizers.encode([text(3, 80)])
    found = ta.Aligned.of(a, b, of_a, of_b)
    pairs, times = found.links()
    monkeypatch.setattr(ta, "BLOCK", 1 << 18)
    again = found.links()
    assert np.array_equal(pairs, again[0]) and np.array_equal(times, again[1])
    assert times.sum() == found.n_links


def test_empty_tables(spark, tokenizers):
    assert ta.align(docs(spark, []), tokenizers).collect() == []
    got = collected(ta.align(docs(spark, [(1, None), (2, "")]), tokenizers))
    assert got == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="stored tables not present")
def test_op13_over_the_stored_documents(spark):
    from salestide.llm import queries
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    agree(collected(queries.QUERIES["op13_token_align"](spark, SF)), plain_rows(rows))
