"""Registered queries of this package: one ``opN_`` query per operator, each
over its whole stored table, with an SQL oracle where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salestide.llm import (
    anchor_dedup, bag_minhash, disclosure, edit_decontam, entropy_mix, importance_resample, license_dice,
    minimax_shards, posting_ann, secret_ledger, token_align, toxicity, unigram_pieces,
)
from salestide.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return wrap


def _sql_spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    p = pattern.replace("'", "''")
    return f"""
select doc_id, {rank} as rk, '{kind}' as kind,
       list_sum(list_transform(gaps[1:i], lambda x: length(x)))
         + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) as a,
       length(ms[i]) as n
from (select doc_id, ms, parts, gaps, unnest(range(1, len(ms) + 1)) as i from (
        select doc_id, regexp_extract_all(t, '{p}') as ms, regexp_extract_all(t, '{p}', {group}) as parts,
               string_split_regex(t, '{p}') as gaps from d))
where length(parts[i]) >= {least}"""


_SPANS = " union all ".join(_sql_spans(r.kind, i, r.pattern, r.group, r.least)
                            for i, r in enumerate(secret_ledger.RULES))


@register("op3_secret_ledger", f"""
with d as (select doc_id, coalesce(text, '') as t from documents), s as ({_SPANS}),
g as (select doc_id, count(*) filter (where kind = 'assign') as n_assign,
        count(*) filter (where kind = 'access') as n_access, count(*) filter (where kind = 'hex') as n_hex,
        string_agg(kind || ':' || a::bigint || ':' || (a + n)::bigint, ',' order by a, rk)
          filter (where kind in ('assign', 'access', 'hex')) as base,
        string_agg(kind || ':' || a::bigint || ':' || (a + n)::bigint, ',' order by a, rk) as spans
      from s group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access,
       coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join g using (doc_id)
""")
def op3_secret_ledger(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return secret_ledger.findings_by_path(docs, secret_ledger.scan_unseen(docs))


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_TEMPLATES = ", ".join(f"({i}, '{name}', {_sql_list(license_dice.bigrams(text))})"
                       for i, (name, text) in enumerate(license_dice.TEMPLATES))


@register("op7_license_dice", f"""
with t(ord, id, tb) as (values {_TEMPLATES}),
d as (select row_number() over () as rid, doc_id, lower(coalesce(text, '')) as x from documents),
u as (select rid, unnest(string_split(x, chr(10))) as unit from d
      union all select rid, unnest(string_split_regex(x, '\n[ \t]*\n')) from d
      union all select rid, x from d),
w as (select rid, string_split(trim(regexp_replace(unit, '[^a-z0-9]+', ' ', 'g')), ' ') as ws
      from (select distinct rid, unit from u)),
b as (select rid, list_distinct(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) as bs
      from w where len(ws) between 2 and 2000),
m as (select rid, id, ord, 2.0 * len(list_intersect(bs, tb)) / (len(bs) + len(tb)) as dice from b, t
      where len(bs) between 0.6 * len(tb) and 1.6 * len(tb)),
g as (select rid, arg_max(id, (dice, -ord)) as license, max(dice) as dice, count(distinct id) as n_matches,
             array_to_string(list_sort(list(distinct id)), ',') as licenses
      from m where dice >= {license_dice.THRESHOLD} group by rid)
select doc_id, license, coalesce(dice, 0)::double as dice, coalesce(licenses, '') as licenses,
       coalesce(n_matches, 0) as n_matches
from d left join g using (rid)
""")
def op7_license_dice(spark, sf_dir):
    return license_dice.license_matches(table(spark, sf_dir, "documents"))


@register("op1_toxicity_fm")
def op1_toxicity_fm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_documents(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@register("op4_disclosure")
def op4_disclosure(spark, sf_dir):
    return disclosure.scan(table(spark, sf_dir, "documents"))


def _public(variable: str, name: str) -> str:
    named = os.environ.get(variable)
    if named:
        return named
    import public_tokenizers
    return str(public_tokenizers.path(name))


def tokenizer_path() -> str:
    """The public SentencePiece model; set SALESTIDE_PIECES to use another."""
    return _public("SALESTIDE_PIECES", "piece_bpe_32k.model")


def byte_bpe_path() -> str:
    """The public byte-level BPE file; set SALESTIDE_BYTE_BPE to use another."""
    return _public("SALESTIDE_BYTE_BPE", "byte_bpe_50k.json")


@register("op8_unigram_pieces")
def op8_unigram_pieces(spark, sf_dir):
    pieces = unigram_pieces.Pieces.load(tokenizer_path())
    return unigram_pieces.encode_documents(table(spark, sf_dir, "documents"), pieces)


@register("op5_edit_decontam")
def op5_edit_decontam(spark, sf_dir):
    return edit_decontam.contaminations(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op9_bag_minhash")
def op9_bag_minhash(spark, sf_dir):
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


_WORDS = "[^\\x20\\x09-\\x0D]+"


@register("op2_anchor_dedup", f"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') as w from documents),
s as (select doc_id, unnest(range(1, len(w) - {anchor_dedup.WINDOW - 2})) as a, w from d
      where len(w) >= {anchor_dedup.WINDOW}),
k as (select doc_id, a, array_to_string(w[a:a + {anchor_dedup.WINDOW - 1}], ' ') as t from s),
r as (select doc_id, a from (select doc_id, a, row_number() over (partition by t order by doc_id, a) as n from k)
      where n > 1),
c as (select doc_id, list(distinct i) as gone from (
        select doc_id, unnest(range(a, a + {anchor_dedup.WINDOW})) as i from r) group by doc_id)
select d.doc_id, len(w) as n_words, coalesce(len(gone), 0) as n_removed,
       sha256(coalesce(array_to_string(case when gone is null then w else list_filter(w, lambda x, i: not list_contains(gone, i)) end, ' '), ''))
         as kept_sha256
from d left join c using (doc_id)
""")
def op2_anchor_dedup(spark, sf_dir):
    return anchor_dedup.remove_repeats(table(spark, sf_dir, "documents"))


@register("op6_posting_ann")
def op6_posting_ann(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return posting_ann.nearest(vectors, vectors.where("vec_id % 20 = 0"))


@register("op10_minimax_shards")
def op10_minimax_shards(spark, sf_dir):
    return minimax_shards.shard_documents(table(spark, sf_dir, "documents"))


_LOWER = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")


# ct: the CRC-32 table by its rule; crc: the checksum of each distinct feature
@register("op11_importance_resample", f"""
with ct as materialized (
  select list(c order by b) as tab from (
    select b, list_reduce(range(8), lambda c, j: case when (c & 1) = 1 then xor(c >> 1, 3988292384::bigint)
                                                      else c >> 1 end, b::bigint) as c
    from range(256) r(b))),
d as materialized (select row_number() over () as rid, doc_id, {_LOWER} as w from documents),
src as (select rid, w from d union all select null, {_LOWER} from benchmark),
f as materialized (
  select rid, array_to_string(w[i:i + k], ' ') as g
  from (select rid, w, k, unnest(range(1, len(w) - k + 1)) as i from src, range({importance_resample.RUN}) q(k)
        where len(w) > k)),
x as (select g, count(rid) as s, count(*) - count(rid) as t, hex(encode(g)) as h from f group by g),
y as (select g, s, t, list_transform(range(0, length(h) // 2), lambda i:
        instr('0123456789ABCDEF', h[2 * i + 1]) * 16 + instr('0123456789ABCDEF', h[2 * i + 2]) - 17) as bs from x),
c as materialized (
  select g, s, t, xor(list_reduce(bs, lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1]), 4294967295::bigint),
                      4294967295::bigint) % {importance_resample.BUCKETS} as bucket from y, ct),
p as (select bucket, sum(s)::double as s, sum(t)::double as t from c group by bucket),
z as (select sum(s) as s, sum(t) as t from p),
n as (select bucket, floor(1000 * ln((p.t + 1) * (z.s + {importance_resample.BUCKETS})
                                     / ((p.s + 1) * (z.t + {importance_resample.BUCKETS}))))::bigint as gain from p, z),
v as (select rid, count(*) as n_features, sum(gain)::bigint as weight
      from f join c using (g) join n using (bucket) where rid is not null group by rid),
e as (select doc_id, rid, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
        ('0x' || substr(sha256('{importance_resample.SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint as h
      from d left join v using (rid)),
o as (select *, weight + floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296)))::bigint as score from e),
r as (select rid, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n
      from o where n_words >= {importance_resample.MIN_WORDS})
select doc_id, n_features, weight, score, case when rank <= {importance_resample.PERCENT} * n // 100 then rank end as rank
from o left join r using (rid)
""")
def op11_importance_resample(spark, sf_dir):
    return importance_resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op12_entropy_mix")
def op12_entropy_mix(spark, sf_dir):
    return entropy_mix.mix(table(spark, sf_dir, "documents"))


@register("op13_token_align")
def op13_token_align(spark, sf_dir):
    tokenizers = token_align.Tokenizers.load(byte_bpe_path(), tokenizer_path())
    return token_align.align(table(spark, sf_dir, "documents"), tokenizers)
