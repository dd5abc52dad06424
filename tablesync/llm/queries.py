"""Registered queries of the operators, with DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from .common import load, work_dir
from .decontaminate import contamination
from .jaccard import jaccard_report
from .licenses import license_report
from .linededup import PASSAGE_WORDS, line_report
from .merkle import manifest_report
from .pieces import round_trip
from .quality import quality_report
from .rules import rule_report
from .shards import shard_documents
from .tokenfiles import read_tokens, write_tokens
from .topk import top_products
from .unigram import token_counts
from .whitening import whitened_rows

QUERIES = {}
ORACLES: dict[str, str] = {}


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; TOKENIZER_DIR names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return wrap


@query("op1_ngram_jaccard")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_report(load(spark, sf, "documents"))


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    "op2_decontaminate",
    f"""
with d as (select row_number() over () as rid, doc_id, {_WORDS} as w from documents),
b as (select coalesce(cast(item_id as varchar), '') as item, {_WORDS} as w from benchmark),
win as (
  select item, least(10, len(w)) as n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') as s
  from (select *, unnest(range(1, len(w) - least(10, len(w)) + 2)) as i from b where len(w) > 0)
),
lens as (select distinct n from win),
spots as (
  select rid, n, i, array_to_string(w[i : i + n - 1], ' ') as s
  from (select rid, w, n, unnest(range(1, len(w) - n + 2)) as i from d, lens where len(w) >= n)
),
hits as (select rid, spots.n, i, item from spots join (select distinct * from win) as win on spots.n = win.n and spots.s = win.s),
words as (select rid, count(*) as n_hit from (select distinct rid, unnest(range(i, i + n)) as k from hits) group by 1),
items as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as names from (select distinct rid, item from hits) group by 1)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join words using (rid) left join items using (rid)
""",
)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return contamination(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


@query("op3_licenses")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return license_report(load(spark, sf, "documents"))


@query("op4_sentencepiece")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return round_trip(load(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op5_line_dedup")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return line_report(load(spark, sf, "documents"), passage_words=PASSAGE_WORDS)


@query(
    "op6_top_products",
    """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), p as (
  select q.vec_id as query_id, c.vec_id as vec_id,
         cast(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e)
  where q.vec_id % 50 = 0
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as "rank" from p
)
select query_id, "rank", vec_id, score from r where "rank" <= 5
""",
)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return top_products(load(spark, sf, "embeddings"), lambda i: i % 50 == 0, 5)


@query("op7_token_files")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    files = write_tokens(load(spark, sf, "documents"), vocabulary("word_bpe_49k.json"), work_dir(spark, "token-files"), end_id=2)
    return read_tokens(spark, files, digest=True)


@query("op8_token_counts")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(load(spark, sf, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op9_shards")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return shard_documents(load(spark, sf, "documents"), 40)


@query("op10_quality")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return quality_report(load(spark, sf, "documents"), load(spark, sf, "labels"))


_FIELD = "case when {0} is null then '-' else strlen(cast({0} as varchar)) || ':' || cast({0} as varchar) end"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# CRC-32 bit by bit: a byte is added, then eight steps (-1) follow
_CRC = """xor(list_reduce([4294967295] || flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295)"""


def _climb_sql(name: str, leaves: str) -> str:
    """All levels of the trees over ``g, idx, n, h``."""
    return f"""{name} as (
  select 0 as level, g, idx, n, h from {leaves}
  union all
  select level + 1, g, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' order by idx)) from {name} where n > 1 group by level, g, idx // 8, n
)"""


def _fold_sql(name: str, rows: str, nodes: str) -> str:
    """``rid, g, idx, n, cur, proof`` of ``rows`` folded up through the trees in ``nodes``."""
    return f"""{name} as (
  select 0 as level, rid, g, idx, n, cur, proof from {rows}
  union all
  select f.level + 1, f.rid, f.g, f.idx // 8, (f.n + 7) // 8, sha256(string_agg(case when s.idx = f.idx then f.cur else s.h end, '' order by s.idx)),
         f.proof || coalesce(string_agg(case when s.idx <> f.idx then s.h end, '' order by s.idx), '')
  from {name} f join {nodes} s on s.level = f.level and s.g = f.g and s.idx // 8 = f.idx // 8
  where f.n > 1 group by f.level, f.rid, f.g, f.idx, f.n, f.proof
)"""


@query(
    "op11_manifest",
    f"""
with recursive d as (
  select row_number() over () as rid, doc_id, lang, sha256({_HEAD} || {_FIELD.format('text')}) as leaf,
         case when doc_id is not null and {_CRC} % 3 = 0 then sha256({_HEAD} || {_FIELD.format(_LOWER)}) end as altered
  from documents
),
langs as (select lang, row_number() over (order by lang nulls first) - 1 as g, count(*) over () as n from (select distinct lang from documents)),
placed as (
  select d.*, langs.g, row_number() over (partition by langs.g order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by langs.g) as n
  from d join langs on d.lang is not distinct from langs.lang
),
leaves as (select g, idx, n, leaf as h from placed),
{_climb_sql('nodes', 'leaves')},
subroots as (select g, h from nodes where n = 1),
tops as (select 0 as g, subroots.g as idx, langs.n, h from subroots join langs on langs.g = subroots.g),
{_climb_sql('above', 'tops')},
changed as (select rid, g, idx, n, coalesce(altered, leaf) as cur, '' as proof from placed),
{_fold_sql('low', 'changed', 'nodes')},
risen as (select rid, 0 as g, low.g as idx, langs.n, cur, proof from low join langs on langs.g = low.g where low.n = 1),
{_fold_sql('high', 'risen', 'above')}
select doc_id, leaf, subroots.h as subroot, root.h as root, sha256(high.proof) as proof_sha256, high.cur as folded_root, high.cur = root.h as verified
from placed join subroots on placed.g = subroots.g join high on placed.rid = high.rid and high.n = 1, (select h from above where n = 1) as root
""",
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return manifest_report(load(spark, sf, "documents"))


@query("op12_quality_rules")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return rule_report(load(spark, sf, "documents"))


@query("op13_whitening")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return whitened_rows(load(spark, sf, "embeddings"))
