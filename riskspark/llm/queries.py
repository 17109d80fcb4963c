"""The registered queries: each operator over the whole given tables, and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import (
    alignment,
    html_extract,
    lm_scoring,
    mixing,
    near_dedup,
    near_vectors,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    token_files,
    topk,
    warc,
)
from riskspark.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.whole(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors.where("vec_id % 100 = 0"), vectors, k=10)


def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.main_text(pages, html_extract.fit(pages))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scoring.score(docs, lm_scoring.fit(docs, table(spark, sf_dir, "labels")))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), n=2)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.round_trip(table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_classifier.score(docs, quality_classifier.fit(docs, table(spark, sf_dir, "labels")))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules.judge(docs, quality_rules.fit(docs, table(spark, sf_dir, "labels")))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def _registered(query: Query) -> Query:
    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    f.__name__: _registered(f)
    for f in (
        op1_topk,
        op2_html_extract,
        op3_lm_scoring,
        op4_near_dedup,
        op5_warc,
        op6_packing,
        op7_quality_classifier,
        op8_mixing,
        op9_token_files,
        op10_quality_rules,
        op11_prefix_trie,
        op12_near_vectors,
        op13_alignment,
    )
}

TOPK = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(cast(x as double) * 1024) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), met as (
  select q.vec_id as query_id, c.vec_id,
         cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 100 = 0
)
select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
from met
qualify rank <= 10
"""

NEAR_DEDUP = r"""
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), s as (
  select distinct doc_id, case when len(w) = 1 then w[1] else w[i] || ' ' || w[i + 1] end as shingle
  from (select doc_id, w, unnest(range(1, greatest(len(w), 2))) as i from w where len(w) > 0)
), n as (
  select doc_id, count(*) as n from s group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c
  from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), links as (
  select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)
), both_ways as (
  select a, b from links union all select b, a from links
), reach(a, b) as (
  select doc_id, doc_id from n
  union
  select r.a, l.b from reach r join both_ways l on l.a = r.b
), least as (
  select a, min(b) as component_id from reach group by a
)
select w.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(component_id, w.doc_id) as component_id,
       w.doc_id = coalesce(component_id, w.doc_id) as kept
from w left join n using (doc_id) left join least on a = w.doc_id
"""

WARC = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
), g as (
  select *, max(page_id) over (partition by payload_digest) as largest from p
)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 1000 and page_id <> largest then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 1000 and page_id <> largest then largest end as refers_to
from g
"""

PREFIX_TRIE = r"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
         row_number() over (partition by conv_id order by turn nulls first, role, text) as pos
  from conversations where conv_id is not null
), sizes as (
  select conv_id, count(*) as n from turns group by conv_id
), hashed as (
  select conv_id, n, conv_id - conv_id % 20 as base,
         xor(list_reduce(
           list_concat([4294967295], list_transform(string_split(cast(conv_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
           lambda crc, c: list_reduce(list_concat([xor(crc, c)], range(8)), lambda x, bit: case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end)
         ), 4294967295) % 4 as h
  from sizes
), convs as (
  select c.conv_id, c.base, h, least(h, coalesce(b.n, 0)) as borrowed from hashed c left join sizes b on b.conv_id = c.base
), rebuilt as (
  select c.conv_id, t.pos, role, text from convs c join turns t on t.conv_id = c.base and t.pos <= h
  union all
  select c.conv_id, t.pos - h + borrowed, role, text from convs c join turns t on t.conv_id = c.conv_id and t.pos > h
), whole as (
  select c.conv_id, coalesce(list({'role': role, 'text': text} order by pos) filter (where pos is not null), []) as turns
  from convs c left join rebuilt using (conv_id) group by c.conv_id
), prefixes as (
  select conv_id, depth, len(turns) as size, sha256(cast(to_json(turns[1:depth]) as varchar)) as node,
         case when depth > 0 then sha256(cast(to_json(turns[1:depth - 1]) as varchar)) end as parent,
         case when depth > 0 then len(regexp_extract_all(turns[depth].text, '[^\x20\x09-\x0D]+')) else 0 end as words
  from (select *, unnest(range(0, len(turns) + 1)) as depth from whole)
), nodes as (
  select depth, node, any_value(parent) as parent, any_value(words) as words, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where size = depth), '')) as ends_sha256
  from prefixes group by depth, node
), counted as (
  select n.*, coalesce(c.kids, 0) as kids
  from nodes n left join (select depth - 1 as depth, parent as node, count(*) as kids from nodes where depth > 0 group by all) c using (depth, node)
), below as (
  select p.depth, p.node, sum(case when b.kids = 0 then 1 else 0 end) as n_leaves, sum((b.n_convs - 1) * b.words) as saved_tokens
  from counted b join prefixes p on p.conv_id = b.conv_id and p.depth <= b.depth group by all
)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, cast(n.kids as bigint) as n_children,
       cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, n.ends_sha256
from counted n join below b using (depth, node) left join nodes p on p.depth = n.depth - 1 and p.node = n.parent
"""

NEAR_VECTORS = """
with recursive v as (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
  where list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))
    / (sqrt(list_sum(list_transform(a.v, lambda x: x * x))) * sqrt(list_sum(list_transform(b.v, lambda x: x * x)))) >= 0.93
), reach(a, b) as (
  select distinct a, a from links union select r.a, l.b from reach r join links l on l.a = r.b
), least as (
  select a, min(b) as component_id from reach group by a
), n as (
  select a, count(*) as n_links from links group by a
)
select vec_id, coalesce(n_links, 0) as n_links, coalesce(component_id, vec_id) as component_id, vec_id = coalesce(component_id, vec_id) as kept
from embeddings left join n on n.a = vec_id left join least l on l.a = vec_id
"""

ORACLES: dict[str, str] = {
    "op1_topk": TOPK,
    "op4_near_dedup": NEAR_DEDUP,
    "op5_warc": WARC,
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_near_vectors": NEAR_VECTORS,
}
