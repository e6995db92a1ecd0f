"""Queries of the training-data operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm import (bpe, decontamination, embedding_dedup, hard_negatives, manifest, mixing, passages, pii, quality, secrets,
                         sharding, simhash, token_counts)
from martlet.llm.common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), words=3, radius=3)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents"), shards=8)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "shards")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op10_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(
        table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"],
        tampered={"text": F.replace(F.col("text"), F.lit("\n"), F.lit(""))}, where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = hard_negatives.whole_vectors(table(spark, sf_dir, "embeddings"))
    label = F.col("label").cast("long")
    moved = vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.hard_negatives(moved, F.col("vec_id") % 100 == 0)


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_bpe, op3_pii, op4_embeddings, op5_sharding, op6_token_counts, op7_mixing, op8_quality,
                                    op9_secrets, op10_passages, op11_manifest, op12_hard_negatives, op13_decontamination)}


#: Brute force over all pairs. The other operators rest on tokenisers, on hashes or on
#: places of matches that SQL does not give; tests hold them against plain versions.
_EMBEDDINGS_SQL = """
with recursive e as (select vec_id, cast(embedding as double[]) as v from embeddings),
link as (select a.vec_id as a, b.vec_id as b from e a join e b on a.vec_id <> b.vec_id
         where list_cosine_similarity(a.v, b.v) >= 0.9),
reach as (select vec_id as a, vec_id as b from e union select r.a, l.b from reach r join link l on r.b = l.a),
root as (select a, min(b) as component_id from reach group by a),
n as (select a, count(*) as n_links from link group by a)
select e.vec_id, coalesce(n.n_links, 0) as n_links, root.component_id, e.vec_id = root.component_id as kept
from e join root on e.vec_id = root.a left join n on e.vec_id = n.a
"""


# Level by level: a run of three nodes becomes one; siblings are the nodes of a leaf's run at each level.
_MANIFEST_SQL = r"""
with recursive part as (
  select doc_id, case when source is null then '' else '+' || source end as tree,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-') as head,
    text, replace(text, chr(10), '') as cut,
    xor(4294967295, list_reduce(list_concat([cast(4294967295 as bigint)], list_transform(string_split(cast(doc_id as varchar), ''), lambda ch: cast(ord(ch) as bigint))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], list_transform(range(8), lambda z: cast(z as bigint))),
        lambda x, i: xor(x >> 1, 3988292384 * (x & 1))))) % 2 = 0 as hit
  from documents),
leaves as (
  select row_number() over () as rid, *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos from (
    select doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
      case when hit then sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) end as other from part)),
up as (
  select tree, 0 as level, pos, count(*) over (partition by tree) as m, leaf as digest from leaves
  union all
  select tree, level + 1, pos // 3, (max(m) + 2) // 3, sha256(string_agg(digest, '' order by pos)) from up where m > 1 group by tree, level, pos // 3),
subroots as (select tree, digest, row_number() over (order by tree) - 1 as pos from up where m = 1),
tops as (
  select 0 as level, pos, count(*) over () as m, digest from subroots
  union all
  select level + 1, pos // 3, (max(m) + 2) // 3, sha256(string_agg(digest, '' order by pos)) from tops where m > 1 group by level, pos // 3),
low as (
  select l.rid, u.level, coalesce(string_agg(u.digest, '' order by u.pos) filter (where u.pos < l.pos // cast(pow(3, u.level) as bigint)), '') || '*'
    || coalesce(string_agg(u.digest, '' order by u.pos) filter (where u.pos > l.pos // cast(pow(3, u.level) as bigint)), '') as step
  from leaves l join up u on l.tree = u.tree and u.m > 1 and u.pos // 3 = l.pos // cast(pow(3, u.level + 1) as bigint) group by l.rid, u.level),
high as (
  select s.tree, t.level, coalesce(string_agg(t.digest, '' order by t.pos) filter (where t.pos < s.pos // cast(pow(3, t.level) as bigint)), '') || '*'
    || coalesce(string_agg(t.digest, '' order by t.pos) filter (where t.pos > s.pos // cast(pow(3, t.level) as bigint)), '') as step
  from subroots s join tops t on t.m > 1 and t.pos // 3 = s.pos // cast(pow(3, t.level + 1) as bigint) group by s.tree, t.level),
lows as (select rid, list(step order by level) as steps from low group by rid),
highs as (select tree, list(step order by level) as steps from high group by tree),
paths as (
  select l.doc_id, l.leaf, coalesce(l.other, l.leaf) as other, s.digest as subroot, (select digest from tops where m = 1) as root,
    list_concat(coalesce(a.steps, []), coalesce(b.steps, [])) as steps
  from leaves l join subroots s on l.tree = s.tree left join lows a on l.rid = a.rid left join highs b on l.tree = b.tree),
folded as (
  select *, list_reduce(list_concat([other], steps), lambda h, p: sha256(split_part(p, '*', 1) || h || split_part(p, '*', 2))) as folded_root from paths)
select doc_id, leaf, subroot, root, sha256(replace(array_to_string(steps, ''), '*', '')) as proof_sha256, folded_root, folded_root = root as verified
from folded
"""

_NEGATIVES_SQL = """
with v as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as q
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
s as (
  select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same, cast(list_inner_product(a.q, b.q) as bigint) as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 100 = 0),
p as (
  select * from (select *, row_number() over (partition by anchor_id order by score desc, other_id) as place from s where same) where place <= 5),
n as (
  select p.anchor_id, p.other_id as positive_id, s.other_id as negative_id, p.score as positive_score, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.other_id order by s.score desc, s.other_id) as place
  from p join s on p.anchor_id = s.anchor_id
  where not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score)
select anchor_id, positive_id, cast(place as integer) as rank, negative_id, positive_score, negative_score from n where place <= 10
"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(regexp_split_to_array({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"
# Windows as text, joined to the windows of the same length of every document.
_DECONTAMINATION_SQL = f"""
with d as (select row_number() over () as rid, doc_id, coalesce({_WORDS}, []) as words from documents),
b as (select item_id, words, least(10, len(words)) as need from (select item_id, {_WORDS} as words from benchmark) where len(words) > 0),
bw as (select distinct item_id, need, array_to_string(words[k + 1:k + need], ' ') as win
       from (select *, unnest(range(len(words) - need + 1)) as k from b)),
dw as (select rid, k, need, array_to_string(words[k + 1:k + need], ' ') as win
       from (select *, unnest(range(greatest(len(words) - need + 1, 0))) as k from d, (select distinct need from b))),
m as (select dw.rid, dw.k, dw.need, bw.item_id from dw join bw on dw.need = bw.need and dw.win = bw.win),
hit as (select rid, count(distinct place) as n_hit from (select rid, unnest(range(k, k + need)) as place from (select distinct rid, k, need from m)) group by rid),
items as (select rid, count(*) as n_items, string_agg(item, ',' order by item) as ids
          from (select distinct rid, cast(item_id as varchar) as item from m) group by rid)
select d.doc_id, cast(len(d.words) as bigint) as n_words, coalesce(h.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
  sha256(coalesce(i.ids, '')) as items_sha256, coalesce(h.n_hit, 0) > 0 as contaminated
from d left join hit h on d.rid = h.rid left join items i on d.rid = i.rid
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_embeddings": _EMBEDDINGS_SQL, "op11_manifest": _MANIFEST_SQL, "op12_hard_negatives": _NEGATIVES_SQL,
            "op13_decontamination": _DECONTAMINATION_SQL}
