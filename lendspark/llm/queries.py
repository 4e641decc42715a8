"""One query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import (decontamination, exact_dedup, language_id, mixing, near_dedup, packing, periodic_runs, quality_model, quality_rules,
               secrets, substring_dedup, toxicity, whitening)
from .common import documents


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "pages"), documents(spark, sf_dir))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(documents(spark, sf_dir))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_substrings(documents(spark, sf_dir)).drop("spans")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan_secrets(documents(spark, sf_dir)))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.digest(periodic_runs.periodic_runs(periodic_runs.repeat_tails(documents(spark, sf_dir))))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_near_dedup, op2_toxicity, op3_quality_model, op4_language_id, op5_quality_rules, op6_mixing, op7_packing,
    op8_substring_dedup, op9_exact_dedup, op10_secrets, op11_periodic_runs, op12_decontamination, op13_whitening)}

ORACLE = {
    "op12_decontamination": r"""
with d as (
  select row_number() over () as key, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from documents),
b as (
  select cast(item_id as varchar) as item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from benchmark),
w as (
  select distinct item_id, least(len(words), 10) as size, array_to_string(words[i:i + 9], ' ') as piece
  from (select *, unnest(range(1, greatest(len(words) - 8, 2))) as i from b where len(words) > 0)),
p as (
  select key, i, size, array_to_string(words[i:i + size - 1], ' ') as piece
  from (select key, words, size, unnest(range(1, len(words) - size + 2)) as i
        from d, (select distinct size from w) where len(words) >= size)),
m as (select key, i, p.size, item_id from p join w on p.size = w.size and p.piece = w.piece),
h as (select key, count(distinct place) as hit from (select key, unnest(range(i, i + size)) as place from m) group by key),
t as (select key, list_sort(list(distinct item_id)) as items from m where item_id is not null group by key)
select doc_id, cast(len(words) as bigint) as n_words, coalesce(hit, 0) as n_hit, cast(coalesce(len(items), 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(hit, 0) > 0 as contaminated
from d left join h using (key) left join t using (key)
""",
    "op9_exact_dedup": r"""
with t as (
  select doc_id, length(coalesce(text, '')) as n_points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as content
  from documents),
g as (
  select *, first_value(doc_id) over (partition by content order by n_points desc, doc_id nulls last) as keep_id,
         count(*) over (partition by content) as group_size
  from t)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, sha256(content) as text_sha256 from g
""",
    "op6_mixing": r"""
with recursive t as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
         cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 15) as bigint) as hash
  from documents),
s as (
  select source, cast(sum(size) as bigint) as source_size,
         cast(1 + (row_number() over (order by source nulls last) - 1) % 3 as double) as w
  from t group by source),
r as (
  select *, 3.0::double * source_size as limit_,
         (sum(source_size) over () - coalesce(sum(3.0::double * source_size) over before, 0))
         / (sum(w) over () - coalesce(sum(w) over before, 0)) as level
  from s window before as (order by 3.0::double * source_size / w, source nulls last
                           rows between unbounded preceding and 1 preceding)),
g as (
  select source, source_size, least(limit_, w * max(case when level <= limit_ / w then level end) over ()) as target from r),
p as (
  select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as epochs from g),
h as (
  select source, hash, sum(size) as sum,
         coalesce(sum(sum(size)) over (partition by source order by hash rows between unbounded preceding and 1 preceding), 0) as below
  from t group by source, hash),
c as (
  select h.source, h.hash,
         case when below + sum <= target - epochs * source_size then 1
              when below > target - epochs * source_size then 0
              when target - epochs * source_size - below > below + sum - (target - epochs * source_size) then 1 else 0 end as more
  from h join p on h.source is not distinct from p.source)
select t.doc_id, t.size, p.source_size, p.target, cast(t.size * (p.epochs + c.more) as bigint) as taken
from t join p on t.source is not distinct from p.source
join c on t.source is not distinct from c.source and t.hash = c.hash
""",
}
