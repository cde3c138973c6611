"""One query for each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import (
    exact_dedup,
    fill_middle,
    license_scan,
    mixing,
    near_dedup,
    packing,
    periodic_runs,
    quality_ledger,
    secret_scan,
    substring_dedup,
    token_counts,
    token_files,
    warc_files,
)
from tradeloom.llm.common import importable, new_folder

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    """The vocabulary file; TRADELOOM_TOKENIZERS names another folder."""
    folder = os.environ.get("TRADELOOM_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secret_scan.scan_secrets(_documents(spark, folder))

    def number(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    both = F.array_sort(F.concat("base", "added"))
    return found.select("doc_id", *[number(k) for k in ("assign", "access", "hex")],
                        F.sha2(secret_scan.span_text(F.col("base")), 256).alias("base_sha256"),
                        secret_scan.span_text(both).alias("spans"))


def op2_token_files(spark: SparkSession, folder: str) -> DataFrame:
    target = new_folder(spark, "token-files")
    token_files.write_token_files(_documents(spark, folder), target, tokenizer_file())
    return token_files.checksums(token_files.read_token_files(spark, target))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    planned = mixing.plan_mix(_documents(spark, folder))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    left = substring_dedup.remove_repeats(_documents(spark, folder).select("doc_id", "text"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op5_quality_ledger(spark: SparkSession, folder: str) -> DataFrame:
    ledger = quality_ledger.evaluate(_documents(spark, folder))
    return ledger.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~quality_ledger.passes("base")).alias("base_failed"), quality_ledger.passes().alias("kept"),
                         "failed")


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_dedup.ingest(_documents(spark, folder), exact_dedup.new_index(spark))
    return found.withColumnRenamed("digest", "text_sha256")


def op7_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_dedup.near_components(_documents(spark, folder), size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id",
                        F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_documents(spark, folder), tokenizer_file())


def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(_documents(spark, folder), tokenizer_file())


def op10_warc(spark: SparkSession, folder: str) -> DataFrame:
    importable(spark)
    target = new_folder(spark, "warc")
    warc_files.write_warc(spark.read.parquet(f"{folder}/pages.parquet"), target)
    return warc_files.read_warc(spark, target).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs.periodic_runs(_documents(spark, folder))
    return found.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                        "collapsed_sha256")


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle.fill_in_middle(_documents(spark, folder))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op13_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.summary(license_scan.scan_licenses(_documents(spark, folder)))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if top not in sys.path:
        sys.path.insert(0, top)
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_secret_scan, op2_token_files, op3_mixing, op4_substring_dedup, op5_quality_ledger, op6_exact_dedup,
        op7_near_dedup, op8_packing, op9_token_counts, op10_warc, op11_periodic_runs, op12_fill_in_middle,
        op13_license_scan, pipeline)}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL. Hash draws, entropy folds, tokenizers and files are tested against brute force instead."""
    return {
        "op4_substring_dedup": rf"""
with d as (select row_number() over () as r, doc_id, {_WORDS} as w from documents),
p as (select r, unnest(generate_series(1, len(w) - 34)) as i, w from d where len(w) >= 35),
k as (select r, i, list_slice(w, i, i + 34) as g from p),
h as (select r, i, count(*) over (partition by g) as n from k),
c as (select distinct r, i + j as x from h, (select unnest(generate_series(0, 34)) as j) where n > 1),
s as (select r, list(x) as xs from c group by r)
select d.doc_id, len(w)::bigint as n_words, coalesce(len(xs), 0)::bigint as n_removed,
  sha256(coalesce(array_to_string(case when xs is null then w else
    (select list(u.x order by u.i) from (select unnest(w) as x, generate_subscripts(w, 1) as i) u
     where not list_contains(xs, u.i)) end, ' '), '')) as kept_sha256
from d left join s using (r)""",
        "op5_quality_ledger": rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, {_WORDS} as w from documents),
l as (select r, unnest(string_split(t, chr(10))) as line from d),
ls as (select r, count(*) as n_lines, count(*) - count(distinct line) as dup from l
       where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
p as (select r, unnest(generate_series(1, len(w) - 7)) as i, w from d where len(w) >= 8),
h as (select r, i, count(*) over (partition by r, list_slice(w, i, i + 7)) as n from p),
c as (select r, count(distinct i + j) as n_rep from h, (select unnest(generate_series(0, 7)) as j) where n > 1 group by r),
u as (select r, unnest(w) as x from d),
v as (select r, sum(length(x)) as chars, count(*) filter (upper(x) = x and lower(x) <> x) as up from u group by r),
m as (select doc_id, len(w)::bigint as n_words, coalesce(chars, 0)::bigint as word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(dup, 0)::bigint as n_dup_lines,
  coalesce(n_rep, 0)::bigint as n_repeat_words, coalesce(n_lines, 0) as n_lines, coalesce(up, 0) as up
  from d left join ls using (r) left join c using (r) left join v using (r)),
b as (select *, case when n_words < 20 then 1 else 0 end + case when 100 * n_repeat_words > 30 * n_words then 2 else 0 end
  + case when 10 * n_symbols > n_words then 4 else 0 end
  + case when n_lines >= 4 and 100 * n_dup_lines > 30 * n_lines then 8 else 0 end
  + case when 2 * word_chars < 4 * n_words then 16 else 0 end
  + case when word_chars > 15 * n_words then 32 else 0 end
  + case when 100 * up > 60 * n_words then 64 else 0 end as failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 as base_failed,
  failed = 0 as kept, failed::bigint as failed from b""",
        "op12_fill_in_middle": r"""
with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(cast(doc_id as varchar), '')) as hx
  from documents),
h as (select doc_id, t, ('0x' || substr(hx, 1, 8))::ubigint as h1, ('0x' || substr(hx, 9, 8))::ubigint as h2,
  ('0x' || substr(hx, 17, 8))::ubigint as h3, ('0x' || substr(hx, 25, 8))::ubigint as h4,
  length(t) - length(replace(t, chr(10), '')) as nl, string_split(t, chr(10)) as parts from d),
c as (select *, nl + case when t <> '' and right(t, 1) <> chr(10) then 1 else 0 end as n,
  t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 100 as plain from h),
k as (select *, least(h1 % (n + 1), h2 % (n + 1)) as k1, greatest(h1 % (n + 1), h2 % (n + 1)) as k2 from c),
b as (select *,
  case when k1 = 0 then 0 else least(length(array_to_string(list_slice(parts, 1, k1), chr(10))) + 1, length(t)) end as b1,
  case when k2 = 0 then 0 else least(length(array_to_string(list_slice(parts, 1, k2), chr(10))) + 1, length(t)) end as b2
  from k),
o as (select *, substr(t, 1, b1) as p, substr(t, b1 + 1, b2 - b1) as m, substr(t, b2 + 1) as s from b)
select doc_id, n::bigint as n, case when plain then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form,
  (case when plain then null else b1 end)::bigint as prefix_chars,
  (case when plain then null else b2 - b1 end)::bigint as middle_chars,
  sha256(case when plain then t when h4 % 100 < 50 then '<S>' || s || '<P>' || p || '<M>' || m
    else '<P>' || p || '<S>' || s || '<M>' || m end) as output_sha256,
  sha256(t) as restored_sha256
from o""",
        "op6_exact_dedup": """
select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
  doc_id is not distinct from max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
from documents window g as (partition by coalesce(text, ''))""",
        "op7_near_dedup": rf"""
with recursive d as (select row_number() over () as r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
s as (select r, doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
  else list_distinct([array_to_string(list_slice(w, i, i + 2), ' ') for i in generate_series(1, len(w) - 2)]) end as g
  from d),
n as (select r, doc_id, g, len(g) as n from s),
e as (select r, n, unnest(g) as x from n),
f as (select a.r as a, b.r as b, a.n as na, b.n as nb, count(*) as shared from e a join e b using (x)
  where a.r < b.r and 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) group by all),
k as (select a, b from f where 100 * shared >= 85 * (na + nb - shared)),
z as (select a, b from k union all select b, a from k),
reach as (select r as a, r as b from n union select reach.a, z.b from reach join z on reach.b = z.a),
m as (select reach.a as r, min(n.doc_id) as component_id from reach join n on reach.b = n.r group by 1)
select n.doc_id, n.n::bigint as n_shingles, m.component_id, n.doc_id is not distinct from m.component_id as kept
from n join m using (r)""",
    }
