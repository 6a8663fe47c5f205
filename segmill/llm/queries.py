"""The queries of this subpackage, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.llm.best_fit import best_fit_packing
from segmill.llm.common import read_table, stage, work_dir
from segmill.llm.exact_dedup import exact_dedup
from segmill.llm.filter_audit import FILTERS, filter_audit
from segmill.llm.jaccard_join import jaccard_components
from segmill.llm.langid import language_id
from segmill.llm.license_scan import license_scan
from segmill.llm.packing import pack_documents
from segmill.llm.site_style_tree import extract_main_text
from segmill.llm.string_tiling import tile_documents
from segmill.llm.suffix_dedup import suffix_dedup
from segmill.llm.token_alignment import align_tokenizers
from segmill.llm.token_binary import token_binary
from segmill.llm.window_dedup import window_dedup


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(spark, read_table(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, read_table(spark, sf_dir, "documents"), located=True)


def exact_dedup_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as two runs on one store: the second meets those of the first. run numbers the runs."""
    docs, store = read_table(spark, sf_dir, "documents"), work_dir(spark)
    first = stage(exact_dedup(spark, docs.where("doc_id % 2 = 0"), store=store))
    second = exact_dedup(spark, docs.where("doc_id % 2 <> 0"), store=store)
    return first.withColumn("run", F.lit(0)).unionByName(second.withColumn("run", F.lit(1)))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(spark, read_table(spark, sf_dir, "documents"))


def op4_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(spark, read_table(spark, sf_dir, "pages"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, read_table(spark, sf_dir, "documents"))


def op6_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tile_documents(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_binary(spark, read_table(spark, sf_dir, "documents"))


def op8_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup(spark, read_table(spark, sf_dir, "documents"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, read_table(spark, sf_dir, "documents")).drop("key")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(spark, read_table(spark, sf_dir, "documents"))
    spans = F.transform("spans", lambda s: F.concat_ws(":", s["label"], s["first_word"], s["last_word"], s["edits"]))
    return found.withColumn("spans", F.array_join(spans, ","))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(spark, read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(spark, read_table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(spark, read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup, op2_exact_dedup, op3_language_id, op4_site_style_tree, op5_packing, op6_string_tiling, op7_token_binary, op8_window_dedup, op9_jaccard_join, op10_license_scan,
        op11_filter_audit, op12_best_fit, op13_token_alignment, exact_dedup_two_runs,
    )
}

_FAILS = """f as (
    select *, len(w) < 50 as fa, 100 * len(list_distinct(w)) < 65 * len(w) as fb, 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) as fc,
        regexp_matches(t, '[#$%&*|]') as fd, doc_id > min(doc_id) over (partition by t) as fe
    from (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents))"""
_LETTERS = f"(select unnest({list(FILTERS)}) as x)"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op11_filter_audit": f"""
        with {_FAILS},
        d as (select part, (if(fa, 'A', '') || if(fb, 'B', '') || if(fc, 'C', '') || if(fd, 'D', '') || if(fe, 'E', '')) as failed,
                     coalesce(l.quality = 1, false) as good, coalesce(l.toxic = 1, false) as toxic
              from f left join (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id) l using (doc_id)),
        c as (select part, failed, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from d group by part, failed),
        orders as (select a.x || b.x || c.x || d.x || e.x as filter_order from {", ".join(f"{_LETTERS} {k}" for k in "abcde")}
                   where a.x not in (b.x, c.x, d.x, e.x) and b.x not in (c.x, d.x, e.x) and c.x not in (d.x, e.x) and d.x <> e.x),
        steps as (select filter_order, cast(step as integer) as step, substr(filter_order, step, 1) as own, substr(filter_order, 1, step - 1) as before from orders, (select unnest(range(1, 6)) as step)),
        marked as (select part, filter_order, step, own, n, good, toxic, contains(failed, own) as fails, failed = own as alone,
                          before <> '' and failed <> '' and regexp_matches(failed, '[' || before || ' ]') as gone from c, steps),
        rows as (select part, filter_order, step, own,
                        cast(coalesce(sum(n) filter (not gone and not fails), 0) as bigint) as kept, cast(coalesce(sum(n) filter (fails and not gone), 0) as bigint) as removed,
                        cast(coalesce(sum(n) filter (fails and gone), 0) as bigint) as redundant, cast(coalesce(sum(n) filter (alone), 0) as bigint) as unique_fails,
                        cast(coalesce(sum(good) filter (fails and not gone), 0) as bigint) as good_lost, cast(coalesce(sum(toxic) filter (fails and not gone), 0) as bigint) as toxic_lost
                 from marked group by all)
        select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, cast(sum(removed) over (partition by part, own) as bigint) as shapley from rows""",
    "op2_exact_dedup": f"""
        with d as (select doc_id, {_LOWER} as t from documents),
             g as (select t, max(doc_id) as keep_id, count(*) as group_size from d group by t)
        select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.t) as text_sha256
        from d join g using (t)""",
    "exact_dedup_two_runs": f"""
        with d as (select doc_id, cast(abs(doc_id % 2) as integer) as run, {_LOWER} as t from documents),
             g as (select r.run, d.t, max(d.doc_id) as keep_id, count(*) as group_size from d, (select unnest([0, 1]) as run) r where d.run <= r.run group by r.run, d.t)
        select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.t) as text_sha256, d.run
        from d join g on g.t = d.t and g.run = d.run""",
}
