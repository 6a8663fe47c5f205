"""How the staged parts of texts are dealt out, however much one task reads."""

from __future__ import annotations

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from segmill.llm import jaccard_join, parts, suffix_dedup, window_dedup
from segmill.llm.common import configure
from segmill.sources.staging import read_table


def test_a_large_task_fills_many_slots_and_row_groups(spark):
    configure(spark)
    long = F.repeat(F.sha2(F.col("id").cast("string"), 256), 4000)  # 256 kB each, in one partition
    rows = spark.range(0, 256, 1, 1).select(F.col("id").alias("doc_id"), long.alias("text"))
    size = parts.text_size(rows)
    staged = parts.stage_parts(parts.keyed(rows), size)
    by_slot = staged.select("slot", "part", F.explode("texts").alias("text")).groupBy("slot").agg(F.sum(F.length("text")).alias("n")).collect()
    assert sum(r.n for r in by_slot) == size
    assert max(r.n for r in by_slot) <= 2 * parts.SLOT_TEXT
    files = [f for path in staged.inputFiles() for f in glob.glob(path.removeprefix("file://"))]
    groups = [m.row_group(i).num_rows for m in (pq.ParquetFile(f).metadata for f in files) for i in range(m.num_row_groups)]
    assert files and max(groups) <= parts.ROW_GROUP_TEXT // parts.PART_TEXT


@pytest.mark.parametrize("tasks", [1, 3, 7, 16, 40, 100, 300])
def test_slots_of_any_number_of_tasks_are_filled_evenly(tasks):
    slots, each = 300, -(-300 // tasks)
    held = [parts.slot_number(task, k, slots) for task in range(tasks) for k in range(each)]
    assert max(held.count(s) for s in set(held)) <= 4


@pytest.mark.parametrize(("module", "query"), [
    (suffix_dedup, lambda spark, docs: suffix_dedup.suffix_dedup(spark, docs, part_text=1 << 14)),
    (window_dedup, lambda spark, docs: window_dedup.window_dedup(spark, docs, part_text=1 << 14)),
    (jaccard_join, lambda spark, docs: jaccard_join.jaccard_components(spark, docs, part_text=1 << 14)),
    (jaccard_join, lambda spark, docs: corpus_pipeline.near(spark, docs, "")),
], ids=["op1", "op8", "op9", "pipeline"])
def test_an_operator_whose_input_is_one_task_gets_many_slots(spark, sf, monkeypatch, module, query):
    docs = read_table(spark, sf, "documents").coalesce(1)
    plain = sorted(query(spark, docs).collect(), key=str)
    seen = []

    def small(texts, size, most):
        seen.append(parts.stage_parts(texts, size, min(most, 1 << 14), 1 << 15))
        return seen[-1]

    monkeypatch.setattr(module, "stage_parts", small)
    assert sorted(query(spark, docs).collect(), key=str) == plain
    slots = parts.bucket_number(parts.text_size(docs), 1 << 15)
    assert slots > 8 and seen[0].select("slot").distinct().count() > slots / 3
