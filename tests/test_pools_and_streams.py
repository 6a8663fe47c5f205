"""Quantiles by brackets, Python's own sample, many protected strings, merge of sorted shards, scored streams."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmill.functions import protected
from segmill.functions.text import tokens
from segmill.jobs import tau
from segmill.jobs.config import SegmentConfig
from segmill.jobs.convert import convert
from segmill.operators import rank, segment
from segmill.sources import jsonl
from segmill.streaming import scored_stream
from tests.test_jobs import samples


def test_brackets_give_the_exact_quantiles(spark):
    rng = random.Random(3)
    pools = {
        "ties": [rng.randint(0, 6) / 6 for _ in range(900)], "few": [0.5], "two": [0.1, 0.2], "wide": [rng.random() ** 9 for _ in range(3000)],
        "odd": [float("nan")] * 40 + [float("inf"), -1.0] + [rng.random() for _ in range(60)], "nan": [float("nan")] * 3, "none": [],
    }
    quantiles = (0.0, 0.01, 0.333, 0.5, 0.5, 0.99, 1.0)
    for name, values in pools.items():
        rows = spark.createDataFrame([(v,) for v in [*values, None]], "v double").repartition(3)
        for accuracy in (10_000, 20):
            got = {r.tau_key: (r.quantile, r.tau) for r in rank.bracket_quantiles(rows, "v", quantiles, accuracy).collect()}
            order = sorted(values, key=lambda v: (v != v, v))
            expected = {f"q_{q:.4f}": (q, order[round((len(order) - 1) * q)] if order else None) for q in quantiles}
            assert repr(got) == repr({k: expected[k] for k in got}) and got.keys() == expected.keys(), (name, accuracy)
    with pytest.raises(ValueError):
        rank.bracket_quantiles(rows, "v", [2.0])


def test_brackets_rank_few_values(spark, monkeypatch):
    """Of 200,000 values only what the brackets hold, and a row a gap, is sorted."""
    rows = spark.range(200_000).select((F.xxhash64("id") % 1_000_000_007 / 1e9).alias("v"))
    ranked = []
    monkeypatch.setattr(rank, "_ranged", lambda df, order, real=rank._ranged: ranked.append(df.count()) or real(df, order))
    got = [r.tau for r in rank.bracket_quantiles(rows, "v", [0.01, 0.5]).orderBy("quantile").collect()]
    values = np.sort(rows.toPandas()["v"].to_numpy())
    assert got == [values[round(199_999 * q)] for q in (0.01, 0.5)] and len(ranked) == 1 and ranked[0] < 1000


def test_a_sketch_that_errs_costs_time_only(spark, monkeypatch):
    rows = spark.range(1000).select((F.col("id") / 7).alias("v"))
    monkeypatch.setattr(F, "percentile_approx", lambda *_: F.array(F.lit(1.0), F.lit(2.0)))
    assert rank.bracket_quantiles(rows, "v", [0.5]).first().tau == round(999 * 0.5) / 7


def test_position_sample_is_pythons(spark, monkeypatch):
    rows = spark.range(500).withColumnRenamed("id", "source_idx").repartition(7)
    for most in (rank.BROADCAST_POSITIONS, 3):
        monkeypatch.setattr(rank, "BROADCAST_POSITIONS", most)
        for size, seed in ((1, 0), (40, 42), (500, 1)):
            assert sorted(r[0] for r in tau.sample_rows(rows, size, seed, positions=True).collect()) == sorted(random.Random(seed).sample(range(500), size))
    assert tau.sample_rows(rows, 900, positions=True).count() == 500
    with pytest.raises(ValueError):
        tau.sample_rows(rows, 900, strict=True, positions=True)
    with pytest.raises(ValueError):
        rank.position_sample(rows, "source_idx", 501, 1)


@settings(max_examples=200, deadline=None)
@given(st.text("aab<é😀", max_size=60), st.lists(st.text("aab<é😀", min_size=1, max_size=4), min_size=1, max_size=12), st.integers(0, 3))
def test_one_automaton_finds_what_single_searches_find(text, strings, few):
    expected = []
    for token in set(strings):
        at = text.find(token)
        while at >= 0:
            expected.append((at, at + len(token), token))
            at = text.find(token, at + len(token))
    before, protected.FEW = protected.FEW, few
    try:
        assert protected.occurrences(text, tuple(strings)) == sorted(expected)
    finally:
        protected.FEW = before


def test_cost_does_not_grow_with_the_list(spark):
    text = "some words of a text <think> and more " * 20_000
    times = []
    for n in (100, 3000):
        strings = (*protected.PROTECTED, *(f"<|{k}|>" for k in range(n)))
        protected.occurrences("", strings)  # the automaton is built once a worker
        began = time.process_time()
        assert len(protected.occurrences(text, strings)) == 20_000
        times.append(time.process_time() - began)
    assert times[1] < 4 * times[0] + 0.2
    row = spark.createDataFrame([("a<|7|>b<|7|><|8|>",), (None,), ("",)], "t string").select(protected.protected_spans(F.col("t"), strings).alias("s"))
    assert [r.s and [tuple(s) for s in r.s] for r in row.collect()] == [[(1, 6, "<|7|>"), (7, 12, "<|7|>"), (12, 17, "<|8|>")], None, []]
    config = SegmentConfig(mode="fixed", fixed_segment_tokens=1, min_step_tokens=1, min_step_chars=1, protected_strings=("two thr",))
    body = "one two three four"
    cut = segment.segment(spark.createDataFrame([(0, body)], "source_idx long, gt_output string"), config, token_lengths=F.array(*[F.lit(n) for n in (4, 4, 6, 4)])).first()
    assert cut.boundaries == [0] and cut.segments == ["one ", "two three four"]
    with pytest.raises(ValueError):
        SegmentConfig(protected_strings=("a", ""))


def test_sorted_shards_merge_without_a_shuffle(spark, tmp_path):
    rng, every = random.Random(2), []
    for k, n in enumerate((400, 0, 3, 900)):
        rows = sorted((rng.choice([5, 5, rng.randint(0, 3000)]), f"{k}-{i}") for i in range(n))
        every += [(i, k, v) for i, v in rows]
        spark.createDataFrame(rows, "source_idx long, v string").coalesce(1).sortWithinPartitions("source_idx").write.option("parquet.block.size", 4096).parquet(str(tmp_path / f"s{k}"))
    paths = [str(tmp_path / f"s{k}") for k in range(4)]
    for ranges in (1, 2, 7):
        merged = jsonl.merge_sorted_shards(spark, paths, "v", ranges=ranges)
        assert [(r.source_idx, r["shard"], r.v) for r in merged.collect()] == sorted(every)
        assert "Exchange" not in merged._jdf.queryExecution().executedPlan().toString() and merged.rdd.getNumPartitions() <= ranges
    assert jsonl.merge_sorted_shards(spark, paths[1:2]).count() == 0
    with pytest.raises(ValueError):
        jsonl.merge_sorted_shards(spark, [])


def test_index_without_a_broadcast_of_splits(spark, tmp_path, monkeypatch):
    (tmp_path / "a.jsonl").write_text("".join(f'{{"gt_output": "{i}"}}\n' for i in range(50)), encoding="utf-8")
    monkeypatch.setattr(jsonl, "BROADCAST_SPLITS", 0)
    assert sorted((r.source_idx, r.gt_output) for r in jsonl.read_jsonl(spark, str(tmp_path), jsonl.REFERENCE).collect()) == [(i, str(i)) for i in range(50)]


def test_scores_that_come_late_or_never_or_twice(spark, tmp_path):
    rows = samples(spark, 12).withColumn("gt_output", F.concat("gt_output", F.lit(" some words at the end")))
    sized = rows.select("source_idx", F.transform(tokens(F.col("gt_output")), lambda _, i: (i % 9) / F.lit(10.0)).alias("confidences"))
    config = SegmentConfig(tau=0.25, min_step_tokens=4)
    minute = lambda k: F.timestamp_seconds(F.lit(1_700_000_000).cast("long") + 60 * F.lit(k))
    left, right, out = (str(tmp_path / n) for n in ("samples", "scores", "out"))
    put = lambda df, path, k: df.withColumn("at", minute(k)).write.mode("append").parquet(path)

    def run():
        read = lambda path: spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
        query = scored_stream.write_stream(scored_stream.convert_streams(read(left), read(right), config, "20 minutes", "5 minutes"), out, str(tmp_path / "check"))
        query.awaitTermination()
        found = {r.source_idx: (r.status, r.thoughts_list) for r in spark.read.parquet(out).collect()}
        return found, sum(o.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for o in p["stateOperators"])

    put(rows.where("source_idx < 8"), left, 0)
    put(sized.where("source_idx in (1, 2, 11)"), right, 1)  # 11 comes before its sample
    put(sized.where("source_idx = 2").withColumn("confidences", F.array(F.lit(0.9))), right, 2)  # again: the first counts
    put(sized.where("source_idx = 3").withColumn("confidences", F.array(F.lit(0.9))), right, 2)
    found, _ = run()
    right_ones = {r.source_idx: r.thoughts_list for r in convert(rows, config, sized).collect()}
    assert found == {1: ("written", right_ones[1]), 2: ("written", right_ones[2]), 3: ("wrong", None)}
    put(rows.where("source_idx >= 8"), left, 15)
    put(sized.where("source_idx = 4"), right, 19)
    found, _ = run()
    assert found.keys() == {1, 2, 3, 4, 11} and found[4] == ("written", right_ones[4]) and found[11] == ("written", right_ones[11])
    put(rows.where("source_idx = 9").withColumn("source_idx", F.lit(99).cast("long")), left, 500)  # later rows move the watermark on
    put(sized.where("source_idx = 9").withColumn("source_idx", F.lit(98).cast("long")), right, 500)
    found, _ = run()
    assert {k: s for k, (s, _) in found.items() if k in (0, 5, 6, 7, 8, 9, 10)} == {0: "skipped", 5: "skipped", 10: "skipped", 6: "unscored", 7: "unscored", 8: "unscored", 9: "unscored"}
    put(sized.where("source_idx = 6"), right, 3)
    again, dropped = run()
    assert again == found and dropped >= 1 and 99 not in again
    with pytest.raises(ValueError):
        scored_stream.convert_streams(rows, sized, SegmentConfig(mode="fixed"))
