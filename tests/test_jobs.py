"""Native columns on hand-worked cases, sources, tau, conversion and audits."""

from __future__ import annotations

import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.functions import chat, protected, scores, text
from segmill.jobs import convert, quality, queries, tau
from segmill.jobs.config import SegmentConfig
from segmill.operators import align, rank, segment
from segmill.sources import jsonl, staging
from segmill.streaming.drop_folder import convert_folder


def one(spark, **values):
    return spark.createDataFrame([tuple(values.values())], T.StructType([T.StructField(k, T.StringType()) for k in values]))


def value(df):
    return df.first()[0]


def test_roles_first_message_wins_even_if_empty(spark):
    schema = T.StructType().add("system", T.StringType()).add("m", T.ArrayType(jsonl.MESSAGE))
    rows = spark.createDataFrame([(None, [("user", None), ("user", "q"), ("assistant", "a")]), ("s", []), (None, None)], schema)
    out = [tuple(r) for r in rows.select(*[c.alias(n) for n, c in chat.roles_of_messages(F.col("system"), F.col("m")).items()]).collect()]
    assert out == [("", "", "a"), ("s", "", ""), ("", "", "")]
    turns = spark.createDataFrame([(1, 0, "user", None), (1, 1, "user", "q"), (1, 2, "assistant", "a")], "conv_id long, turn long, role string, text string")
    assert tuple(chat.roles_of_turns(turns).first()) == (1, "", "", "a")


def test_paragraphs(spark):
    for given, expected in (("a\n\n\n\n b \n\nc", ["a", "b", "c"]), ("a\n\n\nb", ["a", "b"]), ("", []), (None, [])):
        assert value(one(spark, t=given).select(text.split_paragraphs(F.col("t")))) == expected


def test_protected_spans(spark):
    spans = value(one(spark, t="a<think>b<|im_end|><think>").select(protected.protected_spans(F.col("t"))))
    assert [tuple(s) for s in spans] == [(1, 8, "<think>"), (9, 19, "<|im_end|>"), (19, 26, "<think>")]
    with pytest.raises(ValueError):
        protected.protected_spans(F.col("t"), ["x", ""])


def test_native_word_and_segment_tests_agree_with_python(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choices("ab1_- .,中文é+=", k=rng.randint(0, 14))) for _ in range(400)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r.t: r.v for r in rows.select("t", text.is_valid_segment(F.col("t")).alias("v")).collect()}
    assert all(got[t] == segment.is_valid(t) for t in texts)
    cuts = rows.select("t", F.explode(F.sequence(F.lit(0), F.length("t"))).alias("c"))
    left, right = F.substring(F.col("t"), F.lit(1), F.col("c")), F.substring(F.col("t"), F.col("c") + 1, F.lit(99))
    for r in cuts.select("t", "c", text.inside_word(left, right).alias("v")).collect():
        assert r.v == bool(segment.inside_word_flags(r.t)[r.c]), r
    numbered = rows.select(F.monotonically_increasing_id().alias("k"), "t")
    every = numbered.join(text.inside_word_ends(numbered, "k", "t"), "k").collect()
    assert len(every) > 1000 and all(r.inside == bool(segment.inside_word_flags(r.t)[r.end]) for r in every)


def test_strip_and_blank_use_python_white_space(spark):
    for given in (" \n a\t", "　 x\x1f", "　", "", "a b"):
        row = one(spark, t=given).select(text.strip(F.col("t")).alias("s"), text.is_blank(F.col("t")).alias("b")).first()
        assert row.s == given.strip() and row.b == (not given.strip())


def test_windows(spark):
    def windows(n, w, s):
        found = value(spark.range(1).select(scores.scoring_windows(F.lit(n).cast("long"), w, s)))
        assert len(found) == value(spark.range(1).select(scores.window_count(F.lit(n), w, s)))
        fresh = [i for x in found for i in range(x.start + x.fresh_start, x.end)]
        assert fresh == list(range(n))
        return [(x.start, x.end, x.fresh_start) for x in found]

    assert windows(10, 4, 2) == [(0, 4, 0), (2, 6, 2), (4, 8, 2), (6, 10, 2)]
    assert windows(5, 4, 2) == [(0, 4, 0), (2, 5, 2)]
    assert windows(5, 4, 4) == [(0, 4, 0), (4, 5, 0)]
    assert windows(4, 4, 1) == [(0, 4, 0)]
    assert windows(0, 4, 2) == []


def test_logprobs(spark):
    rows = spark.createDataFrame([([None, -200.0, 0.0], 5)], "l array<double>, n long")
    low = value(spark.range(1).select(F.exp(F.lit(-100.0))))
    assert value(rows.select(scores.logprob_confidence(F.col("l"), F.col("n")))) == [low, low, 1.0, low, low]


def test_quantile_rule(spark):
    def at(values, q):
        return value(rank.exact_quantiles(spark.createDataFrame([(v,) for v in values], "v double"), "v", [q]).select("tau"))

    assert at([0.1, 0.2, 0.3, 0.4], 0.5) == 0.3
    assert at([0.1, 0.2], 0.5) == 0.1
    assert at([1.0, 2.0, 3.0, 4.0, 5.0, 6.0], 0.5) == 3.0
    rng = random.Random(1)
    values = [rng.randint(0, 40) / 40 for _ in range(500)]
    for q in (0.0, 0.01, 0.333, 1.0):
        assert at(values, q) == sorted(values)[round((len(values) - 1) * q)]
    with pytest.raises(ValueError):
        rank.exact_quantiles(spark.range(1).select(F.lit(1.0).alias("v")), "v", [1.5])


def test_tau_of_nothing(spark):
    none = spark.createDataFrame([(0.5, False)], "confidence double, cuttable boolean")
    assert [r.tau for r in tau.estimate_tau(none, [0.1, 0.2]).collect()] == [None, None]
    with pytest.raises(ValueError):
        tau.estimate_tau(none, [0.1], strict=True)
    with pytest.raises(ValueError):
        tau.pick_tau(tau.estimate_tau(none, [0.1]), "q_0.1000")


def test_sample(spark):
    rows = spark.range(100).withColumnRenamed("id", "source_idx")
    first = sorted(r[0] for r in tau.sample_rows(rows, 10, 7).collect())
    assert len(first) == 10 and first == sorted(r[0] for r in tau.sample_rows(rows.repartition(7), 10, 7).collect())
    assert tau.sample_rows(rows, 500).count() == 100
    with pytest.raises(ValueError):
        tau.sample_rows(rows, 500, strict=True)


def test_jsonl_round_trip(spark, tmp_path):
    lines = ['{"system": null, "conversations": [{"from": "user", "value": "a\\u2028b"}]}', "", "　 ", '{"system": "s", "conversations": null, "more": 1.50}']
    (tmp_path / "in.jsonl").write_text("\n".join(lines), encoding="utf-8")
    rows = jsonl.read_jsonl(spark, str(tmp_path / "in.jsonl"), jsonl.SAMPLE).orderBy("source_idx").collect()
    assert [r.source_idx for r in rows] == [0, 1] and json.loads(rows[1].raw)["more"] == 1.5
    assert jsonl.read_jsonl(spark, str(tmp_path / "in.jsonl"), jsonl.SAMPLE, limit_rows=0).count() == 0
    (tmp_path / "bad.jsonl").write_text("{", encoding="utf-8")
    with pytest.raises(Exception, match="MALFORMED|no reference row|wrong number"):
        jsonl.read_jsonl(spark, str(tmp_path / "bad.jsonl"), jsonl.SAMPLE).collect()
    jsonl.write_jsonl(spark.createDataFrame([(1, None)], "source_idx long, t string"), str(tmp_path / "out"))
    assert '"t":null' in "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))


def test_jsonl_index_over_splits_and_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for k, n in ((0, 700), (1, 3), (2, 900)):
        lines = [f'{{"gt_output": "{k}-{i}"}}' + "\n" * (1 + i % 3 // 2) for i in range(n)]
        (tmp_path / f"part-{k}.jsonl").write_text("".join(lines), encoding="utf-8")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
        rows = jsonl.read_jsonl(spark, str(tmp_path), jsonl.REFERENCE).select("source_idx", "gt_output").collect()
        some = jsonl.read_jsonl(spark, str(tmp_path), jsonl.REFERENCE, limit_rows=705).count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = [f"{k}-{i}" for k, n in ((0, 700), (1, 3), (2, 900)) for i in range(n)]
    assert [t for _, t in sorted((r.source_idx, r.gt_output) for r in rows)] == expected and some == 705
    assert sorted(r.source_idx for r in rows) == list(range(len(expected)))


def test_merge_is_stable(spark):
    a = spark.createDataFrame([(0, "a"), (2, "b")], "source_idx long, v string")
    b = spark.createDataFrame([(1, "c", 1), (2, "d", 1)], "source_idx long, v string, more int")
    assert [(r.source_idx, r.v) for r in jsonl.merge_shards([a, b]).collect()] == [(0, "a"), (1, "c"), (2, "b"), (2, "d")]


def test_alignment(spark):
    inputs = spark.range(3).withColumnRenamed("id", "source_idx")
    short = spark.createDataFrame([(0, 0), (1, 5)], "source_idx long, reference_idx long")
    assert [r.source_idx for r in align.mismatches(align.align(inputs, short, strict=False)).collect()] == [1]
    with pytest.raises(Exception, match="MALFORMED|no reference row|wrong number"):
        align.align(inputs, short).collect()
    scored = spark.createDataFrame([(0, [0.1])], "source_idx long, confidences array<double>")
    with pytest.raises(Exception, match="MALFORMED|no reference row|wrong number"):
        align.attach_scores(inputs.withColumn("n_tokens", F.lit(2)), scored).collect()
    one = inputs.where("source_idx < 2").withColumn("n_tokens", F.lit(1))
    with pytest.raises(Exception, match="no confidences for source_idx 1"):
        align.attach_scores(one, scored).collect()
    assert [r.source_idx for r in align.attach_scores(one, scored, strict=False).collect()] == [0]


def test_aligned_conversion_checks_the_reference(spark):
    config = SegmentConfig(mode="fixed", fixed_segment_tokens=16, min_step_tokens=4)
    inputs = spark.range(10).withColumnRenamed("id", "source_idx")
    stated = F.when(F.col("source_idx") % 2 == 0, F.col("source_idx"))
    good = samples(spark).withColumn("reference_idx", stated)
    assert convert.convert_aligned(inputs, good, config).count() == convert.convert(samples(spark, 10), config).count() > 0
    with pytest.raises(Exception, match="another row than source_idx 7"):
        convert.convert_aligned(inputs, good.withColumn("reference_idx", F.when(F.col("source_idx") == 7, 8)), config).collect()
    with pytest.raises(Exception, match="no reference row"):
        convert.convert_aligned(inputs, good.where("source_idx < 9"), config).collect()


def test_full_run_estimates_tau(spark):
    rows = samples(spark)
    listed = rows.select("source_idx", text.tokens(F.col("gt_output")).alias("t"))
    every = listed.select("source_idx", F.posexplode("t").alias("idx", "token")).withColumn("confidence", (F.xxhash64("source_idx", "idx") % 1000 + 1000) / 2000)
    scored = every.withColumn("cuttable", F.lit(True))
    arrays = every.groupBy("source_idx").agg(F.array_sort(F.collect_list(F.struct("idx", "confidence"))).alias("s")).select("source_idx", F.col("s.confidence").alias("confidences"))
    config = SegmentConfig(min_step_tokens=4)
    found = convert.full_run(rows.where("gt_output <> ''"), config, arrays, scored, (0.1, 0.2), "q_0.2000").collect()
    given = config.with_(tau=tau.pick_tau(tau.estimate_tau(scored, (0.1, 0.2)), "q_0.2000"))
    expected = convert.convert(rows.where("gt_output <> ''"), given, arrays).orderBy("source_idx").collect()
    assert found == expected and any(len(r.thoughts_list) > 2 for r in found)
    with pytest.raises(ValueError, match="tau"):
        convert.convert(rows, config, arrays)


def test_a_tokenizer_of_ones_own(spark):
    words = lambda c: F.regexp_extract_all(c, F.lit(r"\s*\S+|\s+"), 0)
    config = SegmentConfig(mode="fixed", fixed_segment_tokens=5, min_step_tokens=2, min_step_chars=1)
    found = convert.convert(samples(spark), config, tokenizer=words).collect()
    assert any(r.boundaries == list(range(4, 5 * len(r.boundaries), 5)) and len(r.boundaries) > 5 for r in found)
    with pytest.raises(Exception, match="do not add up"):
        convert.convert(samples(spark), config, tokenizer=lambda c: F.split(c, " ")).collect()


def test_rank_report(spark):
    rows = spark.createDataFrame([(0, "ab", "c"), (1, None, "d"), (2, "", "ee")], "source_idx long, a string, b string")
    assert sorted(tuple(r) for r in jsonl.rank_report(jsonl.with_rank(rows, 2), "a", "b").collect()) == [(0, 2, 5), (1, 1, 1)]


def test_positions_take_one_shuffle(spark):
    rows = spark.range(0, 999, 1, 7).select((F.col("id") * 37 % 100).alias("v"))
    placed = rank.with_position(rows, "v")
    got = [(r.source_idx, r.v) for r in placed.orderBy("source_idx").collect()]
    assert [p for p, _ in got] == list(range(999)) and [v for _, v in got] == sorted(v for _, v in got)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number" not in plan and plan.count("hashpartitioning") == plan.count("hashpartitioning(_part")  # only one row a partition is shuffled


def test_config_checks():
    for bad in ({"mode": "x"}, {"mode": "fixed", "fixed_segment_tokens": 4}, {"mode": "random", "random_min_tokens": 9}, {"mode": "fixed", "window": 0}):
        with pytest.raises(ValueError):
            SegmentConfig(**bad)
    assert SegmentConfig.preset("short", mode="fixed").fixed_segment_tokens == 64


def samples(spark, n=40):
    rng = random.Random(2)
    rows = [(i, "", "q" if i % 5 else "", " ".join("".join(rng.choices("abcde", k=rng.randint(1, 9))) for _ in range(rng.randint(0, 90))), i * 10) for i in range(n)]
    return spark.createDataFrame(rows, "source_idx long, system_prompt string, question string, gt_output string, extra long")


def test_convert_keeps_columns_and_does_not_depend_on_partitions(spark):
    config = SegmentConfig(mode="random", random_min_tokens=8, random_max_tokens=20, min_step_tokens=4)
    first = {r.source_idx: r for r in convert.convert(samples(spark), config).collect()}
    again = {r.source_idx: r for r in convert.convert(samples(spark).repartition(9), config).collect()}
    assert first == again and all(r.extra == 10 * k for k, r in first.items()) and 0 not in first
    plan = convert.convert(samples(spark), config.with_(mode="fixed", fixed_segment_tokens=16))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_counters_and_audit(spark):
    config = SegmentConfig(mode="fixed", max_length=60, long_policy="skip")
    flags = jsonl.with_rank(convert.flagged(samples(spark), config), 2)
    counters = convert.run_counters(flags).first()
    assert counters.rows_seen == 40 == counters.rows_written + counters.rows_skipped
    by_rank = convert.run_counters(flags, "rank")
    good = convert.output_audit(by_rank, flags.where("usable and not dropped"))
    convert.require_consistent(good)
    written = flags.where("usable and not dropped")
    lost = written.first().source_idx
    with pytest.raises(ValueError):
        convert.require_consistent(convert.output_audit(by_rank, written.where(F.col("source_idx") != lost)))
    partials = spark.createDataFrame([(1, "a", None), (2, "a", None)], "x long, y string, z long")
    with pytest.raises(ValueError, match="x"):
        convert.require_equal_config(partials, ["x", "y", "z"])


def test_merge_partials(spark):
    columns = ", ".join(f"{c} long" for c in convert.SUMS) + ", memory_mb double, seconds double"
    partials = spark.createDataFrame([(1, 0, 3, 1, 0, 0, None, 2.0), (2, 0, 4, 1, 0, 0, 5.0, 2.0)], columns)
    row = convert.merge_partials(partials, spark.createDataFrame([(1,), (2,), (2,), (3,)], "source_idx long")).first()
    assert (row.rows_seen, row.sample_count, row.memory_mb, row.seconds_per_row) == (3, 3, 5.0, 0.0)


def test_quality(spark):
    found = quality.segment_quality(convert.convert(samples(spark), SegmentConfig(mode="fixed", fixed_segment_tokens=16, min_step_tokens=4)))
    summary = quality.quality_summary(found).first()
    assert summary.in_word == 0 and summary.segments > summary.samples and summary.protected_lost == 0
    rows = [(0, "a<think>bcd</think>", ["a<think>bcd", "</think>"]), (1, "a<think>bcd", ["a<thi", "nk>bcd"]), (2, "x", [])]
    rows = spark.createDataFrame(rows, "source_idx long, gt_output string, thoughts_list array<string>")
    assert [(r.source_idx, r.n_protected, r.n_protected_lost) for r in quality.segment_quality(rows).orderBy("source_idx").collect()] == [(0, 2, 0), (1, 0, 1)]
    assert "Exchange" not in quality.segment_quality(rows)._jdf.queryExecution().executedPlan().toString()


def test_stream_of_files(spark, tmp_path):
    rows = samples(spark)
    config = SegmentConfig(mode="fixed", fixed_segment_tokens=16, min_step_tokens=4)
    rows.repartition(3).write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        convert_folder(spark, str(tmp_path / "in"), rows.schema, str(tmp_path / "out"), str(tmp_path / "check"), config).awaitTermination()
    got = {r.source_idx: r.thoughts_list for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {r.source_idx: r.thoughts_list for r in convert.convert(rows, config).collect()}


def test_stream_of_scored_rows_is_checked(spark, tmp_path):
    size = F.size(text.tokens(F.col("gt_output")))
    rows = samples(spark).where("gt_output <> ''").withColumn("confidences", F.transform(text.tokens(F.col("gt_output")), lambda _, i: (i % 9) / F.lit(10.0)))
    config = SegmentConfig(tau=0.25, min_step_tokens=4, limit_rows=30)
    rows.write.parquet(str(tmp_path / "in"))
    convert_folder(spark, str(tmp_path / "in"), rows.schema, str(tmp_path / "out"), str(tmp_path / "check"), config).awaitTermination()
    got = {r.source_idx: r.thoughts_list for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    expected = convert.convert(rows.drop("confidences"), config, rows.select("source_idx", "confidences")).collect()
    assert got == {r.source_idx: r.thoughts_list for r in expected} and max(got) < 30
    wrong = rows.withColumn("confidences", F.when(size > 20, F.array(F.lit(0.1))).otherwise(F.col("confidences")))
    wrong.write.parquet(str(tmp_path / "wrong"))
    with pytest.raises(Exception, match="wrong number"):
        convert_folder(spark, str(tmp_path / "wrong"), rows.schema, str(tmp_path / "out2"), str(tmp_path / "check2"), config).awaitTermination()


def test_long_runs_of_connectors_are_inside_words(spark, tmp_path):
    body = "word" + "-" * 80 + "word " + "_-" * 40 + " a" + "-_" * 50 + "中文" + "_" * 70 + "\n" + "-" * 90 + "b --c"
    rows = [(1, 0, "user", "Question?"), (1, 1, "assistant", body)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    flags = segment.inside_word_flags(queries.usable(spark, str(tmp_path)).first().gt_output)
    got = queries.inside_word_cuts(spark, str(tmp_path)).collect()
    assert len(got) > 300 and all(r.inside == bool(flags[r.end]) for r in got)
    ends = {r.idx: r.end for r in got}
    assert not any(flags[ends[r.boundary]] for r in queries.boundaries_fixed(spark, str(tmp_path)).collect())
    pieces = spark.createDataFrame([(0, "", ["word" + "-" * 40, "-" * 40 + "word", "next"])], "source_idx long, gt_output string, thoughts_list array<string>")
    assert quality.segment_quality(pieces).first().n_in_word == 2


def test_scratch_leaves_nothing_behind(spark):
    base = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    outside = staging.stage(spark.range(3))
    before, tables = set(base.iterdir()), {t.name for t in spark.catalog.listTables()}
    with staging.scratch(spark):
        rows = staging.stage_bucketed(staging.stage(spark.range(50)), "id", 2)
        assert rows.join(outside, "id").count() == 3 and set(base.iterdir()) > before
    assert set(base.iterdir()) == before and {t.name for t in spark.catalog.listTables()} == tables and outside.count() == 3


def test_settings_come_back_when_the_last_job_ends(spark):
    name = "spark.sql.test.setting"
    with staging.settings(spark, {name: "a"}):
        other = staging.settings(spark, {name: "a"})
        other.__enter__()
    assert spark.conf.get(name) == "a"
    other.__exit__(None, None, None)
    assert spark.conf.get(name, None) is None
