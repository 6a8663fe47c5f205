"""Windowed scoring, tokens in context, records as their own text, committed runs."""

from __future__ import annotations

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmill.functions import json_text, offsets, text
from segmill.jobs import convert, queries, runs, tau
from segmill.jobs.config import SegmentConfig
from segmill.operators import segment, windows
from segmill.sources import jsonl
from tests.test_jobs import samples
from tests.test_segment import plain_inside, plain_split

# Windows.


def test_scores_do_not_depend_on_windows(spark):
    rows = samples(spark).where("gt_output <> ''")
    expected = {r.source_idx: r.t for r in rows.where("question <> ''").select("source_idx", text.tokens(F.col("gt_output")).alias("t")).collect()}
    before = {k: ["\n", *t[:-1]] for k, t in expected.items()}
    plain = {k: [(len(x) * 29 + len(b[-1:] if i == 0 else b) * 13 + ord(x[0]) % 31) % 101 / 128 for i, (x, b) in enumerate(zip(t, before[k], strict=True))] for k, t in expected.items()}
    for window, stride in ((64, 16), (64, None), (10, 9), (3, 1), (10_000, 7)):
        found = windows.score_answers(rows, queries.toy_scorer, window, stride)
        assert {r.source_idx: r.confidences for r in found.collect()} == plain, (window, stride)


def test_scorers_are_checked(spark):
    rows = windows.window_rows(samples(spark), 20, 5)
    few = lambda: lambda found: [[0.5] * (len(w.fresh) - (w.window_idx == 1)) for w in found]
    with pytest.raises(Exception, match="window 1 of source_idx .* has 5 fresh tokens and got 4 confidences"):
        windows.score_windows(rows, few).collect()
    with pytest.raises(Exception, match="results for"):
        windows.score_windows(rows, lambda: lambda found: []).collect()
    scored = windows.score_windows(rows, queries.toy_scorer)
    for bad in (scored.where("not (source_idx = 6 and window_idx = 1)"), scored.union(scored.where("source_idx = 6 and window_idx = 1"))):
        with pytest.raises(Exception, match="windows of source_idx 6 are missing or repeated"):
            windows.stitch(bad).collect()
    for window, stride in ((4, 5), (4, 0), (4, -1)):
        with pytest.raises(ValueError):
            windows.window_rows(samples(spark), window, stride)
        with pytest.raises(ValueError):
            SegmentConfig(window=window, stride=stride)


def test_a_long_answer_spreads(spark):
    """A million tokens become a thousand rows of a window each, over all partitions."""
    rows = spark.createDataFrame([(1, "", "q", "ab " * 1_000_000)], "source_idx long, system_prompt string, question string, gt_output string")
    found = windows.window_rows(rows, 4096, 1024, prefix=F.lit("p"))
    sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert found.where(F.size("tokens") > 4096).isEmpty()
    whole = windows.stitch(windows.score_windows(found, lambda: lambda ws: [[0.5] * len(w.fresh) for w in ws])).first()
    n = rows.select(F.size(text.tokens(F.col("gt_output")))).first()[0]
    assert len(whole.confidences) == n > 900_000


def test_scored_run_equals_its_steps(spark):
    rows, config = samples(spark), SegmentConfig(min_step_tokens=4, window=32, stride=8, limit_rows=30, max_length=200, long_policy="skip")
    found = convert.scored_run(rows, config, queries.toy_scorer, 12, 42, (0.1, 0.3), "q_0.3000").collect()
    drawn = [r[0] for r in tau.sample_rows(rows.where("source_idx < 30"), 12, 42).collect()]
    short = rows.where((F.size(text.tokens(F.col("gt_output"))) <= 200) & (F.col("source_idx") < 30))
    scores = windows.score_answers(short, queries.toy_scorer, 5000)
    values = [c for r in scores.where(F.col("source_idx").isin(drawn)).collect() for c in r.confidences]
    chosen = sorted(values)[round((len(values) - 1) * 0.3)]
    expected = convert.convert(rows, config.with_(tau=chosen), scores).collect()
    assert sorted(found) == sorted(expected) and len(found) > 10 and any(len(r.thoughts_list) > 2 for r in found)
    given = convert.scored_run(rows, config.with_(tau=chosen), queries.toy_scorer).collect()
    assert sorted(given) == sorted(expected)


# Tokens in context.


def test_clamped_spans(spark):
    spans = [("a", 0, 2), ("b", 1, 3), ("", 3, 3), ("c", 3, 3), ("d", 2, 5), ("e", 5, 5), ("f", 6, 9), ("f", 6, 9)]
    rows = spark.createDataFrame([(spans, 3)], f"s {offsets.SPANS}, edge int")
    got = [tuple(t) for t in rows.select(offsets.clamped(F.col("s"), F.col("edge"))).first()[0]]
    assert got == [(t, max(0, a - 3), b - 3) for t, a, b in spans if b > 3]


def loose_tokens(rng, body):
    """Tokens in order of their ends, with gaps, overlaps and empty ones."""
    ends = sorted(rng.choices(range(1, len(body) + 1), k=rng.randint(1, 30)))
    starts = [max(0, e - rng.choice([0, 1, 1, 2, 3, 5])) for e in ends]
    return [(body[a:b], a, b) for a, b in zip(starts, ends, strict=True)]


def test_cutting_uses_the_offsets(spark):
    rng = random.Random(7)
    rows = []
    for i in range(120):
        body = "".join(rng.choices("ab1_- .,中文é<think>", k=rng.randint(1, 60)))
        if i % 4 == 0:
            body = body[:10] + "<think>" + body[10:]
        rows.append((i, body, loose_tokens(rng, body)))
    df = spark.createDataFrame(rows, f"source_idx long, gt_output string, spans {offsets.SPANS}")
    config = SegmentConfig(mode="fixed", fixed_segment_tokens=3, min_step_tokens=2, min_step_chars=2, special_tokens=("a", "1"))
    got = {r.source_idx: r for r in segment.segment(df, config, token_spans=F.col("spans")).collect()}
    for i, body, tokens in rows:
        hits = [(k, k + 7) for k in range(len(body)) if body.startswith("<think>", k)]
        free = [
            k for k, (t, a, b) in enumerate(tokens[:-1])
            if b > a and t not in ("a", "1") and not any(b > x and a < y for x, y in hits) and not plain_inside(body, b)
        ]
        picked, last = [], -1
        while more := [k for k in free if k >= last + 3]:
            last = more[0]
            picked.append(last)
        assert got[i].boundaries == picked
        assert got[i].segments == plain_split(body, [b for _, _, b in tokens], picked, 2)
    for bad in ([("a", 0, 99)], [("a", 2, 1)], [("a", 0, 3), ("b", 0, 2)], [("a", -1, 2)]):
        with pytest.raises(Exception, match="token spans of source_idx 0"):
            segment.segment(spark.createDataFrame([(0, "abcd", bad)], df.schema), config, token_spans=F.col("spans")).collect()


def test_a_library_tokenizer_in_context(spark, tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    words = {w: k for k, w in enumerate(["?", "a", "bc", "é", "q", "[", "]", "user", "assistant"])}
    library = Tokenizer(models.WordLevel(words, unk_token="?"))
    library.pre_tokenizer = pre_tokenizers.Whitespace()  # drops white space: gaps between the spans
    library.save(str(tmp_path / "words.json"))
    rows = spark.createDataFrame([(0, "", "q", "bc  é a\nbc zz."), (1, "", "q", "😀 bc a"), (2, "", "", "a")], "source_idx long, system_prompt string, question string, gt_output string")
    own = offsets.InContext(offsets.library_tokenizer(str(tmp_path / "words.json")))
    got = {r.source_idx: [(t.start, t.end) for t in r.s] for r in rows.select("source_idx", own.spans().alias("s")).collect()}
    assert got[0] == [(0, 2), (4, 5), (6, 7), (8, 10), (11, 13), (13, 14)] and got[1] == [(0, 1), (2, 4), (5, 6)]
    config = SegmentConfig(mode="fixed", fixed_segment_tokens=2, min_step_tokens=1, min_step_chars=1)
    found = {r.source_idx: r.boundaries for r in convert.convert(rows, config, tokenizer=own).collect()}
    assert found == {0: [1, 3], 1: [1]}
    scores = windows.score_answers(rows, lambda: lambda ws: [[0.5] * len(w.fresh) for w in ws], 4, 2, own)
    assert {r.source_idx: len(r.confidences) for r in scores.collect()} == {0: 6, 1: 3}


# Records as their own text.

_JSON = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False) | st.text(max_size=6), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=4), x, max_size=3), max_leaves=8)


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.sampled_from(["a", "thoughts_list", "source_idx", "}", '"', "é", "x\n"]), _JSON, max_size=6), st.booleans(), st.sampled_from([None, 0, 2]))
def test_set_fields_changes_nothing_else(record, ascii_only, indent):
    line = json.dumps(record, ensure_ascii=ascii_only, indent=indent)
    got = json_text.set_fields(line, {"thoughts_list": '["new"]', "source_idx": "7"}, frozenset(["source_idx"]))
    expected = record | {"thoughts_list": ["new"], "source_idx": 7 if record.get("source_idx") is None else record["source_idx"]}
    assert json.loads(got) == expected and list(json.loads(got)) == [*record, *(k for k in ("thoughts_list", "source_idx") if k not in record)]
    for key, start, end in json_text.top_level(line):
        assert json.loads(line[start:end]) == record[key]
        if key not in ("thoughts_list", "source_idx"):
            assert line[:end].rpartition(",")[2] in got


def test_set_fields_by_hand():
    new = {"t": "[1]"}
    for given, expected in (
        ('{"a":1.50,"t": [ "}" ] ,"b": 1e3}', '{"a":1.50,"t": [1] ,"b": 1e3}'), ("{}", '{"t": [1]}'), (' { "a" : null } ', ' { "a" : null, "t": [1] } '),
        ('{"t":1,"t":{"t":2}}', '{"t":[1],"t":[1]}'), (r'{"t": 0}', r'{"t": [1]}'), ('{"a\\"t": "t"}', '{"a\\"t": "t", "t": [1]}'),
    ):
        assert json_text.set_fields(given, new) == expected
    for bad in ("[1]", "1", '"x"', "{} {}", "", '{"a": 1', '{"a"}', '{"a", "b"}'):
        with pytest.raises(ValueError):
            json_text.set_fields(bad, new)


def test_records_come_back_byte_for_byte(spark, tmp_path):
    lines = [
        '{"gt_output": "one two three four. \\u00e9 five six seven eight nine ten", "question": "q", "x": [1.50, {"b":2,"a":1}], "thoughts_list": ["old"], "z":1e-7}',
        '{"zz":"\\u2028","question":"q","gt_output":"😀 words and more words to be cut here","source_idx":1}',
        '{"question":"","gt_output":"left out"}',
        '{"question":"q","gt_output":"short","source_idx":null}',
    ]
    (tmp_path / "in.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    config = SegmentConfig(mode="fixed", fixed_segment_tokens=4, min_step_tokens=1, min_step_chars=3)
    converted = convert.convert(jsonl.read_jsonl(spark, str(tmp_path / "in.jsonl"), jsonl.REFERENCE), config)
    jsonl.write_records(converted, str(tmp_path / "out"))
    found = {json.loads(x)["source_idx"]: x for p in (tmp_path / "out").glob("part-*") for x in p.read_text(encoding="utf-8").split("\n") if x}
    assert sorted(found) == [0, 1, 3]
    thoughts = {k: json.dumps(json.loads(x)["thoughts_list"], ensure_ascii=False, separators=(",", ":")) for k, x in found.items()}
    assert found[0] == lines[0].replace('["old"]', thoughts[0])[:-1] + ', "source_idx": 0}' and len(json.loads(thoughts[0])) > 2
    assert found[1] == lines[1][:-1] + f', "thoughts_list": {thoughts[1]}}}'
    assert found[3] == lines[3].replace("null", "3")[:-1] + f', "thoughts_list": {thoughts[3]}}}'


# Committed runs.

CONFIG = SegmentConfig(mode="fixed", fixed_segment_tokens=16, min_step_tokens=4, max_length=150, long_policy="skip")


def seen(spark, target):
    return sorted(r.source_idx for r in runs.run_rows(spark, target).collect())


def test_a_lost_run_is_done_again(spark, tmp_path, monkeypatch):
    rows, target = samples(spark), str(tmp_path / "t")
    assert runs.convert_run(rows.where("source_idx < 10"), CONFIG, target, 3).agg(F.sum("rows_seen")).first()[0] == 10
    with monkeypatch.context() as m:
        m.setattr(runs, "commit_run", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):  # its rows are written, its manifest is not
            runs.convert_run(rows.where("source_idx < 25"), CONFIG, target, 3, keep=F.lit(False))
    assert seen(spark, target) == list(range(10))
    runs.convert_run(rows, CONFIG, target, 3)
    assert seen(spark, target) == list(range(40)) and runs.convert_run(rows, CONFIG, target, 3) is None
    got = {r.source_idx: (r.thoughts_list, r.extra, r["rank"]) for r in runs.read_output(spark, target).collect()}
    assert got == {r.source_idx: (r.thoughts_list, r.extra, r.source_idx % 3) for r in convert.convert(rows, CONFIG).collect()}
    audit = runs.audit_runs(spark, target).collect()
    assert len(audit) == 6 and all(r.consistent for r in audit) and sum(r.output_rows for r in audit) == len(got)


def test_dropped_rows_and_lost_files_show(spark, tmp_path):
    rows, target = samples(spark), str(tmp_path / "t")
    kept = runs.convert_run(rows, CONFIG, target, 2, keep=F.size("thoughts_list") > 2).collect()
    assert all(r.rows_scored == r.rows_written + r.rows_dropped and r.rows_dropped > 0 and r.rows_seen > r.rows_scored for r in kept)
    flags = {r["rank"]: r for r in convert.run_counters(jsonl.with_rank(convert.flagged(rows, CONFIG), 2), "rank").collect()}
    assert all((r.token_count, r.window_count, r.num_overlong, r.rows_skipped + r.num_overlong) == (f.token_count, f.window_count, f.num_overlong, f.rows_skipped) for r in kept for f in [flags[r["rank"]]])
    for bad, message in ((dict(world_size=3), "world_size"), (dict(config=CONFIG.with_(min_step_chars=9)), "min_step_chars")):
        with pytest.raises(ValueError, match=message):
            runs.convert_run(rows, **({"config": CONFIG, "target": target, "world_size": 2} | bad))
    next((tmp_path / "t/rows/run=0/rank=1/status=written").glob("*.parquet")).unlink()
    assert sorted((r["rank"], r.consistent) for r in runs.audit_runs(spark, target).collect()) == [(0, True), (1, False)]
    with pytest.raises(ValueError, match=r"output and manifest differ for \(run, rank\) \[\(0, 1\)\]"):
        runs.convert_run(rows, CONFIG, target, 2)


def test_counts_that_differ_are_not_committed(spark, tmp_path):
    target = str(tmp_path / "t")
    observed = runs.write_run(runs.converted_rows(samples(spark), CONFIG, 2), target, 0)
    with pytest.raises(ValueError, match="rows_written"):
        runs.commit_run(spark, target, 0, observed | {"rows_written": observed["rows_written"] + 1}, 2, CONFIG)
    assert runs.manifest(spark, target).isEmpty()
    with pytest.raises(ValueError, match="columns that a run writes itself"):
        runs.converted_rows(samples(spark).withColumn("status", F.lit(1)), CONFIG, 2)


def test_threshold_run_checks_scores_of_converted_rows_only(spark, tmp_path):
    rows = samples(spark)
    config = SegmentConfig(tau=0.3, min_step_tokens=4, max_length=150, long_policy="skip")
    scores = windows.score_answers(rows, queries.toy_scorer, 64, 16)
    short = scores.where(F.size("confidences") <= 150)
    runs.convert_run(rows, config, str(tmp_path / "t"), 2, short)
    got = {r.source_idx: r.thoughts_list for r in runs.read_output(spark, str(tmp_path / "t")).collect()}
    assert got == {r.source_idx: r.thoughts_list for r in convert.convert(rows, config, scores).collect()} and got
    with pytest.raises(Exception, match="no confidences for source_idx"):
        runs.convert_run(rows, config, str(tmp_path / "u"), 2, short.where("source_idx <> 6"))
    assert runs.manifest(spark, str(tmp_path / "u")).isEmpty()
