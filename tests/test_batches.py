"""What Python workers get at once, and how often a text is cut."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from segmill.functions.offsets import InContext
from segmill.jobs import convert, quality, queries
from segmill.jobs.config import SegmentConfig
from segmill.operators import windows
from segmill.sources import jsonl
from segmill.sources.staging import BATCH_BYTES, BATCH_ROWS

SETTINGS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")


@pytest.fixture
def unset(spark):
    """A session as a user opens it: no bound of theirs on batches."""
    for name in SETTINGS:
        spark.conf.unset(name)
    return spark


def guarded(texts):
    """The column itself, raising in a batch of too many rows or bytes."""
    most_rows, most_bytes = BATCH_ROWS, BATCH_BYTES

    def run(column):
        if len(column) > most_rows or column.nbytes > 2 * most_bytes:
            raise ValueError(f"a batch of {len(column)} rows, {column.nbytes} bytes")
        return column

    return F.arrow_udf(run, "string")(texts)


def whole(text):
    """One token: the text."""
    return F.array(F.struct(text.alias("token"), F.lit(0).alias("start"), F.length(text).alias("end")))


def answers(spark, n, size):
    return spark.range(0, n, 1, 1).select(F.col("id").alias("source_idx"), F.lit("q").alias("question"), F.repeat(F.lit("word "), size).alias("gt_output"))


@pytest.mark.parametrize(("n", "size"), [(BATCH_ROWS + 500, 2), (300, 20_000)])
def test_cutting_in_context_gets_small_batches(unset, n, size):
    tokenizer = InContext(lambda text: whole(guarded(text)), lambda: (F.lit(""), F.col("gt_output")))
    found = convert.convert(answers(unset, n, size), SegmentConfig(mode="fixed"), tokenizer=tokenizer)
    assert found.where(F.size("thoughts_list") == 1).count() == n


def cuts(found) -> int:
    """Calls of the segmenter in the plan of a result."""
    return found._jdf.queryExecution().optimizedPlan().toString().count("ArrowEvalPython [run(")


def test_conversion_in_context_cuts_once(spark, sf):
    assert cuts(queries.convert_in_context(spark, sf)) == 1


def test_the_quality_report_cuts_once(spark, sf):
    assert cuts(queries.segment_quality(spark, sf)) == 1


def test_the_quality_report_of_long_texts_gets_small_batches(unset):
    rows = answers(unset, 300, 20_000)
    found = quality.segment_quality(convert.convert(rows.withColumn("gt_output", guarded(F.col("gt_output"))), SegmentConfig(mode="fixed")))
    assert found.where("n_chars = 100000 and n_in_word = 0").count() == 300


@pytest.mark.parametrize(("n", "size"), [(BATCH_ROWS + 500, 2), (300, 20_000)])
def test_record_lines_are_set_in_small_batches(unset, n, size):
    rows = answers(unset, n, size).select("source_idx", F.array("gt_output").alias("thoughts_list"), F.to_json(F.struct("question")).alias("raw"))
    found = jsonl.record_lines(rows.withColumn("thoughts_list", F.array(guarded(F.col("thoughts_list")[0]))).withColumn("raw", guarded(F.col("raw"))))
    assert found.where(F.length("value") > 5 * size).count() == n


def test_random_conversion_cuts_once(spark, sf):
    assert cuts(queries.convert_random(spark, sf)) == 1


def counting_scorer():
    return lambda found: [[float(len(found))] * len(w.fresh) for w in found]


def test_a_scorer_gets_small_batches(unset):
    rows = answers(unset, BATCH_ROWS + 500, 2).withColumn("system_prompt", F.lit(""))
    scored = windows.score_windows(windows.window_rows(rows, 64, 16, tasks=1), counting_scorer)
    assert scored.agg(F.count(F.lit(1)), F.max(F.col("confidences")[0])).first()[:] == (BATCH_ROWS + 500, BATCH_ROWS)


def test_confidence_rows_read_texts_in_small_batches(unset):
    rows = answers(unset, 300, 20_000).withColumn("gt_output", guarded(F.col("gt_output")))
    scores = unset.range(0, 300, 1, 1).select(F.col("id").alias("source_idx"), F.array_repeat(F.lit(0.5), 1).alias("confidences"))
    found = windows.confidence_rows(rows, scores, tokenizer=InContext(whole, lambda: (F.lit(""), F.col("gt_output"))))
    assert found.where("token is not null").count() == 300
