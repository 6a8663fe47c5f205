"""Samples and their scores as two streams, joined by row while both arrive.

A sample waits in the state for its scores until the watermark is `wait` past its time; scores that come
for it within that time, before or after it, are its own. Then it is converted. A sample whose scores
never came leaves with the status `unscored` once the watermark has passed, so no row is lost. Of
repeated scores of a row the first counts. Scores with another number of confidences than the answer
has tokens leave as `wrong`: one bad row does not stop a stream. Rows that come later than the watermark
allows are dropped by Spark and counted in the query's progress (numRowsDroppedByWatermark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from segmill.functions.offsets import InContext
from segmill.functions.text import Tokenizer, tokens
from segmill.jobs.config import SegmentConfig
from segmill.jobs.convert import LENGTHS, PLACES, flagged, segmented

WRITTEN, SKIPPED, OVERLONG, UNSCORED, WRONG = "written", "skipped", "overlong", "unscored", "wrong"


def join_streams(samples: DataFrame, scores: DataFrame, wait: str, late: str) -> DataFrame:
    """samples with confidences (null if none came): both sides have source_idx and a timestamp `at`."""
    once = scores.select("source_idx", F.col("at").alias("scored_at"), "confidences").withWatermark("scored_at", late).dropDuplicatesWithinWatermark(["source_idx"])
    once = once.withColumnRenamed("source_idx", "scored_idx")
    near = F.col("scored_at").between(F.col("at") - F.expr(f"interval {wait}"), F.col("at") + F.expr(f"interval {wait}"))
    return samples.withWatermark("at", late).join(once, (F.col("source_idx") == F.col("scored_idx")) & near, "left_outer").drop("scored_idx")


def convert_streams(samples: DataFrame, scores: DataFrame, config: SegmentConfig, wait: str = "1 hour", late: str = "10 minutes", tokenizer: Tokenizer | InContext = tokens) -> DataFrame:
    """One row per sample: its columns, status and, where it was converted, thoughts_list.

    Rows without a question or an answer, and those that the policy on long answers drops, are given as
    such; they wait like all others.
    """
    if config.mode != "threshold" or config.tau is None:
        raise ValueError("scored streams need threshold mode and a tau")
    kept = [c for c in samples.columns if c != "thoughts_list"]
    rows = flagged(join_streams(samples.select(*kept), scores, wait, late), config, tokenizer)
    fits = F.size("confidences") == F.col("n_tokens")
    status = F.when(~F.col("usable"), SKIPPED).when(F.col("dropped"), OVERLONG).when(F.col("confidences").isNull(), UNSCORED).when(~fits, WRONG).otherwise(WRITTEN)
    rows = rows.withColumn("status", status).withColumn("answer", F.col("gt_output")).withColumn("gt_output", F.when(F.col("status") == WRITTEN, F.col("gt_output")))
    found = segmented(rows, config).withColumn("thoughts_list", F.when(F.col("status") == WRITTEN, F.col("segments")))
    return found.withColumn("gt_output", F.col("answer")).drop(LENGTHS, PLACES).select(*kept, "status", "thoughts_list")


def write_stream(converted: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Start a run over what is there and not yet read; it ends by itself, and the state waits for the next one."""
    return converted.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
