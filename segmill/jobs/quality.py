"""Checks on segments: fragments, protected strings, cuts inside words. Array columns, row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.functions.protected import count_protected
from segmill.functions.text import inside_word, is_valid_segment


def segment_rows(converted: DataFrame, key: str = "source_idx") -> DataFrame:
    return converted.select(key, F.posexplode("thoughts_list").alias("k", "segment")).withColumn("k", F.col("k").cast("long"))


def segment_quality(converted: DataFrame, key: str = "source_idx") -> DataFrame:
    """Per sample: segments, characters, invalid ones, cuts inside words, protected strings kept whole and lost.

    Samples without a segment have no row.
    """
    sized = lambda flags: F.size(F.filter(flags, lambda x: x)).cast("long")
    total = lambda numbers: F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x)
    following = lambda i: F.get("thoughts_list", i + 1)
    rows = converted.where(F.size("thoughts_list") > 0).select(
        key,
        F.size("thoughts_list").cast("long").alias("n_segments"),
        total(F.transform("thoughts_list", lambda x: F.length(x))).alias("n_chars"),
        sized(F.transform("thoughts_list", lambda x: ~is_valid_segment(x))).alias("n_invalid"),
        sized(F.transform("thoughts_list", lambda x, i: F.coalesce(inside_word(x, following(i)), F.lit(False)))).alias("n_in_word"),
        total(F.transform("thoughts_list", lambda x: count_protected(x))).alias("n_protected"),
        count_protected(F.col("gt_output")).alias("_there"),
    )
    return rows.withColumn("n_protected_lost", F.col("_there") - F.col("n_protected")).drop("_there")


def quality_summary(quality: DataFrame) -> DataFrame:
    counted = {"n_segments": "segments", "n_invalid": "invalid", "n_in_word": "in_word", "n_protected_lost": "protected_lost"}
    return quality.agg(F.count(F.lit(1)).alias("samples"), *[F.sum(c).alias(name) for c, name in counted.items()])
