"""Joins by row position: alignment of two data sets, scores, incremental runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align(inputs: DataFrame, reference: DataFrame, strict: bool = True) -> DataFrame:
    """Each input row's reference row by source_idx; a missing one raises if strict, else stays null.

    Further reference rows are ignored. Only source_idx of the inputs is read: their content plays
    no part. A reference's own index, `reference_idx`, can be checked with mismatches(). Every column
    carries the check, so whatever is read or filtered later cannot remove a missing row unseen.
    """
    joined = inputs.select("source_idx").join(reference.withColumn("_there", F.lit(True)), "source_idx", "left")
    if strict:
        message = F.concat(F.lit("no reference row for source_idx "), F.col("source_idx").cast("string"))
        there = F.col("_there").isNotNull()
        joined = joined.select("_there", *[F.when(there, F.col(f.name)).otherwise(F.raise_error(message).cast(f.dataType)).alias(f.name) for f in joined.schema if f.name != "_there"])
    return joined.drop("_there")


def mismatches(aligned: DataFrame, own: str = "reference_idx") -> DataFrame:
    """Rows whose reference states another index than their position (null states none)."""
    return aligned.where(F.col(own).isNotNull() & (F.col(own) != F.col("source_idx")))


def require_aligned(aligned: DataFrame, own: str = "reference_idx") -> DataFrame:
    """aligned, raising when a row of mismatches() is met."""
    message = F.concat(F.lit("reference states another row than source_idx "), F.col("source_idx").cast("string"))
    fits = F.col(own).isNull() | (F.col(own) == F.col("source_idx"))
    return aligned.withColumn("source_idx", F.when(fits, F.col("source_idx")).otherwise(F.raise_error(message).cast("long")))


def not_done(rows: DataFrame, manifest: DataFrame) -> DataFrame:
    """Rows that no earlier run has handled, in whatever order it did."""
    return rows.join(manifest.select("source_idx"), "source_idx", "left_anti")


def attach_scores(samples: DataFrame, scores: DataFrame, strict: bool = True) -> DataFrame:
    """samples (with n_tokens) and their confidences; a sample without them, or with another number, raises if strict, else goes."""
    return checked_scores(samples.join(scores, "source_idx", "left" if strict else "inner"), strict)


def checked_scores(joined: DataFrame, strict: bool = True, only: Column | None = None) -> DataFrame:
    """Rows with n_tokens and confidences, under the same rule; it holds for all rows, or `only` for some."""
    right = F.coalesce(F.size("confidences") == F.col("n_tokens"), F.lit(False))
    if only is not None:
        right = right | ~only
    if not strict:
        return joined.where(right)
    what = F.when(F.col("confidences").isNull(), "no confidences").otherwise("wrong number of confidences")
    message = F.concat(what, F.lit(" for source_idx "), F.col("source_idx").cast("string"))
    return joined.withColumn("confidences", F.when(right, F.col("confidences")).otherwise(F.raise_error(message).cast("array<double>")))
