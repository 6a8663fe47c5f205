"""Conversion of samples to training records, its counters and its audits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.functions.chat import is_usable
from segmill.functions.offsets import SPANS, InContext
from segmill.functions.scores import window_count
from segmill.functions.text import Tokenizer, lengths, tokens
from segmill.jobs.config import SegmentConfig
from segmill.jobs.tau import QUANTILES, SAMPLE_SIZE, SEED, TAU_KEY, estimate_tau, pick_tau, sample_rows
from segmill.operators.align import align, attach_scores, checked_scores, require_aligned
from segmill.operators.segment import segment
from segmill.operators.windows import Scorer, confidence_rows, score_answers
from segmill.sources.staging import stage


#: The column of flagged() that tells where tokens stand, by kind of tokenizer.
LENGTHS, PLACES = "token_lengths", "token_spans"


def flagged(samples: DataFrame, config: SegmentConfig, tokenizer: Tokenizer | InContext = tokens) -> DataFrame:
    """samples with usable, token_lengths, n_tokens, overlong, dropped (by policy), n_windows: per row, without a shuffle.

    A tokenizer in context gives token_spans instead of token_lengths.
    """
    name, found, kind = (PLACES, tokenizer.spans(), SPANS) if isinstance(tokenizer, InContext) else (LENGTHS, lengths(tokenizer(F.col("gt_output"))), "array<int>")
    places = F.when(is_usable(), found).otherwise(F.array().cast(kind))
    rows = samples.withColumn("usable", is_usable()).withColumn(name, places).withColumn("n_tokens", F.size(name).cast("long"))
    rows = rows.withColumn("overlong", F.col("n_tokens") > config.max_length)
    dropped = F.col("overlong") & F.lit(config.long_policy == "skip")
    return rows.withColumn("dropped", dropped).withColumn("n_windows", window_count(F.col("n_tokens"), config.window, config.stride))


def convert(samples: DataFrame, config: SegmentConfig, scores: DataFrame | None = None, tokenizer: Tokenizer | InContext = tokens) -> DataFrame:
    """Usable samples with thoughts_list replaced by their segments; all other columns pass through.

    samples has source_idx, question and gt_output. Threshold mode joins scores(source_idx,
    confidences) by source_idx and raises for a sample without a confidence per token; the other
    modes run without any shuffle. A tokenizer of the user's own, native or a pandas UDF, gives the
    array of an answer's tokens, which joined must be the answer; one in context (functions/offsets)
    gives tokens with offsets of their own.
    """
    if config.mode == "threshold" and scores is None:
        raise ValueError("threshold mode needs scores and a tau")
    return _convert(samples, config, lambda rows: attach_scores(rows, scores), tokenizer)


def convert_scored(samples: DataFrame, config: SegmentConfig, tokenizer: Tokenizer | InContext = tokens) -> DataFrame:
    """convert() of samples that carry their confidences (threshold mode), under the same checks; no join, so streams can use it."""
    return _convert(samples, config, checked_scores, tokenizer)


def _convert(samples: DataFrame, config: SegmentConfig, scored: Callable[[DataFrame], DataFrame], tokenizer: Tokenizer | InContext) -> DataFrame:
    if config.mode == "threshold" and config.tau is None:
        raise ValueError("threshold mode needs scores and a tau")
    if config.limit_rows is not None:
        samples = samples.where(F.col("source_idx") < config.limit_rows)
    kept = [c for c in samples.columns if c != "thoughts_list"]
    rows = flagged(samples.select(*kept), config, tokenizer).where("usable and not dropped")
    if config.mode == "threshold":
        rows = scored(rows)
    return segmented(rows, config).select(*kept, F.col("segments").alias("thoughts_list"), "boundaries")


def segmented(rows: DataFrame, config: SegmentConfig) -> DataFrame:
    """Rows of flagged() with boundaries and segments."""
    return segment(rows, config, token_spans=F.col(PLACES)) if PLACES in rows.columns else segment(rows, config, token_lengths=F.col(LENGTHS))


def convert_aligned(inputs: DataFrame, reference: DataFrame, config: SegmentConfig, scores: DataFrame | None = None, own: str = "reference_idx", tokenizer: Tokenizer | InContext = tokens) -> DataFrame:
    """Conversion of a reference data set that must cover the rows of inputs.

    If reference has the column `own`, its index by its own account, a row that states another than
    its position raises; null states none.
    """
    rows = align(inputs, reference)
    return convert(require_aligned(rows, own) if own in rows.columns else rows, config, scores, tokenizer)


def full_run(samples: DataFrame, config: SegmentConfig, scores: DataFrame, token_scores: DataFrame, quantiles: Sequence[float] = QUANTILES, key: str = TAU_KEY, tokenizer: Tokenizer | InContext = tokens) -> DataFrame:
    """Estimate tau over the token scores (skipped where config.tau is given), convert, sort."""
    if config.mode == "threshold" and config.tau is None:
        config = config.with_(tau=pick_tau(estimate_tau(token_scores, quantiles), key))
    return convert(samples, config, scores, tokenizer).orderBy("source_idx")


def scored_run(
    samples: DataFrame, config: SegmentConfig, load: Callable[[], Scorer], sample_size: int = SAMPLE_SIZE, seed: int = SEED,
    quantiles: Sequence[float] = QUANTILES, key: str = TAU_KEY, tokenizer: Tokenizer | InContext = tokens,
) -> DataFrame:
    """Conversion with a user's scorer: tau from the answers of a seeded sample (unless config has one), then every answer.

    Answers are scored in windows of config.window tokens (see operators/windows). Rows that the policy
    on long answers drops are not scored.
    """
    config = config.with_(mode="threshold")
    if config.limit_rows is not None:
        samples = samples.where(F.col("source_idx") < config.limit_rows)
    rows = flagged(samples, config, tokenizer).where("usable and not dropped").select(*samples.columns)
    score = lambda some: stage(score_answers(some, load, config.window, config.stride, tokenizer))
    if config.tau is None:
        drawn = stage(rows.join(sample_rows(samples, sample_size, seed), "source_idx", "left_semi"))
        found = confidence_rows(drawn, score(drawn), config.special_tokens, tokenizer, config.protected_strings)
        config = config.with_(tau=pick_tau(estimate_tau(found, quantiles), key))
    return convert(samples, config, score(rows), tokenizer)


def _sum_if(value: str | Column, condition: str) -> Column:
    return F.coalesce(F.sum(F.when(F.expr(condition), F.col(value) if isinstance(value, str) else value)), F.lit(0)).cast("long")


def run_counters(flags: DataFrame, *by: str) -> DataFrame:
    """Counters of a run over flagged(): one row, or one per value of `by`; combined map-side."""
    done = "usable and not dropped"
    return flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows_seen"),
        F.count_if(F.expr(done)).alias("rows_scored"),
        F.count_if(F.expr(done)).alias("rows_written"),
        F.count_if(~F.expr(done)).alias("rows_skipped"),
        F.count_if("overlong").alias("num_overlong"),
        _sum_if("n_tokens", done).alias("token_count"),
        _sum_if("n_windows", done).alias("window_count"),
        _sum_if("n_tokens", done).alias("scored_token_count"),
    )


SUMS = ("rows_seen", "rows_scored", "token_count", "window_count", "scored_token_count", "num_overlong")


def merge_partials(partials: DataFrame, indices: DataFrame) -> DataFrame:
    """One row from per-rank metrics: sums, distinct rows, the largest non-null memory, guarded ratios."""
    sums = partials.agg(*[F.sum(c).cast("long").alias(c) for c in SUMS], F.max("memory_mb").alias("memory_mb"), F.sum("seconds").alias("seconds"))
    per = lambda x: F.coalesce(F.try_divide("seconds", x), F.lit(0.0))
    counted = F.lit(indices.select("source_idx").distinct().count())
    return sums.withColumn("sample_count", counted).withColumn("seconds_per_row", per(F.col("rows_scored"))).withColumn("seconds_per_token", per(F.col("scored_token_count")))


def config_mismatches(partials: DataFrame, keys: list[str]) -> DataFrame:
    """(setting, n_values): settings on which the partial runs disagree; null equals null."""
    values = F.explode(F.array(*[F.struct(F.lit(k).alias("setting"), F.coalesce(F.col(k).cast("string"), F.lit("\u0000null")).alias("value")) for k in keys]))
    return partials.select(values.alias("x")).groupBy("x.setting").agg(F.countDistinct("x.value").alias("n_values")).where("n_values > 1")


def require_equal_config(partials: DataFrame, keys: list[str]) -> None:
    if bad := [r.setting for r in config_mismatches(partials, keys).collect()]:
        raise ValueError(f"partial runs differ in {sorted(bad)}")


def output_audit(manifest: DataFrame, output: DataFrame) -> DataFrame:
    """Each rank's manifest against its output: rows written, seen and scored must agree."""
    there = output.groupBy("rank").agg(F.count(F.lit(1)).alias("output_rows"))
    joined = manifest.join(there, "rank", "full_outer").withColumn("output_rows", F.coalesce("output_rows", F.lit(0)))
    fits = (F.col("rows_written") == F.col("output_rows")) & (F.col("rows_seen") >= F.col("rows_written")) & (F.col("rows_scored") >= F.col("rows_written"))
    return joined.select("rank", "rows_seen", "rows_scored", "rows_written", "output_rows", F.coalesce(fits, F.lit(False)).alias("consistent"))


def require_consistent(audit: DataFrame) -> None:
    if bad := [r["rank"] for r in audit.where("not consistent").select("rank").collect()]:
        raise ValueError(f"output and manifest differ on ranks {sorted(bad, key=str)}")
