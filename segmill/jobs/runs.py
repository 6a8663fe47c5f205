"""A conversion as a committed run: output by rank, a manifest with counters, and resumption.

A run writes all rows that it has seen, each with what became of it, to `rows/run=N/rank=R/status=S`;
rows that are not converted keep only their source_idx. Only then it writes `manifest/run=N`, one file
with a row of counters per rank, which appears at once or not at all: a run without a manifest counts
for nothing, and the next one takes its number and replaces its rows. So a job that dies anywhere
between can be started again, and no row is written twice. A later run converts what no committed one
has seen, in whatever order rows came.

Counters are measured on the frame that is written (Observation, in the same pass) and again on what
the files hold; a run whose counts differ is not committed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.functions.offsets import InContext
from segmill.functions.text import Tokenizer, tokens
from segmill.jobs.config import SegmentConfig
from segmill.jobs.convert import LENGTHS, PLACES, flagged, segmented
from segmill.operators.align import checked_scores, not_done
from segmill.sources.jsonl import with_rank
from segmill.sources.staging import exists, stage

#: What becomes of a row: converted; without question or answer; too long for the policy; taken out by `keep`.
WRITTEN, SKIPPED, OVERLONG, DROPPED = "written", "skipped", "overlong", "dropped"
COUNTERS = ("rows_seen", "rows_scored", "rows_written", "rows_skipped", "num_overlong", "rows_dropped", "token_count", "window_count")
MANIFEST = T.StructType([
    T.StructField("world_size", T.LongType()), *(T.StructField(c, T.LongType()) for c in COUNTERS),
    T.StructField("last_source_idx", T.LongType()), T.StructField("finished", T.BooleanType()), T.StructField("settings", T.StringType()),
])
_OWN = ("rank", "run", "status", "overlong", "n_tokens", "n_windows", "thoughts_list")
_PLACED = T.StructType([T.StructField("rank", T.LongType()), *MANIFEST, T.StructField("run", T.LongType())])


def _counters() -> dict[str, Column]:
    status, scored = F.col("status"), F.col("status").isin(WRITTEN, DROPPED)
    total = lambda name: F.coalesce(F.sum(F.when(scored, F.col(name))), F.lit(0)).cast("long")
    return {
        "rows_seen": F.count(F.lit(1)), "rows_scored": F.count_if(scored), "rows_written": F.count_if(status == WRITTEN), "rows_skipped": F.count_if(status == SKIPPED),
        "num_overlong": F.count_if("overlong"), "rows_dropped": F.count_if(status == DROPPED), "token_count": total("n_tokens"), "window_count": total("n_windows"),
    }


def converted_rows(samples: DataFrame, config: SegmentConfig, world_size: int, scores: DataFrame | None = None, keep: Column | None = None, tokenizer: Tokenizer | InContext = tokens) -> DataFrame:
    """Every row of samples with rank, status, overlong, n_tokens, n_windows, and its segments if it was converted.

    keep is a condition on a converted row (thoughts_list among its columns); rows that miss it are `dropped`.
    """
    if config.mode == "threshold" and (scores is None or config.tau is None):
        raise ValueError("threshold mode needs scores and a tau")
    columns = [c for c in samples.columns if c != "thoughts_list"]
    if clash := sorted(set(columns) & set(_OWN)):
        raise ValueError(f"samples have columns that a run writes itself: {clash}")
    rows = flagged(with_rank(samples.select(*columns), world_size), config, tokenizer)
    active = F.col("usable") & ~F.col("dropped")
    if config.mode == "threshold":
        rows = checked_scores(rows.join(scores, "source_idx", "left"), only=active)
    texts = F.col("gt_output")
    rows = segmented(rows.withColumn("gt_output", F.when(active, texts)), config).drop(LENGTHS, PLACES, "confidences", "boundaries")
    rows = rows.withColumn("thoughts_list", F.when(active, F.col("segments"))).drop("segments")
    kept = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    rows = rows.withColumn("status", F.when(~F.col("usable"), SKIPPED).when(F.col("dropped"), OVERLONG).when(kept, WRITTEN).otherwise(DROPPED))
    only_written = [c if c == "source_idx" else F.when(F.col("status") == WRITTEN, F.col(c)).alias(c) for c in [*columns, "thoughts_list"]]
    return rows.select(*only_written, "overlong", "n_tokens", "n_windows", "rank", "status")


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """One row per committed run and rank: run, rank and MANIFEST; none yet, no row."""
    if not exists(spark, f"{target}/manifest"):
        return spark.createDataFrame([], _PLACED)
    return spark.read.schema(_PLACED).json(f"{target}/manifest")


def run_rows(spark: SparkSession, target: str) -> DataFrame:
    """All rows that committed runs have seen; those of other attempts are not read."""
    runs = [r.run for r in manifest(spark, target).select("run").distinct().collect()]  # a number a run
    rows = spark.read.option("basePath", f"{target}/rows").parquet(*[f"{target}/rows/run={n}" for n in runs])
    return rows.withColumn("run", F.col("run").cast("long")).withColumn("rank", F.col("rank").cast("long"))


def read_output(spark: SparkSession, target: str) -> DataFrame:
    """The converted rows of all committed runs."""
    return run_rows(spark, target).where(F.col("status") == WRITTEN).drop("status", "overlong", "n_tokens", "n_windows")


def audit_runs(spark: SparkSession, target: str) -> DataFrame:
    """(run, rank, rows_seen, rows_scored, rows_written, rows_dropped, output_rows, finished, consistent): manifests against the files."""
    there = run_rows(spark, target).groupBy("run", "rank").agg(F.count_if(F.col("status") == WRITTEN).alias("output_rows"), F.count(F.lit(1)).alias("n"))
    joined = manifest(spark, target).join(there, ["run", "rank"], "full_outer")
    seen, scored, written = F.col("rows_seen"), F.col("rows_scored"), F.col("rows_written")
    output = F.coalesce("output_rows", F.lit(0))
    fits = (written == output) & (seen == F.coalesce("n", F.lit(0))) & (seen >= scored) & (scored >= written) & (F.col("rank") < F.col("world_size")) & (~F.col("finished") | (F.col("last_source_idx") >= 0) | (written == 0))
    return joined.select("run", "rank", seen, scored, written, "rows_dropped", output.alias("output_rows"), "finished", F.coalesce(fits, F.lit(False)).alias("consistent"))


def check_runs(spark: SparkSession, target: str, world_size: int, config: SegmentConfig) -> int:
    """Raise unless all committed runs agree with their files, with world_size and with the settings; else the next run's number."""
    before = manifest(spark, target).select("run", "rank", "world_size", "settings").collect()  # a row a run and rank
    if not before:
        return 0
    if sizes := sorted({r.world_size for r in before} - {world_size}):
        raise ValueError(f"earlier runs had world_size {sizes}, this one has {world_size}")
    own = _settings(config)
    for text in {r.settings for r in before}:
        if bad := sorted(k for k, v in own.items() if json.loads(text).get(k) != v):
            raise ValueError(f"earlier runs differ in {bad}")
    if bad := [(r.run, r["rank"]) for r in audit_runs(spark, target).where("not consistent").select("run", "rank").collect()]:
        raise ValueError(f"output and manifest differ for (run, rank) {sorted(bad, key=str)}")
    return 1 + max(r.run for r in before)


def _settings(config: SegmentConfig) -> dict:
    return json.loads(json.dumps({k: v for k, v in asdict(config).items() if k != "limit_rows"}))


def write_run(rows: DataFrame, target: str, run: int) -> dict[str, int]:
    """Write converted_rows() as the rows of a run that is not committed yet; its counters, as observed on the write."""
    seen = Observation()
    observed = rows.observe(seen, *[c.alias(n) for n, c in _counters().items()])
    observed.write.mode("overwrite").option("compression", "zstd").partitionBy("rank", "status").parquet(f"{target}/rows/run={run}")
    return dict(seen.get)


def commit_run(spark: SparkSession, target: str, run: int, observed: dict[str, int], world_size: int, config: SegmentConfig) -> DataFrame:
    """Write the manifest of a run; counts that differ from the files' raise, and nothing is committed."""
    files = spark.read.parquet(f"{target}/rows/run={run}")
    counters = stage(files.groupBy(F.col("rank").cast("long").alias("rank")).agg(*[c.alias(n) for n, c in _counters().items()], F.max("source_idx").alias("last_source_idx")))
    sums = counters.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTERS]).first().asDict()
    if bad := {c: (observed[c], sums[c]) for c in COUNTERS if observed[c] != sums[c]}:
        raise ValueError(f"run {run} counted rows otherwise than its files hold them: {bad}")
    settings = F.lit(json.dumps(_settings(config), sort_keys=True))
    rows = counters.select("rank", F.lit(world_size).cast("long").alias("world_size"), *COUNTERS, "last_source_idx", F.lit(True).alias("finished"), settings.alias("settings"))
    rows.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{target}/manifest/run={run}")
    return manifest(spark, target).where(F.col("run") == run)


def convert_run(
    samples: DataFrame, config: SegmentConfig, target: str, world_size: int = 1, scores: DataFrame | None = None,
    ranks: Sequence[int] | None = None, keep: Column | None = None, tokenizer: Tokenizer | InContext = tokens,
) -> DataFrame | None:
    """Convert the rows of samples that no committed run has seen (of these ranks, or all), and commit; the run's manifest.

    Where nothing is left to do, nothing is written (None). Earlier runs must agree with their files,
    with world_size and with the settings, or this raises.
    """
    spark = samples.sparkSession
    run = check_runs(spark, target, world_size, config)
    if config.limit_rows is not None:
        samples = samples.where(F.col("source_idx") < config.limit_rows)
    if ranks is not None:
        samples = samples.where(F.pmod("source_idx", F.lit(world_size)).isin(*ranks))
    if run:
        samples = not_done(samples, run_rows(spark, target))
    if samples.isEmpty():
        return None
    observed = write_run(converted_rows(samples, config, world_size, scores, keep, tokenizer), target, run)
    return commit_run(spark, target, run, observed, world_size, config)
