"""JSON lines in and out, row positions, shards and their merge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from segmill.functions.json_text import json_array, with_fields
from segmill.functions.text import is_blank
from segmill.sources.staging import configure, stage

#: Splits of files (some 100 bytes each) whose table is broadcast at most.
BROADCAST_SPLITS = 100_000
MESSAGE = T.StructType().add("from", T.StringType()).add("value", T.StringType())
SAMPLE = T.StructType().add("system", T.StringType()).add("conversations", T.ArrayType(MESSAGE))
REFERENCE = T.StructType().add("source_idx", T.LongType()).add("system_prompt", T.StringType()).add("question", T.StringType()).add("gt_output", T.StringType())


def read_jsonl(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, limit_rows: int | None = None, index: bool = True) -> DataFrame:
    """One row per non-blank line: source_idx (0-based, in file order), the schema's fields, raw.

    Blank lines take no index. Bad JSON fails the job. Fields outside the schema stay in `raw`, and
    write_records() writes them again. The index comes from one counting job over the lines, with a row
    per split of a file; no text is shuffled.
    """
    lines = spark.read.text(path).where(~is_blank(F.col("value")))
    if index or limit_rows is not None:
        lines = _indexed(lines)
        if limit_rows is not None:
            lines = lines.where(F.col("source_idx") < max(0, limit_rows))
    parsed = lines.withColumn("_j", F.from_json("value", schema, {"mode": "FAILFAST"}))
    fields = [F.col(f"_j.{n}").alias("reference_idx" if n == "source_idx" else n) for n in schema.names]
    return parsed.select(*(["source_idx"] if "source_idx" in lines.columns else []), *fields, F.col("value").alias("raw"))


def _indexed(lines: DataFrame) -> DataFrame:
    """(source_idx, value): lines numbered by file and place in it. Ids are consecutive within a split of a file."""
    split = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    placed = lines.select("value", *split, F.monotonically_increasing_id().alias("_id"))
    splits = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("_first"))
    earlier = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)  # one row a split
    starts = stage(splits.select("_file", "_block", "_first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before")))
    starts = F.broadcast(starts) if starts.count() <= BROADCAST_SPLITS else starts
    return placed.join(starts, ["_file", "_block"]).select((F.col("_before") + F.col("_id") - F.col("_first")).alias("source_idx"), "value")


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """JSON lines; nulls are written, text is not escaped."""
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)


def record_lines(converted: DataFrame, line: str = "raw") -> DataFrame:
    """(value): each converted record as its own input line with thoughts_list replaced.

    All other text of a line stays byte for byte: fields that no schema names, their order, and how
    numbers are written. source_idx is added where the line has none, or null.
    """
    configure(converted.sparkSession)
    fields = {"thoughts_list": json_array(F.col("thoughts_list")), "source_idx": F.col("source_idx").cast("string")}
    return converted.select(with_fields(F.col(line), fields, keep={"source_idx"}).alias("value"))


def write_records(converted: DataFrame, path: str, mode: str = "append", line: str = "raw") -> None:
    """record_lines() as text files: JSON lines in the order of each partition."""
    record_lines(converted, line).write.mode(mode).text(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A small result (counters, tau candidates) as one JSON file beside the data."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_summary(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def with_rank(df: DataFrame, world_size: int, key: str = "source_idx") -> DataFrame:
    if world_size <= 0:
        raise ValueError("world_size must be positive")
    return df.withColumn("rank", F.pmod(F.col(key), F.lit(world_size)).cast("long"))


def rank_report(rows: DataFrame, *texts: str) -> DataFrame:
    """Rows and characters of each rank, combined before the shuffle."""
    chars = sum((F.coalesce(F.length(t), F.lit(0)) for t in texts), F.lit(0).cast("long"))
    return rows.groupBy("rank").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(chars).alias("n_chars"))


def merge_shards(shards: Sequence[DataFrame], *within: str) -> DataFrame:
    """All shards' rows by source_idx; equal ones by shard, then by `within`; duplicates stay.

    Ragged shards get nulls. The result is a range-partitioned sort: several files in order.
    """
    if not shards:
        raise ValueError("nothing to merge")
    named = [s.withColumn("shard", F.lit(k)) for k, s in enumerate(shards)]
    merged = named[0]
    for more in named[1:]:
        merged = merged.unionByName(more, allowMissingColumns=True)
    return merged.orderBy("source_idx", "shard", *within)


def merge_sorted_shards(spark: SparkSession, paths: Sequence[str], *within: str, ranges: int = 64) -> DataFrame:
    """merge_shards() of Parquet shards that are each sorted by source_idx, without a shuffle of their rows.

    source_idx alone is read to cut it into ranges of about equal numbers of rows. Each range is one task
    that reads what lies in it of every shard: as shards are sorted, the filter reaches the files'
    statistics and skips all other row groups. Partitions of the result are the ranges, in order. Rows
    of one source_idx are one range, however many. Take as many ranges as tasks of a size that suits.
    """
    if not paths:
        raise ValueError("nothing to merge")
    shards = [spark.read.parquet(p).withColumn("shard", F.lit(k)) for k, p in enumerate(paths)]
    every = shards[0]
    for more in shards[1:]:
        every = every.unionByName(more, allowMissingColumns=True)
    cuts = every.agg(F.percentile_approx("source_idx", [k / ranges for k in range(1, ranges)] or [0.5], 10_000)).first()[0]
    cuts = sorted(set(cuts or []))[: ranges - 1]
    place = F.col("source_idx")
    if not cuts:
        return every.coalesce(1).sortWithinPartitions("source_idx", "shard", *within)
    bounds = [place.isNull() | (place < cuts[0]), *((place >= a) & (place < b) for a, b in zip(cuts, cuts[1:], strict=False)), place >= cuts[-1]]
    merged = [every.where(b).coalesce(1).sortWithinPartitions("source_idx", "shard", *within) for b in bounds]
    found = merged[0]
    for more in merged[1:]:
        found = found.union(more)
    return found
