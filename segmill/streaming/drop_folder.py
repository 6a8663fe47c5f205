"""Conversion of samples that arrive as Parquet files in a folder.

Fixed and random modes (and threshold mode with given confidences) decide each row by itself, so the
stream needs no state and no watermark: the checkpoint alone makes each file count once. Row limits
and the check of the number of confidences hold as in a batch.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from segmill.jobs.config import SegmentConfig
from segmill.jobs.convert import convert_scored


def convert_folder(spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, config: SegmentConfig, files_per_batch: int = 64) -> StreamingQuery:
    """Start a run over all files that are there and not yet converted; it ends by itself."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    out = convert_scored(rows, config).drop("boundaries")
    return out.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
