"""Tables between the steps of a job, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _held = threading.Lock(), {}  # of settings(): users and the value before, by session and name
_left: list[tuple[str, str | None]] = []  # what stage() and the like have written: a path, and the table over it
#: Fixed value: buckets that Spark allows for a table.
MOST_BUCKETS = 100_000
#: Fixed for every function in Python: Arrow batches stay small, so that a few very long texts fit a worker.
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def configure(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches that Python workers get, by rows and by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def work_dir(spark: SparkSession) -> str:
    """A fresh path in the folder that all executors share (spark.checkpoint.dir).

    Where the setting is absent, a session in one JVM (as in tests) gets a temporary folder; on a
    cluster that would be a folder of each machine's own, so it raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="segmill-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/segmill-{uuid.uuid4().hex}"
    with _lock:
        _left.append((path, None))
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end, folders and tables alike.

    Results must be written or collected inside: they read what was staged. Without it staged tables
    stay, as a lazy result may still read them; a long session would fill the disk and the catalog.
    """
    with _lock:
        before = len(_left)
    try:
        yield
    finally:
        with _lock:
            mine = _left[before:]
            del _left[before:]
        for path, table in mine:
            if table is not None:
                spark.sql(f"drop table if exists {table}")
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def settings(spark: SparkSession, names: dict[str, str]) -> Iterator[None]:
    """Settings that hold inside.

    Jobs of several threads may use the same ones at once: what stood before comes back when the last ends.
    """
    with _lock:
        for name, value in names.items():
            users, before = _held.get((id(spark), name), (0, spark.conf.get(name, None)))
            _held[id(spark), name] = users + 1, before
            spark.conf.set(name, value)
    try:
        yield
    finally:
        with _lock:
            for name in names:
                users, before = _held.pop((id(spark), name))
                if users > 1:
                    _held[id(spark), name] = users - 1, before
                elif before is None:
                    spark.conf.unset(name)
                else:
                    spark.conf.set(name, before)


def _cleaned(spark: SparkSession):
    """Shuffle files of the writes inside are removed when these end."""
    return settings(spark, {_CLEANUP: "true"})


def stage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write df as a Parquet table in the shared folder (or at a path of one's own) and read it back.

    This cuts the lineage: a lost executor costs no recomputation of what lies before, and the
    shuffle files of the write are removed when it ends.
    """
    spark = df.sparkSession
    path = path or work_dir(spark)
    with _cleaned(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, column: str, buckets: int, group_rows: int | None = None) -> DataFrame:
    """stage() as a table bucketed by a column: a join on this column leaves its rows where they are.

    Only the other side of such a join is shuffled, so wide rows (texts) are written once and never
    travel again. With group_rows a row group has so many rows at most: Parquet's writer looks at its size
    after 100 rows only, and its reader holds a row group's nested columns at once.
    """
    spark = df.sparkSession
    path = work_dir(spark)
    name = path.rpartition("/")[2].replace("-", "_")
    groups = {"parquet.block.row.count.limit": str(group_rows), "parquet.page.size.row.check.min": "1"} if group_rows else {}
    with _cleaned(spark):
        df.write.format("parquet").option("compression", "zstd").options(**groups).option("path", path).bucketBy(buckets, column).saveAsTable(name)
    with _lock:
        _left[_left.index((path, None))] = (path, name)
    return spark.table(name)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever file system the path names."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def bucket_homes(spark: SparkSession, buckets: int) -> list[int]:
    """For each of the buckets a number that bucketing puts there: rows that carry it share that bucket."""
    tries = buckets * (buckets.bit_length() + 20)
    found = spark.range(tries).groupBy(F.pmod(F.hash("id"), F.lit(buckets)).alias("bucket")).agg(F.min("id").alias("id")).collect()  # a row a bucket
    at = {r.bucket: r.id for r in found}
    return [at.get(k, k) for k in range(buckets)]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
