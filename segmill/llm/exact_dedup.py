"""Exact deduplication as a stateful stream over a store that lasts.

Documents become slim events: digest, doc_id (the stable identifier) and a content locator, the file
and row where the text stands. Events are appended to the store, and a stream reads what is new there
in micro-batches. It keeps one state row per digest in RocksDB on disk, without expiry: the identifier
that stays (the largest doc_id so far), the locator of the text that came first, and the number of
rows. Rows of one digest are combined before the shuffle, so a group of any size costs a task one row.

A hit is a digest that was met before. Its new rows are fetched by their locators, and so is the text
that came first, whichever run brought it; their full bytes are compared. A digest with several texts
is split by whole text. Given a store of its own, a later run meets the documents of all runs before.

A run's events are whole once their folder has its mark; until then a new run takes the number and
writes over them. A run that fails later is taken up again by the next call with the same documents
(the same pairs of doc_id and text): its events are there already, the stream's checkpoint lets each of
them count once, and what micro-batches have said stays under the run's number. With a run_id a call is
the same run for good, so a caller whose own write fails can ask again. A failed run that is never
taken up counts as a run.

Texts are equal if they are identical after lower-casing A-Z only.

Cases: null text counts as empty; a null doc_id is smaller than any other; of repeated rows with the
same doc_id and text exactly one stays (that of the largest locator); an empty table gives no row; a
text of any length is one value of a column; other columns are ignored. A store has as many state
partitions as spark.sql.shuffle.partitions said when it was made.
"""

from __future__ import annotations

import string
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from segmill.llm.common import configure, join_counted, settings, stage, work_dir
from segmill.sources.staging import exists

#: Event files in a micro-batch: enough to keep a large cluster busy.
FILES_PER_BATCH = 4096
_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",  # many small stores: no space ahead
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
}
_LOCATOR = ["run", "file", "row"]


def normal_text(text: str | Column = "text") -> Column:
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("string")
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def text_digest(text: Column, digest_bytes: int = 32) -> Column:
    return F.substring(F.unhex(F.sha2(text.cast("binary"), 256)), 1, digest_bytes)


def locate(scan: DataFrame, run: int) -> DataFrame:
    """(doc, run, file, row): a scan of files, its columns in a struct of their own, with each row's locator (file is a hash of the path)."""
    place = F.col("_metadata")
    return scan.select(F.struct(*scan.columns).alias("doc"), F.lit(run).cast("long").alias("run"), F.xxhash64(place["file_path"]).alias("file"), place["row_index"].alias("row"))


class Store:
    """A folder with each run's events, sources and group updates, and the stream's state."""

    def __init__(self, spark: SparkSession, folder: str | None):
        self.spark, self.fresh, self.folder = spark, folder is None, folder or work_dir(spark)
        self.events, self.sources, self.mixed, self.checkpoint = (f"{self.folder}/{name}" for name in ("events", "sources", "mixed", "checkpoint"))
        self.run, self.run_id = 0, ""

    def table(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path)
        except AnalysisException:  # nothing was written there yet
            return None

    def add(self, docs: DataFrame, located: bool, digest_bytes: int, run_id: str | None) -> DataFrame:
        """docs with locators, their events being in the store; unless docs can be located where they stand, their columns are copied to the store."""
        if not self.fresh:
            self._find(docs, digest_bytes, run_id)
            if self.whole(self.run):
                paths = self.source(self.run)
                return locate(docs if located else self.spark.read.parquet(*paths), self.run)
        scan = docs if located else stage(docs, f"{self.folder}/contents-{self.run}-{uuid.uuid4().hex}")
        found = locate(scan, self.run)
        paths = [(self.run, self.run_id, path) for path in scan.inputFiles()]
        self.spark.createDataFrame(paths or [(self.run, self.run_id, None)], "run long, run_id string, path string").coalesce(1).write.mode("overwrite").parquet(f"{self.sources}/run-{self.run}")
        events_of(found, digest_bytes).write.mode("overwrite").parquet(f"{self.events}/run-{self.run}")
        return found

    def _find(self, docs: DataFrame, digest_bytes: int, run_id: str | None) -> None:
        """Set run and run_id: those of an earlier call that this one repeats, or the next."""
        given = run_id is not None
        if not given:
            pairs = docs.select(F.xxhash64(F.col("doc_id").cast("long"), text_digest(normal_text(), digest_bytes)).alias("h"))
            n, total, mixed = pairs.agg(F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("h"))).first()
            run_id = f"{n}:{total}:{mixed}"
        self.run_id, self.run = run_id, 0
        while self.whole(self.run):  # a number a run
            ids = {r.run_id for r in self.spark.read.parquet(f"{self.sources}/run-{self.run}").select("run_id").distinct().collect()}
            if run_id in ids and (given or not exists(self.spark, f"{self.folder}/commits/run-{self.run}")):
                return
            self.run += 1

    def whole(self, run: int) -> bool:
        return exists(self.spark, f"{self.events}/run-{run}/_SUCCESS")

    def source(self, run: int) -> list[str]:
        return [r.path for r in self.spark.read.parquet(f"{self.sources}/run-{run}").select("path").distinct().collect() if r.path is not None]

    def commit(self) -> None:
        """The run is done: the same documents come again as a run of their own."""
        if not self.fresh:
            self.spark.range(1).write.mode("overwrite").parquet(f"{self.folder}/commits/run-{self.run}")

    def texts(self, locators: DataFrame, present: DataFrame) -> DataFrame:
        """(digest, normal) of the texts at locators(digest, run, file, row); present is what add() gave for this run."""
        every = present.select(F.col("doc.text").alias("text"), *_LOCATOR)
        earlier = locators.where(F.col("run") < self.run).select("run").distinct().collect()  # a row a run
        for run in sorted(r.run for r in earlier):
            every = every.unionByName(locate(self.spark.read.parquet(*self.source(run)).select("text"), run).select(F.col("doc.text").alias("text"), *_LOCATOR))
        return every.join(locators.hint("merge"), _LOCATOR).select("digest", normal_text().alias("normal"), *_LOCATOR)


def events_of(contents: DataFrame, digest_bytes: int) -> DataFrame:
    rows = contents.select(F.col("doc.doc_id").cast("long").alias("doc_id"), normal_text("doc.text").alias("normal"), *_LOCATOR)
    return rows.select("doc_id", text_digest(F.col("normal"), digest_bytes).alias("digest"), F.sha2(F.col("normal").cast("binary"), 256).alias("text_sha256"), *_LOCATOR)


def stream_groups(store: Store, events: DataFrame, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """(digest, keep, first, n) of every digest among the new events, after all of them."""
    spark = store.spark
    updates = f"{store.folder}/updates-{store.run}"  # of a run that is taken up again, some may be there
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{store.events}/*")
    state = source.groupBy("digest").agg(*_state())
    with settings(spark, _ROCKSDB):  # a query keeps the settings with which it starts
        query = (
            state.writeStream.outputMode("update")
            .option("checkpointLocation", store.checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(lambda batch, k: batch.write.mode("overwrite").parquet(f"{updates}/batch={k}"))
            .start()
        )
    query.awaitTermination()
    empty = events.limit(0).groupBy("digest").agg(*_state())
    try:
        rows = spark.read.schema(empty.schema).option("basePath", updates).parquet(updates)
    except AnalysisException:  # no new event
        return empty
    return rows.groupBy("digest").agg(F.max("keep").alias("keep"), F.min("first").alias("first"), F.max("n").alias("n"))


def _state() -> list[Column]:
    locator = F.struct(*_LOCATOR)
    return [F.max(F.struct("doc_id", locator.alias("at"))).alias("keep"), F.min(locator).alias("first"), F.count(F.lit(1)).alias("n")]


def exact_dedup(spark: SparkSession, docs: DataFrame, digest_bytes: int = 32, files_per_batch: int = FILES_PER_BATCH, store: str | None = None, located: bool = False, run_id: str | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    With a store, a folder of one's own, groups take in the documents of all runs on it. located says
    that docs are a plain scan of files that stay, so texts need not be copied to the store. A shorter
    digest (digest_bytes) only makes collisions likelier; results stay the same. run_id names the run
    for callers who may ask again.
    """
    return _exact_dedup(spark, docs, digest_bytes, files_per_batch, store, located, run_id)[1].drop(*_LOCATOR)


def _exact_dedup(spark: SparkSession, docs: DataFrame, digest_bytes: int, files_per_batch: int, folder: str | None, located: bool, run_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(docs with locators, exact_dedup() with locators)."""
    configure(spark)
    store = Store(spark, folder)
    contents = store.add(docs, located, digest_bytes, run_id)
    every = spark.read.parquet(f"{store.events}/*").where(F.col("run") <= store.run)
    events = every.where(F.col("run") == store.run)
    groups = stage(stream_groups(store, events, files_per_batch))

    hits = groups.where("n > 1").select("digest", "first")
    met = stage(join_counted(events, groups, "digest").where("n > 1").select("digest", *_LOCATOR).union(hits.select("digest", *[F.col(f"first.{c}").alias(c) for c in _LOCATOR])).distinct())
    texts = store.texts(met, contents).groupBy("digest", "normal").agg(F.count(F.lit(1)).alias("m"))
    mixed = stage(texts.groupBy("digest").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1").select("digest"))
    known = store.table(store.mixed)
    if not mixed.isEmpty():
        mixed.write.mode("append").parquet(store.mixed)
    store.commit()
    if known is not None:
        mixed = stage(mixed.union(known.join(groups, "digest", "left_semi")).distinct())
    if mixed.isEmpty():
        return contents, _result(join_counted(events, groups, "digest"))
    # Different texts share a digest: their groups are those of the whole texts, over all runs.
    whole = stage(store.texts(every.join(mixed, "digest", "left_semi").select("digest", *_LOCATOR), contents).join(every.select("doc_id", "text_sha256", *_LOCATOR), _LOCATOR))
    split = whole.groupBy("normal").agg(*_state())
    rest = join_counted(events.join(mixed, "digest", "left_anti"), groups.join(mixed, "digest", "left_anti"), "digest")
    return contents, _result(rest).unionByName(_result(whole.where(F.col("run") == store.run).join(split, "normal")))


def _result(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.struct(*_LOCATOR) == F.col("keep.at")).alias("kept"),
        "text_sha256",
        *_LOCATOR,
    )


def drop_copies(spark: SparkSession, docs: DataFrame, store: str | None = None, located: bool = False) -> DataFrame:
    """The documents that exact_dedup() keeps, with their own columns; rows go by their locators."""
    contents, found = _exact_dedup(spark, docs, 32, FILES_PER_BATCH, store, located)
    gone = stage(found.where("not kept").select(*_LOCATOR))
    return contents.join(gone, _LOCATOR, "left_anti").select("doc.*")
