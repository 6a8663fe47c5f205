"""Token ids of documents in binary files: frequency-ranked, byte-aligned, separate control bytes.

Ids are replaced by their rank in the corpus (most frequent first), so that frequent ones are
small. A rank takes one to four bytes; how many is two bits in a control stream of its own, four
ranks to a control byte. Both streams decode with numpy table lookups, without a branch per id.

A file is a Parquet part of the table that Spark's writer commits, so a lost executor never leaves
half a file. Each row is one block of consecutive documents in ascending doc_id order. The table of
ranks stands beside the files, so a folder can be read by itself, in any session.

Cases: null text is empty (one id, the end id); a null doc_id sorts first; repeated doc_ids stay as
they are, ordered by their ids; an empty table gives no block and no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from segmill.llm.common import BATCH_BYTES, binary_array, configure, ragged, stage, text_bytes, work_dir
from segmill.llm.tokens import WordEncoder, tokenizer_path

#: Id appended to each document.
END_ID = 1
#: Ids that a block holds before it is closed (a longer document is a block of its own).
BLOCK_IDS = 1 << 19

_IDS = T.StructType().add("doc_id", T.LongType()).add("n_tokens", T.LongType()).add("ids", T.BinaryType())
BLOCKS = (
    T.StructType().add("shard", T.IntegerType()).add("block", T.IntegerType()).add("start_in_shard", T.LongType())
    .add("n_tokens", T.LongType()).add("doc_ids", T.ArrayType(T.LongType())).add("lengths", T.BinaryType())
    .add("control", T.BinaryType()).add("data", T.BinaryType())
)
DECODED = T.StructType().add("doc_id", T.LongType()).add("start", T.LongType()).add("n_tokens", T.LongType()).add("ids_crc32", T.LongType())


def pack(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(control bytes, data bytes) of non-negative ranks below 2^32."""
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    held = np.arange(4, dtype=np.uint8) <= extra[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[held]
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = extra
    control = codes.reshape(-1, 4) @ np.array([1, 4, 16, 64], np.uint8)
    return control.astype(np.uint8), data


#: For every control byte, the sizes of its four ranks.
_SIZES = np.stack([(np.arange(256) >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.uint8)
_MASK = np.array([0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n ranks that pack() wrote."""
    sizes = _SIZES[control].reshape(-1)[:n]
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    wide = padded[:-3] | padded[1:-2] << 8 | padded[2:-1] << 16 | padded[3:] << 24
    return wide[starts] & _MASK[sizes - 1]


def tokenize(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, ids): little-endian unsigned ids of whole texts, 16 bits if they fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(path)
        kind = id_type(encoder.tokenizer.get_vocab_size())
        for batch in batches:
            ids, ends = encoder.encode(batch.column(1))
            n = len(ends) - 1
            own = np.insert(ids.astype(kind), ends[1:], end_id)
            cuts = ends + np.arange(n + 1)
            columns = [batch.column(0), pa.array(np.diff(cuts)), binary_array(own, cuts * kind().itemsize)]
            yield pa.RecordBatch.from_arrays(columns, names=_IDS.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _IDS)


def id_type(vocabulary: int) -> type:
    return np.uint16 if vocabulary <= 1 << 16 else np.uint32


def ranked_ids(ids: DataFrame, kind: type, vocabulary: int) -> np.ndarray:
    """The ids that occur, most frequent in the whole corpus first; no more than the vocabulary has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            data, _ = _bytes(batch.column(0))
            counts += np.bincount(data.view(kind), minlength=vocabulary)
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    rows = ids.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return np.array([r.id for r in sorted(rows, key=lambda r: (-r.n, r.id))], np.uint32)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return text_bytes(column.cast(pa.large_binary()).view(pa.large_string()))


def blocks_of(ids: DataFrame, ranked: np.ndarray, kind: type, vocabulary: int, block_ids: int = BLOCK_IDS) -> DataFrame:
    """Blocks of packed ranks, in ascending doc_id order over shards and blocks."""
    size = kind().itemsize
    rank = np.zeros(vocabulary, np.uint32)
    rank[ranked] = np.arange(len(ranked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            data, offsets = _bytes(batch.column(1))
            cuts = offsets // size
            ranks = rank[data.view(kind)]
            first, n = 0, len(cuts) - 1
            while first < n:
                last = max(first + 1, int(np.searchsorted(cuts, cuts[first] + block_ids, side="right")) - 1)
                last = min(last, n)
                control, packed = pack(ranks[cuts[first] : cuts[last]])
                lengths = np.diff(cuts[first : last + 1]).astype("<i8")
                total = int(lengths.sum())
                yield pa.RecordBatch.from_pylist(
                    [dict(shard=shard, block=block, start_in_shard=start, n_tokens=total, doc_ids=batch.column(0)[first:last].to_pylist(), lengths=lengths.tobytes(), control=control.tobytes(), data=packed.tobytes())],
                    schema=_arrow_blocks(),
                )
                first, block, start = last, block + 1, start + total

    ordered = ids.repartitionByRange("doc_id", "n_tokens").sortWithinPartitions("doc_id", "n_tokens", "ids")
    return ordered.select("doc_id", "ids").mapInArrow(run, BLOCKS)


def _arrow_blocks() -> pa.Schema:
    return pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("start_in_shard", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.binary()), ("control", pa.binary()), ("data", pa.binary())])


def write_files(spark: SparkSession, docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Encode all documents and write folder/blocks and folder/ranks, which has a row per id that occurs."""
    from tokenizers import Tokenizer

    configure(spark)
    path = path or tokenizer_path()
    vocabulary = Tokenizer.from_file(path).get_vocab_size()
    kind = id_type(vocabulary)
    ids = stage(tokenize(docs, path, end_id))
    ranked = ranked_ids(ids, kind, vocabulary)
    stage(spark.createDataFrame(pa.table({"rank": pa.array(range(len(ranked)), pa.int64()), "id": pa.array(ranked, pa.int64())})), f"{folder}/ranks")
    stage(blocks_of(ids, ranked, kind, vocabulary), f"{folder}/blocks")


def read_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the files alone; with_ids adds the ids."""
    ranks = spark.read.parquet(f"{folder}/ranks").toArrow()  # at most the vocabulary
    vocabulary = np.zeros(ranks.num_rows, "<u4")
    vocabulary[ranks["rank"].to_numpy()] = ranks["id"].to_numpy()
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    sums = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("shard_tokens"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    starts = sums.select("shard", F.coalesce(F.sum("shard_tokens").over(before), F.lit(0)).alias("shard_start"))
    schema = T.StructType([*DECODED]).add("ids", T.ArrayType(T.LongType())) if with_ids else DECODED

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.frombuffer(row["lengths"], "<i8")
                ends = np.cumsum(lengths)
                ids = vocabulary[unpack(np.frombuffer(row["control"], np.uint8), np.frombuffer(row["data"], np.uint8), int(lengths.sum()))]
                raw = memoryview(ids).cast("B")
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                start = row["shard_start"] + row["start_in_shard"] + ends - lengths
                columns = [pa.array(row["doc_ids"], pa.int64()), pa.array(start), pa.array(lengths), pa.array(crc, pa.int64())]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return blocks.join(starts, "shard").select("start_in_shard", "doc_ids", "lengths", "control", "data", "shard_start").mapInArrow(run, schema)


def token_binary(spark: SparkSession, docs: DataFrame, path: str | None = None, end_id: int = END_ID, folder: str | None = None) -> DataFrame:
    """Write all documents to a folder and read them back from it; one row per document (see the module's docstring).

    The ids go once through the tokenizer to a table in the shared folder, and are counted and sorted
    from there. The rank table has one entry per vocabulary id, whatever the corpus.
    """
    folder = folder or work_dir(spark)
    write_files(spark, docs, folder, path, end_id)
    return read_files(spark, folder)
