"""Pack documents into sequences of bounded length by first-fit decreasing.

A document longer than a sequence is cut at multiples of the sequence length, so only its last
piece is short. Pieces go to random groups of bounded size; each group is packed on its own by
first-fit decreasing, with a tournament tree over the free space of its bins: the tree's root says
whether any open bin fits, and one walk down finds the first one.

Cases: null text is empty (one piece, the end id); a null or repeated doc_id packs like any other
row; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm.common import configure, stage
from segmill.llm.tokens import WordEncoder, tokenizer_path

SEQUENCE = 4096
END_ID = 2
#: Pieces in a group, on average: enough for a tight packing, small enough for one task.
GROUP_PIECES = 20_000

_PIECES = (
    T.StructType().add("doc_id", T.LongType()).add("start", T.LongType()).add("length", T.LongType())
    .add("ids_crc32", T.LongType()).add("doc_tokens", T.LongType()).add("piece", T.LongType())
)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size. Ties keep their order; sizes must be 1 to capacity."""
    n = len(sizes)
    order = np.argsort(-np.asarray(sizes), kind="stable")
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    full = int(np.searchsorted(-np.asarray(sizes)[order], -capacity, side="right"))
    bins[order[:full]] = np.arange(full)  # a piece of full size fills a bin
    left = n - full
    width = 1 << max(0, (left - 1).bit_length())
    free = [capacity] * (2 * width)  # node k has children 2k and 2k + 1; leaves from width on
    for at, size in zip(order[full:].tolist(), np.asarray(sizes)[order[full:]].tolist(), strict=True):
        node = 1
        while node < width:
            node *= 2
            if free[node] < size:
                node += 1
        bins[at], offsets[at] = full + node - width, capacity - free[node]
        free[node] -= size
        while node > 1:
            node //= 2
            most = free[2 * node] if free[2 * node] > free[2 * node + 1] else free[2 * node + 1]
            if free[node] == most:
                break
            free[node] = most
    return bins, offsets


def cut_pieces(docs: DataFrame, path: str, end_id: int, sequence: int) -> DataFrame:
    """One row per piece, with its checksum and a number that is its own in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, piece = WordEncoder(path), TaskContext.get().partitionId() << 33
        for batch in batches:
            ids, ends = encoder.encode(batch.column(1))
            own = np.insert(ids.astype("<u4"), ends[1:], end_id)
            cuts = ends + np.arange(len(ends))
            lengths = np.diff(cuts)
            counts = -(-lengths // sequence)
            rows = np.repeat(np.arange(len(lengths)), counts)
            start = (np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)) * sequence
            size = np.minimum(sequence, lengths[rows] - start)
            begin = cuts[rows] + start
            raw = memoryview(own).cast("B") if len(own) else memoryview(b"")
            crc = [zlib.crc32(raw[4 * b : 4 * (b + s)]) for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
            columns = [batch.column(0).take(pa.array(rows)), pa.array(start), pa.array(size), pa.array(crc, pa.int64()), pa.array(lengths[rows]), pa.array(piece + np.arange(len(rows)))]
            piece += len(rows)
            yield pa.RecordBatch.from_arrays(columns, names=_PIECES.names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _PIECES)


def pack_documents(spark: SparkSession, docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_to.

    padded_to is the length that its sequence takes: its own length if that is a power of two, else
    the sequence length. Only piece lengths are shuffled, never texts or ids. The number of groups
    follows the number of pieces; a piece's own number decides its group, so no key is hot.
    """
    configure(spark)
    pieces = stage(cut_pieces(docs, path or tokenizer_path(), end_id, sequence))
    groups = max(1, round(pieces.count() / group_pieces))

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("piece", ignore_index=True)
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), sequence)
        used = np.bincount(bins, weights=pdf["length"]).astype(np.int64)[bins]
        alone = (used & (used - 1)) == 0
        return pdf.drop(columns=["piece", "pack_group"]).assign(sequence_id=(key[0] << 40) + bins, offset=offsets, padded_to=np.where(alone, used, sequence))

    schema = T.StructType([f for f in _PIECES if f.name != "piece"]).add("sequence_id", T.LongType()).add("offset", T.LongType()).add("padded_to", T.LongType())
    return pieces.withColumn("pack_group", F.pmod(F.xxhash64("piece"), F.lit(groups))).groupBy("pack_group").applyInPandas(run, schema)
