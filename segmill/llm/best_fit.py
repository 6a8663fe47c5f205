"""Pack documents into few sequences by hierarchical best fit with residuals.

A document longer than a sequence is cut so that only its first piece is short. Each task packs the
pieces of the documents that it reads by best fit in decreasing order, a block of pieces at a time,
without a shuffle. Bins that are nearly full are final. The others are residuals: in rounds, groups of
them are merged along a tree, and a round's best fit takes whole bins as items, until one group is
left. So only bins with much room travel, one row each, and at last the rows of the pieces in them.

A group hands up at most `residuals` bins, those with the most room; the rest are final as they are.
That bounds what one task packs at any size of the table, and loses no piece: two bins of one group
never fit together, so beyond the first of them they can only serve small bins of other groups.

Cases: null text is empty (one piece, the end id); a null or repeated doc_id packs like any other
row; equal sizes keep their order; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm.common import configure, stage
from segmill.llm.tokens import ByteLevelEncoder, tokenizer_path

SEQUENCE = 2048
END_ID = 0
#: A bin is nearly full when less than this share of it is free.
NEARLY_FULL = 1 / 64
#: Pieces that a task packs at once, bins that a group hands up, groups that merge into one.
BLOCK_PIECES, RESIDUALS, FAN = 50_000, 1000, 16
#: Bits that number the bins of a block and the blocks of a task.
_BIN_BITS, _BLOCK_BITS = 20, 16

PIECES = (
    T.StructType().add("doc_id", T.LongType()).add("piece", T.IntegerType()).add("start", T.LongType()).add("length", T.LongType())
    .add("ids_crc32", T.LongType()).add("bin", T.LongType()).add("offset", T.LongType()).add("used", T.LongType()).add("open", T.BooleanType())
)
_ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32", "bin", "offset", "used")), ("open", pa.bool_())])
#: A bin of the first packing, the bin that it has come to stand in, and where.
BINS = T.StructType().add("bin", T.LongType()).add("top", T.LongType()).add("shift", T.LongType()).add("used", T.LongType()).add("open", T.BooleanType())


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each size: the fullest bin that has room, else a new one. Sizes must be 1 to capacity.

    Bins wait in a stack for each number of free places; the bits of one integer tell which stacks hold one.
    """
    order = np.argsort(-np.asarray(sizes), kind="stable")
    bins, offsets = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
    waiting: list[list[int]] = [[] for _ in range(capacity + 1)]
    there, n = 0, 0
    for at, size in zip(order.tolist(), np.asarray(sizes)[order].tolist(), strict=True):
        fits = there >> size
        if fits:
            free = size + (fits & -fits).bit_length() - 1
            bin_ = waiting[free].pop()
            if not waiting[free]:
                there ^= 1 << free
        else:
            bin_, free, n = n, capacity, n + 1
        bins[at], offsets[at] = bin_, capacity - free
        free -= size
        if free:
            waiting[free].append(bin_)
            there |= 1 << free
    return bins, offsets


def cut_lengths(tokens: np.ndarray, sequence: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, piece, start, length) of all pieces: all but the first of a document fill a sequence."""
    counts = np.maximum(1, -(-tokens // sequence))
    first = tokens - (counts - 1) * sequence
    rows = np.repeat(np.arange(len(tokens)), counts)
    piece = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    start = np.where(piece > 0, first[rows] + (piece - 1) * sequence, 0)
    return rows, piece, start, np.where(piece > 0, sequence, first[rows])


def handed_up(used: np.ndarray, capacity: int, nearly_full: float, residuals: int) -> np.ndarray:
    """Which bins stay open: those that are not nearly full, and of these the ones with the most room."""
    order = np.argsort(used, kind="stable")[:residuals]
    flags = np.zeros(len(used), bool)
    flags[order] = used[order] <= capacity * (1 - nearly_full)
    return flags


def pack_locally(docs: DataFrame, path: str, end_id: int, sequence: int, nearly_full: float, residuals: int, block_pieces: int) -> DataFrame:
    """One row per piece with its bin in the block of its task; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, block, held, n = ByteLevelEncoder(path), TaskContext.get().partitionId(), 0, [], 0

        def packed() -> pa.RecordBatch:
            doc_ids = pa.concat_arrays([h[0] for h in held])
            piece, start, length, crc = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3, 4))
            bins, offsets = best_fit_decreasing(length, sequence)
            used = np.bincount(bins, weights=length).astype(np.int64)
            base = ((task << _BLOCK_BITS) + block) << _BIN_BITS
            columns = [doc_ids, piece.astype(np.int32), start, length, crc, base + bins, offsets, used[bins], handed_up(used, sequence, nearly_full, residuals)[bins]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=_ARROW)

        for batch in batches:
            ids, ends = encoder.encode(batch.column(1))
            own = np.insert(ids.astype("<u4"), ends[1:], end_id)
            cuts = ends + np.arange(len(ends))
            rows, piece, start, length = cut_lengths(np.diff(cuts), sequence)
            begin = cuts[rows] + start
            raw = memoryview(own.tobytes())
            crc = np.fromiter((zlib.crc32(raw[4 * b : 4 * (b + s)]) for b, s in zip(begin.tolist(), length.tolist(), strict=True)), np.int64, len(rows))
            held.append((batch.column(0).take(pa.array(rows)), piece, start, length, crc))
            n += len(rows)
            if n >= block_pieces:
                yield packed()
                block, held, n = block + 1, [], 0
        if n:
            yield packed()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def merge_round(bins: DataFrame, sequence: int, nearly_full: float, residuals: int) -> DataFrame:
    """Rows of BINS in groups of open bins: best fit with the bins as items; the first one of a new bin names it."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["top", "shift"], ignore_index=True)
        first = np.flatnonzero(~pdf["top"].duplicated())
        item = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(pdf))))
        sizes, tops = pdf["used"].to_numpy()[first], pdf["top"].to_numpy()[first]
        found, offsets = best_fit_decreasing(sizes, sequence)
        used = np.bincount(found, weights=sizes).astype(np.int64)
        name = np.empty(len(used), np.int64)
        name[found[offsets == 0]] = tops[offsets == 0]
        still = handed_up(used, sequence, nearly_full, residuals)
        own = found[item]
        return pd.DataFrame({"bin": pdf["bin"], "top": name[own], "shift": pdf["shift"] + offsets[item], "used": used[own], "open": still[own]})

    return bins.groupBy("group").applyInPandas(run, BINS)


def best_fit_packing(
    spark: SparkSession, docs: DataFrame, path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID,
    nearly_full: float = NEARLY_FULL, residuals: int = RESIDUALS, fan: int = FAN, block_pieces: int = BLOCK_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    configure(spark)
    if not 1 <= block_pieces <= 1 << (_BIN_BITS - 1) or fan < 2 or residuals < 1:
        raise ValueError("block_pieces, fan or residuals out of range")
    pieces = stage(pack_locally(docs, path or tokenizer_path("byte_bpe_50k.json"), end_id, sequence, nearly_full, residuals, block_pieces))
    block = F.shiftright("bin", _BIN_BITS)
    groups = pieces.where("open").select(block.alias("b")).distinct().count()
    bins = pieces.where("open and offset = 0").select("bin", F.col("bin").alias("top"), F.lit(0).cast("long").alias("shift"), "used", "open")
    rounds, number = [], F.pmod(F.xxhash64(block), F.lit(max(1, groups)))  # a block's place in the tree
    while groups > 1:
        groups = -(-groups // fan)
        number = F.floor(number / fan)
        bins = stage(merge_round(bins.withColumn("group", number), sequence, nearly_full, residuals))
        if groups > 1:
            rounds.append(bins.where("not open"))
            bins = bins.where("open")
    moved = reduce(DataFrame.unionByName, [*rounds, bins]).select("bin", "top", "shift")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    still = pieces.where("not open").select(*columns, F.col("bin").alias("sequence_id"), "offset")
    return still.unionByName(pieces.where("open").join(moved, "bin").select(*columns, F.col("top").alias("sequence_id"), (F.col("offset") + F.col("shift")).alias("offset")))
