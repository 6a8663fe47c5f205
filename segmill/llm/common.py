"""What the operators of this subpackage share: session settings, staged tables, text arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from segmill.sources.staging import BATCH_BYTES, BATCH_ROWS, configure, read_table, settings, stage, work_dir  # noqa: F401  (shared by the operators)

#: Keys that join_counted() broadcasts at most.
MOST_HOT = 1000


def stage_groups(groups: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """groups, one row per key with n, staged; the sum and the highest of n, seen while it is written."""
    seen = Observation()
    staged = stage(groups.observe(seen, F.sum("n").alias("total"), F.max("n").alias("highest")))
    return staged, tuple(seen.get.get(name) or 0 for name in ("total", "highest"))


def join_counted(rows: DataFrame, groups: DataFrame, key: str | list[str], most_hot: int | None = None, seen: tuple[int, int] | None = None) -> DataFrame:
    """rows joined to groups, a staged table of one row per key with n, the number of rows that have it.

    The few keys with a large share of all rows are broadcast, so no task gets all rows of such a
    key: as the n add up to the total, at most MOST_HOT keys have the share of one in MOST_HOT. seen is
    what stage_groups() has seen of groups; without it a job finds out.
    """
    most = most_hot or MOST_HOT
    total, highest = seen or (x or 0 for x in groups.agg(F.sum("n"), F.max("n")).first())
    if highest * most < total + most * most:
        return rows.join(groups, key)
    large = F.col("n") * most >= total + most * most
    hot = groups.where(large)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(groups.where(~large), key)
    return rows.join(F.broadcast(hot), key).unionByName(rest)


def copies_for(n: Column, share: int) -> Column:
    """How many copies of a key's row serve its n partners, share to each on average; none without a partner."""
    return F.ceil(n / F.lit(share)).cast("int")


def copy_of(partner: Column, copies: Column) -> Column:
    """Which of the copies, numbered from 0, serves a partner."""
    return F.pmod(F.xxhash64(partner), copies).cast("int")


def copy_numbers(copies: Column) -> Column:
    """A row for each copy."""
    return F.explode(F.sequence(F.lit(0), copies - 1))


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts of a string column, joined, and offsets (n + 1); null is empty."""
    column = pc.fill_null(as_array(column), "").cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    if not n or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(n + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def binary_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """text_bytes() of a binary column."""
    return text_bytes(as_array(column).cast(pa.large_binary()).view(pa.large_string()))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... for every (start, length), joined."""
    lengths = np.asarray(lengths, np.int64)
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.repeat(np.asarray(starts, np.int64) - before, lengths) + np.arange(total, dtype=np.int64)


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column over the bytes of data, cut at offsets (in bytes)."""
    raw = np.ascontiguousarray(data).view(np.uint8)
    offsets = np.ascontiguousarray(offsets, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
