"""Questions that all texts ask together: how often does a hash occur, and which copy is the first.

Texts are staged once, in parts of bounded size, one row each, as a table bucketed by `slot` (a part's
home). A part sends each bucket its hashes in one packed row; the bucket counts them in one task and
answers with a byte per hash. Answers are gathered by slot and joined to the parts there, so only
hashes and answers are shuffled and a text never travels. A hash that repeats inside a part is sent
once with its number: a passage that a third of all texts share costs its bucket a few bytes a part.
A slot holds a bounded number of parts, however much one task reads, and so does a row group of its
files, as Spark's reader holds all texts of a row group at once.

Rows sent are at most parts x buckets, and never more than hashes. With parts of 2 MB and buckets of
32 MB (sizes for executors of 3 GB), 30 GB of text send about 14 million rows of 370 word windows each,
1 TB about 16 billion of 11. There, raise part_text and lower buckets (both are parameters of the
operators) to what an executor holds: with 64 MB and 512 MB it is 30 million rows at 1 TB.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm.common import stage
from segmill.sources.staging import MOST_BUCKETS, bucket_homes, stage_bucketed

#: Bytes of text in a part, in a slot (what one task reads of the parts), and whose hashes go to one bucket, on average.
PART_TEXT, SLOT_TEXT, BUCKET_TEXT = 2 << 20, 16 << 20, 32 << 20
#: Bytes of text in a row group of the staged parts; one part at least.
ROW_GROUP_TEXT = 8 << 20
#: Texts in a part at most, however short: what numbers them takes 22 bits.
PART_ROWS = 1 << 22
#: Stands for a null doc_id: before all others.
LEAST = np.iinfo(np.int64).min

PARTS = (
    T.StructType().add("slot", T.LongType()).add("part", T.LongType()).add("doc_ids", T.ArrayType(T.LongType()))
    .add("keys", T.ArrayType(T.BinaryType())).add("texts", T.ArrayType(T.StringType()))
)
_ARROW_PARTS = pa.schema([("slot", pa.int64()), ("part", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.binary())), ("texts", pa.list_(pa.string()))])
_SENT = T.StructType().add("bucket", T.LongType()).add("slot", T.LongType()).add("part", T.LongType()).add("hashes", T.BinaryType()).add("repeated", T.BinaryType()).add("times", T.BinaryType())
_ANSWER = T.StructType().add("slot", T.LongType()).add("part", T.LongType()).add("bucket", T.LongType()).add("flags", T.BinaryType()).add("most", T.LongType())
#: Of a text with copies: no copy, the first of them, a later one.
ALONE, FIRST, LATER = 0, 1, 2


def keyed(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """(doc_id, key, text): null text as empty, and a digest of it."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")) if text is None else text
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text.cast("binary"))).alias("key"), text.alias("text"))


def slices(batch: pa.RecordBatch, text: int, most: int = PART_TEXT) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts are about `most` bytes together."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = (np.cumsum(sizes) - sizes) // most
    bounds = np.flatnonzero(np.diff(group, prepend=-1, append=-1)) if len(group) else []
    for first, last in zip(bounds, bounds[1:], strict=False):
        yield batch.slice(first, last - first)


def text_size(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def bucket_number(size: int, bucket_text: int = BUCKET_TEXT) -> int:
    return max(1, -(-size // bucket_text))


def slot_number(task: int, stretch: int, slots: int) -> int:
    """The slot of a task's stretch of text; stretches lie apart by the golden section, so that those of any number of tasks spread evenly."""
    return (task + round(stretch * slots * 0.6180339887)) % slots


def stage_parts(texts: DataFrame, size: int, most: int = PART_TEXT, slot_text: int = SLOT_TEXT) -> DataFrame:
    """The rows of texts(doc_id, key, text), `size` bytes of text, as a staged table of parts.

    There are as many slots as stretches of slot_text bytes, up to Spark's limit on buckets, and a task
    goes on to another slot after so many bytes.
    """
    slots = min(MOST_BUCKETS, bucket_number(size, slot_text))
    homes, slot_text = bucket_homes(texts.sparkSession, slots), max(slot_text, size // slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        part, held, bytes_held, rows_held, done = task << 20, [], 0, 0, 0

        def row() -> pa.RecordBatch:
            joined = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            ends = pa.array([0, joined.num_rows], pa.int32())
            slot = homes[slot_number(task, done // slot_text, slots)]
            return pa.RecordBatch.from_arrays([pa.array([slot]), pa.array([part]), *(pa.ListArray.from_arrays(ends, c) for c in joined.columns)], schema=_ARROW_PARTS)

        for batch in batches:
            for piece in slices(batch, 2, most):
                if held and rows_held + piece.num_rows > PART_ROWS:
                    yield row()
                    part, held, bytes_held, rows_held, done = part + 1, [], 0, 0, done + bytes_held
                held.append(piece)
                bytes_held += piece.column(2).nbytes
                rows_held += piece.num_rows
                if bytes_held >= most:
                    yield row()
                    part, held, bytes_held, rows_held, done = part + 1, [], 0, 0, done + bytes_held
        if held:
            yield row()

    return stage_bucketed(texts.select("doc_id", "key", "text").mapInArrow(run, PARTS), "slot", slots, group_rows=max(1, ROW_GROUP_TEXT // most))


@dataclass
class Part:
    slot: int
    part: int
    doc_ids: pa.Array
    keys: pa.Array
    texts: pa.Array
    rest: list  # what the part has heard

    def ids(self) -> np.ndarray:
        return pa.compute.fill_null(self.doc_ids, LEAST).to_numpy(zero_copy_only=False)

    def digests(self) -> np.ndarray:
        """(rows, 2): the halves of each key, as numbers that sort like it."""
        return np.frombuffer(b"".join(self.keys.to_pylist()), ">u8").reshape(-1, 2).astype(np.uint64)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(row of the least doc_id of each distinct text in order of keys, number of its text for each row)."""
        keys = self.digests()
        order = np.lexsort((self.ids(), keys[:, 1], keys[:, 0]))
        new = np.ones(len(order), bool)
        new[1:] = (keys[order][1:] != keys[order][:-1]).any(axis=1)
        text = np.empty(len(order), np.int64)
        text[order] = np.cumsum(new) - 1
        return order[new], text


def parts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Part]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids, keys, texts = (batch.column(k)[i].values for k in (2, 3, 4))
            yield Part(batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), ids, keys, texts, [c[i].as_py() for c in batch.columns[5:]])


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket by the upper half of a hash; in ascending order of hashes buckets ascend too."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, buckets that occur, bounds of each in the order); the order keeps that of the hashes."""
    bucket = bucket_of(hashes, buckets).astype(np.uint32)
    order = np.argsort(bucket, kind="stable")
    found, first = np.unique(bucket[order], return_index=True)
    return order, found.astype(np.int64), np.append(first, len(order))


def repeated_inside(hashes: np.ndarray) -> np.ndarray:
    """Which hashes occur more than once among themselves."""
    order = np.argsort(hashes)
    same = hashes[order][1:] == hashes[order][:-1]
    flags = np.zeros(len(hashes), bool)
    flags[order[1:][same]] = flags[order[:-1][same]] = True
    return flags


def _asked(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[int, tuple[slice, slice]]]:
    """What a part asks: (rows of hashes that occur once in it, by bucket; distinct repeated ones; their numbers; bucket's slices of both)."""
    local = repeated_inside(hashes)
    known, times = np.unique(hashes[local], return_counts=True)  # in ascending order, so by bucket too
    once = np.flatnonzero(~local)
    order, found, bounds = by_bucket(hashes[once], buckets)
    _, found_known, bounds_known = by_bucket(known, buckets)
    at = {b: (bounds[i], bounds[i + 1]) for i, b in enumerate(found.tolist())}
    at_known = {b: (bounds_known[i], bounds_known[i + 1]) for i, b in enumerate(found_known.tolist())}
    return once[order], known, times, {b: (slice(*at.get(b, (0, 0))), slice(*at_known.get(b, (0, 0)))) for b in sorted(at.keys() | at_known.keys())}


def ask(parts: DataFrame, hashes_of: Callable[[Part], np.ndarray], buckets: int, staged: bool = True) -> DataFrame:
    """(slot, said): for each slot, how often the hashes of its parts occur anywhere. What is read once need not be staged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts_of(batches):
            hashes = hashes_of(p)
            if not len(hashes):
                continue
            rows, known, times, at = _asked(hashes, buckets)
            columns = [pa.array(list(at), pa.int64()), pa.array([p.slot] * len(at), pa.int64()), pa.array([p.part] * len(at), pa.int64())]
            columns += [pa.array([hashes[rows[s]].tobytes() for s, _ in at.values()], pa.binary())]
            columns += [pa.array([x[t].tobytes() for _, t in at.values()], pa.binary()) for x in (known, times.astype("<i4"))]
            yield pa.RecordBatch.from_arrays(columns, names=_SENT.names)

    return gathered(parts.mapInArrow(run, _SENT).groupBy("bucket").applyInArrow(_answer, _ANSWER), "bucket", "flags", "most", staged=staged)


def gathered(rows: DataFrame, *columns: str, staged: bool = True) -> DataFrame:
    """(slot, said): what is said to the parts of each slot."""
    said = rows.groupBy("slot").agg(F.collect_list(F.struct("part", *columns)).alias("said"))
    return stage(said) if staged else said


def tell(parts: DataFrame, said: DataFrame, name: str) -> DataFrame:
    """parts with what was said to each of them; the texts stay in their buckets."""
    heard = said.select("slot", F.col("said").alias(name))
    return parts.join(heard.hint("shuffle_hash"), "slot", "left").withColumn(name, F.filter(name, lambda x: x["part"] == F.col("part")))


def _joined(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    raw = column.to_pylist()
    size = np.dtype(kind).itemsize
    return np.frombuffer(b"".join(raw), kind), np.cumsum([0, *(len(x) // size for x in raw)])


def number_class(times: np.ndarray) -> np.ndarray:
    """0 for what occurs once, else 1 + log2 of how often."""
    return np.where(times > 1, 1 + np.log2(np.maximum(times, 1)), 0).astype(np.uint8)


def _answer(table: pa.Table) -> pa.Table:
    """For each part, a byte per hash that it sent to this bucket: the class of its number in all parts."""
    (hashes, ends), (known, ends_known) = _joined(table["hashes"], np.uint64), _joined(table["repeated"], np.uint64)
    every = np.concatenate([hashes, known])
    times = np.concatenate([np.ones(len(hashes), np.int64), _joined(table["times"], "<i4")[0]])
    order = np.argsort(every)
    new = np.ones(len(order), bool)
    new[1:] = every[order][1:] != every[order][:-1]
    starts = np.flatnonzero(new)
    flags = np.empty(len(order), np.uint8)
    if len(starts):
        flags[order] = np.repeat(number_class(np.add.reduceat(times[order], starts)), np.diff(starts, append=len(order)))
    rows = []
    for s, p, b, i, j, k, m in zip(*(table[c].to_pylist() for c in ("slot", "part", "bucket")), ends.tolist(), ends[1:].tolist(), (len(hashes) + ends_known).tolist(), (len(hashes) + ends_known[1:]).tolist(), strict=False):
        if m > k or flags[i:j].any():
            own = np.concatenate([flags[i:j], flags[k:m]])
            rows.append((s, p, b, own.tobytes(), int(own.max())))
    return _answers(rows)


def _answers(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * len(_ANSWER)
    return pa.table({n: pa.array(c, pa.binary() if n == "flags" else pa.int64()) for n, c in zip(_ANSWER.names, columns, strict=True)})


def heard(hashes: np.ndarray, said: list[dict] | None, buckets: int) -> np.ndarray:
    """The class of each of a part's hashes: 0 if it occurs nowhere else."""
    flags = np.zeros(len(hashes), np.uint8)
    if not said:
        return flags
    rows, known, _, at = _asked(hashes, buckets)
    of_known = np.zeros(len(known), np.uint8)
    for a in said:
        own, twice = at[a["bucket"]]
        got, n = np.frombuffer(a["flags"], np.uint8), own.stop - own.start
        flags[rows[own]], of_known[twice] = got[:n], got[n:]
    if len(known):
        place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        local = known[place] == hashes
        flags[local] = of_known[place[local]]
    return flags


def ask_copies(parts: DataFrame, buckets: int) -> DataFrame:
    """(slot, said): for each distinct text of a part, whether it is alone, the first of its copies or a later one.

    A part sends each of its distinct texts once, so a text that a third of all rows repeat costs a row
    of 24 bytes a part. The first has the least doc_id (a null one before all), then the least part.
    """
    sent = T.StructType().add("bucket", T.LongType()).add("slot", T.LongType()).add("part", T.LongType()).add("keys", T.BinaryType()).add("ids", T.BinaryType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts_of(batches):
            rows, text = p.distinct()
            keys, ids = p.digests()[rows], p.ids()[rows]
            _, found, bounds = by_bucket(keys[:, 0], buckets)
            cuts = list(zip(bounds.tolist(), bounds[1:].tolist(), strict=False))
            columns = [pa.array(found), pa.array([p.slot] * len(found), pa.int64()), pa.array([p.part] * len(found), pa.int64())]
            columns += [pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary()) for x in (keys, ids)]
            yield pa.RecordBatch.from_arrays(columns, names=sent.names)

    return gathered(parts.mapInArrow(run, sent).groupBy("bucket").applyInArrow(_first_copies, _ANSWER), "bucket", "flags")


def _first_copies(table: pa.Table) -> pa.Table:
    keys, (ids, ends) = _joined(table["keys"], np.uint64)[0].reshape(-1, 2), _joined(table["ids"], np.int64)
    slot, part, bucket = (table[c].to_pylist() for c in ("slot", "part", "bucket"))
    order = np.lexsort((np.repeat(np.array(part, np.int64), np.diff(ends)), ids, keys[:, 1], keys[:, 0]))
    same = (keys[order][1:] == keys[order][:-1]).all(axis=1)
    state = np.full(len(order), ALONE, np.uint8)
    state[order[:-1][same]] = FIRST
    state[order[1:][same]] = LATER
    return _answers([(s, p, b, state[i:j].tobytes(), int(state[i:j].max())) for s, p, b, i, j in zip(slot, part, bucket, ends.tolist(), ends[1:].tolist(), strict=False) if state[i:j].any()])


def heard_copies(p: Part, said: list[dict] | None, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows and numbers of distinct(), ALONE, FIRST or LATER of each distinct text)."""
    rows, text = p.distinct()
    state = np.where(np.bincount(text) > 1, FIRST, ALONE).astype(np.uint8)
    if said:
        _, found, bounds = by_bucket(p.digests()[rows, 0], buckets)
        at = {b: slice(bounds[i], bounds[i + 1]) for i, b in enumerate(found.tolist())}
        for a in said:
            state[at[a["bucket"]]] = np.maximum(state[at[a["bucket"]]], np.frombuffer(a["flags"], np.uint8))
    return rows, text, state
