"""What each of five filters removes in every order of them, from packed bitmaps.

Each document fails some of the filters A to E. In the tasks, documents become numpy bitsets: one bit
a document for each filter and label, with the documents of one part in words of their own. For each
of the 32 sets of filters, AND-NOT leaves the documents that pass all of them, and a popcount over a
part's words counts them; Spark adds up the counts. All 600 rows of a part follow from these 32 sums:
what filter f removes after a set S is what S leaves less what S with f leaves.

Equal texts meet by their SHA-256. Rows of 60 bytes are shuffled, never texts; digests with a large
share of all rows (copies) are broadcast, at most so many as common.MOST_HOT.

Cases: null text is empty (it fails A); a null source is the part ''; a null doc_id comes before all
others and has no label; of rows with one doc_id and equal texts none is a copy of the other; several
label rows of a doc_id count as their maximum, null as 0; an empty table gives no row; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm.common import configure, join_counted, ragged, stage, text_bytes

FILTERS = "ABCDE"
#: Least words, least share of distinct words and largest share of capitals (in hundredths), characters of junk.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, JUNK = 50, 65, 5, b"#$%&*|"
#: Documents that become one bitset.
BLOCK_ROWS = 1 << 18
#: Bytes of a text whose words are cut at once.
STRETCH = 1 << 22
_ORDERS = ["".join(p) for p in permutations(FILTERS)]
_SETS = 1 << len(FILTERS)

FLAGS = T.StructType().add("row", T.LongType()).add("doc_id", T.LongType()).add("part", T.StringType()).add("digest", T.BinaryType()).add("fails", T.IntegerType())
COUNTS = T.StructType().add("part", T.StringType()).add("passed", T.IntegerType()).add("n", T.LongType()).add("good", T.LongType()).add("toxic", T.LongType())
_NUMBERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
RESULT = T.StructType([T.StructField("part", T.StringType()), T.StructField("filter_order", T.StringType()), T.StructField("step", T.IntegerType()), *(T.StructField(n, T.LongType()) for n in _NUMBERS)])


def word_counts(text: memoryview) -> tuple[int, int]:
    """(words, distinct words) of UTF-8 bytes, in stretches that end at white space; memory grows with the distinct words."""
    words, seen, rest = 0, set(), b""
    for at in range(0, len(text), STRETCH):
        piece = rest + bytes(text[at : at + STRETCH])
        found = piece.split()
        rest = found.pop() if found and not piece[-1:].isspace() else b""
        words += len(found)
        seen.update(found)
    if rest:
        words += 1
        seen.add(rest)
    return words, len(seen)


def text_flags(column: pa.Array) -> np.ndarray:
    """Bits 0 to 3: whether each text fails A to D."""
    data, offsets = text_bytes(column)
    raw = memoryview(data)
    counted = [word_counts(raw[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
    words, distinct = np.array(counted, np.int64).reshape(-1, 2).T
    per_text = lambda flags: np.array([np.count_nonzero(flags[a:b]) for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)], np.int64)
    points, capitals = per_text((data & 0xC0) != 0x80), per_text((data >= 65) & (data <= 90))
    junk = per_text(np.isin(data, np.frombuffer(JUNK, np.uint8)))
    fails = [words < LEAST_WORDS, 100 * distinct < LEAST_DISTINCT * words, 100 * capitals > MOST_CAPITALS * points, junk > 0]
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def flagged(docs: DataFrame) -> DataFrame:
    """One slim row per document: its number, doc_id, part, digest of its text, bits of the filters that its text fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            raw = memoryview(data)
            digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False)]
            rows = pa.array(np.arange(row, row + len(digests)))
            row += len(digests)
            yield pa.RecordBatch.from_arrays([rows, batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(text_flags(batch.column(2)), pa.int32())], names=FLAGS.names)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, FLAGS)


def with_copies(flags: DataFrame) -> DataFrame:
    """Bit 4 as well: a smaller doc_id (null before all) has the same text."""
    least = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id")  # sorts null first
    groups = stage(flags.groupBy("digest").agg(F.min(least).alias("least"), F.count(F.lit(1)).alias("n")))
    joined = join_counted(flags, groups, "digest")
    return joined.withColumn("fails", F.col("fails") + F.when(least > F.col("least"), 1 << 4).otherwise(0)).select("row", "doc_id", "part", "fails")


def with_labels(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """flags with good and toxic; rows without a doc_id have no label and meet none."""
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    spread = F.when(F.col("doc_id").isNull(), F.col("row")).otherwise(-1)  # rows without a doc_id would all come to one task
    joined = flags.withColumn("spread", spread).join(known.withColumn("spread", F.lit(-1).cast("long")), ["doc_id", "spread"], "left")
    return joined.select("part", "fails", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))


def packed_bits(flags: np.ndarray, place: np.ndarray, words: int) -> np.ndarray:
    """A bitset of so many 64-bit words with the flags at their places."""
    bits = np.zeros(64 * words, np.uint8)
    bits[place] = flags
    return np.packbits(bits, bitorder="little").view(np.uint64)


def set_counts(part: np.ndarray, fails: np.ndarray, labels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(parts that occur, counts[part, labels + 1, set]): documents that pass every filter of a set; all, and those with each label.

    part numbers the rows' parts. Each part's documents begin a word of their own, so a part is a run of words.
    """
    order = np.argsort(part, kind="stable")
    found, sizes = np.unique(part[order], return_counts=True)
    words = -(-sizes // 64)
    place = ragged(64 * (np.cumsum(words) - words), sizes)
    total, starts = int(words.sum()), np.cumsum(words) - words
    bits = lambda flags: packed_bits(flags[order], place, total)
    members = [bits(np.ones(len(part), bool)), *(bits(x) for x in labels)]
    failing = [bits(fails >> k & 1) for k in range(len(FILTERS))]
    any_of = np.zeros((_SETS, total), np.uint64)
    counts = np.zeros((len(found), len(members), _SETS), np.int64)
    for s in range(_SETS):
        if s:
            low = s & -s
            any_of[s] = any_of[s ^ low] | failing[low.bit_length() - 1]
        for m, member in enumerate(members):
            counts[:, m, s] = np.add.reduceat(np.bitwise_count(member & ~any_of[s]).astype(np.int64), starts)
    return found, counts


def count_sets(rows: DataFrame) -> DataFrame:
    """(part, passed, n, good, toxic): for each part and set of filters, the documents that pass all of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            coded = table["part"].combine_chunks().dictionary_encode()
            number = lambda c: table[c].to_numpy()
            found, counts = set_counts(coded.indices.to_numpy(), number("fails"), [number("good"), number("toxic")])
            names = coded.dictionary.take(pa.array(np.repeat(found, _SETS)))
            passed = pa.array(np.tile(np.arange(_SETS, dtype=np.int32), len(found)))
            return pa.RecordBatch.from_arrays([names, passed, *(pa.array(counts[:, m].ravel()) for m in range(3))], names=COUNTS.names)

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield counted()
                held, n = [], 0
        if n:
            yield counted()

    return rows.mapInArrow(run, COUNTS).groupBy("part", "passed").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def order_rows(n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """The 600 rows of a part from what each of the 32 sets leaves of it."""
    steps = [(order, step, sum(1 << FILTERS.index(f) for f in order[: step - 1]), FILTERS.index(order[step - 1])) for order in _ORDERS for step in range(1, len(FILTERS) + 1)]
    before, own = np.array([s[2] for s in steps]), np.array([s[3] for s in steps])
    after, others = before | 1 << own, (_SETS - 1) & ~(1 << own)
    removed = n[before] - n[after]
    shapley = [sum(factorial(s.bit_count()) * factorial(len(FILTERS) - 1 - s.bit_count()) * int(n[s] - n[s | 1 << f]) for s in range(_SETS) if not s >> f & 1) for f in range(len(FILTERS))]
    return {
        "filter_order": np.array([s[0] for s in steps]), "step": np.array([s[1] for s in steps], np.int32), "kept": n[after], "removed": removed,
        "redundant": n[0] - n[1 << own] - removed, "unique_fails": n[others] - n[_SETS - 1],
        "good_lost": good[before] - good[after], "toxic_lost": toxic[before] - toxic[after], "shapley": np.array(shapley, np.int64)[own],
    }


def filter_audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """600 rows per part: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    configure(spark)
    rows = with_labels(with_copies(stage(flagged(docs))), labels)

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("passed")
        found = order_rows(*(pdf[c].to_numpy() for c in ("n", "good", "toxic")))
        return pd.DataFrame({"part": key[0], **found})[RESULT.names]

    return count_sets(rows).groupBy("part").applyInPandas(run, RESULT)
