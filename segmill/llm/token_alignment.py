"""Which tokens of two tokenizers stand for the same bytes, and how typical each pairing is.

A text's bytes carry a label each: no token ends there, one of A, one of B, or one of both. A regular
expression cuts the labels into spans up to each byte where both end; the labels in a span count its
tokens of A and of B, and these are a group. Every token of A in a group is linked with every one of
B; a pair of ids counts the documents of the whole corpus that hold it linked.

Texts are worked through in parts of bounded size. A part keeps each document's pairs as places in
the part's own list of distinct pairs, and only that list is shuffled: to count pairs (combined before
the shuffle), and to bring the counts back. Pairs that nearly every part holds are broadcast, at most
MOST_HOT of them; so is the highest count of each id of A, of which there are as many as vocabulary
entries. Texts and tokens never travel.

Cases: a null or empty text, or one whose tokens' bytes are not its own, has no tokens (zeros, ''); a
null or repeated doc_id and repeated rows are ordinary documents, each counted; a group of any size
has all its links (large ones by distinct ids); an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm.common import configure, join_counted, ragged, stage, text_bytes
from segmill.llm.parts import slices
from segmill.llm.tokens import ByteLevelEncoder, PieceEncoder, TokenBytes, tokenizer_path

#: Bytes of text in a part, and of those aligned at once.
PART_TEXT, SLICE_TEXT = 8 << 20, 2 << 20
#: Pairs that are broadcast at most, each with at least that share of all parts' pairs.
MOST_HOT = 20_000
#: Groups with more links than this are linked by their distinct ids; ids paired at once; labels scanned at once.
MANY_LINKS, PAIRED, SCANNED = 4096, 1 << 20, 1 << 20
#: Letters of the labels 0 to 3, and a span.
LABELS, SPAN = np.frombuffer(b"-ab+", np.uint8), re.compile(rb"[^+]*\+")
#: Tokens whose ids are written as text at once, and digits of an id at most.
WRITTEN, DIGITS = 1 << 18, 10

PARTS = (
    T.StructType().add("part", T.LongType()).add("doc_ids", T.ArrayType(T.LongType())).add("numbers", T.BinaryType()).add("digests", T.ArrayType(T.StringType()))
    .add("index", T.BinaryType()).add("times", T.BinaryType()).add("pairs", T.ArrayType(T.LongType())).add("docs", T.ArrayType(T.LongType()))
)
_LONGS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
RESULT = T.StructType([T.StructField("doc_id", T.LongType()), *(T.StructField(n, T.LongType()) for n in _LONGS), T.StructField("groups_sha256", T.StringType())])
#: Numbers of a document in a part: four counts and its pairs.
_NUMBERS = 5


class SpanCounts(dict):
    """(tokens of A << 32 | tokens of B) of a span, by its labels; short spans are remembered."""

    MOST, LONGEST = 100_000, 64

    def __missing__(self, span: bytes) -> int:
        found = (span.count(b"a") + 1) << 32 | (span.count(b"b") + 1)
        if len(span) <= self.LONGEST and len(self) < self.MOST:
            self[span] = found
        return found


def scan_spans(labels: bytes, known: SpanCounts) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B in each span up to a byte where both end."""
    counts, at = [np.empty(0, np.int64)], 0
    while at < len(labels):
        stop = labels.find(b"+", min(at + SCANNED, len(labels) - 1)) + 1 or len(labels)
        spans = SPAN.findall(labels, at, stop)
        counts.append(np.fromiter(map(known.__getitem__, spans), np.int64, len(spans)))
        at = stop
    both = np.concatenate(counts)
    return both >> 32, both & 0xFFFFFFFF


@dataclass
class Aligned:
    """Tokens of some texts, and their groups."""

    a: np.ndarray
    b: np.ndarray
    of_a: np.ndarray  # tokens of A in each group
    of_b: np.ndarray
    cuts_a: np.ndarray  # tokens of A before each text, n + 1
    cuts_b: np.ndarray
    cuts: np.ndarray  # groups before each text


def _before(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def _own_bytes(ids: np.ndarray, cuts: np.ndarray, vocabulary: TokenBytes, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, whether its tokens' bytes are its own."""
    ends = _before(vocabulary.lengths[ids])[cuts]
    right = np.diff(ends) == np.diff(offsets)
    kept = ids if right.all() else ids[np.repeat(right, np.diff(cuts))]
    own = data if right.all() else data[ragged(offsets[:-1][right], np.diff(offsets)[right])]
    sums = _before(vocabulary.joined(kept) != own)[_before(np.diff(offsets)[right])]
    right[right] = np.diff(sums) == 0
    return right


def align_texts(column: pa.Array, first: ByteLevelEncoder, second: PieceEncoder, bytes_a: TokenBytes, bytes_b: TokenBytes, known: SpanCounts) -> Aligned:
    """Groups of texts that begin with the space that the second tokenizer adds; '' has none."""
    data, offsets = text_bytes(column)
    a, cuts_a = first.encode(column)
    b, cuts_b = second.encode(column)
    right = _own_bytes(a, cuts_a, bytes_a, data, offsets) & _own_bytes(b, cuts_b, bytes_b, data, offsets)
    if not right.all():
        a, b = a[np.repeat(right, np.diff(cuts_a))], b[np.repeat(right, np.diff(cuts_b))]
        cuts_a, cuts_b = (_before(np.where(right, np.diff(c), 0)) for c in (cuts_a, cuts_b))
    texts = _before(np.where(right, np.diff(offsets), 0))
    labels = np.zeros(texts[-1], np.uint8)
    labels[np.cumsum(bytes_a.lengths[a]) - 1] |= 1
    labels[np.cumsum(bytes_b.lengths[b]) - 1] |= 2
    of_a, of_b = scan_spans(LABELS[labels].tobytes(), known)
    return Aligned(a, b, of_a, of_b, cuts_a, cuts_b, np.searchsorted(np.flatnonzero(labels == 3), texts))


def group_digests(x: Aligned) -> list[str]:
    """SHA-256 of each text's groups in writing: ids of A, |, ids of B, groups parted by ; ('' without tokens)."""
    first_a, first_b, cuts = _before(x.of_a), _before(x.of_b), x.cuts_a + x.cuts_b
    ends = cuts[1:][np.diff(cuts) > 0] - 1  # the last token of each text has nothing after it
    hashes = [hashlib.sha256() for _ in range(len(cuts) - 1)]
    for low, high in _blocks(x.of_a + x.of_b, WRITTEN):
        at, stop = first_a[low] + first_b[low], first_a[high] + first_b[high]
        a, b, groups = x.a[first_a[low] : first_a[high]], x.b[first_b[low] : first_b[high]], np.arange(high - low)
        of_a, of_b = first_a[low : high + 1] - first_a[low], first_b[low : high + 1] - first_b[low]
        at_a = np.arange(len(a)) + of_b[np.repeat(groups, np.diff(of_a))]
        at_b = np.arange(len(b)) + of_a[np.repeat(groups, np.diff(of_b)) + 1]
        own, mark = np.empty(stop - at, np.int64), np.full(stop - at, ord(","), np.uint8)
        own[at_a], own[at_b] = a, b
        mark[at_a[of_a[1:] - 1]], mark[at_b[of_b[1:] - 1]] = ord("|"), ord(";")
        shown = np.zeros((stop - at, DIGITS + 1), np.uint8)
        size = np.ones(stop - at, np.int64)
        for k in range(1, DIGITS):
            size += own >= 10**k
        for k in range(int(size.max())):
            rows = size > k
            shown[rows, k] = ord("0") + own[rows] // 10 ** (size[rows] - 1 - k) % 10
        shown[np.arange(stop - at), size] = mark
        size += 1
        size[ends[(ends >= at) & (ends < stop)] - at] -= 1
        raw, written = shown[np.arange(DIGITS + 1) < size[:, None]].tobytes(), _before(size)
        for k in range(int(np.searchsorted(cuts, at, side="right")) - 1, int(np.searchsorted(cuts, stop))):
            a, b = max(cuts[k], at), min(cuts[k + 1], stop)
            if b > a:
                hashes[k].update(raw[written[a - at] : written[b - at]])
    return [h.hexdigest() if size else "" for h, size in zip(hashes, np.diff(cuts).tolist(), strict=True)]


def _blocks(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges (low, high) of groups whose sizes add up to about `most`."""
    ends, low = np.cumsum(sizes), 0
    while low < len(sizes):
        high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + most, side="right")))
        yield low, high
        low = high


def _summed(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of each one's times."""
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1)) if len(keys) else np.empty(0, np.int64)
    return keys[starts], np.add.reduceat(times, starts) if len(starts) else times


def linked_pairs(x: Aligned, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pair, times) of all links, in order of both: a pair is its id of A times the vocabulary of B plus its id of B."""
    first_a, first_b, links = _before(x.of_a), _before(x.of_b), x.of_a * x.of_b
    text = np.repeat(np.arange(len(x.cuts) - 1), np.diff(x.cuts))
    bits, found = (int(x.a.max(initial=0)) * vocabulary + vocabulary).bit_length(), [(np.empty(0, np.int64), np.empty(0, np.int64))]
    few = np.flatnonzero(links <= MANY_LINKS)
    for low, high in _blocks(links[few], PAIRED):
        block = few[low:high]
        own, at = np.repeat(block, links[block]), ragged(np.zeros(len(block), np.int64), links[block])
        pair = x.a[first_a[own] + at // x.of_b[own]].astype(np.int64) * vocabulary + x.b[first_b[own] + at % x.of_b[own]]
        found.append(_summed(text[own] << bits | pair, np.ones(len(pair), np.int64)))
    for g in np.flatnonzero(links > MANY_LINKS).tolist():
        ids_a, times_a = np.unique(x.a[first_a[g] : first_a[g + 1]], return_counts=True)
        ids_b, times_b = np.unique(x.b[first_b[g] : first_b[g + 1]], return_counts=True)
        for k in range(0, len(ids_a), step := max(1, PAIRED // len(ids_b))):
            pair = (ids_a[k : k + step, None].astype(np.int64) * vocabulary + ids_b).ravel()
            found.append(_summed(text[g] << bits | pair, (times_a[k : k + step, None] * times_b).ravel()))
    keys, times = _summed(*(np.concatenate([f[k] for f in found]) for k in range(2)))
    return keys >> bits, keys & ((1 << bits) - 1), times


def align_parts(docs: DataFrame, path_a: str, path_b: str, vocabulary: int, part_text: int) -> DataFrame:
    """One row per part of the texts: what is known of its documents, and its distinct pairs with the documents that hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = ByteLevelEncoder(path_a, plain_specials=True), PieceEncoder(path_b)
        bytes_a, bytes_b, known = TokenBytes.of_byte_level(path_a), TokenBytes.of_pieces(path_b), SpanCounts()
        part, held, size = TaskContext.get().partitionId() << 33, [], 0

        def row() -> pa.RecordBatch:
            doc_ids, numbers, digests, pairs, times = ([h[k] for h in held] for k in range(5))
            distinct, index, docs = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
            one = [
                part, [i for ids in doc_ids for i in ids.to_pylist()], np.concatenate(numbers).astype("<i8").tobytes(), [d for own in digests for d in own],
                index.astype("<u4").tobytes(), np.concatenate(times).astype("<i8").tobytes(), distinct, docs,
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], f) for v, f in zip(one, _ARROW_PARTS.types, strict=True)], schema=_ARROW_PARTS)

        for batch in batches:
            for piece in slices(batch, 1, SLICE_TEXT):
                x = align_texts(piece.column(1), first, second, bytes_a, bytes_b, known)
                text, pairs, times = linked_pairs(x, vocabulary)
                links = np.diff(_before(x.of_a * x.of_b)[x.cuts])
                numbers = np.stack([np.diff(x.cuts_a), np.diff(x.cuts_b), np.diff(x.cuts), links, np.bincount(text, minlength=piece.num_rows)], axis=1)
                held.append((piece.column(0), numbers, group_digests(x), pairs, times))
                size += piece.column(1).nbytes
                if size >= part_text:
                    yield row()
                    part, held, size = part + 1, [], 0
        if held:
            yield row()

    body = F.when(F.length("text") > 0, F.concat(F.lit(" "), F.col("text"))).otherwise("")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).select("doc_id", body).mapInArrow(run, PARTS)


_ARROW_PARTS = pa.schema([
    ("part", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("numbers", pa.binary()), ("digests", pa.list_(pa.string())),
    ("index", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64())),
])


def pair_counts(asked: DataFrame, vocabulary: int) -> DataFrame:
    """(pair, count, n, best): documents that link each pair, parts that hold it, whether no other pair of its id of A counts more."""
    counts = stage(asked.groupBy("pair").agg(F.sum("docs").alias("count"), F.count(F.lit(1)).alias("n")).withColumn("a", F.floor(F.col("pair") / vocabulary)))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))  # a row per entry of the vocabulary at most
    return stage(counts.join(F.broadcast(highest), "a").select("pair", "count", "n", (F.col("count") == F.col("highest")).alias("best")))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts with the counts of their pairs: one row per document."""
    for batch in batches:
        for k in range(batch.num_rows):
            doc_ids, numbers, digests, index, times, places, found, best = (batch.column(c)[k] for c in range(batch.num_columns))
            own = np.frombuffer(numbers.as_py(), "<i8").reshape(-1, _NUMBERS)
            place, times = np.frombuffer(index.as_py(), "<u4"), np.frombuffer(times.as_py(), "<i8")
            count, top = np.zeros((2, int(place.max(initial=0)) + 1), np.int64)
            if places.is_valid:
                at = places.values.to_numpy()
                count[at], top[at] = found.values.to_numpy(), best.values.to_numpy(zero_copy_only=False)
            ends = _before(own[:, 4])
            n_best, count_sum = (np.diff(_before(times * x[place])[ends]) for x in (top, count))
            columns = [doc_ids.values, *(pa.array(np.ascontiguousarray(own[:, c])) for c in range(4)), pa.array(n_best), pa.array(count_sum), digests.values]
            yield pa.RecordBatch.from_arrays(columns, names=RESULT.names)


def align_tokenizers(spark: SparkSession, docs: DataFrame, path_a: str | None = None, path_b: str | None = None, part_text: int = PART_TEXT, most_hot: int = MOST_HOT) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    from sentencepiece import SentencePieceProcessor

    configure(spark)
    path_a, path_b = path_a or tokenizer_path("byte_bpe_50k.json"), path_b or tokenizer_path("piece_bpe_32k.model")
    vocabulary = SentencePieceProcessor(model_file=path_b).get_piece_size()
    parts = stage(align_parts(docs, path_a, path_b, vocabulary, part_text))
    asked = parts.select("part", F.posexplode(F.arrays_zip("pairs", "docs")).alias("place", "p")).select("part", "place", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    told = join_counted(asked.drop("docs"), pair_counts(asked, vocabulary), "pair", most_hot)
    listed = told.groupBy("part").agg(F.collect_list(F.struct("place", "count", "best")).alias("told"))  # of one part, so bounded by its size
    joined = parts.drop("pairs", "docs").join(listed, "part", "left")
    slim = joined.select("doc_ids", "numbers", "digests", "index", "times", F.col("told.place").alias("place"), F.col("told.count").alias("count"), F.col("told.best").alias("best"))
    return slim.mapInArrow(_documents, RESULT)
