"""Substring deduplication by suffix sorting: bytes of 100-byte strings that start earlier too.

Sorting every suffix of the corpus would shuffle it many times over, so strings meet by content: a
100-byte string's anchor is its byte 24-gram of least hash (leftmost of equals). Equal strings have
equal anchors at equal places. First only the hashes of anchors travel and are counted. For anchors
that occur again, the bytes around them (of all strings that own the anchor) go to the task of the
anchor's hash. There, for every such anchor, the suffixes that start at its places are sorted
deep-shallow, and so are the reversed bytes before them: multikey quicksort on blocks of eight bytes
to a shallow depth, then a blind trie for each group that still shares its prefix. Neighbours' common
prefixes in these two orders say which strings are equal: those whose b bytes before the anchor and
100 - b bytes from it on lie in one run each. In each class all but the earliest are repeats.

Skew: a part of the texts sends equal surroundings of one anchor once (the earliest; its other places
are repeats on the spot), and of copies of a whole text only the first takes part. An anchor with many
different surroundings all the same (class HOT) is split: its strings ask one by one whether they
occur again, and those that do go to the tasks of their own hashes, again once a part.

Order: smaller doc_id first (a null one before all), then the text's digest; of repeated rows with one
doc_id and one text any one is first. Null text is empty; texts under 100 bytes are kept; a text of
any length is worked through in stretches; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm import hashing
from segmill.llm.common import binary_bytes, configure, ragged, stage, text_bytes
from segmill.llm.parts import LATER, PART_TEXT, Part, ask, ask_copies, bucket_number, by_bucket, heard, heard_copies, keyed, parts_of, stage_parts, tell, text_size

LENGTH = 100
GRAM = 24
#: Depth to which multikey quicksort goes before blind tries take over.
SHALLOW = 64
#: Class (1 + log2 of the number of places) from which on an anchor is split by its strings.
HOT = 13
#: Bytes of text whose anchors are counted, and whose surroundings are sorted, in one bucket on average.
ANCHOR_TEXT, AROUND_TEXT = 64 << 20, 8 << 20
#: Strings that are hashed, places whose bytes are listed, and places that are sorted at once (those of one anchor together).
_STRINGS, _PLACES, _SORTED = 1 << 18, 1 << 13, 1 << 15

RESULT = T.StructType().add("doc_id", T.LongType()).add("n_bytes", T.LongType()).add("n_removed", T.LongType()).add("n_spans", T.LongType()).add("kept_sha256", T.StringType())
_AROUND = T.StructType().add("bucket", T.LongType()).add("slot", T.LongType()).add("part", T.LongType()).add("docs", T.BinaryType()).add("places", T.BinaryType()).add("bytes", T.BinaryType())
_RUNS = T.StructType().add("slot", T.LongType()).add("part", T.LongType()).add("runs", T.BinaryType())
_DOC = np.dtype([("doc_id", "<i8"), ("high", "<u8"), ("low", "<u8"), ("row", "<i4")])
_PLACE = np.dtype([("hash", "<u8"), ("start", "<i8"), ("strings", "<i4"), ("back", "<i4"), ("doc", "<i4")])


@dataclass
class Places:
    """Anchors of texts: their hash, the first of their strings (in the joined bytes), how many, the anchor itself, the text."""

    hash: np.ndarray
    first: np.ndarray
    strings: np.ndarray
    at: np.ndarray
    text: np.ndarray

    def take(self, rows: np.ndarray) -> Places:
        return Places(*(x[rows] for x in (self.hash, self.first, self.strings, self.at, self.text)))


def anchors_of(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> Places:
    """All anchors in order of their texts and places."""
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    found, wide = [], length - gram + 1
    for low in range(0, max(len(data) - length + 1, 0), _STRINGS):
        high = min(low + _STRINGS, len(data) - length + 1)  # strings low:high, if they lie in one text
        hashes = hashing.rolling(data[low : high + length - 1], gram, hashing.BYTE_BASE)
        least = hashes & ~np.uint64(0xFFFFFFFF) | np.arange(len(hashes), dtype=np.uint64)  # of equals the leftmost
        width = 1
        while width < wide:
            step = min(width, wide - width)
            least = np.minimum(least[step:], least[: len(least) - step])
            width += step
        a, b = np.searchsorted(offsets, low, side="right") - 1, np.searchsorted(offsets, high)
        starts = np.maximum(offsets[a:b], low)
        number = np.maximum(np.minimum(offsets[a:b] + counts[a:b], high) - starts, 0)
        strings, text = ragged(starts - low, number), np.repeat(np.arange(a, b), number)
        owner = (least[strings] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.ones(len(strings), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        # an anchor's hash is a least one, so small: mixed, anchors spread evenly over buckets
        found.append((hashing.mix(hashes[owner[first]]), strings[first] + low, np.diff(first, append=len(strings)), owner[first] + low, text[first]))
    if not found:
        return Places(np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(4)))
    places = Places(*(np.concatenate(x) for x in zip(*found, strict=True)))
    # a place that a stretch's end has cut in two is one
    new = np.ones(len(places.at), bool)
    new[1:] = (places.at[1:] != places.at[:-1]) | (places.text[1:] != places.text[:-1])
    rows = np.flatnonzero(new)
    strings = np.add.reduceat(places.strings, rows) if len(rows) else places.strings
    places = places.take(rows)
    places.strings = strings
    return places


def first_equal(data: np.ndarray, hashes: np.ndarray, first: np.ndarray, sizes: np.ndarray, back: np.ndarray) -> np.ndarray:
    """For each span, the number of the first one with its hash, place in it and bytes."""
    out = np.arange(len(hashes))
    order = np.lexsort((out, hashes))
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(order), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    rows = np.flatnonzero(twice)
    if not len(rows):
        return out
    content = hashing.of_spans(data, first[rows], sizes[rows], hashing.BYTE_BASE)
    by = np.lexsort((rows, back[rows], sizes[rows], content, hashes[rows]))
    rows, content = rows[by], content[by]
    new = np.ones(len(rows), bool)
    new[1:] = (content[1:] != content[:-1]) | (hashes[rows[1:]] != hashes[rows[:-1]]) | (sizes[rows[1:]] != sizes[rows[:-1]]) | (back[rows[1:]] != back[rows[:-1]])
    head = rows[np.maximum.accumulate(np.where(new, np.arange(len(rows)), 0))]
    later = np.flatnonzero(~new)
    for i in range(0, len(later), _PLACES):
        some = later[i : i + _PLACES]
        mine, its, size = rows[some], head[some], sizes[rows[some]]
        equal = np.logical_and.reduceat(data[ragged(first[mine], size)] == data[ragged(first[its], size)], np.cumsum(size) - size)
        out[mine[equal]] = its[equal]  # equal hashes of different bytes stay apart
    return out


class BlindTrie:
    """Sorts strings of one length that share a prefix; nodes know where they branch, not what lies between.

    A new string walks down by its branching bytes alone, is compared once with the leaf it ends at,
    and branches off at the first byte that differs. Strings without a difference share a leaf.
    """

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, string: bytes, item: int) -> None:
        if self.root is None:
            self.root = [len(string), string, [item]]
            return
        node = self.root
        while isinstance(node[2], dict):
            node = node[2].get(string[node[0]]) or next(iter(node[2].values()))
        if node[1] == string:
            node[2].append(item)
            return
        differ = int.from_bytes(node[1], "big") ^ int.from_bytes(string, "big")
        depth = len(string) - (differ.bit_length() + 7) // 8
        other = node[1]
        node = self.root
        while isinstance(node[2], dict) and node[0] < depth:
            node = node[2][string[node[0]]]
        leaf = [len(string), string, [item]]
        if isinstance(node[2], dict) and node[0] == depth:
            node[2][string[depth]] = leaf
        else:
            node[:] = [depth, b"", {other[depth]: list(node), string[depth]: leaf}]

    def leaves(self) -> Iterator[list[int]]:
        """Items of equal strings, in the order of the strings."""
        todo = [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if isinstance(node[2], dict):
                todo.extend(child for _, child in sorted(node[2].items(), reverse=True))
            else:
                yield node[2]


def multikey_quicksort(blocks: np.ndarray, group: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, first place of each place's segment): rows by group, then by their first `shallow` blocks.

    Three-way partitioning: a segment is split at the block of its middle row into smaller, equal and
    larger ones, and the equal ones go on with the next block. All segments take a step at once.
    """
    n = len(group)
    order = np.argsort(group, kind="stable")
    segment = np.zeros(n, np.int64)
    if n:
        new = np.diff(group[order], prepend=group[order[0]]) != 0
        segment = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    depth = np.zeros(n, np.int64)  # of the segment that starts here
    rows = _open(segment, np.arange(n), depth, shallow)
    while len(rows):
        first = np.flatnonzero(np.diff(segment[rows], prepend=-1))  # of each segment, among rows
        size = np.diff(first, append=len(rows))
        own = np.repeat(np.arange(len(first)), size)
        at = depth[rows[first]]
        value = blocks[order[rows], at[own]]
        pivot = value[first + size // 2][own]
        kind = (value >= pivot).astype(np.int8) + (value > pivot)
        place, begin = np.empty(len(rows), np.int64), first.copy()
        for k in range(3):
            mine = kind == k
            before = np.cumsum(mine) - mine
            place[mine] = (begin[own] + before - before[first][own])[mine]
            number = np.add.reduceat(mine.astype(np.int64), first)
            some = number > 0
            depth[rows[begin[some]]] = at[some] + (k == 1)
            segment[rows[ragged(begin[some], number[some])]] = np.repeat(rows[begin[some]], number[some])
            begin += number
        moved = np.empty(len(rows), np.int64)
        moved[place] = order[rows]
        order[rows] = moved
        rows = _open(segment, rows, depth, shallow)
    return order, segment


def _open(segment: np.ndarray, rows: np.ndarray, depth: np.ndarray, shallow: int) -> np.ndarray:
    """Of rows (whole segments, in order) those of segments that are still to be sorted."""
    if not len(rows):
        return rows
    first = np.flatnonzero(np.diff(segment[rows], prepend=-1))
    size = np.diff(first, append=len(rows))
    return rows[np.repeat((size > 1) & (depth[rows[first]] < shallow), size)]


def deep_shallow(strings: np.ndarray, group: np.ndarray, shallow: int = SHALLOW) -> np.ndarray:
    """Order of the rows of a byte matrix by group, then by content (its width is a multiple of 8)."""
    blocks = np.ascontiguousarray(strings).view(">u8")
    order, segment = multikey_quicksort(blocks, group, min(-(-shallow // 8), blocks.shape[1]))
    deep, width = -(-shallow // 8) * 8, strings.shape[1]
    if deep < width and len(order):
        first = np.flatnonzero(np.diff(segment, prepend=-1))
        size = np.diff(first, append=len(order))
        raw = np.ascontiguousarray(strings[:, deep:]).tobytes()
        tail = width - deep
        for a, n in zip(first[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            trie = BlindTrie()
            for item in order[a : a + n].tolist():
                trie.add(raw[item * tail : (item + 1) * tail], item)
            for items in trie.leaves():
                order[a : a + len(items)] = items
                a += len(items)
    return order


def contexts(data: np.ndarray, at: np.ndarray, sizes: np.ndarray, width: int, step: int) -> np.ndarray:
    """Rows of `width` bytes from at on (step 1) or before it, backwards (step -1), zero after `sizes`; the size stands last."""
    padded = -(-(width + 4) // 8) * 8
    out = np.zeros((len(at), padded), np.uint8)
    along = np.arange(width)
    for i in range(0, len(at), _PLACES):
        own = slice(i, i + _PLACES)
        index = at[own, None] + (along if step > 0 else -1 - along)
        out[own, :width] = data[np.clip(index, 0, len(data) - 1)] * (along < sizes[own, None])
    out[:, padded - 4 :] = sizes.astype(">u4").view(np.uint8).reshape(-1, 4)
    return out


def neighbours(strings: np.ndarray, order: np.ndarray, sizes: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Common prefix of each row in the order with the one before it; -1 where a group begins."""
    common = np.full(len(order), -1, np.int64)
    for i in range(1, len(order), _PLACES):
        here, before = order[i : i + _PLACES], order[i - 1 : min(i + _PLACES, len(order)) - 1]
        differ = strings[here] != strings[before]
        agree = np.where(differ.any(axis=1), differ.argmax(axis=1), strings.shape[1])
        common[i : i + _PLACES] = np.where(group[here] == group[before], np.minimum(agree, np.minimum(sizes[here], sizes[before])), -1)
    return common


def repeated_strings(data: np.ndarray, group: np.ndarray, at: np.ndarray, back: np.ndarray, strings: np.ndarray, length: int, gram: int, shallow: int) -> np.ndarray:
    """Which strings of each place start earlier too: (places, strings a place can have).

    Places are given in their order. Strings of a place are numbered from its first one, whose anchor
    stands `back` bytes in.
    """
    wide = length - gram + 1
    before, after = contexts(data, at, back, max(wide - 1, 1), -1), contexts(data, at, strings - 1 - back + length, length, 1)
    left, right = deep_shallow(before, group, shallow), deep_shallow(after, group, shallow)

    def whole(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Equal numbers for places of one group with equal rows."""
        new = np.ones(len(order), bool)
        for i in range(1, len(order), _PLACES):
            here, last = order[i : i + _PLACES], order[i - 1 : min(i + _PLACES, len(order)) - 1]
            new[i : i + _PLACES] = (group[here] != group[last]) | (rows[here] != rows[last]).any(axis=1)
        out = np.empty(len(order), np.int64)
        out[order] = np.cumsum(new)
        return out

    n = len(group)
    out = np.zeros((n, wide), bool)
    _, first = np.unique(whole(before, left) * (n + 1) + whole(after, right), return_index=True)
    leads = np.zeros(n, bool)
    leads[first] = True  # the earliest of equal surroundings; the others are repeats as a whole
    out[~leads] = np.arange(wide) < strings[~leads, None]
    several = np.bincount(group[leads], minlength=int(group.max(initial=0)) + 1) > 1
    leads &= several[group]
    left, right = left[leads[left]], right[leads[right]]
    common_left, common_right = neighbours(before, left, back, group), neighbours(after, right, strings - 1 - back + length, group)
    run_left, run_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for b in range(wide):  # strings with b bytes before their anchor
        rows = np.flatnonzero(leads & (b <= back) & (b > back - strings))
        if len(rows):
            run_left[left], run_right[right] = np.cumsum(common_left < b), np.cumsum(common_right < length - b)
            _, earliest = np.unique(run_left[rows] * (n + 1) + run_right[rows], return_index=True)
            later = np.delete(rows, earliest)
            out[later, back[later] - b] = True
    return out


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first, number) of the runs of true values in the rows of a matrix."""
    edges = np.diff(np.pad(flags.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    row, first = np.nonzero(edges == 1)
    return row, first, np.nonzero(edges == -1)[1] - first


class Texts:
    """The texts of a part that are no later copies, in their order, and their anchors' places."""

    def __init__(self, p: Part, copy_buckets: int, length: int, gram: int):
        rows, _, state = heard_copies(p, p.rest[0], copy_buckets)
        rows = rows[state != LATER]
        keys, ids = p.digests(), p.ids()
        self.rows = rows[np.lexsort((keys[rows, 1], keys[rows, 0], ids[rows]))]
        self.data, self.offsets = text_bytes(p.texts.take(pa.array(self.rows)))
        self.docs = np.zeros(len(self.rows), _DOC)
        self.docs["doc_id"], self.docs["high"], self.docs["low"], self.docs["row"] = ids[self.rows], keys[self.rows, 0], keys[self.rows, 1], self.rows
        self.every = anchors_of(self.data, self.offsets, length, gram)
        e = self.every
        self.head = first_equal(self.data, e.hash, e.first, e.strings + length - 1, e.at - e.first)
        self.lead = self.head == np.arange(len(self.head))
        self.length = length

    def asked(self) -> Places:
        """Places of different surroundings."""
        return self.every.take(np.flatnonzero(self.lead))

    def split(self, places: Places) -> Places:
        """Each string of the places as a place of its own, that meets its equals by its own hash."""
        first = ragged(places.first, places.strings)
        own = np.repeat(np.arange(len(places.at)), places.strings)
        hashes = np.empty(len(first), np.uint64)
        ends = np.cumsum(places.strings)
        for i in range(0, len(places.at), _PLACES):
            a, b = (ends[i - 1] if i else 0), ends[min(i + _PLACES, len(ends)) - 1]
            size = places.strings[i : i + _PLACES] + self.length - 1
            sums = hashing.prefix(self.data[ragged(places.first[i : i + _PLACES], size)], hashing.BYTE_BASE)
            start = ragged(np.cumsum(size) - size, places.strings[i : i + _PLACES])
            hashes[a:b] = hashing.spans(sums, start, start + self.length, hashing.BYTE_BASE)
        return Places(hashes, first, np.ones(len(first), np.int64), places.at[own], places.text[own])


def send_surroundings(parts: DataFrame, length: int, gram: int, copy_buckets: int, hash_buckets: int, buckets: int, hot: int, hot_buckets: int | None) -> DataFrame:
    """Bytes around anchors that occur again, packed for each bucket of hashes; runs that a part knows by itself go back to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts_of(batches):
            texts = Texts(p, copy_buckets, length, gram)
            asked = texts.asked()
            times = heard(asked.hash, p.rest[1], hash_buckets)
            meet = [asked.take(np.flatnonzero((times > 0) & (times < hot)))]
            gone = [texts.every.take(np.flatnonzero(~texts.lead))]
            if hot_buckets is not None:
                strings = texts.split(asked.take(np.flatnonzero(times >= hot)))
                strings = strings.take(np.flatnonzero(heard(strings.hash, p.rest[2], hot_buckets) > 0))
                lead = first_equal(texts.data, strings.hash, strings.first, np.full(len(strings.at), length), strings.at - strings.first) == np.arange(len(strings.at))
                meet.append(strings.take(np.flatnonzero(lead)))
                gone.append(strings.take(np.flatnonzero(~lead)))
            meet, gone = (Places(*(np.concatenate(x) for x in zip(*(vars(y).values() for y in z), strict=True))) for z in (meet, gone))
            place = np.zeros(len(meet.at), _PLACE)
            place["hash"], place["start"], place["strings"], place["back"] = meet.hash, meet.first - texts.offsets[meet.text], meet.strings, meet.at - meet.first
            order, found, bounds = by_bucket(meet.hash, buckets)
            out = {name: [] for name in _AROUND.names}
            for i, b in enumerate(found.tolist()):
                own = order[bounds[i] : bounds[i + 1]]
                who, place["doc"][own] = np.unique(meet.text[own], return_inverse=True)
                row = (b, p.slot, p.part, texts.docs[who].tobytes(), place[own].tobytes(), texts.data[ragged(meet.first[own], meet.strings[own] + length - 1)].tobytes())
                for name, x in zip(_AROUND.names, row, strict=True):
                    out[name].append(x)
            if len(gone.at):
                runs = np.stack([texts.rows[gone.text], gone.first - texts.offsets[gone.text], gone.strings], axis=1)
                for name, x in zip(_AROUND.names, (-1 - p.part, p.slot, p.part, b"", b"", runs.astype("<i4").tobytes()), strict=True):
                    out[name].append(x)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([(n, pa.int64() if n in ("bucket", "slot", "part") else pa.binary()) for n in _AROUND.names]))

    return parts.mapInArrow(run, _AROUND)


def find_repeats(table: pa.Table, length: int = LENGTH, gram: int = GRAM, shallow: int = SHALLOW) -> pa.Table:
    """Runs of strings in this bucket that start earlier too, for each part: (row, first, number)."""
    if table["bucket"][0].as_py() < 0:
        return pa.table({"slot": table["slot"], "part": table["part"], "runs": table["bytes"]})
    (docs, n_docs), (places, n_places) = ((x.view(kind), np.diff(cuts) // kind.itemsize) for (x, cuts), kind in ((binary_bytes(table["docs"]), _DOC), (binary_bytes(table["places"]), _PLACE)))
    data, _ = binary_bytes(table["bytes"])
    parts = table["part"].to_numpy()
    part = np.repeat(np.arange(len(n_docs)), n_docs)
    doc = places["doc"] + np.repeat(np.cumsum(n_docs) - n_docs, n_places)
    strings, back = places["strings"].astype(np.int64), places["back"].astype(np.int64)
    sizes = strings + length - 1
    at = np.cumsum(sizes) - sizes + back
    rank = np.empty(len(docs), np.int64)
    rank[np.lexsort((docs["row"], parts[part], docs["low"], docs["high"], docs["doc_id"]))] = np.arange(len(docs))
    order = np.lexsort((places["start"], rank[doc], places["hash"]))
    group = np.cumsum(np.diff(places["hash"][order], prepend=places["hash"][order[:1]]) != 0)
    begin = np.flatnonzero(np.diff(group, prepend=-1))
    cuts = begin[np.flatnonzero(np.diff(begin // _SORTED, prepend=-1))].tolist()  # anchors stay whole
    runs, whose = [], []
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        by = order[a:b]
        row, first, number = runs_of(repeated_strings(data, group[a:b] - group[a], at[by], back[by], strings[by], length, gram, shallow))
        place = by[row]
        runs.append(np.stack([docs["row"][doc[place]], places["start"][place] + first, number], axis=1).astype("<i4"))
        whose.append(part[doc[place]])
    runs, whose = np.concatenate(runs), np.concatenate(whose)
    by_part = np.argsort(whose, kind="stable")
    found, start = np.unique(whose[by_part], return_index=True)
    bounds = np.append(start, len(by_part)).tolist()
    packed = [runs[by_part[a:b]].tobytes() for a, b in zip(bounds, bounds[1:], strict=False)]
    rows = pa.array(found)
    return pa.table({"slot": table["slot"].combine_chunks().take(rows), "part": table["part"].combine_chunks().take(rows), "runs": pa.array(packed, pa.binary())})


def remove_repeats(parts: DataFrame, length: int, copy_buckets: int, with_text: bool = False) -> DataFrame:
    """Parts with their runs: one row per text, without the bytes of repeated strings; later copies go as a whole."""
    schema = T.StructType([*RESULT]).add("kept_bytes", T.BinaryType()) if with_text else RESULT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts_of(batches):
            rows, _, state = heard_copies(p, p.rest[0], copy_buckets)
            later = np.ones(len(p.texts), bool)
            later[rows[state != LATER]] = False
            data, offsets = text_bytes(p.texts)
            sizes = np.diff(offsets)
            change = np.zeros(len(data) + 1, np.int32)
            runs = np.frombuffer(b"".join(x["runs"] for x in p.rest[1] or ()), "<i4").reshape(-1, 3).astype(np.int64)
            start = offsets[runs[:, 0]] + runs[:, 1]
            np.add.at(change, start, 1)
            np.subtract.at(change, start + runs[:, 2] + length - 1, 1)
            whole = np.flatnonzero(later & (sizes >= length))
            np.add.at(change, offsets[whole], 1)
            np.subtract.at(change, offsets[whole + 1], 1)
            gone = np.cumsum(change, dtype=np.int32)[:-1] > 0
            begin = gone.copy()
            begin[1:] &= ~gone[:-1]
            firsts = offsets[:-1][sizes > 0]
            begin[firsts] |= gone[firsts]
            n_removed, n_spans = (_between(x, offsets) for x in (gone, begin))
            raw, ends = data[~gone].tobytes(), (offsets - np.concatenate([[0], np.cumsum(n_removed)])).tolist()
            kept = [raw[a:b] for a, b in zip(ends, ends[1:], strict=False)]
            columns = [p.doc_ids, pa.array(sizes), pa.array(n_removed), pa.array(n_spans), pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_text, names=schema.names)

    return parts.mapInArrow(run, schema)


def _between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are true in each text."""
    return np.diff(np.searchsorted(np.flatnonzero(flags), offsets))


def suffix_dedup(
    spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shallow: int = SHALLOW, buckets: int | None = None, hot: int = HOT,
    part_text: int = PART_TEXT, with_text: bool = False,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes)."""
    configure(spark)
    size = text_size(docs)
    buckets = buckets or bucket_number(size, AROUND_TEXT)
    hash_buckets = bucket_number(size, ANCHOR_TEXT)
    parts = stage_parts(keyed(docs), size, part_text)
    copies = ask_copies(parts, hash_buckets)
    parts = tell(parts, copies, "copies")
    anchors = ask(parts, lambda p: Texts(p, hash_buckets, length, gram).asked().hash, hash_buckets)
    known, hot_buckets = tell(parts, anchors, "anchors"), None
    if not anchors.where(F.exists("said", lambda x: x["most"] >= hot)).isEmpty():

        def strings_of(p: Part) -> np.ndarray:
            texts = Texts(p, hash_buckets, length, gram)
            asked = texts.asked()
            return texts.split(asked.take(np.flatnonzero(heard(asked.hash, p.rest[1], hash_buckets) >= hot))).hash

        hot_buckets = buckets
        known = tell(known, ask(known, strings_of, hot_buckets), "strings")
    around = send_surroundings(known, length, gram, hash_buckets, hash_buckets, buckets, hot, hot_buckets)
    runs = around.groupBy("bucket").applyInArrow(lambda table: find_repeats(table, length, gram, shallow), _RUNS)
    runs = stage(runs.groupBy("slot").agg(F.collect_list(F.struct("part", "runs")).alias("said")))
    return remove_repeats(tell(parts, runs, "runs"), length, hash_buckets, with_text)

