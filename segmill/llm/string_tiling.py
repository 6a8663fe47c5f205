"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits in lower case. A test item's five-word seeds are looked up in
every document; an item whose seeds cover enough of it is tiled: running Karp-Rabin finds common runs
of words, the longest are marked first, and the search goes on in what is unmarked, down to five
words. Tiles may stand in any order, so a reordered passage is covered as well as a copied one. A
document is contaminated by an item if tiles cover at least 0.8 of the item's words. An item of fewer
words than a seed has is one tile: its words must stand together.

The items are a stated set that meets all documents in blocks: equal texts count once, a block's size
is measured before it is sent to the tasks, and each further block is another pass over the documents.

Cases: null text, and text without a word, matches nothing; a null doc_id or item_id is carried along;
repeated rows each get theirs; of common runs of one length the first in the item is marked first,
then the first in the document; empty tables give no row; other columns are ignored. A long document
costs time in proportion to its words and to its seeds of each item.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm import hashing
from segmill.llm.common import configure, stage
from segmill.llm.license_scan import word_texts
from segmill.llm.parts import slices
from segmill.llm.words import words_of

SEED, COVERAGE = 5, 0.8
#: Words of the windows with which tiling begins.
SEARCH = 20
#: Bytes of test items that one pass sends to the tasks.
BLOCK_BYTES = 4 << 20

TILED = (
    T.StructType().add("doc_id", T.LongType()).add("item_id", T.LongType()).add("item_words", T.LongType())
    .add("covered_words", T.LongType()).add("tiles", T.LongType()).add("coverage", T.DoubleType())
)
_FOUND = T.StructType([T.StructField("key", T.BinaryType()) if f.name == "item_id" else f for f in TILED])


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    joined, cuts, _ = word_texts(column)
    texts = pa.Array.from_buffers(pa.large_string(), len(column), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(joined)])
    words = words_of(texts)
    return words.hashes(), words.cuts


def tile(item: np.ndarray, text: np.ndarray, least: int, search: int = SEARCH) -> list[tuple[int, int, int]]:
    """Tiles (item place, text place, words), by running Karp-Rabin greedy string tiling.

    Windows of the search length find the common runs. If one is over twice as long, the search
    begins again with its length; else the runs are marked, longest first, and the length is halved.
    """
    free_item, free_text = np.ones(len(item), bool), np.ones(len(text), bool)
    tiles: list[tuple[int, int, int]] = []
    size = max(least, search)
    while True:
        runs = _common_runs(item, free_item, text, free_text, size)
        longest = max((n for _, _, n in runs), default=0)
        if longest > 2 * size:
            size = longest
            continue
        heap = [(-n, i, j) for i, j, n in runs]
        heapq.heapify(heap)
        while heap:
            n, i, j = heapq.heappop(heap)
            unmarked = free_item[i : i - n] & free_text[j : j - n]
            if unmarked.all():
                free_item[i : i - n] = free_text[j : j - n] = False
                tiles.append((i, j, -n))
            else:
                for first, left in _stretches(unmarked, size):  # what stands between marked words waits its turn
                    heapq.heappush(heap, (-left, i + first, j + first))
        if size == least:
            return tiles
        size = max(least, size // 2)


def _stretches(flags: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first, length) of every stretch of at least so many flags that are set."""
    if not flags.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return [(a, b - a) for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if b - a >= least]


def _common_runs(item: np.ndarray, free_item: np.ndarray, text: np.ndarray, free_text: np.ndarray, size: int) -> list[tuple[int, int, int]]:
    """(item place, text place, words) of every maximal common run of at least `size` unmarked words.

    The text is gone through once, with the runs that its last window is in; so an item and a text that
    repeat the same words take memory by the item's length, not by the pairs of their windows.
    """
    at_item, hash_item = _windows(item, free_item, size)
    at_text, hash_text = _windows(text, free_text, size)
    order = np.argsort(hash_item, kind="stable")
    known, place = hash_item[order], at_item[order]
    first, last = np.searchsorted(known, hash_text), np.searchsorted(known, hash_text, side="right")
    hits = np.flatnonzero(first < last)
    open_at, open_n, before, ended = np.empty(0, np.int64), np.empty(0, np.int64), -2, []
    for j, a, b in zip(at_text[hits].tolist(), first[hits].tolist(), last[hits].tolist(), strict=True):
        here = place[a:b]
        n, goes_on = np.ones(len(here), np.int64), np.zeros(len(open_at), bool)
        if j == before + 1:
            found = np.minimum(np.searchsorted(open_at, here - 1), len(open_at) - 1)
            same = open_at[found] == here - 1
            n[same] += open_n[found[same]]
            goes_on[found[same]] = True
        ended += [(i, before, k) for i, k in zip(open_at[~goes_on].tolist(), open_n[~goes_on].tolist(), strict=True)]
        open_at, open_n, before = here, n, j
    ended += [(i, before, k) for i, k in zip(open_at.tolist(), open_n.tolist(), strict=True)]
    runs = []
    for i, j, k in ended:  # its last window, and how many there are
        i, j, n = i - k + 1, j - k + 1, k + size - 1
        runs += [(i + a, j + a, m) for a, m in _stretches(item[i : i + n] == text[j : j + n], size)]  # all of it, but for a collision
    return runs


def _windows(values: np.ndarray, free: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of unmarked words."""
    hashes = hashing.rolling(values, size, hashing.WORD_BASE)
    used = np.concatenate([[0], np.cumsum(~free)])
    at = np.flatnonzero(used[size:] == used[: len(used) - size]) if len(hashes) else np.empty(0, np.int64)
    return at, hashes[at]


@dataclass
class Items:
    """A block of test items: word hashes of each, and for each size of seeds a sorted table of them."""

    keys: list
    words: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # hash, item, place
    seed: int
    coverage: float

    @classmethod
    def of(cls, keys: list, texts: list[str | None], seed: int, coverage: float) -> Items:
        hashes, cuts = word_hashes(pa.array(texts, pa.string()))
        words = [hashes[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        seeds = {}
        for size in sorted({min(seed, len(w)) for w in words} - {0}):
            of_size = [i for i, w in enumerate(words) if min(seed, len(w)) == size]
            own = [hashing.rolling(words[i], size, hashing.WORD_BASE) for i in of_size]
            every, item = np.concatenate(own), np.repeat(of_size, [len(x) for x in own])
            order = np.argsort(every, kind="stable")
            seeds[size] = every[order], item[order], np.concatenate([np.arange(len(x)) for x in own])[order]
        return cls(keys, words, seeds, seed, coverage)

    def search(self, column: pa.Array) -> Iterator[tuple[int, int, list[tuple[int, int, int]]]]:
        """(document, item, tiles) of every pair whose tiles cover enough of the item."""
        if not self.seeds:
            return
        words, cuts = word_hashes(column)
        for size, (seed_hash, seed_item, seed_place) in self.seeds.items():
            every = hashing.rolling(words, size, hashing.WORD_BASE)
            low = np.searchsorted(seed_hash, every)
            hit = np.flatnonzero(seed_hash[np.minimum(low, len(seed_hash) - 1)] == every)
            doc = np.searchsorted(cuts, hit, side="right") - 1
            inside = hit + size <= cuts[doc + 1]
            hit, doc = hit[inside], doc[inside]
            for d in np.unique(doc).tolist():
                own = hit[np.searchsorted(doc, d) : np.searchsorted(doc, d, side="right")]
                text, at, hashes = words[cuts[d] : cuts[d + 1]], own - cuts[d], every[own]
                seeds = np.unique(hashes)
                first, last = np.searchsorted(seed_hash, seeds), np.searchsorted(seed_hash, seeds, side="right")
                rows = np.concatenate([np.arange(a, b) for a, b in zip(first.tolist(), last.tolist(), strict=True)])
                for item in np.unique(seed_item[rows]).tolist():
                    tiles = self._tiles(text, at, hashes, item, rows[seed_item[rows] == item], size)
                    if tiles and sum(n for _, _, n in tiles) >= self.coverage * len(self.words[item]):
                        yield d, item, tiles

    def _tiles(self, text: np.ndarray, at: np.ndarray, hashes: np.ndarray, item: int, rows: np.ndarray, size: int) -> list[tuple[int, int, int]]:
        """Tiles of an item in a document that has these of its seeds; none if the seeds cannot cover enough."""
        own = self.words[item]
        if size < self.seed:  # the seed is the item
            places = at[hashes == self.seeds[size][0][rows[0]]]
            return next(([(0, int(j), size)] for j in places if np.array_equal(text[j : j + size], own)), [])
        place = self.seeds[size][2][rows]
        reach = np.zeros(len(own) + 1, np.int32)
        reach[place] += 1
        np.subtract.at(reach, place + size, 1)
        if np.count_nonzero(np.cumsum(reach)[:-1]) < self.coverage * len(own):
            return []  # no tiling can cover more than the seeds do
        return tile(own, self._around(text, at, hashes, item), size)

    def _around(self, text: np.ndarray, hits: np.ndarray, hashes: np.ndarray, item: int) -> np.ndarray:
        """The document's words under seeds of this item; runs are kept apart by a word that no item has."""
        seed_hash, seed_item, _ = self.seeds[self.seed]
        own = np.isin(hashes, seed_hash[seed_item == item])
        covered = np.zeros(len(text) + 1, np.int32)
        covered[hits[own]] += 1
        np.subtract.at(covered, hits[own] + self.seed, 1)
        under = np.flatnonzero(np.cumsum(covered)[:-1])
        gaps = np.flatnonzero(np.diff(under) > 1) + 1
        return np.insert(text[under], gaps, np.uint64(0))


def item_texts(items: DataFrame) -> DataFrame:
    """(key, text) of the distinct texts of items, staged."""
    rows = items.select(_key().alias("key"), F.col("text").cast("string").alias("text")).where("text is not null")
    return stage(rows.dropDuplicates(["key"]))


def _key():
    return F.unhex(F.md5(F.col("text").cast("string").cast("binary")))


def item_blocks(texts: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """The rows of item_texts(), a block at a time. No block has more bytes than that, but for a text that has so many by itself."""
    blocks = 1
    while True:
        block = F.pmod(F.xxhash64("key"), F.lit(blocks))
        sizes = texts.groupBy(block.alias("block")).agg(F.sum(F.octet_length("text")).alias("size"), F.count(F.lit(1)).alias("n"))
        if sizes.where((F.col("size") > block_bytes) & (F.col("n") > 1)).isEmpty():
            break
        blocks *= 2
    for k in range(blocks):
        yield texts.where(block == k).orderBy("key").collect()


def _sent(spark: SparkSession, items: DataFrame, seed: int, coverage: float, block_bytes: int) -> Iterator:
    """The items as broadcast tables of bounded size."""
    for block in item_blocks(item_texts(items), block_bytes):
        yield spark.sparkContext.broadcast(Items.of([r.key for r in block], [r.text for r in block], seed, coverage))


def tile_documents(spark: SparkSession, docs: DataFrame, items: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document and test item that it holds: words covered, tiles, coverage (0 to 1)."""
    configure(spark)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    found = None
    for table in _sent(spark, items, seed, coverage, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            held = table.value
            for whole in batches:
                for batch in slices(whole, 1):
                    rows = []
                    for d, item, tiles in held.search(batch.column(1)):
                        covered, words = sum(n for _, _, n in tiles), len(held.words[item])
                        rows.append([batch.column(0)[d].as_py(), held.keys[item], words, covered, len(tiles), covered / words])
                    if rows:
                        kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64()]
                        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=_FOUND.names)

        part = texts.mapInArrow(run, _FOUND)
        found = part if found is None else found.unionByName(part)
    whose = items.select(_key().alias("key"), F.col("item_id").cast("long").alias("item_id"))
    return found.join(whose, "key").select(*TILED.names)


def drop_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs without the contaminated ones; columns stay. Each block filters in one pass, without a join."""
    configure(spark)
    names, schema = docs.columns, docs.schema
    for table in _sent(spark, items, seed, coverage, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], table=table) -> Iterator[pa.RecordBatch]:
            at = names.index("text")
            for whole in batches:
                for batch in slices(whole, at):
                    clean = np.ones(batch.num_rows, bool)
                    for d, _, _ in table.value.search(batch.column(at)):
                        clean[d] = False
                    if clean.any():
                        yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, schema)
    return docs
