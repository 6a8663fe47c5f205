"""Substring deduplication by fixed windows of words.

A rolling Rabin-Karp hash stands for every window of 35 words. Windows are dealt to buckets by their
hash, counted there, and each part of the texts hears which of its windows repeat (see parts). Those
that do are asked about again by a second hash, of other word hashes and another base, so that only
windows that agree in 128 bits count as the same; few windows repeat, so this costs little.
Repeated windows merge into maximal removal intervals, and their words go.

Cases: null text has no words; fewer words than a window are kept as they are; repeated rows and
copies repeat each other, whatever their doc_id; a null doc_id is an ordinary document; an empty
table gives no row; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from segmill.llm import hashing
from segmill.llm.common import configure, ragged
from segmill.llm.parts import PART_TEXT, Part, ask, bucket_number, heard, keyed, parts_of, stage_parts, tell, text_size
from segmill.llm.words import Words, words_of

WINDOW = 35
#: Odd multipliers of the second hash.
SECOND_BYTE_BASE, SECOND_WORD_BASE = 0xC2B2AE3D27D4EB4F, 0xA0761D6478BD642F
RESULT = T.StructType().add("doc_id", T.LongType()).add("n_words", T.LongType()).add("n_removed", T.LongType()).add("n_spans", T.LongType()).add("kept_sha256", T.StringType())


def window_hashes(words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all windows that lie in one text, first word of each)."""
    first = ragged(words.cuts[:-1], np.maximum(words.counts - window + 1, 0))
    return hashing.rolling(words.hashes(), window, hashing.WORD_BASE)[first] if len(first) else np.empty(0, np.uint64), first


def second_hashes(words: Words, first: np.ndarray, window: int) -> np.ndarray:
    """Hashes of the windows at these first words that have nothing in common with window_hashes()."""
    return hashing.rolling(words.hashes(SECOND_BYTE_BASE), window, SECOND_WORD_BASE)[first] if len(first) else np.empty(0, np.uint64)


def _repeated_once(p: Part, window: int, buckets: int) -> tuple[Words, np.ndarray]:
    """(words, first word of each window whose first hash repeats) of a part that has heard of those."""
    words = words_of(p.texts)
    hashes, first = window_hashes(words, window)
    return words, first[heard(hashes, p.rest[0], buckets) > 0]


def kept_texts(words: Words, removed: np.ndarray) -> list[bytes]:
    """Each text's words that stay, joined by one space."""
    kept = np.flatnonzero(~removed)
    sizes = words.ends[kept] - words.starts[kept] + 1
    joined = np.append(words.data, np.uint8(32))[ragged(words.starts[kept], sizes)]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    joined[ends[1:] - 1] = 32
    raw = joined.tobytes()
    own = ends[np.searchsorted(kept, words.cuts)].tolist()
    return [raw[a : max(a, b - 1)] for a, b in zip(own, own[1:], strict=False)]


def remove_windows(parts: DataFrame, window: int, buckets: int, with_text: bool = False) -> DataFrame:
    """Parts with their answers: one row per text, without the words that a repeated window covers."""
    schema = T.StructType([*RESULT]).add("kept_text", T.StringType()) if with_text else RESULT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p in parts_of(batches):
            words, at = _repeated_once(p, window, buckets)
            at = at[heard(second_hashes(words, at, window), p.rest[1], buckets) > 0]
            change = np.zeros(len(words.starts) + 1, np.int32)
            change[at] += 1
            np.subtract.at(change, at + window, 1)
            removed = np.cumsum(change)[:-1] > 0
            begin = removed.copy()
            begin[1:] &= ~removed[:-1]
            firsts = words.cuts[:-1][words.counts > 0]
            begin[firsts] |= removed[firsts]
            n_removed, n_spans = (np.diff(np.concatenate([[0], np.cumsum(x)])[words.cuts]) for x in (removed, begin))
            pieces = kept_texts(words, removed)
            columns = [p.doc_ids, pa.array(words.counts), pa.array(n_removed), pa.array(n_spans), pa.array([hashlib.sha256(x).hexdigest() for x in pieces])]
            if with_text:
                columns.append(pa.array([x.decode("utf-8", "replace") for x in pieces]))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return parts.mapInArrow(run, schema)


def window_dedup(spark: SparkSession, docs: DataFrame, window: int = WINDOW, buckets: int | None = None, part_text: int = PART_TEXT, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, n_spans, kept_sha256 (and kept_text)."""
    configure(spark)
    size = text_size(docs)
    buckets = buckets or bucket_number(size)
    parts = stage_parts(keyed(docs), size, part_text)
    parts = tell(parts, ask(parts, lambda p: window_hashes(words_of(p.texts), window)[0], buckets), "first")
    again = ask(parts, lambda p: second_hashes(*_repeated_once(p, window, buckets), window), buckets, staged=False)
    return remove_windows(tell(parts, again, "second"), window, buckets, with_text)
