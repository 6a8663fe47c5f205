"""License scan: exact phrases, and short notices with a bounded number of edits.

A text becomes lower-case words joined by one space. One Aho-Corasick pass over it finds two kinds
of needles: whole phrases, and the seeds of fuzzy notices. A notice with at most k edits keeps at
least one of k + 1 disjoint parts unchanged (pigeonhole), so its parts are the seeds. Around each
seed hit the regex library verifies the notice with at most k edits and gives span and edits.

A notice's spans are chosen best first: the match with the fewest edits (of equals the leftmost),
then the best one that does not overlap it, and so on until nothing within k edits is left over.

Cases: null text is empty (no word, no label); repeated rows and ids each get their row; of a
notice's overlapping matches one is a span, those of two notices may overlap; an empty table gives
no row; other columns are ignored. Very long texts cost time in proportion to words and seed hits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.llm.common import configure, text_bytes

#: Base phrases and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Notices that the fuzzy search adds, in the words that a scan sees.
NOTICES = {
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "free software foundation": "gpl",
    "licensed under the apache license": "apache",
    "apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "the software is provided as is without warranty of any kind": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "creative commons attribution": "cc-by",
    "licensed under cc by": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "gnu affero general public license": "agpl",
    "boost software license version 1 0": "boost",
    "neither the name of the copyright holder nor the names of its contributors": "bsd",
    "you may not use this file except in compliance with the license": "apache",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "this software is provided as is without any express or implied warranty": "zlib",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
#: One edit is allowed for so many characters of a notice, and so many at most.
CHARS_PER_EDIT, MOST_EDITS = 12, 4

SPAN = T.StructType().add("label", T.StringType()).add("first_word", T.LongType()).add("last_word", T.LongType()).add("edits", T.IntegerType())
RESULT = (
    T.StructType().add("doc_id", T.LongType()).add("n_words", T.LongType()).add("n_base", T.LongType())
    .add("first_word", T.LongType()).add("last_word", T.LongType()).add("base_labels", T.StringType())
    .add("labels", T.StringType()).add("score", T.DoubleType()).add("spans", T.ArrayType(SPAN))
)
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int32())])))])


def word_texts(column: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray]:
    """All texts as lower-case words, each word with a space after it and one before the text.

    Returns the joined bytes, the offsets of the texts (n + 1) and their numbers of words.
    """
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    table = np.full(256, 32, np.uint8)
    table[0x30:0x3A], table[0x61:0x7B], table[0x80:] = np.arange(0x30, 0x3A), np.arange(0x61, 0x7B), np.arange(0x80, 256)
    table[0x41:0x5B] = np.arange(0x61, 0x7B)
    # a space before each text and one after it
    padded = np.full(len(data) + 2 * n, 32, np.uint8)
    lengths = np.diff(offsets)
    at = np.arange(len(data)) + np.repeat(2 * np.arange(n) + 1, lengths)
    padded[at] = table[data]
    starts = offsets + 2 * np.arange(n + 1)
    space = padded == 32
    keep = np.ones(len(padded), bool)
    keep[1:] = ~(space[1:] & space[:-1])
    keep[starts[:-1]] = True
    places = np.concatenate([[0], np.cumsum(keep)])
    spaces = np.concatenate([[0], np.cumsum(space & keep)])
    cuts = places[starts]
    return padded[keep].tobytes(), cuts, np.maximum(spaces[starts[1:]] - spaces[starts[:-1]] - 1, 0)


class Scanner:
    def __init__(self, base: dict[str, str], notices: dict[str, str], chars_per_edit: int, most_edits: int):
        import ahocorasick
        import regex

        self.base, self.notices = base, []
        needles: dict[str, list[tuple]] = {}
        for phrase, label in base.items():
            needles.setdefault(f" {phrase} ", []).append(("base", label, 0))
        for phrase, label in notices.items():
            edits = min(most_edits, len(phrase) // chars_per_edit)
            bounds = [round(i * len(phrase) / (edits + 1)) for i in range(edits + 2)]
            pattern = regex.compile(rf"(?b)(?<= )(?:{regex.escape(phrase)}){{e<={edits}}}(?= )")
            for first, last in zip(bounds, bounds[1:], strict=False):
                needles.setdefault(phrase[first:last], []).append(("seed", len(self.notices), first))
            self.notices.append((phrase, label, edits, pattern))
        self.automaton = ahocorasick.Automaton()
        for needle, uses in needles.items():
            self.automaton.add_word(needle, (len(needle), uses))
        self.automaton.make_automaton()

    def scan(self, text: str) -> tuple[list[tuple[str, int]], list[tuple[str, int, int, int, int]]]:
        """Base hits (label, character), and notices (label, first and end character, edits, length)."""
        hits: list[tuple[str, int]] = []
        windows: dict[int, set[tuple[int, int]]] = {}
        for end, (size, uses) in self.automaton.iter(text):
            start = end + 1 - size
            for kind, what, shift in uses:
                if kind == "base":
                    hits.append((what, start + 1))
                    continue
                phrase, _, edits, _ = self.notices[what]
                low = max(0, start - shift - edits - 1)
                high = min(len(text), start - shift + len(phrase) + edits + 1)
                windows.setdefault(what, set()).add((low, high))
        found = []
        for what, own in windows.items():
            phrase, label, edits, pattern = self.notices[what]
            found += [(label, a, b, e, len(phrase)) for e, a, b in _best_first(pattern, text, own, len(phrase) - edits)]
        return hits, found


def _best_first(pattern, text: str, windows: set[tuple[int, int]], shortest: int) -> list[tuple[int, int, int]]:
    """(edits, start, end) of matches that do not overlap, the best of all that are left at each step.

    A match lies in some window. The best of each window waits in a heap; one that meets a chosen
    span makes way for the best on either side of that span.
    """
    heap: list[tuple[int, int, int, int, int]] = []

    def search(low: int, high: int) -> None:
        m = pattern.search(text, low, high) if high - low > shortest else None
        if m:
            heapq.heappush(heap, (sum(m.fuzzy_counts), m.start(), m.end(), low, high))

    for low, high in windows:
        search(low, high)
    spans: list[tuple[int, int, int]] = []
    taken: dict[int, tuple[int, int]] = {}  # a chosen span at each of its characters
    while heap:
        edits, start, end, low, high = heapq.heappop(heap)
        met = next((taken[c] for c in range(start, end) if c in taken), None)
        if met:
            search(low, met[0])
            search(met[1], high)
        else:
            spans.append((edits, start, end))
            taken.update(dict.fromkeys(range(start, end), (start, end)))
    return spans


def _word_at(text: str, places: Sequence[int]) -> dict[int, int]:
    """Number of the word that holds or starts at each character."""
    out, last, n = {}, 0, 0
    for p in sorted(set(places)):
        n += text.count(" ", last, p)
        out[p], last = n - 1, p
    return out


def license_scan(spark: SparkSession, docs: DataFrame, base: dict[str, str] | None = None, notices: dict[str, str] | None = None, chars_per_edit: int = CHARS_PER_EDIT, most_edits: int = MOST_EDITS) -> DataFrame:
    """One row per document, with base counts, labels of both kinds, a score and the notices' spans.

    The score is the best match's share of unchanged characters, 1.0 for an exact phrase, 0.0 for none.
    """
    configure(spark)
    base, notices = BASE if base is None else base, NOTICES if notices is None else notices

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices, chars_per_edit, most_edits)
        for batch in batches:
            joined, cuts, n_words = word_texts(batch.column(1))
            rows = []
            for doc_id, low, high, n in zip(batch.column(0).to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), n_words.tolist(), strict=True):
                text = joined[low:high].decode("utf-8", "replace")
                hits, found = scanner.scan(text)
                row = dict(doc_id=doc_id, n_words=n, n_base=len(hits), first_word=None, last_word=None, base_labels="", labels="", score=0.0, spans=[])
                if hits or found:
                    words = _word_at(text, [p for _, p in hits] + [p for _, a, b, _, _ in found for p in (a, b - 1)])
                    own = {label for label, _ in hits}
                    if hits:
                        row |= dict(first_word=min(words[p] for _, p in hits), last_word=max(words[p] for _, p in hits))
                    spans = sorted((label, words[a], words[b - 1], e) for label, a, b, e, _ in found)
                    row |= dict(
                        base_labels=",".join(sorted(own)),
                        labels=",".join(sorted(own | {s[0] for s in spans})),
                        score=1.0 if hits else max(1.0 - e / size for _, _, _, e, size in found),
                        spans=[dict(label=s[0], first_word=s[1], last_word=s[2], edits=s[3]) for s in spans],
                    )
                rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT)
