"""Cutting answers into segments: one Arrow function over slim columns, one row per sample, no shuffle.

Everything that depends on the row's previous cut is decided here, per row; word and mask flags are
numpy over the whole text, and a fixed or random cut costs one binary search. Only the key, the text,
the tokens' lengths and the confidences go to Python; all other columns stay where they are.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Sequence
from functools import cache
from itertools import count, groupby, islice, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.functions.protected import PROTECTED, occurrences
from segmill.functions.text import lengths, tokens
from segmill.jobs.config import SegmentConfig
from segmill.sources.staging import configure

_RUN, _LONG_RUN = re.compile(r"[^\W_]+"), re.compile(r"[^\W_]{3}")
#: The formula of functions/text, with white space as Python's own class of the same characters.
_FORMULA = re.compile(r"[A-Za-z0-9]+(?:\s*[-+*/=<>^%:]+\s*[A-Za-z0-9]+)+")
_FORMULA_BEGUN = re.compile(r"\s*(?:[A-Za-z0-9]+(?:\s*[-+*/=<>^%:]+\s*[A-Za-z0-9]+)*)?[-+*/=<>^%:\s]*")
SEGMENTED = T.StructType().add("boundaries", T.ArrayType(T.LongType())).add("segments", T.ArrayType(T.StringType()))


@cache
def _alnum() -> np.ndarray:
    """For each code point, whether it is a letter or digit."""
    return np.fromiter((chr(i).isalnum() for i in range(0x110000)), bool, 0x110000)


def inside_word_flags(text: str) -> np.ndarray:
    """For every cut 0..len: whether it lies inside a word (two CJK neighbours may be cut)."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    word = _alnum()[codes]
    edges = np.diff(np.pad(((codes == ord("_")) | (codes == ord("-"))).astype(np.int8), 1))
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)  # runs of connectors
    joined = (first > 0) & (last < len(codes))
    joined[joined] = word[first[joined] - 1] & word[last[joined]]
    change = np.zeros(len(codes) + 1, np.int32)
    change[first[joined]], change[last[joined]] = 1, -1
    word = word | (np.cumsum(change)[:-1] > 0)
    cjk = (codes >= 0x4E00) & (codes <= 0x9FFF)
    inside = np.zeros(len(codes) + 1, bool)
    inside[1:-1] = word[:-1] & word[1:] & ~(cjk[:-1] & cjk[1:])
    return inside


def starts_of(ends: np.ndarray) -> np.ndarray:
    """Where tokens begin that follow each other without gaps."""
    return np.concatenate([[0], ends[:-1]]) if len(ends) else ends


def cuttable_flags(starts: np.ndarray, ends: np.ndarray, text: str, strings: Sequence[str] = PROTECTED) -> np.ndarray:
    """Tokens that are not empty and touch no protected string, in one pass over the text."""
    change = np.zeros(len(text) + 1, np.int32)
    for start, end, _ in occurrences(text, strings):
        change[start] += 1
        change[end] -= 1
    covered = np.concatenate([[0], np.cumsum(np.cumsum(change)[:-1] > 0)])
    return (ends > starts) & (covered[ends] == covered[starts])


def is_valid(text: str) -> bool:
    if _LONG_RUN.search(text):
        return True
    runs = _RUN.findall(text)
    if len(runs) == 1 and len(runs[0]) == 2:
        return True
    return bool(runs) and bool(_FORMULA.fullmatch(text.strip()))


def threshold_boundaries(conf: Sequence[float], cuttable: Sequence[bool], tau: float, min_step: int, inside: Sequence[bool] | None = None, window: int = 3) -> list[int]:
    """At most one cut per run of low-confidence tokens: its least confident token that may be cut.

    inside tells of each token whether a cut after it lies inside a word; without it (None) there is
    no word test and no move to a neighbour.
    """
    if min_step < 1:
        raise ValueError("min_step must be at least 1")
    if len(conf) != len(cuttable):
        raise ValueError("confidences and mask differ in length")
    low = np.flatnonzero(np.asarray(cuttable, bool) & (np.asarray(conf, float) < tau)).tolist()
    chosen, last = [], -1
    for _, run in groupby(enumerate(low), lambda p: p[1] - p[0]):
        tries = sorted((i for _, i in run), key=lambda i: (conf[i], i))
        pick = next((i for i in tries if i - last >= min_step and not (inside is not None and inside[i])), None)
        if pick is None and inside is not None:
            near = (i + side * d for i in tries for d in range(1, max(0, window) + 1) for side in (1, -1))
            pick = next((j for j in near if 0 <= j < len(conf) and cuttable[j] and j - last >= min_step and not inside[j]), None)
        if pick is not None:
            chosen.append(pick)
            last = pick
    return chosen


def _usable(cuttable: Sequence[bool], inside: Sequence[bool] | None) -> np.ndarray:
    """Tokens after which a segment of given length may end; the last token is not one."""
    free = np.array(cuttable, bool)
    if inside is not None:
        free &= ~np.asarray(inside, bool)
    return np.flatnonzero(free[:-1])


def fixed_length_boundaries(cuttable: Sequence[bool], size: int, min_step: int, inside: Sequence[bool] | None = None) -> list[int]:
    if size <= 0 or min_step <= 0:
        raise ValueError("segment size and min_step must be positive")
    return _spaced(_usable(cuttable, inside), max(size, min_step), -1)


def _spaced(places: np.ndarray, step: int, last: int) -> list[int]:
    """Of ascending places each first one that is at least a step from the one before it."""
    chosen = []
    while (at := int(np.searchsorted(places, last + step))) < len(places):
        last = int(places[at])
        chosen.append(last)
    return chosen


def draws(config: SegmentConfig, source_idx: int) -> Callable[[int, int], int]:
    """A row's own draws from low to high, so partitioning changes nothing.

    "mersenne" is Python's generator seeded by seed + row; "hash" takes the k-th draw from the MD5 of
    seed:row:k, which SQL can repeat.
    """
    if config.random_generator == "mersenne":
        return random.Random(config.random_seed + source_idx).randint
    number = count()

    def draw(low: int, high: int) -> int:
        return low + int(hashlib.md5(f"{config.random_seed}:{source_idx}:{next(number)}".encode()).hexdigest()[:8], 16) % (high - low + 1)

    return draw


def random_length_boundaries(cuttable: Sequence[bool], low: int, high: int, draw: Callable[[int, int], int], inside: Sequence[bool] | None = None) -> list[int]:
    """One draw per segment; a segment ends at the first token from there on that may end one."""
    if not 0 < low <= high:
        raise ValueError("sizes must be positive and in order")
    usable, chosen, last = _usable(cuttable, inside), [], -1
    while (target := last + draw(low, high)) < len(cuttable) - 1:
        at = int(np.searchsorted(usable, target))
        if at == len(usable):
            break
        last = int(usable[at])
        chosen.append(last)
    return chosen


def split_text(text: str, ends: Sequence[int], boundaries: Sequence[int], min_chars: int, inside: Sequence[bool]) -> list[str]:
    """Cut after the boundary tokens, then join pieces that mean nothing to their neighbours.

    inside is given by character here. White space alone is no piece. A last piece under min_chars
    belongs to the one before it. The first segment takes as many pieces as it needs to mean
    something; from there on every piece that means something opens a segment of its own.
    """
    picked = np.asarray(boundaries, np.int64)
    if len(picked) and (picked[0] < 0 or picked[-1] >= len(ends) or (np.diff(picked) <= 0).any()):
        raise ValueError("boundaries must be in range, in order and without repeats")
    places = np.asarray(ends, np.int64)[picked]
    cuts = [0, *_spaced(places[~np.asarray(inside, bool)[places]], min_chars, 0), len(text)]
    pieces = [piece for a, b in pairwise(cuts) if (piece := text[a:b]).strip()]
    if len(pieces) > 1 and len(text) - cuts[-2] < min_chars and text[cuts[-2] :].strip():
        pieces[-2:] = [pieces[-2] + pieces[-1]]
    several = len(pieces) > 1
    opening = _opening(pieces, several)
    if opening is None:
        return []
    opens = [0, *(k for k in range(opening + 1, len(pieces)) if _stands(pieces[k], several)), len(pieces)]
    return ["".join(pieces[a:b]) for a, b in pairwise(opens)]


def _opening(pieces: list[str], several: bool) -> int | None:
    """The first piece with which all up to it together can be a segment; the text is read once, however long nothing stands."""
    text, end = "".join(pieces), 0
    long, runs = _LONG_RUN.search(text), list(islice(_RUN.finditer(text), 2))
    certain, formula = long.start() + 3 if long else len(text) + 1, _FORMULA_BEGUN.match(text).end()
    for k, piece in enumerate(pieces):
        end += len(piece)
        if end >= certain:
            return k
        if not runs or end <= runs[0].start():
            continue
        alone = len(runs) < 2 or end <= runs[1].start()
        pair = alone and min(end, runs[0].end()) - runs[0].start() == 2
        if (pair or end <= formula) and _stands(text[:end], several):
            return k
    return None


def _stands(piece: str, among_others: bool) -> bool:
    """Whether a piece can be a segment: it is valid and, among others, no word of one or two letters."""
    bare = piece.strip()
    return is_valid(piece) and not (among_others and bare.isalpha() and len(bare) < 3)


def segment(rows: DataFrame, config: SegmentConfig, text: str = "gt_output", key: str = "source_idx", token_lengths: Column | None = None, token_spans: Column | None = None) -> DataFrame:
    """rows with `boundaries` and `segments`; threshold mode reads the array column `confidences`.

    token_lengths is the array of the tokens' lengths, the default tokenizer's if it is not given;
    lengths that do not add up to the text raise. token_spans is an array of (token, start, end) in its
    place: tokens with gaps, overlaps or nothing in them. Spans outside the text, or whose ends go back, raise.
    """
    configure(rows.sparkSession)
    conf = F.col("confidences") if config.mode == "threshold" else F.lit(None)
    if token_spans is None:
        sizes = lengths(tokens(F.col(text))) if token_lengths is None else token_lengths
        places = [F.lit(None).cast("array<int>"), sizes.cast("array<int>"), F.lit(None).cast("array<boolean>")]
    else:
        special = F.transform(token_spans, lambda t: t["token"].isin(*config.special_tokens)) if config.special_tokens else F.lit(None)
        places = [F.transform(token_spans, lambda t: t["start"]).cast("array<int>"), F.transform(token_spans, lambda t: t["end"]).cast("array<int>"), special.cast("array<boolean>")]
    # As the function counts as nondeterministic, Spark never copies it into a filter on segments: posexplode() alone implies such a filter.
    cut = F.arrow_udf(_cutter(config, token_spans is not None), SEGMENTED).asNondeterministic()
    found = cut(F.col(key).cast("long"), F.col(text), *places, conf.cast("array<double>"))
    return rows.withColumn("_cut", found).select(*rows.columns, "_cut.boundaries", "_cut.segments")


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column and the cuts between its rows; null is empty."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)])


def _placed(key: int | None, text: str, starts: np.ndarray, ends: np.ndarray, spans: bool) -> tuple[np.ndarray, np.ndarray]:
    """Where tokens begin and end, from spans or from lengths."""
    if not spans:
        ends = np.cumsum(ends, dtype=np.int64)
        if not len(ends) or ends[-1] != len(text):
            raise ValueError(f"the tokens of source_idx {key} do not add up to its text")
        return starts_of(ends), ends
    if len(ends) and ((starts < 0).any() or (starts > ends).any() or ends[-1] > len(text) or (np.diff(ends) < 0).any()):
        raise ValueError(f"the token spans of source_idx {key} do not lie in order in its text")
    return starts.astype(np.int64), ends.astype(np.int64)


def _cutter(config: SegmentConfig, spans: bool):
    if config.mode == "threshold" and config.tau is None:
        raise ValueError("threshold mode needs a tau")
    special = frozenset(config.special_tokens)

    def cut(key: int | None, text: str | None, starts: np.ndarray, ends: np.ndarray, marked: np.ndarray, conf: np.ndarray) -> tuple[list[int], list[str]]:
        if not text:
            return [], []
        starts, ends = _placed(key, text, starts, ends, spans)
        by_char = inside_word_flags(text)
        cuttable, inside = cuttable_flags(starts, ends, text, config.protected_strings), by_char[ends]
        if special:
            cuttable &= ~marked.astype(bool) if spans else np.array([text[a:b] not in special for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], bool)
        if config.mode == "threshold":
            found = threshold_boundaries(conf.tolist(), cuttable.tolist(), config.tau, config.min_step_tokens, inside.tolist(), config.relocation_window)
        elif config.mode == "fixed":
            found = fixed_length_boundaries(cuttable, config.fixed_segment_tokens, config.min_step_tokens, inside)
        else:
            found = random_length_boundaries(cuttable, config.random_min_tokens, config.random_max_tokens, draws(config, key or 0), inside)
        return found, split_text(text, ends, found, config.min_step_chars, by_char)

    def run(keys: pa.Array, texts: pa.Array, *columns: pa.Array) -> pa.Array:
        lists = [_lists(c) for c in columns]
        found = []
        for i, (key, text) in enumerate(zip(keys.to_pylist(), texts.to_pylist(), strict=True)):
            found.append(cut(key, text, *(values[cuts[i] : cuts[i + 1]] for values, cuts in lists)))
        columns = [pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.string()))]
        return pa.StructArray.from_arrays(columns, names=SEGMENTED.names)

    return run
