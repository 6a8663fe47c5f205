"""Hand-worked cases of the cutting rules, and properties over random texts."""

from __future__ import annotations

import random
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from segmill.jobs.config import SegmentConfig
from segmill.operators import segment as S


@pytest.mark.parametrize(
    ("text", "cut", "inside"),
    [
        ("length", 3, True), ("max_length", 3, True), ("max_length", 4, True), ("step-by-step", 5, True), ("中a", 1, True), ("かな", 1, True),
        ("length", 0, False), ("length", 6, False), ("中文", 1, False), ("x+y=2", 1, False), ("n->n+1", 2, False), ("a- b", 2, False), ("3.14", 1, False), ("don't", 3, False),
    ],
)
def test_inside_word(text, cut, inside):
    assert bool(S.inside_word_flags(text)[cut]) is inside


@pytest.mark.parametrize("text", ["abc", "ab", "12", "ok!", "x+y=2", "n->n+1", "a/b"])
def test_valid(text):
    assert S.is_valid(text)


@pytest.mark.parametrize("text", ["", "   ", "!!!", "a", "a b", "ab cd", "-5", "(a)", "1.5"])
def test_not_valid(text):
    assert not S.is_valid(text)


CONF = [0.9, 0.1, 0.2, 0.9, 0.05, 0.9]


def test_threshold_without_text():
    assert S.threshold_boundaries(CONF, [True] * 6, 0.3, 2) == [1, 4]
    assert S.threshold_boundaries(CONF, [True] * 6, 0.3, 4) == [4]


def test_threshold_relocates_on_short_steps():
    text, ends = "a b c d e f", [1, 3, 5, 7, 9, 11]
    inside = S.inside_word_flags(text)[ends].tolist()
    assert S.threshold_boundaries(CONF, [True] * 6, 0.3, 4, inside) == [3]


def test_threshold_ties_nan_and_errors():
    assert S.threshold_boundaries([0.1, 0.1, 0.9], [True] * 3, 0.3, 1) == [0]
    assert S.threshold_boundaries([float("nan"), 0.1], [True] * 2, 0.3, 1) == [1]
    with pytest.raises(ValueError):
        S.threshold_boundaries([0.1], [True, True], 0.3, 1)
    with pytest.raises(ValueError):
        S.threshold_boundaries([0.1], [True], 0.3, 0)


def test_fixed():
    assert S.fixed_length_boundaries([True] * 10, 4, 1) == [3, 7]
    assert S.fixed_length_boundaries([True] * 8, 4, 1) == [3]
    assert S.fixed_length_boundaries([i != 3 for i in range(10)], 4, 1) == [4, 8]


def test_random_is_the_rows_own():
    for generator in ("mersenne", "hash"):
        config = SegmentConfig(mode="random", random_generator=generator)
        own = lambda row: S.draws(config, row)  # noqa: E731, B023
        assert S.random_length_boundaries([True] * 10, 4, 4, own(0)) == [3, 7]
        assert S.random_length_boundaries([True] * 99, 4, 9, own(5)) == S.random_length_boundaries([True] * 99, 4, 9, own(5)) != S.random_length_boundaries([True] * 99, 4, 9, own(6))
    draw, drawn = S.draws(SegmentConfig(random_generator="hash"), 5), Counter()
    drawn.update(draw(3, 7) for _ in range(5000))
    assert sorted(drawn) == [3, 4, 5, 6, 7] and min(drawn.values()) > 850


def split(text, ends, boundaries, chars):
    return S.split_text(text, ends, boundaries, chars, S.inside_word_flags(text))


def test_split():
    assert split("abc def ghi", [3, 7, 11], [0], 4) == ["abc def ghi"]
    assert split("abc def ghi", [3, 7, 11], [1], 4) == ["abc def", " ghi"]
    assert split("abc def ghi", [3, 7, 11], [1], 5) == ["abc def ghi"]
    assert split("abcd        efgh", [4, 12, 16], [0, 1], 4) == ["abcd", "efgh"]
    assert split("!!! abcdef", [3, 10], [0], 3) == ["!!! abcdef"]
    assert split("!!!! ????", [4, 9], [], 3) == []
    assert split("", [], [], 3) == []
    for bad in ([5], [1, 0], [1, 1], [-1]):
        with pytest.raises(ValueError):
            split("abc def ghi", [3, 7, 11], bad, 4)


def cuttable(ends, text):
    ends = np.array(ends)
    return S.cuttable_flags(S.starts_of(ends), ends, text)


def test_cuttable():
    spans = np.array([(0, 1), (0, 8), (1, 1), (8, 8), (8, 9), (0, 1), (7, 9)])  # overlaps, nothing, touching
    assert S.cuttable_flags(spans[:, 0], spans[:, 1], "a<think>b").tolist() == [True, False, False, False, True, True, False]
    mask = cuttable([1, 2, 7, 9, 9], "a<think>b")
    assert mask.tolist() == [True, False, False, False, False]
    assert cuttable([1, 8, 9], "a<think>b").tolist() == [True, False, True]


def plain_inside(text, cut):
    """The word test by walking over connectors on both sides."""
    if not 0 < cut < len(text):
        return False
    if "\u4e00" <= text[cut - 1] <= "\u9fff" and "\u4e00" <= text[cut] <= "\u9fff":
        return False
    left, right = text[:cut].rstrip("_-"), text[cut:].lstrip("_-")
    return left[-1:].isalnum() and right[:1].isalnum()


def plain_split(text, ends, boundaries, least, good=S.is_valid):
    """The splitting rule told piece by piece, as a fold over what is left (see SURVEY, rule G5)."""

    def cut(start, left):
        if not left:
            return [text[start:]]
        end = ends[left[0]]
        if plain_inside(text, end) or end - start < least:
            return cut(start, left[1:])
        return [text[start:end], *cut(end, left[1:])]

    *front, tail = cut(0, list(boundaries))
    raw = [p for p in front if p.strip()]
    if tail.strip():
        raw = [*raw[:-1], raw[-1] + tail] if raw and len(tail) < least else [*raw, tail]

    def repair(done, waiting, left):
        if not left:
            return [*done[:-1], done[-1] + waiting] if done else []
        piece, word = waiting + left[0], (waiting + left[0]).strip()
        tiny = word.isalpha() and len(word) <= 2 and (len(done) > 0 or len(raw) > 1)
        if good(piece) and not tiny:
            return repair([*done, piece], "", left[1:])
        return repair([*done[:-1], done[-1] + piece], "", left[1:]) if done else repair(done, piece, left[1:])

    return repair([], "", raw)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab1_- .中文é\n!", min_size=1, max_size=120), st.integers(0, 10**6))
def test_all_modes_against_plain_versions(text, seed):
    rng = random.Random(seed)
    ends = sorted(rng.sample(range(1, len(text) + 1), rng.randint(1, len(text))))
    if ends[-1] != len(text):
        ends.append(len(text))
    flags = S.inside_word_flags(text)
    assert flags.tolist() == [plain_inside(text, c) for c in range(len(text) + 1)]
    inside = flags[ends].tolist()
    mask = cuttable(ends, text).tolist()
    free = [i for i in range(len(ends) - 1) if mask[i] and not inside[i]]

    fixed, last = [], -1
    while more := [i for i in free if i >= last + 3]:
        last = more[0]
        fixed.append(last)
    assert S.fixed_length_boundaries(mask, 3, 2, inside) == fixed

    drawn, last, draw = [], -1, random.Random(seed + 1)
    while (target := last + draw.randint(2, 5)) < len(ends) - 1 and (more := [i for i in free if i >= target]):
        last = more[0]
        drawn.append(last)
    assert S.random_length_boundaries(mask, 2, 5, random.Random(seed + 1).randint, inside) == drawn

    conf = [rng.choice([0.1, 0.2, 0.3, 0.6, 0.9]) for _ in ends]
    chosen = S.threshold_boundaries(conf, mask, 0.4, 2, inside)
    assert all(mask[i] and not inside[i] for i in chosen) and all(b - a >= 2 for a, b in zip([-1, *chosen], chosen, strict=False))

    some = sorted(rng.sample(range(len(ends)), rng.randint(0, len(ends))))
    for picked in (fixed, drawn, chosen, some):
        least = rng.randint(1, 6)
        pieces = S.split_text(text, ends, picked, least, flags)
        assert pieces == plain_split(text, ends, picked, least)
        assert not pieces or "".join("".join(pieces).split()) == "".join(text.split())


def test_split_joins_to_neighbours():
    assert split("11_.1", [3, 5], [0], 2) == ["11_.1"]
    assert split("ab cde fgh", [2, 6, 10], [0, 1], 2) == ["ab cde", " fgh"]
    assert split("abc x def", [3, 5, 9], [0, 1], 2) == ["abc x", " def"]


def test_long_texts_in_which_nothing_stands_take_linear_time():
    text = "!? a.. " * 60_000
    began = time.process_time()
    pieces = S.split_text(text, list(range(7, len(text) + 1, 7)), list(range(0, 60_000 - 1)), 7, S.inside_word_flags(text))
    assert pieces == [] and time.process_time() - began < 5
