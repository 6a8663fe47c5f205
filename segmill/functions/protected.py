"""Protected strings: where they stand and which tokens they forbid to cut."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.functions.text import Tokenizer, ends_of, lengths, tokens

#: Strings that no cut may split.
PROTECTED = (
    "<｜begin▁of▁sentence｜>",
    "<｜User｜>",
    "<｜Assistant｜>",
    "<think>",
    "</think>",
    "<|im_start|>",
    "<|im_end|>",
    "<|splitter|>",
    "<|continue|>",
    "<|recover|>",
    "<|begin_of_thought|>",
    "<|end_of_thought|>",
    "<|begin_of_solution|>",
    "<|end_of_solution|>",
)


#: Strings that are looked for one by one.
FEW = 32
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("token", pa.string())]))


def quoted(text: str) -> str:
    """A pattern, as Java and RE2 read it, of the text itself."""
    return re.sub(r"([\\.^$|?*+()\[\]{}])", r"\\\1", text)


def count_protected(text: Column, strings: Sequence[str] = PROTECTED) -> Column:
    """How often protected strings occur (those of the default list cannot overlap)."""
    begin = os.path.commonprefix(list(strings))  # read first, so that most places fail at once
    rest = "|".join(quoted(t[len(begin) :]) for t in strings)
    return F.regexp_count(text, F.lit(f"{quoted(begin)}(?:{rest})")).cast("long")


@cache
def _automaton(strings: tuple[str, ...]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for token in strings:
        found.add_word(token, token)
    found.make_automaton()
    return found


def occurrences(text: str, strings: Sequence[str] = PROTECTED) -> list[tuple[int, int, str]]:
    """Sorted (start, end, token): each string's hits from the left, those of one string never overlap, those of two may.

    A few strings are looked for one by one; many by one automaton in one pass, whatever their number.
    """
    hits = []
    if len(strings) <= FEW:
        for token in dict.fromkeys(strings):
            at = text.find(token)
            while at >= 0:
                hits.append((at, at + len(token), token))
                at = text.find(token, at + len(token))
    elif strings:
        free: dict[str, int] = {}
        for last, token in _automaton(tuple(strings)).iter(text):
            start = last + 1 - len(token)
            if start >= free.get(token, 0):
                free[token] = last + 1
                hits.append((start, last + 1, token))
    return sorted(hits)


def protected_spans(text: Column, strings: Sequence[str] = PROTECTED) -> Column:
    """occurrences() as a sorted array of (start, end, token); one Arrow function over the text, null stays null."""
    if not all(strings):
        raise ValueError("a protected string must not be empty")
    own = tuple(strings)

    def run(texts: pa.Array) -> pa.Array:
        found = [None if t is None else [dict(start=a, end=b, token=token) for a, b, token in occurrences(t, own)] for t in texts.to_pylist()]
        return pa.array(found, _SPANS)

    return F.arrow_udf(run, "array<struct<start:int,end:int,token:string>>")(text)


def is_cuttable(token: Column, start: Column, end: Column, spans: Column, special: Sequence[str] = ()) -> Column:
    """Not special, not empty, and no overlap with a protected span (touching one is fine)."""
    clear = ~F.exists(spans, lambda s: (end > s["start"]) & (start < s["end"]))
    return (end > start) & clear & (~token.isin(*special) if special else F.lit(True))


def cuttable_rows(rows: DataFrame, key: str, text: str, special: Sequence[str] = (), tokenizer: Tokenizer = tokens, strings: Sequence[str] = PROTECTED) -> DataFrame:
    """(key, idx, cuttable) of every token; a text's spans are compared in its own row, not joined to its tokens."""
    listed = rows.select(key, tokenizer(F.col(text)).alias("token"), protected_spans(F.col(text), strings).alias("spans"))
    listed = listed.select(key, "spans", F.arrays_zip("token", ends_of(lengths(F.col("token"))).alias("end")).alias("at"))
    flags = F.transform("at", lambda t: is_cuttable(t["token"], t["end"] - F.length(t["token"]), t["end"], F.col("spans"), special))
    return listed.select(key, F.posexplode(flags).alias("idx", "cuttable")).withColumn("idx", F.col("idx").cast("long"))
