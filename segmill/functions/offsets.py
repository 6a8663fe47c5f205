"""Tokens of an answer as its prompt and it are tokenized together, with offsets of their own.

A tokenizer here gives (token, start, end) over a whole text, half-open in code points. Spans may
leave gaps, overlap or be empty: byte-level tokenizers give several tokens of one character the same
span, others drop white space. Tokens that end in the prompt are not the answer's; one that straddles
its edge begins at 0.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from segmill.functions.chat import render_prompt
from segmill.functions.text import Tokenizer, ends_of, lengths

SPANS = "array<struct<token:string,start:int,end:int>>"


def with_offsets(tokenizer: Tokenizer) -> Callable[[Column], Column]:
    """A tokenizer whose tokens joined are the text, as one with offsets."""

    def spans(text: Column) -> Column:
        token = tokenizer(text)
        zipped = F.arrays_zip(token.alias("token"), ends_of(lengths(token)).alias("end"))
        return F.transform(zipped, lambda t: F.struct(t["token"].alias("token"), (t["end"] - F.length(t["token"])).cast("int").alias("start"), t["end"].cast("int").alias("end")))

    return spans


@cache
def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer as Library

    return Library.from_file(path)


def library_tokenizer(path: str) -> Callable[[Column], Column]:
    """A tokenizers file as a tokenizer with offsets, batch by batch in Arrow; null stays null."""

    def run(texts: pa.Array) -> pa.Array:
        found = _library(path).encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)
        cuts = np.cumsum([0, *(len(e.ids) for e in found)], dtype=np.int32)
        places = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in found)), np.int32, 2 * int(cuts[-1])).reshape(-1, 2)
        fields = [pa.array(list(chain.from_iterable(e.tokens for e in found)), pa.string()), pa.array(np.ascontiguousarray(places[:, 0])), pa.array(np.ascontiguousarray(places[:, 1]))]
        return pa.ListArray.from_arrays(pa.array(cuts), pa.StructArray.from_arrays(fields, names=["token", "start", "end"]), mask=texts.is_null())

    return F.arrow_udf(run, SPANS)


@dataclass(frozen=True)
class InContext:
    """Tokens of an answer from the whole chat, in place of a tokenizer of the answer alone.

    prompt gives the columns (prefix, whole text); the prefix must be how the whole begins.
    """

    tokenizer: Callable[[Column], Column]
    prompt: Callable[[], tuple[Column, Column]] = render_prompt

    def spans(self) -> Column:
        """The answer's tokens: (token, start, end) within the answer."""
        prefix, whole = self.prompt()
        return clamped(self.tokenizer(whole), F.length(prefix))


def clamped(spans: Column, edge: Column) -> Column:
    """Spans that end after the edge, counted from it; what begins before it begins at 0."""
    moved = lambda t: F.struct(t["token"].alias("token"), F.greatest(t["start"] - edge, F.lit(0)).cast("int").alias("start"), (t["end"] - edge).cast("int").alias("end"))
    return F.transform(F.filter(spans, lambda t: t["end"] > edge), moved)


def answer_tokens(tokenizer: Tokenizer | InContext, text: str = "gt_output") -> Column:
    """The answer's tokens as texts, by either kind of tokenizer."""
    if isinstance(tokenizer, InContext):
        return F.transform(tokenizer.spans(), lambda t: t["token"])
    return tokenizer(F.col(text))
