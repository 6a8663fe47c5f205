"""Columns over text: white space, paragraphs, tokens, words and segments, without a shuffle.

All are native but one: running sums inside an array, which Spark's folds would copy at each step,
take one small Arrow function over the lengths alone.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as str.isspace sees it, in a form that Java and RE2 both read.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ALNUM = r"[\p{L}\p{N}]"
#: The default tokenizer. Lossless; it splits words, so cuts inside words do occur.
TOKEN_PATTERN = r"(?s) ?\p{L}{1,4}| ?\p{N}{1,3}|\s+|."
#: A short formula such as x+y=2, on stripped text.
FORMULA = rf"^[A-Za-z0-9]+(?:{SPACE}*[-+*/=<>^%:]+{SPACE}*[A-Za-z0-9]+)+$"
#: Connectors inside a word: the first of a run between letters or digits, and those that follow it.
CONNECTED = rf"(?<={ALNUM})[_-](?=[_-]*+{ALNUM})|\G(?<=[_-])[_-]"
#: Characters between which a cut is free (unified ideographs).
CJK = r"[\x{4e00}-\x{9fff}]"
#: A tokenizer: from a text column to an array column of its tokens, which joined are the text.
Tokenizer = Callable[[Column], Column]


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def is_blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(f"[^{SPACE[1:]}")


def split_paragraphs(text: Column) -> Column:
    """Pieces between empty lines, stripped, without empty ones; '' and null give an empty array."""
    pieces = F.transform(F.split(F.coalesce(text, F.lit("")), "\n\n", -1), strip)
    return F.filter(pieces, lambda x: x != "")


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), 0)


def _running_sums(lists: pa.Array) -> pa.Array:
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    sums = np.concatenate([[0], np.cumsum(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)])
    own = sums[1:] - np.repeat(sums[cuts[:-1]], sizes)
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(own), mask=lists.is_null())


def ends_of(lengths: Column) -> Column:
    """Where each of consecutive pieces ends, from the array of their lengths; null stays null."""
    return F.arrow_udf(_running_sums, "array<bigint>")(lengths)


def lengths(pieces: Column) -> Column:
    return F.transform(pieces, lambda x: F.length(x))


def token_rows(rows: DataFrame, key: str, text: str, tokenizer: Tokenizer = tokens) -> DataFrame:
    """(key, idx, token, start, end): code points, half-open; one row per token."""
    listed = rows.select(key, tokenizer(F.col(text)).alias("token"))
    zipped = listed.select(key, F.posexplode(F.arrays_zip("token", ends_of(lengths(F.col("token"))).alias("end"))).alias("idx", "t"))
    return zipped.select(key, F.col("idx").cast("long").alias("idx"), "t.token", (F.col("t.end") - F.length("t.token")).alias("start"), "t.end")


def inside_word(left: Column, right: Column) -> Column:
    """Whether a cut between two texts lies inside a word."""
    left = F.reverse(left)  # so that both are read from the cut on
    cjk = left.rlike(f"^{CJK}") & right.rlike(f"^{CJK}")
    return left.rlike(rf"^[_-]*{ALNUM}") & right.rlike(rf"^[_-]*{ALNUM}") & ~cjk


def inside_word_ends(rows: DataFrame, key: str, text: str, tokenizer: Tokenizer = tokens) -> DataFrame:
    """(key, idx, end, inside) of every token: whether a cut after it lies inside a word.

    A text becomes words and single characters; a cut is inside a word if neither of these ends
    there, unless ideographs stand on both sides. Arrays are compared row by row, so no text is
    joined to its tokens.
    """
    listed = rows.select(key, tokenizer(F.col(text)).alias("token"), F.regexp_extract_all(words_filled(F.col(text)), F.lit(f"{ALNUM}+|(?s:.)"), 0).alias("piece"))
    ends = listed.select(key, "token", ends_of(lengths(F.col("token"))).alias("ends"), ends_of(lengths(F.col("piece"))).alias("free"))
    marked = lambda found, inside: F.transform(found, lambda e: F.struct(e.alias("end"), F.lit(inside).alias("inside")))
    flags = F.array_sort(F.concat(marked(F.array_except("ends", "free"), True), marked(F.array_intersect("ends", "free"), False)))
    cjk = F.transform("token", lambda t, i: t.rlike(f"{CJK}$") & F.coalesce(F.get("token", i + 1).rlike(f"^{CJK}"), F.lit(False)))
    zipped = ends.select(key, F.posexplode(F.arrays_zip(flags.alias("at"), cjk.alias("cjk"))).alias("idx", "c"))
    return zipped.select(key, F.col("idx").cast("long").alias("idx"), F.col("c.at.end").alias("end"), (F.col("c.at.inside") & ~F.col("c.cjk")).alias("inside"))


def words_filled(text: Column) -> Column:
    """text with a letter for each connector inside a word, so that the characters beside a cut tell of it."""
    return F.regexp_replace(text, CONNECTED, "w")


def is_valid_segment(text: Column) -> Column:
    """Three letters or digits in a row, or one run of two, or a short formula."""
    runs = F.regexp_extract_all(text, F.lit(f"{ALNUM}+"), 0)
    return text.rlike(f"{ALNUM}{{3,}}") | ((F.size(runs) == 1) & (F.length(F.get(runs, 0)) >= 2)) | strip(text).rlike(FORMULA)
