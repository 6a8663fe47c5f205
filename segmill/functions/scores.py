"""Token confidences: from log-probabilities, and the windows in which a scorer reads long answers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the least log-probability; missing ones count as this.
LEAST_LOGPROB = -100.0


def logprob_confidence(logprobs: Column, n_tokens: Column) -> Column:
    """exp of each log-probability, floored, padded or cut to the number of tokens."""
    missing = F.greatest(n_tokens - F.size(logprobs), F.lit(0)).cast("int")
    padded = F.concat(logprobs, F.array_repeat(F.lit(LEAST_LOGPROB), missing))
    return F.transform(F.slice(padded, F.lit(1), n_tokens.cast("int")), lambda x: F.exp(F.greatest(F.coalesce(x, F.lit(LEAST_LOGPROB)), F.lit(LEAST_LOGPROB))))


def logprob_at(logprobs: Column, position: Column, full_length: Column, start: Column) -> Column:
    """The log-probability of an absolute position, from a list that is whole or begins at `start`.

    A list of exactly the truncated length is read from `start`; else the position itself counts if
    it is inside, else the position from `start`; else null.
    """
    size, shifted = F.size(logprobs), position - start
    cut = (start >= 0) & (size == F.greatest(full_length - start, F.lit(0))) & (shifted >= 0) & (shifted < size)
    return (
        F.when(cut, F.get(logprobs, shifted.cast("int")))
        .when((position >= 0) & (position < size), F.get(logprobs, position.cast("int")))
        .when((shifted >= 0) & (shifted < size), F.get(logprobs, shifted.cast("int")))
    )


def checked_stride(window: int, stride: int | None = None) -> int:
    """The stride (a quarter of the window if none is given); over the window it would leave tokens out, so it raises."""
    stride = max(1, window // 4) if stride is None else stride
    if not 0 < stride <= window:
        raise ValueError("stride must be positive and at most the window")
    return stride


def window_count(n_tokens: Column, window: int, stride: int | None = None) -> Column:
    """Scoring windows that cover n tokens, each further one with at most `stride` fresh ones."""
    stride = checked_stride(window, stride)
    more = 1 + F.ceil((n_tokens - window) / stride)
    return F.when(n_tokens <= 0, 0).when(n_tokens <= window, 1).otherwise(more).cast("long")


def scoring_windows(n_tokens: Column, window: int, stride: int | None = None) -> Column:
    """Array of (window_idx, start, end, fresh_start); fresh_start is relative to the window."""
    stride = checked_stride(window, stride)
    k = window_count(n_tokens, window, stride)
    rows = F.transform(
        F.sequence(F.lit(0).cast("long"), k - 1),
        lambda i: F.struct(
            i.alias("window_idx"),
            (i * stride).alias("start"),
            F.least(i * stride + window, n_tokens).cast("long").alias("end"),
            F.when(i == 0, 0).otherwise(window - stride).cast("long").alias("fresh_start"),
        ),
    )
    return F.when(k > 0, rows).otherwise(F.array().cast("array<struct<window_idx:bigint,start:bigint,end:bigint,fresh_start:bigint>>"))
