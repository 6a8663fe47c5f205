"""Choosing the threshold: sample rows, score their tokens, take order statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.operators.rank import bracket_quantiles, exact_quantiles, hash_sample, position_sample

QUANTILES = (0.005, 0.01, 0.015, 0.02)
SAMPLE_SIZE, SEED, TAU_KEY = 1500, 42, "q_0.0100"


def sample_rows(df: DataFrame, size: int = SAMPLE_SIZE, seed: int = SEED, strict: bool = False, positions: bool = False) -> DataFrame:
    """source_idx of a seeded sample of exactly `size` rows; fewer rows raise if strict, else all are taken.

    The draw is by a hash of source_idx; with positions it is that of Python's generator over dense
    positions, for samples that must be those of a plain Python draw.
    """
    if size <= 0:
        raise ValueError("sample size must be positive")
    if strict and (n := df.count()) < size:
        raise ValueError(f"sample of {size} from {n} rows")
    rows = df.select("source_idx")
    return position_sample(rows, "source_idx", min(size, rows.count()), seed) if positions else hash_sample(rows, "source_idx", size, seed)


def estimate_tau(scores: DataFrame, quantiles: Sequence[float] = QUANTILES, strict: bool = False, bracket: bool = False) -> DataFrame:
    """(tau_key, quantile, tau) over the cuttable tokens' confidences; no value: null, or an error if strict.

    bracket reads the scores twice instead of shuffling their distinct values: for pools that are staged
    and have few ties.
    """
    found = (bracket_quantiles if bracket else exact_quantiles)(scores.where("cuttable"), "confidence", quantiles)
    if strict and not found.where("tau is null").isEmpty():
        raise ValueError("no cuttable token was scored")
    return found


def pick_tau(candidates: DataFrame, key: str = TAU_KEY) -> float:
    """The one value that goes to the driver; a missing key or a null raises."""
    rows = candidates.where(F.col("tau_key") == key).select("tau").head(1)
    if not rows or rows[0].tau is None:
        raise ValueError(f"no tau under {key}")
    return rows[0].tau
