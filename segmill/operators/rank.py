"""Exact positions and order statistics without a single task that sorts everything.

Rows are range-partitioned by their order and sorted inside partitions. There monotonically
increasing ids number them: partition in the upper bits, row in the lower ones. The numbers of rows
before each partition (one number a partition) turn that into a position, without a second shuffle.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from segmill.sources.staging import stage

#: Fixed value: bits of a monotonically increasing id that number the rows of a partition.
_ROW_BITS = 33
#: Drawn positions (8 bytes each) that are broadcast at most.
BROADCAST_POSITIONS = 1_000_000


def _ranged(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """df with _part and _row, staged, so both stay as they are."""
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    rows = rows.withColumn("_part", F.shiftright("_id", _ROW_BITS)).withColumn("_row", F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1))
    return stage(rows.drop("_id"))


def _before(sums: DataFrame) -> DataFrame:
    """(_part, _before) from (_part, _sum): what all partitions before hold; one row a partition."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select("_part", "_sum", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))


def with_position(df: DataFrame, *order: str, name: str = "source_idx") -> DataFrame:
    """A dense 0-based position by `order` (ties in any order)."""
    rows = _ranged(df, order)
    starts = _before(rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_sum"))).drop("_sum")
    return rows.join(F.broadcast(starts), "_part").withColumn(name, F.col("_before") + F.col("_row")).drop("_part", "_row", "_before")


def _wanted(quantiles: Sequence[float]) -> dict[str, float]:
    """Quantiles by their keys; of equal keys the last counts."""
    if not quantiles or any(not 0 <= q <= 1 for q in quantiles):
        raise ValueError("quantiles must lie between 0 and 1, one at least")
    return {f"q_{q:.4f}": float(q) for q in quantiles}


def exact_quantiles(df: DataFrame, value: str, quantiles: Sequence[float]) -> DataFrame:
    """(tau_key, quantile, tau): the value at place round((n - 1) q), half to even, of the sorted values.

    Equal values are counted first, so ties cost nothing; only partitions that hold a wanted place
    are looked at again. Without a value tau is null; of equal keys the last quantile counts.
    """
    wanted = _wanted(quantiles)
    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("tau")).agg(F.count(F.lit(1)).alias("n"))
    return _at_places(counts, wanted).select("tau_key", "quantile", "tau")


def bracket_quantiles(df: DataFrame, value: str, quantiles: Sequence[float], accuracy: int = 10_000) -> DataFrame:
    """exact_quantiles() of a large pool without sorting or shuffling it: two passes that combine map-side.

    A sketch gives each quantile a bracket of values that holds it, about 4 in `accuracy` of the pool.
    The second pass counts the values inside brackets one by one and those between brackets as a whole,
    so only what the brackets hold is ranked. Should a place fall outside (the sketch's bound is a
    promise of its own), all values are ranked.
    """
    wanted = _wanted(quantiles)
    rows = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    slack = 2 / accuracy
    edges = [min(1.0, max(0.0, q + side)) for q in wanted.values() for side in (-slack, slack)]
    number = F.when(~F.isnan("v"), F.col("v"))  # NaN comes after all numbers, in a group of its own
    found = rows.agg(F.percentile_approx(number, edges, accuracy)).first()[0]
    if found is None:
        return exact_quantiles(rows, "v", quantiles)
    brackets: list[list[float]] = []
    for low, high in sorted(zip(found[::2], found[1::2], strict=True)):
        if brackets and low <= brackets[-1][1]:
            brackets[-1][1] = max(high, brackets[-1][1])
        else:
            brackets.append([low, high])
    inside, gap = F.lit(False), F.lit(0)
    for low, high in brackets:
        inside, gap = inside | F.col("v").between(low, high), gap + F.when(F.col("v") > high, 1).otherwise(0)
    counts = rows.groupBy(F.when(inside, F.col("v")).alias("one"), F.when(~inside, gap).alias("gap")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("tau"))
    placed = stage(_at_places(counts.select("tau", "n", F.col("gap").isNotNull().alias("many")), wanted))
    if not placed.where("many").isEmpty():
        return exact_quantiles(rows, "v", quantiles)
    return placed.select("tau_key", "quantile", "tau")


def _at_places(counts: DataFrame, wanted: dict[str, float]) -> DataFrame:
    """(tau_key, quantile, and what counts(tau, n, ...) says) at each wanted place of values that stand n times each."""
    ranked = _ranged(counts, ["tau"])
    held, before, first = [], 0, {}
    sums = sorted(tuple(r) for r in ranked.groupBy("_part").agg(F.sum("n")).collect())  # one number a partition
    total = sum(n for _, n in sums)
    places = [(k, q, round((total - 1) * q)) for k, q in wanted.items()]  # one row a quantile
    for part, n in sums:
        if any(before <= place < before + n for _, _, place in places):
            held.append(part)
            first[part] = before
        before += n
    places = counts.sparkSession.createDataFrame(places, "tau_key string, quantile double, place long")
    own = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    starts = F.coalesce(*[F.when(F.col("_part") == part, F.lit(n)) for part, n in first.items()], F.lit(0)).cast("long")
    last = ranked.where(F.col("_part").isin(held)).withColumn("first", starts + F.sum("n").over(own) - F.col("n"))
    inside = (F.col("place") >= F.col("first")) & (F.col("place") < F.col("first") + F.col("n"))
    found = last.join(F.broadcast(places), inside).drop("_part", "_row", "first", "n", "place", "quantile")
    return places.drop("place").join(found, "tau_key", "left")


def position_sample(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """The rows that Python's seeded generator draws: positions random.Random(seed).sample(range(n), size) of a dense 0-based key.

    Only the drawn positions go through the driver, `size` numbers; rows meet them in a semi-join, which
    is broadcast up to BROADCAST_POSITIONS of them.
    """
    n = df.count()
    if not 0 < size <= n:
        raise ValueError(f"sample of {size} from {n} rows")
    drawn = df.sparkSession.createDataFrame(pd.DataFrame({key: sorted(random.Random(seed).sample(range(n), size))}))
    return df.join(F.broadcast(drawn) if size <= BROADCAST_POSITIONS else drawn, key, "left_semi")


def hash_sample(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """Exactly `size` rows (all, if there are fewer), drawn by a seeded hash of the key."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(size)
