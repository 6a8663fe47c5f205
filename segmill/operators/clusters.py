"""Low-confidence tokens, their runs, and the order in which a run's tokens are tried."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def low_confidence(tokens: DataFrame, tau) -> DataFrame:
    """Cuttable tokens whose confidence is strictly under tau (NaN never is)."""
    return tokens.where(F.col("cuttable") & (F.col("confidence") < tau))


def clusters(low: DataFrame, key: str = "source_idx") -> DataFrame:
    """low with `island`: equal for tokens of one run of consecutive indices."""
    order = Window.partitionBy(key).orderBy("idx")
    return low.withColumn("island", F.col("idx") - F.row_number().over(order))


def try_order(islands: DataFrame, key: str = "source_idx") -> DataFrame:
    """islands with `turn`: 1 for the least confident token of its run; ties by index."""
    order = Window.partitionBy(key, "island").orderBy("confidence", "idx")
    return islands.withColumn("turn", F.row_number().over(order).cast("long"))
