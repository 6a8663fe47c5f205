"""Confidence of a token from its left neighbour, by counts over the corpus.

conf(t_i) = (c(t_{i-1}, t_i) + 1) / (c(t_{i-1}) + V), with V distinct tokens; a row's first token
follows a start mark. Counts combine map-side; a pair's context count is joined at pair level, so
token rows meet counts in one join. Frequent pairs, of which there are few, are broadcast first and
their rows are dealt out evenly, so no key of the join has many rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmill.functions.text import tokens
from segmill.sources.staging import stage

START = "\u0002"
#: Pairs that are broadcast: those with at least this share of all tokens, so at most so many.
MOST_FREQUENT = 10_000


def pair_rows(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, idx, prev, token), without a shuffle."""
    listed = rows.select(key, tokens(F.col(text)).alias("tokens"))
    before = F.concat(F.array(F.lit(START)), F.slice("tokens", F.lit(1), F.greatest(F.size("tokens") - 1, F.lit(0))))
    pairs = F.arrays_zip(before.alias("prev"), F.col("tokens").alias("token"))
    return listed.where(F.size("tokens") > 0).select(key, F.posexplode(pairs).alias("idx", "p")).select(key, F.col("idx").cast("long").alias("idx"), F.col("p.prev").alias("prev"), F.col("p.token").alias("token"))


def ngram_confidence(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, idx, token, confidence) of every token."""
    pairs = pair_rows(rows, key, text)
    counts = stage(pairs.groupBy("prev", "token").agg(F.count(F.lit(1)).alias("c")))
    size, total = counts.agg(F.countDistinct("token"), F.coalesce(F.sum("c"), F.lit(0))).first()
    context = counts.groupBy("prev").agg(F.sum("c").alias("c_prev"))
    model = stage(counts.join(context, "prev").select("prev", "token", "c", ((F.col("c") + 1).cast("double") / (F.col("c_prev") + size)).alias("confidence")))
    frequent = F.col("c") * MOST_FREQUENT >= total
    often = F.broadcast(model.where(frequent).select("prev", "token", F.col("confidence").alias("often")))
    spread = F.concat(F.lit(START * 2), F.xxhash64(key, "idx").cast("string"))  # matches no pair
    met = pairs.join(often, ["prev", "token"], "left").withColumn("prev", F.when(F.col("often").isNull(), F.col("prev")).otherwise(spread))
    found = met.join(model.where(~frequent).drop("c"), ["prev", "token"], "left")
    return found.select(key, "idx", "token", F.coalesce("often", "confidence").alias("confidence"))


def confidence_arrays(scores: DataFrame, key: str) -> DataFrame:
    """(key, confidences) from one row per token; a group is one row's tokens."""
    listed = scores.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("idx", "confidence"))).alias("s"))
    return listed.select(key, F.transform("s", lambda x: x["confidence"]).alias("confidences"))
