"""A user's scorer over windows of long answers, and one array of confidences per answer put together again.

An answer of n tokens becomes windows of at most `window` tokens; all tokens of the first one are
fresh, of each further one the last `stride`, and the tokens before those are context. Windows are rows
of their own, dealt out by (row, window), so one very long answer keeps many tasks busy. A window
carries its own tokens alone, never the whole answer. Confidences of the fresh ranges, in order of
windows, are the answer's: they cover each token once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmill.functions.chat import is_usable, render_prompt
from segmill.functions.offsets import InContext, answer_tokens, with_offsets
from segmill.functions.protected import PROTECTED, is_cuttable, protected_spans
from segmill.functions.scores import scoring_windows
from segmill.functions.text import Tokenizer, tokens
from segmill.sources.staging import configure


@dataclass(frozen=True)
class Window:
    """What a scorer sees of an answer: the prompt, some of its tokens, and the first of them that it is to score."""

    source_idx: int
    window_idx: int
    prefix: str
    tokens: list[str]
    fresh_start: int

    @property
    def fresh(self) -> list[str]:
        return self.tokens[self.fresh_start :]


#: Windows of a batch to the confidences of the fresh tokens of each.
Scorer = Callable[[Sequence[Window]], Iterable[Sequence[float]]]

SCORED = T.StructType().add("source_idx", T.LongType()).add("window_idx", T.LongType()).add("n_fresh", T.LongType()).add("confidences", T.ArrayType(T.DoubleType()))


def window_rows(samples: DataFrame, window: int, stride: int | None = None, tokenizer: Tokenizer | InContext = tokens, prefix: Column | None = None, tasks: int | None = None) -> DataFrame:
    """(source_idx, window_idx, prefix, tokens, fresh_start) of the usable samples' answers, spread evenly over `tasks`.

    prefix is what a scorer reads before the answer, by default the chat up to it. The number of tasks
    (by default that of the session's shuffles) is kept even if the windows are few bytes: a window
    costs what the scorer takes for it, not what it weighs.
    """
    tasks = tasks or int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    before = render_prompt()[0] if prefix is None else prefix
    listed = samples.where(is_usable()).select("source_idx", before.alias("prefix"), answer_tokens(tokenizer).alias("listed"))
    cut = F.transform(
        scoring_windows(F.size("listed").cast("long"), window, stride),
        lambda w: F.struct(
            w["window_idx"].alias("window_idx"),
            F.slice(F.col("listed"), (w["start"] + 1).cast("int"), (w["end"] - w["start"]).cast("int")).alias("tokens"),
            w["fresh_start"].alias("fresh_start"),
        ),
    )
    return listed.select("source_idx", "prefix", F.inline(cut)).repartition(tasks, "source_idx", "window_idx").select("source_idx", "window_idx", "prefix", "tokens", "fresh_start")


def score_windows(windows: DataFrame, load: Callable[[], Scorer]) -> DataFrame:
    """SCORED of window_rows(). load() is called once a task and gives the scorer, so a model is read once a task.

    A scorer that gives another number of confidences than there are fresh tokens, or a value that is
    no number, raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = load()
        for batch in batches:
            rows = [Window(**r) for r in batch.to_pylist()]
            found = [list(c) for c in scorer(rows)]
            if len(found) != len(rows):
                raise ValueError(f"the scorer gave {len(found)} results for {len(rows)} windows")
            for w, c in zip(rows, found, strict=True):
                if len(c) != len(w.fresh) or any(x is None for x in c):
                    raise ValueError(f"window {w.window_idx} of source_idx {w.source_idx} has {len(w.fresh)} fresh tokens and got {sum(x is not None for x in c)} confidences")
            columns = [pa.array([w.source_idx for w in rows], pa.int64()), pa.array([w.window_idx for w in rows], pa.int64()), pa.array([len(w.fresh) for w in rows], pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(pa.float64()))], names=SCORED.names)

    configure(windows.sparkSession)
    return windows.mapInArrow(run, SCORED)


def stitch(scored: DataFrame) -> DataFrame:
    """(source_idx, confidences): the windows' fresh ranges put together in order; a group is one answer's windows.

    A window that is missing, or there twice, raises: its answer would get the confidences of other tokens.
    """
    listed = scored.groupBy("source_idx").agg(F.array_sort(F.collect_list(F.struct("window_idx", "confidences"))).alias("w"))
    whole = F.forall(F.transform("w", lambda w, i: w["window_idx"] == i), lambda x: x)
    message = F.concat(F.lit("windows of source_idx "), F.col("source_idx").cast("string"), F.lit(" are missing or repeated"))
    joined = F.flatten(F.transform("w", lambda w: w["confidences"]))
    return listed.select("source_idx", F.when(whole, joined).otherwise(F.raise_error(message).cast("array<double>")).alias("confidences"))


def score_answers(samples: DataFrame, load: Callable[[], Scorer], window: int, stride: int | None = None, tokenizer: Tokenizer | InContext = tokens, prefix: Column | None = None) -> DataFrame:
    """(source_idx, confidences) of all usable samples, as convert() takes them: windows, a user's scorer, and the stitch."""
    return stitch(score_windows(window_rows(samples, window, stride, tokenizer, prefix), load))


def confidence_rows(samples: DataFrame, scores: DataFrame, special: Sequence[str] = (), tokenizer: Tokenizer | InContext = tokens, strings: Sequence[str] = PROTECTED) -> DataFrame:
    """(source_idx, idx, token, confidence, cuttable) for estimate_tau() from arrays of confidences."""
    configure(samples.sparkSession)
    spans = tokenizer.spans() if isinstance(tokenizer, InContext) else with_offsets(tokenizer)(F.col("gt_output"))
    listed = samples.where(is_usable()).join(scores, "source_idx").select("source_idx", "confidences", spans.alias("at"), protected_spans(F.col("gt_output"), strings).alias("spans"))
    flagged = F.transform(
        F.arrays_zip("at", "confidences"),
        lambda t: F.struct(t["at"]["token"].alias("token"), t["confidences"].alias("confidence"), is_cuttable(t["at"]["token"], t["at"]["start"], t["at"]["end"], F.col("spans"), special).alias("cuttable")),
    )
    rows = listed.select("source_idx", F.posexplode(flagged).alias("idx", "t"))
    return rows.select("source_idx", F.col("idx").cast("long").alias("idx"), "t.token", "t.confidence", "t.cuttable")
