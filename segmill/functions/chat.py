"""Chat samples: roles, completeness, prompt text and training records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmill.functions.text import split_paragraphs

ROLES = {"system_prompt": "system", "question": "user", "gt_output": "assistant"}


def roles_of_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation from one row per turn: the first turn of each role, '' if there is none.

    The first message wins even if it is empty. min_by combines map-side, so a long conversation
    costs the shuffle one row per map task.
    """
    first = {name: F.coalesce(F.min_by("text", F.when(F.col("role") == role, F.col("turn"))), F.lit("")) for name, role in ROLES.items()}
    return turns.groupBy(key).agg(*[c.alias(name) for name, c in first.items()])


def roles_of_messages(system: Column, messages: Column) -> dict[str, Column]:
    """The same from an array of {from, value}; the record's own system field comes first."""

    def first(role: str) -> Column:
        return F.coalesce(F.get(F.filter(messages, lambda m: m["from"] == role), F.lit(0))["value"], F.lit(""))

    return {"system_prompt": F.coalesce(system, F.lit("")), "question": first("user"), "gt_output": first("assistant")}


def is_usable() -> Column:
    return (F.col("question") != "") & (F.col("gt_output") != "")


def render_prompt() -> tuple[Column, Column]:
    """(prefix_text, full_text): the chat without and with its answer, in this library's own template."""
    system = F.when(F.col("system_prompt") != "", F.concat(F.lit("[system]\n"), "system_prompt", F.lit("\n"))).otherwise("")
    prefix = F.concat(system, F.lit("[user]\n"), "question", F.lit("\n[assistant]\n"))
    return prefix, F.concat(prefix, "gt_output")


def training_record() -> list[Column]:
    """The eight fields of a training record whose thoughts are the answer's paragraphs."""
    return [
        F.col("source_idx"), F.col("system_prompt"), F.col("question"), F.col("gt_output"),
        split_paragraphs(F.col("question")).alias("question_list"), split_paragraphs(F.col("gt_output")).alias("thoughts_list"),
        split_paragraphs(F.col("system_prompt")).alias("system_list"), F.lit(True).alias("add_eos"),
    ]
