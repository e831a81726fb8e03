"""Multi-turn questions and their running history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelboard.functions.text import is_blank, strip

_CHUNK = 256


def normalize_turn_questions(rows: DataFrame) -> DataFrame:
    """question_id, category, turns: id and prompt fallbacks, blank turns dropped."""
    listed = F.filter(F.transform("turns", lambda t: strip(t)), lambda t: t != "")
    single = F.coalesce("question", "prompt")
    turns = F.when(F.coalesce(F.size("turns"), F.lit(0)) > 0, listed).otherwise(
        F.when(is_blank(single), F.array().cast("array<string>")).otherwise(
            F.array(strip(single))
        )
    )
    return (
        rows.select(
            F.coalesce("question_id", "id").alias("question_id"),
            "category",
            turns.alias("turns"),
            "ord",
        )
        .where(F.col("question_id").isNotNull() & (F.size("turns") > 0))
    )


def interleave(turns: Column, outputs: Column) -> Column:
    """user, assistant, user, assistant, ... messages of one conversation."""
    pairs = F.zip_with(
        turns,
        outputs,
        lambda u, a: F.array(
            F.struct(F.lit("user").alias("role"), u.alias("content")),
            F.struct(F.lit("assistant").alias("role"), a.alias("content")),
        ),
    )
    return F.flatten(pairs)


def running_prompts(rows: DataFrame) -> DataFrame:
    """question_id, turn, messages: the prompt of every turn with its history.

    The conversation is one row, so the history is a slice of that row's
    messages: no window, no shuffle.
    """
    talk = rows.withColumn("_m", interleave(F.col("turns"), F.col("outputs")))
    return talk.select(
        "question_id",
        "_m",
        F.explode(F.sequence(F.lit(0), F.size("turns") - 1)).alias("turn"),
    ).select(
        "question_id",
        "turn",
        F.slice("_m", F.lit(1), F.col("turn") * 2 + 1).alias("messages"),
    )


def running_totals(turn_rows: DataFrame, key: str, order: str, measures: dict[str, Column]) -> DataFrame:
    """Totals over all earlier rows of the same key, for rows in long form.

    Two levels: totals per chunk of positions, running totals over the chunks,
    then a window inside each chunk. A key with a very large share of the rows is
    split over many tasks instead of being sorted in one.
    """
    names = list(measures)
    marked = turn_rows.withColumns(
        {f"_{n}": c for n, c in measures.items()}
    ).withColumn("_chunk", F.floor(F.col(order) / _CHUNK).cast("bigint"))
    chunks = marked.groupBy(key, "_chunk").agg(*[F.sum(f"_{n}").alias(n) for n in names])
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = chunks.select(
        key,
        "_chunk",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_{n}_before") for n in names],
    )
    inside = Window.partitionBy(key, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = marked.select(
        *turn_rows.columns,
        "_chunk",
        *[F.coalesce(F.sum(f"_{n}").over(inside), F.lit(0)).alias(f"_{n}_local") for n in names],
    )
    return local.join(offsets, [key, "_chunk"]).select(
        *turn_rows.columns,
        *[(F.col(f"_{n}_before") + F.col(f"_{n}_local")).alias(n) for n in names],
    )


def multi_turn_answers(rows: DataFrame, model_id: str, tstamp: Column) -> DataFrame:
    """Stored answer shape: one choice with the outputs of all turns."""
    return rows.select(
        "question_id",
        F.md5(F.concat_ws("|", F.lit(model_id), F.col("question_id"))).alias("answer_id"),
        F.lit(model_id).alias("model_id"),
        F.array(F.struct(F.lit(0).alias("index"), F.col("outputs").alias("turns"))).alias("choices"),
        tstamp.alias("tstamp"),
        "category",
    )
