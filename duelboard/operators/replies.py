"""Calling a judge or scorer from Spark tasks, and reading what comes back."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from duelboard import constants as K
from duelboard import schemas
from duelboard.functions.prompts import repair_failure, repair_messages
from duelboard.functions.verdicts import parse_label
from duelboard.operators.keyed import alike
from duelboard.session import bound_batches


def call_judge(requests: DataFrame, make_reply: Callable, columns: list[str], again: int = 1) -> DataFrame:
    """Add ``reply`` and ``error`` by running a reply function on Arrow batches.

    ``make_reply()`` is called once per task and returns ``f(pandas.DataFrame) ->
    sequence``, with a text for each row or, where its call failed, the exception. Only
    the rows that failed are sent again, ``again`` times, and then become error rows (the
    dead letters). A function that raises for a whole batch says nothing about its rows,
    so these are sent one by one. ``one_by_one`` makes such a function from one that
    answers a single request.
    """
    kept = requests.select(*columns)
    bound_batches(requests.sparkSession)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)

    def run(batches):
        reply_fn = make_reply()

        def send(pdf):
            try:
                said = list(reply_fn(pdf))
                if len(said) != len(pdf):
                    raise RuntimeError("reply count differs from request count")
                return said
            except Exception as exc:
                failed = exc.with_traceback(None)  # a traceback would keep the texts of its frames
            if len(pdf) == 1:
                return [failed]
            return [send(pdf.iloc[i : i + 1])[0] for i in range(len(pdf))]

        for pdf in batches:
            said = send(pdf)
            for _ in range(again):
                failed = [i for i, value in enumerate(said) if isinstance(value, Exception)]
                for i, value in zip(failed, send(pdf.iloc[failed]) if failed else []):
                    said[i] = value
            bad = [isinstance(value, Exception) for value in said]
            yield pdf.assign(
                reply=[None if b else value for b, value in zip(bad, said)],
                error=[f"{type(value).__name__}: {value}" if b else None for b, value in zip(bad, said)],
            )

    return kept.mapInPandas(run, f"{schema}, reply string, error string")


def one_by_one(answer: Callable) -> Callable:
    """Reply function from ``answer(row) -> text``; a row's exception stays with the row."""

    def reply(pdf):
        said = []
        for row in pdf.to_dict("records"):
            try:
                said.append(answer(row))
            except Exception as exc:
                said.append(exc)
        return said

    return reply


def with_labels(replies: DataFrame, patterns=K.VERDICT_PATTERNS) -> DataFrame:
    return replies.withColumn("score", parse_label(F.col("reply"), patterns))


def repair_requests(labelled: DataFrame) -> DataFrame:
    """Second-pass requests for replies without a label."""
    return labelled.where(F.col("score").isNull() & F.col("reply").isNotNull()).select(
        "uid",
        "category",
        "game_no",
        "round_label",
        F.col("reply").alias("analysis"),
        repair_messages(F.col("category"), F.col("reply")).alias("messages"),
    )


def without_repairs(labelled: DataFrame) -> DataFrame:
    """The columns of ``apply_repairs`` where nothing was repaired."""
    return labelled.select(
        "*",
        F.lit(None).cast("array<struct<role:string,content:string>>").alias("repair_messages"),
        F.lit(None).cast("string").alias("repair_reply"),
        F.lit(False).alias("repaired"),
        F.col("error").alias("failure"),
    )


def apply_repairs(
    labelled: DataFrame, repairs: DataFrame, patterns=K.VERDICT_PATTERNS
) -> DataFrame:
    """Fill missing scores from the repair replies (uid, game_no, repair_reply and, if kept, repair_messages)."""
    parsed = repairs.withColumn("repair_score", parse_label(F.col("repair_reply"), patterns))
    named = parsed.withColumnsRenamed({"uid": "_uid", "game_no": "_game_no"})
    # dealt by uid alone, as the games of a question meet by it next: their prompts are moved once
    same = (F.col("uid") == F.col("_uid")) & alike(F.col("game_no"), F.col("_game_no"))
    joined = labelled.join(named, same, "left").drop("_uid", "_game_no")
    joined = joined.select("uid", "game_no", *[c for c in joined.columns if c not in ("uid", "game_no")])
    score = F.coalesce("score", "repair_score")
    return (
        joined.withColumn("repaired", F.col("score").isNull() & F.col("repair_score").isNotNull())
        .withColumn(
            "failure",
            F.when(
                score.isNull(),
                F.coalesce(
                    F.col("error"),
                    repair_failure(
                        F.col("uid"),
                        F.col("round_label"),
                        F.coalesce("reply", F.lit("")),
                        F.coalesce("repair_reply", F.lit("")),
                    ),
                ),
            ),
        )
        .withColumn("score", score)
        .drop("repair_score")
    )


def _answer(text: str) -> Column:
    return F.struct(F.col(text).alias("answer"))


def judgment_rows(scored: DataFrame, judge: str, model: str) -> DataFrame:
    """One record per question with both games in order: score, judgment, prompt, repair.

    The two games of a question meet in a join. Questions with a game that could not be
    scored are left for the next run.
    """
    repair = F.when(F.col("repaired"), F.struct(F.col("repair_messages").alias("prompt"), _answer("repair_reply").alias("judgment")))
    game = F.struct("score", _answer("reply").alias("judgment"), F.col("messages").alias("prompt"), repair.alias("repair"))
    good = scored.where(F.col("score").isNotNull())
    first = good.where(F.col("game_no") == 1).select("uid", "category", "baseline", game.alias("_first"))
    second = good.where(F.col("game_no") == 2).select("uid", game.alias("_second"))
    return first.join(second, "uid").select(
        "uid",
        "category",
        F.lit(judge).alias("judge"),
        F.lit(model).alias("model"),
        "baseline",
        F.array("_first", "_second").cast(schemas.GAMES).alias("games"),
    )


def as_records(judged: DataFrame) -> DataFrame:
    """Judgments whose games have all fields of a record; absent ones are null."""
    held = judged.schema["games"].dataType.elementType.fieldNames()
    fields = {field.name: field.dataType for field in DataType.fromDDL(schemas.GAMES).elementType.fields}

    def game(g: Column) -> Column:
        return F.struct(*[(g[name] if name in held else F.lit(None)).cast(kind).alias(name) for name, kind in fields.items()])

    return judged.withColumn("games", F.transform("games", lambda g: F.when(g.isNotNull(), game(g))))


def batch_scores(make_scorer: Callable):
    """Pandas UDF (prompt, responses) -> scores, scoring a whole Arrow batch at once.

    All candidates of a batch go to the scorer in one call and are cut back into
    per-prompt arrays, so the response arrays never leave their row.
    ``make_scorer()`` runs once per Python worker and returns
    ``f(list[(prompt, response)]) -> list[float]``.
    """
    if session := SparkSession.getActiveSession():
        bound_batches(session)

    @F.pandas_udf("array<double>")
    def score(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        scorer = make_scorer()
        for prompts, responses in batches:
            pairs, spans = [], []
            for prompt, candidates in zip(prompts, responses):
                start = len(pairs)
                pairs.extend((prompt, c) for c in (candidates if candidates is not None else []))
                spans.append((start, len(pairs)))
            values = list(scorer(pairs)) if pairs else []
            yield pd.Series([values[a:b] for a, b in spans])

    # A model call must not be repeated by the optimizer: as a deterministic
    # function it would be copied into every filter pushed below it.
    return score.asNondeterministic()
