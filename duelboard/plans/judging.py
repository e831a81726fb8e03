"""Pairwise judging: from questions and answers to stored judgments."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelboard.operators import replies as R
from duelboard.operators import requests as Q
from duelboard.operators.judgments import is_complete
from duelboard.operators.keyed import in_question_order, preview_with_remainder, upsert
from duelboard.plans.calls import ask_once


def pending_games(
    questions: DataFrame,
    answers: DataFrame,
    judged: DataFrame,
    target: str,
    settings: DataFrame,
) -> DataFrame:
    """Both games of every question that still needs judging."""
    pending = Q.unjudged(questions, judged, target, settings)
    paired = Q.with_answers(pending, answers, target, Q.baseline_models(settings))
    return Q.swapped_games(paired)


def require_coverage(questions, answers, target, settings) -> None:
    """Raise when an answer that judging needs is missing."""
    gaps = Q.coverage_gaps(questions, answers, target, settings)
    text = F.concat(F.lit("uid="), F.col("uid"), F.lit(" model="), F.col("model"))
    row = preview_with_remainder(gaps, text, ["ord", "model"]).first()
    if row["total"]:
        raise ValueError("Missing answer rows required for judging: " + row["preview"])


def judge_games(
    games: DataFrame,
    make_reply: Callable,
    store: str,
    make_repair: Callable | None = None,
    every: int | None = None,
) -> DataFrame:
    """uid, category, baseline, game_no, round_label, messages, reply, error, score and the repair's columns.

    Replies and repair replies are logged below ``store`` (a folder all executors share)
    and made about ``every`` at a time: a run that was stopped, started again with the
    same store, asks only for what is missing there. ``uid`` and ``game_no`` tell the
    games apart.
    """
    game = ["uid", "game_no"]
    labelled = R.with_labels(ask_once(Q.judge_requests(games), make_reply, f"{store}/replies", game, every))
    if make_repair is None:
        return R.without_repairs(labelled)
    repairs = ask_once(R.repair_requests(labelled).select(*game, "messages"), make_repair, f"{store}/repairs", game, every)
    return R.apply_repairs(
        labelled, repairs.select(*game, F.col("messages").alias("repair_messages"), F.col("reply").alias("repair_reply"))
    )


def merge_judgments(judged: DataFrame, scored: DataFrame, judge: str, target: str) -> DataFrame:
    """Stored complete judgments plus the new ones for other questions, as full records.

    Stored games that hold only some fields of a record get nulls for the others.
    """
    fresh = R.judgment_rows(scored, judge, target)
    return upsert(R.as_records(judged).select(*fresh.columns), fresh, ["uid"], is_complete(F.col("games")))


def judge_target(
    questions: DataFrame,
    answers: DataFrame,
    judged: DataFrame,
    target: str,
    judge: str,
    settings: DataFrame,
    make_reply: Callable,
    store: str,
    make_repair: Callable | None = None,
    every: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(judgments in question order, failed games) for one target model.

    Checks that categories and answers are complete, judges what has no complete
    judgment yet, and merges. Failed games stay pending for the next run instead
    of stopping this one. Replies are kept in ``store`` as they come, so a run that
    breaks off is continued by calling this again. A target that is the baseline of every question has
    nothing to be compared with and gets an empty result.
    """
    Q.require_known_categories(questions, settings)
    if Q.is_own_baseline(questions, target, settings):
        games = pending_games(questions, answers, judged, target, settings)
        nothing = judged.limit(0)
        return nothing, games.limit(0)
    absent = [r["model"] for r in Q.missing_baselines(questions, answers, target, settings).collect()]
    if absent:
        raise ValueError("Missing baseline answers required for judging: " + ", ".join(sorted(absent)))
    require_coverage(questions, answers, target, settings)
    games = pending_games(questions, answers, judged, target, settings)
    scored = judge_games(games, make_reply, store, make_repair, every)
    merged = merge_judgments(judged, scored, judge, target)
    ordered = in_question_order(merged, questions).drop("question_ord")
    return ordered, scored.where(F.col("score").isNull())
