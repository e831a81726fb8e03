"""What still has to be answered or judged, and the judge requests for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard.functions.prompts import judge_messages, judge_prompt, message
from duelboard.functions.style import style_metadata
from duelboard.operators.judgments import is_complete
from duelboard.operators.keyed import alike, without
from duelboard.session import broadcast_if_small


def unanswered(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """Questions without an answer row."""
    return without(questions, answers, ["uid"])


def with_settings(questions: DataFrame, settings: DataFrame) -> DataFrame:
    """Questions with their category's baseline and system prompt.

    ``settings`` holds one row per category, so it is broadcast after a check.
    """
    return questions.join(broadcast_if_small(settings), "category")


def unknown_categories(questions: DataFrame, settings: DataFrame) -> DataFrame:
    """Questions whose category has no settings (null included)."""
    known = broadcast_if_small(settings.select("category"))
    return questions.join(known, "category", "left_anti")


def require_known_categories(questions: DataFrame, settings: DataFrame) -> DataFrame:
    bad = unknown_categories(questions, settings).select("category").distinct().head(8)
    if bad:
        raise ValueError(f"unknown categories: {[r['category'] for r in bad]}")
    return questions


def coverage_gaps(questions: DataFrame, answers: DataFrame, target: str, settings: DataFrame) -> DataFrame:
    """uid, model of every answer that judging needs and does not have.

    Each question expects the target's answer and, unless it is the target
    itself, its baseline's answer.
    """
    expected = with_settings(questions, settings).select(
        "uid",
        "ord",
        F.explode(
            F.when(F.col("baseline") == target, F.array(F.lit(target))).otherwise(
                F.array(F.lit(target), F.col("baseline"))
            )
        ).alias("model"),
    )
    return without(expected, answers, ["uid", "model"])


def missing_baselines(questions: DataFrame, answers: DataFrame, target: str, settings: DataFrame) -> DataFrame:
    """Baseline models with no answers at all (the target excepted)."""
    needed = (
        with_settings(questions, settings)
        .select(F.col("baseline").alias("model"))
        .distinct()
        .where(F.col("model") != target)
    )
    return without(needed, answers, ["model"])


def is_own_baseline(questions: DataFrame, target: str, settings: DataFrame) -> bool:
    """True when the target is the baseline of every question."""
    others = with_settings(questions, settings).where(F.col("baseline") != target)
    return others.isEmpty()


def unjudged(questions: DataFrame, judged: DataFrame, target: str, settings: DataFrame) -> DataFrame:
    """Questions without a complete judgment whose baseline is not the target."""
    complete = judged.where(is_complete(F.col("games")))
    pending = with_settings(questions, settings).where(F.col("baseline") != target)
    return without(pending, complete, ["uid"])


def baseline_models(settings: DataFrame) -> list[str]:
    """The baselines in use: at most one per category."""
    return sorted({row["baseline"] for row in settings.select("baseline").collect()})


def with_answers(
    pending: DataFrame, answers: DataFrame, target: str, baselines: list[str] | None = None
) -> DataFrame:
    """Pending questions with the target's and the baseline's answer text.

    Each side reads only the models it needs; with ``baselines`` given, the
    filter reaches the scan and prunes a layout partitioned by model. Both joins deal by
    uid alone, which is how resolved answers lie, so texts are not moved for them.
    """
    own = answers.where(F.col("model") == target).select(
        "uid", F.col("answer").alias("target_answer")
    )
    others = answers if baselines is None else answers.where(F.col("model").isin(baselines))
    base = others.select(
        "uid",
        F.col("model").alias("_model"),
        F.col("answer").alias("baseline_answer"),
    )
    paired = pending.join(own, "uid").join(base, "uid").where(alike(F.col("baseline"), F.col("_model"))).drop("_model")
    return paired.select("uid", "baseline", *[c for c in paired.columns if c not in ("uid", "baseline")])


def swapped_games(paired: DataFrame) -> DataFrame:
    """Two rows per question: baseline first, then the answers swapped."""

    def game(number: int, label: str, a: str, b: str) -> Column:
        return F.struct(
            F.lit(number).alias("game_no"),
            F.lit(label).alias("round_label"),
            F.col(a).alias("answer_a"),
            F.col(b).alias("answer_b"),
        )

    games = F.array(
        game(1, "baseline_vs_candidate", "baseline_answer", "target_answer"),
        game(2, "candidate_vs_baseline", "target_answer", "baseline_answer"),
    )
    kept = [c for c in paired.columns if c not in ("baseline_answer", "target_answer")]
    return paired.select(*kept, F.explode(games).alias("g")).select(*kept, "g.*")


def judge_requests(games: DataFrame) -> DataFrame:
    """uid, category, baseline, game_no, round_label, messages."""
    user = judge_prompt(F.col("prompt"), F.col("answer_a"), F.col("answer_b"))
    return games.select(
        "uid",
        "category",
        "baseline",
        "game_no",
        "round_label",
        judge_messages(F.col("system_prompt"), user).alias("messages"),
    )


def answer_rows(
    answered: DataFrame,
    model: str,
    system_prompt: str | None = None,
    tstamp: Column | None = None,
) -> DataFrame:
    """Answer records from uid, prompt, answer (and an optional tstamp column).

    The id is derived from model and uid instead of drawn, so a retried task
    writes the same row. The answer is stored as an object with one key.
    """
    content = F.to_variant_object(F.named_struct(F.lit("answer"), F.col("answer")))
    turns = [message("user", F.col("prompt").cast("variant")), message("assistant", content)]
    if system_prompt:
        turns.insert(0, message("system", F.lit(system_prompt).cast("variant")))
    stamp = F.col("tstamp") if "tstamp" in answered.columns else F.lit(None).cast("double")
    now = F.unix_micros(F.current_timestamp()) / 1e6 if tstamp is None else tstamp
    return answered.select(
        "uid",
        F.md5(F.concat_ws("|", F.lit(model), "uid")).alias("ans_id"),
        F.lit(model).alias("model"),
        F.array(*turns).alias("messages"),
        F.coalesce(F.nullif(stamp, F.lit(0.0)), now).alias("tstamp"),
        style_metadata(F.col("answer")).alias("metadata"),
    )


def assign_shards(df: DataFrame, key: str, shards: int) -> DataFrame:
    """Even assignment of requests to ``shards`` endpoints by key hash.

    Stateless, so a retried or resumed request keeps its shard.
    """
    code = F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("bigint")
    return df.withColumn("shard", F.pmod(code, F.lit(int(shards))))
