"""Pairwise judgments: validity, battles and battle tallies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions.text import short_model_name
from duelboard.functions.verdicts import (
    code_votes,
    is_known_label,
    label_code,
    label_score,
    label_weight,
)
from duelboard.operators.keyed import preview_with_remainder


def _game(games: Column, index: int) -> Column:
    return F.get(games, F.lit(index - 1))


def _game_count(games: Column) -> Column:
    return F.coalesce(F.size(games), F.lit(0))


def is_complete(games: Column) -> Column:
    """At least two games and a score in each of the first two."""
    return F.coalesce(
        (_game_count(games) >= 2)
        & _game(games, 1)["score"].isNotNull()
        & _game(games, 2)["score"].isNotNull(),
        F.lit(False),
    )


def reject_reason(games: Column) -> Column:
    """Why a judgment cannot be scored; null when it can.

    One known label is enough: the other game then contributes nothing.
    """
    first, second = _game(games, 1), _game(games, 2)
    return (
        F.when(_game_count(games) < 2, "missing_games")
        .when(first.isNull() | second.isNull(), "null_game")
        .when(first["score"].isNull() | second["score"].isNull(), "missing_score")
        .when(
            ~is_known_label(first["score"]) & ~is_known_label(second["score"]),
            "invalid_score_labels",
        )
    )


def is_scorable(games: Column) -> Column:
    """Same as having no reject reason, in the few tests a filter needs.

    A missing or null game has a null score.
    """
    first, second = _game(games, 1)["score"], _game(games, 2)["score"]
    return (
        first.isNotNull()
        & second.isNotNull()
        & (is_known_label(first) | is_known_label(second))
    )


def split_judgments(judgments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(scorable rows, rejected rows with their reason)."""
    reason = reject_reason(F.col("games"))
    return (
        judgments.where(is_scorable(F.col("games"))),
        judgments.withColumn("reason", reason).where(F.col("reason").isNotNull()),
    )


def reject_preview(rejects: DataFrame) -> DataFrame:
    """One row: number of rejected judgments and the first few of them.

    Each is named by its file, where the rows have one, its uid, the reason and, if its
    labels are not known, these.
    """
    labels = F.concat(F.lit("="), _label(1), F.lit("/"), _label(2))
    shown = F.when(F.col("reason") == "invalid_score_labels", F.concat("reason", labels)).otherwise(F.col("reason"))
    file = [F.col("file_name"), F.lit(": ")] if "file_name" in rejects.columns else []
    text = F.concat(*file, F.lit("uid="), F.coalesce("uid", F.lit("None")), F.lit(" "), shown)
    return preview_with_remainder(rejects, text, ["ord"], K.INVALID_PREVIEW)


def require_valid(judgments: DataFrame) -> DataFrame:
    """The scorable rows; raises if any row is rejected."""
    valid, rejects = split_judgments(judgments)
    row = reject_preview(rejects).first()
    if row["total"]:
        raise ValueError(
            "Invalid judgment rows found. Fix or rerun judging before reporting: "
            + row["preview"]
        )
    return valid


def _label(index: int) -> Column:
    return _game(F.col("games"), index)["score"]


def with_short_model(df: DataFrame) -> DataFrame:
    return df.withColumn("model", short_model_name(F.col("model")))


def battle_rows(valid: DataFrame) -> DataFrame:
    """One row per battle: the second game directly, the first one flipped.

    A strong label yields three rows.
    """
    direct = F.array_repeat(label_score(_label(2)), label_weight(_label(2)))
    flipped = F.array_repeat(F.lit(1.0) - label_score(_label(1)), label_weight(_label(1)))
    return with_short_model(valid).select(
        "uid", "model", "category", F.explode(F.concat(direct, flipped)).alias("score")
    )


def battle_votes(valid: DataFrame) -> DataFrame:
    """Per judgment the number of battles won, tied and lost by the candidate."""
    coded = with_short_model(valid).withColumns(
        {"_first": label_code(_label(1)), "_second": label_code(_label(2))}
    )
    votes = {
        name: code_votes(F.col("_second"), score) + code_votes(F.col("_first"), 1.0 - score)
        for name, score in (("wins", 1.0), ("ties", 0.5), ("losses", 0.0))
    }
    return coded.withColumns(votes).drop("_first", "_second")


def battle_tallies(valid: DataFrame, keys: list[str]) -> DataFrame:
    """Battles won, tied and lost per key.

    Votes are counted on the judgment row, so nothing is exploded and the shuffle
    carries three counters per key and task however many battles a key has.
    """
    return (
        battle_votes(valid)
        .groupBy(*keys)
        .agg(
            F.sum("wins").alias("wins"),
            F.sum("ties").alias("ties"),
            F.sum("losses").alias("losses"),
        )
    )


def battles_of(wins="wins", ties="ties", losses="losses") -> Column:
    return F.col(wins) + F.col(ties) + F.col(losses)


def mean_score(wins="wins", ties="ties", losses="losses") -> Column:
    return (F.col(wins) + F.lit(0.5) * F.col(ties)) / battles_of(wins, ties, losses)


def for_category(battles: DataFrame, category: str) -> DataFrame:
    """Rows of one category; raises when there are none."""
    chosen = battles.where(F.col("category") == category)
    if chosen.isEmpty():
        raise ValueError(f"Invalid category or no data found: {category}")
    return chosen
