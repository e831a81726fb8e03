"""Leaderboard report: judgments in, one board per category out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.operators.judgments import require_valid, split_judgments
from duelboard.operators.leaderboard import add_baseline_rows, raw_leaderboard
from duelboard.operators.style_board import style_leaderboard


def leaderboard_report(
    judgments: DataFrame,
    settings: DataFrame,
    categories: list[str] | None = None,
    style_lookup: DataFrame | None = None,
    controls=(),
    rounds: int = K.DEFAULT_BOOTSTRAP_ROUNDS,
    seed: int = 42,
    strict: bool = True,
) -> DataFrame:
    """category, model, score, lower, upper for all requested categories.

    All categories are reported by one grouped pass. ``strict`` raises on
    judgments that cannot be scored; otherwise they are left out (read them with
    ``split_judgments``).
    """
    valid = require_valid(judgments) if strict else split_judgments(judgments)[0]
    if categories:
        # at most the requested categories come back, however many there are
        wanted = F.col("category").isin(categories)
        known = settings.where(wanted).select("category").distinct()
        held = valid.where(wanted).select("category").distinct()
        found = {row["category"] for row in known.join(held, "category", "left_semi").collect()}
        if missing := sorted(set(categories) - found):
            raise ValueError(f"Invalid category or no data found: {missing}")
        valid = valid.where(wanted)
    if controls:
        if style_lookup is None:
            raise ValueError("style control needs the answers' style features")
        board = style_leaderboard(valid, style_lookup, settings, controls, rounds, seed)
        return board.drop("separated", "converged")
    board = raw_leaderboard(valid, rounds=rounds, seed=seed)
    return add_baseline_rows(board, settings)
