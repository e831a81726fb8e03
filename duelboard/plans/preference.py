"""Preference pairs from scored responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard.operators.pairs import filter_pairs, pick, preference_pairs, rankable
from duelboard.operators.replies import batch_scores


def score_responses(rollouts: DataFrame, prompt: Column, make_scorer: Callable) -> DataFrame:
    """Adds the kept positions and one score per kept response."""
    usable = rankable(rollouts).withColumn("_kept", pick(F.col("responses"), F.col("kept")))
    return usable.withColumn("scores", batch_scores(make_scorer)(prompt, F.col("_kept"))).drop(
        "_kept"
    )


def build_pairs(rollouts: DataFrame, prompt: Column, make_scorer: Callable, metadata: Column, seed: int = 42) -> DataFrame:
    """Scored, ranked and filtered pairs; every step works inside the row."""
    ranked = score_responses(rollouts, prompt, make_scorer)
    return filter_pairs(preference_pairs(ranked, metadata, seed))
