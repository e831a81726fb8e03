"""Multi-way judging and win rates."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelboard.functions.text import is_falsy
from duelboard.operators import multiway as M
from duelboard.operators.keyed import keep_first
from duelboard.operators.tally import win_rates, winner_counts
from duelboard.plans.calls import ask_once


@dataclass(frozen=True)
class Round:
    """Outcome of a round: newly judged rows, and the calls that failed."""

    results: DataFrame
    failed: DataFrame


def comparison_round(
    candidates: DataFrame,
    names: list[str],
    make_reply: Callable,
    model: str,
    store: str,
    results: DataFrame | None = None,
    limit: int | None = None,
    seed: int = 42,
    order: str = "hash",
    system_prompt: str | None = None,
    every: int | None = None,
) -> Round:
    """Judge the instructions that all candidates share and that have no result yet.

    Replies are logged in ``store``, about ``every`` at a time: nothing downstream can send
    a request again, and a round that was stopped continues with what the log lacks. A
    call that failed is no result: it comes back in ``failed`` and a later round asks it
    again.
    """
    common = M.first_instructions(M.common_instructions(candidates, names), limit)
    if results is not None:
        common = M.unseen(common, results)
    requests = M.comparison_requests(M.label_candidates(common, seed, order), len(names))
    replies = ask_once(requests, make_reply, store, ["instruction"], every, sent="prompt").drop("prompt")
    return Round(M.read_results(replies, model, system_prompt), M.failed_calls(replies))


def resumed(results: DataFrame, new: DataFrame) -> DataFrame:
    """winner and winner_key of all judged instructions: the first stored row of each, then the new ones."""
    kept = results.where(~is_falsy(F.col("instruction")))
    first = keep_first(kept.select("instruction", "winner", "winner_key", "ord"), ["instruction"])
    return first.select("winner", "winner_key").unionByName(new.select("winner", "winner_key"))


def win_table(results: DataFrame, names: list[str]) -> DataFrame:
    return win_rates(winner_counts(results, names))
