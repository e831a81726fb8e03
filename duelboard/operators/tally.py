"""Win counts, win rates and usage totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions.text import is_falsy
from duelboard.functions.verdicts import label_score
from duelboard.operators.keyed import keep_first


def tally_key(winner_key: Column) -> Column:
    """The bucket a result counts in: null, empty and any-case tie are TIE."""
    tie = is_falsy(winner_key) | (F.upper(winner_key) == K.TIE)
    return F.when(tie, F.lit(K.TIE)).otherwise(winner_key)


def stored_results(results: DataFrame) -> DataFrame:
    """Results with an instruction, the first one per instruction."""
    return keep_first(
        results.where(~is_falsy(F.col("instruction"))), ["instruction"]
    )


def winner_counts(results: DataFrame, names: list[str]) -> DataFrame:
    """key, n: one row per bucket seen plus a zero row for absent candidates.

    The candidate list is at most three names plus TIE.
    """
    spark = results.sparkSession
    seen = results.groupBy(
        tally_key(F.coalesce(F.nullif("winner_key", F.lit("")), F.col("winner"))).alias("key")
    ).agg(F.count(F.lit(1)).alias("n"))
    zeros = spark.createDataFrame(
        [(name, 0) for name in [*names, K.TIE]], "key string, n bigint"
    )
    return seen.unionByName(zeros).groupBy("key").agg(F.sum("n").alias("n"))


def win_rates(counts: DataFrame) -> DataFrame:
    """key, n, total, win_rate: ties excluded; 0 without a decisive result.

    The rate is null for the tie bucket and when nothing was judged.
    """
    decisive = F.sum(F.when(F.col("key") != K.TIE, F.col("n")).otherwise(0))
    joined = counts.withColumns(
        {"total": counts.agg(F.sum("n")).scalar(), "decisive": counts.agg(decisive).scalar()}
    )
    rate = (
        F.when((F.col("key") == K.TIE) | (F.col("total") == 0), F.lit(None).cast("double"))
        .when(F.col("decisive") <= 0, F.lit(0.0))
        .otherwise(F.try_divide("n", "decisive"))
    )
    return joined.select("key", "n", "total", rate.alias("win_rate"))


def summary_row(rates: DataFrame, model: str) -> DataFrame:
    """One row with maps of counts and win rates; a handful of keys go in."""
    entries = F.array_sort(F.collect_list(F.struct("key", "n", "win_rate")))
    one = rates.agg(F.max("total").alias("total"), entries.alias("_e"))
    counts = F.map_from_entries(F.transform("_e", lambda e: F.struct(e["key"], e["n"])))
    rated = F.filter("_e", lambda e: e["win_rate"].isNotNull())
    win = F.map_from_entries(F.transform(rated, lambda e: F.struct(e["key"], e["win_rate"])))
    return one.select(
        "total", counts.alias("counts"), win.alias("win_rates"), F.lit(model).alias("model")
    )


def usage_totals(rows: DataFrame, keys: list[str], fields=("prompt_tokens", "completion_tokens", "total_tokens")) -> DataFrame:
    """Recorded token usage per key; absent counters count as zero."""
    sums = [
        F.sum(F.coalesce(F.try_element_at("usage", F.lit(f)), F.lit(0))).alias(f)
        for f in fields
    ]
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("calls"), *sums)


def position_consistency(valid: DataFrame, keys: list[str]) -> DataFrame:
    """How often the swapped games agree, and how often the first answer wins.

    A judge is consistent when the candidate's score is the same in both games.
    """
    first = label_score(F.get("games", F.lit(0))["score"])
    second = label_score(F.get("games", F.lit(1))["score"])
    return (
        valid.where(first.isNotNull() & second.isNotNull())
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("pairs"),
            F.avg((second == 1.0 - first).cast("double")).alias("consistency"),
            F.avg((first + second) / 2).alias("first_position_score"),
        )
    )
