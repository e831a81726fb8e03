"""Raw leaderboards: scores, bootstrap intervals, baseline rows, text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions.prompts import interval_text, percent
from duelboard.functions.text import short_model_name
from duelboard.operators.judgments import battle_tallies, battles_of, mean_score
from duelboard.session import work_partitions

KEYS = ["category", "model"]
_BLOCK = 65_536
_PRIME = 2_147_483_647


def model_scores(valid: DataFrame, keys: list[str] = KEYS) -> DataFrame:
    """Battle count and mean score per key: one shuffle of three counters."""
    return battle_tallies(valid, keys).select(
        *keys, battles_of().alias("battles"), mean_score().alias("score")
    )


def baselines(spark, settings=K.CATEGORY_SETTINGS) -> DataFrame:
    """category, baseline (short name), system_prompt: one row per category."""
    rows = [(category, base, prompt) for category, (base, prompt) in settings.items()]
    table = spark.createDataFrame(rows, "category string, baseline string, system_prompt string")
    return table.withColumn("baseline_short", short_model_name(F.col("baseline")))


# -- bootstrap of the mean ----------------------------------------------------


def bootstrap_rounds_multinomial(
    tallies: DataFrame, keys: list[str], rounds: int, seed: int
) -> DataFrame:
    """keys, round, round_mean by drawing the resampled counts directly.

    Scores take three values, so a resample of n battles with replacement is one
    multinomial draw of (wins, ties, losses). The work per key is the number of
    rounds, whatever the number of battles. The generator is seeded from the key,
    so a retried task repeats its draws.
    """
    rounds = max(1, int(rounds))
    key_schema = ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}"
        for f in tallies.select(*keys).schema.fields
    )

    def draw(batches):
        import numpy as np
        import pandas as pd

        for pdf in batches:
            frames = []
            for row in pdf.to_dict("records"):
                counts = np.array([row["wins"], row["ties"], row["losses"]], dtype="int64")
                total = int(counts.sum())
                if total == 0:
                    continue
                rng = np.random.default_rng([seed, row["_key"] & 0xFFFFFFFF, (row["_key"] >> 32) & 0xFFFFFFFF])
                sample = rng.multinomial(total, counts / total, size=rounds)
                means = (sample[:, 0] + 0.5 * sample[:, 1]) / total
                frame = pd.DataFrame({"round": np.arange(rounds), "round_mean": means})
                for key in keys:
                    frame[key] = row[key]
                frames.append(frame[keys + ["round", "round_mean"]])
            if frames:
                yield pd.concat(frames)

    keyed = tallies.select(
        *keys,
        "wins",
        "ties",
        "losses",
        F.xxhash64(*keys).alias("_key"),
    )
    return keyed.mapInPandas(draw, f"{key_schema}, round int, round_mean double")


def key_code(keys: list[str]) -> Column:
    """Integer below 2^31-1 identifying a key, equal in any engine with md5."""
    text = F.concat_ws("|", *keys)
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % F.lit(_PRIME)


def draw_index(code: Column, round_no: Column, draw: Column, total: Column, seed: int) -> Column:
    """Pseudo-random index in [0, total) of one draw, by integer arithmetic only.

    Three multiply-and-square steps modulo the prime 2^31-1 mix key, round and
    draw number; every product stays below 2^62.
    """
    p = F.lit(_PRIME)
    h = (code + round_no * F.lit(48_271) + F.lit(int(seed))) % p
    h = (h * F.lit(16_807) + draw % p) % p
    h = (h * h + F.lit(12_345)) % p
    h = (h * F.lit(69_621) + draw % F.lit(1_000_003)) % p
    h = (h * h + round_no) % p
    h = (h * F.lit(39_373) + F.lit(7)) % p
    return F.floor(h * total / F.lit(float(_PRIME))).cast("bigint")


def bootstrap_rounds_draws(
    tallies: DataFrame, keys: list[str], rounds: int, seed: int
) -> DataFrame:
    """keys, round, round_mean by making every single draw.

    No battle is shuffled: draw numbers are generated in blocks that spread over
    all tasks, each is hashed to an index, and the index is compared with the
    cumulative counts. Costs rounds x battles hash evaluations; use the
    multinomial form beyond that.
    """
    rounds = max(1, int(rounds))
    total = battles_of().alias("total")
    blocks = (
        tallies.select(*keys, "wins", "ties", total, key_code(keys).alias("_code"))
        .where(F.col("total") > 0)
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))).alias("round"))
        .select(
            "*",
            F.explode(
                F.sequence(F.lit(0), ((F.col("total") - 1) / _BLOCK).cast("bigint"))
            ).alias("_block"),
        )
        .repartition(work_partitions(tallies.sparkSession), *keys, "round", "_block")
    )
    start = F.col("_block") * _BLOCK
    stop = F.least(start + _BLOCK, F.col("total")) - 1
    draws = blocks.select("*", F.explode(F.sequence(start, stop)).alias("_draw"))
    index = draw_index(
        F.col("_code"), F.col("round").cast("bigint"), F.col("_draw"), F.col("total"), seed
    )
    hits = draws.withColumn("_index", index)
    wins = F.when(F.col("_index") < F.col("wins"), 1).otherwise(0)
    ties = F.when(
        (F.col("_index") >= F.col("wins"))
        & (F.col("_index") < F.col("wins") + F.col("ties")),
        1,
    ).otherwise(0)
    return (
        hits.groupBy(*keys, "round", "total")
        .agg(F.sum(wins).alias("_w"), F.sum(ties).alias("_t"))
        .select(
            *keys,
            "round",
            ((F.col("_w") + F.lit(0.5) * F.col("_t")) / F.col("total")).alias("round_mean"),
        )
    )


def interval(rounds: DataFrame, keys: list[str], value: str, center: str = "mean") -> DataFrame:
    """keys, score, lower, upper from one row per round.

    ``center='mean'`` reports the mean of the rounds, ``'median'`` their median.
    Quantiles interpolate linearly.
    """
    qs = F.percentile(value, F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    summary = rounds.groupBy(*keys).agg(qs.alias("_q"), F.avg(value).alias("_mean"))
    score = F.col("_mean") if center == "mean" else F.col("_q")[1]
    return summary.select(
        *keys,
        score.alias("score"),
        F.col("_q")[0].alias("lower"),
        F.col("_q")[2].alias("upper"),
    )


def raw_leaderboard(
    valid: DataFrame,
    keys: list[str] = KEYS,
    rounds: int = K.DEFAULT_BOOTSTRAP_ROUNDS,
    seed: int = 42,
    method: str = "multinomial",
) -> DataFrame:
    """keys, score, lower, upper: the score is the mean of the round means."""
    methods = {
        "multinomial": bootstrap_rounds_multinomial,
        "draws": bootstrap_rounds_draws,
    }
    if method not in methods:
        raise ValueError(f"unknown bootstrap method {method}")
    per_round = methods[method](battle_tallies(valid, keys), keys, rounds, seed)
    return interval(per_round, keys, "round_mean")


# -- presentation -------------------------------------------------------------


def add_baseline_rows(board: DataFrame, settings: DataFrame) -> DataFrame:
    """Add a 50 % row with a zero interval for every absent baseline."""
    reported = board.select("category").distinct()
    half = settings.join(reported, "category", "left_semi").select(
        "category",
        F.col("baseline_short").alias("model"),
        F.lit(0.5).alias("score"),
        F.lit(0.5).alias("lower"),
        F.lit(0.5).alias("upper"),
    )
    missing = half.join(board, ["category", "model"], "left_anti")
    return board.select(*missing.columns).unionByName(missing)


def present(board: DataFrame) -> DataFrame:
    """category, model, score_pct, ci text."""
    return board.select(
        "category",
        "model",
        percent(F.col("score")).alias("score_pct"),
        interval_text(F.col("score"), F.col("lower"), F.col("upper")).alias("ci"),
    )


def text_table(board: DataFrame) -> DataFrame:
    """category, line_no, line: aligned text tables, best score first.

    A board has one row per model, so ranking within a category is small.
    """
    from pyspark.sql import Window

    shown = present(board).select(
        "category",
        "model",
        "score_pct",
        F.format_string("%.1f", "score_pct").alias("score_text"),
        "ci",
    )
    widths = shown.groupBy("category").agg(
        F.greatest(F.max(F.length("model")), F.lit(5)).alias("w1"),
        F.greatest(F.max(F.length("score_text")), F.lit(10)).alias("w2"),
        F.greatest(F.max(F.length("ci")), F.lit(6)).alias("w3"),
    )

    def line(a, b, c):
        return F.concat_ws(
            "  ", F.rpad(a, F.col("w1"), F.lit(" ")), F.rpad(b, F.col("w2"), F.lit(" ")),
            F.rpad(c, F.col("w3"), F.lit(" ")),
        ).alias("line")

    header = widths.select(
        "category",
        F.lit(0).alias("line_no"),
        line(F.lit("Model"), F.lit("Scores (%)"), F.lit("CI (%)")),
    )
    order = Window.partitionBy("category").orderBy(F.desc("score_pct"), "model")
    body = shown.join(widths, "category").select(
        "category",
        F.row_number().over(order).alias("line_no"),
        line(F.col("model"), F.col("score_text"), F.col("ci")),
    )
    return header.unionByName(body)
