"""Preference pairs: the best and the worst of several scored responses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from duelboard.functions.binding import let
from duelboard.functions.text import effectively_empty
from duelboard.functions.transcripts import has_raw_tags, parse_transcript, prompt_and_reference


def rollout_prompts(rows: DataFrame) -> DataFrame:
    """Prompts and reference answers from chosen / rejected transcripts.

    Rows need a chosen text whose prompt ends on a user turn and holds no raw
    role tags.
    """
    parsed = rows.where(F.coalesce(F.col("chosen") != "", F.lit(False))).select(
        "ord",
        prompt_and_reference(parse_transcript(F.col("chosen"))).alias("c"),
        prompt_and_reference(parse_transcript(F.nullif("rejected", F.lit("")))).alias("r"),
    )
    usable = parsed.where(
        (F.coalesce(F.size("c.prompt_messages"), F.lit(0)) > 0)
        & ~has_raw_tags(F.col("c.prompt_messages"))
    )
    return usable.select(
        "ord",
        F.col("c.prompt_messages").alias("prompt_messages"),
        F.struct(
            F.col("c.reference").alias("chosen"), F.col("r.reference").alias("rejected")
        ).alias("reference_responses"),
    )


def empty_indices(responses: Column, mode: str = "fixed") -> Column:
    """Zero-based positions of the effectively empty responses."""
    flags = F.transform(
        responses,
        lambda r, i: F.struct(effectively_empty(r, mode=mode).alias("empty"), i.alias("i")),
    )
    return F.transform(F.filter(flags, lambda s: s["empty"]), lambda s: s["i"])


def kept_indices(responses: Column, mode: str = "fixed") -> Column:
    """Zero-based positions of the responses that hold text."""
    flags = F.transform(
        responses,
        lambda r, i: F.struct(effectively_empty(r, mode=mode).alias("empty"), i.alias("i")),
    )
    return F.transform(F.filter(flags, lambda s: ~s["empty"]), lambda s: s["i"])


def rankable(rollouts: DataFrame, mode: str = "fixed") -> DataFrame:
    """Prompts with at least two non-empty responses, with the kept positions."""
    marked = rollouts.withColumn("kept", kept_indices(F.col("responses"), mode))
    return marked.where(F.size("kept") >= 2)


def pick(responses: Column, indices: Column) -> Column:
    return F.transform(indices, lambda i: F.element_at(responses, i + 1))


def _tie_break(seed: int, key: Column, position: Column, side: str) -> Column:
    return F.md5(
        F.concat_ws("|", F.lit(str(seed)), key.cast("string"), position.cast("string"), F.lit(side))
    )


def best_and_worst(scored: DataFrame, key: str = "prompt_id", seed: int = 42) -> DataFrame:
    """key, best, worst: positions with the highest and lowest score.

    Input is one row per response (key, pos, score). Exact ties are broken by a
    seeded hash, drawn separately for the two sides, so both may be the same
    response. The aggregates merge before the shuffle: a prompt with very many
    responses sends one row per task.
    """
    best = F.max_by("pos", F.struct("score", _tie_break(seed, F.col(key), F.col("pos"), "best")))
    worst = F.min_by("pos", F.struct("score", _tie_break(seed, F.col(key), F.col("pos"), "worst")))
    return scored.groupBy(key).agg(best.alias("best"), worst.alias("worst"))


def best_and_worst_in_row(kept: Column, scores: Column, key: Column, seed: int = 42) -> Column:
    """STRUCT<best, worst> when positions and scores are arrays of the same row.

    No shuffle: the response arrays stay where they are.
    """

    def ranked(side: str) -> Column:
        return F.zip_with(
            kept,
            scores,
            lambda i, s: F.struct(
                s.alias("score"), _tie_break(seed, key, i, side).alias("h"), i.alias("pos")
            ),
        )

    return F.struct(
        F.array_max(ranked("best"))["pos"].alias("best"),
        F.array_min(ranked("worst"))["pos"].alias("worst"),
    )


def run_metadata(
    source: str,
    seed: int,
    k_candidates: int,
    generator_model: str,
    reward_model: str,
    reward_quantization: str = "none",
    judge: str = "rm",
) -> Column:
    """Constant lineage struct attached to every pair."""
    return F.struct(
        F.lit(source).alias("source"),
        F.lit(seed).cast("bigint").alias("seed"),
        F.lit(k_candidates).alias("k_candidates"),
        F.lit(generator_model).alias("generator_model"),
        F.lit(judge).alias("judge"),
        F.lit(reward_model).alias("reward_model"),
        F.lit(reward_quantization).alias("reward_quantization"),
    )


def preference_pairs(
    ranked: DataFrame, metadata: Column, seed: int = 42, allow_equal: bool = True
) -> DataFrame:
    """Pairs from prompt_id, prompt_messages, responses, kept, scores."""

    def sides(w: Column) -> Column:
        def reply(position: Column) -> Column:
            text = F.element_at(F.col("responses"), position + 1)
            return F.array(F.struct(F.lit("assistant").alias("role"), text.alias("content")))

        return F.struct(
            reply(w["best"]).alias("chosen"),
            reply(w["worst"]).alias("rejected"),
            (w["best"] == w["worst"]).alias("equal"),
        )

    picked = best_and_worst_in_row(F.col("kept"), F.col("scores"), F.col("prompt_id"), seed)
    paired = ranked.withColumn("_p", let(picked, sides))
    if not allow_equal:
        paired = paired.where(~F.col("_p.equal"))
    return paired.select(
        "prompt_id",
        "prompt_messages",
        F.col("_p.chosen").alias("chosen"),
        F.col("_p.rejected").alias("rejected"),
        metadata.alias("metadata"),
    )


def has_text(messages: Column, mode: str = "fixed") -> Column:
    """True if any message content holds text."""
    return F.coalesce(
        F.exists(
            messages,
            lambda m: ~effectively_empty(m["content"], drop_escapes=True, mode=mode),
        ),
        F.lit(False),
    )


def has_text_any_shape(value: Column, mode: str = "fixed") -> Column:
    """Same test on a VARIANT that is a string, one message, or a list of either."""
    kind = F.schema_of_variant(value)

    def content(item: Column) -> Column:
        item_kind = F.schema_of_variant(item)
        return F.when(
            item_kind.startswith("OBJECT"), F.try_variant_get(item, "$.content", "string")
        ).when(item_kind == "STRING", F.try_variant_get(item, "$", "string"))

    items = F.when(
        kind.startswith("ARRAY"), F.try_variant_get(value, "$", "array<variant>")
    ).otherwise(F.array(value))
    return F.coalesce(
        F.exists(items, lambda v: ~effectively_empty(content(v), drop_escapes=True, mode=mode)),
        F.lit(False),
    )


def filter_pairs(pairs: DataFrame, mode: str = "fixed") -> DataFrame:
    return pairs.where(has_text(F.col("chosen"), mode) & has_text(F.col("rejected"), mode))


def filter_counts(pairs: DataFrame, mode: str = "fixed") -> DataFrame:
    """One row: pairs read and pairs kept."""
    keep = has_text(F.col("chosen"), mode) & has_text(F.col("rejected"), mode)
    return pairs.agg(F.count(F.lit(1)).alias("total"), F.count_if(keep).alias("kept"))


def filter_and_count(pairs: DataFrame, counts: Observation | str, mode: str = "fixed") -> DataFrame:
    """The kept pairs; ``total`` and ``kept`` are counted while they are written.

    With an ``Observation`` they are its values after the write; a stream names them and
    reports them in each batch's progress. Nothing is read a second time.
    """
    keep = has_text(F.col("chosen"), mode) & has_text(F.col("rejected"), mode)
    return (
        pairs.withColumn("_keep", keep)
        .observe(counts, F.count(F.lit(1)).alias("total"), F.count_if(F.col("_keep")).alias("kept"))
        .where("_keep")
        .drop("_keep")
    )


def _tokens(ids: str, pad: int) -> Column:
    return F.size(F.filter(ids, lambda x: x != pad))


def count_tokens(rows: DataFrame, counts: Observation | str, ids: str, pad: int) -> DataFrame:
    """The rows; sequences and non-padding tokens are counted while they are written."""
    return rows.observe(counts, F.count(F.lit(1)).alias("sequences"), F.sum(_tokens(ids, pad)).alias("tokens"))


def token_totals(rows: DataFrame, keys: list[str], ids: str, pad: int) -> DataFrame:
    """Sequences and non-padding tokens per key."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sequences"), F.sum(_tokens(ids, pad)).alias("tokens")
    )
