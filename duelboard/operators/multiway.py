"""Two- and three-way comparisons of candidate output sets."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions.prompts import comparison_prompt
from duelboard.functions.text import is_falsy, seed_from_key
from duelboard.functions.verdicts import parse_comparison, settle_winner
from duelboard.operators.keyed import alike, first_rows, keep_first, settle_frequent, without


def select_candidates(paths: dict[str, str | None], keys: list[str]) -> list[str]:
    """Names among ``keys`` that have a path; two or three are required."""
    chosen = [key for key in keys if paths.get(key)]
    if len(chosen) < 2:
        raise ValueError("provide at least two candidate output files")
    if len(chosen) > len(K.POSITION_LABELS):
        raise ValueError("at most three candidate output files are supported")
    return chosen


def usable_outputs(candidates: DataFrame) -> DataFrame:
    """Rows with an instruction and an output."""
    return candidates.where(~is_falsy(F.col("instruction")) & F.col("output").isNotNull())


def first_outputs(candidates: DataFrame) -> DataFrame:
    """First usable output per candidate name and instruction."""
    return keep_first(
        usable_outputs(candidates).select("name", "instruction", "output", "ord"),
        ["name", "instruction"],
    )


def _everywhere(names: list[str]) -> Column:
    everywhere = F.lit(True)
    for i in range(len(names)):
        everywhere = everywhere & F.col(f"has_{i}")
    return everywhere


def common_instructions(candidates: DataFrame, names: list[str]) -> DataFrame:
    """instruction and the outputs of all candidates, for instructions that all have.

    One grouping of instructions and row numbers does the first-row-wins rule and the
    N-way intersection; the output texts are fetched for the rows that it has picked. They
    are dealt by instruction alone, so each text is moved once and whatever follows per
    instruction moves none. Of frequent instructions only the picked rows are dealt.
    """
    usable = usable_outputs(candidates).where(F.col("name").isin(names))
    firsts = [F.min(F.when(F.col("name") == name, F.col("ord"))).alias(f"ord_{i}") for i, name in enumerate(names)]
    present = [F.max(F.col("name") == name).alias(f"has_{i}") for i, name in enumerate(names)]
    grouped = usable.groupBy("instruction").agg(*firsts, *present, F.count(F.lit(1)).alias("n"))
    rows = grouped.where(_everywhere(names)).drop("n")
    for i, name in enumerate(names):
        own = usable.where(F.col("name") == name).select("instruction", "ord", F.col("output").alias(f"output_{i}"))
        own = settle_frequent(own, grouped.select("instruction", F.col(f"ord_{i}").alias("ord"), "n"), ["instruction"])
        rows = rows.join(own, "instruction").where(alike(F.col("ord"), F.col(f"ord_{i}"))).drop("ord")
    outputs = [F.struct(F.lit(name).alias("name"), F.col(f"output_{i}").alias("output")) for i, name in enumerate(names)]
    return rows.select("instruction", F.array(*outputs).alias("outputs"))


def coverage_counts(candidates: DataFrame, names: list[str]) -> DataFrame:
    """One row: instructions seen, in all candidates, and dropped."""
    usable = usable_outputs(candidates).where(F.col("name").isin(names))
    flags = [F.max(F.col("name") == name).alias(f"has_{i}") for i, name in enumerate(names)]
    per = usable.groupBy("instruction").agg(*flags)
    everywhere = _everywhere(names)
    return per.agg(
        F.count(F.lit(1)).alias("instructions"),
        F.count_if(everywhere).alias("shared"),
        F.count_if(~everywhere).alias("dropped"),
    )


def first_instructions(common: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` instructions in code-point order."""
    return first_rows(common, limit, order="instruction")


def unseen(common: DataFrame, results: DataFrame) -> DataFrame:
    """Instructions that have no stored result."""
    return without(common, results.where(~is_falsy(F.col("instruction"))), ["instruction"])


def hashed_order(outputs: Column, instruction: Column, seed: int) -> Column:
    """Candidates in a seeded pseudo-random order, decided per instruction."""
    keyed = F.transform(
        outputs,
        lambda o: F.struct(
            F.md5(F.concat(F.lit(f"{seed}-"), instruction, F.lit("-"), o["name"])).alias("k"),
            o["name"].alias("name"),
            o["output"].alias("output"),
        ),
    )
    return F.transform(
        F.array_sort(keyed),
        lambda s: F.struct(s["name"].alias("name"), s["output"].alias("output")),
    )


def twister_order(outputs: Column, instruction: Column, seed: int) -> Column:
    """The order earlier runs used: a Mersenne-Twister shuffle seeded per instruction.

    Only needed to continue such a run; returns the same array reordered.
    """
    @F.pandas_udf("array<int>")
    def permutation(sizes: pd.Series, seeds: pd.Series) -> pd.Series:
        import random

        def shuffled(size, key):
            order = list(range(1, int(size) + 1))
            random.Random(int(key)).shuffle(order)
            return order

        return pd.Series([shuffled(n, s) for n, s in zip(sizes, seeds)])

    order = permutation(F.size(outputs), seed_from_key(instruction, seed).cast("string"))
    return F.transform(order, lambda i: F.element_at(outputs, i))


def label_candidates(common: DataFrame, seed: int = 42, order: str = "hash") -> DataFrame:
    """Adds ``labels`` (A/B/C -> name) and ``ordered`` outputs in label order."""
    orders = {"hash": hashed_order, "twister": twister_order}
    if order not in orders:
        raise ValueError("order must be 'hash' or 'twister'")
    shuffled = common.withColumn(
        "ordered", orders[order](F.col("outputs"), F.col("instruction"), seed)
    )
    positions = F.array(*[F.lit(label) for label in K.POSITION_LABELS])
    names = F.transform("ordered", lambda o: o["name"])
    labels = F.map_from_arrays(F.slice(positions, F.lit(1), F.size(names)), names)
    return shuffled.withColumn("labels", labels)


def comparison_requests(labelled: DataFrame, positions: int, template: str | None = None) -> DataFrame:
    texts = F.transform("ordered", lambda o: o["output"])
    prompt = comparison_prompt(F.col("instruction"), texts, positions, template)
    return labelled.select("instruction", "labels", prompt.alias("prompt"))


def failed_calls(replies: DataFrame) -> DataFrame:
    """instruction, error of the calls that gave no reply: no results, to be asked again."""
    missing = F.col("error").isNotNull() | F.col("reply").isNull()
    return replies.where(missing).select("instruction", F.coalesce("error", F.lit("no reply")).alias("error"))


def read_results(replies: DataFrame, model: str, system_prompt: str | None = None) -> DataFrame:
    """Judged rows from instruction, labels, reply; failed calls are left out.

    A call failed if it has no reply, or an ``error`` where the replies have that column;
    ``usage`` is carried along where they have it.
    """
    error = F.col("error") if "error" in replies.columns else F.lit(None).cast("string")
    replies = replies.where(error.isNull() & F.col("reply").isNotNull())
    usage = F.col("usage") if "usage" in replies.columns else F.lit(None).cast("map<string,bigint>")
    parsed = replies.withColumn("_p", parse_comparison(F.col("reply")))
    settled = parsed.withColumn("_s", settle_winner(F.col("_p.winner"), F.col("labels")))
    return settled.select(
        "instruction",
        F.col("_p.comparison").alias("comparison"),
        F.col("_s.winner").alias("winner"),
        F.col("_s.winner_key").alias("winner_key"),
        "labels",
        F.lit(model).alias("model"),
        F.lit(system_prompt).cast("string").alias("system_prompt"),
        usage.alias("usage"),
        F.col("reply").alias("raw_response"),
    )
