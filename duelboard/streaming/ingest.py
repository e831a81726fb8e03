"""Incremental forms: results that arrive as files, counted as they come.

Every query here runs with ``availableNow``: it takes what is there, commits its
progress in the checkpoint and stops; the next run continues from it. Stateful
operators keep their state per key in the state store, spread over the shuffle
partitions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelboard.operators.judgments import (
    battle_votes,
    battles_of,
    is_complete,
    mean_score,
    split_judgments,
)
from duelboard.operators.tally import tally_key
from duelboard.sources.folders import list_names, modified, remove_path
from duelboard.streaming.keyed_state import one_row_per_key


def file_stream(
    spark: SparkSession,
    directory: str,
    schema,
    fmt: str = "json",
    pattern: str | None = None,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream of the files below a directory."""
    reader = spark.readStream.format(fmt).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(directory)


def first_per_key(stream: DataFrame, table: str, checkpoint: str, keys: list[str], order: str = "ord") -> None:
    """Append the first arrival of every key to ``table``, however late it comes.

    Of the batch that brings a key the row with the smallest ``order`` is kept.
    """
    one_row_per_key(stream, table, checkpoint, keys, order)


def running_winners(stream: DataFrame) -> DataFrame:
    """Running count per winner bucket (complete or update mode)."""
    key = tally_key(F.coalesce(F.nullif("winner_key", F.lit("")), F.col("winner")))
    return stream.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))


def running_scores(stream: DataFrame) -> DataFrame:
    """Running battle count and mean score per category and model."""
    votes = battle_votes(split_judgments(stream)[0])
    sums = votes.groupBy("category", "model").agg(
        F.sum("wins").alias("wins"), F.sum("ties").alias("ties"), F.sum("losses").alias("losses")
    )
    return sums.select(
        "category", "model", battles_of().alias("battles"), mean_score().alias("score")
    )


def append_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Run to the end of the available input, appending parquet files."""
    query = (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def replace_per_batch(stream: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> None:
    """Keep the newest complete result, to be read with ``newest``.

    Each batch writes a version of its own below ``path`` and then removes the older ones,
    so a crash leaves the last whole version in place. A replayed batch writes its
    version again.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:16]

    def save(batch: DataFrame, batch_id: int) -> None:
        spark, own = batch.sparkSession, f"v-{run}-{batch_id}"
        batch.write.mode("overwrite").parquet(f"{path}/{own}")
        for name in _versions(spark, path):
            if name != own:
                remove_path(spark, f"{path}/{name}")

    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(save)
        .start()
    )
    query.awaitTermination()


def newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version that ``replace_per_batch`` has written."""
    return spark.read.parquet(f"{path}/{_versions(spark, path)[-1]}")


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Names of the whole versions, the oldest first."""
    done = [(made, name) for name in list_names(spark, path) if (made := modified(spark, f"{path}/{name}/_SUCCESS")) is not None]
    return [name for _, name in sorted(done)]


def merge_batches(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str],
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    order: str = "ord",
) -> None:
    """Merge complete judgments into a growing table.

    Stored complete rows never change: of the batch that first brings a complete row of a
    key, its last such row (by ``order``) is stored. ``prepare`` is applied to the stream.
    """
    fresh = prepare(stream) if prepare else stream
    one_row_per_key(fresh.where(is_complete(F.col("games"))), table, checkpoint, keys, order, last=True)
