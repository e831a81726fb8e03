"""Event-time windows that end, with the rows that come too late kept apart.

Rows are landed first: each batch is split by the watermark of the batches before it
(their latest event time less the allowed delay) into rows on time and late rows, which
get a table of their own. The rows on time are then aggregated in append mode: a window is
written once, when the watermark passes its end, and its state is dropped.

Sliding windows are made of panes one slide long. The stream counts panes, so a row is
counted once however many windows overlap it, and is late when its pane has ended; closed
panes are added up to windows afterwards.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelboard.sources.folders import path_exists


def land(stream: DataFrame, folder: str, checkpoint: str, time: str, delay: str, closes: Column) -> None:
    """Split the available rows into ``folder/on_time`` and ``folder/late``.

    ``closes`` is the time at which a row's window ends; a row is late if the watermark
    has reached it. Rows without a time are late. The watermark of a batch is the latest
    ``time`` of all earlier batches less ``delay`` and is kept in ``folder/marks``, which is
    written last: a replayed batch that has its mark is whole and is passed over.
    """
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:16]

    def part(name: str, batch_id: int) -> str:
        return f"{folder}/{name}/run=r{run}/batch={batch_id}"

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if path_exists(spark, f"{part('marks', batch_id)}/_SUCCESS"):
            return
        before = spark.read.parquet(part("marks", batch_id - 1)) if batch_id else _marks(spark, folder)
        latest = None if before is None else before.agg(F.max("latest")).first()[0]
        mark = F.lit(latest).cast("timestamp") - F.expr(f"interval {delay}")
        late = F.col(time).isNull() | F.coalesce(closes <= mark, F.lit(False))
        batch = batch.persist()
        batch.where(~late).write.mode("overwrite").parquet(part("on_time", batch_id))
        batch.where(late).withColumn("watermark", mark).write.mode("overwrite").parquet(part("late", batch_id))
        newest = batch.agg(F.greatest(F.max(time), F.lit(latest).cast("timestamp")).alias("latest"))
        newest.coalesce(1).write.mode("overwrite").parquet(part("marks", batch_id))
        batch.unpersist()

    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()
    query.awaitTermination()


def _marks(spark: SparkSession, folder: str) -> DataFrame | None:
    return spark.read.parquet(f"{folder}/marks") if path_exists(spark, f"{folder}/marks") else None


def watermark(spark: SparkSession, folder: str, delay: str) -> Column:
    """The watermark after all landed rows, as a value."""
    marks = _marks(spark, folder)
    latest = None if marks is None else marks.agg(F.max("latest")).first()[0]
    return F.lit(latest).cast("timestamp") - F.expr(f"interval {delay}")


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that came after their window had ended, with the watermark that they met."""
    return spark.read.parquet(f"{folder}/late").drop("run", "batch")


def _on_time(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of the landed rows. A batch takes all of them: a part of a landed batch could close windows of the rest."""
    landed = spark.read.parquet(f"{folder}/on_time")
    return spark.readStream.schema(landed.schema).parquet(f"{folder}/on_time").drop("run", "batch")


def _append(counts: DataFrame, path: str, checkpoint: str) -> list[dict]:
    query = (
        counts.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return list(query.recentProgress)


def pane_end(time: str, slide: str) -> Column:
    """End of the pane that holds a row: the time at which the row becomes late. Panes are counted from 1970-01-01 UTC."""
    step = F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"interval {slide}"))
    at = F.unix_micros(F.col(time))
    return F.timestamp_micros(at - F.pmod(at, step) + step)


def count_panes(stream: DataFrame, folder: str, checkpoint: str, time: str, delay: str, slide: str, keys: list[str]) -> list[dict]:
    """Land the available rows and append the panes that ended to ``folder/panes``; returns the stream's progress."""
    land(stream, folder, f"{checkpoint}/land", time, delay, pane_end(time, slide))
    rows = _on_time(stream.sparkSession, folder).withWatermark(time, delay)
    panes = rows.groupBy(F.window(time, slide).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    panes = panes.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, "n")
    return _append(panes, f"{folder}/panes", f"{checkpoint}/count")


def closed_windows(spark: SparkSession, folder: str, delay: str, slide: str, keys: list[str], panes_per_window: int = 1) -> DataFrame:
    """Windows that have ended, from the closed panes: window_start, window_end, keys, n.

    A window of one pane is that pane. Windows whose last panes are still open are left
    out, as are windows without rows.
    """
    panes = spark.read.parquet(f"{folder}/panes")
    if panes_per_window == 1:
        return panes
    step = F.expr(f"interval {slide}")
    ends = F.transform(F.sequence(F.lit(0), F.lit(panes_per_window - 1)), lambda k: F.col("window_end") + step * k)
    sums = panes.withColumn("window_end", F.explode(ends)).groupBy("window_end", *keys).agg(F.sum("n").alias("n"))
    ended = sums.where(F.col("window_end") <= watermark(spark, folder, delay))
    return ended.select((F.col("window_end") - step * panes_per_window).alias("window_start"), "window_end", *keys, "n")


def count_sessions(stream: DataFrame, folder: str, checkpoint: str, time: str, delay: str, gap: str, keys: list[str]) -> list[dict]:
    """Land the available rows and append the sessions that ended to ``folder/sessions``; returns the stream's progress.

    A session is activity without a pause of ``gap`` or more. A row is late if it is not
    after the watermark, so that it can never belong to a session already written.
    """
    land(stream, folder, f"{checkpoint}/land", time, delay, F.col(time))
    rows = _on_time(stream.sparkSession, folder).withWatermark(time, delay)
    found = rows.groupBy(F.session_window(time, gap).alias("w"), *keys).agg(F.count(F.lit(1)).alias("n"))
    found = found.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *keys, "n")
    return _append(found, f"{folder}/sessions", f"{checkpoint}/count")
