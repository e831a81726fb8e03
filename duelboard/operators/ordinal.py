"""Dense numbers for all rows, and what an even numbering gives: shards filled to within one row."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_ordinal(rows: DataFrame, store: str, order: list[str] | None = None, name: str = "ordinal") -> DataFrame:
    """``rows`` with a gapless number from 0, in the order of ``order`` or, without it, as they lie.

    Rows are written to ``store`` once with their partition and their place in it; the
    rows of each partition are counted, and a partition starts where those before it end.
    No task holds more than its partition, and only one short row per partition is
    broadcast. Rows that ``order`` does not tell apart are numbered in any order.
    """
    spark = rows.sparkSession
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    part, place = f"{name}_part", f"{name}_place"
    placed = rows.withColumns({part: F.spark_partition_id(), place: F.monotonically_increasing_id()})
    placed.write.parquet(store)
    placed = spark.read.schema(placed.schema).parquet(store)
    counts = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(part, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    at = F.col("_start") + F.col(place) - F.shiftleft(F.col(part).cast("long"), 33)
    return placed.join(F.broadcast(starts), part).withColumn(name, at).drop(part, place, "_start")


def round_robin(rows: DataFrame, shards: int, store: str, order: list[str] | None = None) -> DataFrame:
    """``rows`` with ``shard``: dealt in turn, so that the numbers of rows differ by one at most."""
    dealt = with_ordinal(rows, store, order, "_turn")
    return dealt.withColumn("shard", F.pmod(F.col("_turn"), F.lit(int(shards))).cast("int")).drop("_turn")
