"""Exact quantiles of groups of any size.

``percentile`` gathers a group's values in one task. Here equal values are first added up,
the distinct (group, value) pairs are sorted across the cluster by ranges, and running
counts turn places in the sort into ranks. A group that holds most of the rows spreads
over as many partitions as its values fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(rows: DataFrame, keys: list[str], value: str, probabilities: list[float], store: str) -> DataFrame:
    """keys, q, quantile, n: linearly interpolated quantiles of the non-null values of each group.

    ``store`` is a new folder for the sorted counts. Values are compared as doubles, NaN
    after all others. Groups without a value have no rows.
    """
    spark = rows.sparkSession
    values = rows.select(*keys, F.col(value).cast("double").alias("_value")).where(F.col("_value").isNotNull())
    counts = values.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n"))
    ranged = counts.repartitionByRange(*keys, "_value").withColumn("_part", F.spark_partition_id())
    ranged.write.parquet(store)
    ranged = spark.read.schema(ranged.schema).parquet(store)

    # rows of a group in the partitions before: one row per group and partition
    parts = ranged.groupBy(*keys, "_part").agg(F.sum("_n").alias("_held"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        *keys,
        "_part",
        F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_held").over(Window.partitionBy(*keys)).alias("_total"),
    )
    within = Window.partitionBy(*keys, "_part").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = ranged.withColumn("_upto", F.sum("_n").over(within))
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [*keys, "_part"]]
    condition = same[0]
    for one in same[1:]:
        condition = condition & one
    placed = running.alias("r").join(parts.alias("p"), condition).select(
        *[F.col(f"r.{c}").alias(c) for c in keys],
        "_value",
        "_total",
        (F.col("_before") + F.col("_upto") - F.col("_n")).alias("_first"),
        (F.col("_before") + F.col("_upto")).alias("_end"),
    )

    # each value answers the ranks that it covers, usually none
    def target(q: float) -> Column:
        rank = F.lit(float(q)) * (F.col("_total") - 1)
        return F.struct(F.lit(float(q)).alias("q"), F.floor(rank).alias("low"), F.ceil(rank).alias("high"), (rank - F.floor(rank)).alias("share"))

    covers = lambda t: ((t["low"] >= F.col("_first")) & (t["low"] < F.col("_end"))) | ((t["high"] >= F.col("_first")) & (t["high"] < F.col("_end")))
    wanted = F.filter(F.array(*[target(q) for q in probabilities]), covers)
    hit = placed.withColumn("t", F.explode(wanted))
    inside = lambda rank: (F.col(rank) >= F.col("_first")) & (F.col(rank) < F.col("_end"))
    ends = hit.groupBy(*keys, F.col("t.q").alias("q")).agg(
        F.max(F.when(inside("t.low"), F.col("_value"))).alias("_low"),
        F.max(F.when(inside("t.high"), F.col("_value"))).alias("_high"),
        F.first("t.share").alias("_share"),
        F.first("_total").alias("n"),
    )
    return ends.select(*keys, "q", (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_share")).alias("quantile"), "n")
