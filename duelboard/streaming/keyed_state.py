"""Tables that keep one row per key while rows keep arriving.

The keys seen so far are state of the stream (a RocksDB store per shuffle partition), so a
batch looks up only the keys it brings, however large the table has grown. Nothing
expires: a first arrival is kept however late it comes.
"""

from __future__ import annotations

import hashlib
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duelboard.sources.folders import path_exists

STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """State in RocksDB, so that it need not fit into memory; set only where the session has another store."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != STATE_PROVIDER:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)


def best_rows(stream: DataFrame, keys: list[str], order: str, last: bool) -> DataFrame:
    """One row per key: the best by ``order`` in ``best``, and the least and the greatest ``_arrival`` of its rows.

    Rows without an order come after all others. The aggregate merges before the shuffle,
    so a key that makes up much of the input sends one row per task.
    """
    row, at = F.struct(*[c for c in stream.columns if c not in ("_stored", "_arrival")]), F.col(order)
    best = F.max_by(row, F.struct(at.isNotNull(), at)) if last else F.min_by(row, F.struct(at.isNull(), at))
    return stream.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(
        best.alias("best"), F.min("_arrival").alias("since"), F.max("_arrival").alias("until"), F.max("_stored").alias("stored")
    )


def one_row_per_key(stream: DataFrame, table: str, checkpoint: str, keys: list[str], order: str = "ord", last: bool = False) -> None:
    """Append to ``table`` one row of every key that it does not hold: its first batch's first (or last) by ``order``.

    Takes the available input and stops. Rows go to ``run=<id>/batch=<id>``, the run being
    named after the checkpoint. A replayed batch starts from the same state and writes its
    own directory again. A new checkpoint on an existing table takes the table's keys as a
    second source, once, and overwrites nothing. Rows with a null key make one key.

    A key is new if all its rows arrived in one batch, told by the time that Spark notes
    in the checkpoint for each batch and uses again when the batch is replayed.
    """
    spark = stream.sparkSession
    use_rocksdb(spark)
    run = hashlib.md5(checkpoint.encode()).hexdigest()[:16]
    held = f"{checkpoint}/held"
    if not path_exists(spark, f"{held}/_SUCCESS"):
        known = spark.createDataFrame([], stream.schema)
        if path_exists(spark, table):
            known = spark.read.parquet(table)
            known = known.where(known["run"] != f"r{run}") if "run" in known.columns else known
        known.select(*keys).distinct().write.mode("overwrite").parquet(held)
    schema = StructType([stream.schema[k] for k in keys])
    others = [F.lit(None).cast(f.dataType).alias(f.name) if f.name not in keys else F.col(f.name) for f in stream.schema]
    before = spark.readStream.schema(schema).parquet(held).select(*others, F.lit(True).alias("_stored"))
    rows = stream.withColumn("_stored", F.lit(False)).unionByName(before)
    picked = best_rows(rows.withColumn("_arrival", F.current_timestamp()), keys, order, last)
    chosen = picked.where((F.col("since") == F.col("until")) & ~F.col("stored")).select("best.*")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/run=r{run}/batch={batch_id}")

    query = chosen.writeStream.option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).foreachBatch(save).start()
    query.awaitTermination()
