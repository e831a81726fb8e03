"""Stored tables dealt into buckets by key, so that joins on the key need not move them.

Rows of one key lie in the files of one bucket. A join, anti-join or grouping on the key
reads the buckets as they lie and moves only the other side; for a store that grows while
each run brings little, that side is the small one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from duelboard.sources.folders import path_exists


def write_bucketed(rows: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Append rows to the store at ``path``, dealt by ``keys`` and sorted by them in each file.

    Every writer and reader of a store must name the same keys and number of buckets.
    Rows are dealt to the buckets first, so an append writes one file per bucket.
    """
    with _table(rows.sparkSession, path, rows.schema, keys, buckets) as name:
        rows.repartition(buckets, *keys).write.mode("append").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def read_bucketed(spark: SparkSession, path: str, schema, keys: list[str], buckets: int) -> DataFrame:
    """The rows of a store; an absent one is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    # the name has to outlive this call: the returned frame is read through it
    return spark.table(_table(spark, path, schema, keys, buckets).name)


class _table:
    """A catalog name for a store, of this session's catalog; as a context it is dropped again, the files stay."""

    def __init__(self, spark: SparkSession, path: str, schema, keys: list[str], buckets: int):
        self.spark, self.name = spark, f"store_{uuid.uuid4().hex}"
        columns = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = ", ".join(f"`{key}`" for key in keys)
        spark.sql(
            f"create table {self.name} ({columns}) using parquet clustered by ({by}) sorted by ({by}) into {buckets} buckets location '{path}'"
        )

    def __enter__(self) -> str:
        return self.name

    def __exit__(self, *_) -> None:
        self.spark.sql(f"drop table {self.name}")
