"""Model calls that are made once: an append-only log of replies, and what it still lacks."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from duelboard.operators.keyed import without
from duelboard.operators.replies import call_judge
from duelboard.sources.folders import path_exists

def request_digest(keys: list[str], sent: str) -> Column:
    """Digest of a request's keys and of what is sent: a changed prompt is another request."""
    return F.md5(F.to_json(F.struct(*keys, sent)))


def logged_calls(spark, log: str, schema: StructType) -> DataFrame:
    """All calls of a log, failed ones too, with the ``run`` that made them."""
    schema = StructType([*schema.fields, StructField("run", StringType())])
    return spark.read.schema(schema).parquet(f"{log}/calls") if path_exists(spark, f"{log}/calls") else spark.createDataFrame([], schema)


def ask_once(requests: DataFrame, make_reply: Callable, log: str, keys: list[str], every: int | None = None, sent: str = "messages") -> DataFrame:
    """``requests`` with reply and error, asking only what the log has no reply for.

    ``keys`` tell the requests apart, ``sent`` is the column that is sent. Calls are
    appended to the log in run folders, with all columns of their requests, and never
    overwritten: whatever reads them again, or recomputes a lost partition, finds the
    stored ones, and each prompt is stored once however many runs there are. With
    ``every`` about that many calls are made per run folder, so a stopped run loses no
    more than those; started again, it asks the rest. A call that failed is logged with
    its error and asked again by the next run.
    """
    spark, run = requests.sparkSession, uuid.uuid4().hex
    wanted = requests.withColumn("request", request_digest(keys, sent))
    schema = StructType([*wanted.schema.fields, StructField("reply", StringType()), StructField("error", StringType())])
    logged = path_exists(spark, f"{log}/calls")
    pending, slices = wanted, 1
    if logged:  # the requests come from one stored table, so that prompts are built once
        wanted = _written(wanted, f"{log}/wanted/run={run}")
        pending = without(wanted, logged_calls(spark, log, schema).where(F.col("reply").isNotNull()), ["request"])
    if every is not None:
        pending = _written(pending, f"{log}/pending/run={run}")
        slices = max(1, math.ceil(pending.count() / every))
    for number in range(slices):
        part = pending.where(F.pmod(F.xxhash64("request"), F.lit(slices)) == number) if slices > 1 else pending
        made = call_judge(part, make_reply, wanted.columns)
        made.select(schema.names).write.option("compression", "zstd").parquet(f"{log}/calls/run={run}-{number}")
    calls = logged_calls(spark, log, schema)
    if not logged:  # this run's calls are all that was asked, and nothing has to be matched
        return calls.where(F.col("run").startswith(run)).drop("request", "run")
    final = calls.where(F.col("reply").isNotNull() | F.col("run").startswith(run))
    return final.join(wanted.select("request"), "request", "left_semi").drop("request", "run")


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
