"""Sessions, shared scratch space and join hints."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of an Arrow batch, see ``bound_batches``.
ARROW_BYTES = "4m"


def build_session(app_name: str = "duelboard", **conf: str) -> SparkSession:
    """Session with the settings the operators are tuned for.

    AQE coalesces small shuffles and splits skewed ones, so the shuffle
    partition count can be set for the large case.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new directory below the session's shared checkpoint folder.

    Every executor must see it. A session on one machine that has not named a folder
    gets one, which it keeps; on a cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="duelboard-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches of few bytes for Python workers that hold long texts, where the session has set nothing.

    A worker holds a batch several times over (as it came, as objects, as it leaves), so
    Spark's own bound lets four workers take gigabytes.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) in ("64MB", "67108864b", "67108864"):
        spark.conf.set(name, ARROW_BYTES)


@contextlib.contextmanager
def conf_held(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """Settings for the work done inside; afterwards they are as before."""
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def work_partitions(spark: SparkSession) -> int:
    """Partitions for work whose cost the row bytes do not show.

    Adaptive execution merges partitions by size; a few bytes that expand into much
    computation must keep an explicit count: the configured one, or one per core.
    """
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread_scan(df: DataFrame) -> DataFrame:
    """The rows of a scan over as many tasks as there are cores, if its files give fewer.

    For work that costs much per byte, such as regular expressions over long texts. A
    table of many files is returned as it is: its scan already has the tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def broadcast_if_small(df: DataFrame, max_rows: int = 1_000, max_bytes: int = 8_000_000) -> DataFrame:
    """Broadcast hint for a table shown to have few rows and few bytes of text in them.

    Larger tables are returned as they are, so the join shuffles them.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, taken = df.limit(max_rows + 1).agg(F.count("*"), size).first()
    return F.broadcast(df) if rows <= max_rows and (taken or 0) <= max_bytes else df
