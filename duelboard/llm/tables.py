"""Reading input tables, column names that cannot clash, and shared scratch folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Arrow batches for long texts; applied where the session has left Spark's defaults.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
    "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m"),
}


def bound_batches(spark: SparkSession) -> None:
    """Keep the text that a task hands to Python at once to a few megabytes."""
    for key, (default, wanted) in BATCHES.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, wanted)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def column(df: DataFrame, name: str) -> Column:
    """Column of that exact name, also if it holds dots or other signs."""
    return df["`" + name.replace("`", "``") + "`"]


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors see.

    The session decides where; only a local session without that setting gets a
    folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there."""
    bound_batches(df.sparkSession)
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_fold(doc_id: Column, remainder: int) -> Column:
    """True where the CRC-32 of the id's text leaves ``remainder`` modulo 5; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == remainder
