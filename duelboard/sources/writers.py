"""Writers for JSON-lines records, exports, summaries and logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions.text import safe_name
from duelboard.operators.pairs import empty_indices
from duelboard.session import conf_held


def write_jsonl(
    df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str = "none", open_files: int = 0
) -> None:
    """Replace ``path`` with the rows; readers see the old or the new files.

    With ``partition_by`` only the partitions present in ``df`` are replaced. Compressed
    files are read whole by a task each: there are as many as writing tasks. A task of at
    most ``open_files`` partitions writes its rows as they come; otherwise it sorts them by
    partition first, and wide rows spill.
    """
    writer = df.write.mode("overwrite").option("ignoreNullFields", False)
    writer = writer.option("compression", K.ZSTD_CODEC if compression == "zstd" else compression)
    writer = writer.option("parquet.compression.codec.zstd.level", K.ZSTD_LEVEL)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    with conf_held(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(open_files)} if open_files else {}):
        writer.json(path)


def with_places(df: DataFrame, place: str = "place") -> DataFrame:
    """Adds a number to each row, another for each, to be written with it; those of a writing task follow each other."""
    return df.withColumn(place, F.monotonically_increasing_id())


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", False).json(path)


def write_candidates(df: DataFrame, path: str) -> None:
    """Candidate outputs, one directory per sanitised generator name."""
    named = df.withColumn("generator_dir", safe_name(F.col("generator")))
    write_jsonl(named, path, ["generator_dir"])


def export_json_array(df: DataFrame, path: str) -> None:
    """Rows as JSON-array files (one array per part file), for small exports.

    Each task writes the array of its own rows, so no task holds everything.
    """
    from collections.abc import Iterator

    import pandas as pd

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lead = "["
        for pdf in batches:
            if len(pdf):
                leads = [lead] + [","] * (len(pdf) - 1)
                lead = ","
                yield pd.DataFrame({"value": [a + b for a, b in zip(leads, pdf["row"])]})
        yield pd.DataFrame({"value": ["[]" if lead == "[" else "]"]})

    rows = df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("row"))
    rows.mapInPandas(arrays, "value string").write.mode("overwrite").text(path)


def write_one_row(df: DataFrame, path: str) -> None:
    """A summary or manifest: one row, one file."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def run_record(spark: SparkSession, fields: dict, versions: dict[str, str], question_count: Column | None = None) -> DataFrame:
    """One row describing a run: given fields and package versions."""
    row = spark.range(1).select(
        *[F.lit(value).alias(name) for name, value in fields.items()],
        F.create_map(*[F.lit(x) for pair in sorted(versions.items()) for x in pair]).alias(
            "package_versions"
        ),
    )
    return row if question_count is None else row.withColumn("question_count", question_count)


def generation_log(rows: DataFrame, log_all: bool = False, limit: int | None = None, mode: str = "fixed") -> DataFrame:
    """What was asked and said where generations came back empty (or everywhere), in order, capped.

    prompt_id, prompt_messages, prompt_text, raw_responses, cleaned_responses and the
    places of the empty ones. ``rows`` hold the cleaned ``responses``; the other columns
    are null where they do not have them. The cap is the log's size option.
    """
    kinds = {"prompt_messages": "array<struct<role:string,content:string>>", "prompt_text": "string", "raw_responses": "array<string>"}
    held = [F.col(c) if c in rows.columns else F.lit(None).cast(kind).alias(c) for c, kind in kinds.items()]
    marked = rows.select(
        "prompt_id", *held, F.col("responses").alias("cleaned_responses"), empty_indices(F.col("responses"), mode).alias("empty_indices")
    )
    chosen = marked if log_all else marked.where(F.size("empty_indices") > 0)
    return chosen if limit is None else chosen.orderBy("prompt_id").limit(int(limit))
