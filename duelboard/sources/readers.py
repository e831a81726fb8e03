"""Readers for JSON-lines records and dialogue tables.

Every reader declares its schema. Input order matters to several rules ("first
row wins", "last file wins"), so readers attach the file name and a row ordinal
where the record itself does not carry one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard import schemas
from duelboard.functions.text import is_blank, is_falsy
from duelboard.functions.transcripts import parse_transcript, prompt_example
from duelboard.operators.keyed import (
    current_files,
    first_rows,
    keep_first,
    keep_last,
    last_dealt,
    replaced_places,
    unless_marked,
)
from duelboard.session import scratch_dir
from duelboard.sources.folders import path_exists


def read_jsonl(spark: SparkSession, path, schema: str, mode: str = "FAILFAST") -> DataFrame:
    """JSON-lines rows; a malformed line fails the read.

    Lines end at LF or CRLF only, so U+2028 inside a string stays in its row.
    Blank lines are skipped. Files ending in .zstd are read as such, see ``writers.write_jsonl``.
    """
    reader = spark.read.schema(schema).option("mode", mode).option("lineSep", "\n")
    return reader.option("io.compression.codecs", K.ZSTD_CODEC).json(path)


def read_jsonl_tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON-lines rows; malformed lines are skipped."""
    return read_jsonl(spark, path, schema, mode="DROPMALFORMED")


def read_jsonl_with_rejects(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Every line with its file, and the raw text in ``_corrupt`` if malformed."""
    full = f"{schema}, _corrupt string"
    df = (
        spark.read.schema(full)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .option("lineSep", "\n")
        .json(path)
    )
    return df.withColumn("file_name", file_name())


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Elements of JSON-array files as rows."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def file_name() -> Column:
    return F.substring_index(F.col("_metadata.file_path"), "/", -1)


def with_input_order(df: DataFrame) -> DataFrame:
    """Adds file_name and, unless the record has one, ``ord``: the reading order.

    Inside a split the generated id grows with the position, and splits of a file
    are ordered by their start offset, so (start, id) orders the rows of a file.
    """
    order = F.struct(
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("id"),
    )
    named = df.withColumn("file_name", file_name())
    return named if "ord" in df.columns else named.withColumn("ord", order)


def read_keyed(spark: SparkSession, path: str, schema: str, key: str, order: str = "ord") -> DataFrame:
    """Last row per key; rows without the key are skipped; a missing file is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = with_input_order(read_jsonl(spark, path, schema))
    last = keep_last(rows.where(F.col(key).isNotNull()), [key], order)
    return last.select(*spark.createDataFrame([], schema).columns)


def read_json_outputs(
    spark: SparkSession, path: str, name: str, schema: str = schemas.CANDIDATE
) -> DataFrame:
    """A candidate's output array: usable rows, first per instruction."""
    rows = with_input_order(read_json_array(spark, path, schema))
    usable = rows.where(~is_falsy(F.col("instruction")) & F.col("output").isNotNull())
    return keep_first(usable, ["instruction"]).withColumn("name", F.lit(name))


def resolve_answers(rows: DataFrame, place: str | None = None) -> DataFrame:
    """Answer rows of all files -> one row per model and uid.

    ``rows`` has file_name, ord, model, uid. A file's first row names its model,
    a later file replaces an earlier one of the same model, and the last row of a
    uid wins.

    With ``place``, a column that was stored with the rows (``writers.with_places``), texts
    are not shuffled: the other columns are read first and tell which places to leave out.
    """
    if place is None:
        return last_answers(current_files(rows))
    index = stored_index(rows.select("file_name", "model", "uid", "ord", place))
    known = lambda df: current_files(df, heads=index).where(F.col("uid").isNotNull())
    marks = replaced_places(known(index).select("file_name", "uid", "ord", place), ["file_name", "uid"], place)  # a file of each model
    return unless_marked(known(rows), marks, place).drop(place)


def stored_index(rows: DataFrame) -> DataFrame:
    """Short rows that several steps need, stored so that the files with the texts are read for them once."""
    path = scratch_dir(rows.sparkSession, "index")
    rows.write.option("compression", "zstd").option("parquet.writer.version", "v2").parquet(path)  # v2: numbers as differences
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def last_answers(current: DataFrame) -> DataFrame:
    """The last row per model and uid of the rows of current files."""
    return last_dealt(current.where(F.col("uid").isNotNull()), ["model", "uid"], "uid")


def read_answers(spark: SparkSession, directory: str) -> DataFrame:
    """All answer files of a directory, resolved."""
    if not path_exists(spark, directory):
        return spark.createDataFrame([], f"{schemas.ANSWER}, file_name string, first_file string")
    rows = read_jsonl(spark, f"{directory}/*.jsonl", schemas.ANSWER)
    return resolve_answers(with_input_order(rows))


def read_judgments(
    spark: SparkSession, directory: str, judges: list[str], schema: str = schemas.JUDGMENT
) -> DataFrame:
    """Judgments of several judges from a ``judge=<name>`` layout.

    The judge filter prunes directories, so other judges' files are never listed
    for reading. Rows of all chosen judges are pooled, duplicates kept.
    """
    rows = read_jsonl(spark, directory, schema)
    return rows.where(F.col("judge").isin(judges))


def normalize_questions(rows: DataFrame, max_instances: int | None = None) -> DataFrame:
    """Questions with a uid and a non-blank prompt, in input order."""
    usable = rows.where(F.col("uid").isNotNull() & ~is_blank(F.col("prompt")))
    return first_rows(
        usable.withColumns(
            {"uid": F.col("uid").cast("string"), "category": F.col("category").cast("string")}
        ),
        max_instances,
    )


def normalize_legacy_questions(rows: DataFrame, max_instances: int | None = None) -> DataFrame:
    """The older question set: a default category and an optional cluster."""
    category = F.coalesce(
        F.nullif(F.col("category").cast("string"), F.lit("")), F.lit(K.LEGACY_CATEGORY)
    )
    return normalize_questions(
        rows.withColumns({"category": category, "cluster": F.col("cluster").cast("string")}),
        max_instances,
    )


def require_rows(df: DataFrame, message: str) -> DataFrame:
    """The frame itself; raises when it is empty."""
    if df.isEmpty():
        raise ValueError(message)
    return df


def read_questions(spark: SparkSession, path: str, max_instances: int | None = None) -> DataFrame:
    rows = with_input_order(read_jsonl(spark, path, schemas.QUESTION))
    return require_rows(
        normalize_questions(rows, max_instances), "question file is empty after normalization"
    )


def dialogue_text() -> Column:
    """First non-empty of chosen, prompt and text."""
    return F.coalesce(
        F.nullif("chosen", F.lit("")), F.nullif("prompt", F.lit("")), F.col("text")
    )


def dialogue_examples(rows: DataFrame, text: Column, single_turn_only: bool) -> DataFrame:
    """ord, prompt_messages, instruction, output of the eligible transcripts."""
    parsed = rows.select("ord", text.alias("_text")).where(F.col("_text").isNotNull())
    messages = parsed.withColumn("_m", parse_transcript(F.col("_text"))).drop("_text")
    examples = messages.select("ord", prompt_example(F.col("_m"), single_turn_only).alias("e"))
    return examples.where(F.col("e").isNotNull()).select("ord", "e.*")


def eval_examples(rows: DataFrame, single_turn_only: bool = True, max_instances: int | None = None) -> DataFrame:
    return first_rows(dialogue_examples(rows, dialogue_text(), single_turn_only), max_instances)


def chosen_outputs(
    rows: DataFrame, repo: str, split: str, single_turn_only: bool = True, max_instances: int | None = None
) -> DataFrame:
    """instruction, output, generator of the chosen transcripts."""
    examples = dialogue_examples(rows, F.col("chosen"), single_turn_only)
    return first_rows(
        examples.select(
            "ord", "instruction", "output", F.lit(f"{repo}:{split}:chosen").alias("generator")
        ),
        max_instances,
    )
