"""Training-data pipeline over ``documents``: filter, deduplicate, decontaminate, replace personal data, encode.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the runner writes it
as Parquet to the shared folder and reads it again as the next stage's documents, so a
lost executor costs no more than a part of one stage. All stages but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelboard.llm.queries import SURROGATE_KEY, vocabulary_path
from duelboard.llm.tables import column, cut, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose whole text scores below one half; the classifier learns from the stage's own input."""
    from duelboard.llm.pu_toxicity import keep_clean

    return keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: that with the smallest id."""
    from duelboard.llm.bagminhash import keep_one_of_each

    return keep_one_of_each(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, up to its error budget."""
    from duelboard.llm.edit_decontam import keep_uncontaminated

    return keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with surrogates in place of personal data; ``n_chars`` follows the new text."""
    from duelboard.llm.surrogates import replace_entities

    out = replace_entities(docs, SURROGATE_KEY)
    kind = dict(docs.dtypes).get("n_chars")
    if kind is None:
        return out
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the token ids of the whole text of every row, with their number."""
    from duelboard.llm.chunk_bpe import encode_texts

    ids = docs.select(column(docs, "doc_id").alias("doc_id"), encode_texts(column(docs, "text"), vocabulary_path()).alias("ids"))
    return ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("pii", replace_personal_data),
    ("bpe", encode),
]

#: SQL cannot express the classifier, the signatures or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from the ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
