"""Style features of an answer: length and markdown counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions.binding import let
from duelboard.functions.text import strip, word_count

HEADER_LEVELS = ("h1", "h2", "h3", "h4", "h5", "h6")
FEATURES = ("length", "headers", "lists", "bolds")


def drop_fenced(text: Column) -> Column:
    """Delete every fenced body wherever it occurs; the backticks stay."""
    bodies = F.regexp_extract_all(text, F.lit(K.FENCE_PATTERN), F.lit(1))
    removed = F.aggregate(
        bodies, text, lambda left, body: F.replace(left, body, F.lit(""))
    )
    return F.when(F.contains(text, F.lit("```")), removed).otherwise(text)


def markdown_markers(text: Column) -> Column:
    """ARRAY of the header and list markers that open a line, in one scan.

    Headers and list items cannot overlap, so one alternation finds both. Leading
    blank lines of a list item need not be matched: the bullet opens its own line
    either way, and staying on one line keeps the scan linear.
    """
    pattern = (
        rf"(?mdU)^(?:#{{1,6}}|[{K.UNICODE_SPACE}&&[^\n]]*+(?:\p{{Nd}}+\.|[-*+]))"
        rf"[{K.UNICODE_SPACE}]"
    )
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(hits, lambda x: strip(x))


def _count_if(items: Column, test) -> Column:
    return F.size(F.filter(items, test)).cast("bigint")


def header_counts(markers: Column) -> Column:
    """MAP h1..h6 -> count."""

    def level_count(marker: str) -> Column:
        return _count_if(markers, lambda x: x == marker)

    entries = []
    for level, name in enumerate(HEADER_LEVELS, start=1):
        entries += [F.lit(name), level_count("#" * level)]
    return F.create_map(*entries)


def list_counts(markers: Column) -> Column:
    """MAP ordered / unordered -> count."""
    return F.create_map(
        F.lit("ordered"),
        _count_if(markers, lambda x: x.endswith(".")),
        F.lit("unordered"),
        _count_if(markers, lambda x: x.isin("-", "*", "+")),
    )


def bold_counts(text: Column) -> Column:
    """MAP ``**`` / ``__`` -> count."""

    def count(marker: str, pattern: str) -> Column:
        hits = F.regexp_count(text, F.lit(pattern)).cast("bigint")
        return F.when(F.contains(text, F.lit(marker)), hits).otherwise(
            F.lit(0).cast("bigint")
        )

    return F.create_map(
        F.lit("**"),
        count("**", K.BOLD_STAR_PATTERN),
        F.lit("__"),
        count("__", K.BOLD_UNDERSCORE_PATTERN),
    )


def style_metadata(text: Column, token_len: Column | None = None) -> Column:
    """STRUCT<token_len, header_count, list_count, bold_count>.

    The length is taken on the raw text, the counts on the text without fenced
    bodies. ``token_len`` may bring a tokenizer's count; words are the fallback.
    """
    length = (word_count(text) if token_len is None else token_len).cast("bigint")

    def counts(cleaned: Column) -> Column:
        return let(
            markdown_markers(cleaned),
            lambda markers: F.struct(
                length.alias("token_len"),
                header_counts(markers).alias("header_count"),
                list_counts(markers).alias("list_count"),
                bold_counts(cleaned).alias("bold_count"),
            ),
        )

    return let(drop_fenced(text), counts)


def counted_words():
    """Pandas UDF with the numbers of ``word_count``, for scans where the words take most of the time.

    ``str.split`` cuts at the same characters and is several times faster than a pattern.
    """

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else len(t.split()) for t in texts], dtype="Int64")

    return count


def feature_vector(text: Column, words: Column | None = None) -> Column:
    """STRUCT of the four feature totals, straight from the text.

    Same numbers as ``metadata_features(style_metadata(text))`` without building
    the maps, for reports that never look at single levels. ``words`` may bring the
    number of words.
    """
    length = word_count(text) if words is None else words

    def bold(cleaned: Column, marker: str, pattern: str) -> Column:
        return F.when(
            F.contains(cleaned, F.lit(marker)),
            F.regexp_count(cleaned, F.lit(pattern)),
        ).otherwise(F.lit(0))

    def totals(cleaned: Column) -> Column:
        bolds = bold(cleaned, "**", K.BOLD_STAR_PATTERN) + bold(
            cleaned, "__", K.BOLD_UNDERSCORE_PATTERN
        )

        def features(markers: Column) -> Column:
            headers = F.size(F.filter(markers, lambda x: x.startswith("#")))
            return F.struct(
                length.cast("double").alias("length"),
                headers.cast("double").alias("headers"),
                (F.size(markers) - headers).cast("double").alias("lists"),
                bolds.cast("double").alias("bolds"),
            )

        return let(markdown_markers(cleaned), features)

    return let(drop_fenced(text), totals)


def _map_total(counts: Column) -> Column:
    values = F.coalesce(F.map_values(counts), F.array().cast("array<bigint>"))
    return F.aggregate(
        values,
        F.lit(0.0),
        lambda total, value: total + F.coalesce(value.cast("double"), F.lit(0.0)),
    )


def metadata_features(metadata: Column) -> Column:
    """STRUCT of the four feature totals from stored style metadata."""
    return F.struct(
        F.coalesce(metadata["token_len"].cast("double"), F.lit(0.0)).alias("length"),
        _map_total(metadata["header_count"]).alias("headers"),
        _map_total(metadata["list_count"]).alias("lists"),
        _map_total(metadata["bold_count"]).alias("bolds"),
    )


def style_difference(candidate: Column, baseline: Column) -> Column:
    """STRUCT of relative differences of two feature structs."""
    a, b = candidate["length"], baseline["length"]
    columns = [((a - b) / F.greatest(a + b, F.lit(1.0))).alias("length")]
    for name in FEATURES[1:]:
        da = candidate[name] / (a + F.lit(1.0))
        db = baseline[name] / (b + F.lit(1.0))
        columns.append(((da - db) / (da + db + F.lit(1.0))).alias(name))
    return F.struct(*columns)


def tokenizer_length(tokenizer_factory):
    """Pandas UDF counting tokens with a tokenizer built once per Python worker.

    ``tokenizer_factory`` returns an object with ``encode(text) -> list``. Its
    vocabulary files must be on every executor.
    """
    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tokenizer = tokenizer_factory()
        for texts in batches:
            yield texts.map(lambda t: None if t is None else len(tokenizer.encode(t)))

    return count
