"""Text helpers with Python's notion of whitespace.

Spark's ``trim`` removes blanks only and Java's ``\\s`` is ASCII, so the
whitespace set is spelled out once (``constants.PY_SPACES``) and used in
``btrim`` and in regular-expression classes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions.binding import let


def strip(text: Column) -> Column:
    """Remove whitespace from both ends."""
    return F.btrim(text, F.lit(K.PY_SPACES))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(K.PY_SPACES))


def is_blank(text: Column) -> Column:
    """True for null and for whitespace-only text."""
    return F.coalesce(strip(text) == "", F.lit(True))


def is_falsy(text: Column) -> Column:
    """True for null and for the empty string (whitespace counts as text)."""
    return F.coalesce(text == "", F.lit(True))


def normalize_newlines(text: Column) -> Column:
    """Turn CRLF and lone CR into LF."""
    unified = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return F.replace(unified, F.lit("\r"), F.lit("\n"))


def clean_content(text: Column) -> Column:
    """Normalised newlines, trimmed."""
    return strip(normalize_newlines(text))


def compact_spaces(text: Column) -> Column:
    """Join the whitespace-separated words with single blanks."""
    return strip(F.regexp_replace(text, f"(?U)[{K.UNICODE_SPACE}]+", " "))


def preview(text: Column, limit: int = 240) -> Column:
    """Compact one-line excerpt of at most ``limit`` characters."""
    return let(
        compact_spaces(text),
        lambda compact: F.when(F.length(compact) <= limit, compact).otherwise(
            F.concat(F.left(compact, F.lit(limit - 3)), F.lit("..."))
        ),
    )


def summarize(text: Column, max_chars: int = 512) -> Column:
    """The text itself, or its first ``max_chars`` characters and an ellipsis."""
    return F.when(F.length(text) <= max_chars, text).otherwise(
        F.concat(F.left(text, F.lit(max_chars)), F.lit("..."))
    )


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.regexp_count(text, F.lit(f"(?U)[^{K.UNICODE_SPACE}]+"))


def short_model_name(model: Column) -> Column:
    """Last ``/`` segment of a model name."""
    return F.substring_index(model, "/", -1)


def safe_name(value: Column, default: str = "benchmark") -> Column:
    """A name usable as a file or partition name."""
    dashed = F.btrim(
        F.regexp_replace(strip(value), "[^A-Za-z0-9._-]+", "-"), F.lit("-")
    )
    return F.when(dashed == "", F.lit(default)).otherwise(dashed)


def cut_at_stop(text: Column, stops=K.STOP_STRINGS) -> Column:
    """Text before the earliest stop string, trimmed."""
    if not stops:
        return strip(text)
    positions = [F.nullif(F.locate(stop, text), F.lit(0)) for stop in stops]
    first = positions[0] if len(positions) == 1 else F.least(*positions)
    return strip(
        F.when(first.isNull(), text).otherwise(F.left(text, first - F.lit(1)))
    )


def utf8_safe(value: Column) -> Column:
    """Replace invalid UTF-8 sequences (input may be string or binary)."""
    return F.make_valid_utf8(value.cast("string"))


def effectively_empty(
    text: Column, *, drop_escapes: bool = False, mode: str = "fixed"
) -> Column:
    """True when nothing is left after removing special tokens and whitespace.

    ``drop_escapes`` also removes literal backslash-n/r/t pairs (the variant used
    when stored pairs are filtered). ``mode='reference'`` keeps the historical
    special-token pattern; ``'fixed'`` uses the pattern it was meant to be.
    """
    if mode not in ("fixed", "reference"):
        raise ValueError("mode must be 'fixed' or 'reference'")
    # The historical pattern rescans the rest of the text from every position.
    # Runs without a backslash before the next ">" can never match; taking such a
    # run in one step ("$1" puts it back) gives the same result in linear time.
    kept_run = r"([^>\\]++(?=>|\z))|"
    token = K.SPECIAL_TOKEN_FIXED if mode == "fixed" else kept_run + K.SPECIAL_TOKEN_LITERAL
    kept = "" if mode == "fixed" else "$1"
    body = normalize_newlines(text) if drop_escapes else text
    body = strip(body)
    if drop_escapes:
        body = F.regexp_replace(body, r"(?:\\[nrt])+", "")
    return F.coalesce(strip(F.regexp_replace(body, token, kept)) == "", F.lit(True))


def seed_from_key(key: Column, seed: int) -> Column:
    """First eight bytes of SHA-256 of ``seed-key``, big endian, as DECIMAL(20,0)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}-"), key), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("decimal(20,0)")
