"""Reading a judge's free text: pairwise labels and multi-way winners."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions.binding import let
from duelboard.functions.text import strip


def parse_label(text: Column, patterns=K.VERDICT_PATTERNS) -> Column:
    """Last non-empty match of the first pattern that has one, upper-cased."""
    upper = F.upper(text)
    found = []
    for pattern in patterns:
        groups = re.compile(pattern).groups
        if groups > 1:
            raise ValueError(f"verdict pattern has more than one group: {pattern}")
        hits = F.regexp_extract_all(upper, F.lit(pattern), F.lit(groups))
        found.append(F.try_element_at(F.filter(hits, lambda x: x != ""), F.lit(-1)))
    return strip(F.coalesce(*found))


def _labels_where(test) -> list[str]:
    return [label for label, value in K.LABEL_SCORES.items() if test(*value)]


def is_known_label(label: Column) -> Column:
    return F.coalesce(label.isin(*K.LABEL_SCORES), F.lit(False))


def label_score(label: Column) -> Column:
    """1, 0.5 or 0 for the first assistant; null for an unknown label."""
    return (
        F.when(label.isin(_labels_where(lambda s, w: s == 1.0)), 1.0)
        .when(label.isin(_labels_where(lambda s, w: s == 0.5)), 0.5)
        .when(label.isin(_labels_where(lambda s, w: s == 0.0)), 0.0)
    )


def label_weight(label: Column) -> Column:
    """How many battles a label stands for; 0 for an unknown label."""
    return (
        F.when(label.isin(_labels_where(lambda s, w: w == 3)), 3)
        .when(label.isin(_labels_where(lambda s, w: w == 1)), 1)
        .otherwise(0)
    )


def label_code(label: Column) -> Column:
    """Position of the label in the table of fixed values, 0 if unknown."""
    return F.coalesce(
        F.array_position(F.array(*[F.lit(x) for x in K.LABEL_SCORES]), label), F.lit(0)
    ).cast("int")


def code_votes(code: Column, score: float) -> Column:
    """Battles with the given score that a label code stands for."""
    weights = [w if s == score else 0 for s, w in K.LABEL_SCORES.values()]
    return F.get(F.array(*[F.lit(w).cast("bigint") for w in (0, *weights)]), code)


def normalize_winner(value: Column) -> Column:
    """A, B, C or TIE from loosely quoted text; null for anything else."""
    cleaned = F.upper(strip(F.btrim(strip(value), F.lit('"'))))
    return F.when(cleaned.isin("A", "B", "C", K.TIE), cleaned)


def _line_value(text: Column, label: str) -> Column:
    """Values of all lines that start with ``label:`` in any case."""
    breaks = K.LINE_BREAK_CLASS
    pattern = (
        rf"(?i)(?:\A|(?<=[{breaks}]))[{K.SPACE_CLASS}]*{label}:([^{breaks}]*)"
    )
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(1))


def _json_text(payload: Column, key: str) -> Column:
    """The value under ``key`` or its capitalised form if that is a string."""

    def at(name: str) -> Column:
        return F.try_variant_get(payload, f"$.{name}", "variant")

    def truthy(value: Column) -> Column:
        # Python's `or`: empty strings, zeros, false, null, [] and {} give way.
        as_json = F.to_json(value)
        return F.when(
            ~as_json.isin('""', "0", "0.0", "-0.0", "false", "null", "[]", "{}"), value
        )

    chosen = F.coalesce(truthy(at(key)), at(key.capitalize()))
    is_text = F.schema_of_variant(chosen) == "STRING"
    return F.when(is_text, F.try_variant_get(chosen, "$", "string"))


def parse_comparison(reply: Column) -> Column:
    """STRUCT<comparison, winner> from a reply in line or JSON form.

    Lines win over JSON, the last line of a kind wins, and an invalid winner line
    falls through to a search for ``"winner": "X"`` and then for a bare A, B, C
    or TIE anywhere in the text (which also accepts the article "a").
    """

    def winner_of(text: Column, payload: Column) -> Column:
        stated = let(
            _line_value(text, "winner"),
            lambda lines: F.when(
                F.size(lines) > 0, normalize_winner(F.element_at(lines, -1))
            ).otherwise(normalize_winner(_json_text(payload, "winner"))),
        )
        space = K.SPACE_CLASS
        quoted = F.regexp_extract(
            text, rf'(?i)"winner"[{space}]*:[{space}]*"(A|B|C|TIE)"', 1
        )
        bare = F.regexp_extract(
            text, r"(?i)(?<![\p{L}\p{N}_])(A|B|C|TIE)(?![\p{L}\p{N}_])", 1
        )
        return F.coalesce(
            stated,
            F.upper(F.nullif(quoted, F.lit(""))),
            F.upper(F.nullif(bare, F.lit(""))),
        )

    def comparison_of(text: Column, payload: Column) -> Column:
        stated = let(
            _line_value(text, "comparison"),
            lambda lines: F.when(F.size(lines) > 0, strip(F.element_at(lines, -1))).otherwise(
                strip(_json_text(payload, "comparison"))
            ),
        )
        return F.when(text != "", stated)

    def read(text: Column) -> Column:
        payload = F.when(text.startswith("{"), F.try_parse_json(text))
        return let(
            payload,
            lambda p: F.struct(
                comparison_of(text, p).alias("comparison"), winner_of(text, p).alias("winner")
            ),
        )

    return let(strip(reply), read)


def settle_winner(winner: Column, labels: Column) -> Column:
    """STRUCT<winner, winner_key>: an unknown position counts as a tie.

    ``labels`` maps the positions in use (A, B, C) to candidate names.
    """
    known = F.coalesce(
        F.map_contains_key(labels, winner) | (winner == K.TIE), F.lit(False)
    )
    settled = F.when(known, winner).otherwise(F.lit(K.TIE))
    return F.struct(
        settled.alias("winner"),
        F.coalesce(F.try_element_at(labels, settled), settled).alias("winner_key"),
    )
