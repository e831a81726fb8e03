"""Dialogue transcripts with ``Human:`` / ``Assistant:`` tags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelboard.functions.binding import let
from duelboard.functions.text import normalize_newlines, strip

MESSAGES_TYPE = "array<struct<role:string,content:string>>"


def parse_transcript(text: Column) -> Column:
    """ARRAY<STRUCT<role, content>> of the tagged turns; empty turns vanish.

    Two line feeds are put in front unconditionally: text before the first tag is
    dropped anyway, so a transcript that already starts with a tag is unchanged.
    """
    body = F.concat(F.lit("\n\n"), normalize_newlines(text))
    parts = F.split(body, r"\n\n(?=(?:Human|Assistant):)")
    # the end of an array is far enough for any split result
    tagged = F.slice(parts, F.lit(2), F.lit(2**30))

    def message(part: Column) -> Column:
        human = part.startswith("Human:")
        tag_length = F.when(human, F.lit(6)).otherwise(F.lit(10))
        return F.struct(
            F.when(human, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
            strip(F.substr(part, tag_length + F.lit(1))).alias("content"),
        )

    return F.filter(F.transform(tagged, message), lambda m: m["content"] != "")


def render_transcript(messages: Column) -> Column:
    """Messages back to tagged text; every non-user role prints as Assistant."""
    lines = F.transform(
        messages,
        lambda m: F.concat(
            F.when(m["role"] == "user", F.lit("\n\nHuman: ")).otherwise(
                F.lit("\n\nAssistant: ")
            ),
            m["content"],
        ),
    )
    return strip(F.array_join(lines, ""))


def render_prompt(messages: Column) -> Column:
    """Rendered history followed by the assistant cue."""
    return let(
        render_transcript(messages),
        lambda history: F.when(history == "", F.lit("Assistant:")).otherwise(
            F.concat(history, F.lit("\n\nAssistant:"))
        ),
    )


def all_but_last(messages: Column) -> Column:
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def last_message(messages: Column) -> Column:
    return F.try_element_at(messages, F.lit(-1))


def is_example(messages: Column, single_turn_only: bool) -> Column:
    """At least two messages, user first, assistant last (exactly two if single)."""
    size_ok = F.size(messages) == 2 if single_turn_only else F.size(messages) >= 2
    return F.coalesce(
        size_ok
        & (last_message(messages)["role"] == "assistant")
        & (F.try_element_at(messages, F.lit(1))["role"] == "user"),
        F.lit(False),
    )


def prompt_example(messages: Column, single_turn_only: bool) -> Column:
    """STRUCT<prompt_messages, instruction, output>, null when not eligible."""

    def example(m: Column) -> Column:
        prompt = all_but_last(m)
        if single_turn_only:
            instruction = F.try_element_at(prompt, F.lit(1))["content"]
        else:
            instruction = render_prompt(prompt)
        return F.when(
            is_example(m, single_turn_only),
            F.struct(
                prompt.alias("prompt_messages"),
                instruction.alias("instruction"),
                last_message(m)["content"].alias("output"),
            ),
        )

    return let(messages, example)


def prompt_and_reference(messages: Column) -> Column:
    """STRUCT<prompt_messages, reference>: the final assistant turn split off.

    ``prompt_messages`` is null unless what remains ends on a user turn.
    """

    def halves(m: Column) -> Column:
        ends_on_answer = F.coalesce(last_message(m)["role"] == "assistant", F.lit(False))
        rest = F.when(ends_on_answer, all_but_last(m)).otherwise(m)
        return F.struct(
            F.when(last_message(rest)["role"] == "user", rest).alias("prompt_messages"),
            F.when(ends_on_answer, last_message(m)["content"]).alias("reference"),
        )

    return let(messages, halves)


def has_raw_tags(messages: Column) -> Column:
    """True if any content still holds a role tag at its start or after a gap."""
    return F.exists(
        messages, lambda m: m["content"].rlike(r"(?:^|\n\n)(?:Human|Assistant):")
    )
