"""Prompt texts, chat renderings and request / reply payloads."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions.binding import let
from duelboard.functions.text import preview, rstrip, strip

_FIELD = re.compile(r"\{(\w+)\}")


def fill(template: str, **fields: Column) -> Column:
    """Substitute ``{NAME}`` fields in one pass.

    The template is cut into pieces on the driver and concatenated with the
    columns, so braces or field names inside a value are never substituted again.
    """
    pieces = _FIELD.split(template)
    unknown = set(pieces[1::2]) - set(fields)
    if unknown:
        raise KeyError(f"no value for template fields {sorted(unknown)}")
    columns = [
        fields[piece] if index % 2 else F.lit(piece)
        for index, piece in enumerate(pieces)
        if index % 2 or piece
    ]
    return F.concat(*columns)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


# -- judge requests -----------------------------------------------------------


def judge_prompt(
    question: Column, answer_a: Column, answer_b: Column, template=K.JUDGE_TEMPLATE
) -> Column:
    return fill(template, QUESTION=question, ANSWER_A=answer_a, ANSWER_B=answer_b)


def judge_messages(system: Column, user: Column) -> Column:
    return F.array(message("system", system), message("user", user))


def repair_messages(category: Column, analysis: Column) -> Column:
    """Second request for a reply that held no label."""
    return F.array(
        message("system", F.lit(K.REPAIR_SYSTEM)),
        message("user", fill(K.REPAIR_TEMPLATE, CATEGORY=category, ANALYSIS=analysis)),
    )


def comparison_prompt(
    instruction: Column, outputs: Column, positions: int, template: str | None = None
) -> Column:
    """Two- or three-way prompt; ``outputs`` is the array in label order."""
    if positions not in (2, 3):
        raise ValueError("two or three candidates are supported")
    default = K.PAIRWISE_TEMPLATE if positions == 2 else K.THREE_WAY_TEMPLATE

    def at(index: int) -> Column:
        return F.coalesce(F.try_element_at(outputs, F.lit(index)), F.lit(""))

    return fill(
        template or default,
        instruction=instruction,
        output_a=at(1),
        output_b=at(2),
        output_c=at(3),
    )


def instruction_prompt(instruction: Column, template: str) -> Column:
    """One of the named single-field templates."""
    return fill(K.INSTRUCTION_TEMPLATES[template], instruction=instruction)


def ensure_assistant_header(prompt: Column, mode: str = "fixed") -> Column:
    """Append the assistant header unless the prompt already ends on it.

    ``mode='reference'`` keeps the stored header with literal backslash-n pairs,
    which ordinary prompts never end on.
    """
    if mode not in ("fixed", "reference"):
        raise ValueError("mode must be 'fixed' or 'reference'")
    header = K.ASSISTANT_HEADER if mode == "fixed" else K.ASSISTANT_HEADER_LITERAL
    return F.when(
        F.endswith(rstrip(prompt), F.lit(header.rstrip())), prompt
    ).otherwise(F.concat(prompt, F.lit(header)))


# -- chat renderings ----------------------------------------------------------


def render_chatml(messages: Column, add_generation_prompt: bool = True) -> Column:
    first_role = F.try_element_at(messages, F.lit(1))["role"]
    opening = F.when(first_role == "system", F.lit("")).otherwise(
        F.lit(f"<|im_start|>system\n{K.CHATML_DEFAULT_SYSTEM}<|im_end|>\n")
    )
    body = F.transform(
        messages,
        lambda m: F.concat(
            F.lit("<|im_start|>"),
            m["role"],
            F.lit("\n"),
            strip(m["content"]),
            F.lit("<|im_end|>\n"),
        ),
    )
    cue = "<|im_start|>assistant\n" if add_generation_prompt else ""
    return F.concat(opening, F.array_join(body, ""), F.lit(cue))


def render_header_style(
    messages: Column, bos: str = K.LLAMA3_BOS, add_generation_prompt: bool = True
) -> Column:
    body = F.transform(
        messages,
        lambda m: F.concat(
            F.lit("<|start_header_id|>"),
            m["role"],
            F.lit("<|end_header_id|>\n\n"),
            strip(m["content"]),
            F.lit("<|eot_id|>"),
        ),
    )
    opening = F.when(F.size(messages) > 0, F.lit(bos)).otherwise(F.lit(""))
    cue = K.ASSISTANT_HEADER if add_generation_prompt else ""
    return F.concat(opening, F.array_join(body, ""), F.lit(cue))


# -- message contents (string or object) --------------------------------------


def _variant_kind(content: Column) -> Column:
    return F.schema_of_variant(content)


def answer_text(messages: Column) -> Column:
    """Final answer: the last message's text, or its ``answer`` if an object."""
    content = F.try_element_at(messages, F.lit(-1))["content"]
    kind = _variant_kind(content)
    return F.coalesce(
        F.when(
            kind.startswith("OBJECT"), F.try_variant_get(content, "$.answer", "string")
        ).otherwise(F.try_variant_get(content, "$", "string")),
        F.lit(""),
    )


def _plain_content(content: Column) -> Column:
    kind = _variant_kind(content)
    return (
        F.when(kind == "STRING", F.try_variant_get(content, "$", "string"))
        .when(
            kind.startswith("OBJECT"),
            F.coalesce(
                F.try_variant_get(content, "$.answer", "string"), F.to_json(content)
            ),
        )
        .when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(F.to_json(content)))
        .otherwise(F.to_json(content))
    )


def _leaves(content: Column) -> Column:
    """What is no list in a list of lists of any depth, in order; an empty list counts as an empty text.

    Lists are opened level by level until none is left. A list has no more levels than
    its JSON text has opening brackets, so these bound the steps; once all are open a
    step costs nothing.
    """
    is_list = lambda item: _variant_kind(item).startswith("ARRAY")
    empty = F.array(F.lit("").cast("variant"))

    def opened(item: Column) -> Column:
        items = F.try_variant_get(item, "$", "array<variant>")
        return F.when(~is_list(item), F.array(item)).when(F.size(items) > 0, items).otherwise(empty)

    def step(state: Column, _: Column) -> Column:
        deeper = state["more"]
        items = F.when(deeper, F.flatten(F.transform(state["items"], opened))).otherwise(state["items"])
        return let(items, lambda now: F.struct(now.alias("items"), F.when(deeper, F.exists(now, is_list)).otherwise(F.lit(False)).alias("more")))

    levels = F.regexp_count(F.to_json(content), F.lit(r"\["))
    start = F.struct(F.array(content).alias("items"), F.lit(True).alias("more"))
    return F.aggregate(F.sequence(F.lit(1), levels), start, step, lambda state: state["items"])


def content_text(content: Column) -> Column:
    """Any message content as text: answer key, JSON of an object, lists of any depth joined by newlines.

    JSON is Spark's compact form with sorted keys.
    """

    def text(value: Column) -> Column:
        joined = F.array_join(F.transform(_leaves(value), _plain_content), "\n")
        return F.when(_variant_kind(value).startswith("ARRAY"), joined).otherwise(_plain_content(value))

    return let(content, text)


# -- request and reply payloads -----------------------------------------------


def chat_payload(
    messages: Column, model: str, temperature: float, max_tokens: int
) -> Column:
    """JSON body with a message list."""
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            messages.alias("messages"),
            F.lit(float(temperature)).alias("temperature"),
            F.lit(int(max_tokens)).alias("max_tokens"),
        )
    )


def parts_payload(
    messages: Column,
    temperature: float,
    max_tokens: int,
    safety: list[tuple[str, str]] | None = None,
    as_text: Callable[[Column], Column] | None = None,
) -> Column:
    """JSON body with a separate system instruction and text parts.

    A leading system message moves out; later roles map to user or model. ``safety``
    adds settings of (category, threshold). Contents are texts; those of another type
    are turned into texts by ``as_text`` (``content_text`` for VARIANT contents).
    """

    def parts(text: Column) -> Column:
        return F.array(F.struct(text.alias("text")))

    if as_text is not None:
        texts = F.transform(messages, lambda m: F.struct(m["role"].alias("role"), as_text(m["content"]).alias("content")))
        return let(texts, lambda plain: parts_payload(plain, temperature, max_tokens, safety))
    first = F.try_element_at(messages, F.lit(1))
    has_system = F.coalesce(first["role"] == "system", F.lit(False))
    rest = F.when(
        has_system, F.slice(messages, F.lit(2), F.greatest(F.size(messages) - 1, F.lit(0)))
    ).otherwise(messages)
    contents = F.transform(
        rest,
        lambda m: F.struct(
            F.when(m["role"] == "assistant", F.lit("model"))
            .otherwise(F.lit("user"))
            .alias("role"),
            parts(m["content"]).alias("parts"),
        ),
    )
    return F.to_json(
        F.struct(
            F.when(
                has_system, F.struct(parts(first["content"]).alias("parts"))
            ).alias("systemInstruction"),
            contents.alias("contents"),
            F.struct(
                F.lit(float(temperature)).alias("temperature"),
                F.lit(int(max_tokens)).alias("maxOutputTokens"),
            ).alias("generationConfig"),
            *([_safety(safety).alias("safetySettings")] if safety else []),
        )
    )


def _safety(settings: list[tuple[str, str]]) -> Column:
    return F.array(*[F.struct(F.lit(c).alias("category"), F.lit(t).alias("threshold")) for c, t in settings])


_CHAT_REPLY = (
    "choices array<struct<message:struct<content:string>>>, usage map<string,bigint>"
)
_PARTS_REPLY = (
    "candidates array<struct<content:struct<parts:array<struct<text:string>>>>>, "
    "usageMetadata map<string,bigint>"
)


def chat_reply(body: Column) -> Column:
    """STRUCT<answer, usage, error> from a reply with choices."""
    data = F.from_json(body, _CHAT_REPLY)
    first = F.try_element_at(data["choices"], F.lit(1))
    return F.struct(
        F.when(
            F.size(data["choices"]) > 0,
            F.coalesce(first["message"]["content"], F.lit("")),
        ).alias("answer"),
        data["usage"].alias("usage"),
        F.when(
            F.coalesce(F.size(data["choices"]) > 0, F.lit(False)),
            F.lit(None).cast("string"),
        )
        .otherwise(F.lit("no choices"))
        .alias("error"),
    )


def parts_reply(body: Column) -> Column:
    """STRUCT<answer, usage, error> from a reply with candidates and parts."""
    data = F.from_json(body, _PARTS_REPLY)
    parts = F.try_element_at(data["candidates"], F.lit(1))["content"]["parts"]
    text = F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")
    answer = F.nullif(text, F.lit(""))
    return F.struct(
        answer.alias("answer"),
        data["usageMetadata"].alias("usage"),
        F.when(F.coalesce(F.size(data["candidates"]), F.lit(0)) <= 0, F.lit("no candidates"))
        .when(answer.isNull(), F.lit("no text parts"))
        .alias("error"),
    )


def failure_context(
    uid: Column,
    category: Column,
    model: Column,
    baseline: Column,
    judge: Column,
    tag: str = "judge-error",
) -> Column:
    return F.format_string(
        f"[{tag}] uid=%s category=%s model=%s baseline=%s judge=%s",
        uid,
        category,
        model,
        baseline,
        judge,
    )


def repair_failure(uid: Column, round_label: Column, analysis: Column, reply: Column) -> Column:
    """Error text for a verdict that the repair request could not recover."""
    return F.format_string(
        "Judge verdict could not be repaired for uid=%s round=%s "
        "analysis_excerpt=%s repair_excerpt=%s",
        uid,
        round_label,
        preview(analysis),
        preview(reply),
    )


def interval_text(score: Column, lower: Column, upper: Column) -> Column:
    """``(-x / +y)`` in percent with one decimal."""
    return F.format_string(
        "(-%.1f / +%.1f)",
        F.round((score - lower) * 100, 1),
        F.round((upper - score) * 100, 1),
    )


def percent(score: Column) -> Column:
    return F.round(score * 100, 1)
