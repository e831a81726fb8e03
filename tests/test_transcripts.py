import random
import re

from duelboard.functions import transcripts as TR


def parse(text):
    """Brute-force parser by scanning for tags."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    if not re.match(r"\n\n(Human|Assistant):", text):
        text = "\n\n" + text
    parts = re.split(r"\n\n(Human|Assistant): ?", text)
    turns = zip(parts[1::2], parts[2::2])
    return [("user" if r == "Human" else "assistant", c.strip()) for r, c in turns if c.strip()]


CASES = [
    "Human: hi\n\nAssistant: yo", "intro\n\nHuman: hi", "\n\nHuman:\n\nAssistant: z", "", "no tags",
    "\r\n\r\nHuman: a\r\rAssistant: b", "\n\nHuman: a\n\n\nAssistant:b\n\nHuman:   ", "\n\nHuman: x Human: y",
    "\n\n\n\nHuman: deep", "\n\nAssistant: one\n\nAssistant: two", "Human: Assistant: x",
]


def as_pairs(rows):
    return [[(m["role"], m["content"]) for m in r] for r in rows]


def test_parse(evaluate):
    rng = random.Random(1)
    bits = ["\n", "\n\n", "Human:", "Assistant:", " ", "x", "\r", "yo "]
    texts = CASES + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(400)]
    got = as_pairs(evaluate(TR.parse_transcript, texts))
    assert [(t, g) for t, g in zip(texts, got) if g != parse(t)] == []


def test_render(evaluate):
    kind = TR.MESSAGES_TYPE
    values = [[], [("user", "a"), ("assistant", "b"), ("system", "c")], [("user", " ")]]
    assert evaluate(TR.render_prompt, values, kind) == [
        "Assistant:",
        "Human: a\n\nAssistant: b\n\nAssistant: c\n\nAssistant:",
        "Human:\n\nAssistant:",
    ]


def test_examples(evaluate):
    kind = TR.MESSAGES_TYPE
    values = [
        [("user", "q"), ("assistant", "a")],
        [("user", "q"), ("assistant", "a"), ("user", "r"), ("assistant", "b")],
        [("assistant", "q"), ("assistant", "a")],
        [("user", "q")],
        [],
    ]
    single = evaluate(lambda c: TR.prompt_example(c, True), values, kind)
    multi = evaluate(lambda c: TR.prompt_example(c, False), values, kind)
    assert [s and (s["instruction"], s["output"]) for s in single] == [("q", "a"), None, None, None, None]
    assert multi[1]["instruction"] == "Human: q\n\nAssistant: a\n\nHuman: r\n\nAssistant:"
    assert [m is not None for m in multi] == [True, True, False, False, False]
    split = evaluate(TR.prompt_and_reference, values, kind)
    assert [s["reference"] for s in split] == ["a", "b", "a", None, None]
    assert [s["prompt_messages"] and len(s["prompt_messages"]) for s in split] == [1, 3, None, 1, None]


def test_raw_tags(evaluate):
    values = [[("user", "Human: x")], [("user", "a\n\nAssistant: b")], [("user", "a Human: b")]]
    assert evaluate(TR.has_raw_tags, values, TR.MESSAGES_TYPE) == [True, True, False]
