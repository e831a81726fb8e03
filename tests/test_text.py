import random
import re

import pytest

from duelboard import constants as K
from duelboard.functions import text as T

SAMPLES = [
    "", " ", "\n\t", "plain", "  two  words ", "a b　c", "\x1cx\x1f", "é\xa0ü", "tab\tand\nline\r\nend",
    "x" * 600, "word " * 80,
]


def test_strip_matches_python(evaluate):
    assert evaluate(T.strip, SAMPLES) == [s.strip() for s in SAMPLES]


def test_word_count_matches_python(evaluate):
    assert evaluate(T.word_count, SAMPLES) == [len(s.split()) for s in SAMPLES]


def test_preview_and_summary(evaluate):
    compact = [" ".join(s.split()) for s in SAMPLES]
    assert evaluate(T.preview, SAMPLES) == [c if len(c) <= 240 else c[:237] + "..." for c in compact]
    assert evaluate(T.summarize, SAMPLES) == [s if len(s) <= 512 else s[:512] + "..." for s in SAMPLES]


def test_names(evaluate):
    assert evaluate(T.short_model_name, ["a/b/c", "c", "x/"]) == ["c", "c", ""]
    assert evaluate(T.safe_name, ["a/b c", "--", " é ", "ok_1.2-x"]) == ["a-b-c", "benchmark", "benchmark", "ok_1.2-x"]


def test_cut_at_stop(evaluate):
    texts = ["hi\n\nHuman: x", "no stop ", "\n\nHuman: all", "a\n\nHuman: b\n\nHuman: c"]
    assert evaluate(T.cut_at_stop, texts) == ["hi", "no stop", "", "a"]
    assert evaluate(lambda c: T.cut_at_stop(c, ("B", "A")), ["xAyB"]) == ["x"]
    assert evaluate(lambda c: T.cut_at_stop(c, ()), [" x "]) == ["x"]


def test_effectively_empty_edges(evaluate):
    values = ["<|eot_id|>", "text\\", None, " ", "a", "> >"]
    fixed = evaluate(T.effectively_empty, values)
    reference = evaluate(lambda c: T.effectively_empty(c, mode="reference"), values)
    assert fixed == [True, False, True, True, False, False]
    assert reference == [False, True, True, True, False, True]
    escaped = evaluate(lambda c: T.effectively_empty(c, drop_escapes=True), ["\\n\\t", "\r\n\\r <|x|>", "n"])
    assert escaped == [True, True, False]


def test_reference_mode_equals_the_plain_pattern(evaluate):
    rng = random.Random(5)
    values = ["".join(rng.choice("<>\\|a ") for _ in range(rng.randint(0, 12))) for _ in range(400)]
    pattern = re.compile(K.SPECIAL_TOKEN_LITERAL)
    want = [not pattern.sub("", v.strip()).strip() for v in values]
    assert evaluate(lambda c: T.effectively_empty(c, mode="reference"), values) == want


def test_seed_from_key(evaluate):
    import hashlib

    keys = ["instr", "é", ""]
    want = [int.from_bytes(hashlib.sha256(f"7-{k}".encode()).digest()[:8], "big") for k in keys]
    assert [int(x) for x in evaluate(lambda c: T.seed_from_key(c, 7), keys)] == want


def test_mode_is_validated():
    from pyspark.sql import functions as F

    with pytest.raises(ValueError):
        T.effectively_empty(F.lit("x"), mode="other")
