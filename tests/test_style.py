import random
import re

from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions import style as S

SAMPLES = [
    "", "# a\r# b", "#\n# z", "## x\n### y\n####### no\n # no", "- a\n  * b\n+c\n+ d\n\n\n1. x\n 22. y\n3.z",
    "-\n- x", "- a\n-", "**b** __c__ ** no\n** **d*e**", "a ```x``` b x\n```py\n# h\n``` c", "```# a```\n# a\n# b",
    "\n\n  \n- item", "1.\n2. x", "#\x85x\n# y", "　- wide\n　٣. digit",
]


def expected(text):
    cleaned = text
    for body in re.findall(K.FENCE_PATTERN, text):
        cleaned = cleaned.replace(body, "")
    count = lambda p: len(re.findall(p, cleaned, re.MULTILINE))
    headers = [count("^" + "#" * n + r"\s") for n in range(1, 7)]
    lists = [count(r"^\s*\d+\.\s"), count(r"^\s*[-*+]\s")]
    bolds = [count(K.BOLD_STAR_PATTERN), count(K.BOLD_UNDERSCORE_PATTERN)]
    return [len(text.split()), headers, lists, bolds]


def flat(row):
    return [
        row["token_len"],
        [row["header_count"][f"h{n}"] for n in range(1, 7)],
        [row["list_count"]["ordered"], row["list_count"]["unordered"]],
        [row["bold_count"]["**"], row["bold_count"]["__"]],
    ]


def random_texts(n=300):
    rng = random.Random(3)
    alphabet = ["#", "##", " ", "\n", "- ", "1.", "* ", "**", "__", "x", "```", "\n\n", "+", "\t"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_metadata_matches_the_line_patterns(evaluate):
    texts = SAMPLES + random_texts()
    got = [flat(r) for r in evaluate(S.style_metadata, texts)]
    want = [expected(t) for t in texts]
    assert [(t, g) for t, g, w in zip(texts, got, want) if g != w] == []


def test_feature_vector_equals_metadata_totals(evaluate):
    texts = SAMPLES + random_texts(100)
    direct = evaluate(S.feature_vector, texts)
    stored = evaluate(lambda c: S.metadata_features(S.style_metadata(c)), texts)
    assert direct == stored


def test_missing_metadata_counts_as_zero(spark):
    kind = (
        "m struct<token_len:bigint,header_count:map<string,bigint>,"
        "list_count:map<string,bigint>,bold_count:map<string,bigint>>"
    )
    rows = [((None, None, {}, {"**": 2, "__": None}),), ((10, {"h1": 1}, {"ordered": 0, "unordered": 1}, {}),)]
    df = spark.createDataFrame(rows, kind).select(S.metadata_features(F.col("m")).alias("f")).select("f.*")
    assert [tuple(r) for r in df.collect()] == [(0.0, 0.0, 0.0, 2.0), (10.0, 1.0, 1.0, 0.0)]


def test_style_difference(spark):
    kind = "a struct<length:double,headers:double,lists:double,bolds:double>"
    df = spark.createDataFrame([((9.0, 1.0, 0.0, 2.0), (4.0, 0.0, 1.0, 1.0))], f"{kind}, {kind.replace('a s', 'b s')}")
    d = df.select(S.style_difference(F.col("a"), F.col("b")).alias("d")).first()["d"]
    assert abs(d["length"] - 5 / 13) < 1e-12
    assert abs(d["headers"] - 0.1 / 1.1) < 1e-12
    assert abs(d["lists"] + 0.2 / 1.2) < 1e-12
    assert abs(d["bolds"] - 0.0) < 1e-12
