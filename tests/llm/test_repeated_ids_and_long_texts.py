"""Repeated ids, clashing column names and long texts without spaces."""

import random
import time

import pytest
from pyspark.sql import functions as F

from duelboard.llm import bagminhash, chunk_bpe, pu_toxicity
from duelboard.llm.queries import vocabulary_path


def test_an_id_of_many_texts_sends_each_once(spark):
    rows = [(7, f"one id on many texts {i % 3_000}") for i in range(10_000)] + [(7, "the same row again")] * 3_000
    rows += [(i, f"text {i} of its own") for i in range(100, 160)]
    labels = spark.createDataFrame([(7, 1), (101, 0), (102, 1)], "doc_id long, toxic int")
    drawn = []
    for parts in (2, 7):
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
        toxic, free, prior = pu_toxicity.training_sample(docs, labels, 500, 800)
        assert len(toxic) <= 500 and len(free) <= 800 and 0 < prior < 1
        drawn.append(([a.tolist() for a in toxic], [a.tolist() for a in free]))
    assert drawn[0] == drawn[1]  # whatever the partitions


def test_names_that_the_join_uses(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text), (2, text + " more"), (3, "other words here"), (3, "other words here"), (None, "no id")]
    names = ["kept_id", "kept_node", "kept_check", "copies", "text_key", "_text_key", "n"]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.select("*", *[F.lit(name).alias(name) for name in names])
    kept = bagminhash.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, "no id"), (1, text), (3, "other words here")]
    assert all(r[name] == name for r in got for name in names)


@pytest.fixture(scope="module")
def encoder():
    return chunk_bpe.ChunkEncoder(vocabulary_path())


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import tokenizers

    out = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out.no_truncation()
    out.no_padding()
    return out


@pytest.mark.parametrize("marks", ["", "，。、！12"])
def test_a_million_signs_without_a_space(encoder, library, marks):
    rng = random.Random(1)
    text = "".join(rng.choice(marks) if marks and rng.random() < 0.05 else chr(rng.randrange(0x4E00, 0x9FA0)) for _ in range(1_000_000))
    start = time.process_time()
    encoder.encode(text[:100_000])
    short = time.process_time() - start
    start = time.process_time()
    ids = encoder.encode(text)
    assert time.process_time() - start < 40 * max(short, 0.05)  # ten times the text: about ten times the time
    assert ids == library.encode(text, add_special_tokens=False).ids


def test_safe_places_of_odd_texts(encoder, library):
    rng = random.Random(2)
    signs = ["a", "b", "'s", "'ll", "1", "²", "½", " ", "  ", "\n", "\t", ".", ",", "!?", "漢", "字", "、", "。", "ー", "・", "カ", "가", "é", "_", "-", "　", "'", "́", "Ⅷ", "९", "ع", "😀", "(", ")"]
    for _ in range(600):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(1_500)))
        assert encoder.encode(text) == library.encode(text, add_special_tokens=False).ids
