"""The pipeline on a small fixture and the guard of the driver contract."""

import random

import corpus_pipeline
from duelboard.llm.queries import QUERIES

from test_text_operators import sentence  # noqa: E402


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    rng = random.Random(7)
    bad = ["grobble", "snark", "vilex", "dropal"]
    rows, labels = [], []
    for i in range(400):
        words = sentence(rng, 80).split()
        if i % 8 == 0:
            for _ in range(5):
                words[rng.randrange(80)] = rng.choice(bad)
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(i % 8 == 0)))
    item = sentence(rng, 30)
    rows += [(1000, rows[1][1], "en", "s", 0), (1001, rows[2][1] + " tail", "en", "s", 0), (1002, rows[3][1] + " " + item, "en", "s", 0)]
    rows += [(1003, "call +1 (988) 555-2485 " + sentence(rng, 40), "en", "s", 0), (1004, None, "en", "s", None), (1005, "", "en", "s", 0)]
    write = lambda data, schema, name: spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    write(rows, "doc_id long, text string, lang string, source string, n_chars long", "documents")
    write(labels, "doc_id long, quality int, toxic int", "labels")
    write([(1, item)], "item_id long, text string", "benchmark")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == columns, name
        docs.write.parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    toxic_left = [i for i in range(0, 400, 8) if i in seen["toxicity"]]
    assert len(toxic_left) <= 2 and len(seen["toxicity"]) >= 345
    assert 1000 not in seen["near_dedup"] and 1001 not in seen["near_dedup"] and 1 in seen["near_dedup"]
    assert 1002 not in seen["decontamination"] and {1004, 1005} <= set(seen["decontamination"])
    assert "555-2485" not in seen["pii"][1003] and set(seen["pii"]) == set(seen["decontamination"])
    out = {r["doc_id"]: r for r in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()}
    assert set(out) == set(seen["pii"]) and out[1004]["n_tokens"] == 0
    assert set(r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == set(out)


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
