import json

import pytest
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard import schemas
from duelboard.sources import readers as R
from duelboard.sources import writers as W


def write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows))


def test_line_separator_inside_a_string_is_one_row(spark, tmp_path):
    write(tmp_path / "q.jsonl", [{"uid": "q1", "prompt": "before\u2028after"}, "", {"uid": "q2", "prompt": "x"}])
    rows = R.read_jsonl(spark, str(tmp_path / "q.jsonl"), schemas.QUESTION).orderBy("uid").collect()
    assert [r["prompt"] for r in rows] == ["before\u2028after", "x"]


def test_bad_lines(spark, tmp_path):
    path = tmp_path / "bad.jsonl"
    write(path, [{"uid": "1"}, '{"uid": ', {"uid": "2"}])
    with pytest.raises(Exception):
        R.read_jsonl(spark, str(path), "uid string").collect()
    assert {r["uid"] for r in R.read_jsonl_tolerant(spark, str(path), "uid string").collect()} == {"1", "2"}
    rejects = R.read_jsonl_with_rejects(spark, str(path), "uid string").where("_corrupt is not null").collect()
    assert [r["file_name"] for r in rejects] == ["bad.jsonl"]


def test_answers_directory(spark, tmp_path):
    d = tmp_path / "answers"
    write(d / "a.jsonl", [{"uid": "1", "model": "m"}, {"uid": "2", "model": "other"}])
    write(d / "b.jsonl", [{"uid": "1"}, {"uid": "1", "ans_id": "last"}])
    write(d / "c.jsonl", [{"uid": "3", "model": "m"}, {"model": "m"}])
    rows = R.read_answers(spark, str(d)).orderBy("model", "uid").collect()
    assert [(r["model"], r["uid"], r["ans_id"], r["first_file"]) for r in rows] == [
        ("b", "1", "last", "b.jsonl"), ("m", "3", None, "a.jsonl"),
    ]
    assert R.read_answers(spark, str(tmp_path / "none")).count() == 0


def test_keyed_rows(spark, tmp_path):
    write(tmp_path / "k.jsonl", [{"uid": "1", "v": 1}, {"v": 9}, {"uid": "1", "v": 2}, {"uid": "2", "v": 3}])
    rows = R.read_keyed(spark, str(tmp_path / "k.jsonl"), "uid string, v int", "uid").orderBy("uid").collect()
    assert [tuple(r) for r in rows] == [("1", 2), ("2", 3)]
    assert R.read_keyed(spark, str(tmp_path / "no.jsonl"), "uid string, v int", "uid").count() == 0


def test_output_arrays_keep_the_first_row(spark, tmp_path):
    rows = [{"instruction": "i", "output": "one"}, {"instruction": "i", "output": "two"},
            {"instruction": "", "output": "x"}, {"instruction": "j", "output": None}, {"instruction": "k", "output": ""}]
    (tmp_path / "o.json").write_text(json.dumps(rows))
    got = R.read_json_outputs(spark, str(tmp_path / "o.json"), "sft").orderBy("instruction").collect()
    assert [(r["instruction"], r["output"], r["name"]) for r in got] == [("i", "one", "sft"), ("k", "", "sft")]


def test_questions(spark, tmp_path):
    rows = [{"uid": None, "prompt": "x"}, {"uid": "1", "prompt": " \n"}, {"uid": "2", "prompt": "p", "category": "c"},
            {"uid": "3", "prompt": "q"}]
    write(tmp_path / "q.jsonl", rows)
    got = R.read_questions(spark, str(tmp_path / "q.jsonl")).collect()
    assert sorted((r["uid"], r["category"]) for r in got) == [("2", "c"), ("3", None)]
    assert [r["uid"] for r in R.read_questions(spark, str(tmp_path / "q.jsonl"), 1).collect()] == ["2"]
    legacy = R.normalize_legacy_questions(R.with_input_order(R.read_jsonl(spark, str(tmp_path / "q.jsonl"), schemas.QUESTION)))
    assert {r["uid"]: r["category"] for r in legacy.collect()} == {"2": "c", "3": K.LEGACY_CATEGORY}
    write(tmp_path / "empty.jsonl", [{"uid": "1", "prompt": ""}])
    with pytest.raises(ValueError):
        R.read_questions(spark, str(tmp_path / "empty.jsonl"))


def test_judgments_prune_other_judges(spark, tmp_path):
    rows = spark.createDataFrame(
        [("1", "j1", "m"), ("2", "j2", "m"), ("1", "j1", "m")], "uid string, judge string, model string"
    )
    W.write_jsonl(rows, str(tmp_path / "out"), ["judge"])
    found = R.read_judgments(spark, str(tmp_path / "out"), ["j1", "nobody"])
    assert [r["uid"] for r in found.collect()] == ["1", "1"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan or "judge" in plan.split("PartitionFilters:")[1][:80]


def test_array_export_is_valid_json(spark, tmp_path):
    W.export_json_array(spark.range(5).repartition(2), str(tmp_path / "arr"))
    parts = [json.loads(p.read_text()) for p in (tmp_path / "arr").glob("part-*")]
    assert sorted(row["id"] for part in parts for row in part) == [0, 1, 2, 3, 4]


def test_dialogue_text_falls_back(spark):
    df = spark.createDataFrame(
        [("a", "b", "c"), ("", "b", "c"), (None, "", "c"), (None, None, None)], "chosen string, prompt string, text string"
    )
    assert [r[0] for r in df.select(R.dialogue_text()).collect()] == ["a", "b", "c", None]


def test_generation_log_cap(spark):
    df = spark.createDataFrame([(i, ["x", " " if i % 2 else "y"]) for i in range(6)], "prompt_id int, responses array<string>")
    assert [r["prompt_id"] for r in W.generation_log(df).orderBy("prompt_id").collect()] == [1, 3, 5]
    assert W.generation_log(df, log_all=True, limit=4).count() == 4
    assert W.generation_log(df).select(F.max(F.size("empty_indices"))).first()[0] == 1
    logged = W.generation_log(df.withColumn("prompt_text", F.lit("p")))
    assert logged.columns == ["prompt_id", "prompt_messages", "prompt_text", "raw_responses", "cleaned_responses", "empty_indices"]
