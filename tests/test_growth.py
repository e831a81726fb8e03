"""Steps that must not gather, move twice or repeat their texts as the input grows."""

import os
import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from duelboard.functions import style as S
from duelboard.functions.text import word_count
from duelboard.operators import keyed
from duelboard.operators import multiway as M
from duelboard.operators import requests as Q
from duelboard.plans.calls import ask_once
from duelboard.session import bound_batches
from duelboard.sources import readers as R
from duelboard.sources import writers as W
from duelboard.sources.readers import resolve_answers
from duelboard.streaming import keyed_state


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def unbroadcast(spark):
    return spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


ANSWERS = [("f1", "m", "a", 1, "x"), ("f2", "m", "a", 1, "y"), ("f2", "m", "a", 3, "z"), ("f2", "m", None, 4, "n"), ("f3", "o", "a", 1, "w"), ("f3", "o", "b", 2, "v"), ("f3", "o", "b", 2, "v")]


def answers(spark):
    return spark.createDataFrame(ANSWERS, "file_name string, model string, uid string, ord bigint, answer string")


def test_answers_of_a_file_do_not_meet_in_one_task(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    unbroadcast(spark)
    try:
        resolved = resolve_answers(answers(spark))
        _, plan = plan_of(resolved)
        assert "SortMergeJoin [file_name" not in plan and "BroadcastHashJoin [file_name" in plan
        settings = spark.createDataFrame([("c", "o")], "category string, baseline string")
        pending = spark.createDataFrame([("a", "c")], "uid string, category string").join(F.broadcast(settings), "category")
        _, paired = plan_of(Q.with_answers(pending, resolved, "m", ["o"]))
        texts = [line for line in paired.splitlines() if "Exchange hashpartitioning" in line and "answer" in line]
        assert not any("baseline" in line.split("hashpartitioning")[1].split(")")[0] for line in texts)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    rows = sorted((r["model"], r["uid"], r["answer"], r["first_file"]) for r in resolved.collect())
    assert rows == [("m", "a", "z", "f1"), ("o", "a", "w", "f3"), ("o", "b", "v", "f3"), ("o", "b", "v", "f3")]


def shuffled_columns(df):
    """What each exchange of a plan is given."""
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return re.findall(r"\) Exchange\nInput \[\d+\]: \[(.*)\]", text)


def test_stored_answers_are_not_shuffled_to_pick_them(spark, tmp_path):
    found = E.queries()["s3_answers_directory"](spark, "/root/testdata/sf0.001")
    assert not any("answer#" in columns for columns in shuffled_columns(found))

    odd = [("f4", None, "a", None, "r"), ("f4", "p", "a", 2, "s"), ("f4", None, "b", None, "t"), ("f4", "q", "b", None, "u"), ("f4", "p", None, 9, "o")]
    rows = spark.createDataFrame(ANSWERS + odd, answers(spark).schema).repartition(3, "answer")
    held = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    for open_files in (0, 1, 9):
        path = tmp_path / f"files{open_files}"
        W.write_jsonl(W.with_places(rows), str(path), ["file_name"], "zstd", open_files)
        assert {p.suffix for p in path.glob("*/part-*")} == {".zstd"}
        read = R.read_jsonl(spark, str(path), "model string, uid string, ord bigint, answer string, place bigint, file_name string")
        columns = ["file_name", "first_file", "model", "uid", "ord", "answer"]
        want = resolve_answers(rows).select(columns)
        got = resolve_answers(read, "place").select(columns)
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        assert any("answer#" in x for x in shuffled_columns(want)) and not any("answer#" in x for x in shuffled_columns(got))
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == held


def test_marks_of_replaced_places(spark):
    """Places in several tasks, words and runs, at both ends of each."""
    rows = spark.range(30_000).selectExpr("id", "id % 7001 k", "(id % 3 << 33) + id div 3 place", "if(id % 11 = 0, null, id div 7001 % 3) ord")
    marks = keyed.replaced_places(rows, ["k"], "place")
    assert marks.select(F.max(F.size("words")), F.min(F.size("words"))).first() == (64, 64)
    kept = {r["id"] for r in keyed.unless_marked(rows, marks, "place").collect()}
    last = {}
    for r in rows.collect():
        last[r["k"]] = max(last.get(r["k"], -1), -1 if r["ord"] is None else r["ord"])
    assert kept == {r["id"] for r in rows.collect() if (-1 if r["ord"] is None else r["ord"]) == last[r["k"]]}
    places = spark.createDataFrame([(p,) for p in (0, 63, 64, 4095, 4096, 4159, (1 << 33) + 63)], "place bigint")
    one = spark.createDataFrame([(p, 1, o) for p in (63, 4095, 4096) for o in (1,)] + [((1 << 33) + 63, 1, 1), (0, 1, 2)], "place bigint, k int, ord int")
    assert {r["place"] for r in keyed.unless_marked(places, keyed.replaced_places(one, ["k"], "place"), "place").collect()} == {0, 64, 4159}


def test_frequent_keys_send_their_picked_rows_only(spark, monkeypatch):
    monkeypatch.setattr(keyed, "HOT_ROWS", 2)
    rows = spark.createDataFrame([("h", i, i) for i in range(50)] + [("c", i, i) for i in range(2)] + [(None, 7, 7)] * 3, "k string, ord bigint, v bigint")
    picked = rows.groupBy("k").agg(F.min("ord").alias("ord"), F.count("*").alias("n"))
    monkeypatch.setattr(keyed, "HOT_SHARE", 20)
    left = sorted(((r["k"] or ""), r["v"]) for r in keyed.settle_frequent(rows, picked, ["k"]).collect())
    assert left == [("", 7)] * 3 + [("c", 0), ("c", 1), ("h", 0)]


def test_common_instructions_move_each_text_once(spark, monkeypatch):
    names = ["p", "q", "r"]
    data = [(n, f"i{k}", f"{n}{k}-{o}", o) for k in range(4) for n in names for o in (2, 1)]
    data += [("p", "i1", "twice", 1), ("p", "gap", "x", 1), ("q", "gap", "x", None), ("r", "gap", "x", 1)]
    df = spark.createDataFrame(data, "name string, instruction string, output string, ord bigint")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    unbroadcast(spark)
    try:
        _, plan = plan_of(M.unseen(M.common_instructions(df, names), df.where("false")))
        dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert not any("ord" in line.split("hashpartitioning")[1].split(")")[0] for line in dealt)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
    for hot in (1_000, 1):
        monkeypatch.setattr(keyed, "HOT_ROWS", hot)
        got = sorted((r["instruction"], *(o["output"] for o in r["outputs"])) for r in M.common_instructions(df, names).collect())
        assert got == sorted([(f"i{k}", f"p{k}-1", f"q{k}-1", f"r{k}-1") for k in range(4)] + [("i1", "twice", "q1-1", "r1-1")])


def test_a_fresh_log_builds_each_request_once(spark, tmp_path):
    seen = tmp_path / "built"

    def make():
        return lambda pdf: ["ok"] * len(pdf)

    def build(batches):
        for pdf in batches:
            with open(seen, "a") as f:
                f.write("x" * len(pdf))
            yield pdf

    requests = spark.range(40).selectExpr("id", "cast(id as string) messages").mapInPandas(build, "id bigint, messages string")
    log = str(tmp_path / "log")
    assert ask_once(requests, make, log, ["id"]).where("reply = 'ok'").count() == 40
    assert os.path.getsize(seen) == 40
    assert ask_once(requests, make, log, ["id"]).where("reply = 'ok'").count() == 40
    assert os.path.getsize(seen) == 80


def test_batches_for_python_are_small(spark):
    bound_batches(spark)
    sizes = spark.range(0, 20_000, 1, 1).selectExpr("id", "repeat('x', 2000) t").mapInPandas(
        lambda it: (p.groupby(p.id * 0).agg(n=("t", "size")) for p in it), "n bigint"
    )
    assert sizes.agg(F.max("n")).first()[0] <= 4_000 and sizes.agg(F.sum("n")).first()[0] == 20_000


def test_counted_words_are_the_words(spark):
    spaces = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"
    texts = ["", " ", None, "a", " a  b\n", "слово ​ x᠎y", *[f"a{c}b{c}{c}c" for c in spaces]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~word_count(F.col("t")).cast("bigint").eqNullSafe(S.counted_words()(F.col("t")))).count() == 0


def test_streams_keep_keys_in_native_state(spark):
    rows = spark.createDataFrame([("a", None, False, 1), ("a", 2, False, 2), ("b", 5, False, 2), ("b", 4, False, 2), ("c", 1, True, 2)], "k string, ord int, _stored boolean, _arrival int")
    got = {r["_key_k"]: (r["best"]["ord"], r["since"] == r["until"], r["stored"]) for r in keyed_state.best_rows(rows, ["k"], "ord", True).collect()}
    assert got == {"a": (2, False, False), "b": (5, True, False), "c": (1, True, True)}


def test_chances_cover_the_baselines(spark):
    from duelboard.catalog import load_catalog

    sql = load_catalog()[1]["a9_win_probability"]
    assert "both_sides" in sql and "select distinct category, baseline" in sql and "chance" in sql


def test_failed_calls_do_not_keep_their_texts(spark):
    from duelboard.operators.replies import call_judge

    def make():
        class Told(RuntimeError):
            pass

        def reply(pdf):
            if len(pdf) > 1:
                raise RuntimeError("batch")
            error = Told("row")
            raise error

        return reply

    rows = call_judge(spark.range(6).selectExpr("id", "'t' messages"), make, ["id", "messages"]).collect()
    assert {r["error"] for r in rows} == {"Told: row"} and len(rows) == 6 and all(r["reply"] is None for r in rows)
