import random

import pytest
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.functions import prompts as PR
from duelboard.operators import multiway as M
from duelboard.operators import pairs as P
from duelboard.operators import replies as R
from duelboard.operators import requests as Q
from duelboard.operators import tally as TA
from duelboard.operators import turns as TN
from duelboard.operators.leaderboard import baselines
from duelboard.plans import comparison, judging, preference
from duelboard.schemas import JUDGMENT_RECORD
from duelboard.sources.readers import read_jsonl
from duelboard.sources.writers import write_jsonl

JUDGED = "uid string, category string, judge string, model string, baseline string, games array<struct<score:string>>"


def setup(spark):
    questions = spark.createDataFrame(
        [(str(i), f"ask {{ANSWER_A}} {i}", "math" if i % 2 else "creative_writing", i) for i in range(6)],
        "uid string, prompt string, category string, ord bigint",
    )
    models = ["org/m", "o3-mini-2025-01-31", "gemini-2.0-flash-001"]
    answers = spark.createDataFrame(
        [(str(i), m, f"{m} answers {i}") for i in range(6) for m in models], "uid string, model string, answer string"
    )
    return questions, answers, baselines(spark)


def stored(spark, rows):
    return spark.createDataFrame(rows, JUDGED)


def test_two_games_are_judged_repaired_and_merged(spark, tmp_path):
    questions, answers, settings = setup(spark)
    old = stored(spark, [("0", "math", "j", "org/m", "b", [("A>B",), ("A>B",)]), ("1", "math", "j", "org/m", "b", [("A>B",), (None,)])])
    games = judging.pending_games(questions, answers, old, "org/m", settings)
    assert games.count() == 10  # question 0 is complete, question 1 is not

    def make_reply():
        return lambda pdf: ["[[A>B]]" if "1" != u else "no label" for u in pdf["uid"]]

    def make_repair():
        return lambda pdf: ["[A=B]" for _ in range(len(pdf))]

    scored = judging.judge_games(games, make_reply, str(tmp_path / "store"), make_repair)
    merged = judging.merge_judgments(old, scored, "j", "org/m")
    rows = {r["uid"]: [g["score"] for g in r["games"]] for r in merged.collect()}
    assert rows["0"] == ["A>B", "A>B"] and rows["1"] == ["A=B", "A=B"] and len(rows) == 6
    prompt = Q.judge_requests(games).where("uid = '3' and game_no = 2").first()["messages"][1]["content"]
    assert prompt == (
        "<|User Prompt|>\nask {ANSWER_A} 3\n\n<|The Start of Assistant A's Answer|>\norg/m answers 3\n"
        "<|The End of Assistant A's Answer|>\n\n<|The Start of Assistant B's Answer|>\n"
        "o3-mini-2025-01-31 answers 3\n<|The End of Assistant B's Answer|>"
    )


def test_judge_target(spark, tmp_path):
    questions, answers, settings = setup(spark)
    reply = lambda: (lambda pdf: ["[[B>A]]" if u != "4" else "?" for u in pdf["uid"]])
    rows, failed = judging.judge_target(
        questions, answers, stored(spark, []), "org/m", "j", settings, reply, str(tmp_path / "a")
    )
    assert [r["uid"] for r in rows.collect()] == ["0", "1", "2", "3", "5"]
    assert failed.count() == 2
    with pytest.raises(ValueError, match="gemini"):
        judging.judge_target(
            questions, answers.where("model not like 'gemini%'"), stored(spark, []), "org/m", "j", settings, reply, str(tmp_path / "b")
        )
    only = questions.where("category = 'math'")
    own, none = judging.judge_target(
        only, answers, stored(spark, []), "o3-mini-2025-01-31", "j", settings, reply, str(tmp_path / "c")
    )
    assert own.count() == 0 and none.count() == 0


def test_legacy_settings(spark):
    settings = baselines(spark, K.LEGACY_CATEGORY_SETTINGS)
    df = spark.createDataFrame([("1", "p", K.LEGACY_CATEGORY, 0)], "uid string, prompt string, category string, ord bigint")
    assert Q.with_settings(df, settings).first()["baseline"] == "gpt-4-0314"


def test_failed_calls_become_error_rows(spark):
    requests = spark.createDataFrame([(str(i),) for i in range(5)], "uid string")

    def make_reply():
        def reply(pdf):
            if (pdf["uid"] == "3").any():
                raise ValueError("down")
            return ["[[A=B]]"] * len(pdf)

        return reply

    rows = {r["uid"]: (r["reply"], r["error"]) for r in R.call_judge(requests, make_reply, ["uid"]).collect()}
    assert rows["3"] == (None, "ValueError: down") and rows["0"] == ("[[A=B]]", None)


def test_only_failed_rows_are_sent_again(spark, tmp_path):
    requests = spark.range(20).selectExpr("cast(id as string) uid").coalesce(1)
    seen = str(tmp_path / "seen")

    def make_reply():
        def answer(row):
            with open(seen, "a") as out:
                out.write(row["uid"] + "\n")
            if row["uid"] in ("3", "7"):
                raise ValueError("down")
            return "ok"

        return R.one_by_one(answer)

    rows = R.call_judge(requests, make_reply, ["uid"], again=2).collect()
    assert {r["uid"]: r["error"] for r in rows if r["error"]} == {"3": "ValueError: down", "7": "ValueError: down"}
    sent = open(seen).read().split()
    assert sorted(sent) == sorted([str(i) for i in range(20)] + ["3", "7"] * 2)


def test_a_stopped_run_is_continued(spark, tmp_path):
    """A run that dies after its first stored replies asks, started again, only for the others."""
    questions, answers, settings = setup(spark)
    games = judging.pending_games(questions, answers, stored(spark, []), "org/m", settings)
    store, seen, stop = str(tmp_path / "store"), tmp_path / "seen", tmp_path / "stop"
    stop.write_text("")

    def make_reply():
        def reply(pdf):
            if stop.exists() and seen.exists():
                raise SystemExit  # not an error of a call: the task dies
            with open(seen, "a") as out:
                out.write("".join(f"{u}/{g}\n" for u, g in zip(pdf["uid"], pdf["game_no"])))
            return ["[[A>B]]" if u != "1" else "no label" for u in pdf["uid"]]

        return reply

    def make_repair():
        return lambda pdf: ["[[A=B]]"] * len(pdf)

    with pytest.raises(Exception, match="SystemExit|exit"):
        judging.judge_games(games.coalesce(1), make_reply, store, make_repair, every=4)
    paid = seen.read_text().split()
    stop.unlink()
    rows = judging.judge_games(games, make_reply, store, make_repair, every=4).collect()
    asked = seen.read_text().split()
    assert 0 < len(paid) < 12 and sorted(asked) == sorted(f"{u}/{g}" for u in range(6) for g in (1, 2))
    assert len(rows) == 12 and all(r["score"] for r in rows)
    judging.judge_games(games, make_reply, store, make_repair, every=4).collect()
    assert len(seen.read_text().split()) == 12  # nothing is asked a third time
    changed = games.withColumn("prompt", F.when(F.col("uid") == "2", "another question").otherwise(F.col("prompt")))
    judging.judge_games(changed, make_reply, store, make_repair).collect()
    assert len(seen.read_text().split()) == 14  # a changed prompt is another request


def test_records_hold_what_was_sent_and_said(spark, tmp_path):
    questions, answers, settings = setup(spark)
    make_reply = lambda: (lambda pdf: ["[[B>A]]" if u != "4" else "undecided" for u in pdf["uid"]])
    make_repair = lambda: (lambda pdf: ["[A=B]"] * len(pdf))
    rows, _ = judging.judge_target(questions, answers, stored(spark, []), "org/m", "j", settings, make_reply, str(tmp_path / "s"), make_repair)
    path = str(tmp_path / "judgments")
    write_jsonl(rows, path, ["judge", "model"])
    back = {r["uid"]: r for r in read_jsonl(spark, path, JUDGMENT_RECORD).collect()}
    first, repaired = back["0"]["games"][0], back["4"]["games"][1]
    assert first["judgment"]["answer"] == "[[B>A]]" and first["repair"] is None
    assert [m["role"] for m in first["prompt"]] == ["system", "user"] and "ask {ANSWER_A} 0" in first["prompt"][1]["content"]
    assert repaired["score"] == "A=B" and repaired["judgment"]["answer"] == "undecided"
    assert repaired["repair"]["judgment"]["answer"] == "[A=B]" and "undecided" in repaired["repair"]["prompt"][1]["content"]
    # a rerun over the stored records keeps them as they are
    again, _ = judging.judge_target(
        questions, answers, read_jsonl(spark, path, JUDGMENT_RECORD), "org/m", "j", settings, make_reply, str(tmp_path / "t"), make_repair
    )
    assert {r["uid"]: r["games"] for r in again.collect()} == {uid: r["games"] for uid, r in back.items()}


def test_coverage(spark):
    questions, answers, settings = setup(spark)
    judging.require_coverage(questions, answers, "org/m", settings)
    with pytest.raises(ValueError, match="uid=2 model=org/m"):
        judging.require_coverage(questions, answers.where("not (uid = '2' and model = 'org/m')"), "org/m", settings)
    gone = answers.where("model <> 'gemini-2.0-flash-001'")
    assert [r["model"] for r in Q.missing_baselines(questions, gone, "org/m", settings).collect()] == ["gemini-2.0-flash-001"]
    own = Q.unjudged(questions, stored(spark, []), "o3-mini-2025-01-31", settings)
    assert {r["category"] for r in own.collect()} == {"creative_writing"}
    with pytest.raises(ValueError):
        Q.require_known_categories(questions.withColumn("category", F.lit("x")), settings)


def test_answer_rows_hold_object_content(spark):
    df = spark.createDataFrame([("1", "p", "# a", 0.0)], "uid string, prompt string, answer string, tstamp double")
    row = Q.answer_rows(df, "m", "sys", F.lit(5.0))
    out = row.select("tstamp", PR.answer_text(F.col("messages")).alias("a"), F.size("messages").alias("n")).first()
    assert tuple(out) == (5.0, "# a", 3)
    assert row.first()["ans_id"] == Q.answer_rows(df, "m").first()["ans_id"]


CANDIDATES = "name string, instruction string, output string, ord bigint"


def candidates(spark):
    rows = [("a", "i", "a1", 1), ("a", "i", "a2", 2), ("b", "i", None, 3), ("b", "i", "b1", 4), ("a", "j", "x", 5),
            ("a", "k", "k {output_b}", 6), ("b", "k", "kb", 7), ("a", "", "e", 8), ("b", "", "e", 9)]
    return spark.createDataFrame(rows, CANDIDATES)


def test_intersection_keeps_first_outputs(spark):
    common = M.common_instructions(candidates(spark), ["a", "b"])
    got = {r["instruction"]: [(o["name"], o["output"]) for o in r["outputs"]] for r in common.collect()}
    assert got == {"i": [("a", "a1"), ("b", "b1")], "k": [("a", "k {output_b}"), ("b", "kb")]}
    assert tuple(M.coverage_counts(candidates(spark), ["a", "b"]).first()) == (3, 2, 1)
    assert M.first_instructions(common, 1).first()["instruction"] == "i"


def test_label_orders(spark):
    rows = [(n, f"instr {i}", n, i) for i in range(40) for n in ("x", "y", "z")]
    common = M.common_instructions(spark.createDataFrame(rows, CANDIDATES), ["x", "y", "z"])
    twister = {r["instruction"]: r["labels"] for r in M.label_candidates(common, 42, "twister").collect()}
    import hashlib

    for instruction, labels in twister.items():
        seed = int.from_bytes(hashlib.sha256(f"42-{instruction}".encode()).digest()[:8], "big")
        want = ["x", "y", "z"]
        random.Random(seed).shuffle(want)
        assert labels == dict(zip("ABC", want))
    hashed = [tuple(r["labels"].values()) for r in M.label_candidates(common, 42).collect()]
    assert len(set(hashed)) == 6
    with pytest.raises(ValueError):
        M.label_candidates(common, 42, "other")


def test_comparison_round(spark, tmp_path):
    def make_reply():
        return lambda pdf: ["Winner: A" if "k {output_b}" in p and "Response A:\nk {output_b}" in p else "?" for p in pdf["prompt"]]

    done = comparison.comparison_round(candidates(spark), ["a", "b"], make_reply, "j", str(tmp_path / "r"), system_prompt="be fair")
    rows = {r["instruction"]: r for r in done.results.collect()}
    assert rows["i"]["winner_key"] == "TIE" and done.failed.count() == 0
    assert rows["k"]["winner_key"] in ("a", "TIE") and rows["k"]["system_prompt"] == "be fair"
    assert rows["i"]["labels"].keys() == {"A", "B"}


def test_failed_calls_are_asked_again(spark, tmp_path):
    def outage():
        def reply(pdf):
            if (pdf["instruction"] == "i").any():
                raise RuntimeError("down")
            return ["Winner: A"] * len(pdf)

        return reply

    first = comparison.comparison_round(candidates(spark), ["a", "b"], outage, "j", str(tmp_path / "1"))
    assert [tuple(r) for r in first.failed.collect()] == [("i", "RuntimeError: down")]
    assert [r["instruction"] for r in first.results.collect()] == ["k"]
    well = lambda: lambda pdf: ["Winner: B"] * len(pdf)
    second = comparison.comparison_round(candidates(spark), ["a", "b"], well, "j", str(tmp_path / "2"), first.results)
    assert [(r["instruction"], r["winner"]) for r in second.results.collect()] == [("i", "B")] and second.failed.isEmpty()
    stored = first.results.withColumn("ord", F.lit(1)).unionByName(first.results.withColumn("ord", F.lit(2)))
    table = {r["key"]: r["n"] for r in comparison.win_table(comparison.resumed(stored, second.results), ["a", "b"]).collect()}
    assert sum(table.values()) == 2


def test_a_reply_that_is_null_is_no_tie(spark, tmp_path):
    none = lambda: lambda pdf: [None] * len(pdf)
    done = comparison.comparison_round(candidates(spark), ["a", "b"], none, "j", str(tmp_path / "n"))
    assert done.results.isEmpty() and done.failed.count() == 2


def results(spark, keys):
    return spark.createDataFrame(
        [(f"i{n}", k, "A", n) for n, k in enumerate(keys)], "instruction string, winner_key string, winner string, ord bigint"
    )


def test_win_rates(spark):
    df = results(spark, ["x"] * 3 + ["y"] + ["TIE", "tie", "Tie"])
    rows = {r["key"]: (r["n"], r["win_rate"]) for r in TA.win_rates(TA.winner_counts(df, ["x", "y", "z"])).collect()}
    assert rows == {"x": (3, 0.75), "y": (1, 0.25), "z": (0, 0.0), "TIE": (3, None)}
    ties = TA.win_rates(TA.winner_counts(results(spark, ["TIE"]), ["x"])).collect()
    assert {r["key"]: r["win_rate"] for r in ties} == {"x": 0.0, "TIE": None}
    empty = TA.summary_row(TA.win_rates(TA.winner_counts(df.limit(0), ["x"])), "m").first()
    assert empty["total"] == 0 and empty["win_rates"] == {} and empty["counts"] == {"x": 0, "TIE": 0}


def test_candidate_selection():
    assert M.select_candidates({"a": "p", "b": "q", "c": None}, ["c", "b", "a"]) == ["b", "a"]
    for paths in ({"a": "p"}, {x: "p" for x in "abcd"}):
        with pytest.raises(ValueError):
            M.select_candidates(paths, list(paths))


def test_best_and_worst(spark):
    rng = random.Random(2)
    rows = [(p, i, float(rng.randint(0, 3))) for p in range(50) for i in range(rng.randint(2, 9))]
    got = P.best_and_worst(spark.createDataFrame(rows, "prompt_id int, pos int, score double")).collect()
    by = {}
    for p, i, s in rows:
        by.setdefault(p, {})[i] = s
    for r in got:
        scores = by[r["prompt_id"]]
        assert scores[r["best"]] == max(scores.values()) and scores[r["worst"]] == min(scores.values())
    tied = P.best_and_worst(spark.createDataFrame([(p, i, 1.0) for p in range(200) for i in range(4)], "prompt_id int, pos int, score double"))
    best = [r["best"] for r in tied.collect()]
    assert {best.count(i) > 20 for i in range(4)} == {True}
    assert tied.where("best = worst").count() > 20 and tied.where("best <> worst").count() > 20


def test_pairs_from_responses(spark):
    rows = [(1, [("user", "q")], ["", "aa", "b", "<|eot_id|>", "cccc"]), (2, [("user", "q")], ["only", " "])]
    df = spark.createDataFrame(rows, "prompt_id bigint, prompt_messages array<struct<role:string,content:string>>, responses array<string>")
    meta = P.run_metadata("rollout", 42, 5, "g", "r")
    pairs = preference.build_pairs(df, F.col("prompt_messages")[0]["content"], lambda: (lambda ps: [float(len(r)) for _, r in ps]), meta)
    (row,) = pairs.collect()
    assert row["chosen"][0]["content"] == "cccc" and row["rejected"][0]["content"] == "b"
    assert row["metadata"]["k_candidates"] == 5
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1  # the scorer runs once per row


def test_running_totals_cross_chunks(spark):
    rows = [("hot", i, i % 7) for i in range(1000)] + [("c", 0, 5), ("c", 1, 6)]
    df = spark.createDataFrame(rows, "k string, turn int, v int")
    got = {(r["k"], r["turn"]): (r["n"], r["s"]) for r in TN.running_totals(df, "k", "turn", {"n": F.lit(1), "s": F.col("v")}).collect()}
    total = 0
    for i in range(1000):
        assert got[("hot", i)] == (i, total)
        total += i % 7
    assert got[("c", 1)] == (1, 5)


def test_turn_questions(spark):
    rows = [("1", None, "c", [" a ", " "], None, None, 0), (None, "2", "c", [], "q", None, 1), (None, None, "c", ["x"], None, None, 2),
            ("4", None, None, [" "], "ignored", None, 3), ("5", None, "c", None, None, " p ", 4), ("6", None, "c", None, " ", "p", 5)]
    df = spark.createDataFrame(rows, "question_id string, id string, category string, turns array<string>, question string, prompt string, ord int")
    got = {r["question_id"]: r["turns"] for r in TN.normalize_turn_questions(df).collect()}
    assert got == {"1": ["a"], "2": ["q"], "5": ["p"]}
    talk = spark.createDataFrame([("1", ["u1", "u2"], ["a1", "a2"])], "question_id string, turns array<string>, outputs array<string>")
    prompts = {r["turn"]: [m["content"] for m in r["messages"]] for r in TN.running_prompts(talk).collect()}
    assert prompts == {0: ["u1"], 1: ["u1", "a1", "u2"]}


def test_templates(evaluate, spark):
    assert evaluate(lambda c: PR.fill("<{X}|{X}>{Y}", X=c, Y=F.lit("{X}")), ["a{Y}"]) == ["<a{Y}|a{Y}>{X}"]
    with pytest.raises(KeyError):
        PR.fill("{Z}", X=F.lit(1))
    header = K.ASSISTANT_HEADER
    assert evaluate(PR.ensure_assistant_header, ["p", "p" + header]) == ["p" + header, "p" + header]
    kind = "array<struct<role:string,content:string>>"
    chat = evaluate(PR.render_chatml, [[("system", " s "), ("user", "u")]], kind)
    assert chat == ["<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n"]


def test_replies(evaluate):
    chat = evaluate(PR.chat_reply, ['{"choices":[{"message":{"content":null}}],"usage":{"total_tokens":3}}', "{}"])
    assert [(c["answer"], c["error"]) for c in chat] == [("", None), (None, "no choices")]
    parts = evaluate(PR.parts_reply, ['{"candidates":[{"content":{"parts":[{"text":"a"},{"x":1},{"text":"b"}]}}]}', '{"candidates":[{}]}', "{}"])
    assert [(p["answer"], p["error"]) for p in parts] == [("ab", None), (None, "no text parts"), (None, "no candidates")]
