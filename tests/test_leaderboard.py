import numpy as np
import pytest
from pyspark.sql import functions as F

from duelboard.operators import judgments as J
from duelboard.operators import leaderboard as L
from duelboard.plans.report import leaderboard_report

SCHEMA = (
    "uid string, category string, model string, games array<struct<score:string>>, ord bigint"
)


def judgments(spark, pairs, model="org/m", category="math"):
    def games(labels):
        return None if labels is None else [None if x is None else (x,) for x in labels]

    rows = [(str(i), category, model, games(p), i) for i, p in enumerate(pairs)]
    return spark.createDataFrame(rows, SCHEMA)


def test_battles_flip_the_first_game(spark):
    df = judgments(spark, [("A>B", "A<B"), ("A>>B", "junk"), ("B=A", "B<<A")])
    rows = J.battle_rows(J.split_judgments(df)[0]).orderBy("uid").collect()
    by_uid = {}
    for r in rows:
        by_uid.setdefault(r["uid"], []).append(r["score"])
    assert {k: sorted(v) for k, v in by_uid.items()} == {"0": [0, 0], "1": [0, 0, 0], "2": [0.5, 1, 1, 1]}
    assert {r["model"] for r in rows} == {"m"}
    votes = J.battle_tallies(J.split_judgments(df)[0], ["model"]).first()
    assert (votes["wins"], votes["ties"], votes["losses"]) == (3, 1, 5)


def test_rejects_and_preview(spark):
    df = judgments(spark, [("A>B", "A<B"), ("A>B",), (None, "A>B"), ("junk", "x"), None] + [("A",)] * 8)
    df = df.unionByName(
        spark.createDataFrame([("n", "math", "m", [("A>B",), (None,)], 99)], SCHEMA)
    )
    valid, rejects = J.split_judgments(df)
    assert valid.count() == 1
    reasons = {r["reason"]: r["n"] for r in rejects.groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert reasons == {"missing_games": 10, "null_game": 1, "invalid_score_labels": 1, "missing_score": 1}
    with pytest.raises(ValueError, match=r"\+5 more"):
        J.require_valid(df)
    tagged = df.withColumn("reason", J.reject_reason(F.col("games")))
    same = tagged.where(F.col("reason").isNull() != F.coalesce(J.is_scorable(F.col("games")), F.lit(False)))
    assert same.count() == 0


def tallies(spark):
    return spark.createDataFrame(
        [("c", "a", 700, 100, 200), ("c", "b", 5, 0, 0)], "category string, model string, wins bigint, ties bigint, losses bigint"
    )


@pytest.mark.parametrize("method", [L.bootstrap_rounds_multinomial, L.bootstrap_rounds_draws])
def test_bootstrap_follows_resampling(spark, method):
    rounds = method(tallies(spark), ["category", "model"], 400, 7)
    means = {
        m: np.array([r["round_mean"] for r in rounds.where(F.col("model") == m).collect()]) for m in "ab"
    }
    assert len(means["a"]) == 400 and set(means["b"]) == {1.0}
    scores = np.repeat([1.0, 0.5, 0.0], [700, 100, 200])
    assert abs(means["a"].mean() - scores.mean()) < 0.003
    assert abs(means["a"].std() - scores.std() / np.sqrt(1000)) < 0.002


def test_bootstrap_does_not_depend_on_partitioning(spark):
    one = L.bootstrap_rounds_multinomial(tallies(spark).coalesce(1), ["category", "model"], 5, 3)
    many = L.bootstrap_rounds_multinomial(tallies(spark).repartition(4), ["category", "model"], 5, 3)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(one) == key(many)


def test_interval_interpolates(spark):
    df = spark.createDataFrame([("c", x) for x in (1.0, 2.0, 4.0)], "k string, v double")
    row = L.interval(df, ["k"], "v").first()
    assert row["lower"] == pytest.approx(1.1) and row["score"] == pytest.approx(7 / 3)
    assert L.interval(df, ["k"], "v", "median").first()["score"] == 2.0


def test_report_adds_baselines_and_validates_categories(spark):
    df = judgments(spark, [("B>A", "A>B")] * 6)
    board = leaderboard_report(df, L.baselines(spark), rounds=10)
    rows = {r["model"]: r["score"] for r in board.collect()}
    assert rows == {"m": 1.0, "o3-mini-2025-01-31": 0.5}
    with pytest.raises(ValueError):
        leaderboard_report(df, L.baselines(spark), categories=["nope"])
    lines = [r["line"] for r in L.text_table(board).orderBy("line_no").collect()]
    assert lines[0].split() == ["Model", "Scores", "(%)", "CI", "(%)"]
    assert lines[1].startswith("m ") and "100.0" in lines[1] and "(-0.0 / +0.0)" in lines[2]
