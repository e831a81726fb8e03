import numpy as np
import pytest
from pyspark.sql import functions as F

from duelboard.operators import pairwise_fit as PF
from duelboard.operators import style_board as SB
from duelboard.operators.leaderboard import baselines

FEATURES = ["length", "headers", "lists", "bolds"]
SCHEMA = (
    "category string, model string, own boolean, score double, count bigint, row_key bigint, "
    "length double, headers double, lists double, bolds double"
)


def battles(spark, n=600, models=("m1", "m2", "m3"), seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        k = int(rng.integers(len(models)))
        x = rng.normal(size=4)
        chance = 1 / (1 + np.exp(-(0.6 * k - 0.4 + 0.5 * x[0] - 0.3 * x[2])))
        score = float(rng.choice([0.0, 0.5, 1.0], p=[(1 - chance) * 0.9, 0.1, chance * 0.9]))
        rows.append(("math", models[k], False, score, int(rng.integers(1, 5)), i * 7919, *map(float, x)))
    return spark.createDataFrame(rows, SCHEMA), rows


def newton(rows, models):
    """Direct weighted fit on the standardised design."""
    count = np.array([r[4] for r in rows], float)
    x = np.array([r[6:] for r in rows])
    y = np.array([r[3] for r in rows])
    total = count.sum()
    mean = (count[:, None] * x).sum(0) / total
    std = np.sqrt((count[:, None] * (x - mean) ** 2).sum(0) / (total - 1))
    own = np.array([[1.0 if r[1] == m else 0.0 for m in models] for r in rows])
    design = np.hstack([own, (x - mean) / std])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        mu = 1 / (1 + np.exp(-design @ beta))
        g = design.T @ (count * (y - mu))
        h = (design * (count * mu * (1 - mu))[:, None]).T @ design
        beta = beta + np.linalg.solve(h, g)
    return beta


def strengths(fit, category="math"):
    """models x rounds, models in order of their names."""
    rows = fit.strengths.where(F.col("category") == category).orderBy("model", "round").collect()
    models = sorted({r["model"] for r in rows})
    return np.array([r["strength"] for r in rows]).reshape(len(models), -1)


def effects(fit, features=FEATURES, category="math"):
    rows = fit.effects.where(F.col("category") == category).orderBy("round").collect()
    found = {(r["feature"], r["round"]): r["effect"] for r in rows}
    last = max(r["round"] for r in rows)
    return np.array([[found[f, k] for k in range(last + 1)] for f in features])


def test_full_sample_fit_matches_direct_solve(spark):
    df, rows = battles(spark)
    fit = PF.fit_rounds(df, FEATURES, rounds=0)
    want = newton(rows, ["m1", "m2", "m3"])
    got = np.concatenate([strengths(fit)[:, 0], effects(fit)[:, 0]])
    assert np.abs(got - want).max() < 1e-4
    assert fit.passes < 10 and all(r["converged"] for r in fit.rounds.collect())
    left = PF.fit_residuals(df, fit, FEATURES).collect()
    assert len(left) == 7 and all(abs(r["residual"]) < 1e-5 for r in left)


def test_one_candidate_gets_a_coefficient(spark):
    df, rows = battles(spark, models=("m3",))
    fit = PF.fit_rounds(df, FEATURES, rounds=0)
    assert abs(strengths(fit)[0, 0] - newton(rows, ["m3"])[0]) < 1e-4


def test_rounds_do_not_depend_on_partitioning_and_vary(spark):
    df, rows = battles(spark, 400)
    one = strengths(PF.fit_rounds(df.coalesce(1), FEATURES, rounds=40))
    many = strengths(PF.fit_rounds(df.repartition(7), FEATURES, rounds=40))
    assert np.allclose(one, many, atol=1e-7)
    spread = one[:, 1:].std(axis=1)
    n = sum(r[4] for r in rows) / 3
    assert np.all(spread > 0.3 * 2 / np.sqrt(n)) and np.all(spread < 3 * 2 / np.sqrt(n))


def test_separated_models_are_flagged(spark):
    rows = [("math", "m", False, 0.0, 1, i, 0.0, 0.0, 0.0, 0.0) for i in range(30)]
    fit = PF.fit_rounds(spark.createDataFrame(rows, SCHEMA), ["length"], rounds=3)
    assert fit.strengths.where("not separated").isEmpty() and np.all(strengths(fit) < -5)


def test_a_fit_cut_short_says_so(spark):
    df, _ = battles(spark, 200)
    fit = PF.fit_rounds(df, FEATURES, rounds=0, max_passes=1)
    assert fit.passes == 1 and not fit.rounds.first()["converged"]


def test_many_models_and_large_counts(spark):
    rng = np.random.default_rng(5)
    rows = [("math", f"m{i // 4:05d}", False, float(i % 4 in (0, 3) or i % 8 == 1), 1 + i % 3, i * 7919, float(rng.normal()), 0.0, 0.0, 0.0) for i in range(8_000)]
    rows.append(("math", "m00000", False, 0.5, 10_000, 99, 0.3, 0.0, 0.0, 0.0))
    fit = PF.fit_rounds(spark.createDataFrame(rows, SCHEMA), ["length"], rounds=1, ridge=1e-7)
    found = {r["model"]: r["strength"] for r in fit.strengths.where("round = 0").collect()}
    assert len(found) == 2_000
    # direct solve with the diagonal block eliminated
    count, y = np.array([r[4] for r in rows], float), np.array([r[3] for r in rows])
    x, m = np.array([r[6] for r in rows]), np.array([int(r[1][1:]) for r in rows])
    mean = (count * x).sum() / count.sum()
    z = (x - mean) / np.sqrt((count * (x - mean) ** 2).sum() / (count.sum() - 1))
    s, e, pen = np.zeros(2_000), 0.0, 1e-7 * count.sum()
    for _ in range(60):
        mu = 1 / (1 + np.exp(-(s[m] + z * e)))
        w = count * mu * (1 - mu)
        g, d = np.bincount(m, count * (y - mu), 2_000) - pen * s, np.bincount(m, w, 2_000) + pen
        c = np.bincount(m, w * z, 2_000)
        move = ((count * (y - mu) * z).sum() - pen * e - (c * g / d).sum()) / ((w * z * z).sum() + pen - (c * c / d).sum())
        s, e = s + np.clip((g - c * move) / d, -5, 5), e + move
    assert max(abs(found[f"m{i:05d}"] - s[i]) for i in range(2_000)) < 1e-3


def test_weights_are_poisson():
    for count in (1, 3, 500, 10_000):
        w = PF.poisson_weights(np.full(3000, count), 20, 7, 42)
        assert np.all(w[:, 0] == count)
        assert abs(w[:, 1:].mean() - count) < 4 * np.sqrt(count / 60000)
        assert abs(w[:, 1:].var() / count - 1) < 0.05
        assert np.all(w == PF.poisson_weights(np.full(3000, count), 20, 7, 42))


def test_style_board_against_brute_force(spark):
    judg = spark.createDataFrame(
        [("1", "math", "org/m", [("B>A",), ("A>>B",)]), ("2", "math", "org/m", [("A=B",), ("A=B",)]),
         ("3", "math", "org/m", [("A>B",), ("B>A",)]), ("9", "math", "org/m", [("A>B",), ("B>A",)])],
        "uid string, category string, model string, games array<struct<score:string>>",
    )
    base = "o3-mini-2025-01-31"
    answers = spark.createDataFrame(
        [(u, m, f, (float(n), 1.0, 0.0, 0.0)) for u in "123" for m, f, n in
         ((base, "a", 10), ("org/m", "b", 20 + int(u)), ("old/m", "0", 5))],
        "uid string, model string, first_file string, "
        "features struct<length:double,headers:double,lists:double,bolds:double>",
    )
    lookup = SB.style_lookup(answers)
    rows = SB.with_style_difference(SB.counted_battles(judg), lookup, baselines(spark)).collect()
    # uid 9 has no answers; "old/m" is replaced by "org/m", whose first file sorts later
    assert sorted((r["uid"], r["score"], r["count"]) for r in rows) == [
        ("1", 1.0, 4), ("2", 0.5, 2), ("3", 0.0, 2)
    ]
    lengths = {r["uid"]: r["length"] for r in rows}
    assert lengths["1"] == pytest.approx((21 - 10) / 31)
    moments = SB.feature_moments(
        SB.with_style_difference(SB.counted_battles(judg), lookup, baselines(spark))
    ).first()
    sample = np.repeat([(20 + u - 10) / (30 + u) for u in (1, 2, 3)], [4, 2, 2])
    assert moments["length_mean"] == pytest.approx(sample.mean())
    assert moments["length_std"] == pytest.approx(sample.std(ddof=1))
    assert moments["lists_std"] == 1.0
    board = SB.style_leaderboard(judg, lookup, baselines(spark), ["length"], rounds=20)
    found = {r["model"]: r["score"] for r in board.collect()}
    assert found["o3-mini-2025-01-31"] == 0.5 and 0 < found["m"] < 1


def test_controls_are_validated():
    assert SB.control_columns(["markdown"]) == ["headers", "lists", "bolds"]
    for bad in ([], ["size"]):
        with pytest.raises(ValueError):
            SB.control_columns(bad)


def test_probability_against_itself(spark):
    row = spark.range(1).select(PF.win_probability(F.lit(1.5), F.lit(1.5)).alias("p")).first()
    assert row["p"] == 0.5
