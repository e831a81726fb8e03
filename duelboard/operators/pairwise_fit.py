"""Pairwise logistic (Bradley-Terry) fits with style covariates, all rounds at once.

The fit is Newton's method. With the baseline's own column dropped, a battle touches
one strength only, so the strengths' block of the curvature is diagonal and can be
eliminated model by model. Each pass scans the battles once: every chunk of a model's
battles gives its gradient and curvature sums in all bootstrap rounds; Spark adds them
up per (group, round, model), reduces them to one system of the few style effects per
(group, round), and puts the solution back into the models' rows. Coefficients are a
table like any other: neither the number of models nor that of groups is bounded, and
the driver sees one number per pass.

Coefficients are strengths relative to the baseline, which leaves every reported
probability unchanged and makes the fit identifiable.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelboard.session import scratch_dir, work_partitions

#: Bound of coefficients; whatever comes near it is flagged as separated.
MAX_STRENGTH = 20.0
SEPARATED_AT = 8.0
LARGEST_STEP = 5.0
CHUNK_ROWS = 4_096


@dataclass(frozen=True)
class Fit:
    """Tables of a fit.

    ``strengths``: group, model, round, strength, separated. ``effects``: group, feature,
    round, effect, separated. ``rounds``: group, round, change (of the last pass),
    converged. Round 0 is the full sample.
    """

    strengths: DataFrame
    effects: DataFrame
    rounds: DataFrame
    passes: int


def poisson_weights(counts: np.ndarray, rounds: int, key: int, seed: int) -> np.ndarray:
    """rows x (rounds + 1) weights of one chunk; column 0 is the unresampled data.

    A row standing for ``count`` equal battles weighs Poisson(count) in a round. The
    generator is keyed by the chunk, whose rows come in a fixed order, so retries and
    other partitionings see the same resample.
    """
    rng = np.random.Generator(np.random.Philox(key=[key & (2**64 - 1), seed]))
    drawn = rng.poisson(counts[:, None].astype("float64"), (len(counts), rounds))
    return np.concatenate([counts[:, None].astype("float64"), drawn], axis=1)


def weighted_moments(battles: DataFrame, features, group: str = "category") -> DataFrame:
    """group, battles, <feature>_mean, <feature>_std over battles of weight ``count``.

    Deviations are summed about the mean in a second pass, so large counts do not
    cancel. A deviation of zero, or of a single battle, counts as one.
    """
    n = F.col("count")
    means = battles.groupBy(group).agg(
        F.sum(n).alias("battles"),
        *[(F.sum(n * F.col(f)) / F.sum(n)).alias(f"{f}_mean") for f in features],
        *[(F.min(f) == F.max(f)).alias(f"{f}_flat") for f in features],
    )
    squares = (
        battles.join(means.select(group, *[f"{f}_mean" for f in features]), group)
        .groupBy(group)
        .agg(*[F.sum(n * (F.col(f) - F.col(f"{f}_mean")) ** 2).alias(f"{f}_square") for f in features])
    )
    deviation = lambda f: F.sqrt(F.col(f"{f}_square") / (F.col("battles") - 1))
    spread = [
        c
        for f in features
        for c in (
            F.col(f"{f}_mean"),
            F.when((F.col("battles") > 1) & ~F.col(f"{f}_flat"), deviation(f)).otherwise(1.0).alias(f"{f}_std"),
        )
    ]
    return means.join(squares, group).select(group, "battles", *spread)


def chunk_sums(z, score, weights, strengths, effects) -> np.ndarray:
    """Sums over one chunk of a model's battles, a row per round.

    Columns: the strength's gradient and curvature, its curvature with each effect, the
    effects' gradient, and the upper triangle of their curvature.
    """
    k = z.shape[1]
    eta = strengths[None, :] + z @ effects.T
    mu = 1.0 / (1.0 + np.exp(-np.clip(eta, -500, 500)))
    residual = weights * (score[:, None] - mu)
    curve = weights * mu * (1.0 - mu)
    parts = [residual.sum(axis=0)[None], curve.sum(axis=0)[None], z.T @ curve, z.T @ residual]
    parts += [(z[:, i] * z[:, j])[None] @ curve for i in range(k) for j in range(i, k)]
    return np.vstack(parts).T


def _chunks(battles: DataFrame, features: list[str], group: str) -> DataFrame:
    """group, model, chunk, key, counts, scores, z: battles in chunks of about CHUNK_ROWS rows."""
    moments = weighted_moments(battles, features, group)
    z = F.array(*[(F.col(f) - F.col(f"{f}_mean")) / F.col(f"{f}_std") for f in features])
    rows = battles.where(~F.col("own")).select(group, "model", "row_key", "count", "score", *features)
    sizes = rows.groupBy(group, "model").agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("long").alias("n_chunks"))
    placed = rows.join(moments, group).join(sizes, [group, "model"]).withColumn("chunk", F.pmod("row_key", "n_chunks"))
    # every pass is Python work over few bytes, so the count of partitions is stated
    spread = placed.select(group, "model", "chunk", F.struct("row_key", "score", "count", z.alias("z")).alias("row")).repartition(
        work_partitions(battles.sparkSession), group, "model", "chunk"
    )
    own = spread.groupBy(group, "model", "chunk").agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return own.select(
        group,
        "model",
        F.xxhash64(group, "model", "chunk").alias("key"),
        F.col("rows.count").alias("counts"),
        F.col("rows.score").alias("scores"),
        F.flatten("rows.z").alias("z"),
    )


def stored_battles(battles: DataFrame, features: list[str], group: str = "category") -> DataFrame:
    """The columns a fit needs, written once: several passes read them, the joins before run once."""
    return _written(battles.select(group, "model", "own", "score", "count", "row_key", *features), "battles")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fit_rounds(
    battles: DataFrame,
    features: list[str],
    rounds: int,
    seed: int = 42,
    group: str = "category",
    ridge: float = 1e-6,
    tolerance: float = 3e-5,
    max_passes: int = 25,
) -> Fit:
    """Fit the full sample and ``rounds`` resamples of every group together.

    ``battles``: group, model, own (the candidate is the baseline), score, count,
    row_key and the raw feature columns, which are standardised per group. Newton steps
    shrink quadratically, so a last step below ``tolerance`` leaves an error of about
    its square. A step is at most LARGEST_STEP long; rounds that still move after
    ``max_passes`` are returned with ``converged`` false.
    """
    chunks = _chunks(stored_battles(battles, features, group), features, group).persist()
    try:
        return _fit_chunks(chunks, list(features), rounds, seed, group, ridge, tolerance, max_passes)
    finally:
        chunks.unpersist()


def _pass_sums(chunks: DataFrame, coefficients: DataFrame, k: int, rounds: int, seed: int, group: str) -> DataFrame:
    """group, model, round, s0, s1, ...: the sums of ``chunk_sums`` over all chunks."""
    width = 2 + 2 * k + k * (k + 1) // 2
    columns = [f"s{i}" for i in range(width)]

    def scan(batches):
        import pandas as pd

        for pdf in batches:
            for row in pdf.itertuples(index=False):
                counts = np.asarray(row.counts, "float64")
                weights = poisson_weights(counts, rounds, row.key, seed)
                sums = chunk_sums(
                    np.asarray(row.z, "float64").reshape(len(counts), k),
                    np.asarray(row.scores, "float64"),
                    weights,
                    np.asarray(row.strengths, "float64"),
                    np.asarray(row.effects, "float64").reshape(rounds + 1, k),
                )
                frame = pd.DataFrame(sums, columns=columns)
                frame.insert(0, "round", np.arange(rounds + 1, dtype="int32"))
                frame.insert(0, "model", row.model)
                frame.insert(0, "group_name", row.group_name)
                yield frame

    given = chunks.join(coefficients.select(group, "model", "strengths", "effects"), [group, "model"])
    given = given.select(F.col(group).alias("group_name"), "model", "key", "counts", "scores", "z", "strengths", "effects")
    schema = "group_name string, model string, round int, " + ", ".join(f"{c} double" for c in columns)
    summed = given.mapInPandas(scan, schema).groupBy("group_name", "model", "round").agg(*[F.sum(c).alias(c) for c in columns])
    return summed.withColumnRenamed("group_name", group)


def _solved(k: int):
    @F.pandas_udf("array<double>")
    def solve(matrix, right):
        import pandas as pd

        if not len(matrix):
            return pd.Series([], dtype="object")
        a = np.stack(matrix.to_list()).reshape(len(matrix), k, k)
        b = np.stack(right.to_list())
        return pd.Series(list(np.linalg.solve(a, b[..., None])[..., 0]))

    return solve


def _step(sums: DataFrame, coefficients: DataFrame, k: int, group: str) -> DataFrame:
    """Coefficients after one Newton step, with each round's change."""
    bound = lambda x, most: F.greatest(F.lit(-most), F.least(F.lit(most), x))
    at = F.col("round")
    rows = sums.join(coefficients.select(group, "model", "strengths", "effects", "penalty"), [group, "model"]).select(
        group,
        "model",
        "round",
        F.col("penalty"),
        F.get("strengths", at).alias("strength"),
        F.slice("effects", at * k + 1, F.lit(k)).alias("own_effects"),
        (F.col("s0") - F.col("penalty") * F.get("strengths", at)).alias("g"),
        (F.col("s1") + F.col("penalty")).alias("d"),
        *[F.col(f"s{2 + j}").alias(f"c{j}") for j in range(k)],
        *[F.col(f"s{2 + k + j}").alias(f"f{j}") for j in range(k)],
        *[F.col(f"s{2 + 2 * k + i}").alias(f"a{i}") for i in range(k * (k + 1) // 2)],
    )
    upper = {(i, j): n for n, (i, j) in enumerate((i, j) for i in range(k) for j in range(i, k))}
    total = rows.groupBy(group, "round").agg(
        F.first("penalty").alias("penalty"),
        F.min("own_effects").alias("own_effects"),  # the same for all models of a round
        *[F.sum(F.col(f"f{j}") - F.col(f"c{j}") * F.col("g") / F.col("d")).alias(f"r{j}") for j in range(k)],
        *[F.sum(F.col(f"a{n}") - F.col(f"c{i}") * F.col(f"c{j}") / F.col("d")).alias(f"m{n}") for (i, j), n in upper.items()],
    )
    entry = lambda i, j: F.col(f"m{upper[min(i, j), max(i, j)]}") + (F.col("penalty") if i == j else F.lit(0.0))
    matrix = F.array(*[entry(i, j) for i in range(k) for j in range(k)])
    right = F.array(*[F.col(f"r{j}") - F.col("penalty") * F.get("own_effects", F.lit(j)) for j in range(k)])
    moved = total.select(group, "round", _solved(k)(matrix, right).alias("move")).select(
        group, "round", F.transform("move", lambda x: bound(x, LARGEST_STEP)).alias("move")
    )
    step = bound((F.col("g") - sum((F.col(f"c{j}") * F.get("move", F.lit(j)) for j in range(k)), F.lit(0.0))) / F.col("d"), LARGEST_STEP)
    rows = rows.join(moved, [group, "round"]).withColumn("new", bound(F.col("strength") + step, MAX_STRENGTH))
    rows = rows.withColumn("new_effects", F.zip_with("own_effects", "move", lambda e, m: bound(e + m, MAX_STRENGTH)))
    change = F.greatest(F.abs(F.col("new") - F.col("strength")), F.array_max(F.zip_with("new_effects", "own_effects", lambda a, b: F.abs(a - b))))
    state = F.array_sort(F.collect_list(F.struct("round", F.col("new").alias("strength"), F.col("new_effects").alias("effects"), change.alias("change"))))
    out = rows.groupBy(group, "model").agg(state.alias("state"), F.first("penalty").alias("penalty"))
    return out.select(
        group, "model", F.col("state.strength").alias("strengths"), F.flatten("state.effects").alias("effects"), "penalty", F.col("state.change").alias("changes")
    )


def _fit_chunks(chunks, features, rounds, seed, group, ridge, tolerance, max_passes) -> Fit:
    k = len(features)
    battles = F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c)
    models = chunks.groupBy(group, "model").agg(F.sum(battles).alias("n"))
    totals = models.groupBy(group).agg((F.sum("n") * ridge).alias("penalty"))
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    start = models.join(totals, group).select(
        group, "model", zeros(rounds + 1).alias("strengths"), zeros((rounds + 1) * k).alias("effects"), "penalty", zeros(rounds + 1).alias("changes")
    )
    coefficients, passes = _written(start, "fit"), 0
    while passes < max_passes:
        passes += 1
        sums = _pass_sums(chunks, coefficients, k, rounds, seed, group).persist()
        try:
            coefficients = _written(_step(sums, coefficients, k, group), "fit")
        finally:
            sums.unpersist()
        largest = coefficients.agg(F.max(F.array_max("changes"))).first()[0]
        if largest is None or largest < tolerance:
            break
    by_round = coefficients.select(group, "model", F.posexplode(F.arrays_zip("strengths", "changes")).alias("round", "own"))
    high = F.array_max(F.transform("strengths", lambda s: F.abs(s))) > SEPARATED_AT
    strengths = coefficients.select(group, "model", high.alias("separated"), F.posexplode("strengths").alias("round", "strength")).select(
        group, "model", "round", "strength", "separated"
    )
    changes = by_round.groupBy(group, "round").agg(F.max("own.changes").alias("change")).withColumn("converged", F.col("change") < tolerance)
    one = coefficients.groupBy(group).agg(F.min("effects").alias("effects"))  # the same for all models of a group
    effects = one.select(group, F.posexplode("effects").alias("at", "effect")).select(
        group,
        F.element_at(F.array(*[F.lit(f) for f in features]), (F.col("at") % k + 1).cast("int")).alias("feature"),
        F.floor(F.col("at") / k).cast("int").alias("round"),
        "effect",
    )
    limits = effects.groupBy(group, "feature").agg((F.max(F.abs("effect")) > SEPARATED_AT).alias("separated"))
    return Fit(strengths, effects.join(limits, [group, "feature"]), changes, passes)


def fit_residuals(battles: DataFrame, fit: Fit, features: list[str], seed: int = 42, group: str = "category") -> DataFrame:
    """group, round, term, residual: the first-order condition per battle at the fitted coefficients.

    Zero but for rounding and the small ridge in every converged round. A term is a model
    or a feature; the residual is the sum of weight x (score - fitted chance) x design
    over the sum of counts.
    """
    k = len(features)
    chunks = _chunks(battles, features, group)
    number = F.coalesce(*[F.when(F.col("feature") == f, F.lit(j)) for j, f in enumerate(features)])
    effects = fit.effects.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("round", number.alias("j"), "effect"))).alias("e"))
    strengths = fit.strengths.groupBy(group, "model").agg(F.array_sort(F.collect_list(F.struct("round", "strength"))).alias("s"))
    coefficients = strengths.join(effects, group).select(group, "model", F.col("s.strength").alias("strengths"), F.col("e.effect").alias("effects"))
    rounds = fit.rounds.agg(F.max("round")).first()[0] or 0
    sums = _pass_sums(chunks, coefficients, k, rounds, seed, group)
    n = chunks.groupBy(group).agg(F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c)).alias("n"))
    terms = F.explode(F.array(F.struct(F.col("model").alias("term"), F.col("s0").alias("v")), *[F.struct(F.lit(f).alias("term"), F.col(f"s{2 + k + j}").alias("v")) for j, f in enumerate(features)]))
    per_term = sums.select(group, "round", terms.alias("t")).groupBy(group, "round", F.col("t.term").alias("term")).agg(F.sum("t.v").alias("v"))
    return per_term.join(n, group).select(group, "round", "term", (F.col("v") / F.col("n")).alias("residual"))


def win_probability(strength, baseline=None):
    """Chance of beating the baseline from two strengths (log odds)."""
    difference = strength if baseline is None else strength - baseline
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-difference))
