"""Queries for aggregations, fits, leaderboards and tallies (A*, K7)."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.catalog.column_queries import _FEATURES_SQL, _KEPT, _MIRRORED_SQL, WSC, _mirrored_pairs
from duelboard.catalog.registry import query
from duelboard.catalog.scan_queries import WIN_RATES_SQL
from duelboard.functions import style as S
from duelboard.operators import judgments as J
from duelboard.operators import leaderboard as L
from duelboard.operators import pairs as P
from duelboard.operators import pairwise_fit as PF
from duelboard.operators import style_board as SB
from duelboard.operators import tally as TA
from duelboard.operators.quantiles import exact_quantiles
from duelboard.plans.report import leaderboard_report
from duelboard.session import bound_batches, scratch_dir
from duelboard.sources.readers import current_files, last_answers

NAMES = ["chosen", "sft", "beta_dpo"]


def _valid(t):
    return J.split_judgments(t.judgments())[0]


def lookup(t):
    """Style features of the current answers.

    Features are taken where the text is scanned, so the joins that settle which
    row counts move four numbers per answer instead of its text.
    """
    bound_batches(t.spark)
    current = current_files(t.heavy_view("answers_raw"))  # texts of replaced files are not looked at
    counted = current.withColumn("_words", S.counted_words()(F.col("answer")))
    features = S.feature_vector(F.col("answer"), F.col("_words")).alias("features")
    return SB.style_lookup(last_answers(counted.select("file_name", "first_file", "model", "uid", "ord", features)))


# -- battles and scores -------------------------------------------------------


@query("a1_battles", "select uid, model, category, score from battles")
def _(t):
    return J.battle_rows(_valid(t))


@query(
    "a2_model_scores",
    "select category, model, count(*) battles, round(avg(score), 9) score from battles group by 1, 2",
)
def _(t):
    return L.model_scores(_valid(t)).withColumn("score", F.round("score", 9))


@query(
    "a2_model_scores_lineitem",
    """
with b as (
  select category, regexp_replace(model, '^.*/', '') model, s.score, s.weight from shipments join label_scores s on s.label = g2
  union all select category, regexp_replace(model, '^.*/', ''), 1 - s.score, s.weight from shipments join label_scores s on s.label = g1)
select category, model, cast(sum(weight) as bigint) battles, round(sum(score * weight) / sum(weight), 9) score from b group by 1, 2""",
)
def _(t):
    valid = J.split_judgments(t.shipments())[0]
    return L.model_scores(valid).withColumn("score", F.round("score", 9))


_TALLY_SQL = """
tallies as (
  select category, model, count_if(score = 1) wins, count_if(score = 0.5) ties, count_if(score = 0) losses, count(*) total,
         ('0x' || substr(md5(concat_ws('|', category, model)), 1, 8))::bigint % 2147483647 code
  from battles group by 1, 2)"""

# h: three multiply-and-square steps modulo 2^31-1, as stated in draw_index.
_DRAWS_SQL = f"""
with {_TALLY_SQL},
d as (select *, unnest(range(total)) draw from (select *, unnest(range(20)) r from tallies)),
h1 as (select *, (code + r * 48271 + 42) % 2147483647 h from d),
h2 as (select * exclude h, (h * 16807 + draw % 2147483647) % 2147483647 h from h1),
h3 as (select * exclude h, (h * h + 12345) % 2147483647 h from h2),
h4 as (select * exclude h, (h * 69621 + draw % 1000003) % 2147483647 h from h3),
h5 as (select * exclude h, (h * h + r) % 2147483647 h from h4),
h6 as (select * exclude h, (h * 39373 + 7) % 2147483647 h from h5),
i as (select *, cast(floor(cast(h * total as double) / 2147483647::double) as bigint) idx from h6),
rounds as (
  select category, model, r, (count_if(idx < wins) + 0.5 * count_if(idx >= wins and idx < wins + ties)) / any_value(total) m
  from i group by 1, 2, 3)
"""


@query(
    "a3_bootstrap_draws",
    _DRAWS_SQL
    + """
select category, model, round(avg(m), 9) score, round(quantile_cont(m, 0.05), 9) "lower", round(quantile_cont(m, 0.95), 9) "upper"
from rounds group by 1, 2""",
)
def _(t):
    """Every draw made one by one (20 rounds), reproducible in SQL."""
    board = L.raw_leaderboard(_valid(t), rounds=20, seed=42, method="draws")
    return board.select("category", "model", *[F.round(c, 9).alias(c) for c in ("score", "lower", "upper")])


_A3_CHECK_SQL = """
select category, model, round(avg(score), 9) raw_mean, true ordered, true near_mean, true width_fits from {rows} group by 1, 2"""


def _interval_checks(board, valid):
    """Bootstrap bounds against the normal approximation from the tallies.

    The score lies within five standard errors of the raw mean and the interval's width
    within a factor of two of its normal value, or both are nil.
    """
    tallies = J.battle_tallies(valid, L.KEYS)
    n = F.col("wins") + F.col("ties") + F.col("losses")
    mean = (F.col("wins") + 0.5 * F.col("ties")) / n
    variance = (F.col("wins") + 0.25 * F.col("ties")) / n - mean * mean
    stats = tallies.select(*L.KEYS, mean.alias("mean"), F.sqrt(F.greatest(variance, F.lit(0.0)) / n).alias("error"), n.alias("n"))
    width, normal = F.col("upper") - F.col("lower"), 2 * 1.6449 * F.col("error")
    # means move in steps of half a battle
    fits = ((width >= 0.5 * normal - 1.0 / F.col("n")) & (width <= 2 * normal + 1.0 / F.col("n"))) | ((normal < 1e-12) & (width < 1e-12))
    return stats.join(board, L.KEYS).select(
        *L.KEYS,
        F.round("mean", 9).alias("raw_mean"),
        ((F.col("lower") <= F.col("score")) & (F.col("score") <= F.col("upper"))).alias("ordered"),
        (F.abs(F.col("score") - F.col("mean")) <= 5 * F.col("error") + 1e-9).alias("near_mean"),
        fits.alias("width_fits"),
    )


@query("a3_bootstrap_checks", _A3_CHECK_SQL.format(rows="battles"))
def _(t):
    valid = _valid(t)
    return _interval_checks(L.raw_leaderboard(valid, rounds=100, seed=42), valid)


@query(
    "a3_bootstrap_lineitem_checks",
    """
with b as (
  select category, regexp_replace(model, '^.*/', '') model, s.score, s.weight from shipments join label_scores s on s.label = g2
  union all select category, regexp_replace(model, '^.*/', ''), 1 - s.score, s.weight from shipments join label_scores s on s.label = g1)
select category, model, round(sum(score * weight) / sum(weight), 9) raw_mean, true ordered, true near_mean, true width_fits from b group by 1, 2""",
)
def _(t):
    valid = J.split_judgments(t.shipments())[0]
    return _interval_checks(L.raw_leaderboard(valid, rounds=100, seed=42), valid)


@query("a3_bootstrap_leaderboard")
def _(t):
    """100 rounds by multinomial draws of the counts, with baseline rows."""
    return leaderboard_report(t.judgments(), t.settings(), rounds=100, seed=42, strict=False)


@query("a3_bootstrap_lineitem")
def _(t):
    valid = J.split_judgments(t.shipments())[0]
    return L.raw_leaderboard(valid, rounds=100, seed=42)


@query(
    "a4_quantiles",
    """
select category, model, quantile_cont(score, 0.05) q05, quantile_cont(score, 0.5) q50, quantile_cont(score, 0.95) q95 from (
  select category, model, uid, avg(score) score from battles group by 1, 2, 3) group by 1, 2""",
)
def _(t):
    per_question = L.model_scores(_valid(t), ["category", "model", "uid"])
    q = F.percentile("score", F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    return per_question.groupBy("category", "model").agg(q.alias("q")).select(
        "category", "model", *[F.col("q")[i].alias(n) for i, n in enumerate(("q05", "q50", "q95"))]
    )


@query(
    "a4_exact_quantiles",
    """
select l_returnflag, q, case q when 0.05 then quantile_cont(l_extendedprice::double, 0.05) when 0.5 then quantile_cont(l_extendedprice::double, 0.5)
       when 0.95 then quantile_cont(l_extendedprice::double, 0.95) end quantile, count(*) n
from lineitem, (values (0.05::double), (0.5), (0.95)) p(q) group by 1, 2""",
)
def _(t):
    """Few groups of many values: no task holds a group."""
    return exact_quantiles(t.table("lineitem"), ["l_returnflag"], "l_extendedprice", [0.05, 0.5, 0.95], scratch_dir(t.spark, "quantiles"))


@query(
    "a4_battle_quantiles",
    """
select category, model, q, case q when 0.05 then quantile_cont(score, 0.05) when 0.5 then quantile_cont(score, 0.5) else quantile_cont(score, 0.95) end quantile,
       count(*) n
from battles, (values (0.05::double), (0.5), (0.95)) p(q) group by 1, 2, 3""",
)
def _(t):
    """Raw battles: three values hold everything, so ties meet before anything is sorted."""
    rows = J.battle_rows(_valid(t))
    return exact_quantiles(rows, ["category", "model"], "score", [0.05, 0.5, 0.95], scratch_dir(t.spark, "quantiles"))


# -- style --------------------------------------------------------------------

_STYLE_BATTLES_SQL = f"""
with feats as (select a.file_name, a.uid, a.model, x.n, x.h, x.l, x.b from answers a join ({_FEATURES_SQL}) x
               on x.file_name = a.file_name and x.ord = a.ord),
styles as (
  select uid, regexp_replace(f.model, '^.*/', '') model, n, h, l, b from feats f
  join (select regexp_replace(model, '^.*/', '') short, arg_max(model, first_file) model from answers group by 1) w using (model)),
j as (
  select bt.*, c.n cn, g.n gn, c.h / (c.n + 1) ch, g.h / (g.n + 1) gh, c.l / (c.n + 1) cl, g.l / (g.n + 1) gl,
         c.b / (c.n + 1) cb, g.b / (g.n + 1) gb
  from battles bt join settings s using (category)
  join styles c on c.uid = bt.uid and c.model = bt.model
  join styles g on g.uid = bt.uid and g.model = s.baseline),
diffs as (
  select uid, model, category, score, (cn - gn) / greatest(cn + gn, 1) length, (ch - gh) / (ch + gh + 1) headers,
         (cl - gl) / (cl + gl + 1) lists, (cb - gb) / (cb + gb + 1) bolds from j)
"""


@query(
    "j9_style_joined_battles",
    _STYLE_BATTLES_SQL
    + """
select category, model, uid, score, count(*) count, round(any_value(length), 9) length, round(any_value(headers), 9) headers,
       round(any_value(lists), 9) lists, round(any_value(bolds), 9) bolds from diffs group by 1, 2, 3, 4""",
)
def _(t):
    battles = SB.with_style_difference(SB.counted_battles(_valid(t)), lookup(t), t.settings())
    return battles.select(
        "category", "model", "uid", "score", "count", *[F.round(f, 9).alias(f) for f in S.FEATURES]
    )


@query(
    "a5_feature_moments",
    _STYLE_BATTLES_SQL
    + "select category, count(*) battles, "
    + ", ".join(f"round(avg({f}), 9) {f}_mean, round(case when coalesce(stddev_samp({f}), 0) < 1e-9 then 1 else stddev_samp({f}) end, 9) {f}_std" for f in S.FEATURES)
    + " from diffs group by 1",
)
def _(t):
    battles = SB.with_style_difference(SB.counted_battles(_valid(t)), lookup(t), t.settings())
    moments = SB.feature_moments(battles)
    names = [c for c in moments.columns if c not in ("category", "battles")]
    return moments.select("category", "battles", *[F.round(c, 9).alias(c) for c in names])


@query(
    "a6_design_rows",
    _STYLE_BATTLES_SQL
    + """,
m as (select category, avg(length) a1, stddev_samp(length) d1, avg(headers) a2, stddev_samp(headers) d2,
             avg(lists) a3, stddev_samp(lists) d3, avg(bolds) a4, stddev_samp(bolds) d4 from diffs group by 1)
select d.category, d.uid, d.model term, 1.0 own, d.score, count(*) count,
  """
    + ", ".join(
        f"round(any_value(case when coalesce(d{i}, 0) < 1e-9 then {f} - a{i} else ({f} - a{i}) / d{i} end), 7) {f}" for i, f in enumerate(S.FEATURES, 1)
    )
    + """
from diffs d join m using (category) join settings s using (category) where d.model <> s.baseline group by 1, 2, 3, 5""",
)
def _(t):
    """The sparse design the fit reads: one strength column per row and the standardised features.

    The baseline's column is dropped, so a row has its model's column only.
    """
    battles = SB.fit_input(_valid(t), lookup(t), t.settings())
    moments = SB.feature_moments(battles)
    rows = battles.where(~F.col("own")).join(moments, "category")
    z = [F.round((F.col(f) - F.col(f"{f}_mean")) / F.col(f"{f}_std"), 7).alias(f) for f in S.FEATURES]
    return rows.select("category", "uid", F.col("model").alias("term"), F.lit(1.0).alias("own"), "score", "count", *z)


_FIT_TERMS_SQL = (
    _STYLE_BATTLES_SQL
    + """,
fitted as (select distinct d.category, d.model from diffs d join settings s using (category) where d.model <> s.baseline),
terms as (select category, model term from fitted union all
          select category, f.term from (select distinct category from fitted) cross join (values ('length'), ('headers'), ('lists'), ('bolds')) f(term))
"""
)


def _fitted(t, rounds):
    ready = PF.stored_battles(SB.fit_input(_valid(t), lookup(t), t.settings()), list(S.FEATURES))
    return ready, PF.fit_rounds(ready, list(S.FEATURES), rounds=rounds)


def _residuals(ready, fit, features):
    """First-order conditions of round 0, from the exported coefficients alone: no code of the fit is used.

    The features are standardised here with plain aggregates over the battles' counts.
    """
    n = F.sum("count")
    mean = lambda f: F.sum(F.col(f) * F.col("count")) / n
    means = ready.groupBy("category").agg(n.alias("n"), *[mean(f).alias(f"{f}_m") for f in features])
    off = lambda f: F.col(f) - F.col(f"{f}_m")
    spread = ready.join(means, "category").groupBy("category").agg(
        *[F.sqrt(F.sum(off(f) ** 2 * F.col("count")) / (F.sum("count") - 1)).alias(f"{f}_s") for f in features]
    )
    effects = fit.effects.where("round = 0").groupBy("category").pivot("feature", list(features)).agg(F.first("effect"))
    effects = effects.select("category", *[F.col(f).alias(f"{f}_e") for f in features])
    rows = ready.where(~F.col("own")).join(means, "category").join(spread, "category").join(effects, "category")
    rows = rows.join(fit.strengths.where("round = 0").select("category", "model", "strength"), ["category", "model"])
    scaled = {f: off(f) / F.when(F.col(f"{f}_s") > 1e-9, F.col(f"{f}_s")).otherwise(1.0) for f in features}
    logit = F.col("strength") + sum((scaled[f] * F.col(f"{f}_e") for f in features), F.lit(0.0))
    left = F.col("count") * (F.col("score") - 1 / (1 + F.exp(-logit)))
    terms = F.array(F.struct(F.col("model").alias("term"), left.alias("v")), *[F.struct(F.lit(f).alias("term"), (left * z).alias("v")) for f, z in scaled.items()])
    per_term = rows.select("category", "n", F.explode(terms).alias("t")).groupBy("category", "n", "t.term").agg(F.sum("t.v").alias("v"))
    return per_term.select("category", "term", (F.col("v") / F.col("n")).alias("residual"))


@query("a7_pairwise_fit", _FIT_TERMS_SQL + "select category, term, 0.0::double residual, true converged from terms")
def _(t):
    """Full-sample fit: at its coefficients every term's first-order residual per battle is zero."""
    ready, fit = _fitted(t, 0)
    left = _residuals(ready, fit, S.FEATURES).join(fit.rounds.where("round = 0"), "category")
    return left.select("category", "term", F.abs(F.round("residual", 5)).alias("residual"), "converged")


def _plain_fit(t):
    """A fit without style: its likelihood has a closed solution, the log odds of the mean score."""
    battles = SB.counted_battles(_valid(t)).join(t.settings().select("category", F.col("baseline_short").alias("baseline")), "category")
    ready = battles.select(
        "category",
        "model",
        (F.col("model") == F.col("baseline")).alias("own"),
        "score",
        "count",
        F.xxhash64("category", "model", "uid", "score").alias("row_key"),
        F.lit(0.0).alias("nothing"),
    )
    return PF.fit_rounds(ready, ["nothing"], rounds=0)


_PLAIN_SQL = """
with fitted as (select b.category, b.model, avg(b.score) p from battles b join settings s using (category) where b.model <> s.baseline group by 1, 2)
"""


@query("a7_plain_strengths", _PLAIN_SQL + "select category, model, round(ln(p / (1 - p)), 4) strength from fitted")
def _(t):
    """Strengths of a fit without style against their closed form."""
    return _plain_fit(t).strengths.select("category", "model", F.round("strength", 4).alias("strength"))


@query("a7_fitted_terms")
def _(t):
    """Coefficients of the full sample: strengths and style effects."""
    _, fit = _fitted(t, 0)
    strengths = fit.strengths.select("category", F.col("model").alias("term"), F.round("strength", 6).alias("value"))
    return strengths.unionByName(fit.effects.select("category", F.col("feature").alias("term"), F.round("effect", 6).alias("value")))


@query(
    "a8_fit_residuals",
    _FIT_TERMS_SQL + "select category, r::int round, term, 0.0::double residual, true converged from terms cross join range(4) x(r)",
)
def _(t):
    """Three resamples and the full sample: the first-order residual of every term is zero."""
    ready, fit = _fitted(t, 3)
    left = PF.fit_residuals(ready, fit, list(S.FEATURES)).join(fit.rounds, ["category", "round"])
    return left.select("category", "round", "term", F.abs(F.round("residual", 5)).alias("residual"), "converged")


@query("a8_bootstrap_fits")
def _(t):
    """Strengths of every model in each of 100 resamples."""
    return _fitted(t, 100)[1].strengths.where("round > 0")


@query(
    "a9_win_probability",
    _FIT_TERMS_SQL
    + """,
plain as (select b.category, b.model, avg(b.score) p from battles b join settings s using (category) where b.model <> s.baseline group by 1, 2),
styled as (select category, model, true inside, 1.0::double both_sides from fitted
           union all select distinct category, baseline, true, 1.0::double from settings join fitted using (category))
select category, model, inside, both_sides, round(p, 4) chance, round(1 - p, 4) other from styled full join plain using (category, model)""",
)
def _(t):
    """Chances from strengths fitted with style and without.

    With style, of all models and baselines: between 0 and 1, and both sides of a battle add
    up to one. Without, the chances of beating and of losing to the baseline are the mean scores.
    """
    _, fit = _fitted(t, 0)
    base = t.settings().select("category", F.col("baseline_short").alias("model"), F.lit(0.0).alias("strength"))
    strengths = fit.strengths.select("category", "model", "strength")
    rows = strengths.unionByName(base.join(strengths.select("category").distinct(), "category", "left_semi"))
    chance = PF.win_probability(F.col("strength"), F.lit(0.0))
    other = PF.win_probability(F.lit(0.0), F.col("strength"))
    styled = rows.select("category", "model", ((chance > 0) & (chance < 1)).alias("inside"), F.round(chance + other, 9).alias("both_sides"))
    plain = _plain_fit(t).strengths.select("category", "model", F.round(chance, 4).alias("chance"), F.round(other, 4).alias("other"))
    return styled.join(plain, ["category", "model"], "full_outer")


@query("a10_style_leaderboard")
def _(t):
    """Length- and markdown-controlled board of all categories, 100 rounds."""
    return SB.style_leaderboard(_valid(t), lookup(t), t.settings(), rounds=100)


@query("a10_style_leaderboard_length")
def _(t):
    return SB.style_leaderboard(_valid(t), lookup(t), t.settings(), ["length"], rounds=100)


_BOARD_SQL = (
    _FIT_TERMS_SQL
    + """
select category, model, true ordered, 0.0::double off_median, false is_base from fitted
union all select distinct b.category, s.baseline, true, 0.0::double, true from battles b join settings s using (category)"""
)


def _board_checks(t, controls):
    """A board against the resampled fits: bounds in order, score equal to the median chance."""
    valid, styles, settings = _valid(t), lookup(t), t.settings()
    board = SB.style_leaderboard(valid, styles, settings, controls, rounds=9)
    fits = PF.fit_rounds(SB.fit_input(valid, styles, settings), SB.control_columns(controls), rounds=9).strengths.where("round > 0")
    medians = fits.groupBy("category", "model").agg(F.percentile(PF.win_probability(F.col("strength")), F.lit(0.5)).alias("m"))
    off = F.round(F.abs(F.col("score") - F.coalesce("m", F.lit(0.5))), 6)
    ordered = (F.col("lower") <= F.col("score")) & (F.col("score") <= F.col("upper"))
    return board.join(medians, ["category", "model"], "left").select(
        "category", "model", ordered.alias("ordered"), off.alias("off_median"), F.col("m").isNull().alias("is_base")
    )


@query("a10_style_board_checks", _BOARD_SQL)
def _(t):
    return _board_checks(t, ["length", "markdown"])


@query("f5_markdown_board_checks", _BOARD_SQL)
def _(t):
    """The board controlled for markdown only."""
    return _board_checks(t, ["markdown"])


@query(
    "k7_text_leaderboard",
    """
with s as (select category, model, round(avg(score) * 100, 1) pct from battles group by 1, 2
           union all select category, baseline, 50.0 from settings),
x as (select category, model, pct, printf('%.1f', pct) p, '(-0.0 / +0.0)' ci from s),
w as (select category, max(greatest(length(model), 5)) w1, max(greatest(length(p), 10)) w2, max(greatest(length(ci), 6)) w3 from x group by 1)
select category, 0 line_no, concat_ws('  ', rpad('Model', w1::int, ' '), rpad('Scores (%)', w2::int, ' '), rpad('CI (%)', w3::int, ' ')) line from w
union all
select category, row_number() over (partition by category order by pct desc, model),
       concat_ws('  ', rpad(model, w1::int, ' '), rpad(p, w2::int, ' '), rpad(ci, w3::int, ' ')) from x join w using (category)""",
)
def _(t):
    scores = L.model_scores(_valid(t))
    board = scores.withColumns({"lower": F.col("score"), "upper": F.col("score")})
    return L.text_table(L.add_baseline_rows(board, t.settings()))


# -- pairs and counts ---------------------------------------------------------


@query("a11_filter_counts", f"select count(*) total, count_if({_KEPT}) kept from ({_MIRRORED_SQL})")
def _(t):
    return P.filter_counts(_mirrored_pairs(t))


@query("a11_observed_counts", f"select count(*) total, count_if({_KEPT}) kept from ({_MIRRORED_SQL})")
def _(t):
    """The same totals, counted in the pass that writes the kept pairs."""
    counts = Observation()
    P.filter_and_count(_mirrored_pairs(t), counts).write.parquet(scratch_dir(t.spark, "kept"))
    return t.spark.createDataFrame([(counts.get["total"], counts.get["kept"])], "total bigint, kept bigint")


@query("a12_winner_counts", WIN_RATES_SQL + "select key, cast(n as bigint) n from counts")
def _(t):
    return TA.winner_counts(TA.stored_results(t.view("results")), NAMES)


@query(
    "a13_win_rates",
    WIN_RATES_SQL
    + """
select key, cast(n as bigint) n, cast((select sum(n) from counts) as bigint) total,
       case when key <> 'TIE' then round(n / (select sum(n) from counts where key <> 'TIE'), 9) end win_rate from counts""",
)
def _(t):
    rates = TA.win_rates(TA.winner_counts(TA.stored_results(t.view("results")), NAMES))
    return rates.withColumn("win_rate", F.round("win_rate", 9))


@query("a14_best_and_worst", "select prompt_id, best, worst from ranked_lines")
def _(t):
    scored = P.rankable(t.rollouts()).select("prompt_id", "responses", F.explode("kept").alias("pos"))
    score = (F.length(F.element_at("responses", F.col("pos") + 1)) % 7).cast("double")
    return P.best_and_worst(scored.select("prompt_id", "pos", score.alias("score")))


@query("a14_best_and_worst_in_row", "select prompt_id, best, worst from ranked_lines")
def _(t):
    ranked = P.rankable(t.rollouts())
    scores = F.transform(
        P.pick(F.col("responses"), F.col("kept")), lambda r: (F.length(r) % 7).cast("double")
    )
    picked = P.best_and_worst_in_row(F.col("kept"), scores, F.col("prompt_id"))
    return ranked.select("prompt_id", picked.alias("w")).select("prompt_id", "w.*")


@query(
    "a15_generation_totals",
    f"""
select d.lang, count(*) sequences, sum(len(regexp_extract_all(response, '[^{WSC}]+'))) tokens
from rollout_lines r join documents d on d.doc_id = r.prompt_id group by 1""",
)
def _(t):
    from duelboard.functions.text import word_count

    langs = t.table("documents").select(F.col("doc_id").alias("prompt_id"), "lang")
    lines = t.rollouts().select("prompt_id", F.explode("responses").alias("r"))
    counted = lines.groupBy("prompt_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(word_count(F.col("r"))).alias("k")
    )
    return counted.join(langs, "prompt_id").groupBy("lang").agg(
        F.sum("n").alias("sequences"), F.sum("k").alias("tokens")
    )


@query(
    "a15_observed_totals",
    """
select count(*) sequences, sum(len(list_filter(string_split(text, ' '), lambda x: x <> '')))::bigint tokens from documents""",
)
def _(t):
    """Sequences and tokens, counted in the pass that writes them."""
    counts = Observation()
    rows = t.table("documents").select("doc_id", F.split("text", " ").alias("ids"))
    P.count_tokens(rows, counts, "ids", "").write.parquet(scratch_dir(t.spark, "tokens"))
    return t.spark.createDataFrame([(counts.get["sequences"], counts.get["tokens"])], "sequences bigint, tokens bigint")


@query(
    "a16_unpadded_tokens",
    """
select source, count(*) sequences, sum(len(list_filter(string_split(text, ' '), lambda x: x <> ''))) tokens from documents group by 1""",
)
def _(t):
    """Ids are word lengths; 0 (from a doubled blank) is padding."""
    ids = F.transform(F.split("text", " "), lambda w: F.length(w))
    rows = t.table("documents").select("source", ids.alias("ids"))
    return P.token_totals(rows, ["source"], "ids", pad=0)


@query(
    "a17_all_baseline_guard",
    """
select case when count(*) = count_if(baseline = 'o3-mini-2025-01-31') then 'nothing to judge' else 'pending' end state,
       count_if(baseline = 'o3-mini-2025-01-31') own_baseline from questions join settings using (category)""",
)
def _(t):
    from duelboard.operators.requests import with_settings
    from duelboard.sources.readers import require_rows

    rows = require_rows(with_settings(t.view("questions"), t.settings()), "no questions")
    own = F.count_if(F.col("baseline") == "o3-mini-2025-01-31")
    state = F.when(own == F.count(F.lit(1)), "nothing to judge").otherwise("pending")
    return rows.agg(state.alias("state"), own.alias("own_baseline"))


@query(
    "a18_usage_totals",
    """
select judge, model, count(*) calls, sum(prompt_tokens) prompt_tokens, cast(0 as bigint) completion_tokens,
       sum(prompt_tokens + 7) total_tokens from judgments_raw group by 1, 2""",
)
def _(t):
    return TA.usage_totals(t.judgments(), ["judge", "model"])


@query(
    "a19_position_consistency",
    """
select judge, category, count(*) pairs, round(avg(case when s2.score = 1 - s1.score then 1.0 else 0.0 end), 9) consistency,
       round(avg((s1.score + s2.score) / 2), 9) first_position_score
from valid_judgments join label_scores s1 on s1.label = g1 join label_scores s2 on s2.label = g2 group by 1, 2""",
)
def _(t):
    rows = TA.position_consistency(_valid(t), ["judge", "category"])
    return rows.withColumns(
        {c: F.round(c, 9) for c in ("consistency", "first_position_score")}
    )
