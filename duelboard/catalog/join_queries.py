"""Queries for joins, keyed selections, orders and set operations (J*, W*, L*, U*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.catalog.column_queries import _mixed_messages  # noqa: F401  (loads first)
from duelboard.catalog.column_queries import quoted, sql_fill
from duelboard.catalog.registry import query
from duelboard.functions import prompts as PR
from duelboard.functions import transcripts as TR
from duelboard.operators import judgments as J
from duelboard.operators import keyed as KY
from duelboard.operators import leaderboard as L
from duelboard.operators import multiway as M
from duelboard.operators import pairs as P
from duelboard.operators import requests as Q
from duelboard.operators import turns as TN
from duelboard.operators.ordinal import round_robin, with_ordinal
from duelboard.plans.judging import pending_games
from duelboard.session import scratch_dir
from duelboard.sources import readers as R
from duelboard.sources.bucketed import read_bucketed, write_bucketed

NAMES = ["chosen", "sft", "beta_dpo"]
TARGET = "org/sft"
#: Buckets of the stores in these queries; a real store has as many as its size asks for.
BUCKETS = 16


def _judged(t):
    """Stored judgments of the target by one judge, the last row per question."""
    rows = t.judgments().where((F.col("judge") == "gpt-4.1") & (F.col("model") == TARGET))
    return KY.keep_last(rows.select("uid", "category", "judge", "model", "games", "ord"), ["uid"])


def _bucketed(t, rows, keys):
    """The rows stored in two appends and read as a bucketed store."""
    path = scratch_dir(t.spark, "bucketed")
    half = F.pmod(F.xxhash64(*keys), F.lit(2))
    for k in range(2):
        write_bucketed(rows.where(half == k), path, keys, BUCKETS)
    return read_bucketed(t.spark, path, rows.schema, keys, BUCKETS)


_JUDGED_SQL = f"""
judged as (
  select uid, max(ord) ord, arg_max(n_games = 2 and null_game = 0 and g1 is not null and g2 is not null, ord) complete
  from judgments_raw where judge = 'gpt-4.1' and model = '{TARGET}' group by 1)"""


@query(
    "j1_unanswered_questions",
    "select uid, category, ord from questions where uid not in (select uid from answers where model = 'org/sft')",
)
def _(t):
    own = t.answers().where(F.col("model") == TARGET)
    return Q.unanswered(t.view("questions"), own).select("uid", "category", "ord")


@query(
    "j2_unjudged_questions",
    f"""
with {_JUDGED_SQL}
select q.uid, category, ord, baseline from questions q join settings using (category)
where baseline <> '{TARGET}' and q.uid not in (select uid from judged where complete)""",
)
def _(t):
    pending = Q.unjudged(t.view("questions"), _judged(t), TARGET, t.settings())
    return pending.select("uid", "category", "ord", "baseline")


@query(
    "j2_unjudged_bucketed",
    f"""
with {_JUDGED_SQL}
select q.uid, category, ord, baseline from questions q join settings using (category)
where baseline <> '{TARGET}' and q.uid not in (select uid from judged where complete)""",
)
def _(t):
    """The same against a store dealt into buckets, which is not moved."""
    pending = Q.unjudged(t.view("questions"), _bucketed(t, _judged(t), ["uid"]), TARGET, t.settings())
    return pending.select("uid", "category", "ord", "baseline")


_GAPS_SQL = """
with expected as (
  select uid, ord, 'org/sft' model from questions
  union all select uid, ord, baseline from questions join settings using (category))
select uid, ord, model from expected e
where not exists (select 1 from answers a where a.uid = e.uid and a.model = e.model)"""


@query("j3_coverage_gaps", _GAPS_SQL)
def _(t):
    gaps = Q.coverage_gaps(t.view("questions"), t.answers(), TARGET, t.settings())
    return gaps.select("uid", "ord", "model")


@query(
    "j4_missing_baselines",
    """
select distinct baseline model from questions join settings using (category)
where baseline not in (select model from answers where model <> 'gemini-2.0-flash-001')""",
)
def _(t):
    answers = t.answers().where(F.col("model") != "gemini-2.0-flash-001")
    return Q.missing_baselines(t.view("questions"), answers, TARGET, t.settings())


_PAIRED_SQL = """
select q.uid, q.category, q.ord, q.prompt, s.baseline, s.system_prompt, a.answer target_answer, b.answer baseline_answer
from questions q join settings s using (category)
join answers a on a.uid = q.uid and a.model = 'org/sft'
join answers b on b.uid = q.uid and b.model = s.baseline"""


@query(
    "j5_paired_answers",
    f"select uid, baseline, md5(target_answer) target_md5, md5(baseline_answer) baseline_md5 from ({_PAIRED_SQL})",
)
def _(t):
    questions = Q.with_settings(t.view("questions"), t.settings())
    paired = Q.with_answers(questions, t.answers(), TARGET, Q.baseline_models(t.settings()))
    return paired.select(
        "uid",
        "baseline",
        F.md5("target_answer").alias("target_md5"),
        F.md5("baseline_answer").alias("baseline_md5"),
    )


@query(
    "j6_category_settings",
    """
select uid, coalesce(baseline, 'unknown') baseline, md5(coalesce(system_prompt, '')) prompt_md5
from questions_raw left join settings using (category)""",
)
def _(t):
    rows = t.view("questions_raw")
    known = Q.with_settings(rows, t.settings()).select(
        "uid", "baseline", F.md5("system_prompt").alias("prompt_md5")
    )
    unknown = Q.unknown_categories(rows, t.settings()).select(
        "uid", F.lit("unknown").alias("baseline"), F.md5(F.lit("")).alias("prompt_md5")
    )
    return known.unionByName(unknown)


@query(
    "j7_swapped_games",
    f"""
with {_JUDGED_SQL}, p as ({_PAIRED_SQL}), g as (
  select *, 1 game_no, 'baseline_vs_candidate' round_label, baseline_answer a, target_answer b from p
  union all select *, 2, 'candidate_vs_baseline', target_answer, baseline_answer from p)
select uid, category, game_no, round_label, md5({sql_fill(K.JUDGE_TEMPLATE, QUESTION="prompt", ANSWER_A="a", ANSWER_B="b")}) prompt_md5
from g where uid not in (select uid from judged where complete)""",
)
def _(t):
    games = pending_games(t.view("questions"), t.answers(), _judged(t), TARGET, t.settings())
    return Q.judge_requests(games).select(
        "uid", "category", "game_no", "round_label", F.md5(F.col("messages")[1]["content"]).alias("prompt_md5")
    )


_COMMON_SQL = """
first_outputs as (
  select name, instruction, arg_min(output, ord) output from candidates
  where instruction <> '' and output is not null group by 1, 2),
common as (
  select a.instruction, a.output o1, b.output o2, c.output o3
  from first_outputs a join first_outputs b using (instruction) join first_outputs c using (instruction)
  where a.name = 'chosen' and b.name = 'sft' and c.name = 'beta_dpo')"""


@query(
    "j8_common_instructions",
    f"with {_COMMON_SQL} select instruction, o1, o2, o3 from common",
)
def _(t):
    common = M.common_instructions(t.view("candidates"), NAMES)
    return common.select(
        "instruction", *[F.col("outputs")[i]["output"].alias(f"o{i + 1}") for i in range(3)]
    )


@query(
    "j8_common_instruction_counts",
    f"""
with {_COMMON_SQL}
select count(distinct instruction) instructions, (select count(*) from common) shared,
       count(distinct instruction) - (select count(*) from common) dropped from first_outputs""",
)
def _(t):
    return M.coverage_counts(t.view("candidates"), NAMES)


@query(
    "j10_unjudged_instructions",
    f"""
with {_COMMON_SQL} select instruction from common
where instruction not in (select instruction from results where instruction is not null and ord % 3 = 0)""",
)
def _(t):
    common = M.common_instructions(t.view("candidates"), NAMES)
    return M.unseen(common, t.view("results").where("ord % 3 = 0")).select("instruction")


@query(
    "j10_unjudged_bucketed",
    f"""
with {_COMMON_SQL} select instruction from common
where instruction not in (select instruction from results where instruction is not null and ord % 3 = 0)""",
)
def _(t):
    """The same against results dealt into buckets by instruction."""
    done = t.view("results").where("ord % 3 = 0 and instruction is not null").select("instruction", "winner_key", "ord")
    common = M.common_instructions(t.view("candidates"), NAMES)
    return M.unseen(common, _bucketed(t, done, ["instruction"])).select("instruction")


_ORDER_SQL = """
labelled as (
  select instruction, list(struct_pack(k := md5(concat('42-', instruction, '-', name)), name := name, output := output)
                           order by md5(concat('42-', instruction, '-', name))) o
  from (select instruction, unnest(['chosen', 'sft', 'beta_dpo']) name, unnest([o1, o2, o3]) output from common)
  group by 1)"""


@query(
    "j11_winner_name",
    f"""
with {_COMMON_SQL}, {_ORDER_SQL},
r as (select *, case length(o[1].output) % 5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'TIE' else 'A' end w
      from labelled)
select instruction, w winner, case w when 'A' then o[1].name when 'B' then o[2].name when 'C' then o[3].name else w end winner_key from r""",
)
def _(t):
    labelled = M.label_candidates(M.common_instructions(t.view("candidates"), NAMES))
    pick = F.length(F.col("ordered")[0]["output"]) % 5
    word = F.element_at(F.array(*[F.lit(x) for x in ("A", "B", "C", "neither. TIE", "A")]), pick + 1)
    replies = labelled.withColumn("reply", F.concat(F.lit("Winner: "), word))
    # "neither. TIE" is no valid winner line, the word search then finds TIE
    return M.read_results(replies, "judge-x").select("instruction", "winner", "winner_key")


@query(
    "j12_pair_responses",
    """
select r.prompt_id, b.response best_response, w.response worst_response from ranked_lines r
join rollout_lines b on b.prompt_id = r.prompt_id and b.pos = r.best
join rollout_lines w on w.prompt_id = r.prompt_id and w.pos = r.worst""",
)
def _(t):
    ranked = P.rankable(t.rollouts())
    scores = F.transform(
        P.pick(F.col("responses"), F.col("kept")), lambda r: (F.length(r) % 7).cast("double")
    )
    pairs = P.preference_pairs(
        ranked.withColumn("scores", scores), P.run_metadata("rollout", 42, 8, "g", "r")
    )
    return pairs.select(
        "prompt_id",
        F.col("chosen")[0]["content"].alias("best_response"),
        F.col("rejected")[0]["content"].alias("worst_response"),
    )


@query(
    "j13_question_order",
    """
select j.uid, q.ord question_ord, j.ord from judgments_raw j join questions q using (uid)""",
)
def _(t):
    rows = t.judgments().select("uid", "ord")
    return KY.in_question_order(rows, t.view("questions")).select("uid", "question_ord", "ord")


@query(
    "j14_question_output_pairing",
    "select q.uid, md5(prompt) prompt_md5, md5(answer) answer_md5 from questions q join answers a using (uid) where model = 'lab/e-dpo'",
)
def _(t):
    outputs = t.answers().where("model = 'lab/e-dpo'").select("uid", "answer")
    paired = t.view("questions").join(outputs, "uid")
    return paired.select("uid", F.md5("prompt").alias("prompt_md5"), F.md5("answer").alias("answer_md5"))


@query(
    "j15_reference_responses",
    """
select ord, case when c.m[-1].role = 'assistant' then c.m[-1].content end chosen,
       case when r.m[-1].role = 'assistant' then r.m[-1].content end rejected
from (select ord, m from dialogue_messages where side = 'text') c
left join (select ord, m from dialogue_messages where side = 'rejected') r using (ord)""",
)
def _(t):
    last = lambda c: TR.prompt_and_reference(TR.parse_transcript(F.col(c)))["reference"]
    return t.view("dialogues").select(
        "ord", last("text").alias("chosen"), last("rejected").alias("rejected")
    )


# -- keyed selections ---------------------------------------------------------


@query(
    "w1_keep_first",
    "select name, instruction, arg_min(output, ord) output, min(ord) ord from candidates "
    "where instruction <> '' and output is not null group by 1, 2",
)
def _(t):
    return M.first_outputs(t.view("candidates"))


@query(
    "w2_keep_last",
    "select file_name, uid, max(ord) ord, arg_max(md5(answer), ord) answer_md5 from answers_raw group by 1, 2",
)
def _(t):
    rows = t.view("answers_raw").select("file_name", "uid", "ord", F.md5("answer").alias("answer_md5"))
    return KY.keep_last(rows, ["file_name", "uid"])


@query(
    "w3_last_file_per_model",
    """
select model, max(file_name) file_name, count(*) n, min(first_file) first_file from (
  select a.*, w.first_file from answers_raw a
  join (select model, max(file_name) file_name, min(file_name) first_file from answers_raw group by 1) w
  using (model, file_name)) group by 1""",
)
def _(t):
    rows = KY.current_files(t.view("answers_raw"))
    return rows.groupBy("model").agg(
        F.max("file_name").alias("file_name"), F.count(F.lit(1)).alias("n"), F.min("first_file").alias("first_file")
    )


@query(
    "w4_running_history",
    """
select conv_id, turn, coalesce(sum(n) over w, 0) history_messages, coalesce(sum(chars) over w, 0) history_chars,
       coalesce(sum(u) over w, 0) history_user
from (select *, 1 n, length(text) chars, case when role = 'user' then 1 else 0 end u from conversations)
window w as (partition by conv_id order by turn rows between unbounded preceding and 1 preceding)""",
)
def _(t):
    measures = {
        "history_messages": F.lit(1),
        "history_chars": F.length("text"),
        "history_user": F.when(F.col("role") == "user", 1).otherwise(0),
    }
    rows = t.table("conversations").select("conv_id", "turn", "role", "text")
    return TN.running_totals(rows, "conv_id", "turn", measures).drop("role", "text")


@query(
    "w4_running_prompts",
    f"""
with f as (select question_id, turns, unnest(range(len(turns))) turn from turn_questions where len(turns) > 0)
select question_id, turn, concat('<|im_start|>system', chr(10), {quoted(K.CHATML_DEFAULT_SYSTEM)}, '<|im_end|>', chr(10),
       array_to_string(list_transform(turns[1:turn], lambda x: concat('<|im_start|>user', chr(10), x, '<|im_end|>', chr(10),
          '<|im_start|>assistant', chr(10), 're: ', x, '<|im_end|>', chr(10))), ''),
       '<|im_start|>user', chr(10), turns[turn + 1], '<|im_end|>', chr(10), '<|im_start|>assistant', chr(10)) prompt from f""",
)
def _(t):
    questions = TN.normalize_turn_questions(t.turn_questions_raw())
    answered = questions.withColumn("outputs", F.transform("turns", lambda x: F.concat(F.lit("re: "), x)))
    prompts = TN.running_prompts(answered)
    return prompts.select("question_id", "turn", PR.render_chatml(F.col("messages")).alias("prompt"))


@query(
    "w5_split_final_turn",
    """
select ord, len(m) - 1 n_prompt, m[-1].role last_role, m[-1].content last_content
from dialogue_messages where side = 'text' and len(m) > 0""",
)
def _(t):
    rows = t.view("dialogues").select("ord", TR.parse_transcript(F.col("text")).alias("m")).where(F.size("m") > 0)
    last = TR.last_message(F.col("m"))
    return rows.select(
        "ord",
        F.size(TR.all_but_last(F.col("m"))).alias("n_prompt"),
        last["role"].alias("last_role"),
        last["content"].alias("last_content"),
    )


@query(
    "w6_label_order",
    f"with {_COMMON_SQL}, {_ORDER_SQL} select instruction, o[1].name a, o[2].name b, o[3].name c from labelled",
)
def _(t):
    labelled = M.label_candidates(M.common_instructions(t.view("candidates"), NAMES))
    return labelled.select("instruction", *[F.col("labels")[x].alias(x.lower()) for x in "ABC"])


@query("w6_label_order_twister")
def _(t):
    """Label order of earlier runs (Mersenne Twister); SQL cannot express it."""
    labelled = M.label_candidates(M.common_instructions(t.view("candidates"), NAMES), order="twister")
    return labelled.select("instruction", *[F.col("labels")[x].alias(x.lower()) for x in "ABC"])


@query(
    "w7_input_order",
    "select lang, count(*) n, 0 out_of_order from documents group by 1",
)
def _(t):
    """Rows read back from JSON keep their order through (offset, id).

    Files are written in id order, so of two neighbouring ids in one file the
    larger one must have the larger reading order.
    """
    from duelboard.sources.writers import write_jsonl

    path = scratch_dir(t.spark, "ordered")
    rows = t.table("documents").select("doc_id", "lang", "text")
    write_jsonl(rows.repartitionByRange(8, "doc_id").sortWithinPartitions("doc_id"), path)
    back = R.with_input_order(R.read_jsonl(t.spark, path, "doc_id bigint, lang string, text string"))
    here = back.select("doc_id", "lang", "file_name", "ord")
    following = back.select(
        (F.col("doc_id") - 1).alias("doc_id"), "file_name", F.col("ord").alias("next_ord")
    )
    wrong = F.col("next_ord").isNotNull() & (F.col("next_ord") <= F.col("ord"))
    return here.join(following, ["doc_id", "file_name"], "left").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(wrong).alias("out_of_order")
    )


@query(
    "w8_even_assignment",
    "select uid, ('0x' || substr(md5(uid), 1, 8))::bigint % 5 shard from questions",
)
def _(t):
    return Q.assign_shards(t.view("questions"), "uid", 5).select("uid", "shard")


@query(
    "w7_dense_ordinal",
    "select doc_id, row_number() over (order by source, doc_id desc) - 1 ordinal from documents",
)
def _(t):
    """Gapless numbers in a global order, without one task that sees all rows."""
    rows = t.table("documents").select("doc_id", "source", (-F.col("doc_id")).alias("back"))
    return with_ordinal(rows, scratch_dir(t.spark, "ordinal"), ["source", "back"]).select("doc_id", "ordinal")


@query(
    "w8_round_robin",
    "select uid, ((row_number() over (order by ord) - 1) % 5)::int shard from questions",
)
def _(t):
    """Requests dealt in turn: shards differ by one row at most."""
    rows = t.view("questions").select("uid", "ord")
    return round_robin(rows, 5, scratch_dir(t.spark, "turns"), ["ord"]).select("uid", "shard")


# -- orders and limits --------------------------------------------------------


@query(
    "l1_first_in_order",
    "select uid, ord from questions_raw where uid is not null and trim(prompt, chr(32) || chr(10)) <> '' order by ord limit 25",
)
def _(t):
    return R.normalize_questions(t.view("questions_raw"), 25).select("uid", "ord")


@query(
    "l2_first_instructions",
    f"with {_COMMON_SQL} select instruction, o1 from common order by instruction limit 40",
)
def _(t):
    common = M.first_instructions(M.common_instructions(t.view("candidates"), NAMES), 40)
    return common.select("instruction", F.col("outputs")[0]["output"].alias("o1"))


@query(
    "l3_stop_after_limit",
    "select prompt_id, best, worst from ranked_lines order by prompt_id limit 30",
)
def _(t):
    scored = P.rankable(t.rollouts()).select("prompt_id", "responses", F.explode("kept").alias("pos"))
    score = (F.length(F.element_at("responses", F.col("pos") + 1)) % 7).cast("double")
    ranked = P.best_and_worst(scored.withColumn("score", score))
    return KY.first_rows(ranked, 30, "prompt_id")


_SCORES_SQL = """
select category, model, count(*) battles, avg(score) score from battles group by 1, 2"""


@query(
    "l4_leaderboard_order",
    f"""
select category, model, round(score, 9) score, row_number() over (partition by category order by score desc, model) place
from ({_SCORES_SQL})""",
)
def _(t):
    from pyspark.sql import Window

    scores = L.model_scores(J.split_judgments(t.judgments())[0])
    order = Window.partitionBy("category").orderBy(F.desc("score"), "model")
    return scores.select(
        "category", "model", F.round("score", 9).alias("score"), F.row_number().over(order).alias("place")
    ).orderBy("category", "place")


@query(
    "l5_sorted_models",
    "select array_to_string(list_sort(list(distinct model)), ',') models, max(file_name) last_file from answers",
)
def _(t):
    models = t.answers().select("model", "file_name").distinct()
    return models.agg(
        F.array_join(F.array_sort(F.collect_set("model")), ",").alias("models"),
        F.max("file_name").alias("last_file"),
    )


@query(
    "l6_gap_preview",
    f"""
with g as (select ord, model, concat('uid=', uid, ' model=', model) txt from ({_GAPS_SQL})),
p as (select string_agg(txt, ', ' order by ord, model) head from (select * from g order by ord, model limit 8))
select count(*) total, (select head from p) || case when count(*) > 8
       then concat(', ... (+', count(*) - 8, ' more)') else '' end preview from g""",
)
def _(t):
    gaps = Q.coverage_gaps(t.view("questions"), t.answers(), TARGET, t.settings())
    text = F.concat(F.lit("uid="), F.col("uid"), F.lit(" model="), F.col("model"))
    return KY.preview_with_remainder(gaps, text, ["ord", "model"])


@query(
    "l7_log_cap",
    """
select prompt_id, array_to_string(list(pos order by pos), ',') empty_indices from rollout_lines
where response in ('', '<|eot_id|>') group by 1 order by prompt_id limit 20""",
)
def _(t):
    from duelboard.sources.writers import generation_log

    log = generation_log(t.rollouts(), limit=20)
    return log.select("prompt_id", F.array_join("empty_indices", ",").alias("empty_indices"))


# -- set operations -----------------------------------------------------------


@query(
    "u1_pooled_judges",
    f"select judge, category, count(*) n from valid_judgments group by 1, 2",
)
def _(t):
    valid = J.split_judgments(t.judgments())[0]
    pooled = valid.where("judge = 'gpt-4.1'").unionByName(valid.where("judge <> 'gpt-4.1'"))
    return pooled.groupBy("judge", "category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "u2_shared_keys",
    """
select instruction from candidates where name = 'chosen' and instruction <> '' and output is not null
intersect select instruction from candidates where name = 'sft' and instruction <> '' and output is not null""",
)
def _(t):
    usable = M.usable_outputs(t.view("candidates"))
    keys = [usable.where(F.col("name") == n).select("instruction") for n in ("chosen", "sft")]
    return keys[0].intersect(keys[1])


@query(
    "u3_models_with_baseline",
    """
select distinct model from (select regexp_replace(model, '^.*/', '') model from judgments_raw
                            union all select baseline from settings)""",
)
def _(t):
    models = J.with_short_model(t.judgments()).select("model")
    base = t.settings().select(F.col("baseline_short").alias("model"))
    return models.union(base).distinct()


@query(
    "u4_baseline_rows",
    f"""
select category, model, round(score, 9) score from ({_SCORES_SQL})
union all select category, baseline, 0.5 from settings""",
)
def _(t):
    scores = L.model_scores(J.split_judgments(t.judgments())[0])
    board = scores.withColumns({"lower": F.col("score"), "upper": F.col("score")})
    return L.add_baseline_rows(board, t.settings()).select(
        "category", "model", F.round("score", 9).alias("score")
    )


@query(
    "u5_upsert_judgments",
    f"""
with {_JUDGED_SQL},
fresh as (select uid, max(ord) ord from judgments_raw where judge <> 'gpt-4.1' and model = '{TARGET}' group by 1)
select uid, ord, 'old' origin from judged where complete
union all select uid, ord, 'new' from fresh where uid not in (select uid from judged where complete)""",
)
def _(t):
    fresh = t.judgments().where((F.col("judge") != "gpt-4.1") & (F.col("model") == TARGET))
    fresh = KY.keep_last(fresh.select("uid", "games", "ord"), ["uid"]).withColumn("origin", F.lit("new"))
    old = _judged(t).select("uid", "games", "ord", F.lit("old").alias("origin"))
    return KY.upsert(old, fresh, ["uid"], J.is_complete(F.col("games"))).drop("games")


@query(
    "u5_upsert_bucketed",
    f"""
with {_JUDGED_SQL},
fresh as (select uid, max(ord) ord from judgments_raw where judge <> 'gpt-4.1' and model = '{TARGET}' group by 1)
select uid, ord, 'old' origin from judged where complete
union all select uid, ord, 'new' from fresh where uid not in (select uid from judged where complete)""",
)
def _(t):
    """The same against a bucketed store: only the new rows are moved."""
    fresh = t.judgments().where((F.col("judge") != "gpt-4.1") & (F.col("model") == TARGET))
    fresh = KY.keep_last(fresh.select("uid", "games", "ord"), ["uid"]).withColumn("origin", F.lit("new"))
    old = _bucketed(t, _judged(t).select("uid", "games", "ord"), ["uid"]).withColumn("origin", F.lit("old"))
    return KY.upsert(old, fresh, ["uid"], J.is_complete(F.col("games"))).drop("games")
