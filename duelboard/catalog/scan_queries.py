"""Queries for the readers and writers.

Each one writes a derived input as JSON to the shared scratch folder and reads it
back through the reader or writer under test.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard import schemas
from duelboard.catalog.registry import query
from duelboard.functions.text import safe_name
from duelboard.operators import pairs as P
from duelboard.operators.keyed import keep_first, keep_last
from duelboard.operators.tally import summary_row, win_rates, winner_counts, stored_results
from duelboard.operators.turns import normalize_turn_questions
from duelboard.session import scratch_dir
from duelboard.sources import readers as R
from duelboard.sources import writers as W
from duelboard.sources.judged_lines import scan_judged_lines

QUESTION_ORD = schemas.QUESTION + ", ord bigint"


def _stored(t, df, name: str, partition_by=None, **how) -> str:
    path = scratch_dir(t.spark, name)
    W.write_jsonl(df, path, partition_by, **how)
    return path


def _message_columns(df, column: str):
    """Scalars of a message array: count, roles and joined contents."""
    return [
        F.size(column).alias("n_messages"),
        F.array_join(F.transform(column, lambda m: m["role"]), ",").alias("roles"),
    ]


@query(
    "s1_jsonl_scan",
    "select uid, prompt, category, cluster, ord from questions_raw",
)
def _(t):
    path = _stored(t, t.view("questions_raw"), "questions")
    return R.read_jsonl(t.spark, path, QUESTION_ORD)


@query(
    "s2_json_array_scan",
    """
select instruction, arg_min(output, ord) output from candidates
where name = 'sft' and instruction <> '' and output is not null group by 1""",
)
def _(t):
    rows = t.view("candidates").where("name = 'sft'").select("instruction", "output", "ord")
    path = scratch_dir(t.spark, "outputs")
    W.export_json_array(rows, path)
    schema = schemas.CANDIDATE + ", ord bigint"
    return R.read_json_outputs(t.spark, path, "sft", schema).select("instruction", "output")


@query("s3_answers_directory", "select model, uid, ord, answer from answers")
def _(t):
    documents = t.table("documents").sortWithinPartitions("lang")  # texts of a language compress better side by side
    answers = W.with_places(t.view("answers_raw", {"documents": documents}))  # seven answers a document
    answers = answers.select("file_name", "model", "uid", "ord", "place", "answer")
    path = _stored(t, answers, "answers", ["file_name"], compression="zstd", open_files=8)
    schema = "model string, uid string, ord bigint, place bigint, answer string, file_name string"
    rows = R.read_jsonl(t.spark, path, schema)
    return R.resolve_answers(rows, "place").select("model", "uid", "ord", "answer")


@query(
    "s4_judgments_scan",
    """
select uid, category, judge, model, case when n_games > 0 then g1 end g1, ord
from judgments_raw where judge in ('gpt-4.1', 'absent-judge')""",
)
def _(t):
    rows = t.judgments().select("uid", "category", "judge", "model", "games", "ord")
    path = _stored(t, rows, "judgments", ["judge"])
    schema = schemas.JUDGMENT + ", ord bigint"
    found = R.read_judgments(t.spark, path, ["gpt-4.1", "absent-judge"], schema)
    first = F.try_element_at("games", F.lit(1))["score"]
    return found.select("uid", "category", "judge", "model", first.alias("g1"), "ord")


@query(
    "s4_judged_lines_scan",
    """
select uid, category, judge, model, case when n_games > 0 then g1 end g1
from judgments_raw where judge in ('gpt-4.1', 'absent-judge')""",
)
def _(t):
    """The same through the library's own source: a partition per file, folders pruned by judge."""
    rows = t.judgments().select("uid", "category", "judge", "model", F.lit(None).cast("string").alias("baseline"), "games")
    path = _stored(t, rows, "judgments", ["judge"])
    found = scan_judged_lines(t.spark, path, ["gpt-4.1", "absent-judge"])
    first = F.try_element_at("games", F.lit(1))["score"]
    return found.select("uid", "category", "judge", "model", first.alias("g1"))


@query(
    "s5_keyed_jsonl",
    "select instruction, arg_max(coalesce(winner_key, '-'), ord) winner_key, max(ord) ord from results "
    "where instruction is not null group by 1",
)
def _(t):
    rows = t.view("results").select(
        "instruction", F.coalesce("winner_key", F.lit("-")).alias("winner_key"), "ord"
    )
    path = _stored(t, rows, "results")
    return R.read_keyed(
        t.spark, path, "instruction string, winner_key string, ord bigint", "instruction"
    )


@query(
    "s6_questions",
    """
select uid, prompt, category, ord from questions_raw
where uid is not null and trim(prompt, chr(32) || chr(10)) <> ''""",
)
def _(t):
    return R.normalize_questions(t.view("questions_raw")).select("uid", "prompt", "category", "ord")


@query(
    "s7_questions_legacy",
    f"""
select uid, prompt, coalesce(nullif(category, ''), '{K.LEGACY_CATEGORY}') category, cluster, ord
from questions_raw where uid is not null and trim(prompt, chr(32) || chr(10)) <> ''""",
)
def _(t):
    return R.normalize_legacy_questions(t.view("questions_raw")).select(
        "uid", "prompt", "category", "cluster", "ord"
    )


@query(
    "s8_turn_questions",
    """
select question_id, category, ord, len(turns) n_turns, array_to_string(turns, chr(1)) turns
from turn_questions where len(turns) > 0""",
)
def _(t):
    rows = normalize_turn_questions(t.turn_questions_raw())
    return rows.select(
        "question_id", "category", "ord", F.size("turns").alias("n_turns"),
        F.array_join("turns", "\x01").alias("turns"),
    )


@query(
    "s9_eval_examples",
    """
select ord, m[1].content instruction, m[2].content output from dialogue_messages
where side = 'eval' and len(m) = 2 and m[1].role = 'user' and m[2].role = 'assistant'""",
)
def _(t):
    return R.eval_examples(t.view("dialogues")).select("ord", "instruction", "output")


@query(
    "s10_chosen_outputs",
    """
select ord, array_to_string(list_transform(m[:-2], lambda x:
         concat(case when x.role = 'user' then 'Human: ' else 'Assistant: ' end, x.content)), chr(10) || chr(10))
       || chr(10) || chr(10) || 'Assistant:' instruction,
       m[-1].content output, 'local/dialogues:test:chosen' generator
from dialogue_messages where side = 'chosen' and len(m) >= 2 and m[1].role = 'user' and m[-1].role = 'assistant'""",
)
def _(t):
    return R.chosen_outputs(t.view("dialogues"), "local/dialogues", "test", single_turn_only=False)


@query(
    "s11_rollout_prompts",
    """
with c as (
  select ord, m, case when len(m) > 0 and m[-1].role = 'assistant' then m[:-2] else m end p,
         case when len(m) > 0 and m[-1].role = 'assistant' then m[-1].content end ref
  from dialogue_messages where side = 'chosen'),
r as (select ord, case when len(m) > 0 and m[-1].role = 'assistant' then m[-1].content end ref
      from dialogue_messages where side = 'rejected')
select c.ord, len(p) n_messages, array_to_string(list_transform(p, lambda x: x.role), ',') roles,
       c.ref reference_chosen, r.ref reference_rejected
from c left join r using (ord)
where len(p) > 0 and p[-1].role = 'user'
  and len(list_filter(p, lambda x: regexp_matches(x.content, '^(Human|Assistant):|\\n\\n(Human|Assistant):'))) = 0""",
)
def _(t):
    prompts = P.rollout_prompts(t.view("dialogues"))
    return prompts.select(
        "ord",
        *_message_columns(prompts, "prompt_messages"),
        F.col("reference_responses.chosen").alias("reference_chosen"),
        F.col("reference_responses.rejected").alias("reference_rejected"),
    )


@query(
    "s12_tolerant_resume_scan",
    """
select instruction, arg_min(coalesce(winner_key, winner), ord) winner, min(ord) ord from results
where instruction is not null group by 1""",
)
def _(t):
    path = scratch_dir(t.spark, "resume")
    results = t.view("results").select(
        "instruction", F.coalesce("winner_key", "winner").alias("winner"), "ord"
    )
    line = F.to_json(F.struct("instruction", "winner", "ord"))
    # every row is followed by a torn line and a blank one
    lines = results.select(
        F.explode(F.array(line, F.concat(F.lit('{"instruction": "torn-'), F.col("ord")), F.lit(""))).alias("value")
    )
    lines.write.text(path)
    rows = R.read_jsonl_tolerant(t.spark, path, "instruction string, winner string, ord bigint")
    return keep_first(rows.where(F.col("instruction").isNotNull()), ["instruction"])


@query(
    "s13_rollout_scan",
    """
select prompt_id, count(*) n_responses, count_if(response in ('', '<|eot_id|>')) n_empty,
       sum(length(response)) chars
from rollout_lines group by 1""",
)
def _(t):
    path = _stored(t, t.rollouts(), "rollouts")
    rows = R.read_jsonl(t.spark, path, schemas.ROLLOUT)
    return rows.select(
        "prompt_id",
        F.size("responses").alias("n_responses"),
        F.size(P.empty_indices(F.col("responses"))).alias("n_empty"),
        F.aggregate(
            "responses", F.lit(0).cast("bigint"), lambda a, r: a + F.length(r)
        ).alias("chars"),
    )


@query(
    "s14_strict_pair_scan",
    """
select case when doc_id % 37 = 4 then 'rejected line' else 'row' end kind, count(*) n,
       sum(length(text)) chars
from documents group by 1""",
)
def _(t):
    path = scratch_dir(t.spark, "pairs")
    body = F.to_json(F.struct(F.col("text").alias("chosen"), F.length("text").alias("chars")))
    torn = F.concat(F.lit("{"), F.length("text").cast("string"))
    lines = t.table("documents").select(F.when(F.col("doc_id") % 37 == 4, torn).otherwise(body).alias("value"))
    lines.write.text(path)
    rows = R.read_jsonl_with_rejects(t.spark, path, "chosen string, chars bigint")
    bad = F.col("_corrupt").isNotNull()
    chars = F.when(bad, F.substring(F.col("_corrupt"), 2, 20).try_cast("bigint")).otherwise(F.col("chars"))
    return (
        rows.select(F.when(bad, "rejected line").otherwise("row").alias("kind"), chars.alias("chars"))
        .groupBy("kind")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    )


@query(
    "k1_overwrite_partitions",
    """
select judge, model, count(*) n, sum(ord) ord_sum from (
  select judge, regexp_replace(model, '^.*/', '') model, ord from judgments_raw
  where judge <> 'gpt-4.1'
  union all
  select judge, regexp_replace(model, '^.*/', '') model, ord + 1 from judgments_raw
  where judge = 'gpt-4.1') group by 1, 2""",
)
def _(t):
    rows = t.judgments().select("judge", F.substring_index("model", "/", -1).alias("model"), "uid", "ord")
    path = scratch_dir(t.spark, "judgments")
    W.write_jsonl(rows, path, ["judge", "model"])
    replaced = rows.where("judge = 'gpt-4.1'").withColumn("ord", F.col("ord") + 1)
    W.write_jsonl(replaced, path, ["judge", "model"])
    back = R.read_jsonl(t.spark, path, "uid string, ord bigint, judge string, model string")
    return back.groupBy("judge", "model").agg(
        F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ord_sum")
    )


@query("k2_plain_jsonl", "select doc_id, text, lang, source from documents")
def _(t):
    path = _stored(t, t.table("documents").select("doc_id", "text", "lang", "source"), "plain")
    return R.read_jsonl(t.spark, path, "doc_id bigint, text string, lang string, source string")


@query(
    "k3_candidate_export",
    "select name, count(*) n, count(output) with_output, sum(length(output)) chars from candidates group by 1",
)
def _(t):
    path = scratch_dir(t.spark, "export")
    rows = t.view("candidates").select("instruction", "output", F.col("name").alias("generator"))
    W.write_candidates(rows, path)
    back = R.read_jsonl(t.spark, path, "output string, generator string")
    return back.groupBy(F.col("generator").alias("name")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count("output").alias("with_output"),
        F.sum(F.length("output")).alias("chars"),
    )


@query(
    "k4_append_results",
    "select instruction, count(*) n, min(ord) first_ord, max(ord) last_ord from results group by 1",
)
def _(t):
    path = scratch_dir(t.spark, "appended")
    rows = t.view("results").select("instruction", "ord")
    W.append_jsonl(rows.where("ord % 2 = 0"), path)
    W.append_jsonl(rows.where("ord % 2 = 1"), path)
    back = R.read_jsonl(t.spark, path, "instruction string, ord bigint")
    return back.groupBy("instruction").agg(
        F.count(F.lit(1)).alias("n"), F.min("ord").alias("first_ord"), F.max("ord").alias("last_ord")
    )


WIN_RATES_SQL = """
with firsts as (
  select instruction, arg_min(coalesce(nullif(coalesce(winner_key, ''), ''), winner), ord) k
  from results where instruction is not null group by 1),
counted as (
  select case when coalesce(k, '') = '' or upper(k) = 'TIE' then 'TIE' else k end as key, 1 n from firsts
  union all select * from (values ('chosen', 0), ('sft', 0), ('beta_dpo', 0), ('TIE', 0)) z(key, n)),
counts as (select key, sum(n) n from counted group by 1)
"""


@query(
    "k5_summary",
    WIN_RATES_SQL
    + """
select key, cast(n as bigint) n, cast((select sum(n) from counts) as bigint) total,
       case when key <> 'TIE' then round(n / (select sum(n) from counts where key <> 'TIE'), 9) end win_rate,
       'judge-x' model from counts""",
)
def _(t):
    rates = win_rates(winner_counts(stored_results(t.view("results")), ["chosen", "sft", "beta_dpo"]))
    path = scratch_dir(t.spark, "summary")
    W.write_one_row(summary_row(rates, "judge-x"), path)
    schema = "total bigint, counts map<string,bigint>, win_rates map<string,double>, model string"
    back = R.read_jsonl(t.spark, path, schema)
    return back.select("*", F.explode("counts").alias("key", "n")).select(
        "key", "n", "total",
        F.round(F.try_element_at("win_rates", "key"), 9).alias("win_rate"),
        "model",
    )


@query(
    "k6_run_record",
    """
select 'bench-x' bench_name, 'endpoint' "mode", 'org/sft' pretty_name, count(*) question_count,
       'pyspark' package, '4' version from questions""",
)
def _(t):
    total = t.view("questions").agg(F.count(F.lit(1)).alias("n")).scalar()
    record = W.run_record(
        t.spark,
        {"bench_name": "bench-x", "mode": "endpoint", "pretty_name": "org/sft"},
        {"pyspark": "4"},
        total,
    )
    path = scratch_dir(t.spark, "record")
    W.write_one_row(record, path)
    schema = (
        "bench_name string, mode string, pretty_name string, question_count bigint, "
        "package_versions map<string,string>"
    )
    back = R.read_jsonl(t.spark, path, schema)
    return back.select("*", F.explode("package_versions").alias("package", "version")).drop(
        "package_versions"
    )


@query(
    "k8_generation_log",
    """
with e as (select prompt_id, array_to_string(list(pos order by pos), ',') empty_indices from rollout_lines
           where response in ('', '<|eot_id|>') group by 1),
c as (select prompt_id, md5(string_agg(response, '|' order by pos)) cleaned from rollout_lines group by 1)
select prompt_id, empty_indices, concat('<', source, '>') prompt_text, source prompt, cleaned,
       md5(array_to_string(list_concat(string_split(text, chr(10)),
             case doc_id % 3 when 0 then [''] when 1 then ['<|eot_id|>'] else [] end), '|')) raw
from e join c using (prompt_id) join documents on doc_id = prompt_id""",
)
def _(t):
    texts = t.table("documents").select(
        F.col("doc_id").alias("prompt_id"), F.concat(F.lit("<"), "source", F.lit(">")).alias("prompt_text"), F.split("text", "\n").alias("raw")
    )
    rows = t.rollouts().join(texts, "prompt_id")
    rest = F.slice("responses", F.size("raw") + 1, F.size("responses"))
    log = W.generation_log(rows.withColumn("raw_responses", F.concat("raw", rest)))
    return log.select(
        "prompt_id",
        F.array_join("empty_indices", ",").alias("empty_indices"),
        "prompt_text",
        F.col("prompt_messages")[0]["content"].alias("prompt"),
        F.md5(F.array_join("cleaned_responses", "|")).alias("cleaned"),
        F.md5(F.array_join("raw_responses", "|")).alias("raw"),
    )
