"""Queries for projections, predicates and scalar functions (P*, C*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.catalog.registry import query
from duelboard.catalog.views import category_case
from duelboard.functions import prompts as PR
from duelboard.functions import style as S
from duelboard.functions import text as T
from duelboard.functions import transcripts as TR
from duelboard.functions import verdicts as V
from duelboard.operators import judgments as J
from duelboard.operators import pairs as P
from duelboard.operators import requests as Q
from duelboard.operators.multiway import select_candidates

WS = K.PY_SPACES
WSC = K.SPACE_CLASS


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# -- names and records --------------------------------------------------------


@query("p1_short_model_name", "select ord, regexp_replace(model, '^.*/', '') short_name from judgments_raw")
def _(t):
    return t.view("judgments_raw").select("ord", T.short_model_name(F.col("model")).alias("short_name"))


@query(
    "p2_safe_name",
    """
select page_id, coalesce(nullif(trim(regexp_replace(trim(url), '[^A-Za-z0-9._-]+', '-', 'g'), '-'), ''),
                         'benchmark') name from pages""",
)
def _(t):
    return t.table("pages").select("page_id", T.safe_name(F.col("url")).alias("name"))


_STYLE_SQL = f"""
select *, len(regexp_extract_all(c, '(?m)^#{{1}}[{WSC}]')) h1, len(regexp_extract_all(c, '(?m)^#{{2}}[{WSC}]')) h2,
       len(regexp_extract_all(c, '(?m)^#{{3}}[{WSC}]')) h3, len(regexp_extract_all(c, '(?m)^#{{4}}[{WSC}]')) h4,
       len(regexp_extract_all(c, '(?m)^#{{5}}[{WSC}]')) h5, len(regexp_extract_all(c, '(?m)^#{{6}}[{WSC}]')) h6,
       len(regexp_extract_all(c, '(?m)^[{WSC}]*\\p{{Nd}}+\\.[{WSC}]')) ordered,
       len(regexp_extract_all(c, '(?m)^[{WSC}]*[-*+][{WSC}]')) unordered,
       len(regexp_extract_all(c, '\\*\\*[^*\\n]+\\*\\*')) stars,
       len(regexp_extract_all(c, '__[^_\\n]+__')) underscores,
       len(regexp_extract_all(answer, '[^{WSC}]+')) words
from (select *, list_reduce(list_prepend(answer, regexp_extract_all(answer, '```([^`]*)```', 1)),
                            lambda a, b: replace(a, b, '')) c from answers_raw) x"""


@query(
    "p3_answer_rows",
    f"""
select uid, md5(concat_ws('|', 'org/sft', uid)) ans_id, 'org/sft' model, 'system,user,assistant' roles,
       prompt user_content, md5(prompt) answer_md5, cast(case when ord % 2 = 0 then 1700000000 else 1800000000 end as double) tstamp,
       len(regexp_extract_all(prompt, '[^{WSC}]+')) token_len
from questions""",
)
def _(t):
    answered = t.view("questions").select(
        "uid",
        "prompt",
        F.col("prompt").alias("answer"),
        F.when(F.col("ord") % 2 == 0, F.lit(0.0)).otherwise(F.lit(1800000000.0)).alias("tstamp"),
    )
    rows = Q.answer_rows(answered, "org/sft", "Be brief.", F.lit(1700000000.0))
    return rows.select(
        "uid",
        "ans_id",
        "model",
        F.array_join(F.transform("messages", lambda m: m["role"]), ",").alias("roles"),
        PR.content_text(F.col("messages")[1]["content"]).alias("user_content"),
        F.md5(PR.answer_text(F.col("messages"))).alias("answer_md5"),
        "tstamp",
        F.col("metadata.token_len").alias("token_len"),
    )


def _mixed_messages(t):
    """Answers stored as plain strings, as objects, or with no messages at all."""
    as_object = F.to_variant_object(F.named_struct(F.lit("answer"), F.col("answer")))
    content = F.when(F.col("ord") % 2 == 0, as_object).otherwise(F.col("answer").cast("variant"))
    last = F.struct(F.lit("assistant").alias("role"), content.alias("content"))
    first = F.struct(F.lit("user").alias("role"), F.col("uid").cast("variant").alias("content"))
    messages = F.when(F.col("ord") % 29 == 3, F.array(first, last)).otherwise(F.array(last))
    empty = F.slice(messages, F.lit(1), F.lit(0))
    return t.view("answers_raw").select(
        "file_name", "ord", F.when(F.col("ord") % 31 == 4, empty).otherwise(messages).alias("messages")
    )


@query(
    "p4_final_answer_text",
    "select file_name, ord, case when ord % 31 = 4 then '' else answer end answer from answers_raw",
)
def _(t):
    return _mixed_messages(t).select("file_name", "ord", PR.answer_text(F.col("messages")).alias("answer"))


# -- judgments ----------------------------------------------------------------


@query(
    "p5_complete_judgments",
    """
select ord, n_games = 2 and null_game = 0 and g1 is not null and g2 is not null complete from judgments_raw""",
)
def _(t):
    return t.judgments().select("ord", J.is_complete(F.col("games")).alias("complete"))


REASON_SQL = """case when n_games < 2 then 'missing_games' when null_game = 1 then 'null_game'
     when g1 is null or g2 is null then 'missing_score'
     when g1 = 'junk' and g2 = 'junk' then 'invalid_score_labels' end"""


@query(
    "p6_reject_reasons",
    f"select ord, uid, coalesce({REASON_SQL}, 'valid') reason from judgments_raw",
)
def _(t):
    reason = F.coalesce(J.reject_reason(F.col("games")), F.lit("valid"))
    return t.judgments().select("ord", "uid", reason.alias("reason"))


@query(
    "p7_reject_preview",
    f"""
with r as (select ord, concat(regexp_replace(model, '^.*/', ''), '.jsonl: uid=', uid, ' ', {REASON_SQL},
                              case when {REASON_SQL} = 'invalid_score_labels' then concat('=', g1, '/', g2) else '' end) txt
           from judgments_raw where {REASON_SQL} is not null),
p as (select string_agg(txt, ', ' order by ord) head from (select * from r order by ord limit 8))
select count(*) total, (select head from p) || case when count(*) > 8
       then concat(', ... (+', count(*) - 8, ' more)') else '' end preview from r""",
)
def _(t):
    rejects = J.split_judgments(t.judgments())[1]
    return J.reject_preview(rejects.withColumn("file_name", F.concat(F.regexp_replace("model", "^.*/", ""), F.lit(".jsonl"))))


@query("p8_category_filter", "select uid, model, score from battles where category = 'math'")
def _(t):
    battles = J.battle_rows(J.split_judgments(t.judgments())[0])
    return J.for_category(battles, "math").drop("category")


# -- emptiness ----------------------------------------------------------------


@query(
    "p9_effectively_empty",
    """
select prompt_id, pos, response = '' or response = '<|eot_id|>' fixed, response = '' reference from rollout_lines""",
)
def _(t):
    lines = t.rollouts().select("prompt_id", F.posexplode("responses").alias("pos", "response"))
    return lines.select(
        "prompt_id",
        "pos",
        T.effectively_empty(F.col("response")).alias("fixed"),
        T.effectively_empty(F.col("response"), mode="reference").alias("reference"),
    )


@query(
    "p10_effectively_empty_escapes",
    """
select prompt_id, pos, response = '' or response = '<|eot_id|>' or pos % 5 = 4 "empty" from rollout_lines""",
)
def _(t):
    lines = t.rollouts().select("prompt_id", F.posexplode("responses").alias("pos", "response"))
    escaped = F.when(F.col("pos") % 5 == 4, F.lit(" \\n\\r\\n <|eot_id|>\r\n\\t ")).otherwise(F.col("response"))
    return lines.select(
        "prompt_id", "pos", T.effectively_empty(escaped, drop_escapes=True).alias("empty")
    )


@query(
    "p11_has_text_any_shape",
    """
select prompt_id, count_if(response not in ('', '<|eot_id|>')) > 0 "list",
       any_value(response) filter (pos = 0) not in ('', '<|eot_id|>') single from rollout_lines group by 1""",
)
def _(t):
    as_messages = F.transform("responses", lambda r: F.named_struct(F.lit("content"), r))
    listed = F.to_variant_object(as_messages)
    first = F.element_at("responses", 1)
    single = F.when(
        F.col("prompt_id") % 2 == 0, F.to_variant_object(F.named_struct(F.lit("content"), first))
    ).otherwise(first.cast("variant"))
    shaped = t.rollouts().select("prompt_id", listed.alias("l"), single.alias("s"))
    return shaped.select(
        "prompt_id",
        P.has_text_any_shape(F.col("l")).alias("list"),
        P.has_text_any_shape(F.col("s")).alias("single"),
    )


def _mirrored_pairs(t):
    """Every response of a prompt with the one as far from the other end."""
    reply = lambda c: F.array(F.struct(F.lit("assistant").alias("role"), c.alias("content")))
    rows = t.rollouts().select("prompt_id", F.posexplode(F.arrays_zip("responses", F.reverse("responses").alias("mirrored"))).alias("pos", "z"))
    return rows.select("prompt_id", "pos", reply(F.col("z.responses")).alias("chosen"), reply(F.col("z.mirrored")).alias("rejected"))


_MIRRORED_SQL = """
select a.prompt_id, a.pos, a.response chosen, b.response rejected
from rollout_lines a join (select prompt_id, count(*) n from rollout_lines group by 1) c using (prompt_id)
join rollout_lines b on b.prompt_id = a.prompt_id and b.pos = c.n - 1 - a.pos"""
_KEPT = "chosen not in ('', '<|eot_id|>') and rejected not in ('', '<|eot_id|>')"


@query("p12_filter_pairs", f"select * from ({_MIRRORED_SQL}) where {_KEPT}")
def _(t):
    kept = P.filter_pairs(_mirrored_pairs(t))
    return kept.select(
        "prompt_id",
        "pos",
        F.col("chosen")[0]["content"].alias("chosen"),
        F.col("rejected")[0]["content"].alias("rejected"),
    )


@query(
    "p13_raw_role_tags",
    """
select ord, regexp_matches(text, '^(Human|Assistant):|\\n\\n(Human|Assistant):') raw from dialogues""",
)
def _(t):
    message = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    return t.view("dialogues").select("ord", TR.has_raw_tags(message).alias("raw"))


@query(
    "p14_example_eligibility",
    """
select ord, len(m) >= 2 and m[1].role = 'user' and m[-1].role = 'assistant' multi,
       len(m) = 2 and m[1].role = 'user' and m[-1].role = 'assistant' single
from dialogue_messages where side = 'text'""",
)
def _(t):
    parsed = t.heavy_view("dialogues").select("ord", TR.parse_transcript(F.col("text")).alias("m"))
    return parsed.select(
        "ord",
        TR.is_example(F.col("m"), False).alias("multi"),
        TR.is_example(F.col("m"), True).alias("single"),
    )


@query(
    "p15_rankable_prompts",
    """
select prompt_id, array_to_string(list(pos order by pos), ',') kept from rollout_lines
where response not in ('', '<|eot_id|>') group by 1 having count(*) >= 2""",
)
def _(t):
    return P.rankable(t.rollouts()).select("prompt_id", F.array_join("kept", ",").alias("kept"))


@query(
    "p16_metadata_features",
    f"""
select file_name, ord, cast(words as double) length, cast(h1 + h2 + h3 + h4 + h5 + h6 as double) headers,
       cast(ordered + unordered as double) lists, cast(stars + underscores as double) bolds from ({_STYLE_SQL})""",
)
def _(t):
    stored = t.heavy_view("answers_raw").select("file_name", "ord", S.style_metadata(F.col("answer")).alias("m"))
    return stored.select("file_name", "ord", S.metadata_features(F.col("m")).alias("f")).select(
        "file_name", "ord", "f.*"
    )


@query(
    "p17_empty_indices",
    """
select prompt_id, coalesce(array_to_string(list(pos order by pos) filter (response in ('', '<|eot_id|>')), ','), '') empty_indices
from rollout_lines group by 1""",
)
def _(t):
    return t.rollouts().select(
        "prompt_id", F.array_join(P.empty_indices(F.col("responses")), ",").alias("empty_indices")
    )


@query(
    "p18_run_metadata",
    """
select doc_id prompt_id, 'rollout' source, cast(42 as bigint) seed, 8 k_candidates, 'org/sft' generator_model,
       'rm' judge, 'org/reward' reward_model, 'none' reward_quantization from documents""",
)
def _(t):
    meta = P.run_metadata("rollout", 42, 8, "org/sft", "org/reward")
    return t.rollouts().select("prompt_id", meta.alias("m")).select("prompt_id", "m.*")


@query(
    "p19_select_candidates",
    "select name, count(*) n from candidates where name in ('chosen', 'beta_dpo') group by 1",
)
def _(t):
    paths = {"chosen": "a", "sft": None, "beta_dpo": "b"}
    names = select_candidates(paths, ["sft", "beta_dpo", "chosen", "margin_dpo"])
    rows = t.view("candidates").where(F.col("name").isin(names))
    return rows.groupBy("name").agg(F.count(F.lit(1)).alias("n"))


# -- verdicts -----------------------------------------------------------------

LABEL_SQL = """
select *, trim(coalesce(list_filter(regexp_extract_all(upper(reply), '\\[\\[([AB<>=]+)\\]\\]', 1), lambda x: x <> '')[-1],
                        list_filter(regexp_extract_all(upper(reply), '\\[([AB<>=]+)\\]', 1), lambda x: x <> '')[-1])) score
from replies"""


@query("c1_verdict_label", f"select uid, game_no, score from ({LABEL_SQL})")
def _(t):
    return t.heavy_view("replies").select("uid", "game_no", V.parse_label(F.col("reply")).alias("score"))


# The stated line/JSON/fallback rules, written with RE2 and list functions.
COMPARISON_SQL = f"""
with s as (select instruction, ord, trim(reply, {quoted(WS)}) t from comparison_replies),
l as (select *, list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, {quoted(WS)})), lambda x: x <> '') ls,
             case when starts_with(t, '{{') and json_valid(t) then t end j from s),
p as (select *, list_filter(ls, lambda x: starts_with(lower(x), 'comparison:')) cl,
             list_filter(ls, lambda x: starts_with(lower(x), 'winner:')) wl from l),
w as (select *,
        case when len(cl) > 0 then trim(substr(cl[-1], 12), {quoted(WS)})
             else trim(coalesce(nullif(json_extract_string(j, '$.comparison'), ''), json_extract_string(j, '$.Comparison')),
                       {quoted(WS)}) end comparison,
        upper(trim(trim(trim(case when len(wl) > 0 then substr(wl[-1], 8)
             else coalesce(nullif(json_extract_string(j, '$.winner'), ''), json_extract_string(j, '$.Winner')) end,
             {quoted(WS)}), '"'), {quoted(WS)})) stated,
        nullif(upper(regexp_extract(t, '(?i)"winner"[{WSC}]*:[{WSC}]*"(A|B|C|TIE)"', 1)), '') quoted_winner,
        nullif(upper(regexp_extract(t, '(?i)(?:^|[^\\p{{L}}\\p{{N}}_])(A|B|C|TIE)(?:$|[^\\p{{L}}\\p{{N}}_])', 1)), '') bare
      from p)
select instruction, ord, comparison,
       coalesce(case when stated in ('A', 'B', 'C', 'TIE') then stated end, quoted_winner, bare) winner from w"""


@query("c2_comparison_reply", COMPARISON_SQL)
def _(t):
    parsed = t.heavy_view("comparison_replies").select(
        "instruction", "ord", V.parse_comparison(F.col("reply")).alias("p")
    )
    return parsed.select("instruction", "ord", "p.comparison", "p.winner")


@query(
    "c3_normalize_winner",
    """
select event_id, case when k in (0, 1) then 'A' when k = 2 then 'TIE' when k = 3 then 'C' end winner
from (select event_id, event_id % 6 k from events)""",
)
def _(t):
    raw = F.element_at(
        F.array(*[F.lit(x) for x in ("a", ' "A" ', "\ttie\n", '" c"', "D", "")]),
        (F.col("event_id") % 6 + 1).cast("int"),
    )
    return t.table("events").select("event_id", V.normalize_winner(raw).alias("winner"))


@query(
    "c4_settle_winner",
    """
select event_id, case when k = 0 then 'A' when k = 1 then 'B' else 'TIE' end winner,
       case when k = 0 then 'sft' when k = 1 then 'chosen' else 'TIE' end winner_key
from (select event_id, event_id % 5 k from events)""",
)
def _(t):
    labels = F.create_map(F.lit("A"), F.lit("sft"), F.lit("B"), F.lit("chosen"))
    winner = F.element_at(
        F.array(F.lit("A"), F.lit("B"), F.lit("C"), F.lit("TIE"), F.lit(None).cast("string")),
        (F.col("event_id") % 5 + 1).cast("int"),
    )
    settled = t.table("events").select("event_id", V.settle_winner(winner, labels).alias("s"))
    return settled.select("event_id", "s.*")


# -- prompts ------------------------------------------------------------------


def sql_fill(template: str, **fields: str) -> str:
    """The SQL concat that a filled template must equal."""
    import re

    parts = re.split(r"\{(\w+)\}", template)
    return "concat(" + ", ".join(fields[p] if i % 2 else quoted(p) for i, p in enumerate(parts)) + ")"


@query(
    "c5_comparison_prompt",
    "select ord, md5("
    + sql_fill(K.THREE_WAY_TEMPLATE, instruction="uid", output_a="prompt", output_b="category", output_c="'{output_a}'")
    + ") three_way, "
    + sql_fill(K.PAIRWISE_TEMPLATE, instruction="uid", output_a="prompt", output_b="category")
    + " pairwise from questions",
)
def _(t):
    outputs = F.array("prompt", "category", F.lit("{output_a}"))
    return t.view("questions").select(
        "ord",
        F.md5(PR.comparison_prompt(F.col("uid"), outputs, 3)).alias("three_way"),
        PR.comparison_prompt(F.col("uid"), outputs, 2).alias("pairwise"),
    )


@query(
    "c6_judge_prompt",
    "select ord, s.system_prompt, "
    + sql_fill(K.JUDGE_TEMPLATE, QUESTION="uid", ANSWER_A="prompt", ANSWER_B="'{QUESTION}'")
    + " user_prompt from questions join settings s using (category)",
)
def _(t):
    user = PR.judge_prompt(F.col("uid"), F.col("prompt"), F.lit("{QUESTION}"))
    rows = Q.with_settings(t.view("questions"), t.settings()).select(
        "ord", PR.judge_messages(F.col("system_prompt"), user).alias("m")
    )
    return rows.select(
        "ord", F.col("m")[0]["content"].alias("system_prompt"), F.col("m")[1]["content"].alias("user_prompt")
    )


# -- transcripts --------------------------------------------------------------

RENDERED = (
    "array_to_string(list_transform({m}, lambda x: concat(case when x.role = 'user' then 'Human: ' "
    "else 'Assistant: ' end, x.content)), chr(10) || chr(10))"
)


def _messages(t):
    return t.view("dialogues").select("ord", TR.parse_transcript(F.col("text")).alias("m"))


@query(
    "c7_parse_transcript",
    """
select ord, unnest(range(len(m))) idx, unnest(list_transform(m, lambda x: x.role)) "role",
       unnest(list_transform(m, lambda x: x.content)) "content" from dialogue_messages where side = 'text'""",
)
def _(t):
    rows = _messages(t).select("ord", F.posexplode("m").alias("idx", "x"))
    return rows.select("ord", "idx", "x.role", "x.content")


@query(
    "c8_prompt_example",
    f"""
select ord, len(m) - 1 n_prompt, concat({RENDERED.format(m="m[:-2]")}, chr(10), chr(10), 'Assistant:') instruction,
       m[-1].content output from dialogue_messages
where side = 'text' and len(m) >= 2 and m[1].role = 'user' and m[-1].role = 'assistant'""",
)
def _(t):
    examples = _messages(t).select("ord", TR.prompt_example(F.col("m"), False).alias("e"))
    return examples.where(F.col("e").isNotNull()).select(
        "ord", F.size("e.prompt_messages").alias("n_prompt"), "e.instruction", "e.output"
    )


@query(
    "c9_prompt_and_reference",
    """
select ord, case when p[-1].role = 'user' then len(p) end n_prompt, ref reference from (
  select ord, case when m[-1].role = 'assistant' then m[:-2] else m end p,
         case when m[-1].role = 'assistant' then m[-1].content end ref
  from dialogue_messages where side = 'text')""",
)
def _(t):
    rows = _messages(t).select("ord", TR.prompt_and_reference(F.col("m")).alias("e"))
    n = F.when(F.col("e.prompt_messages").isNotNull(), F.size("e.prompt_messages"))
    return rows.select("ord", n.alias("n_prompt"), "e.reference")


@query(
    "c10_render_prompt",
    f"""
select ord, case when len(m) = 0 then 'Assistant:'
            else concat({RENDERED.format(m="m")}, chr(10), chr(10), 'Assistant:') end rendered
from dialogue_messages where side = 'text'""",
)
def _(t):
    return _messages(t).select("ord", TR.render_prompt(F.col("m")).alias("rendered"))


@query(
    "c11_clean_content",
    f"""
select doc_id, trim(replace(replace(concat(' ', chr(13), text, chr(13), chr(10), lang, chr(13), source, chr(9)),
       concat(chr(13), chr(10)), chr(10)), chr(13), chr(10)), {quoted(WS)}) cleaned from documents""",
)
def _(t):
    raw = F.concat(
        F.lit(" \r"), F.col("text"), F.lit("\r\n"), F.col("lang"), F.lit("\r"), F.col("source"), F.lit("\t")
    )
    return t.table("documents").select("doc_id", T.clean_content(raw).alias("cleaned"))


# -- style --------------------------------------------------------------------


@query("c12_drop_fenced", f"select file_name, ord, c cleaned from ({_STYLE_SQL})")
def _(t):
    return t.view("answers_raw").select("file_name", "ord", S.drop_fenced(F.col("answer")).alias("cleaned"))


def _markers(t):
    return t.view("answers_raw").select(
        "file_name", "ord", S.markdown_markers(S.drop_fenced(F.col("answer"))).alias("k")
    )


@query("c13_header_counts", f"select file_name, ord, h1, h2, h3, h4, h5, h6 from ({_STYLE_SQL})")
def _(t):
    counted = _markers(t).select("file_name", "ord", S.header_counts(F.col("k")).alias("h"))
    return counted.select("file_name", "ord", *[F.col("h")[n].alias(n) for n in S.HEADER_LEVELS])


@query("c14_list_counts", f"select file_name, ord, ordered, unordered from ({_STYLE_SQL})")
def _(t):
    counted = _markers(t).select("file_name", "ord", S.list_counts(F.col("k")).alias("l"))
    return counted.select("file_name", "ord", *[F.col("l")[n].alias(n) for n in ("ordered", "unordered")])


@query("c15_bold_counts", f"select file_name, ord, stars, underscores from ({_STYLE_SQL})")
def _(t):
    cleaned = t.view("answers_raw").withColumn("c", S.drop_fenced(F.col("answer")))
    counted = cleaned.select("file_name", "ord", S.bold_counts(F.col("c")).alias("b"))
    return counted.select(
        "file_name", "ord", F.col("b")["**"].alias("stars"), F.col("b")["__"].alias("underscores")
    )


@query("c16_word_count", f"select doc_id, len(regexp_extract_all(text, '[^{WSC}]+')) words from documents")
def _(t):
    return t.table("documents").select("doc_id", T.word_count(F.col("text")).alias("words"))


@query(
    "c17_style_metadata",
    f"""
select file_name, ord, words token_len, h1, h2 + h3 + h4 + h5 + h6 deeper, ordered, unordered, stars, underscores
from ({_STYLE_SQL})""",
)
def _(t):
    m = t.heavy_view("answers_raw").select("file_name", "ord", S.style_metadata(F.col("answer")).alias("m"))
    h = F.col("m.header_count")
    return m.select(
        "file_name",
        "ord",
        "m.token_len",
        h["h1"].alias("h1"),
        (h["h2"] + h["h3"] + h["h4"] + h["h5"] + h["h6"]).alias("deeper"),
        F.col("m.list_count")["ordered"].alias("ordered"),
        F.col("m.list_count")["unordered"].alias("unordered"),
        F.col("m.bold_count")["**"].alias("stars"),
        F.col("m.bold_count")["__"].alias("underscores"),
    )


@query(
    "c18_preview",
    f"""
select doc_id, case when length(c) <= 240 then c else concat(left(c, 237), '...') end preview,
       case when length(text) <= 512 then text else concat(left(text, 512), '...') end summary
from (select doc_id, text, trim(regexp_replace(text, '[{WSC}]+', ' ', 'g')) c from documents)""",
)
def _(t):
    return t.table("documents").select(
        "doc_id", T.preview(F.col("text")).alias("preview"), T.summarize(F.col("text")).alias("summary")
    )


@query(
    "c19_cut_at_stop",
    f"""
select ord, trim(case when p is null then text else left(text, cast(p - 1 as bigint)) end, {quoted(WS)}) kept
from (select ord, text, least(nullif(strpos(text, concat(chr(10), chr(10), 'Human:')), 0),
                              nullif(strpos(text, '%%%'), 0)) p from dialogues)""",
)
def _(t):
    return t.view("dialogues").select(
        "ord", T.cut_at_stop(F.col("text"), (*K.STOP_STRINGS, "%%%")).alias("kept")
    )


_HEADER = quoted(K.ASSISTANT_HEADER)


@query(
    "c20_assistant_header",
    f"""
select doc_id, case when doc_id % 2 = 0 then concat(text, {_HEADER}) else concat(text, {_HEADER}) end fixed,
       concat(text, case when doc_id % 2 = 0 then {_HEADER} else '' end, {quoted(K.ASSISTANT_HEADER_LITERAL)}) reference
from documents""",
)
def _(t):
    prompt = F.concat("text", F.when(F.col("doc_id") % 2 == 0, F.lit(K.ASSISTANT_HEADER)).otherwise(F.lit("")))
    return t.table("documents").select(
        "doc_id",
        PR.ensure_assistant_header(prompt).alias("fixed"),
        PR.ensure_assistant_header(prompt, "reference").alias("reference"),
    )


@query(
    "c21_chat_rendering",
    f"""
select ord, concat('<|im_start|>system', chr(10), {quoted(K.CHATML_DEFAULT_SYSTEM)}, '<|im_end|>', chr(10),
         array_to_string(list_transform(m, lambda x: concat('<|im_start|>', x.role, chr(10), x.content, '<|im_end|>', chr(10))), ''),
         '<|im_start|>assistant', chr(10)) chatml,
       concat(case when len(m) > 0 then '<|begin_of_text|>' else '' end,
         array_to_string(list_transform(m, lambda x: concat('<|start_header_id|>', x.role, '<|end_header_id|>', chr(10), chr(10),
                         x.content, '<|eot_id|>')), ''), {_HEADER}) header_style,
       concat('[INST] ', ord, ' [/INST]') instruct,
       concat('<s> <|system|>', chr(10), '</s>', chr(10), '<|user|>', chr(10), ord, '</s>', chr(10), '<|assistant|>', chr(10)) base
from dialogue_messages where side = 'text'""",
)
def _(t):
    m, key = F.col("m"), F.col("ord").cast("string")
    return _messages(t).select(
        "ord",
        PR.render_chatml(m).alias("chatml"),
        PR.render_header_style(m).alias("header_style"),
        PR.instruction_prompt(key, "mistral-instruct").alias("instruct"),
        PR.instruction_prompt(key, "mistral-base").alias("base"),
    )


@query(
    "c22_content_text",
    """
select doc_id, case doc_id % 4 when 0 then text when 1 then text when 2 then concat(text, chr(10), lang)
               else concat('{"source":"', source, '"}') end content from documents""",
)
def _(t):
    obj = lambda k, c: F.to_variant_object(F.named_struct(F.lit(k), F.col(c)))
    kind = F.col("doc_id") % 4
    content = (
        F.when(kind == 0, F.col("text").cast("variant"))
        .when(kind == 1, obj("answer", "text"))
        .when(kind == 2, F.to_variant_object(F.array("text", "lang")))
        .otherwise(obj("source", "source"))
    )
    shaped = t.table("documents").select("doc_id", content.alias("c"))
    return shaped.select("doc_id", PR.content_text(F.col("c")).alias("content"))


@query(
    "c22_nested_contents",
    """
select doc_id, concat_ws(chr(10), text, lang, source, '', 'x', 'True', 'None', case when doc_id % 2 = 0 then '[[' else text end) content
from documents""",
)
def _(t):
    """Lists of lists, one to sixty levels deep, with objects, empty lists and brackets inside texts."""
    rows = t.table("documents").withColumn("deep", F.col("doc_id") % 60)
    json_of = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    tail = F.when(F.col("doc_id") % 2 == 0, F.lit("[[")).otherwise(F.col("text"))
    inner = F.concat_ws(
        ",",
        F.concat(F.lit("["), json_of("text"), F.lit(",["), json_of("lang"), F.lit("]]")),
        json_of("source"),
        F.lit('[],[[{"answer":"x"}],true],null'),
        json_of(tail),
    )
    content = F.concat(F.repeat(F.lit("["), F.col("deep") + 1), inner, F.repeat(F.lit("]"), F.col("deep") + 1))
    return rows.select("doc_id", PR.content_text(F.parse_json(content)).alias("content"))


@query("c23_utf8_safe", "select doc_id, text, concat('x', chr(65533), 'y') repaired from documents")
def _(t):
    broken = F.concat(F.lit(b"x"), F.unhex(F.lit("FF")), F.lit(b"y"))
    return t.table("documents").select(
        "doc_id", T.utf8_safe(F.encode("text", "UTF-8")).alias("text"), T.utf8_safe(broken).alias("repaired")
    )


_FEATURES_SQL = f"""
select file_name, ord, cast(words as double) n, cast(h1 + h2 + h3 + h4 + h5 + h6 as double) h,
       cast(ordered + unordered as double) l, cast(stars + underscores as double) b from ({_STYLE_SQL})"""


@query(
    "c24_style_difference",
    f"""
with f as ({_FEATURES_SQL}),
j as (select x.file_name, x.ord, x.n an, y.n bn, x.h / (x.n + 1) ah, y.h / (y.n + 1) bh, x.l / (x.n + 1) al, y.l / (y.n + 1) bl,
             x.b / (x.n + 1) ab, y.b / (y.n + 1) bb from f x join f y on y.ord = x.ord and y.file_name = 'f0' where x.file_name <> 'f0')
select file_name, ord, round((an - bn) / greatest(an + bn, 1), 9) length, round((ah - bh) / (ah + bh + 1), 9) headers,
       round((al - bl) / (al + bl + 1), 9) lists, round((ab - bb) / (ab + bb + 1), 9) bolds from j""",
)
def _(t):
    features = t.view("answers_raw").select("file_name", "ord", S.feature_vector(F.col("answer")).alias("f"))
    base = features.where("file_name = 'f0'").select("ord", F.col("f").alias("g"))
    both = features.where("file_name <> 'f0'").join(base, "ord")
    d = both.select("file_name", "ord", S.style_difference(F.col("f"), F.col("g")).alias("d"))
    return d.select("file_name", "ord", *[F.round(F.col(f"d.{n}"), 9).alias(n) for n in S.FEATURES])


@query(
    "c25_seed_from_key",
    """
select doc_id, cast(('0x' || substr(sha256(concat('42-', text)), 1, 16))::ubigint as varchar) seed from documents""",
)
def _(t):
    return t.table("documents").select("doc_id", T.seed_from_key(F.col("text"), 42).cast("string").alias("seed"))


@query(
    "c26_interval_text",
    """
select event_id, concat('(-', printf('%.1f', round((s - lo) * 100, 1)), ' / +', printf('%.1f', round((hi - s) * 100, 1)), ')') ci,
       round(s * 100, 1) pct
from (select event_id, (event_id % 97) / 128.0::double s, (event_id % 97) / 256.0::double lo, (event_id % 97) / 64.0::double hi from events)""",
)
def _(t):
    k = (F.col("event_id") % 97).cast("double")
    return t.table("events").select(
        "event_id",
        PR.interval_text(k / 128, k / 256, k / 64).alias("ci"),
        PR.percent(k / 128).alias("pct"),
    )


@query(
    "c28_variant_payload",
    """
select doc_id, concat(source, chr(10), lang) system_text, text first_content, 'model' first_role, '{"source":"' || source || '"}' second_content
from documents""",
)
def _(t):
    """Messages whose contents are objects and lists."""
    message = lambda role, c: F.struct(F.lit(role).alias("role"), c.alias("content"))
    talk = F.array(
        message("system", F.to_variant_object(F.array("source", "lang"))),
        message("assistant", F.to_variant_object(F.named_struct(F.lit("answer"), F.col("text")))),
        message("user", F.to_variant_object(F.named_struct(F.lit("source"), F.col("source")))),
    )
    body = t.table("documents").select("doc_id", F.parse_json(PR.parts_payload(talk, 0.5, 64, as_text=PR.content_text)).alias("p"))
    get = lambda path: F.try_variant_get("p", path, "string")
    return body.select(
        "doc_id",
        get("$.systemInstruction.parts[0].text").alias("system_text"),
        get("$.contents[0].parts[0].text").alias("first_content"),
        get("$.contents[0].role").alias("first_role"),
        get("$.contents[1].parts[0].text").alias("second_content"),
    )


@query(
    "c28_request_payload",
    """
select ord, 2 + len(m) n, m[1].content first_content,
       case when m[1].role = 'assistant' then 'model' else 'user' end first_role, 'Be brief.' system_text,
       0.5::double temperature, 64 max_tokens, 'judge-x' model
from dialogue_messages where side = 'text' and len(m) > 0""",
)
def _(t):
    system = F.array(F.struct(F.lit("system").alias("role"), F.lit("Be brief.").alias("content")))
    talk = _messages(t).where(F.size("m") > 0).withColumn("all", F.concat(system, "m"))
    bodies = talk.select(
        "ord",
        F.parse_json(PR.parts_payload(F.col("all"), 0.5, 64)).alias("p"),
        F.parse_json(PR.chat_payload(F.col("all"), "judge-x", 0.5, 64)).alias("c"),
    )
    get = F.try_variant_get
    n = F.size(get(F.col("c"), "$.messages", "array<variant>")) + 1
    return bodies.select(
        "ord",
        n.alias("n"),
        get("p", "$.contents[0].parts[0].text", "string").alias("first_content"),
        get("p", "$.contents[0].role", "string").alias("first_role"),
        get("p", "$.systemInstruction.parts[0].text", "string").alias("system_text"),
        get("p", "$.generationConfig.temperature", "double").alias("temperature"),
        get("p", "$.generationConfig.maxOutputTokens", "int").alias("max_tokens"),
        get("c", "$.model", "string").alias("model"),
    )


@query(
    "c29_reply_extraction",
    """
select doc_id, case when doc_id % 5 = 0 then null else text end chat_answer, case when doc_id % 5 = 0 then 'no choices' end chat_error,
       case when doc_id % 5 = 0 then null else concat(text, lang) end parts_answer,
       case when doc_id % 5 = 0 then 'no candidates' end parts_error, n_chars total_tokens from documents""",
)
def _(t):
    some = F.col("doc_id") % 5 != 0
    usage = F.create_map(F.lit("total_tokens"), F.col("n_chars"))
    choice = F.struct(F.struct(F.col("text").alias("content")).alias("message"))
    parts = F.array(F.struct(F.col("text").alias("text")), F.struct(F.col("lang").alias("text")))
    candidate = F.struct(F.struct(parts.alias("parts")).alias("content"))
    only = lambda c: F.slice(F.array(c), F.lit(1), F.when(some, 1).otherwise(0))
    bodies = t.table("documents").select(
        "doc_id",
        F.to_json(F.struct(only(choice).alias("choices"), usage.alias("usage"))).alias("chat"),
        F.to_json(F.struct(only(candidate).alias("candidates"), usage.alias("usageMetadata"))).alias("parts"),
    )
    read = bodies.select(
        "doc_id", PR.chat_reply(F.col("chat")).alias("c"), PR.parts_reply(F.col("parts")).alias("p")
    )
    return read.select(
        "doc_id",
        F.col("c.answer").alias("chat_answer"),
        F.col("c.error").alias("chat_error"),
        F.col("p.answer").alias("parts_answer"),
        F.col("p.error").alias("parts_error"),
        F.col("p.usage")["total_tokens"].alias("total_tokens"),
    )


@query(
    "c30_failure_context",
    """
select ord, concat('[judge-error] uid=', uid, ' category=', category, ' model=org/sft baseline=', baseline, ' judge=gpt-4.1') context
from questions join settings using (category)""",
)
def _(t):
    rows = Q.with_settings(t.view("questions"), t.settings())
    context = PR.failure_context(
        F.col("uid"), F.col("category"), F.lit("org/sft"), F.col("baseline"), F.lit("gpt-4.1")
    )
    return rows.select("ord", context.alias("context"))
