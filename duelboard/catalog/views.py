"""Inputs of the registered queries, derived from the given tables.

The given tables hold no judgments, answers or transcripts, so each input is a
row-wise rewriting of ``documents``, ``events``, ``conversations`` or
``lineitem``. Every row and the whole text is used, and the inputs grow with the
tables. One SQL text serves both engines; ``Tables`` runs it on Spark and
``duckdb_view`` spells it for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.operators.leaderboard import baselines
from duelboard.session import spread_scan
from duelboard.sources.readers import resolve_answers

BASE_TABLES = (
    "documents", "events", "conversations", "lineitem", "labels", "benchmark", "orders", "pages",
)



def label_case(expression: str) -> str:
    """One of the ten verdict labels, or a junk label, from an integer."""
    return f"@LABEL({expression})"


def category_case(expression: str) -> str:
    return (
        f"case ({expression}) % 4 when 0 then 'hard_prompt' when 1 then 'coding' "
        "when 2 then 'math' else 'creative_writing' end"
    )


_DIALOGUE = (
    "concat(case doc_id % 5 when 0 then 'Human: ' when 1 then concat('intro', chr(10), chr(10), 'Human: ') "
    "when 2 then concat(chr(10), chr(10), 'Assistant: ') else concat(chr(10), chr(10), 'Human: ') end, "
    "replace(replace(text, concat('.', chr(10)), concat(chr(10), chr(10), 'Assistant: ')), '! ', "
    "concat(chr(10), chr(10), 'Human: ')), "
    "case when doc_id % 3 = 0 then concat(chr(10), chr(10), 'Assistant:  ok then. ') else '' end)"
)

# @STR is the string type, @INTS(n) unnests 0..n-1, @DOC(x) is floor(x / 10).
_SHARED = {
    "questions_raw": """
select case when doc_id % 17 = 3 then null else cast(doc_id as @STR) end uid,
       case when doc_id % 19 = 5 then concat(' ', chr(10)) else text end prompt,
       case doc_id % 5 when 0 then 'hard_prompt' when 1 then 'coding' when 2 then 'math'
            when 3 then '' else null end category,
       case when doc_id % 3 = 0 then null else source end cluster,
       doc_id ord
from {documents}""",
    "questions": f"""
select cast(doc_id as @STR) uid, text prompt, {category_case('doc_id')} category, doc_id ord
from {{documents}}""",
    "answers_raw": """
select concat('f', cast(k as @STR)) file_name,
       case k when 0 then 'o3-mini-2025-01-31' when 1 then 'gemini-2.0-flash-001' when 2 then 'aaa/sft'
              when 3 then 'org/dpo' when 4 then 'org/sft' when 5 then 'org/dpo' else 'lab/e-dpo' end model,
       cast(case when k > 1 and doc_id % 10 = 9 then doc_id - 1
                 when k = 1 and doc_id % 31 = 7 then doc_id - 1 else doc_id end as @STR) uid,
       doc_id ord,
       concat(case when (doc_id + k) % 3 = 0 then concat('# Title', chr(10)) else '' end,
              case when (doc_id * 3 + k) % 9 = 0 then concat('- item', chr(10), '  1. step', chr(10)) else '' end,
              case when (doc_id * 7 + k) % 6 = 0 then concat(text, ' ', text) else text end,
              case when (doc_id + k) % 5 = 0 then ' **bold** __b__' else '' end,
              case when (doc_id + 2 * k) % 7 = 0
                   then concat(chr(10), '```py', chr(10), '# not a header', chr(10), '```') else '' end) answer
from (select doc_id, text, @INTS(7) k from {documents}) d""",
    "judgments_raw": f"""
select cast(@DOC(event_id) as @STR) uid,
       {category_case('@DOC(event_id)')} category,
       case event_type when 'view' then 'gpt-4.1' when 'click' then 'gpt-4.1' else 'gemini-2.5-flash' end judge,
       case event_id % 3 when 0 then 'org/sft' when 1 then 'org/dpo' else 'lab/e-dpo' end model,
       {label_case('event_id * 3 + user_id')} g1,
       case when event_id % 101 = 0 then null else {label_case('event_id * 5 + user_id * 2 + 1')} end g2,
       case when event_id % 103 = 1 then 1 when event_id % 107 = 2 then 0 else 2 end n_games,
       case when event_id % 109 = 3 then 1 else 0 end null_game,
       cast(floor(value * 10) as bigint) prompt_tokens,
       ts, event_id ord
from {{events}}""",
    "shipments": f"""
select concat_ws('-', cast(l_orderkey as @STR), cast(l_linenumber as @STR), cast(l_partkey as @STR),
                 cast(l_suppkey as @STR)) uid,
       case l_returnflag when 'A' then 'hard_prompt' when 'N' then 'coding' else 'math' end category,
       concat('org/m', cast(l_suppkey % 5 as @STR)) model,
       {label_case('(l_orderkey * 10 + l_linenumber) * 3 + l_suppkey')} g1,
       {label_case('(l_orderkey * 10 + l_linenumber) * 5 + l_partkey')} g2
from {{lineitem}}""",
    "replies": f"""
select cast(doc_id as @STR) uid, game_no, {category_case('doc_id')} category,
       concat(text, chr(10),
              case (doc_id + game_no) % 6
                when 0 then concat('Verdict: [[', {label_case('doc_id * 3 + game_no')}, ']]')
                when 1 then concat('first [[A=B]] then [[', lower({label_case('doc_id * 3 + game_no')}), ']]')
                when 2 then concat('verdict [', {label_case('doc_id * 3 + game_no')}, ']')
                when 3 then 'no label here'
                when 4 then concat('[[]] [[', {label_case('doc_id * 3 + game_no')}, ']] done')
                else 'my final [A]' end) reply
from (select doc_id, text, k + 1 game_no from (select doc_id, text, @INTS(2) k from {{documents}}) e) d""",
    "comparison_replies": """
select concat('instr-', cast(doc_id as @STR)) instruction, doc_id ord,
       case doc_id % 9
         when 0 then concat('Comparison: ', text, chr(10), 'Winner: "b"')
         when 1 then '{"comparison": " same ", "winner": "TIE"}'
         when 2 then concat(text, chr(10), 'Winner: A', chr(10), '  winner: c')
         when 3 then concat('{"winner": "B", "comparison": "', text, '"')
         when 4 then text
         when 5 then '  '
         when 6 then concat('comparison:', text, chr(10), 'Winner: neither', chr(10), text)
         when 7 then '{"Winner": "b ", "comparison": "", "Comparison": "x"}'
         else concat('The winner is clear: ', text) end reply
from {documents}""",
    "dialogues": f"""
select doc_id ord,
       case doc_id % 11 when 4 then null when 5 then '' when 6 then '' else {_DIALOGUE} end chosen,
       case doc_id % 7 when 4 then null else concat({_DIALOGUE}, chr(10), chr(10), 'Assistant: no.') end rejected,
       case doc_id % 11 when 5 then {_DIALOGUE} else '' end prompt,
       {_DIALOGUE} text
from {{documents}}""",
    "candidates": """
select case k when 0 then 'chosen' when 1 then 'sft' else 'beta_dpo' end name,
       case when doc_id % 41 = 7 then ''
            else concat('instr-', cast(case when doc_id % 10 = 9 then doc_id - 1 else doc_id end as @STR)) end instruction,
       case when (doc_id + k) % 13 = 0 then null
            else concat('{instruction} ', cast(k as @STR), ': ', text) end output,
       doc_id ord
from (select doc_id, text, @INTS(3) k from {documents}) d""",
    "results": """
select case when doc_id % 43 = 5 then null
            else concat('instr-', cast(case when doc_id % 10 = 8 then doc_id - 1 else doc_id end as @STR)) end instruction,
       case doc_id % 7 when 1 then 'TIE' else 'A' end winner,
       case doc_id % 7 when 0 then 'TIE' when 1 then null when 2 then 'tie' when 3 then 'sft'
            when 4 then 'sft' when 5 then 'chosen' else 'other' end winner_key,
       n_chars total_tokens, doc_id ord
from {documents}""",
    "turn_questions_raw": """
select case when doc_id % 3 = 0 then null else cast(doc_id as @STR) end question_id,
       case when doc_id % 23 = 6 then null else concat('id-', cast(doc_id as @STR)) end id,
       lang category,
       case when doc_id % 4 = 1 then null
            else replace(text, concat('!', chr(10)), chr(1)) end turn_text,
       case when doc_id % 8 = 1 then null when doc_id % 16 = 5 then '  ' else text end question,
       case when doc_id % 8 = 1 then text else null end prompt,
       doc_id ord
from {documents}""",
}

# Views whose array handling differs between the engines.
_DUCKDB_ONLY = {
    "answers": """
select file_name, first_file, model, uid, max(ord) ord, arg_max(answer, ord) answer
from (select a.*, first_file from answers_raw a
      join (select model, max(file_name) file_name, min(file_name) first_file from answers_raw group by 1) w
      using (model, file_name))
group by 1, 2, 3, 4""",
    "valid_judgments": f"""
select * from judgments_raw
where n_games = 2 and null_game = 0 and g1 is not null and g2 is not null
  and not (g1 = 'junk' and g2 = 'junk')""",
    "battles": """
select uid, regexp_replace(model, '^.*/', '') model, category, score from (
  select uid, model, category, s.score, unnest(range(s.weight)) n from valid_judgments
  join label_scores s on s.label = g2
  union all
  select uid, model, category, 1 - s.score, unnest(range(s.weight)) n from valid_judgments
  join label_scores s on s.label = g1)""",
    "label_scores": "select * from (values "
    + ", ".join(f"('{label}', cast({s} as double), {w})" for label, (s, w) in K.LABEL_SCORES.items())
    + ") t(label, score, weight)",
    "settings": "select * from (values "
    + ", ".join(
        f"('{c}', '{base}', '{prompt.replace(chr(39), chr(39) * 2)}')"
        for c, (base, prompt) in K.CATEGORY_SETTINGS.items()
    )
    + ") t(category, baseline, system_prompt)",
    "rollout_lines": f"""
select prompt_id, pos, trim(line, '{K.PY_SPACES}') response
from (select doc_id prompt_id, unnest(range(len(string_split(text, chr(10))))) pos,
             unnest(string_split(text, chr(10))) line from documents)
union all
select doc_id, len(string_split(text, chr(10))), case doc_id % 3 when 0 then '' else '<|eot_id|>' end
from documents where doc_id % 3 < 2""",
    "ranked_lines": """
select prompt_id, arg_max(pos, (score, md5(concat_ws('|', '42', prompt_id, pos, 'best')))) best,
       arg_min(pos, (score, md5(concat_ws('|', '42', prompt_id, pos, 'worst')))) worst
from (select *, cast(length(response) % 7 as double) score,
             count(*) over (partition by prompt_id) n
      from rollout_lines where response not in ('', '<|eot_id|>'))
where n >= 2 group by 1""",
    "dialogue_messages": f"""
select ord, side, list_filter(list_transform(
         string_split(regexp_replace(concat(chr(10), chr(10), t), '\\n\\n(Human|Assistant): ?',
                                     concat(chr(1), '\\1', chr(2)), 'g'), chr(1))[2:],
         lambda p: {{'role': case when p[1] = 'H' then 'user' else 'assistant' end,
                     'content': trim(split_part(p, chr(2), 2), '{K.PY_SPACES}')}}),
         lambda m: m.content <> '') m
from (select ord, unnest(['chosen', 'rejected', 'text', 'eval']) side,
             unnest([chosen, rejected, text, case when chosen <> '' then chosen when prompt <> '' then prompt
                                                  else text end]) t from dialogues)
where t is not null""",
    "turn_questions": f"""
select coalesce(question_id, id) question_id, category, ord,
       case when turn_text is not null
            then list_filter(list_transform(string_split(turn_text, chr(1)),
                                            lambda x: trim(x, '{K.PY_SPACES}')), lambda x: x <> '')
            else list_filter([trim(coalesce(question, prompt), '{K.PY_SPACES}')], lambda x: x <> '') end turns
from turn_questions_raw
where coalesce(question_id, id) is not null""",
}

VIEWS = [*_SHARED, *_DUCKDB_ONLY]


def _spell(text: str, string_type: str, ints: str, label: str, divide: str) -> str:
    import re

    text = re.sub(r"@DOC\((\w+)\)", rf"(\1 {divide} 10)", text)
    text = re.sub(r"@INTS\((\d+)\)", lambda m: ints.format(n=m.group(1), last=int(m.group(1)) - 1), text)
    labels = ", ".join(f"'{label}'" for label in (*K.LABEL_SCORES, "junk"))
    text = re.sub(r"@LABEL\(([^()]*(?:\([^()]*\)[^()]*)*)\)", lambda m: label.format(e=m.group(1), labels=labels), text)
    return text.replace("@STR", string_type)


def duckdb_view(name: str) -> str:
    if name in _DUCKDB_ONLY:
        return _DUCKDB_ONLY[name].strip()
    text = _spell(_SHARED[name], "varchar", "unnest(range({n}))", "[{labels}][({e}) % 11 + 1]", "//")
    for table in BASE_TABLES:
        text = text.replace("{" + table + "}", table)
    return text.strip()


def as_event_time(ts: Column) -> Column:
    """Zone-less time as an event time that reads the same in UTC."""
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), ts).cast("timestamp")


def as_plain_time(ts: Column) -> Column:
    """Back from an event time to the zone-less time."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))


class Tables:
    """Given tables and derived inputs of one data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def view(self, name: str, sources: dict[str, DataFrame] | None = None) -> DataFrame:
        label = "element_at(array({labels}), cast(({e}) % 11 + 1 as int))"
        text = _spell(_SHARED[name], "string", "explode(sequence(0, {last}))", label, "div").strip()
        used = [t for t in BASE_TABLES if "{" + t + "}" in text]
        aliases = {}
        for t in used:
            text = text.replace("{" + t + "}", f"__src_{t}")
            if sources and t in sources:
                aliases[t] = sources[t]
            else:
                aliases[t] = self.table(t)
        text = text.replace("{", "{{").replace("}", "}}")
        for t in used:
            text = text.replace(f"__src_{t}", "{" + t + "}")
        return self.spark.sql(text, **aliases)

    def heavy_view(self, name: str) -> DataFrame:
        """A view over ``documents`` for work that costs much per byte of text."""
        return self.view(name, {"documents": spread_scan(self.table("documents"))})

    # -- inputs in their stored shape ----------------------------------------

    def judgments(self) -> DataFrame:
        """Judgment records with their array of games."""
        return self.judgments_from(self.table("events"))

    def judgments_from(self, events: DataFrame) -> DataFrame:
        raw = self.view("judgments_raw", {"events": events})
        game = lambda c: F.struct(F.col(c).alias("score"))
        second = F.when(F.col("null_game") == 0, game("g2"))
        games = F.slice(F.array(game("g1"), second), F.lit(1), F.col("n_games"))
        return raw.select(
            "uid", "category", "judge", "model", games.alias("games"),
            F.create_map(
                F.lit("prompt_tokens"), F.col("prompt_tokens"),
                F.lit("total_tokens"), F.col("prompt_tokens") + 7,
            ).alias("usage"),
            "ts", "ord",
        )

    def shipments(self) -> DataFrame:
        game = lambda c: F.struct(F.col(c).alias("score"))
        return self.view("shipments").select(
            "uid", "category", "model", F.array(game("g1"), game("g2")).alias("games")
        )

    def answers(self) -> DataFrame:
        return resolve_answers(self.view("answers_raw"))

    def settings(self) -> DataFrame:
        return baselines(self.spark)

    def rollouts(self) -> DataFrame:
        """prompt_id, prompt_messages, responses: the lines of a document, some with an empty one after them."""
        from duelboard.functions.text import strip

        documents = self.table("documents")
        lines = F.transform(F.split("text", "\n"), strip)
        empty = F.when(F.col("doc_id") % 3 == 0, F.array(F.lit(""))).when(
            F.col("doc_id") % 3 == 1, F.array(F.lit("<|eot_id|>"))
        )
        responses = F.concat(lines, F.coalesce(empty, F.array().cast("array<string>")))
        prompt: Column = F.array(
            F.struct(F.lit("user").alias("role"), F.col("source").alias("content"))
        )
        return documents.select(
            F.col("doc_id").alias("prompt_id"),
            prompt.alias("prompt_messages"),
            responses.alias("responses"),
        )

    def turn_questions_raw(self) -> DataFrame:
        raw = self.view("turn_questions_raw")
        return raw.withColumn("turns", F.split("turn_text", "\x01")).drop("turn_text")
