"""Queries for reply functions, whole workflows and streams (F*, C27, E*, ST*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from duelboard import constants as K
from duelboard.catalog.column_queries import LABEL_SQL, sql_fill
from duelboard.catalog.join_queries import _COMMON_SQL, _JUDGED_SQL, _ORDER_SQL, _PAIRED_SQL, TARGET, _judged
from duelboard.catalog.registry import query
from duelboard.catalog.views import as_event_time, as_plain_time
from duelboard.functions.expand import expand_rows
from duelboard.functions.verdicts import parse_label
from duelboard.operators import pairs as P
from duelboard.operators import replies as R
from duelboard.operators import requests as Q
from duelboard.plans.comparison import comparison_round, resumed, win_table
from duelboard.plans.judging import judge_games, merge_judgments, pending_games
from duelboard.plans.preference import build_pairs, score_responses
from duelboard.session import scratch_dir
from duelboard.sources.judged_lines import stream_judged_lines
from duelboard.sources.writers import write_jsonl
from duelboard.streaming import ingest as ST
from duelboard.streaming import windows as SW

NAMES = ["chosen", "sft", "beta_dpo"]
_LABELS = [*K.LABEL_SCORES, "junk"]
_LABEL_LIST = "[" + ", ".join(f"'{x}'" for x in _LABELS) + "]"


# -- deterministic stand-ins for model endpoints ------------------------------


def stub_judge():
    """Labels by prompt length; every seventh length gives no label."""

    def reply(pdf):
        out = []
        for messages in pdf["messages"]:
            n = len(messages[-1]["content"])
            label = _LABELS[n % len(_LABELS)]
            out.append("cannot decide" if n % 7 == 0 else f"Verdict: [[{label}]]")
        return out

    return reply


def stub_repair():
    """Repairs by prompt length; some requests fail."""

    def answer(row):
        if len(row["messages"][-1]["content"]) % 5 == 0:
            raise RuntimeError("endpoint unavailable")
        return "[[A=B]]"

    return R.one_by_one(answer)


def failing_winner():
    """The same judge with an outage: instructions of some lengths get no reply."""
    answer = stub_winner()

    def reply(pdf):
        if (pdf["instruction"].str.len() % 4 == 0).any():
            raise RuntimeError("no service")
        return answer(pdf)

    return reply


def stub_winner():
    """Winner by prompt length, in the two reply forms."""

    def reply(pdf):
        out = []
        for prompt in pdf["prompt"]:
            n = len(prompt)
            word = ("A", "B", "C", "TIE")[n % 4]
            out.append(
                f"Comparison: seen\nWinner: {word}"
                if n % 2
                else f'{{"comparison": "seen", "winner": "{word}"}}'
            )
        return out

    return reply


def stub_scorer():
    return lambda pairs: [float(len(response) % 7) for _, response in pairs]


# -- repair -------------------------------------------------------------------


@query(
    "c27_repair_requests",
    "select uid, game_no, "
    + sql_fill(K.REPAIR_TEMPLATE, CATEGORY="category", ANALYSIS="reply")
    + f" request from ({LABEL_SQL}) where score is null",
)
def _(t):
    rows = t.view("replies").withColumn("round_label", F.lit("r"))
    requests = R.repair_requests(R.with_labels(rows))
    return requests.select("uid", "game_no", F.col("messages")[1]["content"].alias("request"))


@query(
    "c27_apply_repairs",
    f"""
select uid, game_no, coalesce(score, case when game_no = 1 then 'A=B' end) score,
       score is null and game_no = 1 repaired, coalesce(score, case when game_no = 1 then 'A=B' end) is null failed
from ({LABEL_SQL})""",
)
def _(t):
    rows = t.view("replies").withColumns(
        {"round_label": F.lit("r"), "error": F.lit(None).cast("string")}
    )
    labelled = R.with_labels(rows)
    answers = R.repair_requests(labelled).select(
        "uid", "game_no", F.when(F.col("game_no") == 1, "[[A=B]]").otherwise("none").alias("repair_reply")
    )
    fixed = R.apply_repairs(labelled, answers)
    return fixed.select(
        "uid", "game_no", "score", "repaired", F.col("failure").isNotNull().alias("failed")
    )


# -- extension points ---------------------------------------------------------

_SCORED_SQL = """
select prompt_id, pos, cast(length(response) % 7 as double) score from (
  select *, count(*) over (partition by prompt_id) n from rollout_lines where response not in ('', '<|eot_id|>')) where n >= 2"""


@query("f1_response_scores", _SCORED_SQL)
def _(t):
    scored = score_responses(t.rollouts(), F.col("prompt_messages")[0]["content"], stub_scorer)
    return scored.select("prompt_id", F.explode(F.arrays_zip("kept", "scores")).alias("z")).select(
        "prompt_id", F.col("z.kept").alias("pos"), F.col("z.scores").alias("score")
    )


@query(
    "f2_batched_spans",
    f"select prompt_id, count(*) n, sum(score) total from ({_SCORED_SQL}) group by 1",
)
def _(t):
    scored = score_responses(t.rollouts(), F.col("prompt_messages")[0]["content"], stub_scorer)
    total = F.aggregate("scores", F.lit(0.0), lambda a, s: a + s)
    return scored.select("prompt_id", F.size("scores").alias("n"), total.alias("total"))


_GAMES_SQL = f"""
{_JUDGED_SQL}, p as ({_PAIRED_SQL}), g as (
  select uid, category, baseline, 1 game_no, {sql_fill(K.JUDGE_TEMPLATE, QUESTION="prompt", ANSWER_A="baseline_answer", ANSWER_B="target_answer")} msg from p
  union all select uid, category, baseline, 2, {sql_fill(K.JUDGE_TEMPLATE, QUESTION="prompt", ANSWER_A="target_answer", ANSWER_B="baseline_answer")} from p),
pend as (select *, length(msg) n from g where uid not in (select uid from judged where complete)),
said as (select *, case when n % 7 = 0 then 'cannot decide' else concat('Verdict: [[', {_LABEL_LIST}[n % 11 + 1], ']]') end reply from pend),
first_pass as (select *, case when n % 7 = 0 or n % 11 = 10 then null else {_LABEL_LIST}[n % 11 + 1] end s1,
    length({sql_fill(K.REPAIR_TEMPLATE, CATEGORY="category", ANALYSIS="reply")}) rn from said),
scored as (select *, coalesce(s1, case when rn % 5 <> 0 then 'A=B' end) score from first_pass)"""


@query("f3_judge_calls", f"with {_GAMES_SQL} select uid, game_no, reply, score from scored")
def _(t):
    games = pending_games(t.view("questions"), t.answers(), _judged(t), TARGET, t.settings())
    scored = judge_games(games, stub_judge, scratch_dir(t.spark, "games"), stub_repair)
    return scored.select("uid", "game_no", "reply", "score")


@query(
    "f4_custom_patterns",
    """
select uid, game_no, coalesce(list_filter(regexp_extract_all(upper(reply), 'VERDICT:? \\[+([AB<>=]+)\\]+', 1), lambda x: x <> '')[-1],
       list_filter(regexp_extract_all(upper(reply), 'FINAL \\[[AB]\\]'), lambda x: x <> '')[-1]) score from replies""",
)
def _(t):
    patterns = (r"VERDICT:? \[+([AB<>=]+)\]+", r"FINAL \[[AB]\]")
    return t.view("replies").select(
        "uid", "game_no", parse_label(F.col("reply"), patterns).alias("score")
    )


@query("f5_markdown_leaderboard")
def _(t):
    """Style board controlled for markdown only."""
    from duelboard.catalog.score_queries import _valid, lookup
    from duelboard.operators.style_board import style_leaderboard

    return style_leaderboard(_valid(t), lookup(t), t.settings(), ["markdown"], rounds=20)


@query(
    "f6_custom_stops",
    f"""
select doc_id, trim(case when p is null then text else left(text, cast(p - 1 as bigint)) end, '{K.PY_SPACES}') kept
from (select doc_id, text, least(nullif(strpos(text, '.' || chr(10)), 0), nullif(strpos(text, '!'), 0)) p from documents)""",
)
def _(t):
    from duelboard.functions.text import cut_at_stop

    return t.table("documents").select("doc_id", cut_at_stop(F.col("text"), (".\n", "!")).alias("kept"))


@query(
    "f7_row_expansion",
    """
select ord, count(*) n, count_if(m.role = 'user') users, sum(length(m.content)) chars
from (select ord, unnest(m) m from dialogue_messages where side = 'text') group by 1""",
)
def _(t):
    from duelboard.functions.transcripts import parse_transcript

    rows = t.view("dialogues").select("ord", F.explode(parse_transcript(F.col("text"))).alias("m"))
    return rows.groupBy("ord").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("m.role") == "user").alias("users"),
        F.sum(F.length("m.content")).alias("chars"),
    )


@query(
    "f7_game_expansion",
    f"""
with {_JUDGED_SQL}, p as ({_PAIRED_SQL})
select uid, 1 game_no, md5(baseline_answer) a_md5, md5(target_answer) b_md5 from p where uid not in (select uid from judged where complete)
union all select uid, 2, md5(target_answer), md5(baseline_answer) from p where uid not in (select uid from judged where complete)""",
)
def _(t):
    """A user-written expansion of each paired question into its two games."""

    def make():
        def games(row):
            yield row["uid"], 1, row["baseline_answer"], row["target_answer"]
            yield row["uid"], 2, row["target_answer"], row["baseline_answer"]

        return games

    pending = Q.unjudged(t.view("questions"), _judged(t), TARGET, t.settings())
    paired = Q.with_answers(pending, t.answers(), TARGET, Q.baseline_models(t.settings()))
    rows = expand_rows(paired.select("uid", "baseline_answer", "target_answer"), make, "uid string, game_no int, a string, b string")
    return rows.select("uid", "game_no", F.md5("a").alias("a_md5"), F.md5("b").alias("b_md5"))


@query(
    "f7_running_expansion",
    """
with m as (select ord, unnest(range(len(m))) pos, unnest(m) m from dialogue_messages where side = 'text')
select ord, pos, m.role, sum(length(m.content)) over (partition by ord order by pos)::bigint chars from m
union all select ord, -1, 'all', sum(length(m.content))::bigint from m group by ord""",
)
def _(t):
    """A user-written expansion with state: the messages of a dialogue in order, then a total."""
    from duelboard.functions.transcripts import parse_transcript

    def make():
        class Running:
            def __init__(self):
                self.ord, self.chars = None, 0

            def row(self, row):
                self.ord, self.chars = row["ord"], self.chars + len(row["content"])
                yield row["ord"], row["pos"], row["role"], self.chars

            def end(self):
                if self.ord is not None:
                    yield self.ord, -1, "all", self.chars

        return Running()

    rows = t.view("dialogues").select("ord", F.posexplode(parse_transcript(F.col("text"))).alias("pos", "m"))
    return expand_rows(
        rows.select("ord", "pos", "m.role", "m.content"), make, "ord bigint, pos bigint, role string, chars bigint", ["ord"], ["pos"]
    )


# -- whole workflows ----------------------------------------------------------


_RECORD_SQL = f"""
{_GAMES_SQL},
record as (select *, md5(msg) prompt, md5(reply) judgment, case when s1 is null and score is not null then '[[A=B]]' end repair from scored),
fresh as (select uid, max(score) filter (game_no = 1) g1, max(score) filter (game_no = 2) g2,
            max(prompt) filter (game_no = 1) prompt_1, max(prompt) filter (game_no = 2) prompt_2,
            max(judgment) filter (game_no = 1) judgment_1, max(judgment) filter (game_no = 2) judgment_2,
            max(repair) filter (game_no = 1) repair_1, max(repair) filter (game_no = 2) repair_2
          from record group by 1 having count(score) = 2),
old as (select j.uid, arg_max(g1, j.ord) g1, arg_max(g2, j.ord) g2 from judgments_raw j join judged d using (uid)
        where d.complete and judge = 'gpt-4.1' and model = '{TARGET}' group by 1)
select uid, g1, g2, 'new' origin, prompt_1, prompt_2, judgment_1, judgment_2, repair_1, repair_2 from fresh
union all select uid, g1, g2, 'old', null, null, null, null, null, null from old"""


def _records(merged):
    """The fields of both games of each record, long texts as digests."""
    games = [F.col("games")[k] for k in (0, 1)]
    return merged.select(
        "uid",
        *[g["score"].alias(f"g{k}") for k, g in enumerate(games, 1)],
        F.when(F.col("baseline").isNull(), "old").otherwise("new").alias("origin"),
        *[F.md5(g["prompt"][1]["content"]).alias(f"prompt_{k}") for k, g in enumerate(games, 1)],
        *[F.md5(g["judgment"]["answer"]).alias(f"judgment_{k}") for k, g in enumerate(games, 1)],
        *[g["repair"]["judgment"]["answer"].alias(f"repair_{k}") for k, g in enumerate(games, 1)],
    )


@query("e2_pairwise_judging", f"with {_RECORD_SQL}")
def _(t):
    """Pending games, judged, repaired, assembled to full records and merged with stored rows."""
    stored = _judged(t).withColumn("baseline", F.lit(None).cast("string"))
    games = pending_games(t.view("questions"), t.answers(), stored, TARGET, t.settings())
    scored = judge_games(games, stub_judge, scratch_dir(t.spark, "games"), stub_repair)
    return _records(merge_judgments(stored, scored, "gpt-4.1", TARGET))


@query("e2_resumed_judging", f"with {_RECORD_SQL}")
def _(t):
    """The same over two runs: half of the questions first, then all with the same store."""
    stored = _judged(t).withColumn("baseline", F.lit(None).cast("string"))
    games = pending_games(t.view("questions"), t.answers(), stored, TARGET, t.settings())
    store = scratch_dir(t.spark, "games")
    judge_games(games.where(F.crc32(F.col("uid").cast("binary")) % 2 == 0), stub_judge, store, stub_repair)
    scored = judge_games(games, stub_judge, store, stub_repair)
    return _records(merge_judgments(stored, scored, "gpt-4.1", TARGET))


_ROUND_SQL = f"""
{_COMMON_SQL}, {_ORDER_SQL},
asked as (select instruction, o, length({sql_fill(K.THREE_WAY_TEMPLATE, instruction="instruction", output_a="o[1].output", output_b="o[2].output", output_c="o[3].output")}) n
          from labelled where instruction not in (select instruction from results where instruction is not null and ord % 3 = 0)),
told as (select *, ['A', 'B', 'C', 'TIE'][n % 4 + 1] winner from asked)"""


@query(
    "e3_comparison_round",
    f"""
with {_ROUND_SQL}
select instruction, 'seen' comparison, winner, case winner when 'A' then o[1].name when 'B' then o[2].name
       when 'C' then o[3].name else 'TIE' end winner_key from told""",
)
def _(t):
    """Two rounds over one set: the first meets failing calls, the second asks only these again."""
    done = t.view("results").where("ord % 3 = 0")
    first, second = _two_rounds(t, done)
    rows = first.results.unionByName(second.results)
    return rows.select("instruction", "comparison", "winner", "winner_key")


def _two_rounds(t, done):
    first = comparison_round(t.view("candidates"), NAMES, failing_winner, "judge-x", scratch_dir(t.spark, "round"), done)
    told = done.select("instruction").unionByName(first.results.select("instruction"))
    second = comparison_round(t.view("candidates"), NAMES, stub_winner, "judge-x", scratch_dir(t.spark, "round"), told)
    return first, second


@query(
    "e3_failed_calls",
    f"""
with {_ROUND_SQL}
select instruction, 'RuntimeError: no service' error from told where length(instruction) % 4 = 0""",
)
def _(t):
    """Calls that failed in the first round: no results, no ties."""
    done = t.view("results").where("ord % 3 = 0")
    return _two_rounds(t, done)[0].failed


@query(
    "e3_win_table",
    f"""
with {_ROUND_SQL},
stored as (select arg_min(struct_pack(w := winner, k := winner_key), ord) r from results
           where instruction is not null and instruction <> '' and ord % 3 = 0 group by instruction),
k as (select case winner when 'A' then o[1].name when 'B' then o[2].name when 'C' then o[3].name else 'TIE' end as key from told
      union all select coalesce(nullif(r.k, ''), r.w) from stored),
m as (select case when coalesce(key, '') = '' or upper(key) = 'TIE' then 'TIE' else key end as key from k),
c as (select key, count(*) n from m group by 1 union all
      select v.key, 0 from (values ('chosen'), ('sft'), ('beta_dpo'), ('TIE')) v(key) where v.key not in (select key from m))
select key, cast(n as bigint) n, (select cast(sum(n) as bigint) from c) total,
       case when key <> 'TIE' then round(n / (select sum(n) from c where key <> 'TIE'), 9) end win_rate from c""",
)
def _(t):
    """Win rates over the stored rows and both rounds."""
    done = t.view("results").where("ord % 3 = 0")
    first, second = _two_rounds(t, done)
    rows = resumed(done, first.results.unionByName(second.results))
    return win_table(rows, NAMES).withColumn("win_rate", F.round("win_rate", 9))


@query(
    "e4_preference_pairs",
    """
select r.prompt_id, b.response chosen, w.response rejected, 'org/reward' reward_model from ranked_lines r
join rollout_lines b on b.prompt_id = r.prompt_id and b.pos = r.best
join rollout_lines w on w.prompt_id = r.prompt_id and w.pos = r.worst""",
)
def _(t):
    meta = P.run_metadata("rollout", 42, 8, "org/sft", "org/reward")
    pairs = build_pairs(t.rollouts(), F.col("prompt_messages")[0]["content"], stub_scorer, meta)
    return pairs.select(
        "prompt_id",
        F.col("chosen")[0]["content"].alias("chosen"),
        F.col("rejected")[0]["content"].alias("rejected"),
        "metadata.reward_model",
    )


# -- streams ------------------------------------------------------------------


def _plain_times(df):
    """Timestamp columns as the zone-less times of the events table."""
    times = [n for n, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({n: as_plain_time(F.col(n)) for n in times})


def _event_stream(t):
    """Judgments as a stream over the events table, in the stored shape."""
    schema = t.table("events").schema
    events = ST.file_stream(t.spark, t.sf_dir, schema, "parquet", "events.parquet")
    return t.judgments_from(events).withColumn("ts", as_event_time(F.col("ts")))


#: The events arrive in three parts, by ten days; some come one part later, some in the last.
_ARRIVES = "case when event_id % 25 = 7 then 2 else least(2, (day(ts) - 1) @ 10 + case when event_id % 10 = 3 then 1 else 0 end) end"
_ARRIVED_SQL = f"""
events_in as (select event_id, {_ARRIVES.replace("@", "//")} arrives from events),
arrived as (select j.*, e.arrives from judgments_raw j join events_in e on e.event_id = j.ord)"""
#: Rows on time for windows whose rows end at ``closes``: the watermark is an hour behind the parts before.
_ON_TIME_SQL = f"""
{_ARRIVED_SQL},
marks as (select max(ts) filter (arrives = 0) - interval 1 hour m1, max(ts) filter (arrives <= 1) - interval 1 hour m2,
                 date_trunc('milliseconds', max(ts)) - interval 1 hour done from arrived),
timed as (select a.*, m.done, case arrives when 1 then m1 when 2 then m2 end mark, @CLOSES closes from arrived a, marks m),
on_time as (select * from timed where mark is null or closes > mark)"""
_DAY_SQL = _ON_TIME_SQL.replace("@CLOSES", "time_bucket(interval 1 day, ts) + interval 1 day")


def _parts(t):
    """Feeds the three parts of the events, one after the other; yields the judgments as a stream over what has been fed."""
    source = scratch_dir(t.spark, "feed")
    events = t.table("events").withColumn("part", F.expr(_ARRIVES.replace("@", "div")))
    for part in range(3):
        events.where(F.col("part") == part).drop("part").write.mode("append").parquet(source)
        stream = ST.file_stream(t.spark, source, t.table("events").schema, "parquet")
        yield t.judgments_from(stream).withColumn("ts", as_event_time(F.col("ts")))


@query(
    "st1_ingest_once",
    f"""
with {_ARRIVED_SQL}
select uid || '/' || judge || '/' || model as key, arg_min(ord, (arrives, ord)) ord, count(*) n from arrived group by 1""",
)
def _(t):
    """The first arrival of every key, over three batches and a new checkpoint; counts come from the batch side."""
    key = F.concat_ws("/", "uid", "judge", "model").alias("key")
    path, checkpoint = scratch_dir(t.spark, "once"), scratch_dir(t.spark, "once-state")
    for stream in _parts(t):
        ST.first_per_key(stream.select(key, "ts", "ord"), path, checkpoint, ["key"])
    ST.first_per_key(stream.select(key, "ts", "ord"), path, scratch_dir(t.spark, "once-state"), ["key"])  # adds nothing
    counts = t.judgments().groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return t.spark.read.parquet(path).select("key", "ord").join(counts, "key")


@query(
    "st2_running_winners",
    """
select case when coalesce(k, '') = '' or upper(k) = 'TIE' then 'TIE' else k end as key, count(*) n
from (select case cast(@ % 7 as int) when 0 then 'TIE' when 1 then null when 2 then 'tie' when 3 then 'sft' when 4 then 'sft'
             when 5 then 'chosen' else 'other' end k from events) group by 1""".replace("@", "event_id"),
)
def _(t):
    schema = t.table("events").schema
    events = ST.file_stream(t.spark, t.sf_dir, schema, "parquet", "events.parquet")
    keys = F.array(*[F.lit(x) for x in ("TIE", None, "tie", "sft", "sft", "chosen", "other")])
    rows = events.select(
        F.element_at(keys, (F.col("event_id") % 7 + 1).cast("int")).alias("winner_key"),
        F.lit(None).cast("string").alias("winner"),
    )
    path, checkpoint = scratch_dir(t.spark, "winners"), scratch_dir(t.spark, "winners-state")
    ST.replace_per_batch(ST.running_winners(rows), path, checkpoint)
    return ST.newest(t.spark, path)


@query(
    "st3_running_scores",
    "select category, model, count(*) battles, round(avg(score), 9) score from battles group by 1, 2",
)
def _(t):
    path, checkpoint = scratch_dir(t.spark, "scores"), scratch_dir(t.spark, "scores-state")
    ST.replace_per_batch(ST.running_scores(_event_stream(t)), path, checkpoint)
    return ST.newest(t.spark, path).withColumn("score", F.round("score", 9))


def _daily_panes(t):
    """Folder with the closed days per judge and the rows that came too late for theirs, after three batches."""
    folder, checkpoint = scratch_dir(t.spark, "days"), scratch_dir(t.spark, "days-state")
    for stream in _parts(t):
        SW.count_panes(stream, folder, checkpoint, "ts", "1 hour", "1 day", ["judge"])
    return folder


@query(
    "st4_windowed_throughput",
    f"""
with {_DAY_SQL}
select closes - interval 1 day window_start, closes window_end, judge, count(*) n
from on_time where closes <= done group by all""",
)
def _(t):
    """Days that have ended, written once each while the parts arrive."""
    return _plain_times(SW.closed_windows(t.spark, _daily_panes(t), "1 hour", "1 day", ["judge"]))


@query(
    "st4_sliding_throughput",
    f"""
with {_DAY_SQL},
pairs as (select judge, done, closes + to_days(cast(unnest([0, 1]) as int)) window_end from on_time where closes <= done)
select window_end - interval 2 days window_start, window_end, judge, count(*) n from pairs where window_end <= done group by all""",
)
def _(t):
    """Two days, every day: sums of two closed panes."""
    return _plain_times(SW.closed_windows(t.spark, _daily_panes(t), "1 hour", "1 day", ["judge"], 2))


@query(
    "st4_late_rows",
    f"""
with {_DAY_SQL} select uid, judge, model, ts, ord, mark as watermark from timed where closes <= mark""",
)
def _(t):
    """The rows that came after their day had ended, with the watermark that they met."""
    late = SW.late_rows(t.spark, _daily_panes(t))
    return _plain_times(late.select("uid", "judge", "model", "ts", "ord", "watermark"))


@query(
    "st4_sessions",
    f"""
with {_ON_TIME_SQL.replace("@CLOSES", "ts")},
g as (select judge, ts, done, case when lag(ts) over w is null or ts - lag(ts) over w >= interval 15 minutes then 1 else 0 end b
      from on_time window w as (partition by judge order by ts)),
s as (select judge, ts, done, sum(b) over (partition by judge order by ts rows unbounded preceding) k from g),
ended as (select judge, min(ts) session_start, max(ts) + interval 15 minutes session_end, count(*) n, any_value(done) done from s group by judge, k)
select judge, session_start, session_end, n from ended where session_end <= done""",
)
def _(t):
    """Sessions that have ended, over three batches with late rows."""
    folder, checkpoint = scratch_dir(t.spark, "sessions"), scratch_dir(t.spark, "sessions-state")
    for stream in _parts(t):
        SW.count_sessions(stream, folder, checkpoint, "ts", "1 hour", "15 minutes", ["judge"])
    return _plain_times(t.spark.read.parquet(f"{folder}/sessions"))


@query(
    "st1_ingest_judged_lines",
    """
select uid || '/' || judge || '/' || model as key, max(judge) judge, count(*) n from judgments_raw group by 1""",
)
def _(t):
    """First arrivals of judgment files, streamed by folder and file through the library's own source."""
    rows = t.judgments().select("uid", "category", "model", F.lit(None).cast("string").alias("baseline"), "games", "judge")
    path = scratch_dir(t.spark, "judged")
    write_jsonl(rows, path, ["judge"])
    key = F.concat_ws("/", "uid", "judge", "model").alias("key")
    stream = stream_judged_lines(t.spark, path).select(key, "judge", "line")
    once = scratch_dir(t.spark, "once")
    ST.first_per_key(stream, once, scratch_dir(t.spark, "once-state"), ["key"], order="line")
    counts = t.judgments().groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return t.spark.read.parquet(once).select("key", "judge").join(counts, "key")


@query(
    "st5_merge_batches",
    f"""
with {_ARRIVED_SQL},
good as (select * from arrived where n_games = 2 and null_game = 0 and g1 is not null and g2 is not null)
select uid, arg_max(ord, (-arrives, ord)) ord from good group by 1""",
)
def _(t):
    """Complete judgments merged over three batches: stored ones stay, of a batch the last one is stored."""
    path, checkpoint = scratch_dir(t.spark, "merged"), scratch_dir(t.spark, "merged-state")
    for stream in _parts(t):
        ST.merge_batches(stream.select("uid", "category", "model", "games", "ord"), path, checkpoint, ["uid"])
    return t.spark.read.parquet(path).select("uid", "ord")
