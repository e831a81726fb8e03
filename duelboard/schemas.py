"""Declared record schemas (DDL strings)."""

QUESTION = "uid string, prompt string, category string, cluster string"
TURN_QUESTION = (
    "question_id string, id string, category string, turns array<string>, "
    "question string, prompt string"
)
STYLE_METADATA = (
    "struct<token_len:bigint,header_count:map<string,bigint>,"
    "list_count:map<string,bigint>,bold_count:map<string,bigint>>"
)
ANSWER = (
    "uid string, ans_id string, model string, "
    "messages array<struct<role:string,content:variant>>, tstamp double, "
    f"metadata {STYLE_METADATA}"
)
JUDGMENT = (
    "uid string, category string, judge string, model string, baseline string, "
    "games array<struct<score:string>>"
)
_MESSAGES = "array<struct<role:string,content:string>>"
_JUDGED_BY = "struct<answer:string>"
GAMES = (
    f"array<struct<score:string,judgment:{_JUDGED_BY},prompt:{_MESSAGES},"
    f"repair:struct<prompt:{_MESSAGES},judgment:{_JUDGED_BY}>>>"
)
#: A judgment with everything that was sent and said.
JUDGMENT_RECORD = f"uid string, category string, judge string, model string, baseline string, games {GAMES}"
CANDIDATE = "instruction string, raw_instruction string, output string, generator string"
COMPARISON_RESULT = (
    "instruction string, comparison string, winner string, winner_key string, "
    "labels map<string,string>, model string, raw_response string, "
    "usage map<string,bigint>"
)
DIALOGUE_ROW = "chosen string, rejected string, prompt string, text string"
ROLLOUT = (
    "prompt_id bigint, prompt_messages array<struct<role:string,content:string>>, "
    "responses array<string>, reference_responses struct<chosen:string,rejected:string>"
)
PAIR = (
    "prompt_messages array<struct<role:string,content:string>>, "
    "chosen array<struct<role:string,content:string>>, "
    "rejected array<struct<role:string,content:string>>, "
    "metadata struct<source:string,seed:bigint,k_candidates:int,"
    "generator_model:string,judge:string,reward_model:string,"
    "reward_quantization:string>"
)
