import duckdb
import pytest

import __spark_entry__ as E

DATA = "/root/testdata/sf0.001"
TABLES = ("documents", "events", "conversations", "lineitem", "pages")
SAMPLE = (
    "s3_answers_directory", "p7_reject_preview", "c1_verdict_label", "c2_comparison_reply", "c7_parse_transcript",
    "c17_style_metadata", "j3_coverage_gaps", "j8_common_instructions", "j9_style_joined_battles", "j11_winner_name", "a2_model_scores",
    "a3_bootstrap_draws", "a13_win_rates", "a14_best_and_worst", "w4_running_history", "k7_text_leaderboard",
    "e2_pairwise_judging", "e4_preference_pairs", "st4_sessions",
)


def test_every_sql_belongs_to_a_query():
    queries, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 130


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{DATA}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, db, name):
    from check import rows_of

    df = E.queries()[name](spark, DATA)
    cursor = db.execute(E.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(names, cursor.fetchall())


def test_entry(spark):
    rows = E.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"category", "model", "score", "lower", "upper"}
