"""What the plans of the main operators must and must not hold."""

import re

import pytest

import __spark_entry__ as E
from duelboard.operators import keyed

DATA = "/root/testdata/sf0.001"
TEXT = r"\b(answer|output|prompt|output_\d|answer_md5)#"


def lines(df, node):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if node in line]


@pytest.mark.parametrize("name", ["s3_answers_directory", "w1_keep_first", "w2_keep_last", "j5_paired_answers", "j8_common_instructions"])
def test_texts_are_not_sorted_to_pick_rows(spark, name):
    df = E.queries()[name](spark, DATA)
    assert not [line for line in lines(df, "SortAggregate") if re.search(TEXT, line)]


def test_picked_rows(spark):
    rows = [("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), (None, 5, "n"), (None, 4, "m"), ("c", None, "o"), ("", 7, "p")]
    df = spark.createDataFrame(rows, "k string, ord long, text string")
    first = {r["k"]: r["text"] for r in keyed.keep_first(df, ["k"]).collect()}
    last = {r["k"]: r["text"] for r in keyed.keep_last(df, ["k"]).collect()}
    assert first == {"a": "y", "b": "z", None: "m", "c": "o", "": "p"}
    assert last == {"a": "x", "b": "z", None: "n", "c": "o", "": "p"}


def test_a_hot_key_is_spread(spark):
    """Rows meet what was picked by key and order, so a frequent key does not gather in one task."""
    df = spark.range(10_000).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) k", "id ord", "repeat('t', 20) text")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        picked = keyed.keep_first(df, ["k"])
        assert lines(picked, "ShuffledHashJoin") and not lines(picked, "SortMergeJoin")
        assert len([line for line in lines(picked, "Exchange") if re.search(r"hashpartitioning\(.*ord", line)]) == 2
        assert picked.count() == 6_667
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
