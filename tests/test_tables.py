"""Bucketed stores, the judgment source, table functions, ordinals, quantiles and counts in the writing pass."""

import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from duelboard.functions import prompts as PR
from duelboard.functions.expand import expand_rows
from duelboard.operators import keyed
from duelboard.operators import pairs as P
from duelboard.operators.ordinal import round_robin, with_ordinal
from duelboard.operators.quantiles import exact_quantiles
from duelboard.sources.bucketed import read_bucketed, write_bucketed
from duelboard.sources.judged_lines import scan_judged_lines, stream_judged_lines

# bucketed stores

STORE = "uid string, ord bigint, note string"


@pytest.fixture
def store(spark, tmp_path):
    path = str(tmp_path / "store")
    for k in range(3):
        rows = spark.range(k * 100, k * 100 + 100).selectExpr("cast(id as string) uid", "id ord", "'x' note")
        write_bucketed(rows, path, ["uid"], 8)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanged(df, word):
    """Whether a node below an exchange reads ``word``."""
    lines = plan(df).splitlines()
    for i, line in enumerate(lines):
        if "Exchange" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            for below in lines[i + 1 :]:
                if len(below) - len(below.lstrip(" :+-")) <= depth:
                    break
                if word in below:
                    return True
    return False


def test_a_bucketed_store_is_not_moved(spark, store):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = read_bucketed(spark, store, STORE, ["uid"], 8)
        asked = spark.range(50, 400).selectExpr("cast(id as string) uid")
        left = keyed.without(asked, held.where("ord % 2 = 0"), ["uid"])
        joined = asked.join(held, "uid")
        assert exchanged(left, "Range") and not exchanged(left, "FileScan") and "FileScan" in plan(left)
        assert exchanged(joined, "Range") and not exchanged(joined, "FileScan")
        assert joined.count() == 250 and left.count() == 350 - 125
        again = keyed.upsert(held, asked.selectExpr("uid", "-1L ord", "'y' note"), ["uid"])
        assert again.count() == 400 and again.where("ord < 0").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_absent_store_is_empty(spark, tmp_path):
    assert read_bucketed(spark, str(tmp_path / "none"), STORE, ["uid"], 8).count() == 0


# the judgment source


def put(folder, name, lines, time=None):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("".join(line + "\n" for line in lines))
    if time:
        os.utime(folder / name, (time, time))


def record(uid, **more):
    return json.dumps({"uid": uid, "category": "c", "model": "m", "games": [{"score": "A>B", "other": 1}, None], "extra": [1]} | more)


def test_judged_lines(spark, tmp_path):
    put(tmp_path / "judge=a", "1.jsonl", [record("x"), "", record("y z")])
    put(tmp_path / "judge=b", "1.jsonl", [record("w")])
    put(tmp_path / "judge=b", "_SUCCESS", ["no record"])
    rows = {(r["judge"], r["line"]): r for r in scan_judged_lines(spark, str(tmp_path)).collect()}
    assert {k: r["uid"] for k, r in rows.items()} == {("a", 1): "x", ("a", 3): "y z", ("b", 1): "w"}
    assert rows["a", 1]["games"][0]["score"] == "A>B" and rows["a", 1]["games"][1] is None and rows["a", 1]["baseline"] is None
    assert scan_judged_lines(spark, str(tmp_path / "none")).count() == 0


def test_other_judges_are_not_read(spark, tmp_path):
    put(tmp_path / "judge=a", "1.jsonl", [record("x")])
    put(tmp_path / "judge=b", "1.jsonl", ["a broken line would stop a read"])
    assert [r["uid"] for r in scan_judged_lines(spark, str(tmp_path), ["a", "c"]).collect()] == ["x"]
    assert scan_judged_lines(spark, str(tmp_path), []).count() == 0
    with pytest.raises(Exception, match="line 1 of .*judge=b/1.jsonl"):
        scan_judged_lines(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("bad", ["{", "[1]", '{"uid": "q", "games": 3}', '{"uid": 5}'])
def test_a_bad_line_is_named(spark, tmp_path, bad):
    put(tmp_path / "judge=a", "7.jsonl", [record("x"), "", bad, record("y")])
    with pytest.raises(Exception, match="line 3 of .*7.jsonl"):
        scan_judged_lines(spark, str(tmp_path)).collect()


def test_judged_lines_as_a_stream(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")

    def run():
        stream = stream_judged_lines(spark, str(src))
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted(r["uid"] for r in spark.read.parquet(out).collect())

    put(src / "judge=a", "2.jsonl", [record("x"), record("y")], 1_700_000_000)
    assert run() == ["x", "y"]
    put(src / "judge=b", "1.jsonl", [record("z")], 1_700_000_100)
    assert run() == ["x", "y", "z"]
    assert run() == ["x", "y", "z"]


# table functions


def test_a_user_written_expansion(spark):
    def make():
        def words(row):
            for at, word in enumerate((row["text"] or "").split()):
                yield row["id"], at, word

        return words

    df = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "id long, text string")
    got = expand_rows(df, make, "id long, at int, word string").collect()
    assert sorted(map(tuple, got)) == [(1, 0, "a"), (1, 1, "b"), (3, 0, "c")]


def test_an_expansion_with_state_per_key(spark):
    def make():
        class Longest:
            def __init__(self):
                self.key, self.best, self.last = None, "", None

            def row(self, row):
                assert self.last is None or self.last <= row["at"]  # in order
                self.key, self.last = row["key"], row["at"]
                if len(row["word"]) > len(self.best):
                    self.best = row["word"]
                return ()

            def end(self):
                if self.last is not None:
                    yield self.key, self.best

        return Longest()

    rng = random.Random(3)
    rows = [(rng.choice("ab") if i % 3 else "hot", i, "w" * rng.randrange(1, 50)) for i in range(500)]
    df = spark.createDataFrame(rows, "key string, at int, word string").repartition(7)
    got = dict(map(tuple, expand_rows(df, make, "key string, best string", ["key"], ["at"]).collect()))
    assert {k: len(v) for k, v in got.items()} == {k: max(len(w) for key, _, w in rows if key == k) for k in ("a", "b", "hot")}


def test_an_expansion_names_absent_columns(spark):
    with pytest.raises(Exception, match="lacks the columns nokey"):
        expand_rows(spark.range(3), lambda: (lambda row: ()), "x int", ["nokey"]).collect()


# ordinals


def test_ordinals_are_gapless_and_ordered(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.random()) for i in range(1_000)]
    df = spark.createDataFrame(rows, "id long, x double").repartition(6)
    got = {r["id"]: r["ordinal"] for r in with_ordinal(df, str(tmp_path / "a"), ["x"]).collect()}
    assert got == {i: k for k, (i, _) in enumerate(sorted(rows, key=lambda r: r[1]))}
    unordered = with_ordinal(df, str(tmp_path / "b")).collect()
    assert sorted(r["ordinal"] for r in unordered) == list(range(1_000))
    assert with_ordinal(df.limit(0), str(tmp_path / "c")).count() == 0


def test_a_skewed_input_is_dealt_evenly(spark, tmp_path):
    df = spark.range(997).withColumn("uid", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string"))).repartition(5, "uid")
    counts = [r["count"] for r in round_robin(df, 7, str(tmp_path / "a")).groupBy("shard").count().collect()]
    assert len(counts) == 7 and max(counts) - min(counts) <= 1 and sum(counts) == 997


# quantiles


def test_quantiles_equal_numpy(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [("ties", float(x)) for x in rng.integers(0, 3, 900)] + [("many", float(x)) for x in rng.normal(size=2_000)] + [("one", 7.5), (None, 1.0), (None, 2.0), ("null", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(5)
    qs = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    got = {(r["k"], r["q"]): (r["quantile"], r["n"]) for r in exact_quantiles(df, ["k"], "x", qs, str(tmp_path / "q")).collect()}
    for k in ("ties", "many", "one", None):
        values = [x for key, x in rows if key == k]
        for q in qs:
            assert got.pop((k, q)) == (pytest.approx(np.quantile(values, q), abs=1e-12), len(values))
    assert not got


def test_no_task_holds_a_group(spark, tmp_path):
    """The values of one group spread over several of the written partitions."""
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.range(20_000).selectExpr("'hot' k", "rand(1) x")
        exact_quantiles(df, ["k"], "x", [0.5], str(tmp_path / "q")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    counts = [r["count"] for r in spark.read.parquet(str(tmp_path / "q")).groupBy("_part").count().collect()]
    assert len(counts) == 4 and max(counts) < 10_000


# counts in the writing pass

PAIRS = "id int, chosen array<struct<content:string>>, rejected array<struct<content:string>>"


def test_pairs_are_counted_while_they_are_written(spark, tmp_path):
    df = spark.createDataFrame([(1, [("a",)], [("b",)]), (2, [("",)], [("b",)]), (3, None, [("b",)]), (4, [("",), ("c",)], [("d",)])], PAIRS)
    counts = Observation()
    kept = P.filter_and_count(df, counts)
    kept.write.parquet(str(tmp_path / "kept"))
    assert counts.get == {"total": 4, "kept": 2} and plan(kept).count("Scan") <= 1
    assert [r["id"] for r in spark.read.parquet(str(tmp_path / "kept")).orderBy("id").collect()] == [1, 4]
    assert P.filter_counts(df).first().asDict() == counts.get


def test_a_stream_reports_its_counts(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('{"id": 1, "ids": [5, 0, 6]}\n{"id": 2, "ids": []}\n')
    stream = spark.readStream.schema("id int, ids array<int>").json(str(src))
    query = (
        P.count_tokens(stream, "totals", "ids", 0).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    (progress,) = [p for p in query.recentProgress if p["numInputRows"]]
    assert progress["observedMetrics"]["totals"].asDict() == {"sequences": 2, "tokens": 2}


# contents


def test_contents_of_any_depth(evaluate):
    cases = {
        '[["a","b"],"c"]': "a\nb\nc",
        '["a",[],"b",[[]]]': "a\n\nb\n",
        "[]": "",
        '[[[[{"answer":"x","n":1}]]],{"k":[1,["z"]]}]': 'x\n{"k":[1,["z"]]}',
        '"plain [[["': "plain [[[",
        '["[[",["]]"]]': "[[\n]]",
        "[" * 300 + '"deep"' + "]" * 300: "deep",
        "[true,null,3,1.5]": "True\nNone\n3\n1.5",
        "null": "None",
    }
    got = evaluate(lambda c: PR.content_text(F.parse_json(c)), list(cases))
    assert got == list(cases.values())
