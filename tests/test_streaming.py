import json
import os

from pyspark.sql import functions as F

from duelboard.streaming import ingest as ST
from duelboard.streaming import windows as SW

SCHEMA = "uid string, category string, model string, judge string, winner_key string, winner string, games array<struct<score:string>>, ts timestamp, ord bigint"


def feed(directory, name, rows):
    directory.mkdir(exist_ok=True)
    path = directory / name
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))
    stamp = 1_700_000_000 + int(name.split(".")[0])  # files arrive in name order
    os.utime(path, (stamp, stamp))


def row(i, minute, **extra):
    base = {"uid": f"u{i}", "category": "math", "model": "m", "judge": "j", "winner_key": "x",
            "games": [{"score": "B>A"}, {"score": "A>B"}], "ts": f"2024-01-01T00:{minute:02d}:00Z", "ord": i}
    return base | extra


def stream(spark, directory):
    return ST.file_stream(spark, str(directory), SCHEMA, files_per_trigger=1)


def test_first_arrivals_are_kept_however_late(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    feed(src, "1.json", [row(1, 30, ord=5), row(2, 31), row(1, 32, ord=3)])
    ST.first_per_key(stream(spark, src), out, state, ["uid"])
    feed(src, "2.json", [row(2, 50), row(3, 51)])
    feed(src, "3.json", [row(4, 0)])  # never seen, older than everything before
    ST.first_per_key(stream(spark, src), out, state, ["uid"])
    rows = {r["uid"]: r["ord"] for r in spark.read.parquet(out).collect()}
    assert rows == {"u1": 3, "u2": 2, "u3": 3, "u4": 4}


def test_running_counts_and_scores(spark, tmp_path):
    src = tmp_path / "in"
    feed(src, "1.json", [row(1, 0), row(2, 1, winner_key="tie")])
    feed(src, "2.json", [row(3, 2, winner_key=None, winner="y"), row(4, 3, games=[{"score": "A=B"}, {"score": None}])])
    ST.replace_per_batch(ST.running_winners(stream(spark, src)), str(tmp_path / "w"), str(tmp_path / "ws"))
    assert {r["key"]: r["n"] for r in ST.newest(spark, str(tmp_path / "w")).collect()} == {"x": 2, "TIE": 1, "y": 1}
    ST.replace_per_batch(ST.running_scores(stream(spark, src)), str(tmp_path / "s"), str(tmp_path / "ss"))
    assert [tuple(r) for r in ST.newest(spark, str(tmp_path / "s")).collect()] == [("math", "m", 6, 1.0)]


def test_a_crash_leaves_the_last_whole_version(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "w"
    feed(src, "1.json", [row(1, 0)])
    ST.replace_per_batch(ST.running_winners(stream(spark, src)), str(out), str(tmp_path / "ws"))
    (out / "v-broken-9").mkdir()
    (out / "v-broken-9" / "part-0.parquet").write_bytes(b"half a file")
    assert ST.newest(spark, str(out)).count() == 1
    feed(src, "2.json", [row(2, 0, winner_key="z")])
    ST.replace_per_batch(ST.running_winners(stream(spark, src)), str(out), str(tmp_path / "ws"))
    assert {r["key"] for r in ST.newest(spark, str(out)).collect()} == {"x", "z"}


def panes(spark, directory, folder, delay="5 minutes"):
    return SW.count_panes(stream(spark, directory), f"{folder}/days", f"{folder}/state", "ts", delay, "10 minutes", ["judge"])


def test_windows_end_and_late_rows_are_kept_apart(spark, tmp_path):
    src, folder = tmp_path / "in", str(tmp_path)
    feed(src, "1.json", [row(1, 1), row(2, 12)])
    feed(src, "2.json", [row(3, 40)])
    feed(src, "3.json", [row(4, 41), row(5, 2), row(7, 33), row(8, 0, ts=None)])  # 5 is too late, 7 is not, 8 has no time
    first = panes(spark, src, folder)
    feed(src, "4.json", [row(6, 59), row(9, 13)])
    second = panes(spark, src, folder)
    closed = SW.closed_windows(spark, f"{folder}/days", "5 minutes", "10 minutes", ["judge"])
    assert {r["window_start"].minute: r["n"] for r in closed.collect()} == {0: 1, 10: 1, 30: 1, 40: 2}
    late = {r["uid"]: r["watermark"] and r["watermark"].minute for r in SW.late_rows(spark, f"{folder}/days").collect()}
    assert late == {"u5": 35, "u8": 35, "u9": 36}
    rows = [p["stateOperators"][0] for p in first + second]
    assert sum(r["numRowsDroppedByWatermark"] for r in rows) == 0  # whatever Spark would drop was landed as late
    assert sum(r["numRowsRemoved"] for r in rows) == 4  # ended windows leave the state


def test_state_does_not_grow_with_the_stream(spark, tmp_path):
    src, folder, held = tmp_path / "in", str(tmp_path), []
    for k in range(4):  # each run brings ten windows and ends those of the run before
        feed(src, f"{k}.json", [row(i, 0, ts=f"2024-01-0{k + 1}T{i // 6:02d}:{i % 6 * 10:02d}:00Z") for i in range(10)])
        held.append(panes(spark, src, folder)[-1]["stateOperators"][0]["numRowsTotal"])
    assert max(held) <= 2 and spark.read.parquet(f"{folder}/days/panes").count() >= 38


def test_sliding_windows_are_sums_of_panes(spark, tmp_path):
    src, folder = tmp_path / "in", str(tmp_path)
    feed(src, "1.json", [row(i, m) for i, m in enumerate((1, 5, 12, 25, 48, 59))])
    panes(spark, src, folder, "0 minutes")
    got = SW.closed_windows(spark, f"{folder}/days", "0 minutes", "10 minutes", ["judge"], 3).collect()
    want = {-20: 2, -10: 3, 0: 4, 10: 2, 20: 2}  # panes 0: 2, 10: 1, 20: 1, 40: 1; that of minute 50 is open
    assert {int((r["window_start"] - got[0]["window_start"].replace(hour=0, minute=0, day=1, month=1, year=2024)).total_seconds() // 60): r["n"] for r in got} == want


def test_sessions(spark, tmp_path):
    src, folder = tmp_path / "in", str(tmp_path)
    count = lambda: SW.count_sessions(stream(spark, src), f"{folder}/s", f"{folder}/state", "ts", "10 minutes", "5 minutes", ["judge"])
    feed(src, "1.json", [row(i, m) for i, m in enumerate((0, 2, 20))])
    count()
    feed(src, "2.json", [row(i + 10, m) for i, m in enumerate((22, 13, 9, 50))])  # minute 9 is behind the watermark
    count()
    got = {(r["session_start"].minute, r["n"]) for r in spark.read.parquet(f"{folder}/s/sessions").collect()}
    assert got == {(0, 2), (13, 1), (20, 2)}
    assert [r["uid"] for r in SW.late_rows(spark, f"{folder}/s").collect()] == ["u12"]


def test_a_landed_batch_is_not_landed_again(spark, tmp_path):
    src, folder, state = tmp_path / "in", str(tmp_path / "w"), tmp_path / "state"
    land = lambda: SW.land(stream(spark, src), folder, str(state), "ts", "5 minutes", SW.pane_end("ts", "10 minutes"))
    feed(src, "1.json", [row(1, 30)])
    feed(src, "2.json", [row(2, 31), row(3, 1)])
    land()
    before = sorted(p.name for p in (tmp_path / "w").rglob("*.parquet"))
    for name in ("1", ".1.crc"):  # as after a crash between write and commit
        (state / "commits" / name).unlink(missing_ok=True)
    land()
    assert sorted(p.name for p in (tmp_path / "w").rglob("*.parquet")) == before
    assert [r["uid"] for r in SW.late_rows(spark, folder).collect()] == ["u3"]


def test_batches_merge_complete_rows_once(spark, tmp_path):
    src, table = tmp_path / "in", str(tmp_path / "table")
    half = [{"score": "A>B"}, {"score": None}]
    feed(src, "1.json", [row(1, 0), row(2, 1, games=half)])
    feed(src, "2.json", [row(1, 5, ord=50), row(2, 6, ord=60), row(3, 7, games=half)])
    ST.merge_batches(stream(spark, src), table, str(tmp_path / "state"), ["uid"])
    rows = {r["uid"]: r["ord"] for r in spark.read.parquet(table).collect()}
    assert rows == {"u1": 1, "u2": 60}
    assert spark.read.parquet(table).groupBy("uid").count().where(F.col("count") > 1).count() == 0


def test_a_new_checkpoint_overwrites_nothing(spark, tmp_path):
    src, more, table = tmp_path / "in", tmp_path / "more", str(tmp_path / "table")
    feed(src, "1.json", [row(1, 0)])
    feed(more, "1.json", [row(1, 9, ord=90), row(2, 1)])
    ST.merge_batches(stream(spark, src), table, str(tmp_path / "s1"), ["uid"])
    ST.merge_batches(stream(spark, more), table, str(tmp_path / "s2"), ["uid"])
    assert {r["uid"]: r["ord"] for r in spark.read.parquet(table).collect()} == {"u1": 1, "u2": 2}


def test_a_replayed_batch_writes_the_same_rows(spark, tmp_path):
    src, table, state = tmp_path / "in", str(tmp_path / "table"), tmp_path / "s"
    feed(src, "1.json", [row(1, 0), row(2, 0)])
    feed(src, "2.json", [row(2, 1, ord=8), row(3, 1)])
    ST.merge_batches(stream(spark, src), table, str(state), ["uid"])
    for name in ("1", ".1.crc"):  # as after a crash between write and commit
        (state / "commits" / name).unlink(missing_ok=True)
    ST.merge_batches(stream(spark, src), table, str(state), ["uid"])
    assert sorted((r["uid"], r["ord"]) for r in spark.read.parquet(table).collect()) == [("u1", 1), ("u2", 2), ("u3", 3)]


def test_a_hot_key_and_nested_columns(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    feed(src, "1.json", [row(1, i % 60, ord=10_000 - i) for i in range(3_000)] + [row(2, 0), row(None, 1, uid=None)])
    feed(src, "2.json", [row(1, 0, ord=1), row(3, 0, ord=None), row(None, 2, uid=None)])
    ST.first_per_key(stream(spark, src), out, state, ["uid"])
    rows = {r["uid"]: r for r in spark.read.parquet(out).collect()}
    assert {k: r["ord"] for k, r in rows.items()} == {"u1": 7_001, "u2": 2, None: None, "u3": None}
    assert rows["u1"]["games"][1]["score"] == "A>B" and rows["u1"]["ts"].minute == 2_999 % 60


def test_a_batch_does_not_read_the_stored_table(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", str(tmp_path / "state")
    feed(src, "1.json", [row(1, 0), row(2, 0)])
    ST.first_per_key(stream(spark, src), str(out), state, ["uid"])
    for part in out.rglob("*.parquet"):
        part.write_bytes(b"no table")  # a read of what is stored would fail
    for crc in out.rglob(".*.crc"):
        crc.unlink()
    feed(src, "2.json", [row(2, 1), row(3, 1)])
    ST.first_per_key(stream(spark, src), str(out), state, ["uid"])
    (second,) = out.glob("run=*/batch=1")
    assert [r["uid"] for r in spark.read.parquet(str(second)).collect()] == ["u3"]
