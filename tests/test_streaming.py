"""Streaming operators over several batches give the batch result; late rows are dropped."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, TimerValues

from sensorspark.streaming import live

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp, id long, k string, value double"


def feed(spark, folder, batches, schema=SCHEMA):
    """One file per batch, read one at a time in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/b{i:02d}")
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(folder))
    )


def minute(i, n, k="a", v=None):
    return (T0 + dt.timedelta(minutes=i), n, k, float(i if v is None else v))


def test_count_windows_carry_rows_between_batches(spark, tmp_path):
    order = list(range(40))
    batches = [[minute(i, i) for i in reversed(order[a : a + 7])] for a in range(0, 40, 7)]
    out = live.count_windows(feed(spark, tmp_path, batches), "ts", "id", "value", "k", size=6, step=2, delay="5 minutes")
    got = sorted((r["window_id"], r["mean"]) for r in live.drain(out, "t").collect())
    # The watermark ends at 39 - 5 minutes; a window is out once all its rows are behind it.
    assert got == [(w, w * 2 + 2.5) for w in range((34 - 6) // 2 + 1)]


def test_rows_later_than_the_watermark_are_dropped(spark, tmp_path):
    batches = [[minute(i, i) for i in range(30)], [minute(40, 40)], [minute(3, 99)], [minute(60, 60)]]
    out = live.snapshots(feed(spark, tmp_path, batches), "ts", "value", "10 minutes", ["k"], delay="5 minutes")
    got = {r["start_us"]: r["n_rows"] for r in live.drain(out, "t").collect()}
    first = int(T0.replace(tzinfo=dt.timezone.utc).timestamp() * 1e6)
    assert [got[first + i * 600_000_000] for i in (0, 1, 2)] == [10, 10, 10]


def test_alarm_fires_once_across_batches(spark, tmp_path):
    over = [0, 1, 1, 0, 1, 1, 1, 1, 0, 1, 1, 1]
    batches = [[(T0, i, "a", float(over[i])) for i in range(a, min(a + 2, len(over)))] for a in range(0, len(over), 2)]
    flags = feed(spark, tmp_path, batches).select("k", "id", (F.col("value") > 0).alias("over"))
    got = live.drain(live.sustained_alarm(flags, "k", "id", "over"), "t").collect()
    assert [(r["k"], r["detected_at"]) for r in got] == [("a", 4)]


def test_outcomes_duplicates_and_timeout(spark, tmp_path):
    schema = "created_at timestamp, run_id string, level string, event_type string, message string"

    def row(i, run, level, event, message="m"):
        return (T0 + dt.timedelta(minutes=i), run, level, event, message)

    batches = [
        [row(0, "good", "INFO", "pod.started"), row(0, "bad", "ERROR", "x"), row(0, "hung", "INFO", "x"), row(1, "full", "WARN", "x", "in the reasoning block")],
        [row(2, "good", "INFO", "job.completed"), row(2, "good", "INFO", "job.completed"), row(2, "bad", "INFO", "pod.terminated"), row(2, "full", "INFO", "job.completed")],
        [row(300, "late", "INFO", "x")],
        [row(301, "late", "INFO", "y")],
    ]
    out = live.run_outcomes(feed(spark, tmp_path, batches, schema), delay="5 minutes", timeout_s=3600.0)
    got = sorted((r["run_id"], r["outcome"]) for r in live.drain(out, "t").collect())
    assert got == [("bad", "failed"), ("full", "empty-reasoning-overflow"), ("good", "completed"), ("hung", "timeout")]


def test_settings_stay_and_the_newest_row_decides(spark, tmp_path):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", live.PROVIDER)}
    schema = "created_at timestamp, run_id string, level string, event_type string, message string"

    def row(i, run, level, event):
        return (T0 + dt.timedelta(minutes=i), run, level, event, "m")

    batches = [
        [row(0, "late-error", "INFO", "job.completed"), row(0, "resumed", "INFO", "job.completed"), row(1, "good", "INFO", "job.completed")],
        [row(2, "late-error", "ERROR", "job.failed"), row(3, "resumed", "INFO", "job.started")],
        [row(60, "other", "INFO", "x")],
        [row(120, "other", "INFO", "y")],
    ]
    out = live.run_outcomes(feed(spark, tmp_path, batches, schema), delay="5 minutes", timeout_s=None)
    got = sorted((r["run_id"], r["outcome"]) for r in live.drain(out, "t").collect())
    assert got == [("good", "completed"), ("late-error", "failed")]
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_early_snapshots_wait(spark, tmp_path):
    batches = [[(T0, i, "a", 1.0)] for i in (2, 0, 3, 1, 1)]
    flags = feed(spark, tmp_path, batches).select("k", "id", (F.col("value") > 0).alias("over"))
    got = live.drain(live.sustained_alarm(flags, "k", "id", "over", sustain=4), "t").collect()
    assert [(r["k"], r["detected_at"]) for r in got] == [("a", 0)]


def test_a_lost_snapshot_breaks_the_streak_and_is_passed(spark, tmp_path):
    # Snapshot 2 never comes; 9 is five numbers past it.
    over = {0: 1, 1: 1, 3: 1, 4: 1, 5: 0, 6: 1, 7: 1, 8: 1, 9: 1}
    batches = [[(T0, i, "a", float(v))] for i, v in over.items()]
    flags = feed(spark, tmp_path, batches).select("k", "id", (F.col("value") > 0).alias("over"))
    got = live.drain(live.sustained_alarm(flags, "k", "id", "over", reach=5), "t").collect()
    assert [(r["k"], r["detected_at"]) for r in got] == [("a", 6)]


def test_a_lost_snapshot_is_passed_by_the_watermark(spark, tmp_path):
    seen = [0, 1, 3, 4, 5]
    batches = [[minute(i, i)] for i in seen] + [[minute(200, 0, "b")], [minute(400, 1, "b")]]
    flags = feed(spark, tmp_path, batches).select("ts", "k", "id", F.lit(True).alias("over"))
    out = live.sustained_alarm(flags, "k", "id", "over", timestamp="ts", delay="5 minutes", patience_s=600.0)
    got = live.drain(out, "t").collect()
    assert [(r["k"], r["detected_at"]) for r in got] == [("a", 3)]


def test_a_run_without_an_end_is_dropped_by_default(spark, tmp_path):
    schema = "created_at timestamp, run_id string, level string, event_type string, message string"
    batches = [[(T0 + dt.timedelta(hours=h), run, "INFO", "x", "m")] for h, run in ((0, "hung"), (30, "other"), (31, "other"))]
    got = live.drain(live.run_outcomes(feed(spark, tmp_path, batches, schema)), "t").collect()
    assert [(r["run_id"], r["outcome"]) for r in got] == [("hung", "timeout")]


def test_count_windows_over_many_cells_batches_and_missing_values(spark, tmp_path):
    n = 90
    rows = [(T0 + dt.timedelta(seconds=20 * (i // 3)), i, "a", None if i % 7 == 0 else float(i)) for i in range(n)]
    near = [r for i in range(0, n, 9) for r in reversed(rows[i : i + 9])]
    batches = [near[a : a + 10] for a in range(0, n, 10)] + [[(T0 + dt.timedelta(hours=1), n, "b", 0.0)], [(T0 + dt.timedelta(hours=2), n, "b", 0.0)]]
    out = live.count_windows(feed(spark, tmp_path, batches), "ts", "id", "value", "k", size=5, step=3, delay="2 minutes", cell_s=30.0)
    got = sorted((r["window_id"], r["mean"]) for r in live.drain(out, "t").collect() if r["k"] == "a")
    want = []
    for w, a in enumerate(range(0, n - 4, 3)):
        values = [r[3] for r in rows[a : a + 5] if r[3] is not None]
        want.append((w, sum(values) / len(values)))
    assert got == want


class FakeState:
    """Keyed state of one key that counts the calls."""

    def __init__(self):
        self.calls, self.stores, self.timers = 0, {}, set()

    def getMapState(self, name, *_):
        return FakeStore(self, name)

    getValueState = getListState = getMapState

    def registerTimer(self, ms):
        self.calls += 1
        self.timers.add(ms)


class FakeStore:
    def __init__(self, handle, name):
        self.handle, self.at = handle, handle.stores.setdefault(name, {})

    def _called(self, out=None):
        self.handle.calls += 1
        return out

    def get(self):
        return self._called(self.at.get("all"))

    def exists(self):
        return self._called("all" in self.at)

    def update(self, value):
        self._called(self.at.update(all=value))

    put = update

    def clear(self):
        self._called(self.at.clear())

    def getValue(self, key):
        return self._called(self.at.get(key))

    def containsKey(self, key):
        return self._called(key in self.at)

    def updateValue(self, key, value):
        self._called(self.at.update({key: value}))

    def removeKey(self, key):
        self._called(self.at.pop(key))


def run_one_key(batches, size, step):
    """``(means, calls to the state)`` of batches ``(rows of (us, tie, value), watermark in ms)`` of one key."""
    state, out = FakeState(), []
    work = live._CountWindows(size, step, ["k"], 60_000_000)
    work.init(state)
    for rows, mark in batches:
        if rows:
            list(work.handleInputRows(("a",), iter([pd.DataFrame(rows, columns=["us", "tie", "value"])]), None))
        for ms in sorted(t for t in state.timers if t <= mark):
            state.timers.discard(ms)
            out += work.handleExpiredTimer(("a",), TimerValues(0, mark), ExpiredTimerInfo(ms))
    got = [(int(w), m) for pdf in out for w, m in zip(pdf["window_id"], pdf["mean"])]
    return got, state.calls


def test_count_windows_call_the_state_by_pieces():
    # Rows that are minutes apart, in one batch: each used to be a cell and a timer of its own.
    n, minute_us = 2_000, 60_000_000
    rows = [(i * 5 * minute_us, i, float(i)) for i in range(n)]
    random.Random(0).shuffle(rows)
    got, calls = run_one_key([(rows, 0), ([], n * 5 * 60_000)], 8, 4)
    assert got == [(w, 4 * w + 3.5) for w in range((n - 8) // 4 + 1)]
    assert calls < 50


def test_count_windows_over_overlapping_pieces(monkeypatch):
    monkeypatch.setattr(live._CountWindows, "PIECE", 7, raising=False)
    draw = random.Random(1)
    rows = [(i // 2 * 20_000_000, i, float(i)) for i in range(400)]
    late = sorted(rows, key=lambda r: r[0] + draw.random() * 500_000_000)
    batches, done = [], 0
    for a in range(0, len(late), 23):
        batches.append((late[a : a + 23], max(0, late[min(a + 22, len(late) - 1)][0] // 1000 - 600_000)))
    batches = [(b, max(m for _, m in batches[: i + 1])) for i, (b, _) in enumerate(batches)] + [([], 10**9)]
    for b, m in batches:
        assert all(us >= done * 1000 for us, _, _ in b)
        done = m
    got, _ = run_one_key(batches, 5, 3)
    assert got == [(w, 3 * w + 2.0) for w in range((400 - 5) // 3 + 1)]
