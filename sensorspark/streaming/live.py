"""Structured Streaming forms of the operators.

Time windows and sessions are plain aggregations under a watermark.  The count-based
window, the sustained alarm and the run tracker keep a few values per key.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sensorspark.operators.runs import TERMINAL_EVENTS
from sensorspark.session import fresh_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# A run without an end is given up after a day.
RUN_TIMEOUT_S = 86_400.0

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Keyed state needs the RocksDB store while a stream starts; the setting is put back after."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)


def snapshots(
    stream: DataFrame, timestamp: str, value: str, width: str, keys: Sequence[str] = (), *, slide: str | None = None,
    delay: str = "10 minutes",
) -> DataFrame:
    """Time-window summaries of a late-data-tolerant stream; rows behind the watermark are dropped."""
    w = F.window(timestamp, width, slide) if slide else F.window(timestamp, width)
    out = stream.withWatermark(timestamp, delay).groupBy(*keys, w.alias("w")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max")
    )
    return out.select(
        *keys, F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n_rows", "mean", "min", "max"
    )


def sessions(stream: DataFrame, timestamp: str, gap: str, keys: Sequence[str], *, delay: str = "10 minutes") -> DataFrame:
    """Sessions split where a series pauses longer than ``gap``; the end includes the gap."""
    out = stream.withWatermark(timestamp, delay).groupBy(*keys, F.session_window(timestamp, gap).alias("w"))
    return out.agg(F.count(F.lit(1)).alias("n_rows")).select(
        *keys, F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n_rows"
    )


class _CountWindows(StatefulProcessor):
    """Rows wait until the watermark passes them, then leave in event-time order.

    State per key: the waiting rows in sorted pieces, the least time of each piece, the last
    ``size - 1`` released rows and the position.  A batch adds its rows as pieces of about
    ``PIECE`` rows, or fills up the newest one if that lies in the same cell of time.  One timer
    per key stands at its first waiting row; when it fires, the pieces that the watermark has
    reached are merged one after the other.  Calls to the state so grow with the pieces, not
    with the rows, and pieces ahead of the watermark are not touched.
    """

    PIECE = 1_000

    def __init__(self, size: int, step: int, key_names: Sequence[str], cell_us: int):
        self.size, self.step, self.key_names, self.cell_us = size, step, list(key_names), cell_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "piece long", "us array<long>, tie array<long>, value array<double>")
        # Numbers, least times and sizes of the pieces that wait, and the timer that is set.
        self.pieces = handle.getValueState("pieces", "next long, piece array<long>, least array<long>, n array<long>, timer long")
        self.line = handle.getValueState("line", "n long, us array<long>, tie array<long>, value array<double>")

    def _read(self, piece: int) -> list[tuple]:
        return list(zip(*self.waiting.getValue((piece,))))

    def _write(self, piece: int, rows: list[tuple]) -> None:
        us, tie, value = zip(*rows)
        self.waiting.updateValue((piece,), (list(us), list(tie), list(value)))

    def _keep(self, next_: int, known: list[tuple[int, int, int]], timer: int) -> None:
        """Write the list of pieces, with a timer at the first row that waits."""
        if known:
            due = min(k[1] for k in known) // 1000 + 1
            if timer < 0 or due < timer:
                self.handle.registerTimer(due)
                timer = due
        self.pieces.update((next_, [k[0] for k in known], [k[1] for k in known], [k[2] for k in known], timer))

    def _known(self) -> tuple[int, list[tuple[int, int, int]], int]:
        next_, piece, least, n, timer = self.pieces.get() or (0, [], [], [], -1)
        return next_, list(zip(piece, least, n)), timer

    def handleInputRows(self, key, rows, timerValues):
        next_, known, timer = self._known()
        for pdf in rows:
            value = [None if v != v else v for v in pdf["value"].tolist()]
            fresh = sorted(zip(pdf["us"].tolist(), pdf["tie"].tolist(), value), key=lambda r: r[:2])
            if not fresh:
                continue
            last = known[-1] if known else None
            cells = {us // self.cell_us for us in (last[1] if last else -1, fresh[0][0], fresh[-1][0])}
            if last and last[2] + len(fresh) <= self.PIECE and len(cells) == 1:
                fresh = sorted(self._read(last[0]) + fresh, key=lambda r: r[:2])
                known.pop()
                next_ = last[0]
            for a in range(0, len(fresh), self.PIECE):
                part = fresh[a : a + self.PIECE]
                self._write(next_, part)
                known.append((next_, part[0][0], len(part)))
                next_ += 1
        if known:
            self._keep(next_, known, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        next_, known, _ = self._known()
        due = sorted((k for k in known if k[1] < limit), key=lambda k: k[1])
        if not due:
            return
        left = [k for k in known if k[1] >= limit]
        n, *tail = self.line.get() or (0, [], [], [])
        tail = list(zip(*tail))
        ready: list[tuple] = []
        for i, (piece, _, _) in enumerate(due):
            rows = self._read(piece)
            early = [r for r in rows if r[0] < limit]
            if len(early) < len(rows):
                late = rows[len(early) :]
                self._write(piece, late)
                left.append((piece, late[0][0], len(late)))
            else:
                self.waiting.removeKey((piece,))
            ready = sorted(ready + early, key=lambda r: r[:2])
            # Rows before the next piece can leave.
            bound = due[i + 1][1] if i + 1 < len(due) else limit
            going = bisect_left(ready, bound, key=lambda r: r[0])
            out = list(self._windows(key, n, tail, ready[:going]))
            line = tail + ready[:going]
            tail, ready, n = line[len(line) - min(len(line), self.size - 1) :], ready[going:], n + going
            if out:
                yield pd.DataFrame(out, columns=[*self.key_names, "window_id", "start_us", "finish_us", "mean"])
        self.line.update((n, *([list(c) for c in zip(*tail)] or [[], [], []])))
        self._keep(next_, sorted(left), -1)

    def _windows(self, key, n: int, tail: list[tuple], ready: list[tuple]) -> Iterator[tuple]:
        """The windows that end among the ``ready`` rows, the first of which has position ``n``."""
        line, first = tail + ready, n - len(tail)
        for i in range(len(tail), len(line)):
            start = first + i - self.size + 1
            if start >= 0 and start % self.step == 0:
                window = line[i - self.size + 1 : i + 1]
                values = [r[2] for r in window if r[2] is not None]
                mean = sum(values) / len(values) if values else None
                yield (*key, start // self.step, window[0][0], window[-1][0], mean)

    def close(self) -> None:
        pass


def count_windows(
    stream: DataFrame, timestamp: str, tie: str, value: str, key: str, *, size: int, step: int = 1, delay: str = "10 minutes",
    cell_s: float = 60.0,
) -> DataFrame:
    """Row-count windows of a stream with the rows carried over between batches.

    Emits ``window_id, start_us, finish_us, mean`` once every row of a window is behind
    the watermark; rows later than the watermark are dropped by Spark and counted in the
    query progress, rows without a time are left out.  The mean is over the values that are present.  Rows of several batches
    wait together if they lie in one cell of ``cell_s`` seconds.
    """
    if size < 1 or step < 1:
        raise ValueError(f"size and step must be positive, got {size} and {step}")
    if cell_s < 0.001:
        raise ValueError(f"a cell takes a millisecond at least, got {cell_s} s")
    marked = stream.withWatermark(timestamp, delay)
    rows = marked.select(
        key, timestamp, F.unix_micros(timestamp).alias("us"), F.col(tie).cast("long").alias("tie"),
        F.col(value).cast("double").alias("value"),
    ).filter(F.col(timestamp).isNotNull())
    kind = stream.schema[key].dataType.simpleString()
    return rows.groupBy(key).transformWithStateInPandas(
        _CountWindows(size, step, [key], int(cell_s * 1_000_000)),
        f"{key} {kind}, window_id long, start_us long, finish_us long, mean double",
        "Append",
        "EventTime",
    )


class _Sustained(StatefulProcessor):
    """The current streak, the next snapshot, those that came too early, and whether the alarm has fired."""

    def __init__(self, sustain: int, key_name: str, first: int, reach: int, patience_ms: int | None):
        self.sustain, self.key_name, self.first, self.reach, self.patience_ms = sustain, key_name, first, reach, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("streak", "n long, next long, fired boolean")
        self.early = handle.getMapState("early", "snapshot long", "over boolean, ms long")

    def _judge(self, key, given_up) -> Iterator[pd.DataFrame]:
        """Judge what is due; where it is missing, go on at the next one that waits if ``given_up`` says so."""
        n, due, fired = self.state.get() if self.state.exists() else (0, self.first, False)
        waiting = None
        while not fired:
            # Snapshots are judged in their own order, whatever batch brings them.
            if self.early.containsKey((due,)):
                over, _ = self.early.getValue((due,))
                self.early.removeKey((due,))
                n, due = (n + 1 if over else 0), due + 1
                fired = n == self.sustain
                continue
            if waiting is None:
                waiting = {k[0]: v[1] for k, v in self.early.iterator()}
            ahead = {k: ms for k, ms in waiting.items() if k >= due}
            if not ahead or not given_up(due, ahead):
                break
            n, due = 0, min(ahead)
        if fired:
            self.early.clear()
        self.state.update((n, due, fired))
        if fired:
            yield pd.DataFrame([(*key, due - self.sustain)], columns=[self.key_name, "detected_at"])

    def handleInputRows(self, key, rows, timerValues):
        _, due, fired = self.state.get() if self.state.exists() else (0, self.first, False)
        if fired:
            return
        for pdf in rows:
            for snapshot, over, ms in zip(pdf["snapshot"].tolist(), pdf["over"].tolist(), pdf["ms"].tolist()):
                if snapshot >= due:
                    self.early.updateValue((snapshot,), (bool(over), ms))
                    if self.patience_ms is not None:
                        self.handle.registerTimer(ms + self.patience_ms)
        yield from self._judge(key, lambda due, ahead: max(ahead) - due >= self.reach)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.state.exists() or self.state.get()[2]:
            return
        now = timerValues.getCurrentWatermarkInMs()
        yield from self._judge(key, lambda due, ahead: min(ahead.values()) + self.patience_ms <= now)

    def close(self) -> None:
        pass


def sustained_alarm(
    stream: DataFrame, key: str, snapshot: str, over: str, *, sustain: int = 3, first: int = 0, reach: int = 10_000,
    timestamp: str | None = None, delay: str = "10 minutes", patience_s: float = 3_600.0,
) -> DataFrame:
    """Fires once per asset when ``sustain`` consecutive snapshots are over the line.

    Snapshots are numbered from ``first``; one that arrives early waits for those before it,
    and a repeated one is ignored.  One that is lost breaks the streak: it is given up when
    one that is ``reach`` numbers later has come or, with ``timestamp``, when the watermark is
    ``patience_s`` past a later one.  An asset so keeps ``reach`` snapshots at most, and of
    one that has fired the mark that it has.
    """
    if sustain < 1 or reach < 1:
        raise ValueError(f"sustain and reach must be positive, got {sustain} and {reach}")
    marked = stream.withWatermark(timestamp, delay) if timestamp else stream
    time = [timestamp, F.unix_millis(timestamp).alias("ms")] if timestamp else [F.lit(0).cast("long").alias("ms")]
    rows = marked.select(key, F.col(snapshot).cast("long").alias("snapshot"), F.col(over).alias("over"), *time)
    kind = stream.schema[key].dataType.simpleString()
    patience_ms = int(patience_s * 1000) if timestamp else None
    return rows.filter("snapshot is not null").groupBy(key).transformWithStateInPandas(
        _Sustained(sustain, key, first, reach, patience_ms),
        f"{key} {kind}, detected_at long",
        "Append",
        "EventTime" if timestamp else "None",
    )


class _Outcome(StatefulProcessor):
    """The newest row of a run and whether it has shown an error or an overflow warning.

    The run is judged by a timer when the watermark has passed its newest row, so it does not
    matter how its rows are dealt over batches; a judged run leaves no state.
    """

    def __init__(self, key_name: str, timeout_ms: int | None, overflow_phrase: str):
        self.key_name, self.timeout_ms, self.phrase = key_name, timeout_ms, overflow_phrase

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("run", "first long, newest long, event string, failed boolean, spent boolean")

    def handleInputRows(self, key, rows, timerValues):
        seen = self.state.get() if self.state.exists() else (None, -1, "", False, False)
        first, newest, event, failed, spent = seen
        known = first is not None
        for pdf in rows:
            failed = failed or bool((pdf["level"] == "ERROR").any())
            warned = (pdf["level"] == "WARN") & pdf["message"].fillna("").str.contains(self.phrase, regex=False)
            spent = spent or bool(warned.any())
            newest, event = max([(newest, event), *zip(pdf["us"].tolist(), pdf["event_type"].fillna("").tolist())])
            low = int(pdf["us"].min())
            first = low if first is None else min(first, low)
        if not known and self.timeout_ms is not None:
            self.handle.registerTimer(first // 1000 + self.timeout_ms)
        self.handle.registerTimer(newest // 1000 + 1)
        self.state.update((first, newest, event, failed, spent))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if not self.state.exists():
            return
        first, newest, event, failed, spent = self.state.get()
        now = timerValues.getCurrentWatermarkInMs()
        if event in TERMINAL_EVENTS and newest // 1000 < now:
            outcome = "failed" if failed else "empty-reasoning-overflow" if spent else "completed"
        elif self.timeout_ms is not None and first // 1000 + self.timeout_ms <= now:
            outcome = "timeout"
        else:
            return
        self.state.clear()
        yield pd.DataFrame([(*key, outcome)], columns=[self.key_name, "outcome"])

    def close(self) -> None:
        pass


def run_outcomes(
    logs: DataFrame, run: str = "run_id", *, delay: str = "10 minutes", timeout_s: float | None = RUN_TIMEOUT_S,
    overflow_phrase: str = "reasoning block",
) -> DataFrame:
    """One outcome per run of a log stream, by the rule of ``runs.outcome_by_event``.

    A run is judged once the watermark has passed its newest row: if that row is terminal it
    has ended.  Among rows of one instant the event that sorts last is the newest.  A run
    without a terminal row ends as a timeout when the watermark is ``timeout_s`` past its first
    row; with None it keeps its state for ever.  Rows later than the watermark are dropped,
    repeated deliveries count once.
    """
    marked = logs.withWatermark("created_at", delay).dropDuplicatesWithinWatermark(
        [run, "created_at", "event_type", "message"]
    )
    rows = marked.select(run, "created_at", F.unix_micros("created_at").alias("us"), "level", "event_type", "message")
    kind = logs.schema[run].dataType.simpleString()
    timeout_ms = None if timeout_s is None else int(timeout_s * 1000)
    return rows.groupBy(run).transformWithStateInPandas(
        _Outcome(run, timeout_ms, overflow_phrase), f"{run} {kind}, outcome string", "Append", "EventTime"
    )


def neighbors_by_batch(stream: DataFrame, library: DataFrame, k: int, name: str, **options) -> DataFrame:
    """Exact neighbours of a stream's vectors, each micro-batch searched as a batch.

    A library of any size can be searched so, also one that is beyond the broadcast limit.  A
    batch that is repeated after a failure replaces what it has written.
    """
    from sensorspark.operators.neighbors import knn

    path = fresh_path(stream.sparkSession, name)

    def search(batch: DataFrame, number: int) -> None:
        knn(batch, library, k, **options).write.mode("overwrite").parquet(f"{path}/rows/batch={number}")

    run = stream.writeStream.foreachBatch(search).option("checkpointLocation", f"{path}/state")
    run.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.parquet(f"{path}/rows").drop("batch")


def drain(stream: DataFrame, name: str, *, timeout_s: int | None = None) -> DataFrame:
    """Run a stream over everything available now and read its output back; no time limit by default.

    Output and checkpoint go to a new place under the shared folder, so a restarted
    executor or driver continues from committed state.
    """
    spark = stream.sparkSession
    path = fresh_path(spark, name)
    out = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/state")
    with rocksdb(spark):
        running = out.option("path", f"{path}/rows").trigger(availableNow=True).start()
        if timeout_s is None:
            running.awaitTermination()
        elif not running.awaitTermination(timeout_s):
            running.stop()
            raise TimeoutError(f"stream {name} did not finish in {timeout_s} s")
    return spark.read.schema(stream.schema).parquet(f"{path}/rows")
