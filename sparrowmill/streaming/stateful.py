"""Streams with state of their own: transmissions of a receiver, superseded positions, and a sink
that a restart does not repeat.

The processors keep rows of a key until the watermark has passed them and then take them in
event-time order, so the order and the cutting of micro-batches change nothing. They need the
RocksDB state store, which `session_options` names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sparrowmill.functions.scans import scan

HANG_MS, SQUELCH_HANG_MS, LEAST_MS, THRESHOLD_DB = 1000, 100, 500, -42.0
CLOSING = (" over", " out")

#: Options of a session that runs the processors.
session_options = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

_HOP = "ms bigint, dur bigint, squelch boolean, level double, partial string"
SEGMENT = "start bigint, stop bigint, dur bigint, n bigint, partial string"


def active(squelch, level) -> bool:
    """The squelch line decides where there is one, else the level."""
    return bool(squelch) if squelch is not None else level is not None and level > THRESHOLD_DB


def step(state: tuple | None, hop: tuple, hang_ms: int = HANG_MS, least_ms: int = LEAST_MS):
    """One hop: the new state (None outside a transmission) and the transmission that it closes, if long enough.
    State: start, silence, total, hops, last partial. Times are whole milliseconds."""
    ms, dur, squelch, level, partial = hop
    on = active(squelch, level)
    if state is None and not on:
        return None, None
    start, silence, total, n, said = state or (ms, 0, 0, 0, "")
    silence = 0 if on else silence + dur
    total, n, said = total + dur, n + 1, partial or said
    hang = SQUELCH_HANG_MS if squelch is not None or (partial or "").endswith(CLOSING) else hang_ms
    if silence < hang:
        return (start, silence, total, n, said), None
    return None, (start, ms + dur, total, n, said) if total >= least_ms else None


class _InOrder(StatefulProcessor):
    """Rows wait in the state until the watermark has reached them and are then taken in order. A row
    that is not newer than the watermark when it comes is late and left out."""

    ROW = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.ROW)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new, due = [], set()
        mark = timerValues.getCurrentWatermarkInMs()
        for pdf in rows:
            for r in pdf[self.columns()].itertuples(index=False):
                r = tuple(None if pd.isna(v) else v for v in r)
                if r[0] is not None and r[0] > mark:
                    new.append(tuple(int(v) if isinstance(v, (int, float)) and k in self.whole() else v for k, v in zip(self.columns(), r)))
                    due.add(int(r[0]))
        for r in new:
            self.waiting.appendValue(r)
        if due:
            self.handle.registerTimer(min(due))
        yield self.nothing()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        rows = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: (r[0], tuple(str(v) for v in r[1:]))) if self.waiting.exists() else []
        ready, rest = [r for r in rows if r[0] <= mark], [r for r in rows if r[0] > mark]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(int(rest[0][0]))
        elif rows:
            self.waiting.clear()
        yield self.take(key, ready)

    def columns(self) -> list[str]:
        return [c.split()[0] for c in self.ROW.split(", ")]

    def whole(self) -> set[str]:
        return {c.split()[0] for c in self.ROW.split(", ") if c.endswith("bigint")}

    def close(self) -> None:
        pass


class Segmenter(_InOrder):
    """Transmissions of one receiver; see `step`."""

    ROW = _HOP

    def __init__(self, key: str, kind: str, hang_ms: int, least_ms: int):
        self.key, self.kind, self.hang_ms, self.least_ms = key, kind, hang_ms, least_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.open = handle.getValueState("open", "start bigint, silence bigint, total bigint, n bigint, said string")

    def nothing(self) -> pd.DataFrame:
        return pd.DataFrame(columns=[self.key, "start", "stop", "dur", "n", "partial"])

    def take(self, key, hops) -> pd.DataFrame:
        state = tuple(self.open.get()) if self.open.exists() else None
        had, out = state is not None, []
        for hop in hops:
            state, done = step(state, hop, self.hang_ms, self.least_ms)
            if done:
                out.append((key[0], *done))
        if state is not None:
            self.open.update(state)
        elif had:
            self.open.clear()
        return pd.DataFrame(out, columns=self.nothing().columns)


def stream_transmissions(hops: DataFrame, key: str, ts: str, late: str = "10 seconds", hang_ms: int = HANG_MS, least_ms: int = LEAST_MS) -> DataFrame:
    """Transmissions of a stream of hops (key, `ts`, dur in ms, squelch or null, level in dB, partial
    text): key, start and stop in ms, dur, n hops, partial. A transmission opens with activity and
    closes after `hang_ms` of silence, after 100 ms where a squelch line is given or the partial
    ends in over or out; shorter ones than `least_ms` are dropped. It comes out when the watermark
    passes its end; hops not newer than the watermark are left out."""
    kind = hops.schema[key].dataType.simpleString()
    t = hops.withWatermark(ts, late).select(key, ts, F.unix_millis(ts).alias("ms"), F.col("dur").cast("long").alias("dur"), "squelch", F.col("level").cast("double").alias("level"), "partial")
    return t.groupBy(key).transformWithStateInPandas(Segmenter(key, kind, hang_ms, least_ms), f"`{key}` {kind}, {SEGMENT}", outputMode="Append", timeMode="EventTime")


def transmissions(hops: DataFrame, key: str, ms: str, order: list[str], on: Column, hang: Column, dur: str, least_ms: int = LEAST_MS) -> DataFrame:
    """The same over a batch, without a task per receiver: key, start, stop, dur, n. `on`: activity of a
    hop; `hang`: silence in ms that closes there. Silence is a difference of running sums since the
    last active hop; the first hop of a silence that reaches its hang closes what is open."""
    by = [ms, *order]
    d = hops.select(key, *by, F.col(dur).cast("long").alias("_d"), F.coalesce(on, F.lit(False)).alias("_on"), hang.alias("_hang"))
    d = scan(d, key, by, sums={"_t": F.col("_d"), "_a": F.col("_on").cast("int"), "_i": F.lit(1)})
    own = F.when(F.col("_on"), F.col("_t"))
    d = scan(d, key, by, last={"_heard": own}).where("_a > 0")
    shut = ~F.col("_on") & (F.col("_t") - F.col("_heard") >= F.col("_hang"))
    at = F.struct("_i", F.col("_t").alias("t"), (F.col(ms) + F.col("_d")).alias("stop"))
    # A row per active hop, with the first hop behind it that closes.
    runs = d.groupBy(key, "_a").agg(F.min(F.when(F.col("_on"), F.struct("_i", (F.col("_t") - F.col("_d")).alias("t"), F.col(ms).alias("start")))).alias("h"), F.min(F.when(shut, at)).alias("c"))
    runs = scan(runs, key, ["_a"], sums={"_closed": F.col("c").isNotNull().cast("int")})
    seg = F.col("_closed") - F.col("c").isNotNull().cast("int")
    out = runs.withColumn("_s", seg).groupBy(key, "_s").agg(F.min("h").alias("h"), F.max("c").alias("c")).where("c is not null")
    return out.select(key, F.col("h.start").alias("start"), F.col("c.stop").alias("stop"), (F.col("c.t") - F.col("h.t")).alias("dur"), (F.col("c._i") - F.col("h._i") + 1).alias("n")).where(F.col("dur") >= least_ms)


class Tracker(_InOrder):
    """Positions of one sender: each new one, and a correction of the one before."""

    ROW = "ms bigint, id string"

    def __init__(self, key: str):
        self.key = key

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", "id string")

    def nothing(self) -> pd.DataFrame:
        return pd.DataFrame(columns=[self.key, "id", "superseded_by"])

    def take(self, key, rows) -> pd.DataFrame:
        last, out = (self.last.get()[0] if self.last.exists() else None), []
        for _, i in rows:
            if last is not None:
                out.append((key[0], last, i))
            out.append((key[0], i, None))
            last = i
        if rows:
            self.last.update((last,))
        return pd.DataFrame(out, columns=self.nothing().columns)


def stream_superseded(markers: DataFrame, sender: str, ts: str, marker: str, late: str = "10 seconds") -> DataFrame:
    """Changes of the table of positions: a row (sender, id, null) for each new marker and a row
    (sender, id, superseded_by) that corrects the marker of that sender before it. Folding the
    changes, the last row of an id counts, gives `superseded_by` of the batch. Markers not
    newer than the watermark are left out; markers of one time follow each other by id."""
    kind = markers.schema[sender].dataType.simpleString()
    t = markers.withWatermark(ts, late).where(F.col(sender).isNotNull()).select(sender, ts, F.unix_millis(ts).alias("ms"), F.col(marker).cast("string").alias("id"))
    return t.groupBy(sender).transformWithStateInPandas(Tracker(sender), f"`{sender}` {kind}, id string, superseded_by string", outputMode="Append", timeMode="EventTime")


def fold_changes(changes: DataFrame, sender: str) -> DataFrame:
    """State of the table after its changes: sender, id, superseded_by."""
    return changes.groupBy(sender, "id").agg(F.max("superseded_by").alias("superseded_by"))


class Ledger:
    """Batches of a sink in a folder: each is written to a place of its own and then entered in the
    ledger. A batch that is entered is not written again, one that was cut off is overwritten, and
    readers see entered batches only."""

    def __init__(self, folder: str):
        self.data, self.book = f"{folder}/data", f"{folder}/ledger"

    def _fs(self, spark, path: str):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()), p

    def entered(self, spark, batch: int) -> bool:
        fs, p = self._fs(spark, f"{self.book}/{batch}")
        return fs.exists(p)

    def write(self, df: DataFrame, batch: int) -> None:
        spark = df.sparkSession
        if self.entered(spark, batch):
            return
        df.write.mode("overwrite").parquet(f"{self.data}/batch={batch}")
        fs, p = self._fs(spark, f"{self.book}/{batch}")
        fs.create(p, True).close()

    def read(self, spark, schema) -> DataFrame:
        fs, p = self._fs(spark, self.book)
        done = sorted(int(f.getPath().getName()) for f in fs.listStatus(p)) if fs.exists(p) else []
        paths = [f"{self.data}/batch={b}" for b in done]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def write_once(stream: DataFrame, folder: str, checkpoint: str, make: Callable[[DataFrame], DataFrame], tx: str, ts: str, late: str = "10 minutes", **trigger) -> StreamingQuery:
    """Starts a query that writes `make` of each micro-batch to a `Ledger` in `folder`. A transmission
    that comes again within `late` is taken once; a batch that is replayed after a restart changes
    nothing."""
    ledger = Ledger(folder)
    once = stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([tx])
    return once.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, batch: ledger.write(make(df), batch)).trigger(**(trigger or {"availableNow": True})).start()
