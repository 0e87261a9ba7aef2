"""Stateful streams against plain loops over the whole input."""

import random

import pytest
from pyspark.sql import functions as F

from sparrowmill.operators import aggs, radio
from sparrowmill.streaming import stateful


@pytest.fixture()
def rocks(spark):
    for k, v in stateful.session_options.items():
        spark.conf.set(k, v)
    yield spark
    for k in stateful.session_options:
        spark.conf.unset(k)


HOPS = "rx string, ms bigint, dur bigint, squelch boolean, level double, partial string"


def _hops(seed, n=240):
    """Hops of 100 ms of receivers with and without a squelch line."""
    r, rows = random.Random(seed), []
    for rx in ("s", "v", "w"):
        on, said = False, ""
        for i in range(n):
            if r.random() < 0.15:
                on, said = not on, ""
            said = (said + r.choice((" go", " over", " out", "")))[-12:] if on else said
            rows.append((rx, 100 * (i + 1), 100, on if rx == "s" else None, -20.0 if on else -60.0, said))
    return rows


def _loop(rows, hang_s=1.0, min_s=0.5):
    """The plain segmenter: one hop after the other, in seconds."""
    out = []
    for rx in sorted({r[0] for r in rows}):
        buf, silent = [], 0
        for _, ms, dur, squelch, level, partial in sorted(r for r in rows if r[0] == rx):
            active = squelch if squelch is not None else level > -42
            if active:
                silent = 0
            if active or buf:
                buf.append((ms, dur, partial))
                if not active:
                    silent += dur
                early = partial.endswith(" over") or partial.endswith(" out")
                if silent >= 1000 * (0.1 if squelch is not None else hang_s) or (early and silent >= 100):
                    total = sum(d for _, d, _ in buf)
                    if total >= 1000 * min_s:
                        out.append((rx, buf[0][0], ms + dur, total, len(buf)))
                    buf, silent = [], 0
    return sorted(out)


def _feed(spark, folder, rows, schema, batches, seed):
    """Files of shuffled rows, each within two seconds of event time, and a last row that moves the watermark."""
    r = random.Random(seed)
    rows = sorted(rows, key=lambda x: x[1] + r.uniform(0, 2000))
    size = -(-len(rows) // batches)
    for i in range(batches):
        spark.createDataFrame(rows[i * size:(i + 1) * size], schema).coalesce(1).write.mode("append").json(f"{folder}/in")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{folder}/in")


def test_stream_of_hops_equals_the_loop(rocks, tmp_path):
    rows = _hops(5)
    end = [(rx, 10_000_000, 100, None, -60.0, "") for rx in ("s", "v", "w", "x")]
    schema = HOPS
    hops = _feed(rocks, tmp_path, rows, schema, 6, 1)
    make = lambda d: stateful.stream_transmissions(d.withColumn("ts", F.timestamp_millis("ms")), "rx", "ts", "5 seconds").select("rx", "start", "stop", "dur", "n")
    start = lambda: make(hops).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start()
    start().awaitTermination()
    for _ in range(2):  # two restarts, which move the watermark behind the last hop
        rocks.createDataFrame(end, schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        start().awaitTermination()
    got = sorted(tuple(r) for r in rocks.read.parquet(str(tmp_path / "out")).collect())
    assert got == _loop(rows) and len(got) > 10


def test_batch_of_hops_equals_the_loop(spark):
    rows = _hops(6)
    df = spark.createDataFrame(rows, HOPS)
    on = F.coalesce("squelch", F.col("level") > stateful.THRESHOLD_DB)
    early = F.col("squelch").isNotNull() | F.col("partial").endswith(" over") | F.col("partial").endswith(" out")
    got = stateful.transmissions(df, "rx", "ms", [], on, F.when(early, 100).otherwise(1000), "dur")
    assert sorted(map(tuple, got.collect())) == _loop(rows)


def test_late_hops_are_left_out(rocks, tmp_path):
    hop = lambda ms, on: ("s", ms, 100, on, None, "")
    first, late = [hop(1000 + 100 * i, i < 8) for i in range(10)] + [hop(60_000, False)], [hop(500, True), hop(61_000, False)]
    for rows in (first, late, [hop(120_000, False)], [hop(180_000, False)]):
        rocks.createDataFrame(rows, HOPS).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        src = rocks.readStream.schema(HOPS).json(f"{tmp_path}/in").withColumn("ts", F.timestamp_millis("ms"))
        stateful.stream_transmissions(src, "rx", "ts", "1 second").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert [(r.start, r.stop, r.dur, r.n) for r in rocks.read.parquet(str(tmp_path / "out")).collect()] == [(1000, 1900, 900, 9)]


def test_changes_fold_to_the_superseded_table(rocks, tmp_path):
    r = random.Random(7)
    rows = [(r.choice(("a", "b", "c")), 50 * (i + 1), f"m{i:03}") for i in range(200)]
    schema = "sender string, ms bigint, id string"
    src = _feed(rocks, tmp_path, rows, schema, 5, 2)
    run = lambda: stateful.stream_superseded(src.withColumn("ts", F.timestamp_millis("ms")), "sender", "ts", "id", "5 seconds").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    run()
    for k in (1, 2):
        rocks.createDataFrame([(x, k * 1_000_000, f"z{k}{x}") for x in "abc"], schema).coalesce(1).write.mode("append").json(f"{tmp_path}/in")
        run()
    changes = rocks.read.schema("sender string, id string, superseded_by string").parquet(str(tmp_path / "out"))
    got = {(x.sender, x.id): x.superseded_by for x in stateful.fold_changes(changes, "sender").collect() if x.id[0] == "m"}
    batch = aggs.superseded_by(rocks.createDataFrame(rows, schema), "sender", ["ms", "id"], "id").collect()
    last = {s: max(x.id for x in batch if x.sender == s) for s in "abc"}
    want = {(x.sender, x.id): x.superseded_by or f"z1{x.sender}" for x in batch}
    assert got == want and all(want[s, last[s]].startswith("z1") for s in "abc")


def test_a_killed_sink_writes_each_marker_once(spark, tmp_path):
    """The query dies behind its data and before the ledger; the replayed batch changes nothing."""
    schema = "id string, text string, ts timestamp"
    src = spark.range(30).select(F.col("id").cast("string").alias("id"), F.concat(F.lit("Charlie six, this is Alpha one, grid "), F.when(F.col("id") % 2 == 0, "one two three four").otherwise("fife fife six six"), F.lit(", over")).alias("text"), F.timestamp_seconds(F.col("id") + 1).alias("ts"))
    for i in range(3):
        src.where(F.col("id").cast("int") % 3 == i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    src.where("id in ('3', '4')").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))  # sent again
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    deaths = []

    def make(df):
        out = radio.markers(radio.with_extraction(df, "text"), "id", "ts")
        if len(deaths) < 2:  # data of the batch is there, the ledger entry is not
            deaths.append(1)
            out.write.mode("overwrite").parquet(f"{tmp_path}/sink/data/batch={len(deaths) - 1}")
            raise RuntimeError("killed")
        return out

    for _ in range(4):
        try:
            stateful.write_once(stream(), f"{tmp_path}/sink", str(tmp_path / "c"), make, "id", "ts", "1 hour").awaitTermination()
        except Exception as e:
            assert "killed" in str(e)
    want = radio.markers(radio.with_extraction(src, "text"), "id", "ts")
    got = stateful.Ledger(f"{tmp_path}/sink").read(spark, want.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 30 and len(deaths) == 2


def test_an_entered_batch_is_not_written_again(spark, tmp_path):
    ledger = stateful.Ledger(str(tmp_path))
    ledger.write(spark.range(3), 0)
    ledger.write(spark.range(5), 0)
    spark.range(9).write.parquet(f"{tmp_path}/data/batch=1")  # cut off before its entry
    assert ledger.read(spark, spark.range(1).schema).count() == 3
    ledger.write(spark.range(2), 1)
    assert ledger.read(spark, spark.range(1).schema).count() == 5
