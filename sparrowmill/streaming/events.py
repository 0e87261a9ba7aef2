"""Event-time streams; every function takes a batch or a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.functions.scans import scan
from sparrowmill.operators import acoustic
from sparrowmill.sources import files


def segments(df: DataFrame, key: str, ts: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """Segments of activity closed by a gap: key, start, stop (last row), n."""
    g = df.withWatermark(ts, late) if df.isStreaming else df
    return g.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.min(ts).alias("start"), F.max(ts).alias("stop"), F.count(F.lit(1)).alias("n")).drop("w")


def track_units(df: DataFrame, sender: str, order: Column, *fields: str) -> DataFrame:
    """Last position per sender (update mode on a stream)."""
    last = F.max_by(F.struct(*fields), order)
    return df.groupBy(sender).agg(last.alias("p")).select(sender, *[F.col(f"p.{f}").alias(f) for f in fields])


def latest_partial(df: DataFrame, key: str, text: str, order: Column) -> DataFrame:
    return df.groupBy(key).agg(F.max_by(text, order).alias(text))


def with_operator(df: DataFrame, ops: DataFrame) -> DataFrame:
    """Records entered by hand join the same table, with their source."""
    return df.withColumn("source_tag", F.lit("auto")).unionByName(ops.withColumn("source_tag", F.lit("operator")), allowMissingColumns=True)


def with_latency(df: DataFrame, stages: list[str]) -> DataFrame:
    """Seconds between neighbouring stages and from end to end."""
    t = {s: F.unix_micros(F.col(s)) for s in stages}
    for a, b in zip(stages, stages[1:]):
        df = df.withColumn(f"{b}_s", (t[b] - t[a]) / 1e6)
    return df.withColumn("total_s", (t[stages[-1]] - t[stages[0]]) / 1e6)


def closed_segments(df: DataFrame, key: str, ts: str, order: list[str], gap_s: float, closing: Column, least_s: float) -> DataFrame:
    """Segments of a batch that end by a gap or by a closing word: key, start, stop, n. Segments shorter than `least_s` are dropped."""
    by = [ts, *order]
    d = df.select(key, *by, (F.unix_micros(F.col(ts)) / 1e6).alias("_t"), closing.alias("_c"))
    d = scan(d, key, by, lag={"_before": F.col("_t"), "_shut": F.col("_c")})
    fresh = F.coalesce((F.col("_t") - F.col("_before") >= gap_s) | F.col("_shut"), F.lit(True))
    d = scan(d, key, by, sums={"_s": fresh.cast("int")})
    out = d.groupBy(key, "_s").agg(F.min(ts).alias("start"), F.max(ts).alias("stop"), F.count(F.lit(1)).alias("n"))
    return out.where((F.unix_micros("stop") - F.unix_micros("start")) / 1e6 >= least_s).drop("_s")


def harvest_folder(spark: SparkSession, folder: str, sr: int, seconds: float = 6.0, frame: int = 320) -> DataFrame:
    """Stream of the segments of the WAV files that a folder grows by: path, segment, samples, kind (speech or noise)."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    found = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.wav").load(folder)
    x = files.decode_media(found, sr).where("samples is not null").withColumn("samples", F.col("samples").cast("array<double>"))
    return acoustic.harvest(x.withColumnRenamed("samples", "x"), "path", "x", int(seconds * sr), frame)
