"""Media and table sources and sinks. Audio is PCM WAV; other formats are listed, not decoded."""

from __future__ import annotations

import io
import wave

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.operators.acoustic import resample


def scan_media(spark: SparkSession, path: str, glob: str = "*.{wav,flac,ogg}") -> DataFrame:
    """Files below a folder: path, length, content (read only when used)."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path).select("path", "length", "content")


def _open(data: bytes):
    try:
        return wave.open(io.BytesIO(data))
    except (wave.Error, EOFError, RuntimeError):  # a chunk longer than its file is a RuntimeError
        return None


def probe_media(df: DataFrame) -> DataFrame:
    """path, frames, rate, seconds; NULL where the header cannot be read."""
    def run(batches):
        for b in batches:
            out = []
            for path, data in zip(b["path"], b["content"]):
                w = _open(data)
                out.append((path, w and w.getnframes(), w and w.getframerate()))
            x = pd.DataFrame(out, columns=["path", "frames", "rate"]).astype({"frames": "Int64", "rate": "Int64"})
            yield x

    # Whole files: chunks of any size may stand before the data.
    return df.select("path", "content").mapInPandas(run, "path string, frames bigint, rate bigint").withColumn("seconds", F.col("frames") / F.col("rate"))


def decode_media(df: DataFrame, sr: int, start_s: float = 0.0, stop_s: float | None = None) -> DataFrame:
    """path, sr, samples: mono mix resampled to `sr`; unreadable files give NULL."""
    def decode(data):
        w = _open(data)
        if w is None:
            return None
        rate, width = w.getframerate(), w.getsampwidth()
        w.setpos(min(w.getnframes(), int(start_s * rate)))
        raw = w.readframes(w.getnframes() if stop_s is None else max(0, int((stop_s - start_s) * rate)))
        raw = raw[:len(raw) - len(raw) % (width * w.getnchannels())]  # data may end inside a frame
        if width == 3:
            b = np.frombuffer(raw, "uint8").reshape(-1, 3).astype("int32")
            x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8) / 2**23
        else:
            x = (np.frombuffer(raw, "uint8").astype("float64") - 128) / 128 if width == 1 else np.frombuffer(raw, f"<i{width}") / 2 ** (8 * width - 1)
        x = x.reshape(-1, w.getnchannels()).mean(axis=1)
        return resample(x, rate, sr).astype("float32")

    def run(batches):
        for b in batches:
            for path, data in zip(b["path"], b["content"]):  # a row a frame: one signal in memory at a time
                yield pd.DataFrame({"path": [path], "sr": [sr], "samples": [decode(data)]})

    return df.select("path", "content").mapInPandas(run, "path string, sr int, samples array<float>")


def read_meta(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def scan_label_csv(spark: SparkSession, path: str, key: str, cols: dict[str, str], lists: tuple[str, ...] = ()) -> DataFrame:
    """Columns of a label file with a header, renamed `{new: old}`; columns of `lists` are split
    from `[a, b]` into arrays of doubles. Rows without a key are left out."""
    df = spark.read.option("header", True).csv(path)
    number = lambda c: F.filter(F.split(F.regexp_replace(c, r"[\[\]\s]", ""), ","), lambda v: v != "").cast("array<double>")
    return df.select(F.col(key).alias("file"), *[(number(F.col(old)) if new in lists else F.col(old)).alias(new) for new, old in cols.items()]).where("file is not null")


def join_labels(df: DataFrame, file: Column, labels: DataFrame, key: str) -> DataFrame:
    """Rows with their labels; rows without one are left out. Catalyst picks the join by the sizes it measures."""
    return df.withColumn("_file", file).join(labels.withColumnRenamed(key, "_file"), "_file").drop("_file")


def join_scores(scores: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Scored rows with their metadata; the key stays a zero-padded string on both sides."""
    return scores.withColumn(key, F.col(key).cast("string")).join(meta.withColumn(key, F.col(key).cast("string")), key)


def todo_ids(wanted: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Ids still to build."""
    return wanted.select(key).join(present.select(key), key, "left_anti")


def read_embedded(df: DataFrame, audio: str = "audio", speaker: tuple[str, ...] = ("speaker_id", "speaker", "spk"), text: tuple[str, ...] = ("transcript", "text", "sentence")) -> DataFrame:
    """Audio held in rows as struct<bytes>: content, and speaker and text from whichever of their columns there are."""
    pick = lambda names: F.coalesce(*[F.col(c).cast("string") for c in names if c in df.columns], F.lit(None).cast("string"))
    return df.select(F.col(f"{audio}.bytes").alias("content"), pick(speaker).alias("speaker"), pick(text).alias("text"))


def read_manifest(spark: SparkSession, path: str, required: list[str]) -> DataFrame:
    df = spark.read.parquet(path)
    if missing := sorted(set(required) - set(df.columns)):
        raise ValueError(f"{path}: missing columns {missing}")
    return df


def decode_nested(df: DataFrame, col: str, schema: str) -> DataFrame:
    return df.withColumn(col, F.from_json(col, schema))


def predominant(ratings: Column) -> Column:
    """Map class -> ratings: the classes every rater gave at least 1."""
    return F.map_keys(F.map_filter(ratings, lambda _, v: (F.size(v) > 0) & (F.array_min(v) >= 1)))


def screen_incremental(df: DataFrame, prior: DataFrame, key: str, screen) -> DataFrame:
    """Old verdicts stay, only unseen keys are screened."""
    return prior.join(df.select(key), key, "left_semi").unionByName(screen(df.join(prior.select(key), key, "left_anti")).select(prior.columns))


def write_manifest(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_frozen(df: DataFrame, path: str) -> None:
    """Refuses to overwrite."""
    df.write.mode("errorifexists").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """A small report as one CSV file with a header; rows are gathered by Spark, not by the driver."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def markdown_table(df: DataFrame, most: int = 1000) -> str:
    """A report of at most `most` rows as a Markdown table; a longer one raises, since the driver holds it."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows")
    line = lambda xs: "| " + " | ".join("" if x is None else str(x) for x in xs) + " |"
    return "\n".join([line(df.columns), line(["---"] * len(df.columns)), *map(line, rows)])


def write_list(df: DataFrame, col: str, path: str, header: str) -> None:
    """A text file of one column below a header line."""
    head = df.sparkSession.range(1).select(F.lit(header).alias("value"))
    head.unionByName(df.select(F.col(col).cast("string").alias("value"))).coalesce(1).write.mode("overwrite").text(path)
