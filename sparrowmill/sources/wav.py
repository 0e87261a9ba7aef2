"""WAV files as a data source of Spark.

`read_wav` asks for the columns that are wanted: without `samples` only the chunk heads of a file
are read, whatever its size. Long files are cut into byte ranges, so that no task holds one whole.
Folders may lie in any store that Arrow opens by its address.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

SCHEMA = "path string, length bigint, frames bigint, rate int, channels int, seconds double, start bigint, samples array<float>"
#: Bytes of a file in one piece; files that share a task have about as many together.
SPLIT_BYTES = 32 << 20
PCM, FLOAT, EXTENSIBLE = 1, 3, 0xFFFE


@dataclass
class Head:
    kind: int
    rate: int
    channels: int
    width: int
    start: int
    frames: int

    @property
    def block(self) -> int:
        return self.channels * self.width


def walk(f, size: int) -> Head | None:
    """Head of a WAV file by its chunks, of which only the heads and the format are read; None for
    other files. A data chunk longer than its file ends with it."""
    if f.read(4) != b"RIFF" or f.read(8)[4:] != b"WAVE":
        return None
    at, form = 12, None
    while at + 8 <= size:
        f.seek(at)
        name, n = struct.unpack("<4sI", f.read(8))
        if name == b"fmt " and n >= 16:
            raw = f.read(min(n, 40))
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", raw[:16])
            kind = struct.unpack("<H", raw[24:26])[0] if kind == EXTENSIBLE and len(raw) >= 26 else kind
            form = (kind, rate, channels, bits // 8)
        elif name == b"data" and form:
            kind, rate, channels, width = form
            known = (kind == PCM and width in (1, 2, 3, 4)) or (kind == FLOAT and width in (4, 8))
            return Head(*form, at + 8, min(n, size - at - 8) // (channels * width)) if known and channels and rate else None
        at += 8 + n + n % 2
    return None


def mono(raw: bytes, head: Head) -> np.ndarray:
    """Mean of the channels as floats of full scale 1."""
    if head.kind == FLOAT:
        x = np.frombuffer(raw, f"<f{head.width}").astype("float64")
    elif head.width == 1:
        x = (np.frombuffer(raw, "uint8").astype("float64") - 128) / 128
    elif head.width == 3:
        b = np.frombuffer(raw, "uint8").reshape(-1, 3).astype("int32")
        x = ((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) << 8 >> 8) / 2**23
    else:
        x = np.frombuffer(raw, f"<i{head.width}") / 2.0 ** (8 * head.width - 1)
    return x.reshape(-1, head.channels).mean(axis=1)


class Files(InputPartition):
    """Pieces (path, length, first byte, byte behind the last) of one task."""

    def __init__(self, pieces):
        self.pieces = pieces


class WavReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names = [f.name for f in schema.fields]
        self.folder, self.split = options["path"], int(options.get("split", SPLIT_BYTES))

    def partitions(self) -> list[Files]:
        store, root = fs.FileSystem.from_uri(self.folder) if "://" in self.folder or self.folder.startswith("file:") else (fs.LocalFileSystem(), self.folder)
        found = store.get_file_info(fs.FileSelector(root, recursive=True))
        out, held, size = [], [], 0
        for f in sorted((f for f in found if f.is_file and f.path.lower().endswith(".wav")), key=lambda f: f.path):
            cuts = range(0, max(1, f.size), self.split) if "samples" in self.names else [0]
            for lo in cuts:
                held.append((f.path, f.size, lo, lo + self.split if "samples" in self.names else f.size))
                size += min(self.split, f.size) if "samples" in self.names else 1 << 16
                if size >= self.split:
                    out.append(Files(held))
                    held, size = [], 0
        return out + ([Files(held)] if held else [])

    def open(self, path: str):
        store = fs.FileSystem.from_uri(self.folder)[0] if "://" in self.folder or self.folder.startswith("file:") else fs.LocalFileSystem()
        return store.open_input_file(path)

    def read(self, partition: Files) -> Iterator[tuple]:
        for path, length, lo, hi in partition.pieces:
            with self.open(path) as f:
                head = walk(f, length)
                row = {"path": path, "length": length}
                if head is None:
                    if lo == 0:
                        yield tuple(row.get(n) for n in self.names)
                    continue
                row |= {"frames": head.frames, "rate": head.rate, "channels": head.channels, "seconds": head.frames / head.rate, "start": 0}
                if "samples" in self.names:
                    # Frames belong to the range that holds their first byte; the first range has the row of an empty file.
                    first = max(0, -(-(lo - head.start) // head.block))
                    last = min(head.frames, max(0, -(-(hi - head.start) // head.block)))
                    if last <= first and not (lo == 0 and head.frames == 0):
                        continue
                    f.seek(head.start + first * head.block)
                    row |= {"start": first, "samples": mono(f.read((last - first) * head.block), head).astype("float32").tolist()}
                yield tuple(row.get(n) for n in self.names)


class WavSource(DataSource):
    """`spark.read.format("wav").schema(columns).load(folder)`: the columns of the schema are what is read."""

    @classmethod
    def name(cls) -> str:
        return "wav"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> WavReader:
        return WavReader(schema, self.options)


def read_wav(spark: SparkSession, folder: str, columns: list[str] | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """WAV files below a folder: the wanted columns of path, length, frames, rate, channels, seconds,
    start, samples. With samples there is a row for each piece of a file (`start`: its first frame),
    else one a file, for which no sample is read. Files that are no WAV have nulls."""
    spark.dataSource.register(WavSource)
    kinds = dict(c.split() for c in SCHEMA.split(", "))
    if unknown := sorted(set(columns or kinds) - set(kinds)):
        raise ValueError(f"no columns {unknown}")
    ddl = ", ".join(f"{c} {kinds[c]}" for c in columns or kinds)
    return spark.read.format("wav").schema(ddl).option("split", str(split_bytes)).load(folder)
