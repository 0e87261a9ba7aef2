"""The WAV data source on odd chunks, widths, ranges and files that are none."""

import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, StringType

from sparrowmill.sources import wav


def _file(path, x, rate=8000, channels=1, kind=1, width=2, before=(), cut=0):
    """Writes `x` (frames x channels, full scale 1) with chunks before the data."""
    if kind == 3:
        data = x.astype(f"<f{width}").tobytes()
    elif width == 1:
        data = np.round(x * 127 + 128).astype("uint8").tobytes()
    elif width == 3:
        v = np.round(x * (2**23 - 1)).astype("<i4")
        data = np.ascontiguousarray(v).view("uint8").reshape(-1, 4)[:, :3].tobytes()
    else:
        data = np.round(x * (2 ** (8 * width - 1) - 1)).astype(f"<i{width}").tobytes()
    fmt = struct.pack("<HHIIHH", kind, channels, rate, rate * channels * width, channels * width, 8 * width)
    chunks = b"".join(struct.pack("<4sI", n, len(b)) + b + b"\0" * (len(b) % 2) for n, b in [(b"fmt ", fmt), *before])
    body = b"WAVE" + chunks + struct.pack("<4sI", b"data", len(data)) + data
    path.write_bytes((b"RIFF" + struct.pack("<I", len(body)) + body)[:-cut or None])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("wav")
    (d / "deep").mkdir()
    x = np.sin(np.arange(9000) / 7)[:, None] * 0.5
    _file(d / "a.wav", x)
    _file(d / "deep" / "b.WAV", np.c_[x, -x], channels=2, width=3, rate=16000, before=[(b"LIST", b"odd"), (b"junk", b"x" * 100)])
    _file(d / "f.wav", x, kind=3, width=4)
    _file(d / "u.wav", x, width=1)
    _file(d / "cut.wav", x, cut=1000)
    _file(d / "empty.wav", x[:0])
    (d / "none.wav").write_bytes(b"junk")
    (d / "nothing.wav").write_bytes(b"")
    (d / "notes.txt").write_bytes(b"RIFF")
    return d, x[:, 0]


@pytest.mark.parametrize("split", [wav.SPLIT_BYTES, 1001])
def test_samples_of_all_pieces(spark, folder, split):
    d, x = folder
    got = {}
    for r in wav.read_wav(spark, str(d), split_bytes=split).orderBy("path", "start").collect():
        name = r.path.rsplit("/", 1)[1]
        head = (r.frames, r.rate, r.channels, r.seconds)
        got.setdefault(name, (head, []))[1].extend(r.samples or [])
        assert r.samples is None or len(got[name][1]) == r.start + len(r.samples) and got[name][0] == head
    assert set(got) == {"a.wav", "b.WAV", "f.wav", "u.wav", "cut.wav", "empty.wav", "none.wav", "nothing.wav"}
    assert got["a.wav"][0] == (9000, 8000, 1, 9000 / 8000) and got["b.WAV"][0] == (9000, 16000, 2, 9000 / 16000)
    for name, tol in (("a.wav", 1e-4), ("f.wav", 1e-6), ("u.wav", 1e-2)):
        assert np.allclose(got[name][1], x, atol=tol)
    assert np.allclose(got["b.WAV"][1], 0, atol=1e-6) and got["cut.wav"][0][0] == 8500 and np.allclose(got["cut.wav"][1], x[:8500], atol=1e-4)
    assert got["empty.wav"] == ((0, 8000, 1, 0.0), []) and got["none.wav"] == got["nothing.wav"] == ((None,) * 4, [])


def test_headers_read_no_samples(spark, folder, monkeypatch):
    d, _ = folder
    rows = wav.read_wav(spark, str(d), ["path", "seconds"]).collect()
    assert len(rows) == 8 and {r.path.rsplit("/", 1)[1]: r.seconds for r in rows}["a.wav"] == 9000 / 8000
    read = []

    class Counted:
        def __init__(self, f):
            self.f = f

        def __enter__(self):
            return self

        def __exit__(self, *e):
            self.f.close()

        def seek(self, n):
            self.f.seek(n)

        def read(self, n):
            read.append(n)
            return self.f.read(n)

    monkeypatch.setattr(wav.WavReader, "open", lambda self, p, o=wav.WavReader.open: Counted(o(self, p)))
    count = lambda *names: [sum(1 for _ in r.read(p)) for r in [wav.WavReader(StructType([StructField(n, StringType()) for n in names]), {"path": str(d)})] for p in r.partitions()]
    assert sum(count("path", "seconds")) == 8 and sum(read) < 8 * 120
    read.clear()
    assert sum(count("path", "samples")) == 8 and sum(read) > 100_000


def test_long_files_are_cut_into_tasks(spark, folder):
    d, _ = folder
    df = wav.read_wav(spark, str(d), ["path", "start", "samples"], split_bytes=4096)
    assert df.rdd.getNumPartitions() > 10
    assert df.select(F.max(F.size("samples"))).first()[0] <= 4096
    with pytest.raises(ValueError, match="no columns"):
        wav.read_wav(spark, str(d), ["loudness"])
