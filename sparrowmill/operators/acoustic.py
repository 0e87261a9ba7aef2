"""Signal features that need a filter, a spectrum or a walk: numpy per Arrow batch, a row a signal."""

from __future__ import annotations

import functools
import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .signals import frame_db

# The K weighting of the loudness standard, as (centre, gain in dB, quality) of a shelf and (corner, quality) of a high pass.
SHELF, HIGH_PASS = (1681.974450955533, 3.999843853973347, 0.7071752369554196), (38.13547087602444, 0.5003270373238773)
ABSOLUTE_GATE, RELATIVE_GATE, OFFSET = -70.0, -10.0, -0.691


def per_signal(df: DataFrame, x: str, f: Callable[[np.ndarray], float | None], name: str) -> DataFrame:
    """Adds a double computed from each array; null arrays give null."""
    one = F.pandas_udf(lambda s: pd.Series([None if v is None else f(np.asarray(v, "float64")) for v in s], dtype="float64"), "double")
    return df.withColumn(name, one(F.col(x)))


def attack_ms(x: np.ndarray, sr: int, window_ms: float = 1.5) -> float | None:
    """Rise from 10 to 90 % of the first transient: its onset reaches 10 % of the whole peak, its own peak lies in the window behind."""
    env = np.abs(x)
    if not len(env) or env.max() <= 0:
        return None
    rise = env[int(np.argmax(env >= 0.1 * env.max())):]
    rise = rise[:int(np.argmax(rise[:max(1, int(sr * window_ms / 1000))])) + 1]
    return float(np.argmax(rise >= 0.9 * rise[-1]) - np.argmax(rise >= 0.1 * rise[-1])) / sr * 1000


@functools.lru_cache(maxsize=16)
def _response(b: tuple, a: tuple) -> np.ndarray:
    """Impulse response of a second-order filter until it has died out; made once per worker."""
    h, y1, y2 = [], 0.0, 0.0
    while len(h) < 64 or (abs(y1) + abs(y2) > 1e-12 and len(h) < 1 << 17):
        y1, y2 = (b[len(h)] if len(h) < 3 else 0.0) - a[0] * y1 - a[1] * y2, y1
        h.append(y1)
    return np.array(h)


def _biquad(x: np.ndarray, b: np.ndarray, a: np.ndarray) -> np.ndarray:
    h = _response(tuple(b), tuple(a))[:len(x)]
    m = 1 << int(len(x) + len(h)).bit_length()
    return np.fft.irfft(np.fft.rfft(x, m) * np.fft.rfft(h, m), m)[:len(x)]


def k_filters(sr: int) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Numerator and denominator (without its leading one) of both filters of the K weighting."""
    fc, gain, q = SHELF
    amp, w = 10 ** (gain / 40), 2 * np.pi * fc / sr
    c, al = np.cos(w), np.sin(w) / (2 * q) * 2 * np.sqrt(amp)
    up, down = amp + 1, amp - 1
    a0 = up - down * c + al
    shelf = np.array([amp * (up + down * c + al), -2 * amp * (down + up * c), amp * (up + down * c - al)]) / a0, np.array([2 * (down - up * c), up - down * c - al]) / a0
    fc, q = HIGH_PASS
    w = 2 * np.pi * fc / sr
    c, al = np.cos(w), np.sin(w) / (2 * q)
    return shelf, (np.array([(1 + c) / 2, -(1 + c), (1 + c) / 2]) / (1 + al), np.array([-2 * c, 1 - al]) / (1 + al))


def k_weighted(x: np.ndarray, sr: int) -> np.ndarray:
    for b, a in k_filters(sr):
        x = _biquad(x, b, a)
    return x


def peak_hold(df: DataFrame, x: str, release: float, name: str) -> DataFrame:
    """Adds env with env[i] = max(|x[i]|, env[i - 1] * release): a running maximum of logarithms, so nothing overflows."""
    def hold(v):
        fall = np.arange(len(v)) * np.log(release)
        with np.errstate(divide="ignore"):
            return np.exp(np.maximum.accumulate(np.log(np.abs(np.asarray(v, "float64"))) - fall) + fall)
    one = F.pandas_udf(lambda s: pd.Series([None if v is None else hold(v) for v in s], dtype=object), "array<double>")
    return df.withColumn(name, one(F.col(x)))


def loudness_blocks(df: DataFrame, key: str, x: str, sr: int) -> DataFrame:
    """Mean squares of K-weighted blocks of 400 ms with three quarters of overlap: key, z."""
    size = int(0.4 * sr)

    def run(batches):
        for b in batches:
            for k, v in zip(b[key], b[x]):
                y = np.r_[0.0, np.cumsum(k_weighted(np.asarray(v, "float64"), sr) ** 2)]
                at = np.arange(0, len(y) - size, size // 4)
                z = (y[at + size] - y[at]) / size if len(at) else np.array([y[-1] / max(1, len(y) - 1)])
                yield pd.DataFrame({key: [k] * len(z), "z": z})

    return df.select(key, x).mapInPandas(run, f"{df.select(key).schema.simpleString()[7:-1].replace(':', ' ')}, z double")


def loudness_lufs(df: DataFrame, key: str, x: str, sr: int) -> DataFrame:
    """Integrated loudness: the gates are two aggregates over the block table; silence gives the absolute gate."""
    level = lambda c: OFFSET + 10 * F.log10(c + 1e-12)
    z = loudness_blocks(df, key, x, sr).where(level(F.col("z")) > ABSOLUTE_GATE)
    gate = z.groupBy(key).agg((level(F.avg("z")) + RELATIVE_GATE).alias("gate"))
    loud = z.join(gate, key).where(level(F.col("z")) > F.col("gate")).groupBy(key).agg(level(F.avg("z")).alias("lufs"))
    return df.select(key).join(loud, key, "left").select(key, F.coalesce("lufs", F.lit(ABSOLUTE_GATE)).alias("lufs"))


def _ddl(df: DataFrame, *cols: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*cols).schema.fields)


def spectrum(df: DataFrame, key: str, x: str, least: int = 1) -> DataFrame:
    """Power of the rFFT of whole signals: key, n (length of the transform: that of the signal, or
    `least` with zeros behind), bin, power. A signal at a time is in memory; null and empty ones give no rows."""
    def run(batches):
        for b in batches:
            for k, v in zip(b[key], b[x]):
                if v is not None and len(v):
                    n = max(least, len(v))
                    p = np.abs(np.fft.rfft(np.asarray(v, "float64"), n)) ** 2
                    yield pd.DataFrame({key: [k] * len(p), "n": n, "bin": np.arange(len(p)), "power": p})

    return df.select(key, x).mapInPandas(run, f"{_ddl(df, key)}, n int, bin int, power double")


def band_energies(df: DataFrame, x: str, sr: int, bands: dict[str, tuple[float, float, bool]], least: int = 2048) -> DataFrame:
    """Adds the energy of whole signals in bands `{name: (low, high, low included)}` in Hz, high
    included; no spectrum leaves the worker. Null for null signals."""
    def one(v):
        if v is None:
            return None
        n = max(least, len(v))
        p, f = np.abs(np.fft.rfft(np.asarray(v, "float64"), n)) ** 2, np.fft.rfftfreq(n, 1.0 / sr)
        return {name: float(p[((f >= lo) if closed else (f > lo)) & (f <= hi)].sum()) for name, (lo, hi, closed) in bands.items()}

    kind = "struct<" + ", ".join(f"{name}: double" for name in bands) + ">"
    udf = F.pandas_udf(lambda s: pd.DataFrame([one(v) or dict.fromkeys(bands) for v in s], columns=list(bands), dtype="float64"), kind)
    return df.withColumn("_e", udf(F.col(x))).select(*df.columns, *[F.when(F.col(x).isNotNull(), F.col(f"_e.{name}")).alias(name) for name in bands])


def band_ratio_db(df: DataFrame, x: str, sr: int, high: tuple[float, float] = (1000, 3000), low: tuple[float, float] = (100, 500), least: int = 2048) -> DataFrame:
    """Adds `ratio_db`, the energy of one band over another, of whole signals."""
    e = band_energies(df, x, sr, {"_high": (*high, True), "_low": (*low, True)}, least)
    return e.withColumn("ratio_db", 10 * F.log10((F.col("_high") + 1e-12) / (F.col("_low") + 1e-12))).drop("_high", "_low")


def high_share_db(df: DataFrame, x: str, sr: int, edge: float = 4000, low: float = 300, least: int = 1) -> DataFrame:
    """Adds `high_db`, the energy above `edge` over that from `low` up to it, of whole signals."""
    e = band_energies(df, x, sr, {"_high": (edge, float("inf"), False), "_low": (low, edge, False)}, least)
    return e.withColumn("high_db", 10 * F.log10(F.col("_high") / (F.col("_low") + 1e-12))).drop("_high", "_low")


def frame_spectrum(df: DataFrame, key: str, x: str, n: int, hop: int, window: bool = True) -> DataFrame:
    """Sums over the overlapping frames of whole signals: key, bin, power, frames. Sums of signals,
    of parts of signals or of groups add up. A signal shorter than a frame is one frame with zeros
    behind; what is behind the last full frame is left out."""
    def run(batches):
        w = np.hanning(n + 1)[:-1] if window else np.ones(n)
        for b in batches:
            for k, v in zip(b[key], b[x]):
                if v is None or not len(v):
                    continue
                v = np.asarray(v, "float64")
                v = np.pad(v, (0, max(0, n - len(v))))
                starts = np.arange(0, len(v) - n + 1, hop)
                p = np.zeros(n // 2 + 1)
                for lo in range(0, len(starts), 1024):
                    p += (np.abs(np.fft.rfft(v[starts[lo:lo + 1024, None] + np.arange(n)] * w, axis=1)) ** 2).sum(axis=0)
                yield pd.DataFrame({key: [k] * len(p), "bin": np.arange(len(p)), "power": p, "frames": len(starts)})

    return df.select(key, x).mapInPandas(run, f"{_ddl(df, key)}, bin int, power double, frames bigint")


def lta_spectrum(frames: DataFrame, by: list[str]) -> DataFrame:
    """Long-term average: mean power of all frames per group and bin, from `frame_spectrum`."""
    return frames.groupBy(*by, "bin").agg((F.sum("power") / F.sum("frames")).alias("power"))


def harvest(df: DataFrame, key: str, x: str, n: int, frame: int, least_db: float = -45.0, share: float = 0.3) -> DataFrame:
    """Full segments of n samples (key, segment, samples, kind): speech where more than `share` of the frames are above the level."""
    count = F.floor(F.size(x) / n).cast("int")
    parts = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(F.col(x), i * n + 1, F.lit(n)))).otherwise(F.array().cast("array<array<double>>"))
    levels = frame_db(F.col("samples"), frame)
    active = F.size(F.filter(levels, lambda v: v > least_db)) / F.size(levels)
    return df.select(key, F.posexplode(parts).alias("segment", "samples")).withColumn("kind", F.when(active > share, "speech").otherwise("noise"))


def window_long(df: DataFrame, key: str, n: int, cut: str, least_last: float = 0.35) -> DataFrame:
    """Windows (key, start, stop) of at most n samples of each recording (key, `size`, `cut`: sorted
    array of samples at which it may be cut). A window ends at the last cut within its last third,
    else at n; a thin tail is dropped. Each recording is one row, so no group is gathered."""
    def run(batches):
        for b in batches:
            out = []
            for k, size, cuts in zip(b[key], b["size"], b[cut]):
                start, cuts = 0, np.asarray(cuts if cuts is not None else [], "int64")
                while start < size:
                    stop = min(size, start + n)
                    if stop < size:
                        fit = cuts[(cuts > start + int(0.66 * n)) & (cuts <= stop)]
                        stop = int(fit[-1]) if len(fit) else stop
                    if start and stop - start < least_last * n:
                        break
                    out.append((k, start, stop))
                    start = stop
            yield pd.DataFrame(out, columns=[key, "start", "stop"])

    return df.select(key, "size", cut).mapInPandas(run, f"{df.select(key).schema.simpleString()[7:-1].replace(':', ' ')}, start bigint, stop bigint")


def score_windows(df: DataFrame, key: str, x: str, n: int, scorer: Callable[[np.ndarray], np.ndarray], classes: int, most: int = 3) -> DataFrame:
    """Largest score of each class over at most three evenly spaced windows: key, scores. The scorer
    takes a matrix of windows, one batch at a time."""
    def run(batches):
        for b in batches:
            rows, owner = [], []
            for i, v in enumerate(b[x]):
                v = np.asarray(v, "float64")
                starts = np.unique(np.linspace(0, max(0, len(v) - n), most).astype(int))
                rows += [np.pad(v[s:s + n], (0, max(0, n - len(v)))) for s in starts]
                owner += [i] * len(starts)
            best = np.full((len(b), classes), -np.inf)
            if rows:
                np.maximum.at(best, owner, scorer(np.stack(rows)))
            yield pd.DataFrame({key: b[key], "scores": list(best)})

    return df.select(key, x).mapInPandas(run, f"{df.select(key).schema.simpleString()[7:-1].replace(':', ' ')}, scores array<double>")


def periodic_frames(x: np.ndarray, sr: int, frame_s: float = 0.03, f0: tuple[float, float] = (70, 400), least: float = 0.5) -> np.ndarray:
    """Frames whose normalised autocorrelation has a peak above `least` at a lag of the voice band."""
    n = int(frame_s * sr)
    f = np.asarray(x, "float64")[:len(x) // n * n].reshape(-1, n)
    if not len(f):
        return np.zeros(0, bool)
    f = f - f.mean(axis=1, keepdims=True)
    r = np.fft.irfft(np.abs(np.fft.rfft(f, 2 * n, axis=1)) ** 2, axis=1)[:, :n]
    peak = r[:, int(sr / f0[1]):int(sr / f0[0])].max(axis=1)
    return (r[:, 0] >= 1e-8) & (peak > least * r[:, 0])


def active_frames(x: np.ndarray, sr: int, frame_s: float = 0.03, memory_s: float = 1.5, rise_db: float = 6.0, hold: int = 3, hold_db: float = 3.0,
                  band: tuple[float, float] = (200, 4000), share: float = 0.25) -> np.ndarray:
    """Frames whose level in the speech band is above a tracked noise floor, the least smoothed
    level within `memory_s`, and that have at least `share` of their energy in the band; behind
    them up to `hold` frames that are still above it by `hold_db`. What sounds steadily is floor,
    and what rumbles is out of the band."""
    n = int(frame_s * sr)
    f = np.asarray(x, "float64")[:len(x) // n * n].reshape(-1, n)
    if not len(f):
        return np.zeros(0, bool)
    p, at = np.abs(np.fft.rfft(f * np.hanning(n), axis=1)) ** 2, np.fft.rfftfreq(n, 1 / sr)
    within = p[:, (at >= band[0]) & (at <= band[1])].sum(axis=1)
    power = within / (n * n / 4) + 1e-10
    level = 10 * np.log10(power)
    back = max(1, int(memory_s / frame_s))
    smooth = 10 * np.log10(np.convolve(np.pad(power, 1, mode="edge"), np.ones(3) / 3, "valid"))
    # The floor looks ahead as far as it looks back: a clip may begin with speech.
    pad = np.pad(smooth, (back, back), mode="edge")
    floor = np.lib.stride_tricks.sliding_window_view(pad, 2 * back + 1).min(axis=1)
    on = (level > floor + rise_db) & (within >= share * p.sum(axis=1))
    last = np.maximum.accumulate(np.where(on, np.arange(len(on)), -hold - 1))
    return on | ((np.arange(len(on)) - last <= hold) & (level > floor + hold_db))


def voiced_share(x: np.ndarray, sr: int) -> tuple[int, float]:
    """Number and share of frames that are active and periodic at once."""
    both = periodic_frames(x, sr) & active_frames(x, sr)
    return int(both.sum()), float(both.mean()) if len(both) else 0.0


def voice_screen(df: DataFrame, x: str, sr: int, frames: int = 8, share: float = 0.1) -> DataFrame:
    """Adds `has_voice`: at least `frames` frames and the share `share` of them are at once periodic
    in the voice band (70 to 400 Hz) and above the tracked noise floor. False for null and short signals."""
    def test(v: np.ndarray) -> float:
        n, part = voiced_share(v, sr)
        return float(n >= frames and part >= share)
    return per_signal(df, x, test, "_v").withColumn("has_voice", F.coalesce(F.col("_v") == 1, F.lit(False))).drop("_v")


@functools.lru_cache(maxsize=16)
def filter_bank(up: int, down: int, zeros: int = 24, beta: float = 9.0) -> np.ndarray:
    """Low pass at the lower of both Nyquist frequencies as a windowed sinc, a row per phase."""
    wide = max(up, down)
    half = zeros * wide
    k = np.arange(-half, half + 1)
    h = np.sinc(0.94 * k / wide) * 0.94 / wide * np.kaiser(2 * half + 1, beta)
    h *= up / h.sum()
    taps = -(-len(h) // up)
    return np.pad(h, (0, taps * up - len(h))).reshape(taps, up).T.copy()


def resample(x: np.ndarray, rate: int, sr: int, block: int = 8192) -> np.ndarray:
    """Polyphase resampling at the reduced ratio of both rates. A tone beyond the new Nyquist
    frequency is down by 60 dB at 1.1 times of it."""
    g = math.gcd(int(rate), int(sr))
    up, down = int(sr) // g, int(rate) // g
    if up == down or not len(x):
        return np.asarray(x, "float64")
    bank = filter_bank(up, down)
    taps = bank.shape[1]
    centre = 24 * max(up, down)
    out = np.empty(-(-len(x) * up // down))
    pad = np.pad(np.asarray(x, "float64"), (taps, taps + centre // up + 1))
    for lo in range(0, len(out), block):
        m = np.arange(lo, min(len(out), lo + block)) * down + centre
        rows = pad[(m // up + taps)[:, None] - np.arange(taps)]
        out[lo:lo + block] = np.einsum("ij,ij->i", rows, bank[m % up])
    return out


def stoi(clean: np.ndarray, other: np.ndarray, sr: int) -> float | None:
    """Short-time objective intelligibility as published: 10 kHz, silent frames out, 15 third-octave
    bands from 150 Hz, segments of 30 frames, clipping at -15 dB; null for less than one segment."""
    n, hop, size, seg, clip = 256, 128, 512, 30, 10 ** (15 / 20)
    if sr != 10_000:
        clean, other = resample(clean, sr, 10_000), resample(other, sr, 10_000)
    if len(clean) < n:
        return None
    w = np.hanning(n + 2)[1:-1]
    cut = np.arange(0, len(clean) - n + 1, hop)[:, None] + np.arange(n)
    x, y = clean[cut] * w, other[cut] * w
    level = 20 * np.log10(np.linalg.norm(x, axis=1) + 1e-12)
    x, y = x[level > level.max() - 40], y[level > level.max() - 40]
    if len(x) < seg:
        return None
    freq, centre = np.arange(size // 2 + 1) * 10_000 / size, 150 * 2 ** (np.arange(15) / 3)
    bands = (freq[None, :] >= centre[:, None] * 2 ** (-1 / 6)) & (freq[None, :] < centre[:, None] * 2 ** (1 / 6))
    tob = lambda f: np.sqrt(np.abs(np.fft.rfft(f, size, axis=1)) ** 2 @ bands.T)
    part = np.arange(len(x) - seg + 1)[:, None] + np.arange(seg)
    a, b = (tob(f)[part].transpose(0, 2, 1) for f in (x, y))  # segments, bands, frames
    b = np.minimum(b * np.linalg.norm(a, axis=2, keepdims=True) / (np.linalg.norm(b, axis=2, keepdims=True) + 1e-12), a * (1 + clip))
    a, b = (v - v.mean(axis=2, keepdims=True) for v in (a, b))
    r = (a * b).sum(axis=2) / (np.linalg.norm(a, axis=2) * np.linalg.norm(b, axis=2) + 1e-12)
    return float(r.mean())


def with_stoi(df: DataFrame, clean: str, other: str, sr: int) -> DataFrame:
    """Adds `stoi` of each pair of signals; null where either is null or they are too short."""
    one = F.pandas_udf(lambda a, b: pd.Series([None if x is None or y is None else stoi(np.asarray(x, "float64"), np.asarray(y, "float64"), sr) for x, y in zip(a, b)], dtype="float64"), "double")
    return df.withColumn("stoi", one(F.col(clean), F.col(other)))
