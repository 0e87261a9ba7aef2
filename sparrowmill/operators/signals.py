"""Signals held as arrays: levels, frames and metrics with higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v)


def energy(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))


def rms(x: Column) -> Column:
    return F.sqrt(energy(x) / F.size(x))


def peak(x: Column) -> Column:
    return F.array_max(F.transform(x, lambda v: F.abs(v.cast("double"))))


def frames(x: Column, n: int) -> Column:
    """Full frames only."""
    count = F.floor(F.size(x) / n).cast("int")
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(x, i * n + 1, F.lit(n)))).otherwise(F.array())


def active_rms(x: Column, n: int) -> Column:
    """Mean of the loudest half of the frame levels."""
    levels = F.sort_array(F.transform(frames(x, n), rms), asc=False)
    half = F.greatest(F.lit(1), F.floor(F.size(levels) / 2).cast("int"))
    return total(F.slice(levels, F.lit(1), half)) / half


def crest(x: Column) -> Column:
    return peak(x) / rms(x)


def clip_frac(x: Column, limit: float = 0.999) -> Column:
    """Share of samples beyond the limit."""
    return F.size(F.filter(x, lambda v: F.abs(v) > limit)) / F.nullif(F.size(x), F.lit(0))


def dbfs(level: Column, floor: float = 1e-12) -> Column:
    return 20 * F.log10(F.greatest(level, F.lit(floor)))


def centred(x: Column) -> Column:
    """Samples less their mean, taken once."""
    def finish(s):
        return F.transform(F.array(s / F.size(x)), lambda m: F.transform(x, lambda v: v.cast("double") - m))[0]
    return F.aggregate(x, F.lit(0.0), lambda s, v: s + v.cast("double"), finish)


def si_snr(est: Column, ref: Column, eps: float = 1e-12, mask: Column | None = None) -> Column:
    """Means are removed first, so a large offset cancels nothing; then three sums in one pass.
    With `mask` (array<boolean>) only valid samples count."""
    if mask is not None:
        est, ref = (F.filter(x, lambda v, i: F.element_at(mask, i + 1)) for x in (est, ref))
    pairs = F.zip_with(centred(est), centred(ref), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("aa", "bb", "ab")])
    add = lambda s, p: F.struct((s["aa"] + p["a"] * p["a"]).alias("aa"), (s["bb"] + p["b"] * p["b"]).alias("bb"), (s["ab"] + p["a"] * p["b"]).alias("ab"))

    def finish(s):
        k = s["ab"] / (s["bb"] + eps)
        return 10 * F.log10((k * k * s["bb"] + eps) / (F.greatest(F.lit(0.0), s["aa"] - 2 * k * s["ab"] + k * k * s["bb"]) + eps))

    return F.aggregate(pairs, zero, add, finish)


def snr(est: Column, ref: Column, eps: float = 1e-12) -> Column:
    noise = F.zip_with(est, ref, lambda a, b: a.cast("double") - b.cast("double"))
    return 10 * F.log10((energy(ref) + eps) / (energy(noise) + eps))


def frame_levels(x: Column, n: int) -> Column:
    """RMS of each full frame."""
    return F.transform(frames(x, n), rms)


def frame_db(x: Column, n: int) -> Column:
    return F.transform(frame_levels(x, n), lambda v: dbfs(v))


def at_quantile(values: Column, p: float) -> Column:
    """Linear interpolation in a sorted array."""
    v, pos = F.sort_array(values), (F.size(values) - 1) * F.lit(float(p))
    lo, hi = F.floor(pos).cast("int"), F.ceil(pos).cast("int")
    return F.when(F.size(values) > 0, F.element_at(v, lo + 1) + (pos - lo) * (F.element_at(v, hi + 1) - F.element_at(v, lo + 1)))


def noise_floor_db(x: Column, n: int) -> Column:
    return at_quantile(frame_db(x, n), 0.1)


def crest_db(x: Column) -> Column:
    return 20 * F.log10(crest(x))


def event_crest_db(x: Column, before: int, after: int) -> Column:
    """Crest in a fixed window about the first sample of largest magnitude."""
    mags = F.transform(x, lambda v: F.abs(v.cast("double")))
    at = F.array_position(mags, F.array_max(mags)).cast("int")
    start = F.greatest(F.lit(1), at - before)
    return crest_db(F.slice(x, start, at + after - start + 1))


def _ends(keep: Column) -> tuple[Column, Column]:
    """First and last position (from 1) of true in an array; 0 if there is none."""
    first = F.array_position(keep, True).cast("int")
    last = F.when(first > 0, F.size(keep) + 1 - F.array_position(F.reverse(keep), True).cast("int")).otherwise(0)
    return first, last


def trim_silence(x: Column, floor: float = 0.0) -> Column:
    """Without samples of magnitude up to `floor` at either end."""
    first, last = _ends(F.transform(x, lambda v: F.abs(v) > floor))
    return F.when(first > 0, F.slice(x, F.greatest(first, F.lit(1)), F.greatest(last - first + 1, F.lit(0)))).otherwise(F.slice(x, 1, 0))


def trim_edges(x: Column, n: int, keep: int, below_db: float = 40.0) -> Column:
    """Edge frames below the active level less `below_db` go, but for `keep` samples."""
    limit = active_rms(x, n) * 10 ** (-below_db / 20)
    first, last = _ends(F.transform(frame_levels(x, n), lambda v: v >= limit))
    start = F.greatest(F.lit(1), (first - 1) * n + 1 - keep)
    return F.when(first > 0, F.slice(x, start, F.least(F.size(x), last * n + keep) - start + 1)).otherwise(x)


def fit(x: Column, n: int, mode: str = "pad", at: Column | int = 0) -> Column:
    """Exactly n samples: `pad` crops from `at` or fills with zeros behind, `tile` repeats the
    signal and crops from `at`, `place` puts it at `at` into silence."""
    at = F.lit(at) if isinstance(at, int) else at
    kind = F.lit(0.0)
    if mode == "pad":
        part = F.slice(x, at + 1, F.lit(n))
        return F.concat(part, F.array_repeat(kind, F.greatest(F.lit(0), n - F.size(part))))
    if mode == "tile":
        times = F.ceil((at + n) / F.size(x)).cast("int")
        return F.slice(F.flatten(F.array_repeat(x, times)), at + 1, F.lit(n))
    if mode == "place":
        return F.slice(F.concat(F.array_repeat(kind, at), x, F.array_repeat(kind, n)), F.lit(1), F.lit(n))
    raise ValueError(mode)


def fade(x: Column, n: int) -> Column:
    """Linear ramps over the first and last n samples."""
    size = F.size(x)
    return F.transform(x, lambda v, i: v * F.least(F.lit(1.0), i / n, (size - 1 - i) / n))


def speech_fraction(x: Column, n: int, below_db: float = 25.0) -> Column:
    """Share of frames above the active level less `below_db`."""
    limit, levels = active_rms(x, n) * 10 ** (-below_db / 20), frame_levels(x, n)
    return F.size(F.filter(levels, lambda v: v > limit)) / F.nullif(F.size(levels), F.lit(0))


def audible_span(x: Column, start: Column | int = 0, below_db: float = 40.0) -> Column:
    """First and last sample (from `start`) within `below_db` of the event's own peak."""
    limit = peak(x) * 10 ** (-below_db / 20)
    first, last = _ends(F.transform(x, lambda v: F.abs(v.cast("double")) >= limit))
    start = F.lit(start) if isinstance(start, int) else start
    return F.struct((start + first - 1).alias("start"), (start + last - 1).alias("stop"))


def audible_fraction(x: Column, rest: Column, n: int, within_db: float = 10.0, active_db: float = 40.0) -> Column:
    """Share of the active frames of x that are within `within_db` of the rest's frames."""
    a, b = frame_levels(x, n), frame_levels(rest, n)
    limit = F.array_max(a) * 10 ** (-active_db / 20)
    active = F.filter(F.zip_with(a, b, lambda p, q: F.struct(p.alias("p"), q.alias("q"))), lambda s: s["p"] >= limit)
    return F.size(F.filter(active, lambda s: s["p"] >= s["q"] * 10 ** (-within_db / 20))) / F.nullif(F.size(active), F.lit(0))


def local_snr_db(speech: Column, noise: Column, a: int, b: int, eps: float = 1e-12) -> Column:
    """SNR of samples a to b - 1."""
    part = lambda c: energy(F.slice(c, a + 1, b - a))
    return 10 * F.log10((part(speech) + eps) / (part(noise) + eps))


def mix_at_snr(speech: Column, noise: Column, snr_db: Column | float, eps: float = 1e-12) -> Column:
    """Speech plus noise scaled to the SNR by RMS."""
    snr_db = F.lit(float(snr_db)) if isinstance(snr_db, (int, float)) else snr_db
    gain = rms(speech) / (rms(noise) + eps) * F.pow(F.lit(10.0), -snr_db / 20)
    scaled = F.transform(F.array(gain), lambda g: F.zip_with(speech, noise, lambda s, v: s + g * v))
    return scaled[0]


def blind_snr_db(x: Column, n: int, loud: float = 0.3, quiet: float = 0.2) -> Column:
    """Mean energy of the loudest share of frames over that of the quietest, without a reference."""
    e = F.sort_array(F.transform(frame_levels(x, n), lambda v: v * v))
    size = F.size(e)
    hi, lo = F.greatest(F.lit(1), F.floor(size * loud).cast("int")), F.greatest(F.lit(1), F.floor(size * quiet).cast("int"))
    return 10 * F.log10((total(F.slice(e, size - hi + 1, hi)) / hi + 1e-12) / (total(F.slice(e, F.lit(1), lo)) / lo + 1e-12))


def active_crop_at(x: Column, starts: list[int], n: int, level: float, share: float = 0.25) -> Column:
    """First of the candidate starts whose crop has the share of active samples, else the most active one."""
    parts = F.array(*[F.struct((F.size(F.filter(F.slice(x, s + 1, n), lambda v: F.abs(v) > level)) / n).alias("share"), F.lit(-k).alias("k"), F.lit(s).alias("start")) for k, s in enumerate(starts)])
    good = F.filter(parts, lambda p: p["share"] >= share)
    return F.when(F.size(good) > 0, good[0]["start"]).otherwise(F.array_max(parts)["start"])


def top_entries(scores: Column, names: list[str], k: int) -> Column:
    """Names of the k largest scores, ties by the earlier name."""
    ranked = F.array_sort(F.transform(scores, lambda v, i: F.struct((-v).alias("s"), i.alias("i"))))
    return F.transform(F.slice(ranked, 1, k), lambda s: F.element_at(F.array(*map(F.lit, names)), s["i"] + 1))
