"""Scores and score tables: frames, words, positions, breakdowns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import signals
from .aggs import select_ranks


def ratio(num: Column, den: Column) -> Column:
    """Null where undefined."""
    return num / F.nullif(den, F.lit(0))


def frame_pr(df: DataFrame, keys: list[str], pred: Column, truth: Column) -> DataFrame:
    """Precision, recall and share of false alarms among frames without an event."""
    n = lambda p: F.count(F.when(p, 1))
    t = df.groupBy(*keys).agg(n(pred & truth).alias("tp"), n(pred).alias("p"), n(truth).alias("t"), n(pred & ~truth).alias("fp"), n(~truth).alias("f"))
    return t.select(*keys, ratio(F.col("tp"), F.col("p")).alias("precision"), ratio(F.col("tp"), F.col("t")).alias("recall"), ratio(F.col("fp"), F.col("f")).alias("false_alarm"))


def blackout(df: DataFrame, keys: list[str], in_event: Column, speech: Column, out_db: Column, target_db: Column, below: float = 20.0) -> DataFrame:
    """Share of speech frames in event windows whose output is more than `below` dB under the target."""
    w = F.coalesce(in_event & speech, F.lit(False))
    return df.groupBy(*keys).agg(F.avg(F.when(w, (out_db < target_db - below).cast("double"))).alias("blackout"))


def error_split(df: DataFrame, keys: list[str], speech: Column, error: Column, eps: float = 1e-12) -> DataFrame:
    """Mean squared error in silent frames (leak) and in speech frames, in dB."""
    db = lambda p: 10 * F.log10(F.avg(F.when(p, error * error)) + eps)
    return df.groupBy(*keys).agg(db(~speech).alias("leak_db"), db(speech).alias("error_db"))


def improvement(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Adds out - in for each name."""
    return df.withColumns({name: F.col(out) - F.col(in_) for name, (out, in_) in pairs.items()})


def keyword_recall(ref: Column, hyp: Column, vocab: list[str]) -> Column:
    """Share of the reference's keywords (each occurrence) that the hypothesis holds; null without any."""
    want = F.filter(ref, lambda t: t.isin(vocab))
    return ratio(F.size(F.filter(want, lambda t: F.array_contains(hyp, t))), F.size(want))


def word_errors(ref: Column, hyp: Column) -> Column:
    """Edit distance over tokens: each distinct token of a pair becomes one character, then Levenshtein."""
    words = F.array_distinct(F.concat(ref, hyp))
    # Characters from U+4E00 on; a pair holds far fewer distinct tokens than the plane has left below the surrogates.
    char = lambda t: F.decode(F.unhex(F.lpad(F.hex(F.array_position(words, t) + 0x4E00), 4, "0")), "UTF-16BE")
    text = lambda a: F.array_join(F.transform(a, char), "")
    return F.levenshtein(text(ref), text(hyp))


def ref_error(truth: Column, found: Column) -> Column:
    """Edit distance of the closest candidate over the length of the truth; 1 without candidates."""
    near = F.array_min(F.transform(found, lambda f: F.levenshtein(f, truth)))
    return F.coalesce(near / F.length(truth), F.lit(1.0))


def invented_rate(df: DataFrame, ref: Column, hyp: Column) -> DataFrame:
    """Share of rows with an empty reference whose hypothesis has words."""
    return df.where(F.size(ref) == 0).agg(F.avg((F.size(hyp) > 0).cast("double")).alias("invented_rate"))


def position_error_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular distance in metres."""
    x = F.radians(lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2))
    return 6371000.0 * F.sqrt(x * x + F.pow(F.radians(lat2 - lat1), 2))


def results_table(df: DataFrame, cls: str, metrics: list[str], n_events: str, event_snr: str) -> DataFrame:
    """Means of the metrics: all, per class, with events, and with event SNR above 6 and below 0;
    empty subsets have no row. One pass over the rows: each row goes to the subsets it is in."""
    has = F.coalesce(F.col(n_events) > 0, F.lit(False))
    names = F.array_compact(F.array(F.lit("all"), F.concat(F.lit("class "), F.col(cls)), F.when(has, "events"), F.when(has & (F.col(event_snr) > 6), "event snr > 6"), F.when(has & (F.col(event_snr) < 0), "event snr < 0")))
    return df.select(F.explode(names).alias("subset"), *metrics).groupBy("subset").agg(F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(m) for m in metrics])


def pool_summary(df: DataFrame, pool: str, kept: Column, over: dict[str, Column]) -> DataFrame:
    return df.groupBy(pool).agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce(kept, F.lit(False)).cast("double")).alias("kept"), *[F.avg(F.coalesce(p, F.lit(False)).cast("double")).alias(n) for n, p in over.items()])


def nested_min(events: Column, field: str, where: Callable[[Column], Column] = lambda e: F.lit(True)) -> Column:
    """Least value of a field over the array's entries that pass; null if none does."""
    return F.array_min(F.transform(F.filter(events, where), lambda e: e[field]))


def answer_accuracy(df: DataFrame, question: str, source: str, right: Column) -> DataFrame:
    """Accuracy per question and per question@source."""
    t = df.withColumn("_r", right.cast("double"))
    by = t.groupingSets([[F.col(question)], [F.col(question), F.col(source)]], F.col(question), F.col(source)).agg(F.avg("_r").alias("accuracy"), F.grouping(source).alias("_g"))
    return by.select(F.when(F.col("_g") == 1, F.col(question)).otherwise(F.concat(question, F.lit("@"), source)).alias("name"), "accuracy")


def run_summary(df: DataFrame, truth: Column, error_m: Column, latency: str, hop: str) -> DataFrame:
    """Rows, rows with a true position, hits within 1 km, and exact medians of two latencies, by
    counted selection of both at once."""
    n = lambda p: F.count(F.when(p, 1))
    mid = select_ranks(df, [latency, hop], [0.5])
    known = lambda c, name: F.lit(mid[c][0]).cast("double").alias(name)
    return df.agg(F.count(F.lit(1)).alias("events"), n(truth).alias("grid_reports"), n(truth & (error_m < 1000)).alias("within_1km")).select(
        "*", known(latency, "median_latency"), known(hop, "median_hop_p95"))


def composition(df: DataFrame, by: str, seconds: str, flags: dict[str, Column]) -> DataFrame:
    """Rows, hours, share of the whole and shares of the flags per value, in one aggregate pass."""
    t = df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), (F.sum(seconds) / 3600.0).alias("hours"), *[F.avg(F.coalesce(p, F.lit(False)).cast("double")).alias(n) for n, p in flags.items()])
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    return t.crossJoin(F.broadcast(total)).withColumn("share", F.col("n") / F.col("_t")).drop("_t")  # one row


def clip_labels(events: Column, label: str, masked: Column | str) -> Column:
    """Struct: sorted distinct labels of the entries that are not masked, their number, and the number masked."""
    heard = F.filter(events, lambda e: ~F.coalesce(e[masked], F.lit(False)))
    labels = F.array_sort(F.array_distinct(F.transform(heard, lambda e: e[label])))
    return F.struct(labels.alias("labels"), F.size(labels).alias("n_labels"), (F.size(events) - F.size(heard)).alias("n_masked"))


def evaluate_set(est: DataFrame, ref: DataFrame, key: str, x: str, enhance: Callable[[Column], Column] | None = None) -> DataFrame:
    """Joins outputs to references by id, applies an optional function of the array, and adds the metric columns."""
    both = est.select(key, F.col(x).alias("_e")).join(ref.select(key, F.col(x).alias("_r")), key)
    out = enhance(F.col("_e")) if enhance else F.col("_e")
    return both.withColumn("_o", out).select(key, signals.si_snr(F.col("_o"), F.col("_r")).alias("si_snr"), signals.snr(F.col("_o"), F.col("_r")).alias("snr"))


def side_by_side(a: DataFrame, b: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """Means of each column in two versions of the same rows, and the difference."""
    both = a.select(key, *[F.col(c).alias(f"a_{c}") for c in cols]).join(b.select(key, *[F.col(c).alias(f"b_{c}") for c in cols]), key)
    one = both.agg(*[F.avg(f"{s}_{c}").alias(f"{s}_{c}") for c in cols for s in "ab"])
    rows = F.array(*[F.struct(F.lit(c).alias("stat"), F.col(f"a_{c}").alias("a"), F.col(f"b_{c}").alias("b"), (F.col(f"b_{c}") - F.col(f"a_{c}")).alias("delta")) for c in cols])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def metric_selftest(spark) -> DataFrame:
    """Known answers: identical signals beyond 60 dB, noise at +10 dB within 0.5 dB of it."""
    i = F.sequence(F.lit(0), F.lit(15999))
    d = spark.range(1).select(F.transform(i, lambda k: F.sin(k * 0.2)).alias("s"), F.transform(i, lambda k: F.cos(k * 1.7)).alias("n"))
    noisy = signals.mix_at_snr(F.col("s"), F.col("n"), 10.0)
    return d.select(signals.si_snr(F.col("s"), F.col("s")).alias("same"), signals.snr(noisy, F.col("s")).alias("ten")).select((F.col("same") > 60).alias("identical_ok"), (F.abs(F.col("ten") - 10) < 0.5).alias("noise_ok"))
