"""Audits: one row (name, status, n_bad) each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggs import select_ranks


def verdict(bad: DataFrame, name: str, level: str = "FAIL") -> DataFrame:
    n = bad.agg(F.count(F.lit(1)).alias("n_bad"))
    return n.select(F.lit(name).alias("name"), F.when(F.col("n_bad") == 0, "PASS").otherwise(level).alias("status"), "n_bad")


def check_groups(df: DataFrame, group: str, split: Column, name: str) -> DataFrame:
    """Groups found in more than one split; two partial aggregates, no self join."""
    g = df.where(F.col(group).isNotNull()).groupBy(group).agg(F.min(split).alias("a"), F.max(split).alias("b"))
    return verdict(g.where("a <> b"), name)


def check_windows(df: DataFrame, t: Column, lo: Column, hi: Column, name: str, eps: float = 1e-6) -> DataFrame:
    return verdict(df.where((t < lo - eps) | (t > hi + eps)), name)


def check_flagged(used: DataFrame, flagged: DataFrame, key: str, name: str) -> DataFrame:
    return verdict(used.join(flagged.select(key), key, "left_semi"), name)


def check_duplicates(df: DataFrame, content: str, name: str) -> DataFrame:
    g = df.groupBy(F.md5(F.encode(content, "UTF-8")).alias("h")).agg(F.count(F.lit(1)).alias("n"))
    return verdict(g.where("n > 1"), name)


def content_overlap(df: DataFrame, text: str, split: Column) -> DataFrame:
    """Share of distinct test texts that are also in train (report only)."""
    g = df.where(split.isin("train", "test")).groupBy(F.md5(F.encode(text, "UTF-8")).alias("h")).agg(F.max((split == "test").cast("int")).alias("te"), F.max((split == "train").cast("int")).alias("tr"))
    return g.where("te = 1").agg(F.count(F.lit(1)).alias("n_test"), F.coalesce(F.sum("tr"), F.lit(0)).alias("n_shared"))


def check_rates(df: DataFrame, pred: Column, kind: str, lo: float, hi: float, kinds: int, name: str) -> DataFrame:
    a = df.agg(F.avg(pred.cast("double")).alias("rate"), F.countDistinct(kind).alias("k"))
    return verdict(a.where(~F.col("rate").between(lo, hi) | (F.col("k") < kinds)), name)


def check_reuse(df: DataFrame, item: str, part: str, split: Column, name: str) -> DataFrame:
    """Two rows: parts used by more than one item, and parts used in more than one split."""
    g = df.groupBy(part).agg(F.min(item).alias("i0"), F.max(item).alias("i1"), F.min(split).alias("s0"), F.max(split).alias("s1"))
    return verdict(g.where("i0 <> i1"), f"{name} reused", "WARN").unionByName(verdict(g.where("s0 <> s1"), f"{name} across splits"))


def check_agree(a: DataFrame, b: DataFrame, key: str, split: str, name: str) -> DataFrame:
    """Keys that both tables hold must have the same split; keys of one table alone pass."""
    both = a.select(key, F.col(split).alias("_a")).join(b.select(key, F.col(split).alias("_b")), key)
    return verdict(both.where(~F.col("_a").eqNullSafe(F.col("_b"))), name)


def check_files(plan: DataFrame, path: str, split: str, except_: DataFrame, name: str) -> DataFrame:
    """Files used in two splits, but for those that are split by time."""
    g = plan.groupBy(path).agg(F.min(split).alias("a"), F.max(split).alias("b")).where("a <> b")
    return verdict(g.join(except_.select(path).distinct(), path, "left_anti"), name)


def check_recordings(plan: DataFrame, pools: DataFrame, path: str, split: str, group: list[str], name: str) -> DataFrame:
    """Recording groups in two splits; the plan is reduced to distinct paths before the join."""
    used = plan.groupBy(path).agg(F.min(split).alias("a"), F.max(split).alias("b"))
    g = used.join(pools.select(path, *group).distinct(), path).groupBy(*group).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    return verdict(g.where("a <> b"), name)


def check_seeds(df: DataFrame, seed: str, bits: int, name: str) -> DataFrame:
    """Repeated seeds against the number that chance allows, n^2 / 2^(bits + 1): beyond
    three times that and three in all is a failure. Seeds are grouped, never sorted."""
    g = df.groupBy(seed).agg(F.count(F.lit(1)).alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_repeated"))
    expected = F.col("n").cast("double") * F.col("n") / 2 / 2.0**bits
    return g.select(F.lit(name).alias("name"), F.when(F.col("n_repeated") <= F.greatest(F.lit(3.0), 3 * expected), "PASS").otherwise("FAIL").alias("status"), F.col("n_repeated").alias("n_bad"), expected.alias("expected"))


def check_coverage(wanted: DataFrame, have: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Configured cells without a row, as a warning."""
    return verdict(wanted.join(have.select(*keys).distinct(), keys, "left_anti"), name, "WARN")


def check_duplicates_by_split(df: DataFrame, content: str, split: Column, name: str) -> DataFrame:
    """Two rows: identical content within a split, and across splits."""
    h = df.select(F.md5(F.encode(content, "UTF-8")).alias("h"), split.alias("s")).groupBy("h", "s").agg(F.count(F.lit(1)).alias("n"))
    g = h.groupBy("h").agg(F.max("n").alias("most"), F.count(F.lit(1)).alias("splits"))
    return verdict(g.where("most > 1"), f"{name} within").unionByName(verdict(g.where("splits > 1"), f"{name} across"))


def check_product(df: DataFrame, a: str, b: str, stored: str, tol: float, name: str) -> DataFrame:
    """Arrays whose stored values differ from the element-wise product by more than tol, or in length."""
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    off = F.array_max(F.zip_with(product, stored, lambda p, s: F.abs(p - s)))
    return verdict(df.where((F.size(a) != F.size(stored)) | (F.coalesce(off, F.lit(0.0)) > tol)), name)


def describe_design(df: DataFrame, cols: list[str]) -> DataFrame:
    """Mean and exact median of each column, a row each; all medians are selected together."""
    mid = select_ranks(df, cols, [0.5])
    one = df.agg(*[F.avg(c).alias(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("stat"), F.col(c).alias("mean"), F.lit(mid[c][0]).cast("double").alias("median")) for c in cols])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def check_determinism(a: DataFrame, b: DataFrame, key: str, name: str) -> DataFrame:
    """Keys whose rows differ in any column, or that one build lacks."""
    hashed = lambda d, to: d.select(key, F.sha2(F.to_json(F.struct(*sorted(c for c in d.columns if c != key))), 256).alias(to))
    both = hashed(a, "_a").join(hashed(b, "_b"), key, "full")
    return verdict(both.where(~F.col("_a").eqNullSafe(F.col("_b"))), name)


def check_within(df: DataFrame, measured: Column, drawn: Column, tol: float, name: str) -> DataFrame:
    """Rows whose measured value is more than tol from the drawn one, or unknown."""
    return verdict(df.where(~F.coalesce(F.abs(measured - drawn) <= tol, F.lit(False))), name)


def check_spans(frames: DataFrame, key: str, level: str, inside: Column, ratio: float, name: str) -> DataFrame:
    """Keys whose level inside their spans is below `ratio` times that outside."""
    sq = lambda pred: F.sqrt(F.avg(F.when(pred, F.col(level) * F.col(level))))
    g = frames.groupBy(key).agg(sq(inside).alias("a"), sq(~inside).alias("b"))
    return verdict(g.where("a is not null and b is not null").where(F.col("a") < ratio * F.col("b")), name)


def check_sources(df: DataFrame, frames: Column, peak: Column, name: str, silent: float = 1e-4) -> DataFrame:
    """Sources that do not open, are empty or are silent."""
    return verdict(df.where(frames.isNull() | (frames == 0) | (F.coalesce(peak, F.lit(0.0)) < silent)), name)


def check_support(real: DataFrame, synth: DataFrame, stats: list[str], margin: float, name: str) -> DataFrame:
    """Real rows outside the synthetic range of any statistic, widened by the margin. The range is one row."""
    ends = synth.agg(*[f(s).alias(f"_{k}_{s}") for s in stats for k, f in (("lo", F.min), ("hi", F.max))])
    out = F.lit(False)
    for s in stats:
        out = out | (F.col(s) < F.col(f"_lo_{s}") - margin) | (F.col(s) > F.col(f"_hi_{s}") + margin)
    return verdict(real.crossJoin(F.broadcast(ends)).where(out), name)


def register_ranges(df: DataFrame, stats: list[str]) -> DataFrame:
    """p02 and p98 of each statistic, selected together: stat, lo, hi."""
    ends = select_ranks(df, stats, [0.02, 0.98])
    return df.sparkSession.createDataFrame([(s, *ends[s]) for s in stats], "stat string, lo double, hi double")


def check_capture(df: DataFrame, key: str, ranges: DataFrame, stats: list[str], margin: float = 3.0) -> DataFrame:
    """A row per capture and statistic: ok if the value is within the registered range, widened."""
    long = df.select(key, F.explode(F.array(*[F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias("value")) for s in stats])).alias("v")).select(key, "v.stat", "v.value")
    ok = F.coalesce(F.col("value").between(F.col("lo") - margin, F.col("hi") + margin), F.lit(False))
    return long.join(F.broadcast(ranges), "stat").select(key, "stat", "value", ok.alias("ok"))  # a row per statistic


def audit_content(expected: Column, in_top: Column, music: Column, speech: Column, interferer: Column) -> Column:
    """Fixed limits: expected at 0.15, or 0.05 and among the top entries; music below 0.3; speech below 0.4 unless an interferer."""
    seen = (expected >= 0.15) | ((expected >= 0.05) & in_top)
    return F.coalesce(seen & (music < 0.3) & ((speech < 0.4) | interferer), F.lit(False))


def gate(agreement: Column, gain: Column, least_db: float = 15.0, least_gain: float = 0.5) -> Column:
    return F.coalesce((agreement >= least_db) & (gain >= least_gain), F.lit(False))


def promotion_gate(old: DataFrame, new: DataFrame, probe: str, value: str, limits: dict[str, float], default: float) -> DataFrame:
    """A row per probe of the old run: the new value may fall by no more than the probe's limit; a missing one fails."""
    from .filters import lookup

    both = old.select(probe, F.col(value).alias("old")).join(new.select(probe, F.col(value).alias("new")), probe, "left")
    limit = F.coalesce(lookup(F.col(probe), limits), F.lit(default)) if limits else F.lit(default)
    return both.select(probe, "old", "new", F.coalesce(F.col("new") >= F.col("old") - limit, F.lit(False)).alias("ok"))


def current_model(log: DataFrame, seq: str, path: str, state: str) -> DataFrame:
    """Last promoted path that no later row rolled back. `log` is append-only: promoted or rolled_back rows."""
    last = log.groupBy(path).agg(F.max_by(state, seq).alias("_s"), F.max(seq).alias(seq)).where(F.col("_s") == "promoted")
    return last.agg(F.max_by(path, seq).alias(path), F.max(seq).alias(seq))


def rollback(log: DataFrame, seq: str, path: str, state: str) -> DataFrame:
    """The row that marks the current path as rolled back, to be appended to the log."""
    now = current_model(log, seq, path, state).select(path)
    top = log.agg(F.max(seq).alias("_m"))
    return now.crossJoin(top).where(F.col(path).isNotNull()).select((F.col("_m") + 1).alias(seq), path, F.lit("rolled_back").alias(state))  # one row each


def check_batch(batch: DataFrame, manifest: DataFrame, key: str, want: str, split: str, eval_only: Column, name: str) -> DataFrame:
    """Drawn rows that the manifest lacks, puts in another split or keeps for evaluation."""
    m = manifest.select(key, F.col(split).alias("_s"), F.coalesce(eval_only, F.lit(False)).alias("_e"))
    return verdict(batch.select(key).join(m, key, "left").where(F.col("_s").isNull() | (F.col("_s") != want) | (F.col("_e") & F.lit(want == "train"))), name)


def check_config(scenarios: DataFrame, labels: DataFrame, scenario: str, label: str, role: str, weight: str) -> DataFrame:
    """Three rows: labels without an entry of the needed role, scenarios whose weights do not sum to one, weights out of [0, 1]."""
    missing = scenarios.join(labels.select(label, role).distinct(), [label, role], "left_anti")
    sums = scenarios.groupBy(scenario).agg(F.sum(weight).alias("s")).where(F.abs(F.col("s") - 1) >= 1e-6)
    outside = scenarios.where(~F.coalesce(F.col(weight).between(0, 1), F.lit(False)))
    return verdict(missing, "labels").unionByName(verdict(sums, "weights sum")).unionByName(verdict(outside, "weights range"))
