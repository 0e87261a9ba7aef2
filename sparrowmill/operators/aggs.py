"""Aggregations, windows and set operations over tables."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.functions.scans import ranged, scan


def hours(df: DataFrame, by: list[str], seconds: str) -> DataFrame:
    return df.groupBy(*by).agg((F.sum(seconds) / 3600.0).alias("hours"))


def n_distinct(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.countDistinct(col).alias("n"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), col)


def rate_pct(df: DataFrame, pred: Column, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg((F.avg(pred.cast("double")) * 100).alias("pct"))


def quantiles(df: DataFrame, col: str, ps: list[float]) -> DataFrame:
    """Exact, with linear interpolation; nulls are left out. Values are counted and dealt by
    range, and ranks come from the counts of the ranges before, so no task sees all rows."""
    v = ranged(df.select(F.col(col).cast("double").alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n")), "v")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    parts = v.groupBy("_part").agg(F.sum("n").alias("m")).select("_part", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"), F.sum("m").over(Window.partitionBy()).alias("total"))
    run = F.sum("n").over(Window.partitionBy("_part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    ranked = v.withColumn("run", run).join(F.broadcast(parts), "_part").withColumn("end", F.col("base") + F.col("run"))

    def at(k):
        return F.max(F.when((F.col("end") - F.col("n") <= k) & (k < F.col("end")), F.col("v")))

    pos = [(F.col("total") - 1) * F.lit(float(p)) for p in ps]
    q = ranked.agg(F.max("total").alias("total"), *[at(f(x)).alias(f"{k}{i}") for i, x in enumerate(pos) for k, f in (("lo", F.floor), ("hi", F.ceil))])
    return q.select(*[F.when(F.floor(x) == F.ceil(x), F.col(f"lo{i}")).otherwise((F.ceil(x) - x) * F.col(f"lo{i}") + (x - F.floor(x)) * F.col(f"hi{i}")).alias(f"p{round(p * 100):02d}")
                      for i, (p, x) in enumerate(zip(ps, pos))])


def histogram_left(df: DataFrame, col: str, edges: list[float]) -> DataFrame:
    """Left-closed bins, the last one closed on both sides; empty bins count zero."""
    c, last = F.col(col), len(edges) - 2
    bin_ = reduce(lambda w, i: w.when((c >= edges[i]) & ((c < edges[i + 1]) if i < last else (c <= edges[i + 1])), i), range(last + 1), F)
    n = df.select(bin_.alias("bin")).where("bin is not null").groupBy("bin").count()
    bins = df.sparkSession.range(len(edges) - 1).select(F.col("id").cast("int").alias("bin"))
    return bins.join(n, "bin", "left").select("bin", F.coalesce("count", F.lit(0)).alias("n"))


def binned_mean(df: DataFrame, col: str, edges: list[float], metric: str) -> DataFrame:
    """Right-closed bins; values outside are dropped."""
    c = F.col(col)
    bin_ = reduce(lambda w, i: w.when((c > edges[i]) & (c <= edges[i + 1]), i), range(len(edges) - 1), F)
    return df.withColumn("bin", bin_).where("bin is not null").groupBy("bin").agg(F.avg(metric).alias("mean"), F.count(F.lit(1)).alias("n"))


def breakdown(df: DataFrame, keys: list[str], metric: str) -> DataFrame:
    """Means by each key at once: one grouping set per key and the total."""
    sets = [[F.col(k)] for k in keys] + [[]]
    return df.groupingSets(sets, *[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"), F.avg(metric).alias("mean"), F.grouping_id().cast("long").alias("gid"))


def top_k_values(df: DataFrame, by: str, col: str, k: int) -> DataFrame:
    n = df.groupBy(by, col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(by).orderBy(F.desc("n"), col)
    return n.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def micro_ratio(df: DataFrame, num: str, den: str, by: str) -> DataFrame:
    return df.groupBy(by).agg((F.sum(num) / F.greatest(F.sum(den), F.lit(1))).alias("ratio"))


def threshold_sweep(df: DataFrame, conf: str, ps: list[float]) -> DataFrame:
    one = df.agg(*[F.count(F.when(F.col(conf) >= p, 1)).alias(str(i)) for i, p in enumerate(ps)])
    return one.select(F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col(str(i)).alias("n")) for i, p in enumerate(ps)])).alias("s")).select("s.p", "s.n")


def occurrence(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return scan(df, key, order, sums={"occurrence": F.lit(1)}).withColumn("occurrence", F.col("occurrence") - 1)


def number_in(df: DataFrame, prefix: str, order: str) -> DataFrame:
    """Names `<prefix>_<n>`, n counted from 1 in `order` and padded to four digits, never cut.
    Rows are dealt by range and counted from the rows of the ranges before, so no prefix
    passes through one task; equal rows are told apart by a row number."""
    t = ranged(df.withColumn("_row", F.monotonically_increasing_id()), prefix, order, "_row")
    before = Window.partitionBy(prefix).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    base = t.groupBy("_part", prefix).agg(F.count(F.lit(1)).alias("_m")).select(
        F.col("_part").alias("_p"), F.col(prefix).alias("_g"), F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_base"))
    t = t.withColumn("_n", F.row_number().over(Window.partitionBy("_part", prefix).orderBy(order, "_row")))
    n = (F.col("_base") + F.col("_n")).cast("string")
    t = t.join(base, (F.col("_part") == F.col("_p")) & F.col(prefix).eqNullSafe(F.col("_g")))
    return t.withColumn("name", F.concat(prefix, F.lit("_"), F.lpad(n, F.greatest(F.lit(4), F.length(n)), F.lit("0")))).select(*df.columns, "name")


def first_k(df: DataFrame, by: str, order: str, k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("rank") <= k)


def gap_violations(df: DataFrame, key: str, t: Column, order: list[str], min_gap: float) -> DataFrame:
    """Rows that follow the one before within less than `min_gap`, and all rows, per key."""
    d = scan(df.select(key, *order, t.alias("_t")), key, order, lag={"_before": F.col("_t")})
    return d.groupBy(key).agg(F.count(F.when(F.col("_t") - F.col("_before") < min_gap, 1)).alias("violations"), F.count(F.lit(1)).alias("n"))


def max_concurrent(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Sweep line: ends come before starts at one time, so the changes of one time add up before they
    are scanned. A range gives its sum and its highest prefix; no running sum leaves it."""
    marks = df.select(key, F.explode(F.array(F.struct(F.col(a).alias("t"), F.lit(1).alias("d")), F.struct(F.col(b).alias("t"), F.lit(-1).alias("d")))).alias("m")).select(key, "m.t", "m.d")
    t = ranged(marks.groupBy(key, "t").agg(F.sum("d").alias("d")), key, "t")
    run = F.sum("d").over(Window.partitionBy("_part", key).orderBy("t").rowsBetween(Window.unboundedPreceding, 0))
    parts = t.withColumn("live", run).groupBy("_part", key).agg(F.sum("d").alias("d"), F.max("live").alias("top"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    return parts.select(key, (F.coalesce(F.sum("d").over(before), F.lit(0)) + F.col("top")).alias("live")).groupBy(key).agg(F.max("live").alias("max_live"))


def last_known(df: DataFrame, key: str, value: Column, order: list[str]) -> DataFrame:
    return scan(df, key, order, last={"last_known": value})


def superseded_by(df: DataFrame, key: str, order: list[str], id_col: str) -> DataFrame:
    return scan(df, key, order, lead={"superseded_by": F.col(id_col)})


def newest(df: DataFrame, n: int, order: list) -> DataFrame:
    return df.orderBy(*order).limit(n)


def distinct_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def upsert_by_id(old: DataFrame, new: DataFrame, wanted: DataFrame, key: str, line: str | None = None) -> DataFrame:
    """Wanted rows by id, the newest line of each: new rows before old ones, and of several new (or
    old) rows of an id the one with the largest `line`. Without a line number the rest of the row
    decides, so that the result does not depend on partitions."""
    both = old.withColumn("_v", F.lit(0)).unionByName(new.withColumn("_v", F.lit(1)), allowMissingColumns=True)
    rest = [line] if line else [c for c in both.columns if c not in (key, "_v")]
    newest_ = F.max(F.struct("_v", *rest, *[c for c in both.columns if c not in (key, "_v", *rest)])).alias("_r")
    best = both.groupBy(key).agg(newest_)
    return best.select(*[F.col(key) if c == key else F.col(f"_r.{c}").alias(c) for c in both.columns if c != "_v"]).join(wanted.select(key), key, "left_semi")


def select_ranks(df: DataFrame, cols: list[str], ps: list[float], bins: int = 1024) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns at once, with linear interpolation; nulls are left out.

    Each pass counts values in bins around the wanted ranks and narrows to the bins that hold them,
    until a bin holds one value. Nothing is sorted or shuffled but counts: `bins` rows a column and
    rank, which is all that the driver sees. Columns must be free of NaN and infinities."""
    names = {f"c{i}": c for i, c in enumerate(cols)}
    d = df.select(*[F.col(c).cast("double").alias(n) for n, c in names.items()])
    ends = d.agg(*[f(n).alias(f"{k}{n}") for n in names for k, f in (("n", F.count), ("a", F.min), ("b", F.max))]).first()
    found: dict[tuple[str, int], float] = {}
    todo: dict[tuple[str, float, float], set[tuple[int, int]]] = {}  # (column, low, high) -> (rank, values below low)
    want = {}
    for n in names:
        total = ends[f"n{n}"]
        want[n] = [(total - 1) * p for p in ps] if total else []
        for x in want[n]:
            for r in {math.floor(x), math.ceil(x)}:
                todo.setdefault((n, ends[f"a{n}"], ends[f"b{n}"]), set()).add((r, 0))
    while todo:
        for (n, lo, hi), ranks in [x for x in todo.items() if x[0][1] == x[0][2]]:
            found.update({(n, r): lo for r, _ in ranks})
            del todo[n, lo, hi]
        if not todo:
            break
        spans = list(todo)
        place = []
        for i, (n, lo, hi) in enumerate(spans):
            step = F.least(F.lit(bins - 1), F.floor((F.col(n) - lo) / (hi - lo) * bins).cast("int"))
            place.append(F.when(F.col(n).between(lo, hi), F.struct(F.lit(i).alias("i"), step.alias("k"), F.col(n).alias("v"))))
        counts = d.select(F.explode(F.array_compact(F.array(*place))).alias("x")).groupBy("x.i", "x.k").agg(F.count(F.lit(1)).alias("m"), F.min("x.v").alias("lo"), F.max("x.v").alias("hi"))
        by = {}
        for r in counts.collect():
            by.setdefault(r.i, []).append((r.k, r.m, r.lo, r.hi))
        following: dict = {}
        for i, span in enumerate(spans):
            for rank, below in todo[span]:
                for _, m, lo, hi in sorted(by[i]):
                    if rank < below + m:
                        following.setdefault((span[0], lo, hi), set()).add((rank, below))
                        break
                    below += m
        todo = following
    out = {}
    for n, c in names.items():
        out[c] = [found[n, math.floor(x)] + (x - math.floor(x)) * (found[n, math.ceil(x)] - found[n, math.floor(x)]) for x in want[n]] or [None] * len(ps)
    return out


def paired_stats(calm: DataFrame, loud: DataFrame, key: list[str], by: str) -> DataFrame:
    """Ratios loud / calm of paired takes: mean and sample deviation per group of two pairs or more."""
    r = calm.join(loud, key).where("calm > 0").select(by, (F.col("loud") / F.col("calm")).alias("r"))
    return r.groupBy(by).agg(F.avg("r").alias("mean"), F.stddev_samp("r").alias("std"), F.count(F.lit(1)).alias("n")).where("n >= 2")
