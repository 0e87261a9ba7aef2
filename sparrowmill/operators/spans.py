"""Intervals, ranks and draws over tables."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.functions.keyed import keyed_u
from sparrowmill.functions.scans import ranged, ranged_in, scan
from sparrowmill.functions.shared import materialise


#: Starts and ends in a range of intervals.
MARKS = 400_000


def overlap_join(spans: DataFrame, frames: DataFrame, key: str) -> DataFrame:
    """Spans (key, a, b) with frames (key, c, d) that overlap, touching ends apart.

    Starts and ends are dealt over ranges of (key, time). An interval goes to each range that it
    crosses, however long it is, and a pair is found in the range of its later start, by a sweep
    over sorted starts. Ranges hold a bounded number of starts and ends, so there are more of them
    in larger tables. Times are numbers; rows with a null never overlap."""
    s, f = (materialise(d.withColumn(n, F.monotonically_increasing_id()), "side") for d, n in ((spans, "_s"), (frames, "_f")))
    ends = [d.select(F.col(key).alias("_k"), F.lit(side).alias("_side"), F.col(n).alias("_id"), F.col(lo).cast("double").alias("_lo"), F.col(hi).cast("double").alias("_hi"))
            for d, side, n, lo, hi in ((s, 0, "_s", "a", "b"), (f, 1, "_f", "c", "d"))]
    both = ends[0].unionByName(ends[1]).where("_k is not null and _lo <= _hi")
    times = both.select("_k", "_side", "_id", "_lo", "_hi", F.explode(F.array("_lo", "_hi")).alias("_t"))
    n = -(-2 * (s.count() + f.count()) // MARKS)
    marks = ranged(times, "_k", "_t") if n < 2 else ranged_in(times, n, "_k", "_t")
    crossed = marks.groupBy("_k", "_side", "_id", "_lo", "_hi").agg(F.min("_part").alias("_p0"), F.max("_part").alias("_p1"))
    pieces = crossed.withColumn("_part", F.explode(F.sequence("_p0", "_p1")))

    def sweep(pdf: pd.DataFrame) -> pd.DataFrame:
        code = pd.factorize(pdf["_k"])[0].astype("int64")
        times = np.unique(np.r_[pdf["_lo"], pdf["_hi"]])
        width = len(times) + 1
        lo, hi = (code * width + np.searchsorted(times, pdf[c]) for c in ("_lo", "_hi"))
        side, ident, here = pdf["_side"].to_numpy(), pdf["_id"].to_numpy("int64"), (pdf["_p0"] == pdf["_part"]).to_numpy()
        out = []
        for x in (0, 1):
            start = np.flatnonzero((side != x) & here)  # the others that start in this range
            start = start[np.argsort(lo[start], kind="stable")]
            hold = np.flatnonzero(side == x)
            first = np.searchsorted(lo[start], lo[hold], "left" if x == 0 else "right")  # equal starts once
            n = np.maximum(np.searchsorted(lo[start], hi[hold], "left") - first, 0)
            at = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            a, b = np.repeat(hold, n), start[at]
            real = (lo[a] < hi[b]) & (lo[b] < hi[a])
            pair = (ident[a[real]], ident[b[real]])
            out.append(pd.DataFrame(dict(zip(("_s", "_f") if x == 0 else ("_f", "_s"), pair))))
        return pd.concat(out)[["_s", "_f"]]

    pairs = pieces.groupBy("_part").applyInPandas(sweep, "_s bigint, _f bigint")
    return pairs.join(s, "_s").join(f.drop(key), "_f").drop("_s", "_f")


def within_window(df: DataFrame, windows: DataFrame, key: str, t: str) -> DataFrame:
    """Rows whose time lies in a window (key, lo, hi) of their key, ends included."""
    return df.join(windows, key).where(F.col(t).between(F.col("lo"), F.col("hi")))


def join_cum_weight(df: DataFrame, weights: DataFrame, u: str, name: str, weight: str) -> DataFrame:
    """Each row's draw u in [0, 1) picks the name whose cumulative weight interval, by name, holds it.
    Weights and draws are sorted together and each draw takes the last interval that begins at or
    before it, so either table may be of any size. Draws outside [0, 1) and null ones pick nothing."""
    w = weights.where(F.col(weight) > 0).select(F.lit(0).alias("_k"), name, F.col(weight).cast("double").alias("_w"))
    cum = materialise(scan(w, "_k", [name], sums={"_hi": F.col("_w")}), "cum")
    total = cum.agg(F.max("_hi").alias("_total"))
    begin = cum.crossJoin(F.broadcast(total)).select(((F.col("_hi") - F.col("_w")) / F.col("_total")).alias("_v"), F.lit(0).alias("_draw"), F.col(name).alias("_name"))  # one row
    rows = df.where((F.col(u) >= 0) & (F.col(u) < 1)).select(F.col(u).cast("double").alias("_v"), F.lit(1).alias("_draw"), F.struct(*df.columns).alias("_r"))
    both = begin.unionByName(rows, allowMissingColumns=True).withColumn("_k", F.lit(0))
    met = scan(both, "_k", ["_v", "_draw"], last={"_found": F.col("_name")})
    return met.where("_draw = 1 and _found is not null").select("_r.*", F.col("_found").alias(name))


def empty_cells(a: DataFrame, b: DataFrame, fact: DataFrame) -> DataFrame:
    """Pairs of two configuration tables without a row in `fact`."""
    return a.crossJoin(F.broadcast(b)).join(fact.select(*a.columns, *b.columns).distinct(), [*a.columns, *b.columns], "left_anti")


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """Adds `n`, the number of a row from 0 in `order`. Rows are dealt by range and counted from the ranges before."""
    t = ranged(df, *order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    base = t.groupBy("_part").agg(F.count(F.lit(1)).alias("_m")).select("_part", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_base"))
    t = t.withColumn("_i", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    return t.join(F.broadcast(base), "_part").withColumn("n", F.col("_base") + F.col("_i") - 1).select(*df.columns, "n")


def permute(df: DataFrame, seed: int, key: str) -> DataFrame:
    """Rows with their place `n` in a seeded permutation."""
    return numbered(df.withColumn("_u", keyed_u(seed, F.col(key), "permute")), "_u", key).drop("_u")


def limit_random(df: DataFrame, k: int, seed: int, key: str) -> DataFrame:
    """k rows by least draw: the partitions' k least are merged, nothing is sorted whole."""
    return df.withColumn("_u", keyed_u(seed, F.col(key), "limit")).orderBy("_u", key).limit(k).drop("_u")


def limit_even(df: DataFrame, k: int, key: str) -> DataFrame:
    """k evenly spaced rows in the order of `key`, the first and the last included."""
    t = numbered(df, key)
    total = t.count()
    step = max(1, k - 1)
    want = df.sparkSession.range(min(k, total)).select(F.expr(f"id * {total - 1}L div {step}").alias("n")).distinct()
    return t.join(want, "n", "left_semi").drop("n")


def ranked_pool(pool_rows: DataFrame, pool: str, key: str) -> DataFrame:
    """Adds `_rank` from 0 within each pool, and `_size`, without one task per pool: ranges are
    numbered and each pool counts from its least number."""
    t = numbered(pool_rows, pool, key)
    base = t.groupBy(pool).agg(F.min("n").alias("_first"), F.count(F.lit(1)).alias("_size"))
    return t.join(base, pool).withColumn("_rank", F.col("n") - F.col("_first")).drop("n", "_first")


def rank_join(df: DataFrame, pool_rows: DataFrame, pool: str, key: str, u: str) -> DataFrame:
    """Each row's draw u picks a row of its pool: equi join on pool and rank."""
    r = ranked_pool(pool_rows, pool, key)
    sizes = r.groupBy(pool).agg(F.count(F.lit(1)).alias("_n"))
    want = df.join(sizes, pool).withColumn("_rank", F.floor(F.col(u) * F.col("_n")))
    return want.join(r.drop("_size"), [pool, "_rank"]).drop("_rank", "_n")


def pool_draw(df: DataFrame, pool_rows: DataFrame, pool: str, key: str, u: str, prefer: Column, least: int = 20) -> DataFrame:
    """A rank join into the preferred rows of a pool where it has `least` of them, into all rows otherwise."""
    n = pool_rows.groupBy(pool).agg(F.count(F.when(prefer, 1)).alias("_p"))
    use = pool_rows.join(n, pool).where((F.col("_p") < least) | prefer).drop("_p")
    return rank_join(df, use, pool, key, u)


def pick_nonempty(alts: list[str], counts: DataFrame, pool: str, n: str, df: DataFrame, u: str) -> DataFrame:
    """Adds `pick`, one of the alternative pools that have rows; raises if none has. Counts are one row."""
    have = counts.where(F.col(pool).isin(alts) & (F.col(n) > 0)).agg(F.array_sort(F.collect_list(pool)).alias("_have"))  # at most the alternatives
    pick = F.element_at("_have", (F.floor(F.col(u) * F.size("_have")) + 1).cast("int"))
    return df.crossJoin(F.broadcast(have)).withColumn("pick", F.when(F.size("_have") > 0, pick).otherwise(F.raise_error(F.lit("no pool has rows")).cast("string"))).drop("_have")


def mix_shares(base: DataFrame, extra: DataFrame, corpus: str, key: str, shares: dict[str, float], seed: int) -> DataFrame:
    """`base` plus rows of each extra corpus up to its share of the whole: without replacement
    where the corpus is long enough, otherwise each row often enough in seeded order."""
    quota = base.count() / max(1e-12, 1 - sum(shares.values()))
    want = F.create_map(*[F.lit(x) for c, s in shares.items() for x in (c, float(round(quota * s)))])[F.col(corpus)]
    r = ranked_pool(extra.where(F.col(corpus).isin(list(shares))).withColumn("_u", keyed_u(seed, F.col(key), "mix")).withColumn("_k", F.struct("_u", key)), corpus, "_k")
    times = F.floor(want / F.col("_size")) + F.when(F.col("_rank") < F.pmod(want, F.col("_size").cast("double")), 1).otherwise(0)
    drawn = r.withColumn("_t", times.cast("int")).where("_t > 0").withColumn("_c", F.explode(F.sequence(F.lit(1), F.col("_t"))))
    return base.unionByName(drawn.select(*base.columns))


def index_items(items: DataFrame, key: str, n: int, cap: int) -> DataFrame:
    """Indices 0 to n - 1 with the item of rank index mod the number of items, each used `cap` times at most."""
    t = numbered(items.select(key), key)
    total = t.count()
    if not total:
        return t.select(F.lit(None).cast("long").alias("index"), key).limit(0)
    idx = t.sparkSession.range(min(n, total * cap)).select(F.col("id").alias("index"), (F.col("id") % total).alias("n"))
    return idx.join(t, "n").select("index", key)


def capped_sample(df: DataFrame, n: int, is_capped: Column, cap: float, seed: int, key: str) -> DataFrame:
    """n rows of which at most the share `cap` is of the capped class, by least draw on either side."""
    most = int(n * cap)
    few = limit_random(df.where(is_capped), most, seed, key)
    return few.unionByName(limit_random(df.where(~is_capped), n - most, seed, key))


def noisy_tokens(toks: Column, key: Column, p: float, confuse: dict[str, list[str]], digits: dict[str, str], extra: list[str], seed: int) -> Column:
    """Tokens as a recogniser might hear them, one to many: a token is deleted with probability
    0.3 p; up to 1.6 p it is confused with one of its alternatives (which may be empty or two
    words), up to 1.2 p a spoken digit is written; behind each that stays a filler word follows
    with probability 0.1 p. All draws are keyed by row and place. Null tokens give null."""
    def u(i, stage):
        return keyed_u(seed, F.concat_ws(".", key.cast("string"), i.cast("string")), stage)

    def pick(options: Column, at: Column) -> Column:
        return F.get(options, F.floor(at * F.size(options)).cast("int"))

    wrong = F.create_map(*[x for w, alts in confuse.items() for x in (F.lit(w), F.array(*map(F.lit, alts)))])
    number = F.create_map(*[F.lit(x) for kv in digits.items() for x in kv])
    fill = F.array(*map(F.lit, extra))

    def one(t, i):
        r = u(i, "token")
        heard = F.when(wrong[t].isNotNull() & (r < 1.6 * p), pick(wrong[t], u(i, "which"))).when(number[t].isNotNull() & (r < 1.2 * p), number[t]).otherwise(t)
        more = F.when(u(i, "insert") < 0.1 * p, F.array(heard, pick(fill, u(i, "filler")))).otherwise(F.array(heard))
        return F.when(r < 0.3 * p, F.array().cast("array<string>")).otherwise(more)

    return F.filter(F.flatten(F.transform(toks, one)), lambda w: w != "")


def noisy_text(text: Column, key: Column, p: float, confuse: dict[str, list[str]], digits: dict[str, str], extra: list[str], seed: int) -> Column:
    """Lower-case words of a text with recognition errors; for half of the rows neighbouring digits run together."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[a-z\-']+|[0-9]+"), F.lit(0))
    s = F.array_join(noisy_tokens(toks, key, p, confuse, digits, extra, seed), " ")
    return F.when(keyed_u(seed, key.cast("string"), "join") < 0.5, F.regexp_replace(s, r"([0-9]) (?=[0-9])", "$1")).otherwise(s)


def soft_gold(label: Column, classes: list[str], main: float = 0.9) -> Column:
    """Probability map: `main` on the label, the rest shared by the others."""
    rest = (1 - main) / (len(classes) - 1)
    return F.map_from_arrays(F.array(*map(F.lit, classes)), F.array(*[F.when(label == c, F.lit(main)).otherwise(F.lit(rest)) for c in classes]))


def raster_spans(spans: DataFrame, keys: list[str], a: str, b: str, value: str, hop: float) -> DataFrame:
    """Frames that a span touches, with the largest value of the spans over each."""
    f = F.explode(F.sequence(F.floor(F.col(a) / hop), F.ceil(F.col(b) / hop) - 1))
    return spans.where(F.col(b) > F.col(a)).select(*keys, f.alias("frame"), value).groupBy(*keys, "frame").agg(F.max(value).alias(value))


def pause_islands(df: DataFrame, key: str, order: str, quiet: Column, least: int) -> DataFrame:
    """Runs of at least `least` quiet frames: key, first, last, n. Frames of a run share the number of loud frames before."""
    t = scan(df.withColumn("_q", F.coalesce(quiet, F.lit(False))), key, [order], sums={"_g": F.when(F.col("_q"), 0).otherwise(1)})
    runs = t.where("_q").groupBy(key, "_g").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count(F.lit(1)).alias("n"))
    return runs.where(F.col("n") >= least).drop("_g")


def moving_argmin(df: DataFrame, key: str, order: str, value: str, k: int) -> DataFrame:
    """Least mean of k neighbouring rows per key, and where it starts; only full windows count. Rows
    are numbered and cut into blocks; the first k - 1 rows of a block also go to the one before."""
    size = max(4096, 4 * k)
    t = scan(df.select(key, order, value), key, [order], sums={"_n": F.lit(1)}).withColumn("_b", F.floor((F.col("_n") - 1) / size))
    early = F.when(((F.col("_n") - 1) % size < k - 1) & (F.col("_b") > 0), F.array("_b", F.col("_b") - 1)).otherwise(F.array("_b"))
    w = Window.partitionBy(key, "_b").orderBy("_n").rowsBetween(0, k - 1)
    t = t.select(key, order, value, "_n", F.explode(early).alias("_b")).select(key, order, "_n", "_b", F.avg(value).over(w).alias("mean"), F.count(F.lit(1)).over(w).alias("_c"))
    t = t.where((F.col("_c") == k) & (F.floor((F.col("_n") - 1) / size) == F.col("_b")))
    return t.groupBy(key).agg(F.min(F.struct("mean", order)).alias("m")).select(key, "m.mean", F.col(f"m.{order}").alias("at"))


def union_all(*dfs: DataFrame) -> DataFrame:
    """Union by name; columns that a part lacks are null."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)
