"""Ordered scans, packing, sweeps and selections of one large key, against plain loops."""

import bisect
import random
import time

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparrowmill.functions import scans
from sparrowmill.operators import aggs, packing, spans


@pytest.fixture()
def many_ranges(spark, monkeypatch):
    """Seven ranges, whatever the size."""
    def dealt(df, *order):
        return scans.materialise(df.repartitionByRange(7, *order).withColumn("_part", F.spark_partition_id()), "ranged")

    for m in (scans, aggs, spans, packing):
        monkeypatch.setattr(m, "ranged", dealt)
    return spark


def _rows(n, keys, seed=0):
    r = random.Random(seed)
    return [(r.choice(keys), r.randrange(50), i, r.choice((None, *range(9)))) for i in range(n)]


@pytest.mark.parametrize("keys", [[1], [1, 2, None], list(range(300))])
def test_scan_equals_windows(many_ranges, keys):
    df = many_ranges.createDataFrame(_rows(2000, keys), "k int, t int, id int, v int")
    w = Window.partitionBy("k").orderBy("t", "id")
    upto, prior = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("*", F.coalesce(F.sum("v").over(upto), F.lit(0)).alias("s"), F.count(F.lit(1)).over(upto).alias("n"), F.lag("v").over(w).alias("g"), F.lead("id").over(w).alias("d"), F.last("v", ignorenulls=True).over(prior).alias("l"))
    got = scans.scan(df, "k", ["t", "id"], sums={"s": F.col("v"), "n": F.lit(1)}, lag={"g": F.col("v")}, lead={"d": F.col("id")}, last={"l": F.col("v")})
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_scan_of_nothing(many_ranges):
    assert scans.scan(many_ranges.createDataFrame([], "k int, t int"), "k", ["t"], sums={"n": F.lit(1)}).count() == 0


def test_one_key_is_in_all_ranges(many_ranges):
    df = many_ranges.createDataFrame(_rows(5000, [1]), "k int, t int, id int, v int")
    t = scans.ranged(df, "k", "t", "id")
    sizes = [r["count"] for r in t.groupBy("_part").count().collect()]
    assert len(sizes) == 7 and max(sizes) < 2 * 5000 / 7


def test_concurrency_islands_and_moving_means(many_ranges):
    rows = _rows(3000, [1, 1, 1, 2], 4)
    df = many_ranges.createDataFrame([(k, i, t, t + (v or 0), v) for k, t, i, v in rows], "k int, i int, a int, b int, v int")
    marks = {}
    for k, _, a, b, _ in df.collect():
        marks.setdefault(k, []).extend([(a, 1), (b, -1)])
    want = {}
    for k, m in marks.items():
        live = best = None
        for _, d in sorted(m):
            live = (live or 0) + d
            best = live if best is None else max(best, live)
        want[k] = best
    assert {r.k: r.max_live for r in aggs.max_concurrent(df, "k", "a", "b").collect()} == want

    islands = []
    for k in (1, 2):
        run = []
        for kk, i, _, _, v in sorted(df.collect(), key=lambda r: r.i):
            if kk == k:
                if v is not None and v < 6:
                    run.append(i)
                else:
                    islands += [(k, run[0], run[-1], len(run))] if len(run) >= 3 else []
                    run = []
        islands += [(k, run[0], run[-1], len(run))] if len(run) >= 3 else []
    assert sorted(map(tuple, spans.pause_islands(df.select("k", "i", "v"), "k", "i", F.col("v") < 6, 3).collect())) == sorted(islands)

    full = df.withColumn("v", F.coalesce("v", F.lit(0)) + F.col("i") * 1e-6)
    means = {}
    for k in (1, 2):
        x = [(r.i, r.v) for r in full.orderBy("i").collect() if r.k == k]
        means[k] = min((round(sum(v for _, v in x[j:j + 1500]) / 1500, 9), x[j][0]) for j in range(len(x) - 1499)) if len(x) >= 1500 else None
    got = {r.k: (round(r.mean, 9), r["at"]) for r in spans.moving_argmin(full, "k", "i", "v", 1500).collect()}
    assert got == {k: m for k, m in means.items() if m}


# --- packing ---------------------------------------------------------------

def _packed(sizes, most, gap):
    """(string, at) of clips in order by the plain loop."""
    string, used, out = 0, None, []
    for z in sizes:
        if used is not None and used + gap + z > most:
            string, used = string + 1, None
        at = 0 if used is None else used + gap
        used = at + z
        out.append((string, at))
    return out


def _chunked(sizes, reach, gap):
    string, used, out = 0, 0, []
    for z in sizes:
        out.append((string, used))
        used += z + gap
        if used >= reach:
            string, used = string + 1, 0
    return out


@pytest.mark.parametrize("n, low", [(400, 0), (3000, 1)])
def test_strings_of_a_group_in_many_ranges(many_ranges, n, low):
    r = random.Random(n)
    rows = [(g, i, r.choice((low, low, 7, 20, 60, 100))) for g, i in zip((r.choice(("a", "a", "a", "b", None)) for _ in range(n)), range(n))]
    df = many_ranges.createDataFrame(rows, "g string, clip int, size int")
    for rule, plain in ((packing.Rule(5, most=100), lambda z: _packed(z, 100, 5)), (packing.Rule(4, reach=150), lambda z: _chunked(z, 150, 4)), (packing.Rule(0, most=100), lambda z: _packed(z, 100, 0))):
        got = {x.clip: (x.string, x["at"]) for x in packing.strings(df, ["g"], "clip", "size", F.col("clip"), rule).collect()}
        for g in ("a", "b", None):
            mine = [(i, z) for k, i, z in rows if k == g]
            assert [got[i] for i, _ in mine] == plain([z for _, z in mine])


def test_pack_short_of_100_000_clips(spark):
    df = spark.range(100_000).select(F.lit("g").alias("g"), F.col("id").alias("clip"), (F.pmod(F.xxhash64("id"), F.lit(70)) + 1).cast("int").alias("size"))
    out = packing.pack_short(df, ["g"], "clip", "size", F.xxhash64("clip", F.lit(3)), 100, 5)
    rows = df.withColumn("o", F.xxhash64("clip", F.lit(3))).orderBy("o", "clip").collect()
    place = _packed([r.size for r in rows], 100, 5)
    fill = {}
    for r, (s, at) in zip(rows, place):
        fill[s] = at + r.size
    want = {(s, r.clip, at) for r, (s, at) in zip(rows, place) if fill[s] >= 35}
    assert {(r.string, r.clip, r["at"]) for r in out.collect()} == want


def test_pack_keeps_a_whole_thin_group(spark):
    df = spark.createDataFrame([("a", 1, 10), ("b", 2, 90), ("b", 3, 20), ("c", 4, 500)], "g string, clip int, size int")
    out = {(r.g, r.string, r.clip, r["at"]) for r in packing.pack_short(df, ["g"], "clip", "size", F.col("clip"), 100, 5).collect()}
    assert out == {("a", 0, 1, 0), ("b", 0, 2, 0), ("c", 0, 4, 0)}


def test_chunk_leaves_the_rest(spark):
    df = spark.createDataFrame([("a", i, z) for i, z in enumerate((50, 2, 50, 50, 50, 30))], "g string, clip int, size int")
    out = {(r.string, r.clip, r["at"]) for r in packing.chunk_clips(df, ["g"], "clip", "size", F.col("clip"), 100, 4, 5).collect()}
    assert out == {(0, 0, 0), (0, 2, 54), (1, 3, 0), (1, 4, 54)}


# --- sweep and selection ---------------------------------------------------

def test_overlaps_equal_all_pairs(many_ranges):
    r = random.Random(2)
    side = lambda n, far: [(r.choice((1, 1, 1, 2, None)), i, a, a + r.choice((0, 1, 5, far))) for i, a in zip(range(n), (r.randrange(200) for _ in range(n)))]
    s, f = side(120, 90), side(150, 40)
    s += [(1, 500, None, 4), (1, 501, 9, None), (1, 502, 30, 10)]
    got = spans.overlap_join(many_ranges.createDataFrame(s, "k int, s int, a int, b int"), many_ranges.createDataFrame(f, "k int, f int, c int, d int"), "k")
    want = {(x[1], y[1]) for x in s for y in f if x[0] is not None and x[0] == y[0] and None not in (x[2], x[3]) and x[2] <= x[3] and x[2] < y[3] and y[2] < x[3]}
    out = [(x.s, x.f) for x in got.collect()]
    assert len(out) == len(set(out)) and set(out) == want


def test_a_long_span_makes_few_rows(many_ranges):
    """A span of a billion hops meets every frame and is copied to the ranges it crosses only."""
    s = many_ranges.createDataFrame([(1, 0, 0.0, 1e9)], "k int, s int, a double, b double")
    f = many_ranges.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("f"), (F.col("id") * 4e5).alias("c"), (F.col("id") * 4e5 + 1).alias("d"))
    assert spans.overlap_join(s, f, "k").count() == 2000


def test_select_ranks_equals_sorting(spark):
    r = np.random.default_rng(1)
    x = np.r_[r.normal(0, 1, 3000), np.full(500, 0.25), 1e9, -1e-300]
    rows = [(float(v), float(i % 7), None) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    ps = [0.0, 0.02, 0.5, 0.98, 1.0]
    got = aggs.select_ranks(df, ["a", "b", "c"], ps, bins=16)
    assert np.allclose(got["a"], np.quantile(x, ps), rtol=0, atol=1e-12) and np.allclose(got["b"], np.quantile([q for _, q, _ in rows], ps))
    assert got["c"] == [None] * 5


def test_upsert_takes_the_newest_line(spark):
    old = spark.createDataFrame([(1, 0, "old"), (2, 9, "kept"), (3, 1, "unwanted")], "id int, line int, v string")
    new = spark.createDataFrame([(1, 4, "four"), (1, 7, "seven"), (1, 5, "five"), (4, 1, "b"), (4, 1, "a")], "id int, line int, v string").repartition(4)
    wanted = spark.createDataFrame([(1,), (2,), (4,)], "id int")
    assert sorted((r.id, r.v) for r in aggs.upsert_by_id(old, new, wanted, "id", "line").collect()) == [(1, "seven"), (2, "kept"), (4, "b")]


def test_noisy_text_by_plain_rules(spark):
    import hashlib
    import re

    from sparrowmill.plans.speech import CONFUSE, FILLERS, WRITTEN

    def u(key, stage):
        return int(hashlib.sha256(f"7:{key}:{stage}".encode()).hexdigest()[:8], 16) / 2**32

    texts = ["The one and in 12 de la que der on un die", "", None, "one two in un de die on " * 12, "can't-stop 5 6"]
    got = {r.id: r.s for r in spark.createDataFrame(list(enumerate(texts)), "id int, t string").select("id", spans.noisy_text(F.col("t"), F.col("id"), 0.5, CONFUSE, WRITTEN, FILLERS, 7).alias("s")).collect()}
    for i, t in enumerate(texts):
        out = []
        for k, w in enumerate(re.findall(r"[a-z\-']+|[0-9]+", (t or "").lower())):
            x = u(f"{i}.{k}", "token")
            if x < 0.15:
                continue
            if w in CONFUSE and x < 0.8:
                w = CONFUSE[w][int(u(f"{i}.{k}", "which") * len(CONFUSE[w]))]
            elif w in WRITTEN and x < 0.6:
                w = WRITTEN[w]
            out.append(w)
            if u(f"{i}.{k}", "insert") < 0.05:
                out.append(FILLERS[int(u(f"{i}.{k}", "filler") * len(FILLERS))])
        s = " ".join(w for w in out if w)
        assert got[i] == (re.sub(r"([0-9]) (?=[0-9])", r"\1", s) if u(i, "join") < 0.5 else s)


def test_even_limit_takes_both_ends(spark):
    got = [r.id for r in spans.limit_even(spark.range(1000), 4, "id").orderBy("id").collect()]
    assert got == [0, 333, 666, 999]
    assert bisect.bisect(got, 500) == 2 and spans.limit_even(spark.range(0), 4, "id").count() == 0


def test_many_small_groups_cost_no_call_each(spark):
    """20,000 groups of five clips, keys beyond 2**53 and a null key among them."""
    key = F.when(F.col("id") % 20_000 == 7, F.lit(None)).otherwise(F.col("id") % 20_000 + 2**60)
    df = spark.range(100_000).select(key.alias("g"), F.col("id").alias("clip"), (F.pmod(F.xxhash64("id"), F.lit(70)) + 1).cast("int").alias("size")).cache()
    rows = df.collect()
    start = time.time()
    got = {r.clip: (r.g, r.string, r["at"]) for r in packing.strings(df, ["g"], "clip", "size", F.col("clip"), packing.Rule(5, most=100)).collect()}
    assert time.time() - start < 30
    groups = {}
    for r in sorted(rows, key=lambda r: r.clip):
        groups.setdefault(r.g, []).append(r)
    want = {r.clip: (g, *place) for g, mine in groups.items() for r, place in zip(mine, _packed([r.size for r in mine], 100, 5))}
    assert got == want


def test_ranges_of_overlaps_grow_in_number_not_in_size(spark, monkeypatch):
    """4,000 marks, 500 a range: by its default the session would put them all in four ranges or fewer."""
    seen, deal = [], scans.materialise
    monkeypatch.setattr(scans, "materialise", lambda df, tag: seen.append(deal(df, tag)) or seen[-1])
    monkeypatch.setattr(spans, "MARKS", 500, raising=False)
    s = spark.range(1000).select((F.col("id") % 10).alias("k"), F.col("id").alias("s"), F.col("id").alias("a"), (F.col("id") + 15).alias("b"))
    f = s.withColumnsRenamed({"s": "f", "a": "c", "b": "d"})
    assert spans.overlap_join(s, f, "k").count() == 1000 + 2 * 990
    sizes = [r["count"] for r in seen[0].groupBy("_part").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1000
