"""Clips of a group put into strings in one order, for groups of any size.

Where a string ends depends on where it began, so a group seems to need one task. But within a
range of rows everything behind the first fresh start depends on that start alone. Each range
sums up, for every place at which the string that comes in can end, how full the string is that
goes out. The few summaries of a group are followed from range to range, which tells each range
what comes in, and all ranges are then cut at once. A group in one range needs no summary, and the
cut takes the groups of a partition one after the other, so that many small groups cost no call each.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparrowmill.functions.scans import ranged


@dataclass(frozen=True)
class Rule:
    """`most`: a clip that would make a string longer than this, gaps between clips included, begins
    the next. `reach`: a string ends with the clip that brings it to this length, a gap after each
    clip included. One of them is given. Without an open string its length is FRESH."""

    gap: int
    most: int | None = None
    reach: int | None = None

    def fresh(self, p: np.ndarray, at, used):
        """First fresh start behind strings that hold `used` before clip `at`. `p`: sums of the clips
        before each, with a gap each. Only a string of `reach` can end with the last clip."""
        if self.most is not None:
            return np.searchsorted(p, p[at] + self.most - used, "right") - 1
        return np.searchsorted(p, p[at] + self.reach - used, "left")

    def open(self, used: int, total: int) -> bool:
        """Whether a string takes all of a range and stays open."""
        return used + total <= self.most if self.most is not None else used + total < self.reach


FRESH = -1


def _sums(sizes, gap: int) -> np.ndarray:
    return np.r_[0, np.cumsum(np.asarray(sizes, "int64") + gap)]


def _summary(p: np.ndarray, rule: Rule) -> tuple[list[int], list[int], list[int]]:
    """For each place at which a string that comes in can end: the sum before it, what the open string
    holds at the end of the range, and how many strings begin from there on."""
    m = len(p) - 1
    at = np.arange(m)
    nxt = np.maximum(at + 1, rule.fresh(p, at, -rule.gap if rule.most is not None else 0)).tolist()
    out, n = [FRESH] * (m + 1), [0] * (m + 1)
    for i in range(m - 1, -1, -1):
        j = nxt[i]
        if j < m:
            out[i], n[i] = out[j], n[j] + 1
        elif rule.most is not None:
            out[i], n[i] = int(p[m] - p[i]) - rule.gap, 1
        else:
            out[i], n[i] = FRESH if j == m else int(p[m] - p[i]), 1
    far = min(m, int(rule.fresh(p, 0, 0))) + 1  # a string that comes in holds nothing at least
    return p[:far].tolist(), out[:far], n[:far]


def strings(df: DataFrame, keys: list[str], clip: str, size: str, order: Column, rule: Rule) -> DataFrame:
    """keys, `string` (from 0 in the order of the group), clip, size, `at` (where the clip begins in its string).

    Clips follow each other by `order`, ties by clip; sizes are whole numbers from 0. A null key is
    a key; a group in one range is cut there. An empty table gives no rows."""
    d = df.select(*keys, F.col(clip).alias("_c"), F.col(size).cast("long").alias("_z"), order.alias("_o"))
    t = ranged(d, *keys, "_o", "_c")
    kinds = {f.name: f.dataType.simpleString() for f in t.schema.fields}
    group = ", ".join(f"`{k}` {kinds[k]}" for k in keys)

    def summed(pdf: pd.DataFrame) -> pd.DataFrame:
        p = _sums(pdf.sort_values(["_o", "_c"])["_z"], rule.gap)
        before, out, n = _summary(p, rule)
        return pd.DataFrame({**{k: pdf[k].iloc[:1].values for k in keys}, "_part": [pdf["_part"].iloc[0]], "before": [before], "out": [out], "n": [n], "total": [p[-1]]})

    def followed(pdf: pd.DataFrame) -> pd.DataFrame:
        """What comes into each range of a group, one row a range, and the strings begun before."""
        used, begun, rows = FRESH, 0, []
        for part, before, out, n, total in pdf.sort_values("_part")[["_part", "before", "out", "n", "total"]].itertuples(index=False):
            rows.append((part, used, begun))
            if used != FRESH and rule.open(used, total):
                used += int(total)
                continue
            e = 0 if used == FRESH else int(rule.fresh(np.asarray(before), 0, used))
            used, begun = int(out[e]), begun + int(n[e])
        res = pd.DataFrame(rows, columns=["_part", "used", "begun"])
        for i, k in enumerate(keys):
            res.insert(i, k, [pdf[k].iloc[0]] * len(res))
        return res

    def cut(batches):
        """Rows come group by group in their order; `_r` is 1 where a group or a range begins."""
        used, string = FRESH, -1
        for batch in batches:
            ids, at = [], []
            for r, z, into, begun in zip(*(batch.column(c).to_pylist() for c in ("_r", "_z", "used", "begun"))):
                if r == 1:
                    used, string = into, begun - 1
                if used == FRESH or (rule.most is not None and used + rule.gap + z > rule.most):
                    string, start = string + 1, 0
                else:
                    start = used + (rule.gap if rule.most is not None else 0)
                ids.append(string)
                at.append(start)
                used = start + z + (rule.gap if rule.reach is not None else 0)
                if rule.reach is not None and used >= rule.reach:
                    used = FRESH
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), pa.array(ids, "int64"), batch.column("_c"), batch.column("_z"), pa.array(at, "int64")], names=[*keys, "string", "clip", "size", "at"])

    # Only a group that lies in several ranges is summed up: fewer than there are ranges, so they are broadcast.
    wide = t.groupBy(*keys).agg(F.min("_part").alias("_p0"), F.max("_part").alias("_p1")).where("_p0 < _p1").drop("_p0", "_p1")
    pieces = t.join(F.broadcast(wide), [t[k].eqNullSafe(wide[k]) for k in keys], "left_semi")
    sums = pieces.groupBy(*keys, "_part").applyInPandas(summed, f"{group}, _part int, before array<bigint>, out array<bigint>, n array<bigint>, total bigint")
    into = sums.groupBy(*keys).applyInPandas(followed, f"{group}, _part int, used bigint, begun bigint")  # a row per range
    same = [t[k].eqNullSafe(into[k]) for k in keys]
    met = t.join(F.broadcast(into), [t["_part"] == into["_part"], *same], "left").select(
        *[t[k] for k in keys], t["_part"], "_c", "_z", "_o", F.coalesce("used", F.lit(FRESH).cast("long")).alias("used"), F.coalesce("begun", F.lit(0).cast("long")).alias("begun"))
    place = Window.partitionBy(*keys, "_part").orderBy("_o", "_c")
    ordered = met.withColumn("_r", F.row_number().over(place)).sortWithinPartitions(*keys, "_part", "_o", "_c").drop("_part", "_o")
    out = ordered.mapInArrow(cut, f"{group}, string bigint, clip {kinds['_c']}, size bigint, at bigint")
    return out.withColumnRenamed("clip", clip).withColumnRenamed("size", size)


def pack_short(df: DataFrame, keys: list[str], clip: str, size: str, order: Column, n: int, gap: int, least: float = 0.35) -> DataFrame:
    """Clips of a group put into strings of at most n samples, each used once in the drawn order;
    longer clips are cut to n; a string below the share `least` is dropped unless it holds the
    whole group: keys, `string`, clip, at. Groups may be of any size."""
    s = strings(df.withColumn(size, F.least(F.col(size).cast("long"), F.lit(n))), keys, clip, size, order, Rule(gap, most=n))
    whole = s.groupBy(*keys).agg(F.max("string").alias("_last")).withColumnsRenamed({k: f"_k{k}" for k in keys})
    s = s.join(whole, [F.col(k).eqNullSafe(F.col(f"_k{k}")) for k in keys])
    fill = F.max(F.col("at") + F.col(size)).over(Window.partitionBy(*keys, "string"))
    return s.withColumn("_f", fill).where((F.col("_f") >= least * n) | (F.col("_last") == 0)).select(*keys, "string", clip, "at")


def chunk_clips(df: DataFrame, keys: list[str], clip: str, size: str, order: Column, reach: int, gap: int, least: int) -> DataFrame:
    """Clips of a speaker put into strings that end with the clip that brings them to `reach`, a gap
    after each clip included; clips shorter than `least` are left out, and so is what remains behind
    the last full string: keys, `string`, clip, at. Groups may be of any size."""
    s = strings(df.where(F.col(size) >= least), keys, clip, size, order, Rule(gap, reach=reach))
    full = F.sum(F.col(size) + gap).over(Window.partitionBy(*keys, "string"))
    return s.withColumn("_f", full).where(F.col("_f") >= reach).select(*keys, "string", clip, "at")
