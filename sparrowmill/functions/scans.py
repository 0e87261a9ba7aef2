"""Ordered scans of a key's rows that are dealt over range partitions: no task needs a whole key.

Rows are cut into ranges of (key, order). Each range gives one summary per key it holds (a sum,
its first or last row, its last known value); summaries are scanned in the order of ranges and
handed to the rows of the next range. A key in one range costs one summary; a key that holds
a third of all rows costs one per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """Rows in the shared folder with `_part`, the number of their range in `order`."""
    return materialise(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranged")


def ranged_in(df: DataFrame, n: int, *order: str) -> DataFrame:
    """The same in n ranges, however small they are: for tasks that hold a range in memory."""
    return materialise(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranged")


def scan(df: DataFrame, key: str, order: list[str], sums: dict[str, Column] | None = None, lag: dict[str, Column] | None = None,
         lead: dict[str, Column] | None = None, last: dict[str, Column] | None = None) -> DataFrame:
    """Adds columns over the rows of a key in ascending `order` (nulls first): running `sums` up
    to and with a row (null counts as zero), `lag` and `lead` of the neighbouring row, and `last`,
    the last value before a row that is not null. Rows of equal order follow each other in one
    arbitrary order that all columns share. A null key is a key; an empty table stays empty."""
    sums, lag, lead, last = sums or {}, lag or {}, lead or {}, last or {}
    exprs = {f"_x{i}": e for i, e in enumerate([*sums.values(), *lag.values(), *lead.values(), *last.values()])}
    names = iter(exprs)
    s, g, d, k = ({n: next(names) for n in group} for group in (sums, lag, lead, last))
    t = ranged(df.withColumns(exprs).withColumn("_row", F.monotonically_increasing_id()), key, *order, "_row")
    t = t.withColumn("_key", F.struct(key))  # never null, and equal where keys are null: one shuffle serves windows and join
    place = F.struct(*order, "_row")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))

    ahead = Window.partitionBy("_key").orderBy("_part")  # a row per range of a key
    before = ahead.rowsBetween(Window.unboundedPreceding, -1)
    parts = t.groupBy("_part", "_key").agg(
        *[F.sum(zero(c)).alias(c) for c in s.values()], *[F.max_by(F.struct(c), place).alias(c) for c in g.values()],
        *[F.min_by(F.struct(c), place).alias(c) for c in d.values()], *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(c) for c in k.values()])
    carry = parts.select(
        "_part", "_key", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_c{c}") for c in s.values()],
        *[F.lag(c).over(ahead).alias(f"_c{c}") for c in g.values()], *[F.lead(c).over(ahead).alias(f"_c{c}") for c in d.values()],
        *[F.last(c, ignorenulls=True).over(before).alias(f"_c{c}") for c in k.values()])

    own = Window.partitionBy("_part", "_key").orderBy(*order, "_row")  # within a range
    upto, prior = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(Window.unboundedPreceding, -1)
    near = {c: F.lag(F.struct(c)).over(own) for c in g.values()} | {c: F.lead(F.struct(c)).over(own) for c in d.values()}
    inside = {c: F.sum(zero(c)).over(upto) for c in s.values()} | near | {c: F.last(c, ignorenulls=True).over(prior) for c in k.values()}
    t = t.select(*df.columns, "_part", "_key", *[e.alias(f"_i{c}") for c, e in inside.items()])
    t = t.join(carry, ["_part", "_key"])
    both = lambda c: F.coalesce(f"_i{c}", f"_c{c}")
    return t.select(*df.columns, *[(F.col(f"_i{c}") + F.col(f"_c{c}")).alias(n) for n, c in s.items()],
                    *[both(c)[c].alias(n) for n, c in [*g.items(), *d.items()]], *[both(c).alias(n) for n, c in k.items()])
