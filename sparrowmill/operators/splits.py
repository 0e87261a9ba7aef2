"""Split assignment beyond the hash split: folds, time windows, tails, forced splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .filters import lookup


def fold_split(fold: Column, splits: dict[int, str]) -> Column:
    """Split of an official fold; a fold without one, null included, raises."""
    name = lookup(fold, splits)
    return F.when(name.isNotNull(), name).otherwise(F.raise_error(F.concat(F.lit("no split for fold "), F.coalesce(fold.cast("string"), F.lit("null")))).cast("string"))


def time_split(df: DataFrame, length: Column, windows: list[tuple[str, float, float]]) -> DataFrame:
    """A row per window of a recording (split, start_s, end_s), clamped to its length; windows beyond it are left out."""
    parts = F.array(*[F.struct(F.lit(s).alias("split"), F.lit(float(a)).alias("start_s"), F.least(F.lit(float(b)), length.cast("double")).alias("end_s")) for s, a, b in windows])
    return df.withColumn("_w", F.explode(parts)).select(*df.columns, "_w.split", "_w.start_s", "_w.end_s").where("end_s > start_s")


def tail_split(df: DataFrame, group: str) -> DataFrame:
    """For few groups: the last one is test, the second last val if there are three or more. The
    three last groups, a row of the plan, are all that the split needs to know."""
    last = df.select(group).where(F.col(group).isNotNull()).distinct().orderBy(F.desc(group)).limit(3)
    top = last.agg(F.sort_array(F.collect_list(group), asc=False).alias("_t"))
    name = F.when(F.col(group) == F.get("_t", F.lit(0)), "test").when((F.col(group) == F.get("_t", F.lit(1))) & (F.size("_t") == 3), "val").when(F.col(group).isNotNull(), "train")
    return df.crossJoin(F.broadcast(top)).withColumn("split", name).drop("_t")  # one row


def force_split(split: Column, eval_only: Column, official: Column | None = None) -> Column:
    """Test for sources that are for evaluation only and for official evaluation files."""
    forced = F.coalesce(eval_only, F.lit(False))
    if official is not None:
        forced = forced | F.coalesce(official, F.lit(False))
    return F.when(forced, "test").otherwise(split)
