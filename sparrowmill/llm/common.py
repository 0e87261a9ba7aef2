"""Helpers shared by the training-data operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.functions.shared import materialise, shared_dir  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(col: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(col, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def utf8(col: str = "text") -> Column:
    """A text as bytes for Arrow; null counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary").alias(col)


def salts(spark: SparkSession) -> int:
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str, salt: str, n: int, how: str = "inner") -> DataFrame:
    """Join of `left` to `right`, which holds one row per key and in `weight` the number of
    left rows of that key. Keys heavier than n/(4*salts) are dealt over all salts on the
    left and repeated on the right; there are at most 4*salts of them, so the list of heavy
    keys that is broadcast has a proven bound. `right` is read twice and should be a written
    table; `salt` must tell rows of a key apart. `how` may be inner or left."""
    s = salts(left.sparkSession)
    limit = max(1000, n // (4 * s))
    heavy = right.where(F.col(weight) > limit).select(*keys, F.lit(True).alias("_heavy"))
    left = left.join(F.broadcast(heavy), keys, "left").withColumn(
        "_salt", F.when(F.col("_heavy"), F.pmod(F.xxhash64(salt), F.lit(s))).otherwise(F.lit(0)).cast("int")
    ).drop("_heavy")
    right = right.withColumn(
        "_salt", F.explode(F.when(F.col(weight) > limit, F.sequence(F.lit(0), F.lit(s - 1))).otherwise(F.array(F.lit(0))))
    )
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def bounded(rows: DataFrame, most: int) -> DataFrame:
    """`rows`, written, or a sample of about `most` of them by hash of their number."""
    t = materialise(rows.withColumn("_n", F.monotonically_increasing_id()), "bounded")
    n = t.count()
    return (t if n <= most else t.where(F.pmod(F.xxhash64("_n"), F.lit(1_000_000)) < int(1e6 * most / n))).drop("_n")


_MARK = {"row_number_of": "sparrowmill"}


def numbered(df: DataFrame, name: str = "_row_key") -> tuple[DataFrame, str]:
    """`df` with a number of its own for each row, and the column's name. A column that this function
    made is known by its metadata and kept, also in a table that was written and read; any other
    column is the user's, whatever its name, and the number gets a name that is free. The numbers
    are written once, so that every reader sees the same."""
    for f in df.schema.fields:
        if f.metadata == _MARK:
            return df, f.name
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return materialise(df.withColumn(name, F.monotonically_increasing_id().alias(name, metadata=_MARK)), "keyed"), name
