"""Transcript text: tokens, loops, keywords. Word errors are in `scores`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(c), F.lit(r"[a-z0-9']+|[,.?!]"), F.lit(0))


def clean_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[_/|-]+", " "), " +", " "))


def keyword_hits(toks: Column, vocab: list[str]) -> Column:
    return F.size(F.filter(toks, lambda t: t.isin(vocab)))


def longest_run(df: DataFrame, keys: list[str], text: str) -> DataFrame:
    """Longest run of one repeated token: one pass over each token array, no shuffle. Texts without tokens have no row."""
    def step(s, t):
        run = F.when(t == s["last"], s["run"] + 1).otherwise(F.lit(1))
        return F.struct(t.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))
    zero = F.struct(F.lit("").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))  # no token is empty
    return df.select(*keys, F.aggregate(tokens(F.col(text)), zero, step, lambda s: s["best"].cast("long")).alias("longest_run")).where("longest_run > 0")


def grounded(value: Column, text: Column) -> Column:
    """Every word of the value occurs in the text."""
    return F.forall(tokens(value), lambda w: F.array_contains(tokens(text), w))
