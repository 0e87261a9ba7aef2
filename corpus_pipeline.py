"""The corpus pipeline: each stage works on all that the one before kept.

Rows are judged one by one by a number of their own, so null, repeated and shared ids change
nothing; null text counts as empty (no words, never toxic, one exact group); an empty table
stays empty; extra columns are carried, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparrowmill.llm.bpe import encode_decode
from sparrowmill.llm.common import materialise, numbered, table
from sparrowmill.llm.decontaminate import decontaminate
from sparrowmill.llm.exact_dedup import exact_dedup
from sparrowmill.llm.jaccard_join import jaccard_join
from sparrowmill.llm.toxicity import score_toxicity


# Ids may be null, repeated or shared by different texts, so stages judge rows by a number
# (`numbered`), which the first stage writes and the later ones carry.


def _without(docs: DataFrame, key: str, bad: DataFrame) -> DataFrame:
    return docs.join(bad.select(key), key, "left_anti").select(docs.columns)


def _by_key(docs: DataFrame, key: str) -> DataFrame:
    """The key in the place of the id, for operators that look at nothing else of a row."""
    return docs.select(F.col(key).alias("doc_id"), "text")


def _plain(docs: DataFrame, key: str) -> DataFrame:
    """What an operator that takes a key needs of a row."""
    return docs.select("doc_id", "text", key)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar predicts as toxic go; without usable labels none does."""
    docs, key = numbered(docs)
    return _without(docs, key, score_toxicity(_plain(docs, key), table(spark, sf_dir, "labels"), key=key).where("predicted = 1"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text (equal but for A-Z) stays: one with the largest id, the largest key among equal ids."""
    docs, key = numbered(docs)
    return _without(docs, key, exact_dedup(_plain(docs, key), key=key).where("not kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the largest id of each class stays, the largest key among equal ids. Texts without words are alone."""
    docs, key = numbered(docs)
    classes = jaccard_join(_by_key(docs, key)).select(F.col("doc_id").alias(key), "class_id")
    members = materialise(classes.join(docs.select(key, F.col("doc_id").alias("_id")), key), "members")
    heads = members.groupBy("class_id").agg(F.max(F.struct("_id", key)).alias("m")).select(f"m.{key}")
    return _without(docs, key, members.join(heads, key, "left_anti"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark windows go; an empty benchmark removes none."""
    docs, key = numbered(docs)
    return _without(docs, key, decontaminate(_by_key(docs, key), table(spark, sf_dir, "benchmark")).where("contaminated").withColumnRenamed("doc_id", key))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left; a null id stays null."""
    import public_tokenizers

    return encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("decontaminate", decontaminate_stage),
    ("bpe", tokens_stage),
]

#: Scores, near copies and tokens are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
