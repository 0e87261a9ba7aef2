"""The stages on null, repeated and conflicting ids."""
import random

import pytest

from pyspark.sql import functions as F

import corpus_pipeline
from sparrowmill.llm import exact_dedup

R = random.Random(5)
WORDS = ["".join(R.choices("abcdefgh", k=5)) for _ in range(300)]


def prose(n):
    return " ".join(R.choices(WORDS, k=n))


BASE, ITEM = prose(80), prose(15)
NEAR = BASE.rsplit(" ", 1)[0] + " changed"
CLEAN = [prose(30) for _ in range(6)]
TOXIC, LEAK = "you are a blorf blorf", ITEM + " " + prose(20)
TRAIN = [(1000 + i, f"you are a blorf blorf {prose(2)}" if i % 2 else prose(8)) for i in range(120)]


def run(spark, tmp_path, stage, rows):
    spark.createDataFrame([(i, 0, int("blorf" in t)) for i, t in TRAIN], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id bigint, text string, source string").repartition(3)
    out = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


@pytest.mark.parametrize("stage, bad", [("toxicity", TOXIC), ("decontaminate", LEAK)])
def test_rows_are_judged_one_by_one(spark, tmp_path, stage, bad):
    extra = TRAIN if stage == "toxicity" else []
    rows = [(None, bad), (None, CLEAN[0]), (7, bad), (7, CLEAN[1]), (8, CLEAN[2]), (8, CLEAN[2]), (9, bad), (9, bad), (10, None)]
    want = [(i, t) for i, t in rows + extra if t != bad and "blorf" not in (t or "")]
    assert run(spark, tmp_path, stage, rows + extra) == sorted(want, key=str)


@pytest.mark.parametrize("stage", ["exact_dedup", "jaccard_join"])
def test_one_row_of_a_group_stays(spark, tmp_path, stage):
    near = stage == "jaccard_join"
    rows = [(None, BASE), (3, BASE), (4, NEAR if near else BASE.upper()), (4, NEAR if near else BASE.upper()), (4, CLEAN[0]), (5, CLEAN[1]), (5, CLEAN[1]), (None, CLEAN[2]), (None, CLEAN[2]), (6, CLEAN[3]), (6, CLEAN[4])]
    want = [(4, rows[2][1]), (4, CLEAN[0]), (5, CLEAN[1]), (None, CLEAN[2]), (6, CLEAN[3]), (6, CLEAN[4])]
    assert run(spark, tmp_path, stage, rows) == sorted(want, key=str)


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    rows = [(None, "a"), (None, "A"), (1, "b"), (1, "b"), (2, "c"), (2, "d"), (None, "c"), (3, None), (3, "")]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).where("kept").collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "3", "None"] and all(r.doc_id == r.keep_id for r in got)


@pytest.mark.parametrize("value", [0, None])
def test_a_column_named_as_the_row_number_changes_nothing(spark, tmp_path, value):
    docs = spark.createDataFrame([(1, "same text"), (2, "SAME text"), (3, "other"), (4, "same text")], "doc_id bigint, text string")
    clash = docs.withColumn("_row_key", F.lit(value).cast("bigint"))
    (tmp_path / "sf").mkdir()
    kept = lambda d: sorted(r.doc_id for r in corpus_pipeline.exact_stage(spark, d, str(tmp_path / "sf")).collect())
    assert kept(docs) == kept(clash) == [3, 4]
    once = corpus_pipeline.exact_stage(spark, clash, str(tmp_path / "sf"))
    once.write.parquet(str(tmp_path / "stage"))
    again = spark.read.parquet(str(tmp_path / "stage"))  # as the next stage reads it
    assert "_row_key" in again.columns and kept(again) == [3, 4] and kept(again.unionByName(again.limit(0))) == [3, 4]
    assert {c for c in again.columns if c.startswith("_row_key")} == {"_row_key", "_row_key_"}
