"""Values that several fields read are worked out once: long transcripts and plans of bounded size."""

import io
import time
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from sparrowmill.llm import license_scan
from sparrowmill.operators import radio

LONG = "Bravo two six, this is alpha one, contact left, grade wun two tree fower, " + "go to the rally point, " * 4000 + "over"


@pytest.fixture()
def quick():
    start = time.time()
    yield
    assert time.time() - start < 60


def _plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_numerals_of_a_long_text(spark, quick):
    df = spark.createDataFrame([(i, t) for i, t in enumerate([LONG, "one\ntwo, three", "", ", four", None, "fire one fire"] * 3)], "i int, t string")
    got = [r.n for r in df.select("i", radio.normalise_numerals(F.col("t")).alias("n")).orderBy("i").collect()]
    assert got[:6] == got[6:12] and got[0].startswith("bravo 26, this is alpha 1, contact left, grid 1234, go to") and got[1:6] == ["123", "", ", 4", "", "fire 15"]


def test_extraction_of_a_long_text(spark, quick):
    r = radio.with_extraction(spark.createDataFrame([(LONG,)], "t string"), "t").first()
    assert (r.receiver, r.sender, r.grids, r.contact, r.direction, r.closing) == ("B26", "A1", ["1234"], True, "left", "over")


def test_grounding_of_many_words(spark, quick):
    df = spark.createDataFrame([("rally " * 300 + "1234", LONG), ("rally 999", LONG)], "v string, t string")
    assert [r.ok for r in df.select(radio.grounded(F.col("v"), F.col("t")).alias("ok")).collect()] == [True, False]


def test_markers_work_out_kind_and_place_once(spark):
    df = spark.createDataFrame([("x", 1, LONG, [("wun", 0.5), ("two", 0.5), ("tree", 0.5), ("fower", 0.7)])], "id string, ts int, t string, words array<struct<w string, p double>>")
    marks = radio.markers(radio.with_extraction(df, "t"), "id", "ts", "words")
    m = marks.first()
    assert (m.kind, m.label, m.half_m, m.confirmed) == ("enemy", "UNCONFIRMED Enemy", 500, False) and m.confidence == pytest.approx(0.55)
    assert _plan(marks).count("regexp_extract_all(") <= 8


def test_enrichment_reads_the_normalised_text_once(spark, quick):
    df = radio.with_extraction(spark.createDataFrame([(LONG,)], "t string"), "t").withColumns({f: F.lit(v) for f, v in (("enemy_size", "rally point " * 200), ("grid_digits", "1234"), ("direction_said", "left"), ("sender_said", "alpha two"))})
    r = radio.enrich(df, ["enemy_size", "grid_digits", "direction_said", "sender_said"], "t").first()
    assert r.kept == ["direction_said", "enemy_size", "grid_digits"] and r.dropped == ["sender_said"] and "_forms" not in r.asDict()


def test_places_by_a_plan_of_bounded_size(spark):
    df = spark.range(1).select(radio.grid_to_latlon(F.lpad(F.col("id").cast("string"), 4, "0")).alias("p"))
    assert _plan(df.select("p.lat", "p.lon")).count("SIN(") < 30


def test_licence_scan_reads_the_texts_once_for_all_its_joins(spark):
    files = spark.createDataFrame([(1, "/a/LICENSE", "MIT License"), (2, "/a/b/x.txt", "plain words"), (3, "/c/y.txt", "Released under the MIT License."), (4, None, None)], "file_id int, path string, text string")
    out = license_scan.scan_licences(files)
    assert {r.file_id: (r.own, r.licence, r.inherited_from) for r in out.collect()} == {1: ("MIT", "MIT", None), 2: (None, "MIT", "/a"), 3: ("MIT", "MIT", None), 4: (None, None, None)}
    plan = _plan(out)
    assert "Scan ExistingRDD" not in plan and plan.count("Exchange") <= 16
