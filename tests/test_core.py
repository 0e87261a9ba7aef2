import duckdb
import numpy as np
import pytest

from sparrowmill.plans import features, leakage, more, speech  # noqa: F401
from sparrowmill.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings conversations labels pages".split()


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(round(r[i], 5) if isinstance(r[i], float) else str(r[i]) for i in order) for r in values), key=str)


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, name):
    f, sql = QUERIES[name]
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = f(spark, SF)
    want = con.sql(sql)
    assert rows(got.columns, got.collect()) == rows(want.columns, want.fetchall())


def test_draws_do_not_depend_on_partitions(spark):
    from pyspark.sql import functions as F

    from sparrowmill.functions.keyed import hash_split, keyed_u

    make = lambda n: {tuple(r) for r in spark.range(500).repartition(n).select("id", keyed_u(1, F.col("id"), "a"), hash_split(F.col("id"))).collect()}
    assert make(1) == make(7)


def test_media_and_sinks(spark, tmp_path):
    import struct
    import wave

    from sparrowmill.sources import files

    (tmp_path / "in" / "a").mkdir(parents=True)
    with wave.open(str(tmp_path / "in" / "a" / "x.wav"), "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(2)
        w.setframerate(16000)
        w.writeframes(struct.pack("<hh", 16384, 0) * 16000)
    (tmp_path / "in" / "bad.wav").write_bytes(b"junk")
    found = files.scan_media(spark, str(tmp_path / "in"))
    got = {r.path.rsplit("/", 1)[1]: r for r in files.probe_media(found).collect()}
    assert (got["x.wav"].frames, got["x.wav"].rate, got["x.wav"].seconds, got["bad.wav"].frames) == (16000, 16000, 1.0, None)
    cut = {r.path.rsplit("/", 1)[1]: r.samples for r in files.decode_media(found, 8000, 0.25, 0.75).collect()}
    assert len(cut["x.wav"]) == 4000 and np.allclose(cut["x.wav"][100:-100], 0.25, atol=1e-4) and cut["bad.wav"] is None
    files.write_frozen(spark.range(3), str(tmp_path / "set"))
    with pytest.raises(Exception):
        files.write_frozen(spark.range(3), str(tmp_path / "set"))
    with pytest.raises(ValueError):
        files.read_manifest(spark, str(tmp_path / "set"), ["id", "split"])


def test_segments_of_a_stream_equal_the_batch(spark, tmp_path):
    from pyspark.sql import functions as F

    from sparrowmill.streaming import events

    src = spark.read.parquet(f"{SF}/events.parquet").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    end = src.agg(F.max("ts")).first()[0]
    src.write.parquet(str(tmp_path / "a"))
    late = src.select(F.lit(-1).cast("long").alias("user_id"), (F.lit(end) + F.expr("interval 3 days")).alias("ts")).limit(1)
    stream = spark.readStream.schema(src.schema).parquet(str(tmp_path / "a"))
    q = events.segments(stream, "user_id", "ts", "30 minutes").writeStream.format("memory").queryName("seg").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    late.write.mode("append").parquet(str(tmp_path / "a"))
    q.processAllAvailable()
    q.stop()
    want = {tuple(r) for r in events.segments(src, "user_id", "ts", "30 minutes").collect()}
    assert {tuple(r) for r in spark.table("seg").collect() if r.user_id >= 0} == want


@pytest.fixture
def ranges(spark):
    """Keeps small ranges apart, so that offsets between them count."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_numbers_over_four_digits_are_not_cut(spark, ranges):
    from pyspark.sql import functions as F

    from sparrowmill.operators import aggs

    n = 10_050
    df = spark.range(n).select(F.when(F.col("id") < n - 3, "hot").when(F.col("id") < n - 1, "b").alias("source"), (F.lit(n) - F.col("id")).alias("doc_id"), F.lit("x").alias("kept")).repartition(7)
    out = aggs.number_in(df, "source", "doc_id")
    got = {r.doc_id: r.name for r in out.collect()}
    want = {n - i: f"hot_{n - i - 3:04d}" for i in range(n - 3)} | {3: "b_0002", 2: "b_0001", 1: None}
    assert got == want and out.columns == ["source", "doc_id", "kept", "name"]
    twice = aggs.number_in(df.where("source = 'b'").select("source", F.lit(1).alias("doc_id")), "source", "doc_id")
    assert sorted(r.name for r in twice.collect()) == ["b_0001", "b_0002"]


def test_quantiles_rank_over_ranges(spark, ranges):
    import numpy as np
    from pyspark.sql import functions as F

    from sparrowmill.operators import aggs

    ps = [0.0, 0.02, 0.5, 0.77, 1.0]
    df = spark.range(3001).select(F.when(F.col("id") % 3 == 0, 7.5).otherwise((F.col("id") * 7919 % 1009).cast("double")).alias("x")).union(spark.sql("select cast(null as double)"))
    got = aggs.quantiles(df, "x", ps)
    x = [r.x for r in df.collect() if r.x is not None]
    assert list(got.first()) == pytest.approx(list(np.quantile(x, ps)))
    plan = got._jdf.queryExecution().toString()
    assert "percentile" not in plan
    assert list(aggs.quantiles(df.limit(0), "x", ps).first()) == [None] * 5
