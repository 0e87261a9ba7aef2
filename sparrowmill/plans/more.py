"""Registered queries of filters, sources and streams (batch form)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparrowmill.functions import keyed
from sparrowmill.functions.shared import shared_dir
from sparrowmill.operators import filters, radio
from sparrowmill.plans.registry import SEC, U, query, read, simple, split_sql
from sparrowmill.sources import files
from sparrowmill.streaming import events, stateful

C = F.col
ROLES = {"click": "near", "view": "near", "purchase": "far"}
DIGITS = [{"1": "one", "2": "two", "3": "three"}, {"0": "zero", "1": "one", "2": "two", "5": "five"}]

simple("p2_code_to_words", """SELECT p_partkey, CASE WHEN length(c) = 2 THEN a || ' ' || b END AS words FROM (SELECT p_partkey, substr(p_brand, 7) AS c,
  CASE substr(p_brand, 7, 1) WHEN '1' THEN 'one' WHEN '2' THEN 'two' WHEN '3' THEN 'three' END AS a,
  CASE substr(p_brand, 8, 1) WHEN '0' THEN 'zero' WHEN '1' THEN 'one' WHEN '2' THEN 'two' WHEN '5' THEN 'five' END AS b FROM part)""", "part")(
    lambda d: d.select("p_partkey", filters.code_to_words(F.substring("p_brand", 7, 10), DIGITS).alias("words")))
simple("p3_map_role", "SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'far' ELSE 'near' END AS role FROM events WHERE event_type IN ('click', 'view', 'purchase')", "events")(
    lambda d: filters.map_role(d, "event_type", ROLES).select("event_id", "role"))
simple("p5_first_match", "SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'offer' WHEN p_type LIKE '%AN%' THEN 'an' WHEN p_type LIKE '%E%' THEN 'e' ELSE 'other' END AS label FROM part", "part")(
    lambda d: d.select("p_partkey", filters.first_match(C("p_type"), {"PROMO": "offer"}, [("AN", "an"), ("E", "e")], "other").alias("label")))
simple("p7_min_duration", "SELECT doc_id FROM documents WHERE NOT coalesce(n_chars < CASE lang WHEN 'en' THEN 500 WHEN 'de' THEN 1000 END, false)", "documents")(
    lambda d: filters.min_duration(d.select("doc_id", "lang", "n_chars"), "lang", "n_chars", {"en": 500, "de": 1000}).select("doc_id"))
simple("p11_holdout_only", "SELECT doc_id FROM documents WHERE source = 'src3'", "documents")(
    lambda d: filters.holdout_filter(d, keyed.hash_split(C("doc_id")), "train", "only", "source", "src3").select("doc_id"))
simple("p11_holdout_exclude", f"SELECT doc_id FROM documents WHERE {split_sql('doc_id')} = 'train' AND source IS DISTINCT FROM 'src3'", "documents")(
    lambda d: filters.holdout_filter(d, keyed.hash_split(C("doc_id")), "train", "exclude", "source", "src3").select("doc_id"))
simple("p12_split_mask", f"SELECT doc_id FROM documents WHERE {split_sql('doc_id')} IN ('val', 'test')", "documents")(
    lambda d: d.where(filters.split_mask(keyed.hash_split(C("doc_id")), "heldout")).select("doc_id"))
simple("p19_sample_weight", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 2.0::DOUBLE WHEN 'P' THEN 3.0 ELSE 1.0 END AS weight FROM orders", "orders")(
    lambda d: d.select("o_orderkey", F.coalesce(filters.lookup(C("o_orderstatus"), {"F": 2.0, "P": 3.0}), F.lit(1.0)).alias("weight")))
simple("d3_weighted_draw", f"SELECT o_orderkey, CASE WHEN u < 0.25 THEN 'a' WHEN u < 0.75 THEN 'b' ELSE 'c' END AS pick FROM (SELECT o_orderkey, {U} AS u FROM orders)", "orders")(
    lambda d: d.select("o_orderkey", filters.weighted_draw(keyed.keyed_u(7, C("o_orderkey"), "snr"), {"a": 1.0, "b": 2.0, "c": 1.0}).alias("pick")))
simple("d9_schedule", "SELECT o_orderkey, CASE WHEN o_orderkey < 100 THEN 'easy' WHEN o_orderkey < 1000 THEN 'mid' ELSE 'hard' END AS stage FROM orders", "orders")(
    lambda d: d.select("o_orderkey", filters.schedule(C("o_orderkey"), [(100, "easy"), (1000, "mid"), (5000, "hard")]).alias("stage")))
simple("d18_coupled", f"SELECT o_orderkey, greatest(0.0, least(1.0, 0.2 + o_totalprice / 400000.0 + 0.1 * (2 * u - 1))) AS strength FROM (SELECT o_orderkey, o_totalprice, {U} AS u FROM orders)", "orders")(
    lambda d: d.select("o_orderkey", filters.coupled(C("o_totalprice"), keyed.keyed_u(7, C("o_orderkey"), "snr"), 0.2, 400000.0, 0.1).alias("strength")))
simple("s9_decode_nested", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events", "events")(
    lambda d: files.decode_nested(d, "props", "k bigint").select("event_id", "props.k"))
simple("s17_relative_path", r"SELECT page_id, regexp_replace(replace(url, '\', '/'), '^https?://[^/]*/', '') AS path FROM pages", "pages")(
    lambda d: d.select("page_id", filters.relative_path(C("url"), "^https?://[^/]*/").alias("path")))
simple("l1_segments", f"""SELECT user_id, epoch_us(min(ts)) AS start, epoch_us(max(ts)) AS stop, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s
  FROM (SELECT *, CASE WHEN {SEC} - lag({SEC}) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 1800 THEN 0 ELSE 1 END AS new FROM events)) GROUP BY user_id, s""", "events")(
    lambda d: events.segments(d.select("user_id", C("ts").cast("timestamp").alias("ts")), "user_id", "ts", "30 minutes").select("user_id", F.unix_micros("start").alias("start"), F.unix_micros("stop").alias("stop"), "n"))
simple("l3_track_units", "SELECT user_id, arg_max(event_id, ts) AS event_id, arg_max(value, ts) AS value FROM events GROUP BY user_id", "events")(
    lambda d: events.track_units(d, "user_id", F.struct("ts", "event_id"), "event_id", "value"))
simple("l5_latest_partial", "SELECT user_id, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id", "events")(
    lambda d: events.latest_partial(d, "user_id", "event_type", F.struct("ts", "event_id")))


_U2 = "(('0x' || substr(sha256(concat_ws(':', '7', CAST(o_orderkey AS VARCHAR), 'second')), 1, 8))::BIGINT / 4294967296.0)"


@simple("d2_more_dists", f"""SELECT o_orderkey, 4.0::DOUBLE AS constant, exp(ln(0.5) + u * (ln(8.0) - ln(0.5))) AS loguni, 3 + 2 * sqrt(-2 * ln(1 - u)) * cos(2 * 3.141592653589793 * u2) AS normal
  FROM (SELECT o_orderkey, {U} AS u, {_U2} AS u2 FROM orders)""", "orders")
def d2_more(d):
    u, u2 = (keyed.keyed_u(7, C("o_orderkey"), s) for s in ("snr", "second"))
    return d.select("o_orderkey", keyed.sample_dist("constant", u, value=4).alias("constant"), keyed.sample_dist("loguniform", u, low=0.5, high=8).alias("loguni"), keyed.sample_dist("normal", u, mean=3, std=2, u2=u2).alias("normal"))


simple("l1_closed_segments", f"""SELECT user_id, epoch_us(min(ts)) AS start, epoch_us(max(ts)) AS stop, count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s
  FROM (SELECT *, CASE WHEN {SEC} - lag({SEC}) OVER w < 7200 AND lag(event_type) OVER w <> 'purchase' THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))) GROUP BY user_id, s HAVING (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 >= 600""", "events")(
    lambda d: events.closed_segments(d.select("user_id", "event_id", "event_type", C("ts").cast("timestamp").alias("ts")), "user_id", "ts", ["event_id"], 7200, C("event_type") == "purchase", 600).select("user_id", F.unix_micros("start").alias("start"), F.unix_micros("stop").alias("stop"), "n"))


@query("p9_validate_rows", """SELECT doc_id, array_to_string(list_filter([CASE WHEN lang = 'en' AND quality IS NULL THEN 'untested' END, CASE WHEN toxic = 1 THEN 'flagged' END], lambda v: v IS NOT NULL), ',') AS bad
  FROM documents LEFT JOIN labels USING (doc_id)""")
def p9(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "lang").join(read(spark, sf, "labels"), "doc_id", "left")
    return filters.violations(d, {"untested": (C("lang") == "en") & C("quality").isNull(), "flagged": C("toxic") == 1}).select("doc_id", F.array_join("violations", ",").alias("bad"))


@query("p13_apply_allowlist", "SELECT doc_id, coalesce(toxic = 1, false) AND coalesce(quality, 0) <> 1 AS flagged FROM documents LEFT JOIN labels USING (doc_id)")
def p13(spark, sf):
    lab = read(spark, sf, "labels")
    d = read(spark, sf, "documents").select("doc_id").join(lab.select("doc_id", "toxic"), "doc_id", "left")
    return filters.apply_allowlist(d, lab.where("quality = 1"), "doc_id", C("toxic") == 1).select("doc_id", "flagged")


@query("s14_screen_incremental", "SELECT doc_id, coalesce(toxic, (n_chars > 1000)::INT) AS verdict FROM documents LEFT JOIN (SELECT doc_id, toxic FROM labels WHERE toxic IS NOT NULL) USING (doc_id)")
def s14(spark, sf):
    prior = read(spark, sf, "labels").where("toxic is not null").select("doc_id", C("toxic").alias("verdict"))
    d = read(spark, sf, "documents").select("doc_id", "n_chars")
    return files.screen_incremental(d, prior, "doc_id", lambda t: t.withColumn("verdict", (C("n_chars") > 1000).cast("int")))


@query("p6_counted_dim", "SELECT c_nationkey, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2")
def p6_counted(spark, sf):
    """Aggregated before the join, so the dimension meets one row per key."""
    n = read(spark, sf, "customer").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return n.join(read(spark, sf, "nation"), C("c_nationkey") == C("n_nationkey")).select("c_nationkey", "n_name", "n")




# Hops of a receiver: the squelch line is open on views and clicks, a hop lasts for 20 ms and more.
_HOPS = f"(SELECT user_id, event_id, epoch_us(ts) // 1000 AS ms, 20 + (event_id % 7) * 15 AS dur, event_type IN ('click', 'view') AS sq, event_type = 'purchase' AS early FROM events)"
_SIL = "sum(dur) OVER (PARTITION BY user_id, a ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING) - max(CASE WHEN sq THEN dur ELSE 0 END) OVER (PARTITION BY user_id, a)"


def _transmissions_sql(hang: str) -> str:
    return f"""WITH h AS (SELECT *, sum(sq::INT) OVER w AS a, sum(dur) OVER w AS t, row_number() OVER w AS i FROM {_HOPS} WINDOW w AS (PARTITION BY user_id ORDER BY ms, event_id ROWS UNBOUNDED PRECEDING)),
  s AS (SELECT *, {_SIL} AS silence FROM h WHERE a > 0),
  r AS (SELECT user_id, a, min(ms) FILTER (WHERE sq) AS start, min(t - dur) FILTER (WHERE sq) AS t0, min(i) FILTER (WHERE sq) AS i0, arg_min(ms + dur, i) FILTER (WHERE NOT sq AND silence >= {hang}) AS stop,
    arg_min(t, i) FILTER (WHERE NOT sq AND silence >= {hang}) AS t1, min(i) FILTER (WHERE NOT sq AND silence >= {hang}) AS i1 FROM s GROUP BY user_id, a),
  g AS (SELECT *, coalesce(sum((i1 IS NOT NULL)::INT) OVER (PARTITION BY user_id ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM r)
  SELECT user_id, arg_min(start, a) AS start, max(stop) AS stop, max(t1) - min(t0) AS dur, max(i1) - min(i0) + 1 AS n FROM g GROUP BY user_id, seg HAVING max(i1) IS NOT NULL AND max(t1) - min(t0) >= 500"""


def _hops(d):
    return d.select("user_id", "event_id", F.unix_millis(C("ts").cast("timestamp")).alias("ms"), (20 + C("event_id") % 7 * 15).alias("dur"), C("event_type").isin("click", "view").alias("sq"), (C("event_type") == "purchase").alias("early"))


simple("l1_squelch_transmissions", _transmissions_sql("100"), "events")(lambda d: stateful.transmissions(_hops(d), "user_id", "ms", ["event_id"], C("sq"), F.lit(100), "dur"))
simple("l1_level_transmissions", _transmissions_sql("CASE WHEN early THEN 100 ELSE 250 END"), "events")(
    lambda d: stateful.transmissions(_hops(d), "user_id", "ms", ["event_id"], C("sq"), F.when(C("early"), 100).otherwise(250), "dur"))


# Files that are written from the tables and read back.
@query("s6_meta_lines", "SELECT event_id, event_type, value FROM events")
def s6(spark, sf):
    path = shared_dir(spark) + "-meta"
    read(spark, sf, "events").select("event_id", "event_type", "value").write.json(path)
    return files.read_meta(spark, path, "event_id bigint, event_type string, value double")


@query("s7_manifest", "SELECT doc_id, lang, source FROM documents")
def s7(spark, sf):
    path = shared_dir(spark) + "-manifest"
    files.write_manifest(read(spark, sf, "documents").select("doc_id", "lang", "source"), path)
    return files.read_manifest(spark, path, ["doc_id", "lang"])


@query("s4_label_csv", "SELECT 'f' || event_id AS file, event_type AS cls, value AS a, user_id::DOUBLE AS b FROM events")
def s4_csv(spark, sf):
    path = shared_dir(spark) + "-labels"
    e = read(spark, sf, "events")
    e.select(F.concat(F.lit("f"), "event_id").alias("name"), C("event_type").alias("kind"), F.concat(F.lit("[ "), "value", F.lit(", "), "user_id", F.lit("]")).alias("r")).write.option("header", True).csv(path)
    labels = files.scan_label_csv(spark, path, "name", {"cls": "kind", "ratings": "r"}, ("ratings",))
    return labels.select("file", "cls", C("ratings")[0].alias("a"), C("ratings")[1].alias("b"))


@query("s8_embedded_audio", "SELECT octet_length(encode(text)) AS n, lang AS speaker, source AS text FROM documents")
def s8(spark, sf):
    rows = read(spark, sf, "documents").select(F.struct(C("text").cast("binary").alias("bytes")).alias("audio"), C("lang").alias("speaker"), C("source").alias("transcript"))
    return files.read_embedded(rows).select(F.octet_length("content").alias("n"), "speaker", "text")


# Latitude and longitude of grids: the inverse series with its coefficients in SQL.
_F = "(1 / 298.257223563)"
_LL = f"""WITH n AS (SELECT {_F} / (2 - {_F}) AS n), k AS (SELECT n, 6378137.0 / (1 + n) * (1 + n^2 / 4 + n^4 / 64) AS a, [n / 2 - 2 * n^2 / 3 + 37 * n^3 / 96, n^2 / 48 + n^3 / 15, 17 * n^3 / 480] AS b, [2 * n - 2 * n^2 / 3 - 2 * n^3, 7 * n^2 / 3 - 8 * n^3 / 5, 56 * n^3 / 15] AS d FROM n),
  g AS (SELECT l_orderkey, l_linenumber, l_partkey, 400000 + (l_partkey % 10000 // 100) * 1000 + 500.0 AS e, 5300000 + (l_partkey % 100) * 1000 + 500.0 AS m FROM lineitem),
  x AS (SELECT g.*, k.*, m / (0.9996 * a) AS xi, (e - 500000.0) / (0.9996 * a) AS eta FROM g, k),
  y AS (SELECT *, xi - b[1] * sin(2 * xi) * cosh(2 * eta) - b[2] * sin(4 * xi) * cosh(4 * eta) - b[3] * sin(6 * xi) * cosh(6 * eta) AS x1, eta - b[1] * cos(2 * xi) * sinh(2 * eta) - b[2] * cos(4 * xi) * sinh(4 * eta) - b[3] * cos(6 * xi) * sinh(6 * eta) AS e1 FROM x),
  z AS (SELECT *, asin(sin(x1) / cosh(e1)) AS chi FROM y)
  SELECT l_orderkey, l_linenumber, l_partkey, round(degrees(chi + d[1] * sin(2 * chi) + d[2] * sin(4 * chi) + d[3] * sin(6 * chi)), 7) AS lat, round(degrees(radians(15) + atan2(sinh(e1), cos(x1))), 7) AS lon FROM z"""


@simple("t6_grid_to_latlon", _LL, "lineitem")
def t6_latlon(d):
    at = radio.grid_to_latlon(F.lpad((C("l_partkey") % 10000).cast("string"), 4, "0"), "33UVP")
    return d.select("l_orderkey", "l_linenumber", "l_partkey", at.alias("p")).select("l_orderkey", "l_linenumber", "l_partkey", F.round("p.lat", 7).alias("lat"), F.round("p.lon", 7).alias("lon"))
