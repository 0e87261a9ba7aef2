"""Registered queries of signal features, scores, intervals and draws."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparrowmill.functions import keyed
from sparrowmill.operators import acoustic, aggs, packing, scores, signals, spans
from sparrowmill.plans.leakage import doubles
from sparrowmill.plans.registry import U, query, read, simple, u_sql

C = F.col
_X = "list_transform(embedding, lambda v: v::DOUBLE)"
_E = "(SELECT vec_id, list_transform(embedding, lambda v: v::DOUBLE) AS x FROM embeddings)"
_SQ = "list_sum(list_transform({0}, lambda v: v * v))"
_RMS = f"sqrt({_SQ} / len({{0}}))"
_PEAK = "list_max(list_transform({0}, lambda v: abs(v)))"
#: Levels of the eight frames of eight samples, and the mean of the loudest half.
_F = f"(SELECT vec_id, x, list_transform(range(8), lambda i: sqrt({_SQ.format('x[i*8+1:i*8+8]')} / 8)) AS l FROM {_E})"
_A = "(list_sum(list_reverse_sort(l)[1:4]) / 4)"


def vec(name: str, sql: str):
    """Register a function of the signals: columns vec_id and x (doubles)."""
    def add(f):
        simple(name, sql, "embeddings")(lambda d: f(doubles(d)))
        return f
    return add


def pairs(spark, sf):
    """Each signal with the next one: vec_id, x, y."""
    x = doubles(read(spark, sf, "embeddings"))
    return x.join(x.select((C("vec_id") - 1).alias("vec_id"), C("x").alias("y")), "vec_id")


_PAIR = f"(SELECT a.vec_id, a.x, b.x AS y FROM {_E} a JOIN {_E} b ON b.vec_id = a.vec_id + 1)"

vec("g1_frame_db", f"SELECT vec_id, i AS frame, 20 * log10(greatest(l[i + 1], 1e-12)) AS db FROM {_F}, range(8) t(i)")(lambda d: d.select("vec_id", F.posexplode(signals.frame_db(C("x"), 8)).alias("frame", "db")))
vec("g2_levels_full", f"""SELECT vec_id, 20 * log10(greatest({_RMS.format('x')}, 1e-12)) AS dbfs, len(list_filter(x, lambda v: abs(v) > 0.2)) / 64.0 AS clip,
  quantile_cont(20 * log10(greatest(v, 1e-12)), 0.1) AS floor_db FROM (SELECT vec_id, x, unnest(l) AS v FROM {_F}) GROUP BY vec_id, x""")(
    lambda d: d.select("vec_id", signals.dbfs(signals.rms(C("x"))).alias("dbfs"), signals.clip_frac(C("x"), 0.2).alias("clip"), signals.noise_floor_db(C("x"), 8).alias("floor_db")))
_AT = "list_position(list_transform(x, lambda v: abs(v)), " + _PEAK.format("x") + ")"
_W = "x[greatest(1, p - 4):p + 8]"
vec("g4_crest", f"SELECT vec_id, 20 * log10({_PEAK.format('x')} / {_RMS.format('x')}) AS crest_db, 20 * log10({_PEAK.format(_W)} / {_RMS.format(_W)}) AS event_crest_db FROM (SELECT *, {_AT} AS p FROM {_E})")(
    lambda d: d.select("vec_id", signals.crest_db(C("x")).alias("crest_db"), signals.event_crest_db(C("x"), 4, 8).alias("event_crest_db")))
_FIRST = "list_min(list_filter(range(1, 65), lambda i: abs(x[i]) > 0.1))"
vec("g6_trim_silence", f"SELECT vec_id, coalesce(list_max(list_filter(range(1, 65), lambda i: abs(x[i]) > 0.1)) - {_FIRST} + 1, 0)::INT AS n, coalesce(x[{_FIRST}], 0) AS first FROM {_E}")(
    lambda d: d.select("vec_id", signals.trim_silence(C("x"), 0.1).alias("t")).select("vec_id", F.size("t").alias("n"), F.coalesce(F.get("t", F.lit(0)), F.lit(0.0)).alias("first")))
_FL = f"list_filter(range(1, 9), lambda i: l[i] >= {_A} * 10 ** (-2.0 / 20))"
vec("g6_trim_edges", f"SELECT vec_id, (least(64, list_max({_FL}) * 8 + 3) - greatest(1, (list_min({_FL}) - 1) * 8 + 1 - 3) + 1)::INT AS n FROM {_F}")(
    lambda d: d.select("vec_id", F.size(signals.trim_edges(C("x"), 8, 3, 2.0)).alias("n")))
vec("g7_fit", "SELECT vec_id, list_sum(x[5:64]) + 0.0 AS padded, list_sum(x) * 2 + list_sum(x[1:22]) AS tiled, list_sum(x[1:60]) AS placed FROM " + _E)(
    lambda d: d.select("vec_id", *[signals.total(signals.fit(C("x"), n, m, at)).alias(k) for k, n, m, at in (("padded", 100, "pad", 4), ("tiled", 150, "tile", 0), ("placed", 70, "place", 10))]))
vec("g7_fade", "SELECT vec_id, list_sum(list_transform(range(1, 65), lambda i: x[i] * least(1.0, (i - 1) / 8.0, (64 - i) / 8.0))) AS s FROM " + _E)(lambda d: d.select("vec_id", signals.total(signals.fade(C("x"), 8)).alias("s")))
vec("g8_speech_fraction", f"SELECT vec_id, len(list_filter(l, lambda v: v > {_A} * 10 ** (-1.0 / 20))) / 8.0 AS share FROM {_F}")(lambda d: d.select("vec_id", signals.speech_fraction(C("x"), 8, 1.0).alias("share")))
_NEAR = f"list_filter(range(1, 65), lambda i: abs(x[i]) >= {_PEAK.format('x')} * 10 ** (-6.0 / 20))"
vec("g14_audible_span", f"SELECT vec_id, (list_min({_NEAR}) - 1)::INT AS start, (list_max({_NEAR}) - 1)::INT AS stop FROM {_E}")(lambda d: d.select("vec_id", signals.audible_span(C("x"), 0, 6.0).alias("s")).select("vec_id", "s.start", "s.stop"))


@query("g15_audible_fraction", f"""SELECT a.vec_id, len(list_filter(range(1, 9), lambda i: a.l[i] >= list_max(a.l) * 10 ** (-3.0 / 20) AND a.l[i] >= b.l[i])) * 1.0
  / len(list_filter(range(1, 9), lambda i: a.l[i] >= list_max(a.l) * 10 ** (-3.0 / 20))) AS share FROM {_F} a JOIN {_F} b ON b.vec_id = a.vec_id + 1""")
def g15(spark, sf):
    return pairs(spark, sf).select("vec_id", signals.audible_fraction(C("x"), C("y"), 8, 0.0, 3.0).alias("share"))


@query("g16_local_snr", f"SELECT vec_id, 10 * log10(({_SQ.format('x[9:40]')} + 1e-12) / ({_SQ.format('y[9:40]')} + 1e-12)) AS snr FROM {_PAIR}")
def g16(spark, sf):
    return pairs(spark, sf).select("vec_id", signals.local_snr_db(C("x"), C("y"), 8, 40).alias("snr"))


@query("g17_mix_at_snr", f"SELECT vec_id, list_sum(list_transform(range(1, 65), lambda i: abs(x[i] + g * y[i]))) AS s FROM (SELECT *, {_RMS.format('x')} / ({_RMS.format('y')} + 1e-12) * 10 ** (-0.3) AS g FROM {_PAIR})")
def g17(spark, sf):
    return pairs(spark, sf).select("vec_id", signals.mix_at_snr(C("x"), C("y"), 6.0).alias("m")).select("vec_id", signals.total(F.transform("m", F.abs)).alias("s"))


vec("g24_blind_snr", f"SELECT vec_id, 10 * log10(((s[8] + s[7]) / 2 + 1e-12) / (s[1] + 1e-12)) AS snr FROM (SELECT vec_id, list_sort(list_transform(l, lambda v: v * v)) AS s FROM {_F})")(
    lambda d: d.select("vec_id", signals.blind_snr_db(C("x"), 8).alias("snr")))
vec("g27_peak_hold", f"SELECT vec_id, list_sum(list_transform(range(1, 65), lambda i: list_max(list_transform(range(1, i + 1), lambda j: abs(x[j]) * 0.9 ** (i - j))))) AS s FROM {_E}")(
    lambda d: acoustic.peak_hold(d, "x", 0.9, "env").select("vec_id", signals.total(C("env")).alias("s")))
_SH = "len(list_filter(x[{0}+1:{0}+16], lambda v: abs(v) > 0.15)) / 16.0"
vec("g28_active_crop", f"SELECT vec_id, CASE WHEN a >= 0.5 THEN 0 WHEN b >= 0.5 THEN 16 WHEN c >= 0.5 THEN 40 WHEN a >= b AND a >= c THEN 0 WHEN b >= c THEN 16 ELSE 40 END AS start FROM (SELECT vec_id, {_SH.format(0)} AS a, {_SH.format(16)} AS b, {_SH.format(40)} AS c FROM {_E})")(
    lambda d: d.select("vec_id", signals.active_crop_at(C("x"), [0, 16, 40], 16, 0.15, 0.5).alias("start")))
vec("o2_top_entries", "SELECT vec_id, array_to_string(list_transform(list_sort(list_transform(range(1, 65), lambda i: {'s': -x[i], 'i': i}))[1:5], lambda p: 'n' || (p.i - 1)), ',') AS top FROM " + _E)(
    lambda d: d.select("vec_id", F.array_join(signals.top_entries(C("x"), [f"n{i}" for i in range(64)], 5), ",").alias("top")))
simple("g9_pause_islands", """SELECT user_id, min(event_id) AS first, max(event_id) AS last, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, value < 40 ORDER BY event_id) AS g FROM events)
  WHERE value < 40 GROUP BY user_id, g HAVING count(*) >= 3""", "events")(lambda d: spans.pause_islands(d.select("user_id", "event_id", "value"), "user_id", "event_id", C("value") < 40, 3))
simple("w7_moving_argmin", """SELECT user_id, min(mean) AS mean, arg_min(event_id, {'m': mean, 'e': event_id}) AS at FROM (SELECT user_id, event_id, avg(value) OVER w AS mean, count(*) OVER w AS n FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN CURRENT ROW AND 3 FOLLOWING)) WHERE n = 4 GROUP BY user_id""", "events")(lambda d: spans.moving_argmin(d, "user_id", "event_id", "value", 4))


@query("g23_paired_stats", "SELECT lang, avg(r) AS mean, stddev_samp(r) AS std, count(*) AS n FROM (SELECT a.lang, b.n_chars::DOUBLE / a.n_chars AS r FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 WHERE a.lang = b.lang AND a.n_chars > 0) GROUP BY lang HAVING count(*) >= 2")
def g23(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return aggs.paired_stats(d.select("doc_id", "lang", C("n_chars").alias("calm")), d.select((C("doc_id") - 1).alias("doc_id"), "lang", C("n_chars").alias("loud")), ["doc_id", "lang"], "lang")


# Intervals, ranks and draws
_LI = "(SELECT l_orderkey, l_linenumber, l_quantity AS a, l_quantity + l_linenumber AS b FROM lineitem)"


def items(spark, sf):
    return read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", C("l_quantity").alias("a"), (C("l_quantity") + C("l_linenumber")).alias("b"))


@query("j7_overlap_join", f"SELECT s.l_orderkey, s.l_linenumber AS n1, f.l_linenumber AS n2, s.a, f.a AS c FROM {_LI} s JOIN {_LI} f ON s.l_orderkey = f.l_orderkey AND s.a < f.b AND f.a < s.b")
def j7(spark, sf):
    s = items(spark, sf)
    f = s.select("l_orderkey", C("l_linenumber").alias("n2"), C("a").alias("c"), C("b").alias("d"))
    return spans.overlap_join(s.withColumnRenamed("l_linenumber", "n1"), f, "l_orderkey").select("l_orderkey", "n1", "n2", "a", "c")


@query("j6_within_window", "SELECT event_id FROM events WHERE (event_type = 'click' AND value BETWEEN 10 AND 40) OR (event_type = 'view' AND value BETWEEN 50 AND 90)")
def j6(spark, sf):
    w = read(spark, sf, "events").select("event_type").distinct().select("event_type", F.when(C("event_type") == "click", 10.0).when(C("event_type") == "view", 50.0).alias("lo"), F.when(C("event_type") == "click", 40.0).otherwise(90.0).alias("hi"))
    return spans.within_window(read(spark, sf, "events"), w, "event_type", "value").select("event_id")


@query("j5_join_cum_weight", f"""SELECT o_orderkey, r_name FROM (SELECT o_orderkey, {U} AS u FROM orders) JOIN (SELECT r_name, (sum(w) OVER (ORDER BY r_name) - w) / sum(w) OVER () AS lo, sum(w) OVER (ORDER BY r_name) / sum(w) OVER () AS hi
  FROM (SELECT r_name, r_regionkey + 1.0::DOUBLE AS w FROM region)) ON u >= lo AND u < hi""")
def j5(spark, sf):
    d = read(spark, sf, "orders").select("o_orderkey", keyed.keyed_u(7, C("o_orderkey"), "snr").alias("u"))
    return spans.join_cum_weight(d, read(spark, sf, "region").select("r_name", (C("r_regionkey") + 1.0).alias("w")), "u", "r_name", "w").select("o_orderkey", "r_name")


@query("j9_empty_cells", "SELECT n_name, event_type FROM nation, (SELECT DISTINCT event_type FROM events) EXCEPT SELECT n_name, event_type FROM events JOIN nation ON user_id % 60 = n_nationkey WHERE value > 60 AND event_id % 9 = 0")
def j9(spark, sf):
    n, e = read(spark, sf, "nation"), read(spark, sf, "events")
    fact = e.where("value > 60 and event_id % 9 = 0").join(n, C("user_id") % 60 == C("n_nationkey"))
    return spans.empty_cells(n.select("n_name"), e.select("event_type").distinct(), fact)


_RANKED = "(SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents {0})"
_LANG = "CASE o_orderkey % 3 WHEN 0 THEN 'en' WHEN 1 THEN 'de' ELSE 'fr' END"


def drawn(spark, sf):
    lang = F.element_at(F.array(*map(F.lit, ("en", "de", "fr"))), (C("o_orderkey") % 3 + 1).cast("int"))
    return read(spark, sf, "orders").select("o_orderkey", lang.alias("lang"), keyed.keyed_u(7, C("o_orderkey"), "snr").alias("u"))


@query("j11_rank_join", f"SELECT o_orderkey, doc_id FROM (SELECT o_orderkey, {_LANG} AS lang, {U} AS u FROM orders) o JOIN {_RANKED.format('')} d ON o.lang = d.lang AND d.r = floor(u * n)")
def j11(spark, sf):
    return spans.rank_join(drawn(spark, sf), read(spark, sf, "documents").select("lang", "doc_id"), "lang", "doc_id", "u").select("o_orderkey", "doc_id")


@query("d4_pool_draw", f"SELECT o_orderkey, doc_id FROM (SELECT o_orderkey, {_LANG} AS lang, {U} AS u FROM orders) o JOIN {_RANKED.format('WHERE n_chars > 3000 OR lang IN (SELECT lang FROM documents GROUP BY lang HAVING count(*) FILTER (WHERE n_chars > 3000) < 40)')} d ON o.lang = d.lang AND d.r = floor(u * n)")
def d4(spark, sf):
    return spans.pool_draw(drawn(spark, sf), read(spark, sf, "documents").select("lang", "doc_id", "n_chars"), "lang", "doc_id", "u", C("n_chars") > 3000, 40).select("o_orderkey", "doc_id")


@query("d5_pick_nonempty", f"SELECT o_orderkey, h[floor(u * len(h))::INT + 1] AS pick FROM (SELECT o_orderkey, {U} AS u FROM orders), (SELECT list(lang ORDER BY lang) AS h FROM (SELECT DISTINCT lang FROM documents WHERE lang IN ('de', 'es', 'it')))")
def d5(spark, sf):
    counts = read(spark, sf, "documents").groupBy("lang").count()
    return spans.pick_nonempty(["de", "es", "it"], counts, "lang", "count", drawn(spark, sf), "u").select("o_orderkey", "pick")


def _draw(stage: str, key: str = "o_orderkey", seed: int = 7) -> str:
    """Keyed draw of a stage, as SQL."""
    return "(" + u_sql(f"concat_ws(':', '{seed}', CAST({key} AS VARCHAR), '{stage}')") + " / 4294967296.0)"


simple("d6_permute", f"SELECT o_orderkey, row_number() OVER (ORDER BY {_draw('permute')}, o_orderkey) - 1 AS n FROM orders", "orders")(lambda d: spans.permute(d.select("o_orderkey"), 7, "o_orderkey"))
simple("d12_limit_random", f"SELECT o_orderkey FROM orders ORDER BY {_draw('limit')}, o_orderkey LIMIT 40", "orders")(lambda d: spans.limit_random(d.select("o_orderkey"), 40, 7, "o_orderkey"))
simple("d12_limit_even", "SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n, count(*) OVER () AS t FROM orders) WHERE n IN (SELECT (i * (t - 1)) // 24 FROM range(25) r(i))", "orders")(
    lambda d: spans.limit_even(d.select("o_orderkey"), 25, "o_orderkey"))


@query("d8_index_items", "SELECT i AS index, s_suppkey FROM range(least(1000, 3 * (SELECT count(*) FROM supplier))) t(i) JOIN (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS n, count(*) OVER () AS c FROM supplier) ON i % c = n")
def d8(spark, sf):
    return spans.index_items(read(spark, sf, "supplier"), "s_suppkey", 1000, 3)


@query("d7_mix_shares", f"""WITH b AS (SELECT lang, doc_id FROM documents WHERE lang = 'en'), q AS (SELECT count(*) / 0.5 AS q FROM b),
  e AS (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY {_draw('mix', 'doc_id')}, doc_id) - 1 AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents WHERE lang IN ('de', 'es')),
  w AS (SELECT *, round(q * CASE lang WHEN 'de' THEN 0.1 ELSE 0.4 END) AS k FROM e, q)
  SELECT lang, doc_id FROM b UNION ALL SELECT lang, doc_id FROM (SELECT *, unnest(range((floor(k / n) + CASE WHEN r < k % n THEN 1 ELSE 0 END)::INT)) FROM w)""")
def d7(spark, sf):
    d = read(spark, sf, "documents").select("lang", "doc_id")
    return spans.mix_shares(d.where("lang = 'en'"), d, "lang", "doc_id", {"de": 0.1, "es": 0.4}, 7)


simple("d11_capped_sample", f"(SELECT doc_id FROM documents WHERE lang = 'en' ORDER BY {_draw('limit', 'doc_id')}, doc_id LIMIT 10) UNION ALL (SELECT doc_id FROM documents WHERE lang <> 'en' ORDER BY {_draw('limit', 'doc_id')}, doc_id LIMIT 40)", "documents")(
    lambda d: spans.capped_sample(d.select("doc_id", "lang"), 50, C("lang") == "en", 0.2, 7, "doc_id").select("doc_id"))
simple("d20_soft_gold", "SELECT event_id, CASE WHEN event_type = 'click' THEN 0.9 ELSE (1 - 0.9) / 2 END AS click, CASE WHEN event_type = 'view' THEN 0.9 ELSE (1 - 0.9) / 2 END AS view FROM events WHERE event_type IN ('click', 'view', 'error')", "events")(
    lambda d: d.where(C("event_type").isin("click", "view", "error")).select("event_id", spans.soft_gold(C("event_type"), ["click", "view", "error"]).alias("g")).select("event_id", C("g")["click"].alias("click"), C("g")["view"].alias("view")))
simple("g26_raster_spans", "SELECT l_orderkey, frame, max(l_linenumber) AS l_linenumber FROM (SELECT l_orderkey, l_linenumber, unnest(range(floor(l_quantity / 4)::BIGINT, ceil((l_quantity + l_linenumber) / 4)::BIGINT)) AS frame FROM lineitem) GROUP BY 1, 2", "lineitem")(
    lambda d: spans.raster_spans(d.select("l_orderkey", "l_linenumber", C("l_quantity").alias("a"), (C("l_quantity") + C("l_linenumber")).alias("b")), ["l_orderkey"], "a", "b", "l_linenumber", 4.0))


@query("u1_union_all", "SELECT c_name AS name, c_acctbal AS bal, c_mktsegment AS seg FROM customer UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier")
def u1(spark, sf):
    return spans.union_all(read(spark, sf, "customer").select(C("c_name").alias("name"), C("c_acctbal").alias("bal"), C("c_mktsegment").alias("seg")), read(spark, sf, "supplier").select(C("s_acctbal").alias("bal"), C("s_name").alias("name")))


@query("u2_minus_common", "(SELECT 'minus' AS kind, o_custkey AS k FROM orders EXCEPT SELECT 'minus', c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL (SELECT 'common', o_custkey FROM orders INTERSECT SELECT 'common', c_custkey FROM customer WHERE c_acctbal > 0)")
def u2(spark, sf):
    a, b = read(spark, sf, "orders").select(C("o_custkey").alias("k")), read(spark, sf, "customer").where("c_acctbal > 0").select(C("c_custkey").alias("k"))
    return spans.minus(a, b).select(F.lit("minus").alias("kind"), "k").unionByName(spans.common(a, b).select(F.lit("common").alias("kind"), "k"))


# Scores
_T, _P, _S = "event_type = 'click'", "value > 50", "user_id % 2 = 0"


def _share(num: str, den: str) -> str:
    return f"count(*) FILTER (WHERE {num})::DOUBLE / nullif(count(*) FILTER (WHERE {den}), 0)"


simple("m5_frame_pr", f"SELECT user_id, {_share(f'{_P} AND {_T}', _P)} AS precision, {_share(f'{_P} AND {_T}', _T)} AS recall, {_share(f'{_P} AND NOT {_T}', f'NOT {_T}')} AS false_alarm FROM events GROUP BY 1", "events")(
    lambda d: scores.frame_pr(d, ["user_id"], C("value") > 50, C("event_type") == "click"))
simple("m6_blackout", f"SELECT event_type, avg((value < event_id % 100 - 20)::INT) FILTER (WHERE {_S}) AS blackout FROM events GROUP BY 1", "events")(
    lambda d: scores.blackout(d, ["event_type"], C("user_id") % 2 == 0, F.lit(True), C("value"), C("event_id") % 100))
simple("m7_error_split", f"SELECT event_type, 10 * log10(avg(value * value) FILTER (WHERE NOT {_S}) + 1e-12) AS leak_db, 10 * log10(avg(value * value) FILTER (WHERE {_S}) + 1e-12) AS error_db FROM events GROUP BY 1", "events")(
    lambda d: scores.error_split(d, ["event_type"], C("user_id") % 2 == 0, C("value")))
simple("m8_improvement", "SELECT o_orderkey, o_totalprice - o_custkey AS gain FROM orders", "orders")(lambda d: scores.improvement(d, {"gain": ("o_totalprice", "o_custkey")}).select("o_orderkey", "gain"))
_R = "6371000.0 * sqrt(power(radians(b.lon - a.lon) * cos(radians((a.lat + b.lat) / 2)), 2) + power(radians(b.lat - a.lat), 2))"
_LL = "(SELECT s_suppkey, 48 + s_nationkey / 25.0 AS lat, 12 + s_acctbal / 1e4 AS lon FROM supplier)"


@query("m13_position_error", f"SELECT a.s_suppkey, {_R} AS m FROM {_LL} a JOIN {_LL} b ON b.s_suppkey = a.s_suppkey + 1")
def m13(spark, sf):
    p = read(spark, sf, "supplier").select("s_suppkey", (48 + C("s_nationkey") / 25.0).alias("lat"), (12 + C("s_acctbal") / 1e4).alias("lon"))
    q = p.select((C("s_suppkey") - 1).alias("s_suppkey"), C("lat").alias("lat2"), C("lon").alias("lon2"))
    return p.join(q, "s_suppkey").select("s_suppkey", scores.position_error_m(C("lat"), C("lon"), C("lat2"), C("lon2")).alias("m"))


simple("m15_side_by_side", "SELECT 'o_totalprice' AS stat, avg(o_totalprice) AS a, avg(o_totalprice * 2) AS b, avg(o_totalprice * 2) - avg(o_totalprice) AS delta FROM orders UNION ALL SELECT 'o_custkey', avg(o_custkey), avg(o_custkey + 1), avg(o_custkey + 1) - avg(o_custkey) FROM orders", "orders")(
    lambda d: scores.side_by_side(d, d.select("o_orderkey", (C("o_totalprice") * 2).alias("o_totalprice"), (C("o_custkey") + 1).alias("o_custkey")), "o_orderkey", ["o_totalprice", "o_custkey"]))
_SUB = "SELECT {0} AS subset, count(*) AS n, avg(o_totalprice) AS o_totalprice FROM o {1} HAVING count(*) > 0"
_HAS = "o_orderkey % 4 > 0"
simple("a10_results_table", f"WITH o AS (SELECT *, o_custkey % 20 - 8 AS s FROM orders) SELECT 'class ' || o_orderstatus AS subset, count(*) AS n, avg(o_totalprice) AS o_totalprice FROM o GROUP BY o_orderstatus UNION ALL " + " UNION ALL ".join(
    _SUB.format(f"'{k}'", w) for k, w in (("all", ""), ("events", f"WHERE {_HAS}"), ("event snr > 6", f"WHERE {_HAS} AND s > 6"), ("event snr < 0", f"WHERE {_HAS} AND s < 0"))), "orders")(
    lambda d: scores.results_table(d.withColumn("n_events", C("o_orderkey") % 4).withColumn("s", C("o_custkey") % 20 - 8), "o_orderstatus", ["o_totalprice"], "n_events", "s"))


@query("a11_pool_summary", "SELECT lang, count(*) AS n, avg(coalesce(quality = 1, false)::INT) AS kept, avg((n_chars > 1000)::INT) AS long FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def a11(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "lang", "n_chars").join(read(spark, sf, "labels"), "doc_id", "left")
    return scores.pool_summary(d, "lang", C("quality") == 1, {"long": C("n_chars") > 1000})


def nested(d):
    return d.groupBy("l_orderkey").agg(F.collect_list(F.struct("l_returnflag", "l_quantity", (C("l_linestatus") == "O").alias("masked"))).alias("e"))


simple("a13_nested_min", "SELECT l_orderkey, min(l_quantity) FILTER (WHERE l_linestatus = 'F') AS least FROM lineitem GROUP BY 1", "lineitem")(lambda d: nested(d).select("l_orderkey", scores.nested_min(C("e"), "l_quantity", lambda e: ~e["masked"]).alias("least")))
simple("a19_clip_labels", "SELECT l_orderkey, coalesce(string_agg(DISTINCT l_returnflag, ',' ORDER BY l_returnflag) FILTER (WHERE l_linestatus <> 'O'), '') AS labels, (count(DISTINCT l_returnflag) FILTER (WHERE l_linestatus <> 'O'))::INT AS n_labels, (count(*) FILTER (WHERE l_linestatus = 'O'))::INT AS n_masked FROM lineitem GROUP BY 1", "lineitem")(
    lambda d: nested(d).select("l_orderkey", scores.clip_labels(C("e"), "l_returnflag", "masked").alias("c")).select("l_orderkey", F.array_join("c.labels", ",").alias("labels"), "c.n_labels", "c.n_masked"))
simple("a16_answer_accuracy", "SELECT event_type AS name, avg((value > 50)::INT) AS accuracy FROM events GROUP BY 1 UNION ALL SELECT event_type || '@' || (user_id % 3), avg((value > 50)::INT) FROM events GROUP BY 1", "events")(
    lambda d: scores.answer_accuracy(d.withColumn("s", (C("user_id") % 3).cast("string")), "event_type", "s", C("value") > 50))
simple("a17_run_summary", "SELECT count(*) AS events, count(*) FILTER (WHERE event_type = 'click') AS grid_reports, count(*) FILTER (WHERE event_type = 'click' AND value * 20 < 1000) AS within_1km, median(value) AS median_latency, median(user_id) AS median_hop_p95 FROM events", "events")(
    lambda d: scores.run_summary(d, C("event_type") == "click", C("value") * 20, "value", "user_id"))
simple("a18_composition", "SELECT lang, count(*) AS n, sum(n_chars) / 3600.0 AS hours, avg((source = 'src0')::INT) AS hot, count(*) / (SELECT count(*) FROM documents)::DOUBLE AS share FROM documents GROUP BY lang", "documents")(
    lambda d: scores.composition(d, "lang", "n_chars", {"hot": C("source") == "src0"}))


@query("m3_evaluate_set", f"""SELECT vec_id, 10 * log10(({_SQ.format('y')} + 1e-12) / (list_sum(list_transform(range(1, 65), lambda i: (x[i] * 0.5 - y[i]) * (x[i] * 0.5 - y[i]))) + 1e-12)) AS snr FROM {_PAIR}""")
def m3(spark, sf):
    x = doubles(read(spark, sf, "embeddings"))
    return scores.evaluate_set(x, x.select((C("vec_id") - 1).alias("vec_id"), "x"), "vec_id", "x", lambda a: F.transform(a, lambda v: v * 0.5)).select("vec_id", "snr")


@query("l10_latency", "SELECT event_id, 2.0::DOUBLE AS mid_s, user_id::DOUBLE AS end_s, user_id + 2.0::DOUBLE AS total_s FROM events")
def l10(spark, sf):
    from sparrowmill.streaming import events

    d = read(spark, sf, "events").select("event_id", "user_id", C("ts").cast("timestamp").alias("ts"))
    d = d.withColumn("mid", F.timestamp_micros(F.unix_micros("ts") + 2_000_000)).withColumn("end", F.timestamp_micros(F.unix_micros("mid") + C("user_id") * 1_000_000))
    return events.with_latency(d, ["ts", "mid", "end"]).select("event_id", "mid_s", "end_s", "total_s")


@query("l6_with_operator", "SELECT event_id, 'auto' AS source_tag FROM events WHERE event_type <> 'error' UNION ALL SELECT event_id, 'operator' FROM events WHERE event_type = 'error'")
def l6(spark, sf):
    from sparrowmill.streaming import events

    e = read(spark, sf, "events").select("event_id", "event_type")
    return events.with_operator(e.where("event_type <> 'error'"), e.where("event_type = 'error'")).select("event_id", "source_tag")


@query("s13_upsert_by_id", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS v FROM orders WHERE o_orderkey % 2 = 0 AND (o_orderkey % 5 <> 0 OR o_orderkey % 3 = 0)")
def s13(spark, sf):
    o = read(spark, sf, "orders")
    old = o.where("o_orderkey % 5 <> 0").select("o_orderkey", C("o_totalprice").alias("v"))
    new = o.where("o_orderkey % 3 = 0").select("o_orderkey", (C("o_totalprice") * 2).alias("v"))
    return aggs.upsert_by_id(old, new, o.where("o_orderkey % 2 = 0"), "o_orderkey")



# Features with a spectrum or a walk

vec("g21_harvest", f"""SELECT vec_id, s AS segment, CASE WHEN len(list_filter(range(s * 4, s * 4 + 4), lambda i: 20 * log10(greatest(sqrt({_SQ.format('x[i*8+1:i*8+8]')} / 8), 1e-12)) > -18)) / 4.0 > 0.5 THEN 'speech' ELSE 'noise' END AS kind
  FROM {_E}, range(2) t(s)""")(lambda d: acoustic.harvest(d, "vec_id", "x", 32, 8, -18.0, 0.5).select("vec_id", "segment", "kind"))
# Signals of unequal lengths: the first 40 to 63 samples. By Parseval the powers of all bins, all but
# the first and the middle one twice, sum to n times the energy.
_CUT = f"(SELECT vec_id, x[1:40 + vec_id % 24] AS x FROM {_E})"


def uneven(d):
    return d.select("vec_id", F.slice("x", F.lit(1), (40 + C("vec_id") % 24).cast("int")).alias("x"))


vec("g22_spectrum_energy", f"SELECT vec_id, {_SQ.format('x')} * len(x) AS energy FROM {_CUT}")(
    lambda d: acoustic.spectrum(uneven(d), "vec_id", "x").groupBy("vec_id").agg(F.sum(C("power") * F.when((C("bin") == 0) | (2 * C("bin") == C("n")), 1).otherwise(2)).alias("energy")))
# Frames of 16 samples, half overlapped and without a window: bin 0 is the square of a frame's sum.
vec("g22_lta_spectrum", f"SELECT 0 AS bin, avg(power(list_sum(x[i * 8 + 1:i * 8 + 16]), 2)) AS power FROM (SELECT x, unnest(range((len(x) - 16) // 8 + 1)) AS i FROM {_CUT})")(
    lambda d: acoustic.lta_spectrum(acoustic.frame_spectrum(uneven(d), "vec_id", "x", 16, 8, window=False), []).where("bin = 0"))
# Bands of whole signals at a rate of 640 with a transform of the signal's length, by a plain sum over samples.
_BIN = "power(list_sum(list_transform(x, lambda v, i: v * cos(2 * pi() * k * (i - 1) / n))), 2) + power(list_sum(list_transform(x, lambda v, i: v * sin(2 * pi() * k * (i - 1) / n))), 2)"
_BANDS = f"(SELECT vec_id, k * 640.0 / n AS f, {_BIN} AS p FROM (SELECT vec_id, x, len(x) AS n, unnest(range(len(x) // 2 + 1)) AS k FROM {_CUT}))"
vec("g22_band_ratio", f"SELECT vec_id, 10 * log10((sum(CASE WHEN f BETWEEN 100 AND 300 THEN p ELSE 0 END) + 1e-12) / (sum(CASE WHEN f BETWEEN 10 AND 50 THEN p ELSE 0 END) + 1e-12)) AS ratio_db FROM {_BANDS} GROUP BY vec_id")(
    lambda d: acoustic.band_ratio_db(uneven(d), "x", 640, (100, 300), (10, 50), least=1).select("vec_id", "ratio_db"))
vec("g22_high_share", f"SELECT vec_id, 10 * log10(sum(CASE WHEN f > 160 THEN p ELSE 0 END) / (sum(CASE WHEN f > 12 AND f <= 160 THEN p ELSE 0 END) + 1e-12)) AS high_db FROM {_BANDS} GROUP BY vec_id")(
    lambda d: acoustic.high_share_db(uneven(d), "x", 640, 160, 12).select("vec_id", "high_db"))
vec("g25_score_windows", f"SELECT vec_id, greatest(list_sum(x[1:32]), list_sum(x[17:48]), list_sum(x[33:64])) AS total, greatest(x[1], x[17], x[33]) AS first FROM {_E}")(
    lambda d: acoustic.score_windows(d, "vec_id", "x", 32, lambda m: m[:, [0, 0]] * [0, 1] + m.sum(axis=1)[:, None] * [1, 0], 2).select("vec_id", C("scores")[0].alias("total"), C("scores")[1].alias("first")))
_RISE = "list_position(list_transform(rise, lambda v: v >= {0} * rise[len(rise)]), true)"
vec("g5_attack", f"""SELECT vec_id, ({_RISE.format(0.9)} - {_RISE.format(0.1)}) / 8000.0 * 1000 AS attack FROM (SELECT vec_id, part[1:list_position(part, list_max(part))] AS rise
  FROM (SELECT vec_id, env[list_position(list_transform(env, lambda v: v >= 0.1 * list_max(env)), true):][1:12] AS part FROM (SELECT vec_id, list_transform(x, lambda v: abs(v)) AS env FROM {_E})))""")(
    lambda d: acoustic.per_signal(d, "x", lambda x: acoustic.attack_ms(x, 8000), "attack").select("vec_id", "attack"))
# Both filters run sample by sample, then blocks of 40 samples every ten and the two gates.
(_B, _A), (_D, _C) = [([repr(float(v)) for v in b], [repr(float(v)) for v in a]) for b, a in acoustic.k_filters(100)]
_LUFS = "-0.691 + 10 * log10({0} + 1e-12)"
vec("g12_loudness", f"""WITH RECURSIVE r AS (SELECT vec_id, x, 0 AS i, 0.0::DOUBLE AS x1, 0.0::DOUBLE AS x2, 0.0::DOUBLE AS u1, 0.0::DOUBLE AS u2, 0.0::DOUBLE AS y1, 0.0::DOUBLE AS y2 FROM {_E}
  UNION ALL SELECT vec_id, x, i + 1, x[i + 1], x1, u, u1, {_D[0]} * u + {_D[1]} * u1 + {_D[2]} * u2 - {_C[0]} * y1 - {_C[1]} * y2, y1
  FROM (SELECT *, {_B[0]} * x[i + 1] + {_B[1]} * x1 + {_B[2]} * x2 - {_A[0]} * u1 - {_A[1]} * u2 AS u FROM r WHERE i < len(x))),
  z AS (SELECT vec_id, k, avg(y1 * y1) AS z FROM r, range(3) t(k) WHERE i > k * 10 AND i <= k * 10 + 40 GROUP BY ALL),
  l AS (SELECT *, {_LUFS.format('z')} AS level FROM z WHERE {_LUFS.format('z')} > -70), g AS (SELECT vec_id, {_LUFS.format('avg(z)')} - 10 AS gate FROM l GROUP BY vec_id),
  o AS (SELECT vec_id, {_LUFS.format('avg(z)')} AS lufs FROM l JOIN g USING (vec_id) WHERE level > gate GROUP BY vec_id)
  SELECT vec_id, coalesce(lufs, -70.0) AS lufs FROM embeddings LEFT JOIN o USING (vec_id)""")(lambda d: acoustic.loudness_lufs(d, "vec_id", "x", 100))
simple("g10_window_long", """WITH RECURSIVE s AS (SELECT o_orderkey, o_custkey % 400 + 1 AS size, [o_custkey % 90, o_custkey % 90 + 70, o_custkey % 90 + 190] AS cuts FROM orders),
  w AS (SELECT o_orderkey, size, cuts, 0::BIGINT AS start, CASE WHEN size <= 100 THEN size ELSE coalesce(list_max(list_filter(cuts, lambda c: c > 66 AND c <= 100)), 100) END AS stop FROM s
  UNION ALL SELECT o_orderkey, size, cuts, stop, CASE WHEN size <= stop + 100 THEN size ELSE coalesce(list_max(list_filter(cuts, lambda c: c > stop + 66 AND c <= stop + 100)), stop + 100) END FROM w WHERE stop < size)
  SELECT o_orderkey, start, stop FROM w WHERE start = 0 OR stop - start >= 35""", "orders")(
    lambda d: acoustic.window_long(d.select("o_orderkey", (C("o_custkey") % 400 + 1).alias("size"), F.array(C("o_custkey") % 90, C("o_custkey") % 90 + 70, C("o_custkey") % 90 + 190).alias("cuts")), "o_orderkey", 100, "cuts"))
# Greedy strings by a recursion over the clips of a group in their drawn order.
_CLIPS = f"SELECT l_suppkey, clip, size, row_number() OVER (PARTITION BY l_suppkey ORDER BY {_draw('pack', 'clip')}, clip) AS i FROM (SELECT l_suppkey, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS clip, l_quantity::INT AS size FROM lineitem)"


def clips(d):
    return d.select("l_suppkey", ((C("l_orderkey") * 10 + C("l_linenumber")) * 1000000 + C("l_partkey")).alias("clip"), C("l_quantity").cast("int").alias("size"))


simple("g11_pack_short", f"""WITH RECURSIVE c AS MATERIALIZED ({_CLIPS}), r AS (SELECT l_suppkey, clip, size, i, 0::BIGINT AS string, 0::BIGINT AS "at" FROM c WHERE i = 1
  UNION ALL SELECT c.l_suppkey, c.clip, c.size, c.i, CASE WHEN r."at" + r.size + 5 + c.size > 100 THEN r.string + 1 ELSE r.string END, CASE WHEN r."at" + r.size + 5 + c.size > 100 THEN 0 ELSE r."at" + r.size + 5 END
  FROM r JOIN c ON c.l_suppkey = r.l_suppkey AND c.i = r.i + 1)
  SELECT l_suppkey, string, clip, "at" FROM (SELECT *, max("at" + size) OVER (PARTITION BY l_suppkey, string) AS fill, max(string) OVER (PARTITION BY l_suppkey) AS last FROM r) WHERE fill >= 35 OR last = 0""", "lineitem")(
    lambda d: packing.pack_short(clips(d), ["l_suppkey"], "clip", "size", keyed.keyed_u(7, C("clip"), "pack"), 100, 5))
simple("d22_chunk_clips", f"""WITH RECURSIVE c AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY i) AS k FROM ({_CLIPS}) WHERE size >= 4), r AS (SELECT l_suppkey, clip, size, k, 0::BIGINT AS string, 0::BIGINT AS "at" FROM c WHERE k = 1
  UNION ALL SELECT c.l_suppkey, c.clip, c.size, c.k, CASE WHEN r."at" + r.size + 4 >= 90 THEN r.string + 1 ELSE r.string END, CASE WHEN r."at" + r.size + 4 >= 90 THEN 0 ELSE r."at" + r.size + 4 END
  FROM r JOIN c ON c.l_suppkey = r.l_suppkey AND c.k = r.k + 1)
  SELECT l_suppkey, string, clip, "at" FROM (SELECT *, sum(size + 4) OVER (PARTITION BY l_suppkey, string) AS full_ FROM r) WHERE full_ >= 90""", "lineitem")(
    lambda d: packing.chunk_clips(clips(d), ["l_suppkey"], "clip", "size", keyed.keyed_u(7, C("clip"), "pack"), 90, 4, 4))
