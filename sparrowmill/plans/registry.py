"""Registered queries of the core library: name -> (function, SQL)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparrowmill.functions import keyed
from sparrowmill.operators import aggs, audits, filters, signals, text
from sparrowmill.sources import files

QUERIES: dict = {}


def query(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = (f, sql)
        return f
    return add


def read(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def u_sql(key: str) -> str:
    return f"('0x' || substr(sha256({key}), 1, 8))::BIGINT"


def split_sql(key: str) -> str:
    u = f"{u_sql(f'CAST({key} AS VARCHAR)')} / 4294967295.0"
    return f"CASE WHEN {u} < 0.9 THEN 'train' WHEN {u} < 0.95 THEN 'val' ELSE 'test' END"


@query("x1_hash_split", f"SELECT c_custkey, {split_sql('c_name')} AS split FROM customer")
def x1(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", keyed.hash_split(F.col("c_name")).alias("split"))


@query("a1_count_matrix", f"""SELECT lang, count(*) FILTER (WHERE s = 'train') AS train, count(*) FILTER (WHERE s = 'val') AS val,
 count(*) FILTER (WHERE s = 'test') AS test FROM (SELECT lang, {split_sql('doc_id')} AS s FROM documents) GROUP BY lang""")
def a1(spark, sf):
    d = read(spark, sf, "documents").select("lang", keyed.hash_split(F.col("doc_id")).alias("split"))
    return d.groupBy("lang").pivot("split", ["train", "val", "test"]).count().na.fill(0)


def simple(name: str, sql: str, table: str):
    """Register a function of one table."""
    def add(f):
        QUERIES[name] = (lambda spark, sf: f(read(spark, sf, table)), sql)
        return f
    return add


C = F.col
SEC = "epoch_us(ts) / 1000000.0"


def seconds(c: str = "ts"):
    return F.unix_micros(F.col(c).cast("timestamp")) / 1000000.0


_KEY = "concat_ws(':', '7', CAST(o_orderkey AS VARCHAR), 'snr')"
U = f"({u_sql(_KEY)} / 4294967296.0)"
simple("d1_keyed_u", f"SELECT o_orderkey, {U} AS u FROM orders", "orders")(lambda d: d.select("o_orderkey", keyed.keyed_u(7, C("o_orderkey"), "snr").alias("u")))


@simple("d2_sample_dist", f"""SELECT o_orderkey, -5 + u * 20 AS uni, 2 + floor(u * 4)::BIGINT AS whole,
  CASE WHEN u < 0.3 THEN sqrt(u * 10 * 3) ELSE 10 - sqrt((1 - u) * 10 * 7) END AS tri FROM (SELECT o_orderkey, {U} AS u FROM orders)""", "orders")
def d2(d):
    u = keyed.keyed_u(7, C("o_orderkey"), "snr")
    return d.select("o_orderkey", keyed.sample_dist("uniform", u, low=-5, high=15).alias("uni"), keyed.sample_dist("uniform_int", u, low=2, high=5).alias("whole"),
                    keyed.sample_dist("triangular", u, low=0, mode=3, high=10).alias("tri"))


simple("x5_index_splits", """SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 9 THEN 'test' WHEN o_orderkey % 10 = 8 THEN 'val' ELSE 'train' END AS by_mod,
  CASE WHEN ((o_orderkey::HUGEINT * 2654435761) % 4294967296) / 4294967296.0 < 0.1 THEN 'val' ELSE 'train' END AS by_hash FROM orders""", "orders")(
    lambda d: d.select("o_orderkey", keyed.mod_split(C("o_orderkey")).alias("by_mod"), keyed.knuth_split(C("o_orderkey"), 0.1).alias("by_hash")))

simple("a2_hours", "SELECT lang, sum(n_chars) / 3600.0 AS hours FROM documents GROUP BY lang", "documents")(lambda d: aggs.hours(d, ["lang"], "n_chars"))
simple("a3_n_distinct", f"SELECT split, count(DISTINCT o_custkey) AS n FROM (SELECT o_custkey, {split_sql('o_orderkey')} AS split FROM orders) GROUP BY split", "orders")(
    lambda d: aggs.n_distinct(d.withColumn("split", keyed.hash_split(C("o_orderkey"))), "o_custkey", ["split"]))
simple("a4_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1", "events")(lambda d: aggs.value_counts(d, "event_type"))
simple("a5_rate_pct", "SELECT o_orderpriority, avg(CASE WHEN o_totalprice > 150000 THEN 1.0 ELSE 0 END) * 100 AS pct FROM orders GROUP BY 1", "orders")(
    lambda d: aggs.rate_pct(d, C("o_totalprice") > 150000, ["o_orderpriority"]))
simple("a6_quantiles", "SELECT " + ", ".join(f"quantile_cont(value, {p}) AS p{round(p * 100):02d}" for p in (.02, .1, .5, .9, .98)) + " FROM events", "events")(
    lambda d: aggs.quantiles(d, "value", [.02, .1, .5, .9, .98]))
simple("a7_histogram_left", """SELECT b::INT AS bin, (SELECT count(*) FROM events WHERE value >= b * 20 AND (value < (b + 1) * 20 OR (b = 4 AND value = 100))) AS n FROM range(5) t(b)""", "events")(
    lambda d: aggs.histogram_left(d, "value", [0, 20, 40, 60, 80, 100]))
simple("a8_binned_mean", "SELECT (ceil(value / 20) - 1)::INT AS bin, avg(user_id) AS mean, count(*) AS n FROM events WHERE value > 0 AND value <= 100 GROUP BY 1", "events")(
    lambda d: aggs.binned_mean(d, "value", [0, 20, 40, 60, 80, 100], "user_id"))
simple("a9_breakdown", """SELECT o_orderstatus, o_orderpriority, count(*) AS n, avg(o_totalprice) AS mean, grouping_id(o_orderstatus, o_orderpriority)::BIGINT AS gid
  FROM orders GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""", "orders")(lambda d: aggs.breakdown(d, ["o_orderstatus", "o_orderpriority"], "o_totalprice"))
simple("a12_top_k_values", """SELECT * FROM (SELECT lang, source, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, source)::INT AS rank
  FROM documents GROUP BY lang, source) WHERE rank <= 6""", "documents")(lambda d: aggs.top_k_values(d, "lang", "source", 6))
simple("a14_micro_ratio", "SELECT l_returnflag, sum(l_discount) / greatest(sum(l_quantity), 1) AS ratio FROM lineitem GROUP BY 1", "lineitem")(lambda d: aggs.micro_ratio(d, "l_discount", "l_quantity", "l_returnflag"))
simple("a15_threshold_sweep", "SELECT p::DOUBLE AS p, (SELECT count(*) FROM events WHERE value >= p) AS n FROM (VALUES (10), (30), (50)) t(p)", "events")(lambda d: aggs.threshold_sweep(d, "value", [10.0, 30.0, 50.0]))
simple("w1_number_in", "SELECT doc_id, source || '_' || lpad(n, greatest(4, length(n))::INT, '0') AS name FROM (SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY doc_id) AS VARCHAR) AS n FROM documents)", "documents")(
    lambda d: aggs.number_in(d, "source", "doc_id").select("doc_id", "name"))
simple("w2_occurrence", "SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS occurrence FROM lineitem", "lineitem")(
    lambda d: aggs.occurrence(d, "l_orderkey", ["l_linenumber"]).select("l_orderkey", "l_linenumber", "occurrence"))
simple("w3_gap_violations", f"""SELECT user_id, count(*) FILTER (WHERE gap < 3600) AS violations, count(*) AS n FROM (SELECT user_id,
  {SEC} - lag({SEC}) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap FROM events) GROUP BY 1""", "events")(
    lambda d: aggs.gap_violations(d, "user_id", seconds(), ["ts", "event_id"], 3600))
simple("w4_max_concurrent", """SELECT k AS l_suppkey, max(live)::BIGINT AS max_live FROM (SELECT k, sum(d) OVER (PARTITION BY k ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS live FROM
  (SELECT l_suppkey AS k, CAST(l_shipdate AS DATE) AS t, 1 AS d FROM lineitem UNION ALL SELECT l_suppkey, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INT), -1 FROM lineitem)) GROUP BY k""", "lineitem")(
    lambda d: aggs.max_concurrent(d.select("l_suppkey", C("l_shipdate").cast("date").alias("a"), F.date_add(C("l_shipdate").cast("date"), C("l_quantity").cast("int")).alias("b")), "l_suppkey", "a", "b"))
simple("w5_superseded_by", "SELECT event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS superseded_by FROM events", "events")(
    lambda d: aggs.superseded_by(d, "user_id", ["ts", "event_id"], "event_id").select("event_id", "superseded_by"))
simple("j10_last_known", """SELECT event_id, last_value(CASE WHEN value > 50 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_known FROM events""", "events")(
    lambda d: aggs.last_known(d, "user_id", F.when(C("value") > 50, C("value")), ["ts", "event_id"]).select("event_id", "last_known"))
simple("d10_first_k", "SELECT * FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey)::INT AS rank FROM orders) WHERE rank <= 3", "orders")(
    lambda d: aggs.first_k(d, "o_orderpriority", "o_orderkey", 3).select("o_orderkey", "rank"))
simple("o1_newest", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 200", "events")(lambda d: aggs.newest(d.select("event_id", "ts"), 200, [F.desc("ts"), F.desc("event_id")]).select("event_id"))
simple("u3_distinct_by", "SELECT lang, source, min(doc_id) AS doc_id FROM documents GROUP BY 1, 2", "documents")(lambda d: aggs.distinct_by(d.select("lang", "source", "doc_id"), ["lang", "source"], ["doc_id"]))

_STATUS = "CASE WHEN n_bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status, n_bad"
simple("q1_check_groups", f"SELECT 'customers' AS name, {_STATUS} FROM (SELECT count(*) AS n_bad FROM (SELECT o_custkey FROM (SELECT o_custkey, {split_sql('o_orderkey')} AS s FROM orders) GROUP BY 1 HAVING min(s) <> max(s)))", "orders")(
    lambda d: audits.check_groups(d, "o_custkey", keyed.hash_split(C("o_orderkey")), "customers"))
simple("q5_content_overlap", f"""SELECT count(*) AS n_test, coalesce(sum(tr), 0)::BIGINT AS n_shared FROM (SELECT text, max((s = 'test')::INT) AS te, max((s = 'train')::INT) AS tr
  FROM (SELECT text, {split_sql('doc_id')} AS s FROM documents) GROUP BY text) WHERE te = 1""", "documents")(lambda d: audits.content_overlap(d, "text", keyed.hash_split(C("doc_id"))))
simple("q12_check_duplicates", f"SELECT 'content' AS name, {_STATUS} FROM (SELECT count(*) AS n_bad FROM (SELECT text FROM documents GROUP BY text HAVING count(*) > 1))", "documents")(
    lambda d: audits.check_duplicates(d, "text", "content"))
simple("q21_check_rates", f"SELECT 'rates' AS name, {_STATUS} FROM (SELECT (NOT (avg((value > 50)::INT) BETWEEN 0.2 AND 0.8) OR count(DISTINCT event_type) < 5)::INT::BIGINT AS n_bad FROM events)", "events")(
    lambda d: audits.check_rates(d, C("value") > 50, "event_type", 0.2, 0.8, 5, "rates"))


@query("q9_check_flagged", f"SELECT 'flagged' AS name, {_STATUS} FROM (SELECT count(*) AS n_bad FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1))")
def q9(spark, sf):
    return audits.check_flagged(read(spark, sf, "documents").select("doc_id"), read(spark, sf, "labels").where("toxic = 1"), "doc_id", "flagged")


@query("p15_audited_only", "SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 1) = 1")
def p15(spark, sf):
    return filters.audited_only(read(spark, sf, "documents").select("doc_id"), read(spark, sf, "labels"), "doc_id", F.col("quality") == 1)


@query("s12_todo_ids", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")
def s12(spark, sf):
    """Orders that are still to build: those of one status are taken as missing."""
    o = read(spark, sf, "orders")
    return files.todo_ids(o.select("o_orderkey"), o.where("o_orderstatus <> 'P'"), "o_orderkey")


@query("p6_attach_dim", "SELECT n_name, coalesce(CASE WHEN r_name <> 'ASIA' THEN r_name END, 'other') AS region FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def p6(spark, sf):
    dim = read(spark, sf, "region").where("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region"))
    return filters.attach_dim(read(spark, sf, "nation"), dim, "n_regionkey", "region", "other").select("n_name", "region")


@query("j1_join_all", "SELECT l_orderkey, l_linenumber, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def j1(spark, sf):
    o = read(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority")
    return filters.join_all(read(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), o, "l_orderkey")


_D = "list_transform(embedding, lambda v: v::DOUBLE)"
_SS = "list_sum(list_transform({0}, lambda v: v * v))"
simple("g2_level_stats", f"SELECT vec_id, sqrt({_SS.format('x')} / len(x)) AS rms, list_max(list_transform(x, lambda v: abs(v))) AS peak, list_sum(x) / len(x) AS dc FROM (SELECT vec_id, {_D} AS x FROM embeddings)", "embeddings")(
    lambda d: d.withColumn("x", C("embedding").cast("array<double>")).select("vec_id", signals.rms(C("x")).alias("rms"), signals.peak(C("x")).alias("peak"), (signals.total(C("x")) / F.size("x")).alias("dc")))
simple("g3_active_rms", f"""SELECT vec_id, avg(r) AS active FROM (SELECT vec_id, i, r, row_number() OVER (PARTITION BY vec_id ORDER BY r DESC) AS k FROM
  (SELECT vec_id, i, sqrt({_SS.format('x[i*8+1:i*8+8]')} / 8) AS r FROM (SELECT vec_id, {_D} AS x, unnest(range(8)) AS i FROM embeddings))) WHERE k <= 4 GROUP BY vec_id""", "embeddings")(
    lambda d: d.select("vec_id", signals.active_rms(C("embedding").cast("array<double>"), 8).alias("active")))


@query("m1_m2_snr", f"""WITH x AS (SELECT vec_id, {_D} AS v FROM embeddings), p AS (SELECT a.vec_id, a.v AS e0, b.v AS r0,
  list_transform(a.v, lambda q: q - list_avg(a.v)) AS e, list_transform(b.v, lambda q: q - list_avg(b.v)) AS r FROM x a JOIN x b ON b.vec_id = a.vec_id + 1),
  s AS (SELECT *, list_transform(r, lambda q: q * list_dot_product(e, r) / ({_SS.format('r')} + 1e-12)) AS t FROM p)
  SELECT vec_id, 10 * log10(({_SS.format('t')} + 1e-12) / (list_sum(list_transform(list_zip(e, t), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) + 1e-12)) AS si_snr,
  10 * log10(({_SS.format('r0')} + 1e-12) / (list_sum(list_transform(list_zip(e0, r0), lambda q: (q[1] - q[2]) * (q[1] - q[2]))) + 1e-12)) AS snr FROM s""")
def m1(spark, sf):
    x = read(spark, sf, "embeddings").select("vec_id", "embedding")
    y = x.select((C("vec_id") - 1).alias("vec_id"), C("embedding").alias("ref"))
    return x.join(y, "vec_id").select("vec_id", signals.si_snr(C("embedding"), C("ref")).alias("si_snr"), signals.snr(C("embedding"), C("ref")).alias("snr"))


_TOK = "regexp_extract_all(lower(text), '[a-z0-9'']+|[,.?!]')"
simple("t1_tokens", f"SELECT conv_id, turn, len({_TOK}) AS n FROM conversations", "conversations")(lambda d: d.select("conv_id", "turn", F.size(text.tokens(C("text"))).alias("n")))
simple("t9_keyword_hits", f"SELECT conv_id, turn, len(list_filter({_TOK}, lambda t: t IN ('the', 'la', 'die'))) AS n FROM conversations", "conversations")(
    lambda d: d.select("conv_id", "turn", text.keyword_hits(text.tokens(C("text")), ["the", "la", "die"]).alias("n")))
simple("p16_clean_text", "SELECT conv_id, turn, md5(trim(regexp_replace(regexp_replace(text, '[_/|-]+', ' ', 'g'), ' +', ' ', 'g'), ' ')) AS h FROM conversations", "conversations")(
    lambda d: d.select("conv_id", "turn", F.md5(F.encode(text.clean_text(C("text")), "UTF-8")).alias("h")))
simple("w6_longest_run", f"""SELECT conv_id, turn, max(n) AS longest_run FROM (SELECT conv_id, turn, tok, g, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, turn ORDER BY pos)
  - row_number() OVER (PARTITION BY conv_id, turn, tok ORDER BY pos) AS g FROM (SELECT conv_id, turn, unnest(w) AS tok, generate_subscripts(w, 1) AS pos FROM (SELECT conv_id, turn, {_TOK} AS w FROM conversations)))
  GROUP BY 1, 2, 3, 4) GROUP BY 1, 2""", "conversations")(lambda d: text.longest_run(d, ["conv_id", "turn"], "text"))
