"""Registered queries of splits, pool rules and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparrowmill.functions import keyed
from sparrowmill.operators import audits, filters, signals, splits
from sparrowmill.plans.registry import query, read, simple, split_sql

C = F.col
WINDOWS = [("train", 0, 40), ("val", 40, 60), ("test", 60, 100)]
FOLDS = {1: "train", 2: "train", 3: "train", 4: "val", 5: "test"}
_X = "list_transform(embedding, lambda v: v::DOUBLE)"
_MAX = "list_max(list_transform({0}, lambda v: abs(v)))"
_RMS = "sqrt(list_sum(list_transform({0}, lambda v: v * v)) / len({0}))"
STATUS = "CASE WHEN n_bad = 0 THEN 'PASS' ELSE '{0}' END AS status, n_bad"


def status(name: str, count: str, level: str = "FAIL") -> str:
    return f"SELECT '{name}' AS name, {STATUS.format(level)} FROM ({count})"


def doubles(d):
    return d.select("vec_id", C("embedding").cast("array<double>").alias("x"))


simple("x2_fold_split", "SELECT s_suppkey, CASE WHEN s_suppkey % 5 < 3 THEN 'train' WHEN s_suppkey % 5 = 3 THEN 'val' ELSE 'test' END AS split FROM supplier", "supplier")(
    lambda d: d.select("s_suppkey", splits.fold_split((C("s_suppkey") % 5 + 1).cast("int"), FOLDS).alias("split")))
simple("x3_time_split", """SELECT event_id, s AS split, a::DOUBLE AS start_s, least(b::DOUBLE, value) AS end_s FROM events, (VALUES ('train', 0, 40), ('val', 40, 60), ('test', 60, 100)) w(s, a, b)
  WHERE least(b::DOUBLE, value) > a""", "events")(lambda d: splits.time_split(d.select("event_id", "value"), C("value"), WINDOWS).select("event_id", "split", "start_s", "end_s"))
simple("x4_tail_split", """SELECT doc_id, CASE WHEN r = 1 THEN 'test' WHEN r = 2 AND n >= 3 THEN 'val' ELSE 'train' END AS split FROM documents JOIN
  (SELECT source, row_number() OVER (ORDER BY source DESC) AS r, count(*) OVER () AS n FROM (SELECT DISTINCT source FROM documents)) USING (source)""", "documents")(
    lambda d: splits.tail_split(d.select("doc_id", "source"), "source").select("doc_id", "split"))
simple("x6_force_split", f"SELECT doc_id, CASE WHEN source = 'src3' OR lang = 'es' THEN 'test' ELSE {split_sql('doc_id')} END AS split FROM documents", "documents")(
    lambda d: d.select("doc_id", splits.force_split(keyed.hash_split(C("doc_id")), C("source") == "src3", C("lang") == "es").alias("split")))

_URL = r"^https?://([^./]+)[^/]*/([a-z]+)/(\d+)"
simple("p1_parse_key", f"SELECT page_id, nullif(regexp_extract(url, '{_URL}', 1), '') AS host, nullif(regexp_extract(url, '{_URL}', 2), '') AS lang, nullif(regexp_extract(url, '{_URL}', 3), '') AS number FROM pages", "pages")(
    lambda d: d.select("page_id", filters.parse_key(C("url"), _URL, ["host", "lang", "number"]).alias("k")).select("page_id", "k.host", "k.lang", "k.number"))
simple("p4_labels_to_pools", """SELECT doc_id, unnest(list_filter(CASE WHEN source = 'src3' THEN [] WHEN lang = 'en' THEN [CASE WHEN source IN ('src0', 'src2') THEN 'spoken' END]
  ELSE [CASE WHEN source IN ('src0', 'src1') THEN 'near' END, CASE WHEN source IN ('src1', 'src2', 'src3') THEN 'far' END] END, lambda p: p IS NOT NULL)) AS pool FROM documents""", "documents")(
    lambda d: filters.labels_to_pools(d.select("doc_id", F.array("lang", "source").alias("l")), "l", {"near": ["src0", "src1"], "far": ["src1", "src2", "src3"]}, {"spoken": ["src0", "src2"]}, ["en"], ["src3"]).select("doc_id", "pool"))


@simple("p8_route_clipped", f"SELECT vec_id, len(list_filter({_X}, lambda v: abs(v) > 0.25)) * 1.0 / len(embedding) > 0.02 AS rejected FROM embeddings", "embeddings")
def p8(d):
    ok, bad = filters.route_clipped(doubles(d), signals.clip_frac(C("x"), 0.25), 0.02)
    return ok.select("vec_id", F.lit(False).alias("rejected")).unionByName(bad.select("vec_id", F.lit(True).alias("rejected")))


@query("p10_contract_violations", f"""SELECT vec_id, array_to_string(list_filter([CASE WHEN y IS NULL THEN 'missing' END, CASE WHEN len(x) <> len(y) THEN 'length' END,
  CASE WHEN coalesce({_MAX.format('y')}, 0) < 0.22 THEN 'silent' END, CASE WHEN {_MAX.format('x')} > 1 OR {_MAX.format('y')} > 1 THEN 'range' END], lambda v: v IS NOT NULL), ',') AS bad
  FROM (SELECT a.vec_id, list_transform(a.embedding, lambda v: v::DOUBLE * 3) AS x, list_transform(b.embedding, lambda v: v::DOUBLE) AS y FROM embeddings a LEFT JOIN embeddings b ON b.vec_id = a.vec_id + 1)""")
def p10(spark, sf):
    x = doubles(read(spark, sf, "embeddings"))
    y = x.select((C("vec_id") - 1).alias("vec_id"), C("x").alias("y"))
    d = x.select("vec_id", F.transform("x", lambda v: v * 3).alias("x")).join(y, "vec_id", "left")
    return filters.contract_violations(d, "x", "y", 0.22).select("vec_id", F.array_join("violations", ",").alias("bad"))


@query("p14_quarantine", "SELECT lang, count(*) AS n FROM documents JOIN labels USING (doc_id) WHERE toxic = 1 GROUP BY lang")
def p14(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", "lang").join(read(spark, sf, "labels"), "doc_id", "left")
    return filters.quarantine(d, C("toxic") == 1, "lang", ["speech"])


simple("p18_needs_screen", "SELECT doc_id, lang IN ('de', 'fr') AND source NOT IN ('src0', 'src1') AS screen FROM documents", "documents")(
    lambda d: d.select("doc_id", filters.needs_screen(C("lang"), C("source"), ["de", "fr"], ["src0", "src1"]).alias("screen")))
simple("p20_derive_label", "SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 THEN l_returnflag || '_distant' WHEN l_linestatus = 'O' THEN l_returnflag || '_auto' ELSE l_returnflag END AS label FROM lineitem", "lineitem")(
    lambda d: d.select("l_orderkey", "l_linenumber", filters.derive_label(C("l_returnflag"), C("l_quantity") > 40, C("l_linestatus") == "O").alias("label")))


@query("p17_ratio_eligible", """SELECT a.conv_id, a.turn FROM (SELECT conv_id, turn, len(regexp_extract_all(lower(text), '[a-z0-9'']+|[,.?!]')) AS n FROM conversations) a JOIN
  (SELECT conv_id, turn, len(regexp_extract_all(lower(text), '[a-z0-9'']+|[,.?!]')) AS n FROM conversations) b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 WHERE b.n > 0 AND a.n::DOUBLE / b.n BETWEEN 0.8 AND 1.25""")
def p17(spark, sf):
    from sparrowmill.operators.text import tokens

    t = read(spark, sf, "conversations").select("conv_id", "turn", F.size(tokens(C("text"))).alias("n"))
    return t.join(t.select("conv_id", (C("turn") - 1).alias("turn"), C("n").alias("m")), ["conv_id", "turn"]).where(filters.ratio_eligible(C("n"), C("m"))).select("conv_id", "turn")


S = split_sql("o_orderkey")
L = split_sql("l_orderkey")
simple("q2_check_ids", status("ids", f"SELECT count(*) AS n_bad FROM (SELECT l_partkey FROM (SELECT l_partkey, {L} AS s FROM lineitem) GROUP BY 1 HAVING min(s) <> max(s))"), "lineitem")(
    lambda d: audits.check_groups(d, "l_partkey", keyed.hash_split(C("l_orderkey")), "ids"))
_P = f"(SELECT l_suppkey AS p, min(l_orderkey) AS i0, max(l_orderkey) AS i1, min({L}) AS s0, max({L}) AS s1 FROM lineitem GROUP BY 1)"
simple("q3_check_reuse", status("suppliers reused", f"SELECT count(*) AS n_bad FROM {_P} WHERE i0 <> i1", "WARN") + " UNION ALL " + status("suppliers across splits", f"SELECT count(*) AS n_bad FROM {_P} WHERE s0 <> s1"), "lineitem")(
    lambda d: audits.check_reuse(d.select("l_orderkey", "l_suppkey"), "l_orderkey", "l_suppkey", keyed.hash_split(C("l_orderkey")), "suppliers"))


@query("q4_check_agree", status("customers agree", f"SELECT count(*) AS n_bad FROM customer JOIN orders ON c_custkey = o_orderkey WHERE {split_sql('c_name')} <> {S}"))
def q4(spark, sf):
    a = read(spark, sf, "customer").select(C("c_custkey").alias("k"), keyed.hash_split(C("c_name")).alias("split"))
    b = read(spark, sf, "orders").select(C("o_orderkey").alias("k"), keyed.hash_split(C("o_orderkey")).alias("split"))
    return audits.check_agree(a, b, "k", "split", "customers agree")


@query("q6_check_files", status("files", f"SELECT count(*) AS n_bad FROM (SELECT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25) GROUP BY 1 HAVING min({L}) <> max({L}))"))
def q6(spark, sf):
    plan = read(spark, sf, "lineitem").select(C("l_partkey").alias("p_partkey"), keyed.hash_split(C("l_orderkey")).alias("split"))
    return audits.check_files(plan, "p_partkey", "split", read(spark, sf, "part").where("p_size > 25"), "files")


@query("q7_check_recordings", status("recordings", f"SELECT count(*) AS n_bad FROM (SELECT p_brand, p_type FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2 HAVING min({L}) <> max({L}))"))
def q7(spark, sf):
    plan = read(spark, sf, "lineitem").select(C("l_partkey").alias("p_partkey"), keyed.hash_split(C("l_orderkey")).alias("split"))
    return audits.check_recordings(plan, read(spark, sf, "part"), "p_partkey", "split", ["p_brand", "p_type"], "recordings")


simple("q8_check_windows", status("windows", "SELECT count(*) AS n_bad FROM events WHERE value < user_id % 40 - 1e-6 OR value > user_id % 40 + 30 + 1e-6"), "events")(
    lambda d: audits.check_windows(d, C("value"), (C("user_id") % 40).cast("double"), (C("user_id") % 40 + 30).cast("double"), "windows"))
simple("q10_check_seeds", """SELECT 'seeds' AS name, CASE WHEN n_bad <= greatest(3.0, 3 * expected) THEN 'PASS' ELSE 'FAIL' END AS status, n_bad, expected FROM
  (SELECT (count(*) - count(DISTINCT l_partkey))::BIGINT AS n_bad, count(*)::DOUBLE * count(*) / 2 / 2147483648.0 AS expected FROM lineitem)""", "lineitem")(lambda d: audits.check_seeds(d, "l_partkey", 31, "seeds"))


@query("q11_check_coverage", status("coverage", f"""SELECT count(*) AS n_bad FROM (SELECT n_name, s FROM nation, (VALUES ('train'), ('val'), ('test')) t(s)) w
  WHERE NOT EXISTS (SELECT 1 FROM customer JOIN nation n2 ON c_nationkey = n_nationkey WHERE n2.n_name = w.n_name AND {split_sql('c_name')} = w.s AND c_acctbal > 9000)""", "WARN"))
def q11(spark, sf):
    n = read(spark, sf, "nation")
    wanted = n.select("n_name", F.explode(F.array(*map(F.lit, ("train", "val", "test")))).alias("split"))
    have = read(spark, sf, "customer").where("c_acctbal > 9000").join(n, C("c_nationkey") == C("n_nationkey")).select("n_name", keyed.hash_split(C("c_name")).alias("split"))
    return audits.check_coverage(wanted, have, ["n_name", "split"], "coverage")


_G = f"(SELECT text, count(*) AS n, s FROM (SELECT text, {split_sql('doc_id')} AS s FROM documents) GROUP BY text, s)"
simple("q12_duplicates_by_split", status("text within", f"SELECT count(*) AS n_bad FROM (SELECT text FROM {_G} GROUP BY text HAVING max(n) > 1)") + " UNION ALL "
       + status("text across", f"SELECT count(*) AS n_bad FROM (SELECT text FROM {_G} GROUP BY text HAVING count(*) > 1)"), "documents")(
    lambda d: audits.check_duplicates_by_split(d, "text", keyed.hash_split(C("doc_id")), "text"))
simple("q13_check_product", status("product", f"SELECT count(*) AS n_bad FROM (SELECT {_X} AS x FROM embeddings) WHERE list_max(list_transform(x, lambda v: abs(v * v - round(v * v, 2)))) > 0.0049"), "embeddings")(
    lambda d: audits.check_product(doubles(d).withColumn("s", F.transform("x", lambda v: F.round(v * v, 2))), "x", "x", "s", 0.0049, "product"))
simple("q14_describe_design", "SELECT 'value' AS stat, avg(value) AS mean, median(value) AS median FROM events UNION ALL SELECT 'user_id', avg(user_id), median(user_id) FROM events", "events")(
    lambda d: audits.describe_design(d, ["value", "user_id"]))
simple("q15_check_determinism", status("rebuild", "SELECT count(*) AS n_bad FROM orders WHERE o_orderkey % 100 = 7"), "orders")(
    lambda d: audits.check_determinism(d.select("o_orderkey", "o_totalprice"), d.select("o_orderkey", F.when(C("o_orderkey") % 100 == 7, -1.0).otherwise(C("o_totalprice")).alias("o_totalprice")), "o_orderkey", "rebuild"))
simple("q16_check_snr", status("snr", f"SELECT count(*) AS n_bad FROM (SELECT {_RMS.format('x')} AS r, x[1] AS f FROM (SELECT {_X} AS x FROM embeddings)) WHERE NOT abs(r - abs(f)) <= 0.1"), "embeddings")(
    lambda d: audits.check_within(doubles(d), signals.rms(C("x")), F.abs(F.element_at("x", 1)), 0.1, "snr"))
simple("q17_check_spans", status("spans", """SELECT count(*) AS n_bad FROM (SELECT user_id, sqrt(avg(CASE WHEN event_type = 'click' THEN value * value END)) AS a,
  sqrt(avg(CASE WHEN event_type <> 'click' THEN value * value END)) AS b FROM events GROUP BY 1) WHERE a < 1.5 * b"""), "events")(
    lambda d: audits.check_spans(d, "user_id", "value", C("event_type") == "click", 1.5, "spans"))
simple("q18_check_sources", status("sources", f"SELECT count(*) AS n_bad FROM (SELECT {_X} AS x FROM embeddings) WHERE {_MAX.format('x')} < 0.22"), "embeddings")(
    lambda d: audits.check_sources(doubles(d), F.size("x"), signals.peak(C("x")), "sources", 0.22))
_PC = f"(SELECT vec_id, {_MAX.format('x')} AS peak, {_MAX.format('x')} / {_RMS.format('x')} AS crest FROM (SELECT vec_id, {_X} AS x FROM embeddings))"


def peak_crest(d):
    return doubles(d).select("vec_id", signals.peak(C("x")).alias("peak"), signals.crest(C("x")).alias("crest"))


@simple("q19_check_support", status("support", f"""SELECT count(*) AS n_bad FROM {_PC} r, (SELECT min(peak) AS a, max(peak) AS b, min(crest) AS c, max(crest) AS d FROM {_PC} WHERE vec_id % 10 = 0) s
  WHERE r.peak < a - 0.01 OR r.peak > b + 0.01 OR r.crest < c - 0.01 OR r.crest > d + 0.01"""), "embeddings")
def q19(d):
    s = peak_crest(d)
    return audits.check_support(s, s.where("vec_id % 10 = 0"), ["peak", "crest"], 0.01, "support")


@simple("q20_check_capture", f"""WITH s AS {_PC}, r AS (SELECT 'peak' AS stat, quantile_cont(peak, 0.02) AS lo, quantile_cont(peak, 0.98) AS hi FROM s UNION ALL SELECT 'crest', quantile_cont(crest, 0.02), quantile_cont(crest, 0.98) FROM s)
  SELECT vec_id, stat, value, value BETWEEN lo - 0.01 AND hi + 0.01 AS ok FROM (SELECT vec_id, 'peak' AS stat, peak AS value FROM s UNION ALL SELECT vec_id, 'crest', crest FROM s) JOIN r USING (stat)""", "embeddings")
def q20(d):
    s = peak_crest(d)
    return audits.check_capture(s, "vec_id", audits.register_ranges(s, ["peak", "crest"]), ["peak", "crest"], 0.01)


simple("q22_audit_content", """SELECT event_id, (value / 100 >= 0.15 OR (value / 100 >= 0.05 AND event_type = 'click')) AND user_id % 10 / 10.0 < 0.3 AND (user_id % 7 / 7.0 < 0.4 OR event_type = 'error') AS ok FROM events""", "events")(
    lambda d: d.select("event_id", audits.audit_content(C("value") / 100, C("event_type") == "click", C("user_id") % 10 / 10.0, C("user_id") % 7 / 7.0, C("event_type") == "error").alias("ok")))
simple("q23_gate", "SELECT event_id, value >= 15 AND user_id % 3 / 2.0 >= 0.5 AS ok FROM events", "events")(lambda d: d.select("event_id", audits.gate(C("value"), C("user_id") % 3 / 2.0).alias("ok")))


@query("q24_promotion_gate", """WITH p AS (SELECT event_type, avg(value) FILTER (WHERE user_id % 2 = 0) AS old, avg(value) FILTER (WHERE user_id % 2 = 1) AS new FROM events GROUP BY 1)
  SELECT event_type, old, new, coalesce(new >= old - CASE event_type WHEN 'click' THEN 5.0 ELSE 0.1 END, false) AS ok FROM p WHERE old IS NOT NULL""")
def q24(spark, sf):
    run = lambda k: read(spark, sf, "events").where(C("user_id") % 2 == k).groupBy("event_type").agg(F.avg("value").alias("v"))
    return audits.promotion_gate(run(0), run(1), "event_type", "v", {"click": 5.0}, 0.1)


_LOG = "SELECT event_id AS seq, 'm' || (user_id % 50) AS path, CASE WHEN event_type = 'error' THEN 'rolled_back' ELSE 'promoted' END AS state FROM events"


def log(d):
    return d.select(C("event_id").alias("seq"), F.concat(F.lit("m"), C("user_id") % 50).alias("path"), F.when(C("event_type") == "error", "rolled_back").otherwise("promoted").alias("state"))


simple("q25_current_model", f"SELECT arg_max(path, seq) AS path, max(seq) AS seq FROM (SELECT path, max(seq) AS seq, arg_max(state, seq) AS state FROM ({_LOG}) GROUP BY path) WHERE state = 'promoted'", "events")(
    lambda d: audits.current_model(log(d), "seq", "path", "state"))
simple("q25_rollback", f"""SELECT (SELECT max(seq) + 1 FROM ({_LOG})) AS seq, arg_max(path, seq) AS path, 'rolled_back' AS state FROM (SELECT path, max(seq) AS seq, arg_max(state, seq) AS state FROM ({_LOG}) GROUP BY path) WHERE state = 'promoted'""", "events")(
    lambda d: audits.rollback(log(d), "seq", "path", "state"))


@query("q26_check_batch", status("batch", f"SELECT count(*) AS n_bad FROM lineitem LEFT JOIN (SELECT o_orderkey, {S} AS s, o_orderstatus = 'P' AS e FROM orders) ON l_orderkey = o_orderkey WHERE l_quantity > 45 AND (s IS NULL OR s <> 'train' OR e)"))
def q26(spark, sf):
    batch = read(spark, sf, "lineitem").where("l_quantity > 45").select(C("l_orderkey").alias("o_orderkey"))
    m = read(spark, sf, "orders").withColumn("split", keyed.hash_split(C("o_orderkey")))
    return audits.check_batch(batch, m, "o_orderkey", "train", "split", C("o_orderstatus") == "P", "batch")


@query("q27_check_config", "WITH c AS (SELECT p_type AS scenario, p_brand AS label, CASE WHEN p_size > 25 THEN 'far' ELSE 'near' END AS role, p_size / 50.0 AS w FROM part), l AS (SELECT DISTINCT p_brand AS label, 'near' AS role FROM part WHERE p_size < 10) "
       + status("labels", "SELECT count(*) AS n_bad FROM c WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.label = c.label AND l.role = c.role)") + " UNION ALL "
       + status("weights sum", "SELECT count(*) AS n_bad FROM (SELECT scenario FROM c GROUP BY 1 HAVING abs(sum(w) - 1) >= 1e-6)") + " UNION ALL "
       + status("weights range", "SELECT count(*) AS n_bad FROM c WHERE NOT w BETWEEN 0 AND 1"))
def q27(spark, sf):
    p = read(spark, sf, "part")
    c = p.select(C("p_type").alias("scenario"), C("p_brand").alias("label"), F.when(C("p_size") > 25, "far").otherwise("near").alias("role"), (C("p_size") / 50.0).alias("w"))
    return audits.check_config(c, p.where("p_size < 10").select(C("p_brand").alias("label"), F.lit("near").alias("role")), "scenario", "label", "role", "w")
