"""Registered queries of radio transcripts, word scores and class imports. Transcripts are spoken
forms of the numbers of a table's rows, so that SQL knows what they say."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparrowmill.operators import filters, radio, scores, spans, text
from sparrowmill.plans.registry import query, read, simple, u_sql
from sparrowmill.sources import files

C = F.col
SPOKEN = ["zero", "wun", "two", "tree", "fower", "fife", "six", "seven", "ait", "niner"]
_NAMES = "[" + ", ".join(f"'{w}'" for w in SPOKEN) + "]"
_P4 = "lpad((l_partkey % 10000)::VARCHAR, 4, '0')"
_KEYS = "l_orderkey, l_linenumber, l_partkey"


# Six reports by key: contact, no sender, no contact, an odd digit run, two grids, casualties.
_T = "l_partkey % 6"
_N = "l_linenumber"
_HEAD = f"'bravo 26, this is alpha ' || {_N} || ', '"
_NORM = f"""CASE {_T} WHEN 0 THEN {_HEAD} || 'contact front, squad size enemy, grid ' || {_P4} || ', over' WHEN 1 THEN 'bravo 26, radio check, how do you read, over'
  WHEN 2 THEN {_HEAD} || 'sitrep, no contact, grid ' || {_P4} || ', out' WHEN 3 THEN {_HEAD} || 'moving to grid ' || substr({_P4}, 1, 3) || ', over'
  WHEN 4 THEN {_HEAD} || 'contact left, ' || {_N} || ' enemy, grid ' || {_P4} || ', and grid ' || reverse({_P4}) || ', over'
  ELSE {_HEAD} || 'medevac, ' || {_N} || ' urgent, grid ' || {_P4} || ', over' END"""


def said(d):
    """Line items with `p4` (four digits), `said` (one of six reports that speaks them) and `words` (with probabilities)."""
    names = F.array(*map(F.lit, SPOKEN))
    word = lambda c: F.element_at(names, c.cast("int") + 1)
    d = d.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", F.lpad((C("l_partkey") % 10000).cast("string"), 4, "0").alias("p4"))
    w = [word(F.substring("p4", i, 1)) for i in (1, 2, 3, 4)]
    n = word(C("l_linenumber"))
    say = lambda *parts: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in parts])
    run = lambda *ws: F.array_join(F.array(*ws), " ")
    head = say("Bravo two six, this is alpha ", n, ", ")
    t = C("l_partkey") % 6
    speech = (F.when(t == 0, say(head, "contact front, squad size enemy, great ", run(*w[:2]), ", ", run(*w[2:]), ", over")).when(t == 1, "Bravo two six, radio check, how do you read, over")
              .when(t == 2, say(head, "sitrep, no contact, grid ", run(*w), ", out")).when(t == 3, say(head, "moving to grid ", run(*w[:3]), ", over"))
              .when(t == 4, say(head, "contact left, ", n, " enemy, grade ", run(*w), ", and grid ", run(*w[::-1]), ", over"))
              .otherwise(say(head, "medevac, ", n, " urgent, grid ", w[0], ", ", run(*w[1:]), ", over")))
    p = [F.lit(0.9), C("l_discount") + 0.5, F.lit(0.7), F.lit(0.8)]
    scored = F.array(*[F.struct(x.alias("w"), q.alias("p")) for x, q in zip(w, p)])
    lead = F.array(F.struct(F.lit("grid").alias("w"), F.lit(0.1).alias("p")))
    return d.withColumn("said", speech).withColumn("words", F.when(t == 2, F.concat(lead, scored)).otherwise(scored))


def spoken(name: str, sql: str):
    def add(f):
        simple(name, sql, "lineitem")(lambda d: f(said(d)))
        return f
    return add


K = ["l_orderkey", "l_linenumber", "l_partkey"]
spoken("t2_normalise_numerals", f"SELECT {_KEYS}, {_NORM} AS norm FROM lineitem")(
    lambda d: d.select(*K, radio.normalise_numerals(C("said")).alias("norm")))
spoken("t3_callsign", f"SELECT {_KEYS}, 'B26' AS first, CASE WHEN {_T} <> 1 THEN 'A' || {_N} END AS second, NULL::VARCHAR AS none FROM lineitem")(
    lambda d: d.select(*K, *[radio.callsign_at(radio.radio_words(C("said")), F.lit(i))["sign"].alias(n) for n, i in (("first", 0), ("second", 5), ("none", 1))]))
spoken("t4_extract", f"""SELECT {_KEYS}, 'B26' AS receiver, CASE WHEN {_T} <> 1 THEN 'A' || {_N} END AS sender, CASE {_T} WHEN 1 THEN '' WHEN 3 THEN '' WHEN 4 THEN {_P4} || ',' || reverse({_P4}) ELSE {_P4} END AS grids,
  CASE {_T} WHEN 1 THEN 'radio_check' WHEN 2 THEN 'contact_report,sitrep' WHEN 3 THEN 'movement' WHEN 5 THEN 'medevac' ELSE 'contact_report' END AS types, {_T} IN (0, 4) AS contact,
  CASE {_T} WHEN 0 THEN 'squad' WHEN 4 THEN {_N}::VARCHAR END AS size, CASE {_T} WHEN 0 THEN 'front' WHEN 4 THEN 'left' END AS direction, CASE WHEN {_T} = 2 THEN 'out' ELSE 'over' END AS closing,
  CASE WHEN {_T} = 5 THEN {_N}::INT END AS casualties FROM lineitem""")(
    lambda d: radio.with_extraction(d, "said").select(*K, "receiver", "sender", F.array_join("grids", ",").alias("grids"), F.array_join("types", ",").alias("types"), "contact", "size", "direction", "closing", "casualties"))
spoken("t5_grounded", f"SELECT {_KEYS}, contains({_NORM}, l_suppkey::VARCHAR) AS ok FROM lineitem")(lambda d: d.select(*K, radio.grounded(C("l_suppkey"), C("said")).alias("ok")))
spoken("t6_grid_to_xy", f"SELECT {_KEYS}, substr({_P4}, 1, 2)::BIGINT * 1000 + 500 AS easting, substr({_P4}, 3, 2)::BIGINT * 1000 + 500 AS northing, 500.0::DOUBLE AS half, {_P4} AS back FROM lineitem")(
    lambda d: d.select(*K, radio.grid_to_xy(C("p4")).alias("g")).select(*K, "g.easting", "g.northing", "g.half", radio.xy_to_grid(C("g.easting"), C("g.northing"), 4).alias("back")))
spoken("t7_number_confidence", f"SELECT {_KEYS}, CASE WHEN {_T} <> 3 OR {_P4} = reverse({_P4}) THEN (0.9 + l_discount + 0.5 + 0.7 + 0.8) / 4 END AS conf FROM lineitem")(
    lambda d: d.select(*K, radio.number_confidence(F.when(C("l_partkey") % 6 == 3, F.reverse("p4")).otherwise(C("p4")), C("words")).alias("conf")))
spoken("t8_collapse_loops", f"""SELECT {_KEYS}, CASE {_T} % 3 WHEN 1 THEN repeat('go stop ', {_N}) || 'end' WHEN 2 THEN CASE WHEN {_N} > 4 THEN 'start' || repeat(' Go, go.', 2) || ' Go, [unreliable: repetition]' ELSE 'start ' || repeat('Go, go. ', {_N} // 2) || 'end' END
  ELSE CASE WHEN {_N} > 5 THEN 'go go go go go [unreliable: repetition]' ELSE repeat('go ', {_N}) || 'end' END END AS s FROM lineitem""")(
    lambda d: d.select(*K, radio.collapse_loops(F.when(C("l_partkey") % 3 == 1, F.concat(F.repeat(F.lit("go stop "), C("l_linenumber")), F.lit("end")))
                                                .when(C("l_partkey") % 3 == 2, F.concat(F.lit("start "), F.repeat(F.lit("Go, go. "), F.when(C("l_linenumber") > 4, 3).otherwise(F.floor(C("l_linenumber") / 2).cast("int"))), F.lit("end")))
                                                .otherwise(F.concat(F.repeat(F.lit("go "), C("l_linenumber")), F.lit("end")))).alias("s")))
_ENGLISH = "['zero', 'one', 'two', 'three', 'four', 'five', 'six', 'seven', 'eight', 'nine']"
simple("t10_expand_words", f"SELECT k, pos::INT AS pos, {_ENGLISH}[substr(p4, pos + 1, 1)::INT + 1] AS w, q + pos / 4.0 AS start, q + (pos + 1) / 4.0 AS stop FROM (SELECT l_orderkey * 100 + l_linenumber AS k, l_quantity AS q, {_P4} AS p4, unnest(range(4)) AS pos FROM lineitem)", "lineitem")(
    lambda d: radio.expand_words(said(d).select((C("l_orderkey") * 100 + C("l_linenumber")).alias("k"), "p4", C("l_quantity").alias("q"), (C("l_quantity") + 1).alias("e")), "k", "p4", "q", "e"))
spoken("t11_check_citations", f"SELECT {_KEYS}, CASE WHEN l_partkey % 7 = 3 THEN 'tx3' ELSE '' END AS cited, l_partkey % 7 <> 3 AS unverified FROM lineitem")(
    lambda d: d.select(*K, radio.check_citations(F.concat(F.lit("see [tx"), C("l_partkey") % 7, F.lit("] and [op9]")), F.array(F.lit("tx3"), F.lit("op1"))).alias("c")).select(*K, F.array_join("c.citations", ",").alias("cited"), "c.unverified"))
simple("t12_merge_decisions", "SELECT event_id, CASE WHEN value > 60 AND event_type <> 'click' THEN 'click,' || event_type ELSE 'click' END AS types, user_id % 2 = 0 OR value > 70 AS contact FROM events", "events")(
    lambda d: d.select("event_id", radio.merge_decisions(F.array(F.lit("click")), C("event_type"), C("value") / 100, C("user_id") % 2 == 0, C("value") / 100).alias("m")).select("event_id", F.array_join("m.types", ",").alias("types"), "m.contact"))
_CONF = "(0.9 + l_discount + 0.5 + 0.7 + 0.8) / 4"


def marked(d):
    d = said(d).withColumn("tx", C("l_orderkey") * 100 + C("l_linenumber"))
    return radio.with_extraction(d, "said")


_MARKED = f"SELECT *, {_T} AS t, {_P4} AS p4 FROM lineitem WHERE {_T} NOT IN (1, 3)"
simple("l2_ingest", f"""SELECT l_orderkey * 100 + l_linenumber AS tx, grid, CASE t WHEN 2 THEN 'friendly' WHEN 5 THEN 'casualty' ELSE 'enemy' END AS kind,
  CASE WHEN sure THEN '' ELSE 'UNCONFIRMED ' END || CASE t WHEN 0 THEN 'Enemy squad' WHEN 2 THEN 'A' || l_linenumber WHEN 4 THEN 'Enemy ' || l_linenumber ELSE 'CASEVAC ' || l_linenumber || ' urgent' END AS label, 'A' || l_linenumber AS sender, sure AS confirmed, 500.0::DOUBLE AS half_m
  FROM (SELECT *, grid <> p4 OR {_CONF} >= 0.75 AS sure FROM (SELECT *, unnest(CASE WHEN t = 4 THEN [p4, reverse(p4)] ELSE [p4] END) AS grid FROM ({_MARKED})))""", "lineitem")(
    lambda d: radio.markers(marked(d), "tx", "l_quantity", "words").select("tx", "grid", "kind", "label", "sender", "confirmed", "half_m"))
simple("l4_enrich", f"""SELECT l_orderkey * 100 + l_linenumber AS tx, array_to_string(list_filter([CASE WHEN {_T} = 0 AND l_quantity > 25 THEN 'direction_said' END, CASE WHEN {_T} = 0 THEN 'enemy_size' END,
  CASE WHEN (l_quantity > 10) = ({_T} NOT IN (1, 3)) THEN 'grid_digits' END, CASE WHEN {_T} <> 1 AND l_linenumber = 3 THEN 'sender_said' END], lambda v: v IS NOT NULL), ',') AS kept FROM lineitem""", "lineitem")(
    lambda d: radio.enrich(marked(d).withColumns({"direction_said": F.when(C("l_quantity") > 25, "front").otherwise("squad"), "enemy_size": F.lit("squad"), "grid_digits": F.when(C("l_quantity") > 10, C("p4")).otherwise(F.lit("26")),
                                                  "sender_said": F.lit("alpha tree")}), ["direction_said", "enemy_size", "grid_digits", "sender_said"], "said").select("tx", F.array_join("kept", ",").alias("kept")))


@query("l7_snapshot", "SELECT record, id FROM (SELECT 'marker' AS record, event_id AS id FROM events WHERE event_type = 'click' UNION ALL (SELECT 'transmission', event_id FROM events ORDER BY ts DESC LIMIT 200))")
def l7(spark, sf):
    e = read(spark, sf, "events").select(C("event_id").alias("id"), C("event_type").alias("kind"), "ts")
    return radio.snapshot(e, e.drop("kind"), "ts", 200, "click").select("record", "id")


# Word scores over neighbouring turns: the assistant's turn against the user's before it.
_TOK = "regexp_extract_all(lower(text), '[a-z0-9'']+|[,.?!]')"
_TURNS = f"(SELECT a.conv_id, a.turn, a.w AS r, b.w AS h FROM (SELECT conv_id, turn, {_TOK} AS w FROM conversations) a JOIN (SELECT conv_id, turn, {_TOK} AS w FROM conversations) b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1)"


def turns(spark, sf):
    t = read(spark, sf, "conversations").select("conv_id", "turn", text.tokens(C("text")).alias("r"))
    return t.join(t.select("conv_id", (C("turn") - 1).alias("turn"), C("r").alias("h")), ["conv_id", "turn"])


_VOCAB = ["the", "la", "die", "de", "and", "el"]
_IN = "(" + ", ".join(f"'{w}'" for w in _VOCAB) + ")"


@query("m9_keyword_recall", f"SELECT conv_id, turn, len(list_filter(r, lambda t: t IN {_IN} AND list_contains(h, t)))::DOUBLE / nullif(len(list_filter(r, lambda t: t IN {_IN})), 0) AS recall FROM {_TURNS}")
def m9(spark, sf):
    return turns(spark, sf).select("conv_id", "turn", scores.keyword_recall(C("r"), C("h"), _VOCAB).alias("recall"))


# Rows of the edit table one by one: a recursion over the reference, a fold over the hypothesis.
@query("m10_word_errors", f"""WITH RECURSIVE p AS (SELECT conv_id, turn, r, h, 0 AS i, range(len(h) + 1) AS d FROM {_TURNS} UNION ALL
  SELECT conv_id, turn, r, h, i + 1, list_reduce(list_transform(range(1, len(h) + 1), lambda j: [j]), lambda a, j: list_append(a, least(a[-1] + 1, d[j[1] + 1] + 1, d[j[1]] + (r[i + 1] <> h[j[1]])::BIGINT)), [i + 1::BIGINT]) FROM p WHERE i < len(r))
  SELECT conv_id, turn, d[-1] AS errors FROM p WHERE i = len(r)""")
def m10(spark, sf):
    return turns(spark, sf).select("conv_id", "turn", scores.word_errors(C("r"), C("h")).alias("errors"))


@query("m12_invented_rate", f"SELECT avg((len(h) > 20)::INT) AS invented_rate FROM {_TURNS} WHERE len(list_filter(r, lambda t: t = 'la')) = 0")
def m12(spark, sf):
    return scores.invented_rate(turns(spark, sf), F.filter("r", lambda t: t == "la"), F.when(F.size("h") > 20, C("h")).otherwise(F.array().cast("array<string>")))


spoken("m11_ref_error", f"SELECT {_KEYS}, least(levenshtein({_P4}, lpad(l_suppkey::VARCHAR, 4, '0')), levenshtein({_P4}, '1234')) / 4.0 AS err FROM lineitem")(
    lambda d: d.select(*K, scores.ref_error(C("p4"), F.array(F.lpad(C("l_suppkey").cast("string"), 4, "0"), F.lit("1234"))).alias("err")))
# What a recogniser confuses, the digits it writes, and its fillers.
CONFUSE = {
    "the": ["a", "thee", ""],
    "la": ["là", "le la"],
    "der": ["dear", "there", "der"],
    "que": ["qué", ""],
    "and": ["end", "an", "and"],
}
WRITTEN = {"one": "1", "two": "2", "in": "1", "un": "1", "die": "2", "de": "3", "on": "4"}
FILLERS = ["the", "a", "uh", "and", "is"]


def _token_u(stage: str) -> str:
    return "(" + u_sql(f"concat_ws(chr(58), '7', conv_id || '-' || turn || '.' || i, '{stage}')") + " / 4294967296.0)"


def _from(options: list[str], stage: str) -> str:
    return "[" + ", ".join(f"'{o}'" for o in options) + f"][floor({_token_u(stage)} * {len(options)})::INT + 1]"


_WRONG = " ".join(f"WHEN t = '{w}' AND {_token_u('token')} < 0.48 THEN {_from(alts, 'which')}" for w, alts in CONFUSE.items())
_DIGIT = " ".join(f"WHEN t = '{w}' AND {_token_u('token')} < 0.36 THEN '{d}'" for w, d in WRITTEN.items())
_JOIN = u_sql("concat_ws(chr(58), '7', conv_id || '-' || turn, 'join')") + " / 4294967296.0"
simple("d19_corrupt_text", rf"""WITH k AS (SELECT conv_id, turn, unnest(w) AS t, unnest(range(len(w))) AS i FROM (SELECT conv_id, turn, regexp_extract_all(lower(text), '[a-z\-'']+|[0-9]+') AS w FROM conversations)),
  h AS (SELECT conv_id, turn, i, CASE {_WRONG} {_DIGIT} ELSE t END AS heard, CASE WHEN {_token_u('insert')} < 0.03 THEN {_from(FILLERS, 'filler')} ELSE '' END AS more FROM k WHERE {_token_u('token')} >= 0.09),
  j AS (SELECT conv_id, turn, string_agg(w, ' ' ORDER BY i, o) AS s FROM (SELECT conv_id, turn, i, 0 AS o, heard AS w FROM h UNION ALL SELECT conv_id, turn, i, 1, more FROM h) WHERE w <> '' GROUP BY conv_id, turn)
  SELECT c.conv_id, c.turn, md5(CASE WHEN {_JOIN.replace('conv_id', 'c.conv_id').replace(' turn', ' c.turn')} < 0.5 THEN regexp_replace(regexp_replace(coalesce(s, ''), '([0-9]) ([0-9])', '\1\2', 'g'), '([0-9]) ([0-9])', '\1\2', 'g') ELSE coalesce(s, '') END) AS h
  FROM conversations c LEFT JOIN j USING (conv_id, turn)""", "conversations")(
    lambda d: d.select("conv_id", "turn", F.md5(F.encode(spans.noisy_text(C("text"), F.concat_ws("-", "conv_id", "turn"), 0.3, CONFUSE, WRITTEN, FILLERS, 7), "UTF-8")).alias("h")))
# Two runs with a mark between them; a run beyond five is cut behind its fifth word.
simple("w6_truncate_runs", """SELECT l_orderkey, l_linenumber, l_partkey, (CASE WHEN l_linenumber > 5 THEN 5 WHEN l_partkey % 9 > 5 THEN l_linenumber + 6 ELSE l_linenumber + 1 + l_partkey % 9 END)::INT AS n,
  l_linenumber > 5 OR l_partkey % 9 > 5 AS cut FROM lineitem""", "lineitem")(
    lambda d: d.select(*K, F.concat(F.array_repeat(C("l_returnflag"), C("l_linenumber")), F.array(F.lit("mark")), F.array_repeat(C("l_linestatus"), (C("l_partkey") % 9).cast("int"))).alias("w")).withColumn("n", radio.loop_cut(C("w"), 5)).select(*K, "n", (C("n") < F.size("w")).alias("cut")))

# Imports
simple("s5_predominant", "SELECT event_id, event_type AS cls FROM events WHERE value >= 1 AND user_id % 5 >= 1", "events")(
    lambda d: d.select("event_id", F.explode(files.predominant(F.create_map("event_type", F.array(C("value"), (C("user_id") % 5).cast("double"))))).alias("cls")))
simple("s16_import_by_class", "SELECT doc_id, CASE lang WHEN 'de' THEN 'german' ELSE 'french' END AS cls FROM documents WHERE lang IN ('de', 'fr')", "documents")(
    lambda d: filters.import_by_class(d, "lang", {"de": "german", "fr": "french", "en": "english"}, ["en"]).select("doc_id", "cls"))
simple("s4_label_join", "SELECT page_id, CASE WHEN contains(url, '/fr/') THEN 'french' WHEN contains(url, '/de/') THEN 'german' END AS label FROM pages WHERE contains(url, '/fr/') OR contains(url, '/de/')", "pages")(
    lambda d: files.join_labels(d.select("page_id", "url"), F.regexp_extract("url", r"^https?://[^/]+/([a-z]+)/", 1), d.sparkSession.createDataFrame([("fr", "french"), ("de", "german")], "file string, label string"), "file").select("page_id", "label"))


@query("s18_join_scores", "SELECT lpad(doc_id::VARCHAR, 8, '0') AS id, quality, lang FROM documents JOIN labels USING (doc_id)")
def s18(spark, sf):
    key = F.lpad(C("doc_id").cast("string"), 8, "0").alias("id")
    return files.join_scores(read(spark, sf, "labels").select(key, "quality"), read(spark, sf, "documents").select(key, "lang"), "id").select("id", "quality", "lang")
