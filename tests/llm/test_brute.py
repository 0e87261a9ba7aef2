"""Operators against plain versions on small fixtures."""
import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.llm import bpe, chat_format, decontaminate, hmm_lm, jaccard_join, quality, scan, suffix_dedup, toxicity

R = random.Random(11)
VOCAB = ["".join(R.choices("abcdefg", k=R.randrange(2, 7))) for _ in range(120)] + ["É", "ärger", "x1"]
BIG = 9007199254740993
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def prose(n):
    return " ".join(R.choices(VOCAB, k=n))


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], "doc_id bigint, text string, node string, row int").repartition(4)


def near_rows():
    """Bases with edits from none to a third of the words, copies, short, empty and null texts, repeated and null ids."""
    rows, i = [], 0
    for _ in range(25):
        base = R.choices(VOCAB, k=R.randrange(3, 120))
        for edits in (0, 0, 1, 2, 4, 8):
            ws = list(base)
            for _ in range(min(edits, len(ws) - 1)):
                ws[R.randrange(len(ws))] = R.choice(VOCAB)
            rows.append((i, R.choice([" ", ", ", "\n"]).join(ws)))
            i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, "  !?"), (None, rows[0][1]), (None, "only here and there"), (5, rows[6][1]), (5, prose(40)), (BIG, rows[12][1]), (BIG, rows[12][1])]
    return rows


def test_words_are_those_of_the_pattern():
    texts = ["Ab, cd-Ef É’x\u2028y", "", "0a`b{c", prose(50)]
    w = scan.scan([t.encode() for t in texts])
    got = [[w.word(i).decode() for i in range(a, b)] for a, b in zip(w.first[:-1], w.first[1:])]
    assert got == [words(t) for t in texts]
    g = scan.scan(["A\x00b\x0bc\xa0d \t e".encode()], scan.GRAPH)
    assert [g.word(i).decode() for i in range(len(g.hash))] == re.findall(r"[^\x20\x09-\x0D]+", "a\x00b\x0bc\xa0d \t e")


def test_jaccard_equals_all_pairs(spark):
    rows = near_rows()
    nodes = {}
    for _, t in rows:
        ws = tuple(words(t))
        if ws:
            nodes.setdefault(ws, {ws[k:k + 5] for k in range(max(1, len(ws) - 4))})
    links, root = collections.Counter(), {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(nodes, 2):
        if len(nodes[a] & nodes[b]) >= 0.8 * len(nodes[a] | nodes[b]) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    tops = {}
    for i, t in rows:
        if ws := tuple(words(t)):
            tops.setdefault(find(ws), []).append(i)
    want = []
    for i, t in rows:
        ws = tuple(words(t))
        top = max((x for x in tops[find(ws)] if x is not None), default=None) if ws else i
        want.append((i, top, links[ws] if ws else 0, top == i))
    got = [tuple(r) for r in jaccard_join.jaccard_join(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(links.values()) > 40


def test_prefixes_are_shortened_until_the_recall_is_met():
    rng = np.random.default_rng(3)
    found = total = 0
    for _ in range(60):
        base = rng.integers(0, 2**63, 200, dtype="uint64")
        other = base.copy()
        other[:22] = rng.integers(0, 2**63, 22, dtype="uint64")  # similarity 178 / 222, just above 0.8
        sig = np.stack([np.frombuffer(jaccard_join.signature(np.unique(x)), "uint16").reshape(jaccard_join.TREES, -1) for x in (base, other, rng.integers(0, 2**63, 200, dtype="uint64"))])
        a, b = jaccard_join.near_pairs(sig, 0.8, 0.9999)
        total += 1
        found += (0, 1) in set(zip(a.tolist(), b.tolist()))
        assert all((x, y) == (0, 1) for x, y in zip(a.tolist(), b.tolist()))
    assert found == total
    assert jaccard_join.floor_depth() < jaccard_join.DEPTH


def test_language_model_counts_equal_a_plain_count(spark):
    rows = [(i, prose(R.randrange(0, 60)) + (" Unseen%d" % i if i % 7 == 0 else "")) for i in range(60)] + [(None, prose(5)), (60, None), (3, prose(9)), (61, "a\x00b\x85c d"), (BIG, "LAST one")]
    tok = lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [""]
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    c = collections.Counter(w for i, t in rows if not held(i) for w in tok(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i, held(i), len(tok(t)), sum(c[w] > 0 for w in tok(t)), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tok(t)), 6)) for i, t in rows), key=str)
    got = hmm_lm.score_lm(frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=str) == want
    assert any(r.held_out for r in got) and all(r.score < 0 for r in got)


def test_rare_words_give_the_same_as_frequent_ones(spark, monkeypatch):
    rows = [(i, prose(30)) for i in range(40)]
    whole = {r.doc_id: (r.base_score, r.n_known) for r in hmm_lm.score_lm(frame(spark, rows)).collect()}
    monkeypatch.setattr(hmm_lm, "HOT_WORDS", 20)
    for r in hmm_lm.score_lm(frame(spark, rows)).collect():
        assert (pytest.approx(whole[r.doc_id][0]), whole[r.doc_id][1]) == (r.base_score, r.n_known)


def test_forward_and_counts_equal_plain_recursions():
    rng = np.random.default_rng(1)
    pi, a, e = (hmm_lm._normal(rng.random(s), 0.1) for s in ((3,), (3, 3), (3, 5)))
    seqs = [rng.integers(0, 5, n) for n in (1, 7, 4, 7, 2)]
    x, lengths = np.concatenate(seqs), np.array([len(s) for s in seqs])
    c_pi, c_a, c_e, want = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 5)), []
    for s in seqs:
        paths = list(itertools.product(range(3), repeat=len(s)))
        p = np.array([pi[h[0]] * e[h[0], s[0]] * np.prod([a[h[i - 1], h[i]] * e[h[i], s[i]] for i in range(1, len(s))]) for h in paths])
        want.append(np.log10(p.sum()))
        for h, q in zip(paths, p / p.sum()):
            c_pi[h[0]] += q
            for i, k in enumerate(h):
                c_e[k, s[i]] += q
                if i:
                    c_a[h[i - 1], k] += q
    assert np.allclose(hmm_lm.forward(seqs, pi, a, e), want)
    for got, plain in zip(hmm_lm.expected_counts(x, np.cumsum(lengths) - lengths, lengths, pi, a, e), (c_pi, c_a, c_e)):
        assert np.allclose(got, plain, rtol=1e-4, atol=1e-4)
    assert list(zip(*hmm_lm._segments(np.array([5, 2]), 2))) == [(0, 2), (2, 2), (4, 1), (5, 2)]


def test_decontamination_equals_a_plain_search(spark):
    items = [(str(k), prose(n)) for k, n in enumerate((5, 13, 14, 30, 40, 1))] + [("6", ""), ("3", prose(20))]
    rows = [(i, prose(R.randrange(0, 40)) + " " + " ".join(words(R.choice(items)[1])[R.randrange(4):]) + " " + prose(R.randrange(0, 300))) for i in range(60)] + [(None, items[3][1]), (7, items[4][1]), (7, items[4][1]), (BIG, None)]
    want = []
    for i, t in rows:
        ws, hit, its, longest = words(t), set(), set(), 0
        for name, item in items:
            iw = words(item)
            k = min(13, len(iw))
            for p in range(len(iw) - k + 1 if k else 0):
                for q in range(len(ws) - k + 1):
                    if ws[q:q + k] == iw[p:p + k]:
                        hit.update(range(q, q + k))
                        its.add(name)
                        n = k
                        while q + n < len(ws) and p + n < len(iw) and ws[q + n] == iw[p + n]:
                            n += 1
                        longest = max(longest, n)
        want.append((i, len(ws), len(hit), len(its), bool(hit) and 20 * len(hit) >= len(ws), longest))
    bench = spark.createDataFrame(items, "item_id string, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated, r.longest_words) for r in decontaminate.decontaminate(frame(spark, rows), bench).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("limit", [suffix_dedup.LIMIT, 400])
def test_suffix_dedup_equals_a_plain_scan(spark, limit):
    passage = [prose(40) for _ in range(4)]
    rows = [(i, prose(R.randrange(0, 40)) + R.choice(passage)[R.randrange(30):] + prose(R.randrange(0, 30)) + R.choice(passage)) for i in range(60)]
    rows += [(60, "ab" * 300), (61, "xab" * 150), (62, rows[3][1]), (63, None), (BIG, rows[4][1])]
    seen, want = set(), []
    for i, t in sorted(rows):
        b = (t or "").encode()
        m = bytearray(len(b))
        for k in range(len(b) - 99):
            if b[k:k + 100] in seen:
                m[k:k + 100] = b"\1" * 100
            seen.add(b[k:k + 100])
        want.append((i, sum(m), len(re.findall(b"\1+", bytes(m)))))
    got = sorted((r.doc_id, r.n_removed, r.n_spans) for r in suffix_dedup.suffix_dedup(frame(spark, rows), limit).collect())
    assert got == want


def test_large_ids_stay_whole_beside_null_ids(spark):
    import public_tokenizers

    rows = frame(spark, [(BIG, "some text"), (None, "other"), (BIG + 2, None)])
    labels = spark.createDataFrame([(1, 0, 0)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, "some")], "item_id bigint, text string")
    outs = [bpe.encode_decode(rows, public_tokenizers.path("byte_bpe_50k.json")), decontaminate.decontaminate(rows, bench), toxicity.score_toxicity(rows, labels), hmm_lm.score_lm(rows),
            jaccard_join.jaccard_join(rows), suffix_dedup.suffix_dedup(rows), quality.score_quality(rows, labels.select("doc_id", F.col("quality").alias("grade")))]
    for out in outs:
        assert {r.doc_id for r in out.select("doc_id").collect()} == {BIG, None, BIG + 2}


def test_grammar_reads_clauses_not_words():
    g = toxicity.Grammar({"idiot": 2.0})
    names = toxicity.FEATURES
    read = lambda t: dict(zip(names, g.features(toxicity.tokens([t.encode()]))[0]))
    assert read("what an idiot.") == {"I": 2.0, "J": 0, "K": 0, "X": 0, "Z": 0, "C": 1.0}
    assert read("you absolute idiot")["J"] == 2.0
    assert read("you are not an idiot.")["X"] == 2.0
    assert read('he said: you idiot.')["Z"] == 2.0 and read('the sign “you idiot” fell')["Z"] == 2.0
    assert read("they will be shot, i will kill you; i kill time")["K"] == 1.0
    assert read("du wirst den idiot nicht")["J"] == 2.0 and read("jamais un idiot")["X"] == 2.0 and read("según ellos, idiot")["Z"] == 2.0
    assert read("the idiot's car, l'idiot")["I"] == 4.0
    assert sum(read("a calm day. no harm done").values()) == 0
    # The composed table gives what the machines give one after another.
    machines = [toxicity.target_machine(), toxicity.negation_machine(), toxicity.report_machine(), toxicity.clause_machine()]
    whole, s, parts = toxicity.grammar(), 0, [0] * 4
    for c in R.choices("OIHYNRQE", k=3000):
        sym = toxicity.NUMBER[c]
        out, s = whole.out[s, sym], whole.step[s, sym]
        for k, m in enumerate(machines):
            sym, parts[k] = m.out[parts[k], sym], m.step[parts[k], sym]
        assert out == sym


def test_toxicity_learns_from_one_side_of_the_split(spark):
    rows = [(i, prose(10) + (" you blorf. " if i % 3 == 0 else " ") + prose(10)) for i in range(300)]
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(300)] + [(5, 0, None), (None, 0, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.score_toxicity(frame(spark, rows), labels).collect()
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert all(r.score == 0 for r in toxicity.score_toxicity(frame(spark, rows), labels.limit(0)).collect())


def _ordinal_case(n, levels):
    texts = [prose(12).encode() for _ in range(n)]
    doc, i, v = quality.features(texts)
    return doc, i, v, np.array([k % levels for k in range(n)])


def test_ordinal_gradient_equals_finite_differences():
    doc, i, v, grade = _ordinal_case(40, 4)
    m, r = quality.BUCKETS + quality.SHAPES, np.random.default_rng(0)
    p = np.r_[r.normal(0, 0.3, m), -0.4, r.normal(0, 0.5, 2)]
    f = lambda q: quality.loss_and_gradient(q, doc, i, v, grade, 4, 0.01)
    loss, g = f(p)
    w, theta = p[:m], np.cumsum(np.r_[p[m], np.exp(p[m + 1:])])
    z = np.array([v[doc == k] @ w[i[doc == k]] for k in range(40)])
    below = lambda k, zz: 0.0 if k < 0 else 1.0 if k > 2 else 1 / (1 + np.exp(-(theta[k] - zz)))
    plain = -np.mean([np.log(below(k, zz) - below(k - 1, zz)) for k, zz in zip(grade, z)]) + 0.005 * (w @ w)
    assert loss == pytest.approx(plain, abs=1e-9)
    for k in [*r.choice(np.unique(i), 25, replace=False), m - 2, m, m + 1, m + 2]:
        e = np.zeros(len(p))
        e[k] = 1e-5
        assert (f(p + e)[0] - f(p - e)[0]) / 2e-5 == pytest.approx(g[k], abs=1e-7)


def test_ordinal_fit_lowers_the_loss_and_keeps_thresholds_in_order():
    doc, i, v, grade = _ordinal_case(40, 3)
    rows = [(i[doc == k], v[doc == k]) for k in range(40)]
    assert all(abs((x[1][x[0] < quality.BUCKETS] ** 2).sum() - 1) < 1e-9 for x in rows)
    w, theta = quality.fit_ordinal(rows, grade, 3, steps=200)
    assert (np.diff(theta) > 0).all()
    loss = lambda w, theta: quality.loss_and_gradient(np.r_[w, theta[0], np.log(np.diff(theta))], doc, i, v, grade, 3, 0.0)[0]
    assert loss(w, theta) < 0.6 * loss(np.zeros_like(w), np.sort(theta))


def test_grades_out_of_range_raise(spark):
    d = frame(spark, [(i, prose(5)) for i in range(4)])
    for g in (-1, quality.MAX_GRADE + 1):
        with pytest.raises(ValueError, match="grades must be"):
            quality.score_quality(d, spark.createDataFrame([(k, g) for k in range(4)], "doc_id bigint, grade int"))


def test_labelled_rows_are_bounded_though_ids_repeat(spark):
    from sparrowmill.llm.common import bounded

    rows = frame(spark, [(i % 2, prose(3)) for i in range(3000)])
    assert bounded(rows, 5000).count() == 3000 and 150 < bounded(rows, 300).count() < 450


def _token_by_token(text, arcs):
    """Features of a text by reading every word and mark with the four rules, no tables and no skips."""
    kinds = {w: c for c, ws in (("Y", toxicity.TARGET), ("R", toxicity.REPORTED), ("N", toxicity.NEGATION), ("H", toxicity.THREAT)) for w in ws.split()} | {w: "I" for w in arcs}
    plain = text.lower()
    for mark, other in toxicity.PLAIN:
        plain = plain.replace(mark, other)
    target = negation = 0
    said = quoted = match = False
    out = dict.fromkeys(toxicity.FEATURES, 0.0)
    for t in [*re.findall(r"[0-9a-z\x80-\U0010ffff]+|[.!?;\n\"]", plain), "."]:
        c = {'"': "Q"}.get(t, "E" if t in ".!?;\n" else kinds.get(t, "O"))
        weight = arcs.get(t, 1.0) if c == "I" else 1.0
        # Target: an insult or threat within reach of a target is aimed at it.
        aimed = target > 0
        target = 0 if c == "E" else toxicity.TARGET_REACH if c == "Y" else target if c == "Q" else max(0, target - 1)
        c = {"I": "J", "H": "K"}.get(c, c) if aimed else "O" if c == "H" else c
        # Negation.
        off = negation > 0
        negation = 0 if c == "E" else toxicity.NEGATION_REACH if c == "N" else negation if c == "Q" else max(0, negation - 1)
        c = "X" if off and c in "IJK" else c
        # Report and quotation.
        inside = said or quoted
        if c == "R":
            said = True
        elif c == "Q":
            quoted = not quoted
        elif c == "E":
            said = False
        c = "Z" if inside and c in "IJK" else c
        # Clause.
        if c in "IJKXZ":
            match = True
        elif c == "E":
            c, match = "C" if match else "E", False
        if c in out:
            out[c] += weight
    return [out[c] for c in toxicity.FEATURES]


def test_grammar_equals_reading_every_token():
    arcs = {"blorf": 2.0, "snek": 0.5}
    g, r = toxicity.Grammar(arcs), random.Random(11)
    words = ["you", "blorf", "snek", "not", "said", "kill", "tree", "a", "hm", "isn't", "tu", "été"]
    marks = ['"', ".", " ", "; ", "\n", "“", "”", "…", "!", ", "]
    texts = ['"you blorf" ok', '"', "", "...", '" "you snek', "blorf", '." you kill']
    for _ in range(1500):
        t = "".join(r.choice(marks) for _ in range(r.choice((0, 0, 1, 2))))
        for _ in range(r.randrange(14)):
            t += r.choice(words) + r.choice(("", "", *marks)) + " "
        texts.append(t)
    got = g.features(toxicity.tokens([t.encode() for t in texts]))
    for t, row in zip(texts, got):
        assert row.tolist() == _token_by_token(t, arcs), t
    assert got[0].tolist() == [0, 0, 0, 0, 2, 1]


def test_chat_layouts_may_be_mixed_in_a_table(spark):
    schema = "conv_id bigint, prompt string, response string, messages array<struct<role:string,content:string>>, instruction string, input string, output string, extra int"
    rows = [(1, "q", "a", None, None, None, None, 1), (2, None, None, [("user", "q"), ("assistant", None)], None, None, None, 2), (3, None, None, None, "do", None, "done", 3),
            (4, None, None, None, "do", "this", "done", 4), (5, None, None, None, None, None, None, 5), (6, "q", None, [("user", "q")], None, None, None, 6)]
    df = spark.createDataFrame(rows, schema)
    got = {r.conv_id: r.turns and [(t.role, t.text) for t in r.turns] for r in chat_format.to_turns(df).collect()}
    assert got == {1: [("user", "q"), ("assistant", "a")], 2: [("user", "q"), ("assistant", "")], 3: [("user", "do"), ("assistant", "done")],
                   4: [("system", "do"), ("user", "this"), ("assistant", "done")], 5: None, 6: None}
    assert sum(r["count"] for r in chat_format.unknown_layouts(df).collect()) == 2


def test_chat_roles_cannot_end_their_head(spark):
    rows = [(1, 0, "a:\nb", "c"), (1, 1, "assistant", "x:\n### y:\n"), (1, 2, "\\c\\n:", None), (1, None, "assistant", "z"), (2, 0, None, "")]
    turns = chat_format.to_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    out = chat_format.format_chat(turns)
    back = {r.conv_id: [(t.role, t.text) for t in r.t] for r in out.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t")).collect()}
    assert back == {1: [("assistant", "z"), ("a:\nb", "c"), ("assistant", "x:\n### y:\n"), ("\\c\\n:", "")], 2: [("", "")]}
    for r in out.select("formatted", chat_format.loss_spans(F.col("mask")).alias("spans")).where("conv_id = 1").collect():
        assert [r.formatted[s.start:s.start + s.len] for s in r.spans] == ["z", "x:\n\\h\\h\\h y:\n"]
