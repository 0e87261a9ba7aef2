"""MinHash dedup, tokenizer alignment and conversation repair against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparrowmill.llm import alignment, chat_repair, minhash
from sparrowmill.llm.common import table

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id bigint, text string"


# --- MinHash ---------------------------------------------------------------

def _shingles(text):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < 4 else {tuple(w[i:i + 4]) for i in range(len(w) - 3)}


def _components(rows):
    """All pairs of rows (id, text); ids may repeat."""
    sets = [_shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 80 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted((str(d), len(sets[i]), str(low.get(find(i))), d == low.get(find(i))) for i, (d, _) in enumerate(rows))


def _found(df):
    return sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


def _chains(seed, n):
    """Texts of which each follows an earlier one with a few words changed: chains of links."""
    r = random.Random(seed)
    texts = [[f"w{r.randrange(400)}" for _ in range(r.choice((3, 5, 12, 60, 200)))]]
    for _ in range(n):
        t = list(r.choice(texts[-6:]))
        for _ in range(r.choice((0, 1, 1, 2, 4))):
            t[r.randrange(len(t))] = f"w{r.randrange(400)}"
        texts.append(t if r.random() < 0.8 else [f"w{r.randrange(400)}" for _ in range(r.choice((2, 6, 80)))])
    return [" ".join(t) for t in texts]


def test_minhash_equals_all_pairs(spark):
    rows = list(enumerate(_chains(1, 250))) + [(5, None), (None, ""), (900, " \t\n"), (None, "w1 w2 w3 w4 w5"), (901, "W1 w2  w3\tw4 w5"), (7, "another text of one id"), (7, "another text of one id"), (902, "\x1c   x")]
    out = minhash.minhash_dedup(spark.createDataFrame(rows, DOC).withColumn("label", F.lit("x")).withColumn("n", F.lit(1)).repartition(5))
    assert _found(out) == _components(rows)


def test_minhash_whole_table(spark):
    docs = table(spark, SF, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert _found(minhash.op11_minhash(spark, SF)) == _components(rows)


def test_minhash_empty_table(spark):
    assert minhash.minhash_dedup(spark.createDataFrame([], DOC)).count() == 0


def test_centres_alone_are_not_enough(spark):
    """Members far from the first centre are linked with each other: later rounds find that."""
    base = [f"b{i}" for i in range(100)]
    rows = [(k, " ".join(base[:i] + ["x"] * (i > 0) + base[i:])) for k, i in enumerate(range(0, 100, 7))]
    rows += [(100 + k, " ".join(base[: 84 - 3 * k])) for k in range(12)]
    assert _found(minhash.minhash_dedup(spark.createDataFrame(rows, DOC))) == _components(rows)


def test_densified_bins_estimate_similarity():
    r = np.random.default_rng(0)
    for size in (5, 40, 3000):
        est = []
        for _ in range(40):
            x = r.integers(0, 2**63, size * 10 // 9 + 1, dtype="uint64")
            a, b = np.unique(x[:size]), np.unique(x[len(x) - size:])
            low = minhash.one_permutation([a, b])
            assert (low != 0xFFFFFFFF).all()
            est.append((low[0] == low[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(est)) < 0.04
    one = minhash.one_permutation([np.array([7], "uint64"), np.array([7], "uint64"), np.array([8], "uint64")])
    assert (one[0] == one[1]).all() and not (one[0] == one[2]).any()


def test_star_edges_are_linear(spark):
    """3,000 near copies in common buckets: edges per round stay near one per member and centre, not pairs."""
    r = random.Random(3)
    base = [f"v{i}" for i in range(300)]
    rows = []
    for k in range(3000):
        t = list(base)
        t[r.randrange(300)] = f"own{k}"
        rows.append((k, " ".join(t)))
    out = minhash.minhash_dedup(spark.createDataFrame(rows, DOC).repartition(4))
    assert out.where("component_id = 0").count() == 3000 and out.where("kept").count() == 1


def test_near_copies_cost_stars_and_not_pairs(monkeypatch):
    r = np.random.default_rng(5)
    base = r.integers(0, 2**63, 300, dtype="uint64")
    near = [np.unique(np.r_[base[5:], r.integers(0, 2**63, 5, dtype="uint64")]) for _ in range(400)]
    far = [np.unique(np.r_[base[:150], r.integers(0, 2**63, 150, dtype="uint64")]) for _ in range(20)]
    stars = minhash.Stars(near + far, 80)
    tried = []
    monkeypatch.setattr(minhash.Stars, "linked", lambda self, x, f=minhash.Stars.linked: tried.append(x) or f(self, x))
    n = len(near) + len(far)
    root = minhash.settle(stars, np.zeros(n, int), np.ones(n, bool), np.zeros(n, bool))
    assert len(set(root[:400])) == 1 and len(set(root)) == 21 and len(tried) <= 22


@pytest.mark.parametrize("block", [3, 10])
def test_large_parts_in_blocks_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = list(enumerate(_chains(4, 150)))
    base = [f"b{i}" for i in range(60)]
    rows += [(1000 + k, " ".join(base[:k] + [f"x{k}"] * (k % 4) + base[k:])) for k in range(40)]
    assert _found(minhash.minhash_dedup(spark.createDataFrame(rows, DOC))) == _components(rows)


# --- Alignment -------------------------------------------------------------

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", None, " ", "  ", "a", " lead", "trail ", "two  spaces", "tab\tand\nline \n x", "end \n", "\n", "▁ mark", "é ﬁ 日本語 text", "<s> </s> <|endoftext|> <unk> <0x41>",
       "can't  won't'll", "x" * 300, "a  b　 c", "​zero \x1c \x00 y", "emoji 🙂🙂 end", "word " * 700, "12345 6789 3.14", "a" + " " * 50 + "b"]


def _plain_alignment(texts):
    import sentencepiece
    import tokenizers

    pair = alignment.Pair(A_PATH, B_PATH)  # bytes of tokens only
    a = tokenizers.Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    docs = []
    for t in texts:
        x = a.encode(" " + (t or ""), add_special_tokens=False).ids
        y = b.encode(t or "")
        raw = (" " + (t or "")).encode()
        if not t or b"".join(pair.a_bytes[i] for i in x) != raw or b"".join(pair.b_bytes[i] for i in y) != raw:
            docs.append(([], [], [], []))
            continue
        spans = []
        for ids, size in ((x, pair.a_bytes), (y, pair.b_bytes)):
            ends = list(itertools.accumulate(len(size[i]) for i in ids))
            spans.append([(i, s, e) for i, s, e in zip(ids, [0, *ends], ends)])
        links, lo = [], 0
        for i, s, e in spans[0]:
            while spans[1][lo][2] <= s:
                lo += 1
            k = lo
            while k < len(y) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        cuts = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [[[i for i, s, e in side if lo <= s and e <= hi] for side in spans] for lo, hi in zip([0, *cuts], cuts)] if len(x) < 1500 else None
        docs.append((x, y, links, groups))
    count = Counter(p for _, _, links, _ in docs for p in set(links))
    best = defaultdict(int)
    for (i, _), n in count.items():
        best[i] = max(best[i], n)
    out = []
    for k, (x, y, links, groups) in enumerate(docs):
        text = None if groups is None else ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        sha = None if groups is None else hashlib.sha256(text.encode()).hexdigest() if x else ""
        out.append((k, len(x), len(y), None if groups is None else len(groups), len(links), sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links), sha))
    return out


@pytest.mark.parametrize("heavy", [alignment.HEAVY, 50])
def test_alignment_equals_plain_loops(spark, heavy):
    texts = ODD + [r.text for r in table(spark, SF, "documents").orderBy("doc_id").limit(60).collect()]
    df = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)], DOC + ", n_a int").repartition(3)
    got = {r.doc_id: tuple(r) for r in alignment.align_tokenizers(df, A_PATH, B_PATH, heavy).collect()}
    assert len(got) == len(texts)
    for want in _plain_alignment(texts):
        assert tuple(g if w is not None else None for g, w in zip(got[want[0]], want)) == want


def test_alignment_in_lanes_equals_one_lane(monkeypatch):
    pair = alignment.Pair(A_PATH, B_PATH)
    texts = ["some  words, and more: naïve façade; " * k for k in (1, 7, 300)] + ODD[2:]
    short = alignment.align(pair, [t or "" for t in texts])
    monkeypatch.setattr(alignment, "LANE", 10**9)
    whole = alignment.align(pair, [t or "" for t in texts])
    assert {k: v.to_pylist() for k, v in short.items()} == {k: v.to_pylist() for k, v in whole.items()}


def test_alignment_of_nothing(spark):
    assert alignment.align_tokenizers(spark.createDataFrame([], DOC), A_PATH, B_PATH).count() == 0
    rows = alignment.align_tokenizers(spark.createDataFrame([(1, None), (1, ""), (None, "a b")], DOC), A_PATH, B_PATH).collect()
    assert sorted((r.doc_id is None, r.n_a > 0, r.groups_sha256 != "") for r in rows) == [(False, False, False)] * 2 + [(True, True, True)]


# --- Conversation repair ---------------------------------------------------

CHAT = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"
NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}  # by the initial read last


def _damaged(rows):
    """Rows per conversation after damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        conversation = out[conv]
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        conversation += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    for c in out.values():
        c.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def _faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        end = text.rstrip(SPACE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def _every_repair(rows, faults):
    """Least (cost, audit, lines) by trying every edit: whole strings, no merging but of equal futures."""
    best = {"": (0, "", ())}  # initial read last -> cost, audit, lines

    def inserted(states):
        todo = dict(states)
        for _ in range(4):
            for last, (cost, audit, lines) in list(todo.items()):
                for t in NEXT[last]:
                    if t != "s":
                        new = (cost + 3, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[t]))
                        todo[t] = min(todo.get(t, new), new)
        return todo

    for (_, role, text), fault in zip(rows, faults):
        after = {}
        for last, (cost, audit, lines) in inserted(best).items():
            moves = [(last, (cost + 4, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                moves += [(t, (cost + more, audit + "K", (*lines, f"{role}:{text}"))) for t in NEXT[last] if role[:1] == t]
                moves += [(t, (cost + 3 + more, audit + "R", (*lines, {"u": "user", "a": "assistant"}[t] + ":" + text))) for t in NEXT[last] if t != "s"]
            for t, new in moves:
                after[t] = min(after.get(t, new), new)
        best = after
    return min(v for last, v in inserted(best).items() if last in ("", "a"))


def _plain_repairs(rows):
    out = []
    for conv, turns in _damaged(rows).items():
        faults = _faults(turns)
        cost, audit, lines = _every_repair(turns, faults)
        known = [t for t, _, _ in turns if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        out.append((str(conv), max(known) - min(known) + 1 - len(set(known)) if known else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out)


def _repaired(df):
    c = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted((str(r.conv_id), *(r[x] for x in c)) for r in df.collect())


def test_repair_of_a_whole_table(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.01", "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert _repaired(chat_repair.op13_chat_repair(spark, "/root/testdata/sf0.01")) == _plain_repairs(rows)


def _messy(n, seed=5):
    r = random.Random(seed)
    texts = ["", None, " \n", "Yes.", "No", "What? ", "Yes.", "ok!\t", "cut off", "long " * 20 + "."]
    return [(r.choice((1, 2, 3, 4, 5, None)), r.choice((None, *range(12))), r.choice(("user", "assistant", "system", "user", "assistant", "tool", "", None)), r.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("long_rows", [10_000, 3])
def test_repair_of_messy_turns(spark, monkeypatch, long_rows):
    monkeypatch.setattr(chat_repair, "LONG_ROWS", long_rows)
    monkeypatch.setattr(chat_repair, "PIECE", 40)
    rows = _messy(160)
    df = spark.createDataFrame(rows, CHAT).withColumn("alive", F.lit("clash")).withColumn("pos", F.lit(0)).repartition(3)
    assert _repaired(chat_repair.repair_conversations(chat_repair.damage(df))) == _plain_repairs(rows)


def test_one_conversation_over_all_partitions(spark):
    r = random.Random(8)
    rows = [(1, k, r.choice(("user", "assistant", "system")), r.choice((f"text {k}.", f"text {k}", "same."))) for k in range(3000)] + [(2, 0, "user", "Hi.")]
    out = chat_repair.repair_conversations(chat_repair.damage(spark.createDataFrame(rows, CHAT)))
    assert _repaired(out) == _plain_repairs(rows)


def test_repair_of_nothing(spark):
    assert chat_repair.repair_conversations(chat_repair.damage(spark.createDataFrame([], CHAT))).count() == 0
    gone = [(c, 0, "user", "x") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    out = chat_repair.repair_conversations(chat_repair.damage(spark.createDataFrame(gone, CHAT))).collect()
    assert len(out) == len(gone) and {(r.gaps, r.cost, r.audit, r.repaired_sha256) for r in out} == {(0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_edits_of_short_conversations_by_enumeration():
    """All edit strings of up to three turns, without states."""
    rep = chat_repair.Repair()
    for roles in itertools.product("suax", repeat=3):
        for faulty in itertools.product((0, 1, 2), repeat=3):
            best = None
            slots = [("", "I", "II", "III")] * 4
            for ins in itertools.product(*slots):
                if sum(map(len, ins)) > 3:
                    continue
                for edits in itertools.product("KRD", repeat=3):
                    if any(f == 2 and e != "D" for f, e in zip(faulty, edits)):
                        continue
                    audit = "".join(w + e for w, e in zip(ins, edits)) + ins[3]
                    fixed = [r if e == "K" else "?" for r, e in zip(roles, edits)]
                    line = "".join("?" * len(w) + (f if e != "D" else "") for w, e, f in zip(ins, edits, fixed)) + "?" * len(ins[3])
                    body = line[1:] if line[:1] == "s" else line
                    if (line and not body) or len(body) % 2 or any(c not in "?" + "ua"[k % 2] for k, c in enumerate(body)):
                        continue
                    cost = 3 * audit.count("I") + sum({"K": 0, "R": 3, "D": 4}[e] + 3 * (f == 1 and e != "D") for e, f in zip(edits, faulty))
                    best = min(best or (cost, audit), (cost, audit))
            ks = chat_repair.kinds(["sua".find(r) if r in "sua" else 3 for r in roles], [f == 2 for f in faulty], [False] * 3, [f == 1 for f in faulty])
            level, total, backs = rep.forward(ks)
            cost, stack, last = rep.finish(level)
            audit, _ = chat_repair.repair_lines(rep.backward(backs, stack), last, ["r"] * 3, ["t"] * 3)
            assert (total + cost, audit) == best, (roles, faulty)
