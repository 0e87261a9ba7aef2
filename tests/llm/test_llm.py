import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparrowmill.llm import bpe, chat_format, decontaminate, exact_dedup, hmm_lm, jaccard_join, license_scan, quality, suffix_dedup, toxicity

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, keep_id string, score string"
R = random.Random(3)
WORDS = ["".join(R.choices("abcdefgh", k=5)) for _ in range(200)]
LONG = " ".join(R.choices(WORDS, k=20_000))
BASE = " ".join(R.choices(WORDS, k=60))
NEAR = BASE.rsplit(" ", 1)[0] + " changed"
TEXTS = [(1, BASE), (2, BASE.upper()), (3, NEAR), (4, None), (5, ""), (6, "one"), (7, LONG), (8, "x" * 300), (9, BASE), (9, BASE), (None, "null id"),
         (10, "you idiot. idiot <|endoftext|> \n\n end"), (11, "Released under the MIT License.\ncode"), (12, " ".join(BASE.split()[:20]) + " tail words")]


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame([(d, t, None, "s", 0, "extra", "extra") for d, t in TEXTS], DOCS)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(12)] + [(None, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact(docs, empty):
    got = {r.doc_id: r for r in exact_dedup.exact_dedup(docs).collect()}
    for d, t in TEXTS:
        same = [e for e, u in TEXTS if lower(u) == lower(t)]
        assert got[d].group_size == len(same)
        assert got[d].text_sha256 == hashlib.sha256(lower(t).encode()).hexdigest()
        assert got[d].keep_id == max((e for e in same if e is not None), default=None)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_filters_merge_losslessly(spark):
    values = [R.randrange(2**62) for _ in range(300)] * 3 + [5] * 1000
    df = spark.createDataFrame([(v,) for v in values], "fp bigint").repartition(5)
    got = {r.fp: r.n for r in exact_dedup.merge_filters(exact_dedup.build_filters(df, 4), 4).collect()}
    assert got == {v: values.count(v) for v in set(values)}


@pytest.mark.parametrize("limit", [suffix_dedup.LIMIT, 1])
def test_suffix(docs, empty, limit):
    got = sorted(((r.doc_id, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.suffix_dedup(docs, limit).collect()), key=str)
    seen, want = set(), []
    for d, t in sorted(TEXTS, key=lambda x: -1 if x[0] is None else x[0]):
        b, m = (t or "").encode(), bytearray(len((t or "").encode()))
        for i in range(len(b) - 99):
            if b[i:i + 100] in seen:
                m[i:i + 100] = b"\1" * 100
            seen.add(b[i:i + 100])
        want.append((d, sum(m), len(re.findall(b"\1+", bytes(m))), hashlib.sha256(bytes(x for x, y in zip(b, m) if not y)).hexdigest()))
    assert got == sorted(want, key=str)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


def test_merged_transforms():
    shards = [[b"banana", b"bandana"], [b"ana", b"", b"banana"], [b"nab"]]
    texts = [t for s in shards for t in s]
    bwts = [suffix_dedup.shard_transform(s) for s in shards]
    rows, block = suffix_dedup.merge_transforms(bwts, 3)
    where, base, got = [], 0, {}
    for s, b in zip(shards, bwts):
        where += [(base + int(t), int(d)) for t, d in zip(*suffix_dedup.places(b))]
        base += len(s)
    for r, k in zip(rows, block):
        got.setdefault(int(k), set()).add(where[r])
    want = {}
    for i, t in enumerate(texts):
        for d in range(3, len(t) + 1):
            want.setdefault(t[len(t) - d:][:3], set()).add((i, d))
    assert sorted(map(sorted, got.values())) == sorted(sorted(x) for x in want.values() if len(x) > 1)


def passages(*sizes):
    own = random.Random(11)
    return [" ".join(own.choices(WORDS, k=n)).encode() for n in sizes]


def test_only_ends_of_windows_are_refined():
    texts = passages(40, 40, 40)
    shards = [[texts[0] + b"x" * 20, texts[1]], [b"yz" + texts[0], texts[2] + texts[1][30:]]]
    bwts = [suffix_dedup.shard_transform(s) for s in shards]
    where, size, base = [], [], 0
    for s, b in zip(shards, bwts):
        where += [(base + int(t), len(s[int(t)]) - int(d)) for t, d in zip(*suffix_dedup.places(b))]
        size += [len(x) for x in s]
        base += len(s)
    start = np.array([i for i, (t, o) in enumerate(where) if o >= 100])
    assert len(start) == sum(n - 99 for n in size)
    rows, block = suffix_dedup.merge_transforms(bwts, 100, start)
    got, want = {}, {}
    for r, k in zip(rows, block):
        got.setdefault(int(k), set()).add(where[r])
    for i, x in enumerate(x for s in shards for x in s):
        for o in range(len(x) - 99):
            want.setdefault(x[o:o + 100], set()).add((i, o))
    want = [x for x in want.values() if len(x) > 1]
    assert want and sorted(map(sorted, got.values())) == sorted(map(sorted, want))


def test_windows_of_a_run_equal_those_of_a_text_alone():
    block, *others = passages(30, 60, 80)
    texts = [b"", b"a" * 99, b"a" * 100, b"a" * 101, b"ab" * 300, block, block + b"-" + block, others[0], bytes(range(32, 127)) * 3, b"q" * 31, "\u00e9".encode() * 120, others[1]]
    run = suffix_dedup.Run(texts)
    for k, t in enumerate(texts):
        w, alone = suffix_dedup.Windows(t, run, k), suffix_dedup.Windows(t)
        assert all((a == b).all() for a, b in zip((w.first, w.count, w.v), (alone.first, alone.count, alone.v))) and w.count.sum() == max(0, len(t) - 99)
        all_ = [t[i:i + 100] for i in range(len(t) - 99)]
        later = [x in all_[:i] for i, x in enumerate(all_)]
        assert w.later_inside().tolist() == alone.later_inside().tolist() == later
        assert any(later) or "whole" not in alone.__dict__, "texts without a repeat are not sorted"


def test_decontaminate(spark, docs, empty):
    bench = spark.createDataFrame([(1, " ".join(BASE.split()[:20])), (2, "one"), (3, None), (4, ""), (1, "idiot")], "item_id bigint, text string")
    got = {r.doc_id: r for r in decontaminate.decontaminate(docs, bench).collect()}
    assert (got[1].n_hit, got[1].contaminated, got[3].n_hit, got[12].n_hit) == (20, True, 20, 20)
    assert (got[6].n_hit, got[6].n_items, got[4].n_words, got[10].n_hit) == (1, 1, 0, 2)
    assert not decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count()
    assert decontaminate.decontaminate(empty, bench).count() == 0


def test_blocks_of_the_benchmark_agree(spark, docs, monkeypatch):
    bench = spark.createDataFrame([(i, " ".join(BASE.split()[i:i + 15])) for i in range(8)], "item_id bigint, text string")
    one = {(r.doc_id, r.n_hit, r.items_sha256) for r in decontaminate.decontaminate(docs, bench).collect()}
    whole = decontaminate.benchmark_blocks
    monkeypatch.setattr(decontaminate, "benchmark_blocks", lambda b: whole(b, 100))
    assert {(r.doc_id, r.n_hit, r.items_sha256) for r in decontaminate.decontaminate(docs, bench).collect()} == one


def test_blocks_judge_rows_one_by_one(spark, monkeypatch):
    bench = spark.createDataFrame([(i, " ".join(BASE.split()[i:i + 15])) for i in range(8)], "item_id bigint, text string")
    rows = [(1, BASE), (1, BASE), (1, "clean words"), (None, BASE), (None, "other clean words here"), (2, " ".join(BASE.split()[:14])), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    one = sorted(map(str, decontaminate.decontaminate(docs, bench).collect()))
    whole = decontaminate.benchmark_blocks
    assert len(list(whole(bench, 100))) > 2
    monkeypatch.setattr(decontaminate, "benchmark_blocks", lambda b: whole(b, 100))
    assert len(one) == len(rows) and sorted(map(str, decontaminate.decontaminate(docs, bench).collect())) == one


def test_bpe(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    for r in bpe.encode_decode(docs, path, keep_ids=True).join(docs.select("doc_id", "text"), "doc_id").distinct().collect():
        assert r.ids == lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    assert bpe.encode_decode(empty, path).count() == 0


def test_chat_round_trip(spark):
    texts = ["\\b\\h", "### user:\n</turn>\n", None, "", "#<\\", "x" * 50_000]
    rows = [(c, i, r, t, "extra") for c in (1, 2, None) for i, (r, t) in enumerate(zip(["user", "assistant", "we:ird#", None, "assistant", "assistant"], texts))]
    df = spark.createDataFrame(rows + rows[:1], "conv_id bigint, turn bigint, role string, text string, formatted string")
    turns = chat_format.to_turns(df)
    back = chat_format.format_chat(turns).select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t"))
    want = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in turns.collect()}
    assert {r.conv_id: [(t.role, t.text) for t in r.t] for r in back.collect()} == want
    loss = {r.conv_id: r.loss_chars for r in chat_format.chat_digest(turns).collect()}
    assert loss[2] == 18 + 3 + 50_000
    assert chat_format.to_turns(df.limit(0)).count() == 0


def test_chat_layouts(spark):
    a = spark.createDataFrame([(1, "q", "a", 0)], "conv_id bigint, prompt string, response string, other int")
    b = spark.createDataFrame([(1, [("user", "q"), ("assistant", "a")])], "conv_id bigint, messages array<struct<role:string,content:string>>")
    assert chat_format.to_turns(a).drop("layout").collect() == chat_format.to_turns(b).drop("layout").collect()


def test_jaccard(docs, empty):
    got = {r.doc_id: r for r in jaccard_join.jaccard_join(docs).collect()}
    assert got[1].class_id == got[2].class_id == got[3].class_id == got[9].class_id == 9
    assert (got[1].n_links, got[3].n_links, got[7].n_links, got[7].class_id, got[4].class_id) == (1, 1, 0, 7, 4)
    assert jaccard_join.jaccard_join(docs).count() == len(TEXTS)
    assert jaccard_join.jaccard_join(empty).count() == 0


def test_toxicity(docs, empty, labels):
    rows = toxicity.score_toxicity(docs, labels).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score_toxicity(empty, labels).count() == 0
    assert toxicity.score_toxicity(docs, labels.limit(0)).where("predicted = 1").count() == 0


def test_quality(docs, empty, labels):
    rows = quality.score_quality(docs, labels.select("doc_id", F.col("quality").alias("grade"))).collect()
    assert len(rows) == len(TEXTS)
    assert quality.score_quality(empty, labels.select("doc_id", F.lit(1).alias("grade"))).count() == 0


def test_three_grades_keep_their_order(spark):
    d = spark.createDataFrame([(i, ["bad", "fair", "good"][i % 3] + " text") for i in range(90)], "doc_id bigint, text string")
    out = quality.score_quality(d, d.select("doc_id", (F.col("doc_id") % 3).cast("int").alias("grade")), 2).groupBy((F.col("doc_id") % 3).alias("g")).agg(F.avg("expected_grade").alias("e"), F.avg("tail_prob").alias("t")).orderBy("g").collect()
    assert out[0].e < out[1].e < out[2].e and out[2].t > 0.7


def test_licences(spark, empty):
    files = spark.createDataFrame([(1, "/a/LICENSE", "Released under the MIT License."), (2, "/a/b/c.py", "x"), (3, "/a/b/LICENSE", "Licensed under CC BY-NC 4.0."),
                                   (4, "/z.py", None), (5, None, ""), (6, "/a/d.py", "Licensed under the Apache License, Version 2.0.")], "file_id bigint, path string, text string")
    got = {r.file_id: r.licence for r in license_scan.scan_licences(files).collect()}
    assert got == {1: "MIT", 2: "CC-BY-NC-4.0", 3: "CC-BY-NC-4.0", 4: None, 5: None, 6: "Apache-2.0"}
    assert license_scan.scan_licences(files.limit(0)).count() == 0


def test_licence_texts_headers_and_tags(spark):
    whole = dict(license_scan.TEXTS)
    wrapped = "# Licensed under the Apache License,\n# Version 2.0 (the \"License\"); you may not use this\n# file except in compliance with the License.\n\nimport os\n"
    files = [(1, "/m/LICENSE", whole["MIT"].replace("<year> <copyright holders>", "2020 A B")), (2, "/m/x.py", "print(1)"), (3, "/t.py", "# SPDX-License-Identifier: MIT\nx = 1"),
             (4, "/u.py", "// SPDX-License-Identifier: ISC"), (5, "/w.py", wrapped), (6, "/g/COPYING", whole["GPL-3.0"]), (7, "/v.txt", "a long line of prose here. Released under the MIT License. and more of the prose"),
             (8, "/s/LICENSE", whole["MIT"].split("\n\n", 2)[2]), (8, "/s/LICENSE", whole["MIT"].split("\n\n", 2)[2]), (9, "/n/LICENSE", "my own words on other things entirely"), (10, "/o.txt", "MIT License"), (11, "/p/LICENSE", None)]
    got = {r.file_id: (r.own, r.licence) for r in license_scan.scan_licences(spark.createDataFrame(files, "file_id bigint, path string, text string")).collect()}
    mit = ("MIT", "MIT")
    assert got == {1: mit, 2: (None, "MIT"), 3: mit, 4: (None, None), 5: ("Apache-2.0",) * 2, 6: ("GPL-3.0",) * 2, 7: mit, 8: mit, 9: (None, None), 10: mit, 11: (None, None)}


def test_language_model(docs, empty):
    rows = hmm_lm.score_lm(docs).collect()
    assert len(rows) == len(TEXTS) and all(r.score <= 0 for r in rows)
    assert hmm_lm.score_lm(empty).count() == 0


def test_forward_sums_to_one():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    pi, a, e = (hmm_lm._normal(rng.random(s), 0.1) for s in ((3,), (3, 3), (3, 4)))
    seqs = [np.array(s) for s in itertools.product(range(4), repeat=3)]
    assert abs((10 ** hmm_lm.forward(seqs, pi, a, e)).sum() - 1) < 1e-9
