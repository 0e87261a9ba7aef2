"""The licence scan and the whole pipeline against plain versions."""
import collections
import itertools
import math
import random
import re

import pytest

import corpus_pipeline
from sparrowmill.llm import license_scan as scan

R = random.Random(23)
VOCAB = ["".join(R.choices("abcdefg", k=R.randrange(2, 7))) for _ in range(150)]
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(n):
    return " ".join(R.choices(VOCAB, k=n))


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))


def test_licences_equal_a_plain_scan(spark):
    notices = [t for _, t in scan.TEMPLATES + scan.HEADERS]
    rows = []
    for i in range(60):
        text = prose(R.randrange(0, 30))
        if i % 3 == 0:
            ws = R.choice(notices).split()
            if i % 2:
                del ws[R.randrange(len(ws))]
            text += R.choice(["\n", ". ", "\n\n"]) + R.choice([" ", "\n"]).join(ws) + R.choice(["\n", " "]) + prose(R.randrange(0, 9))
        rows.append((i, f"/{R.choice('ab')}/{R.choice('cd')}/" + ("LICENSE" if i % 7 == 0 else f"{i}.py"), text))
    rows += [(60, None, notices[0]), (61, "/a/x.py", None), (62, "/z/y", ""), (60, None, notices[0])]
    templates = scan.TEMPLATES + scan.HEADERS
    bag = lambda t: list(dict.fromkeys(re.findall("[a-z0-9]+", (t or "").translate(LOWER))))
    terms = [bag(t) for _, t in templates]
    vocab = {w for ws in terms for w in ws}
    df, n = collections.Counter(), 0
    for _, _, t in rows:
        for line in dict.fromkeys((t or "").split("\n")):
            n += 1
            df.update(set(bag(line)) & vocab)
    weight = lambda w: math.log((1 + n) / (1 + df[w]) + 1) ** 2 if w in vocab else math.log(2 + n) ** 2
    own = []
    for i, path, t in rows:
        best = (0.0, None)
        for unit in (t or "").split("\n") + re.split(scan.PARAGRAPH.replace(r"\p{L}\p{N}", "A-Za-z0-9"), t or "") + re.split(scan.SENTENCE.replace(r"\p{L}\p{N}", "A-Za-z0-9"), t or ""):
            u = bag(unit)
            for (name, _), ws in zip(templates, terms):
                dot = sum(weight(w) for w in ws if w in u)
                if dot:
                    cos = dot / math.sqrt(sum(map(weight, u)) * sum(map(weight, ws)))
                    if cos > best[0] + 1e-12:
                        best = (cos, name)
        own.append((i, path, best[1] if best[0] >= scan.MIN_COSINE else None, best[0]))
    here = collections.defaultdict(list)
    for _, path, name, cos in own:
        if path and re.search(scan.LICENCE_FILE, path) and name:
            here[path.rsplit("/", 1)[0]].append((-round(cos, 6), name))
    want = []
    for i, path, name, _ in own:
        licence, home = name, (path or "").rsplit("/", 1)[0]
        while licence is None and path:
            if home in here:
                licence = min(here[home])[1]
            if "/" not in home:
                break
            home = home.rsplit("/", 1)[0]
        want.append((i, name, licence))
    files = spark.createDataFrame([(*r, "x") for r in rows], "file_id bigint, path string, text string, own string")
    got = [(r.file_id, r.own, r.licence) for r in scan.scan_licences(files).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(x[1] is not None for x in want) > 5


def test_pipeline_equals_its_plain_stages(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    items = [(k, prose(20)) for k in range(3)]
    rows, i = [], 0
    for _ in range(25):
        base = R.choices(VOCAB, k=R.randrange(20, 90))
        for edits in (0, 0, 1, 12):
            ws = list(base)
            for _ in range(edits):
                ws[R.randrange(len(ws))] = R.choice(VOCAB)
            rows.append((i, " ".join(ws).upper() if i % 5 == 0 else " ".join(ws)))
            i += 1
    rows += [(i + k, prose(20) + " " + R.choice(items)[1] + " " + prose(R.choice([5, 900]))) for k in range(12)]
    rows += [(500 + k, f"you are a blorf blorf {prose(2)}" if k % 2 else prose(9)) for k in range(120)]
    rows += [(700, None), (701, ""), (None, rows[9][1]), (702, "?!"), (-3, prose(30))]
    spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'en' as lang", "'s' as source", "length(text) as n_chars").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(d, 1, int("blorf" in (t or ""))) for d, t in rows if d is not None], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    order = lambda d: -(2**63) if d is None else d
    left = [r for r in rows if "blorf" not in (r[1] or "")]
    exact = {}
    for d, t in left:
        key = (t or "").translate(LOWER)
        if key not in exact or order(d) > order(exact[key][0]):
            exact[key] = (d, t)
    left = list(exact.values())
    nodes = {}
    for d, t in left:
        if words(t):
            nodes.setdefault(tuple(words(t)), []).append((d, t))
    sets = {w: {w[k:k + 5] for k in range(max(1, len(w) - 4))} for w in nodes}
    root = {w: w for w in nodes}

    def find(w):
        while root[w] != w:
            w = root[w]
        return w

    for a, b in itertools.combinations(nodes, 2):
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9:
            root[find(a)] = find(b)
    classes = collections.defaultdict(list)
    for w, members in nodes.items():
        classes[find(w)] += members
    left = [r for r in left if not words(r[1])] + [max(m, key=lambda r: order(r[0])) for m in classes.values()]
    windows = {tuple(words(t)[p:p + 13]) for _, t in items for p in range(8)}

    def clean(t):
        ws, hit = words(t), set()
        for p in range(len(ws) - 12):
            if tuple(ws[p:p + 13]) in windows:
                hit.update(range(p, p + 13))
        return not hit or 20 * len(hit) < len(ws)

    left = [r for r in left if clean(r[1])]
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = sorted((str(d), len(lib.encode(t or "", add_special_tokens=False).ids)) for d, t in left)
    got = sorted((str(r.doc_id), r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == want and 40 < len(want) < len(rows) - 60
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "jaccard_join", "decontaminate", "bpe"]


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, tmp_path, stage):
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([], "doc_id bigint, text string, score string, kept string")
    assert dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path)).count() == 0
