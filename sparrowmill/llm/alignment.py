"""Cross-tokenizer alignment by lockstep merging.

Two tokenizers cut the bytes of one text at different places. A state vector holds, for every
document of a run, a pointer into the tokens of A and one into those of B. Each step advances
all of them at once: it emits the link of the two current tokens, whose byte ranges overlap,
moves the pointer whose token ends first (both, at a cut), and compacts the vector when
documents are finished. Long documents ride in several lanes, which part where both
tokenizers end a token, so that no document makes a run wait for it.

Links are judged by corpus-wide counts of documents. Counts of frequent pairs, of which there
are at most `HEAVY`, and the highest count of each A id (one per id of the vocabulary) are
sent to the workers; all other pairs are joined.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import materialise, utf8
from .scan import columns, runs

#: Tokens of A in a lane, tokens of lanes that advance together, chunks that a worker remembers and their longest.
LANE, RUN_BYTES, MEMO, MEMO_CHARS = 192, 1_000_000, 100_000, 48
# Fixed value: the split pattern of the byte-level vocabulary.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: At most this many pair counts are sent to the workers.
HEAVY = 200_000

#: A chunk starts at a space that follows other text. Neither tokenizer has a token across such a place.
_CUT = re.compile(r"(?<=\S)(?= )")
#: Places where cutting at every space would part white space.
_ODD = re.compile(r"\s |  | $")


class Pair:
    """Both tokenizers and the bytes of their tokens; made once per Python worker."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        import tiktoken

        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {c: b for b, c in byte_alphabet().items()}
        with open(a_path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ids = [vocab["".join(m)] for m in merges]
        if spec.get("normalizer") or ids != sorted(ids) or (ids and ids[0] < 256):
            raise ValueError(f"{a_path}: ids must follow the order of merges, and texts must not be normalised")
        self.a_bytes = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        # Ids follow the order of merges, so they are ranks.
        self.a = tiktoken.Encoding("a", pat_str=SPLIT, special_tokens={}, mergeable_ranks={b: i for (t, i), b in zip(vocab.items(), self.a_bytes.values()) if t not in special})
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.n_b = len(pieces)
        self.a_size = np.zeros(max(self.a_bytes) + 1, "int32")
        self.a_size[list(self.a_bytes)] = [len(b) for b in self.a_bytes.values()]
        self.b_size = np.array([len(b) for b in self.b_bytes], "int32")
        # A piece with a space behind other text would be a token across chunks; then texts are encoded whole.
        self.chunked = not any("▁" in p.lstrip("▁") for p in pieces)
        n = max(len(self.a_size), self.n_b)
        self.text = np.array([sign + str(k) for sign in ",;|" for k in range(n)], object)
        self.stride = n
        self.known: dict[str, tuple | None] = {}
        self.old: dict[str, tuple | None] = {}

    def chunks(self, text: str) -> list[str]:
        """Chunks of a space and the text."""
        if not self.chunked:
            return [" " + text]
        if not _ODD.search(text) and text[:1] != " ":
            return [" " + c for c in text.split(" ")]
        parts = _CUT.split(" " + text)
        if len(parts) > 1 and not parts[-1].strip(" "):  # a text's last spaces belong to the chunk before
            parts[-2:] = [parts[-2] + parts[-1]]
        return parts

    def learn(self, new: list[str]) -> dict[str, tuple | None]:
        """Ids of chunks by both tokenizers; None where the bytes of B differ from the chunk. A is byte-level: its never do."""
        out, one, pieces = {}, self.a.encode_ordinary, self.b_bytes
        for c, y in zip(new, self.b.encode([c[1:] for c in new], num_threads=1)):
            out[c] = (one(c), y) if b"".join([pieces[i] for i in y]) == c.encode() else None
        return out

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of A and B per text, empty where the text is empty or bytes differ. Chunks that were met
        lately are remembered in two generations."""
        cut = [self.chunks(t) if t else [] for t in texts]
        known, old, got, new = self.known, self.old, {}, []
        for c in set(itertools.chain.from_iterable(cut)):
            if c in known:
                got[c] = known[c]
            elif c in old:
                got[c] = known[c] = old[c]
            else:
                new.append(c)
        learnt = self.learn(new)
        got.update(learnt)
        out = []
        for parts in cut:
            both = [got[c] for c in parts]
            if not parts or None in both:
                both = []
            out.append(tuple(np.array(list(itertools.chain.from_iterable([x[k] for x in both])), "int32") for k in (0, 1)))
        known.update((c, x) for c, x in learnt.items() if len(c) <= MEMO_CHARS)
        if len(known) > MEMO:
            self.known, self.old = {}, known
        return out


def lanes(end_a: np.ndarray, end_b: np.ndarray, size: int) -> np.ndarray:
    """Tokens of A, spaced by `size` or more, that end where a token of B ends: ends of lanes but the last."""
    if len(end_a) <= size:
        return np.empty(0, "int64")
    both = np.flatnonzero(end_b[np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)] == end_a)
    at = np.searchsorted(both, np.arange(size, len(end_a), size))
    return np.unique(both[at[at < len(both)]])[:-1]


def lockstep(end_a: np.ndarray, end_b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray, stop_a: np.ndarray):
    """Links and cuts of all lanes. `end_*`: where each token ends in one address space of all
    lanes; `start_*` and `stop_a`: the token ranges of the lanes. Returns the links (token of A,
    token of B) and the cuts (last token of A, last token of B), in the order of steps."""
    i, j, stop = start_a.copy(), start_b.copy(), stop_a
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(i):
        links_a.append(i)
        links_b.append(j)
        x, y = end_a[i], end_b[j]
        step_a, step_b = x <= y, y <= x
        cut = step_a & step_b
        cuts_a.append(i[cut])
        cuts_b.append(j[cut])
        i, j = i + step_a, j + step_b
        live = i < stop
        if not live.all():  # both pointers of a lane reach its end in the same step
            i, j, stop = i[live], j[live], stop[live]
    none = np.empty(0, "int64")
    return tuple(np.concatenate(x) if x else none for x in (links_a, links_b, cuts_a, cuts_b))


def align(pair: Pair, texts: list[str]) -> dict[str, list]:
    """Per text: n_a, n_b, n_groups, n_links, groups_sha256, and its different links as codes
    (A id * size of B + B id, ascending) with how often each occurs."""
    tokens = pair.encode(texts)
    size_a, size_b = ([len(t[k]) for t in tokens] for k in (0, 1))
    a, b = (np.concatenate([t[k] for t in tokens]) if tokens else np.empty(0, "int32") for k in (0, 1))
    first_a, first_b = (np.r_[0, np.cumsum(s)].astype("int64") for s in (size_a, size_b))
    end_a, end_b = np.cumsum(pair.a_size[a], dtype="int64"), np.cumsum(pair.b_size[b], dtype="int64")
    stops = []
    for d in range(len(texts)):
        if size_a[d]:
            lo, hi = first_a[d], first_a[d + 1]
            stops.append(lo + lanes(end_a[lo:hi], end_b[first_b[d]:first_b[d + 1]], LANE) + 1)
            stops.append([hi])
    stop_a = np.concatenate(stops).astype("int64") if stops else np.empty(0, "int64")
    start_a = np.r_[0, stop_a[:-1]].astype("int64")[:len(stop_a)]
    start_b = np.searchsorted(end_b, end_a[stop_a - 1]) + 1
    start_b = np.r_[0, start_b[:-1]].astype("int64")[:len(stop_a)]
    la, lb, ca, cb = lockstep(end_a, end_b, start_a, start_b, stop_a)

    # Links per document, different codes with their number.
    doc = np.repeat(np.arange(len(texts)), size_a)[la]
    code = a[la].astype("int64") * pair.n_b + b[lb]
    span = np.int64(len(pair.a_size)) * pair.n_b
    key, times = np.unique(doc * span + code, return_counts=True)
    code, at = key % span, np.searchsorted(key // span, np.arange(len(texts) + 1))
    n_links = np.bincount(doc, minlength=len(texts))
    # Groups in text order: their tokens of A, then those of B, each with the sign before it.
    ca, cb = np.sort(ca), np.sort(cb)
    group_a = np.searchsorted(ca, np.arange(len(a)))  # the group of each token
    group_b = np.searchsorted(cb, np.arange(len(b)))
    lead_a, lead_b = np.r_[True, group_a[1:] != group_a[:-1]][:len(a)], np.r_[True, group_b[1:] != group_b[:-1]][:len(b)]
    order = np.empty(len(a) + len(b), "int64")
    order[np.arange(len(a)) + np.r_[0, cb + 1][group_a]] = a + pair.stride * lead_a
    order[np.arange(len(b)) + (ca + 1)[group_b]] = b + 2 * pair.stride * lead_b
    words = pair.text[order]
    first = first_a + first_b
    shas = [hashlib.sha256("".join(words[lo:hi].tolist())[1:].encode()).hexdigest() if hi > lo else "" for lo, hi in zip(first[:-1], first[1:])]
    groups = np.diff(np.searchsorted(ca, first_a))

    def lists(flat, kind):
        return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat, kind))

    return {"n_a": pa.array(size_a, pa.int64()), "n_b": pa.array(size_b, pa.int64()), "n_groups": pa.array(groups, pa.int64()), "n_links": pa.array(n_links, pa.int64()),
            "groups_sha256": pa.array(shas, pa.string()), "codes": lists(code, pa.int64()), "times": lists(times, pa.int32())}


@functools.lru_cache(maxsize=1)
def _pair(a_path: str, b_path: str) -> Pair:
    return Pair(a_path, b_path)


def _align_batches(a_path: str, b_path: str):
    def run(batches):
        pair = _pair(a_path, b_path)
        for b in batches:
            for lo, hi in runs(b.column("text"), RUN_BYTES):
                part = b.slice(lo, hi - lo)
                yield columns(part, ["row", "doc_id"], align(pair, [t.decode() for t in part.column("text").to_pylist()]))
    return run


def _count_codes(batches):
    """Documents per code, added up over runs of about four million links before they are shuffled."""
    def counted(parts):
        code, n = np.unique(np.concatenate(parts), return_counts=True)
        for lo in range(0, len(code), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(code[lo:lo + (1 << 16)]), pa.array(n[lo:lo + (1 << 16)], pa.int64())], names=["code", "n"])

    held, size = [], 0
    for b in batches:
        held.append(b.column("codes").flatten().to_numpy(zero_copy_only=False))
        size += len(held[-1])
        if size > 4_000_000:
            yield from counted(held)
            held, size = [], 0
    if size:
        yield from counted(held)


def _judge(heavy, best):
    """Sums over the links whose counts were sent; the rest of the links as lists."""
    def run(batches):
        (code, n), (top, n_b) = heavy.value, best.value
        for b in batches:
            c, t = b.column("codes"), b.column("times").flatten().to_numpy(zero_copy_only=False).astype("int64")
            size = np.asarray(c.value_lengths().fill_null(0), "int64")
            c = c.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(code, c), max(len(code) - 1, 0))
            hit = code[at] == c if len(code) else np.zeros(len(c), bool)
            count = np.where(hit, n[at], 0) if len(code) else np.zeros(len(c), "int64")
            is_best = hit & (count == top[c // n_b])
            sums = np.zeros((2, len(size)), "int64")
            np.add.at(sums[0], row, count * t)
            np.add.at(sums[1], row, is_best * t)
            left = np.r_[0, np.cumsum(np.bincount(row[~hit], minlength=len(size)))]
            yield columns(b, ["row"], {"count_sum": pa.array(sums[0]), "n_best": pa.array(sums[1]),
                                       "codes": pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(c[~hit])),
                                       "times": pa.ListArray.from_arrays(pa.array(left, pa.int32()), pa.array(t[~hit]))})
    return run


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, heavy: int = HEAVY) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A reads a space and the text, B the text, to which it adds a space itself; special tokens in
    texts are plain text. Texts that are null, empty, or not given back byte for byte by both
    tokenizers have zeros and an empty digest. Counts are of rows: repeated rows and rows that
    share an id each count. An empty table gives no rows; extra columns are ignored."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8()).withColumn("row", F.monotonically_increasing_id())
    done = materialise(src.mapInArrow(_align_batches(a_path, b_path), "row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, codes array<bigint>, times array<int>"), "aligned")
    counts = materialise(done.select("codes").mapInArrow(_count_codes, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")), "counts")
    n_b = _pair(a_path, b_path).n_b
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    limit = total // heavy  # codes above it are fewer than `heavy`
    top = counts.groupBy(F.expr(f"code div {n_b}").alias("a")).agg(F.max("n").alias("best"))
    tops = materialise(top, "tops")
    best = np.zeros(len(_pair(a_path, b_path).a_size), "int64")
    for r in tops.toLocalIterator():  # one row per id of the vocabulary at most
        best[r.a] = r.best
    sent = counts.where(F.col("n") > limit).orderBy("code").toPandas()
    heavy_b = spark.sparkContext.broadcast((sent["code"].to_numpy("int64"), sent["n"].to_numpy("int64")))
    best_b = spark.sparkContext.broadcast((best, n_b))
    judged = materialise(done.select("row", "codes", "times").mapInArrow(_judge(heavy_b, best_b), "row bigint, count_sum bigint, n_best bigint, codes array<bigint>, times array<bigint>"), "judged")
    rare = judged.select("row", F.explode(F.arrays_zip("codes", "times")).alias("l")).select("row", F.col("l.codes").alias("code"), F.col("l.times").alias("t"))
    light = counts.where(F.col("n") <= limit).join(tops, F.expr(f"code div {n_b}") == F.col("a")).select("code", "n", (F.col("n") == F.col("best")).cast("long").alias("top"))
    rest = rare.join(light, "code").groupBy("row").agg(F.sum(F.col("n") * F.col("t")).alias("count_sum"), F.sum(F.col("top") * F.col("t")).alias("n_best"))
    both = judged.select("row", "count_sum", "n_best").unionByName(rest).groupBy("row").agg(F.sum("count_sum").alias("count_sum"), F.sum("n_best").alias("n_best"))
    return done.drop("codes", "times").join(both, "row").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op12_alignment(spark, sf_dir):
    """Every document with its alignment; edge cases as in `align_tokenizers`."""
    import public_tokenizers

    from .common import table

    return align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
