"""Hidden Markov language model.

A word is emitted in two steps: the latent state draws a word class, the class draws the
word. Frequent words are classes of their own, the rest fall into classes by ending and
length. Word counts are a distributed table that grows with the corpus; only words of at
least 1/HOT_WORDS of all tokens, at most HOT_WORDS of them, and the class table reach the
workers. Texts are coded as classes once; each Baum-Welch round reads the codes of all
training texts in sequences of up to SEGMENT tokens and sums its counts within and across
partitions. Likelihoods use the scaled forward recursion over whole texts, so they are exact
for texts of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, utf8
from .scan import GRAPH, Words, columns, mix, runs, scan

STATES, TOP_WORDS, SHAPES, ROUNDS = 8, 2000, 512, 8
HOT_WORDS = 200_000
SEGMENT, BATCH_TOKENS = 64, 500_000
END = ""  # no word is empty, so this marks the end of a text
#: Classes: frequent words from 0, the end of a text, shapes of other words.
END_CLASS, N_CLASSES = TOP_WORDS, TOP_WORDS + 1 + SHAPES
ADD = 0.1


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 10 == 0, F.lit(False))


def shapes(w: Words, at: np.ndarray) -> np.ndarray:
    """Class of the words at `at` by their last three bytes and their length."""
    data = np.frombuffer(w.raw, "uint8")
    start, end = w.start[at], w.end[at]
    key = np.minimum((end - start) // 4, 4).astype("uint64")
    for j in (1, 2, 3):
        key = key * np.uint64(256) + np.where(end - j >= start, data[np.maximum(end - j, 0)], 0).astype("uint64")
    return END_CLASS + 1 + (mix(key + np.uint64(1)) % np.uint64(SHAPES)).astype("int64")


def _ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of sequences, longest first, and how many of them reach each step."""
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    return order, np.searchsorted(-size, -np.arange(size[0]), "left") if len(size) else np.empty(0, "int64")


def _forward_flat(x: np.ndarray, begin: np.ndarray, lengths: np.ndarray, pi, a, e) -> np.ndarray:
    """log10 likelihoods of the sequences x[begin:begin + length]."""
    order, live = _ragged(lengths)
    at, et = begin[order], np.ascontiguousarray(e.T)
    logs, f = np.zeros(len(order)), None
    for t, m in enumerate(live):
        f = (pi if f is None else f[:m] @ a) * et[x[at[:m] + t]]
        s = f.sum(axis=1)
        f = f / s[:, None]
        logs[:m] += np.log10(s)
    out = np.zeros(len(order))
    out[order] = logs
    return out


def forward(docs: list[np.ndarray], pi, a, e) -> np.ndarray:
    """log10 likelihoods of class sequences, none of them empty."""
    lengths = np.array([len(d) for d in docs], "int64")
    return _forward_flat(np.concatenate(docs), np.cumsum(lengths) - lengths, lengths, pi, a, e)


def expected_counts(x: np.ndarray, begin: np.ndarray, lengths: np.ndarray, pi, a, e):
    """Baum-Welch counts of starts, transitions and emissions over sequences of bounded length."""
    k = len(pi)
    order, live = _ragged(lengths)
    at = begin[order]
    pi, a, et = pi.astype("float32"), a.astype("float32"), np.ascontiguousarray(e.T, "float32")
    alphas, scales, emits = [], [], []
    f = None
    for t, m in enumerate(live):
        emit = et[x[at[:m] + t]]
        f = (pi if f is None else f[:m] @ a) * emit
        s = f.sum(axis=1)
        f = f / s[:, None]
        alphas.append(f)
        scales.append(s)
        emits.append(emit)
    seen, gammas = [], []
    c_a, b = np.zeros((k, k)), np.ones((0, k), "float32")
    for t in range(len(live) - 1, -1, -1):
        m = live[t]
        b = np.concatenate([b, np.ones((m - len(b), k), "float32")])  # sequences that end here
        seen.append(x[at[:m] + t])
        gammas.append(alphas[t] * b)
        if t:
            v = b * emits[t] / scales[t][:, None]
            c_a += a * (alphas[t - 1][:m].T @ v)
            b = v @ a.T
    g, cls = np.concatenate(gammas), np.concatenate(seen)
    g /= g.sum(axis=1, keepdims=True)
    c_e = np.stack([np.bincount(cls, g[:, s], e.shape[1]) for s in range(k)])
    return g[len(g) - live[0]:].sum(axis=0, dtype="float64"), c_a, c_e


def _normal(m, prior):
    m = m + prior
    return m / m.sum(axis=-1, keepdims=True)


def _segments(lengths: np.ndarray, size: int = SEGMENT):
    """Begin and length of the pieces of consecutive texts, each of `size` tokens at most."""
    n = -(-lengths // size)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = np.repeat(np.cumsum(lengths) - lengths, n) + step * size
    return begin, np.minimum(np.repeat(np.cumsum(lengths), n) - begin, size)


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    raw = batch.column("classes").to_pylist()
    return np.frombuffer(b"".join(raw), "int16"), np.array([len(r) // 2 for r in raw], "int64")


def train(coded: DataFrame, rounds: int = ROUNDS, states: int = STATES, n_classes: int = N_CLASSES):
    """Baum-Welch over the codes (`classes`) of all rows; each round is one pass."""
    rng = np.random.default_rng(7)
    pi, a = np.ones(states) / states, _normal(np.eye(states) * 60.0, 1.0)
    e = _normal(rng.random((states, n_classes)) ** 3, 1e-3)
    size = states + states * states + states * n_classes

    def counts(batches, pi, a, e):
        total = np.zeros(size)
        for b in batches:
            x, lengths = _codes(b)
            begin, n = _segments(lengths)
            for i in range(0, len(n), BATCH_TOKENS // SEGMENT):
                part = expected_counts(x, begin[i:i + BATCH_TOKENS // SEGMENT], n[i:i + BATCH_TOKENS // SEGMENT], pi, a, e)
                total += np.concatenate([p.ravel() for p in part])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["at", "c"])

    for _ in range(rounds):
        rows = coded.select("classes").mapInArrow(lambda it, p=(pi, a, e): counts(it, *p), "at bigint, c double").groupBy("at").agg(F.sum("c").alias("c")).toPandas()
        total = np.zeros(size)
        total[rows["at"]] = rows["c"]
        pi = _normal(total[:states], 0.1)
        a = _normal(total[states:states + states**2].reshape(states, states), 0.1)
        e = _normal(total[states + states**2:].reshape(states, -1), 1e-3)
    return pi, a, e


def count_words(rows: DataFrame) -> DataFrame:
    """Words of all texts: w, h (hash), k (shape class), c (count in training texts), a (count in all)."""
    def run(batches):
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                w = scan(part.column("text").to_pylist(), GRAPH)
                learn = ~np.asarray(part.column("held_out").to_numpy(zero_copy_only=False), bool)
                h, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
                c = np.bincount(back[np.repeat(learn, np.diff(w.first))], minlength=len(h))
                words = [w.word(i) for i in first] + [END.encode()]
                yield pa.RecordBatch.from_arrays([
                    pa.array(words, pa.binary()), pa.array(np.r_[h, np.uint64(0)].view("int64")), pa.array(np.r_[shapes(w, first), END_CLASS]),
                    pa.array(np.r_[c, learn.sum()]), pa.array(np.r_[np.bincount(back, minlength=len(h)), len(learn)])], names=["w", "h", "k", "c", "a"])

    return rows.select("held_out", "text").mapInArrow(run, "w binary, h bigint, k bigint, c bigint, a bigint").groupBy("w", "h", "k").agg(F.sum("c").alias("c"), F.sum("a").alias("a"))


class Coder:
    """Codes texts as classes and sums what frequent words add; other words are listed."""

    def __init__(self, hot: list, n: int, v: int, per_class: dict[int, tuple[int, int]]):
        """`hot`: (h, k, c) of the frequent words; n, v: training tokens, distinct ones."""
        self.div = np.log10(n + ADD * (v + 1))
        top = sorted((r for r in hot if r[2] > 0 and r[1] != END_CLASS), key=lambda r: (-r[2], r[0]))[:TOP_WORDS]
        own = {r[0]: i for i, r in enumerate(top)}
        rows = sorted((r for r in hot if r[1] != END_CLASS), key=lambda r: np.int64(r[0]).view("uint64"))
        self.known = np.array([r[0] for r in rows], "int64").view("uint64")
        self.count = np.array([r[2] for r in rows], "int64")
        # Log10 of a shape class's total: its words but for those that are classes of their own.
        taken = {}
        for r in top:
            t = taken.setdefault(r[1], [0, 0])
            t[0], t[1] = t[0] + r[2], t[1] + 1
        self.class_div = np.zeros(N_CLASSES)
        for k in range(END_CLASS + 1, N_CLASSES):
            (c, d), (ct, dt) = per_class.get(k, (0, 0)), taken.get(k, (0, 0))
            self.class_div[k] = np.log10(c - ct + ADD * (d - dt + 1))
        k = np.array([r[1] for r in rows], "int64")
        self.own = np.array([own.get(r[0], -1) for r in rows], "int64")
        lc = np.log10(self.count + ADD)
        self.base = lc - self.div
        self.inner = np.where(self.own >= 0, 0.0, lc - self.class_div[k]) if len(rows) else lc
        end = next((r[2] for r in hot if r[1] == END_CLASS), 0)
        self.end_known, self.end_base = int(end > 0), np.log10(end + ADD) - self.div

    def code(self, w: Words) -> dict:
        n = len(w.first) - 1
        h, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, h), max(0, len(self.known) - 1))
        hot = self.known[at] == h if len(self.known) else np.zeros(len(h), bool)
        shape = shapes(w, first)
        cls, known, base, inner, div = shape.copy(), np.zeros(len(h), "int64"), np.zeros(len(h)), np.zeros(len(h)), self.class_div[shape]
        if hot.any():
            s = at[hot]
            cls[hot] = np.where(self.own[s] >= 0, self.own[s], shape[hot])
            known[hot], base[hot], inner[hot] = self.count[s] > 0, self.base[s], self.inner[s]
        doc, size = w.doc, np.diff(w.first)
        codes = np.full(len(back) + n, END_CLASS, "int16")
        codes[np.arange(len(back)) + doc] = cls[back]
        ends = w.first[1:] + np.arange(1, n + 1)
        per = lambda x, keep: np.bincount(doc[keep], x[back[keep]], n).astype("float64")  # noqa: E731  (of nothing: integers)
        frequent, rare = np.flatnonzero(hot[back]), np.flatnonzero(~hot[back])
        pair, times = np.unique(doc[rare] * max(1, len(h)) + back[rare], return_counts=True)
        word_no, cut = pair % max(1, len(h)), np.searchsorted(pair, np.arange(n + 1) * max(1, len(h)))
        cold = np.flatnonzero(~hot)
        names = pa.array([w.word(i) for i in first[cold]], pa.binary()).take(pa.array(np.searchsorted(cold, word_no)))
        offsets = pa.array(cut, pa.int32())
        return {"n_tokens": pa.array(size + 1), "classes": pa.array([codes[a:b].tobytes() for a, b in zip(np.r_[0, ends[:-1]], ends)], pa.binary()),
                "known": pa.array(per(known, frequent).astype("int64") + self.end_known), "base": pa.array(per(base, frequent) + self.end_base),
                "inner": pa.array(per(inner, frequent) - per(div, rare)), "n_rare": pa.array(np.bincount(doc[rare], minlength=n)),
                "rare": pa.ListArray.from_arrays(offsets, names), "times": pa.ListArray.from_arrays(offsets, pa.array(times, pa.int64()))}


CODED = "n_tokens bigint, classes binary, known bigint, base double, inner double, n_rare bigint, rare array<binary>, times array<bigint>"


def score_lm(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null text counts as empty: one end token. A null id is a training row. Repeated rows
    are scored each; an empty table gives none; with no training rows counts are zero.
    Extra columns are ignored."""
    rows = docs.select("doc_id", utf8(), held_out(F.col("doc_id")).alias("held_out"))
    counted = materialise(count_words(rows), "words")
    n, v, everything = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.when(F.col("c") > 0, 1)), F.coalesce(F.sum("a"), F.lit(0))).first()
    # Words of at least 1/HOT_WORDS of all tokens: at most HOT_WORDS of them, whatever the corpus.
    is_hot = F.col("a") * HOT_WORDS >= F.lit(everything)
    hot = [tuple(r) for r in counted.where(is_hot | (F.col("k") == END_CLASS)).select("h", "k", "c").toPandas().itertuples(index=False)]
    seen = counted.where((F.col("c") > 0) & (F.col("k") != END_CLASS))
    per_class = {r.k: (r.c, r.d) for r in seen.groupBy("k").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("d")).collect()}
    coder = Coder(hot, n, v, per_class)

    def encode(batches):
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                yield columns(part, ["row", "doc_id", "held_out"], coder.code(scan(part.column("text").to_pylist(), GRAPH)))

    coded = rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(encode, f"row bigint, doc_id bigint, held_out boolean, {CODED}")
    coded = materialise(coded, "coded")
    params = train(coded.where("not held_out"))

    def likelihood(batches):
        for b in batches:
            x, lengths = _codes(b)
            yield columns(b, ["row", "doc_id", "held_out", "n_tokens", "known", "base", "inner", "n_rare"], {"ll": pa.array(_forward_flat(x, np.cumsum(lengths) - lengths, lengths, *params))})

    kept = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, inner double, n_rare bigint"
    seq = coded.select("row", "doc_id", "held_out", "n_tokens", "known", "base", "inner", "n_rare", "classes").mapInArrow(likelihood, f"{kept}, ll double")
    # Each of these words has less than 1/HOT_WORDS of all tokens, training or not, so no key of this join is heavy.
    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r")).select("row", F.col("r.rare").alias("w"), F.col("r.times").alias("m"))
    met = rare.join(counted.where(~is_hot).select("w", "c"), "w")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).alias("k2"), F.sum(F.col("m") * F.log10(F.col("c") + ADD)).alias("lc"))
    out = seq.join(sums, "row", "left")
    lc = F.coalesce("lc", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("k2", F.lit(0))).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
                      (F.col("base") + lc - F.col("n_rare") * float(coder.div)).alias("base_score"), (F.col("ll") + F.col("inner") + lc).alias("score"))


def op9_hmm_lm(spark, sf_dir):
    """Every document scored; edge cases as in `score_lm`."""
    from .common import table

    return score_lm(table(spark, sf_dir, "documents"))
