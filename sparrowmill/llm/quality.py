"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(threshold_k - w . x) with one weight vector over hashed words and
ordered thresholds. Gives the expected grade and the tail probability used for selection.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, utf8
from .scan import columns, runs, scan

BUCKETS = 1 << 12
#: Bound on labelled rows that are fitted, a hash sample beyond it; a row sends at most 6 bytes a bucket.
MAX_LABELLED = 10_000
SHAPES = 6
#: Best grade that ratings may have: a threshold per grade is fitted.
MAX_GRADE = 100
_PUNCT, _DIGIT, _UPPER = (np.zeros(256, bool) for _ in range(3))
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
_DIGIT[48:58] = True
_UPPER[65:91] = True


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number, feature and value: hashed words of length one, then shape ratios of the whole text."""
    n, w = len(texts), scan(texts)
    count = np.diff(w.first)
    cell, times = np.unique(w.doc * BUCKETS + (w.hash % np.uint64(BUCKETS)).astype("int64"), return_counts=True)
    doc, v = cell // BUCKETS, np.sqrt(times)
    v = v / np.sqrt(np.maximum(np.bincount(doc, v * v, n), 1e-12))[doc]
    size = np.maximum(1, [len(t) for t in texts])
    kinds = np.unique(np.stack([w.doc.astype("uint64"), w.hash]), axis=1)[0].astype("int64") if len(w.hash) else np.empty(0, "int64")
    share = lambda table: np.array([table[np.frombuffer(t, "uint8")].sum() for t in texts]) / size * 5
    lines = [t.split(b"\n") for t in texts]
    shape = np.stack([share(_PUNCT), share(_DIGIT), share(_UPPER), np.log1p(count) / 5, [len(set(x)) / len(x) for x in lines], np.bincount(kinds, minlength=n) / np.maximum(1, count)], axis=1)
    doc = np.r_[doc, np.repeat(np.arange(n), SHAPES)]
    order = np.argsort(doc, kind="stable")
    return doc[order], np.r_[cell % BUCKETS, np.tile(BUCKETS + np.arange(SHAPES), n)][order], np.r_[v, shape.ravel()][order]


def _sample(known: DataFrame) -> list:
    """Feature rows of the labelled sample: grade, i, v."""
    def run(batches):
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                doc, i, v = features(part.column("text").to_pylist())
                cut = np.searchsorted(doc, np.arange(len(part) + 1))
                cells = [(i[a:z].astype("int16").tobytes(), v[a:z].astype("float32").tobytes()) for a, z in zip(cut[:-1], cut[1:])]
                yield columns(part, ["grade"], {"i": pa.array([c[0] for c in cells], pa.binary()), "v": pa.array([c[1] for c in cells], pa.binary())})

    rows = known.select("grade", utf8()).mapInArrow(run, "grade int, i binary, v binary").collect()
    return [(r.grade, np.frombuffer(r.i, "int16").astype("int64"), np.frombuffer(r.v, "float32").astype("float64")) for r in rows]


def _cumulative(z, theta):
    return 1 / (1 + np.exp(-np.clip(theta[None, :] - z[:, None], -30, 30)))


def loss_and_gradient(p: np.ndarray, at: np.ndarray, idx: np.ndarray, val: np.ndarray, grade: np.ndarray, levels: int, ridge: float):
    """Mean negative log likelihood with a ridge, and its gradient. `p`: weights, the first threshold
    and the logarithms of the steps to the others, so that the order of thresholds holds."""
    m, n = BUCKETS + SHAPES, len(grade)
    w, theta = p[:m], np.cumsum(np.r_[p[m], np.exp(p[m + 1:])])
    z = np.bincount(at, val * w[idx], n)
    c = np.c_[np.zeros(n), _cumulative(z, theta), np.ones(n)]
    hi, lo = c[np.arange(n), grade + 1], c[np.arange(n), grade]
    lik = np.maximum(hi - lo, 1e-12)
    dhi, dlo = hi * (1 - hi) / lik, lo * (1 - lo) / lik
    dz = (dhi - dlo) / n
    dt = np.array([(-(dhi * (grade == k)) + dlo * (grade == k + 1)).sum() for k in range(levels - 1)]) / n
    tail = np.cumsum(dt[::-1])[::-1]
    g = np.r_[np.bincount(idx, val * dz[at], m) + ridge * w, tail[0], tail[1:] * np.exp(p[m + 1:])]
    return -np.log(lik).mean() + ridge * (w @ w) / 2, g


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grade: np.ndarray, levels: int, steps: int = 300, ridge: float = 1e-4):
    """Weights and ordered thresholds by Adam on the mean log likelihood."""
    m = BUCKETS + SHAPES
    at = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    idx, val = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    share = np.cumsum(np.bincount(grade, minlength=levels)[:-1] + 0.5) / (len(grade) + 0.5 * levels)
    start = np.log(share / (1 - share))
    p = np.r_[np.zeros(m), start[0], np.log(np.maximum(np.diff(start), 1e-3))]
    g1, g2 = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, steps + 1):
        _, g = loss_and_gradient(p, at, idx, val, grade, levels, ridge)
        g1, g2 = 0.9 * g1 + 0.1 * g, 0.999 * g2 + 0.001 * g * g
        p = p - 0.05 * (g1 / (1 - 0.9**t)) / (np.sqrt(g2 / (1 - 0.999**t)) + 1e-8)
    return p[:m], np.cumsum(np.r_[p[m], np.exp(p[m + 1:])])


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def score_quality(docs: DataFrame, ratings: DataFrame, min_grade: int | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per row: doc_id, held_out, expected_grade, tail_prob = P(grade >= min_grade), by default the best grade.

    `ratings`: doc_id, grade (integers from 0 to `MAX_GRADE`; others raise). At most about `max_labelled` rated rows are
    learnt from, none whose crc32(doc_id) mod 3 is 1. Null text counts as empty; null grades
    are skipped; several grades of one document count by the least; without two grades both
    outputs are 0. Repeated rows score alike; an empty table gives none; extra columns are ignored."""
    r = ratings.where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade")).where(~held_out(F.col("doc_id")))
    n, low, high = r.agg(F.count(F.lit(1)), F.min("grade"), F.max("grade")).first()
    if n and (low < 0 or high > MAX_GRADE):
        raise ValueError(f"grades must be 0 to {MAX_GRADE}, not {low} to {high}")
    if n > max_labelled:
        r = r.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1e6 * max_labelled / n))
    # The sample is bounded, so it is sent to the documents and no other text moves.
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = _sample(bounded(docs.join(F.broadcast(r), "doc_id").select("text", "grade"), max_labelled))
    held = held_out(F.col("doc_id")).alias("held_out")
    levels = max([x[0] for x in sample], default=0) + 1
    if levels < 2:
        return docs.select("doc_id", held, F.lit(0.0).alias("expected_grade"), F.lit(0.0).alias("tail_prob"))
    w, theta = fit_ordinal([(i, v) for _, i, v in sample], np.array([g for g, _, _ in sample]), levels)
    cut = levels - 1 if min_grade is None else min_grade

    def score(batches):
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                doc, i, v = features(part.column("text").to_pylist())
                above = 1 - _cumulative(np.bincount(doc, v * w[i], len(part)), theta)  # P(grade > k)
                tail = above[:, cut - 1] if cut > 0 else np.ones(len(part))
                yield columns(part, ["doc_id", "held_out"], {"expected_grade": pa.array(above.sum(axis=1)), "tail_prob": pa.array(tail)})

    return docs.select("doc_id", held, utf8()).mapInArrow(score, "doc_id bigint, held_out boolean, expected_grade double, tail_prob double")


def op1_quality(spark, sf_dir):
    """Every document scored on three grades: 2 good and not toxic, 1 one of both, 0 neither; edge
    cases as in `score_quality`."""
    from .common import table

    grade = F.col("quality") + F.when(F.col("toxic") == 1, 0).otherwise(1)
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", grade.alias("grade")))
