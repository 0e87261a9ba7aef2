"""Benchmark decontamination with suffix arrays of the training text.

Documents are cut into shards of bounded bytes. A shard sorts the suffixes of its word
sequence and looks every benchmark suffix up by binary search, which gives all places where
its next 13 words occur; places that follow one another on a diagonal are one longest
verbatim match. Suffixes whose first words start no benchmark window are left out of the
array: they can match none. Documents are whole rows of a shard, so no match crosses a cut.
Words are compared as ids of 64-bit hashes, and a hash that meets the benchmark's is checked
byte by byte.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import materialise, numbered, utf8
from .scan import Words, columns, grams, runs, scan

WINDOW = 13
#: Words of a window that are tried before its suffix enters an array.
PROBE = 4
SHARD_BYTES = 2_000_000
BLOCK_BYTES = 8 << 20
FOUND = "n_words bigint, n_hit bigint, starts array<int>, lengths array<int>, items array<string>, longest struct<words:int,start:int,item:string>"


def _within(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Place of each value in the sorted `known`, -1 if it is not there."""
    if not len(known):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return np.where(known[at] == values, at, -1)


class Probe:
    """Set of hashes; a table of their low bits settles most misses."""

    def __init__(self, hashes: np.ndarray):
        self.known = np.unique(hashes)
        self.mask = np.uint64((1 << max(10, int(8 * len(self.known)).bit_length())) - 1)
        self.low = np.zeros(int(self.mask) + 1, bool)
        self.low[self.known & self.mask] = True

    def places(self, values: np.ndarray) -> np.ndarray:
        at = np.flatnonzero(self.low[values & self.mask])
        return at[_within(values[at], self.known) >= 0]


class Block:
    """Benchmark suffixes of one block, for binary search."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.window, self.items = window, sorted({i for i, _ in items})
        w = scan([t for _, t in items])
        self.vocab, at = np.unique(w.hash, return_index=True)
        self.words = [w.word(i) for i in at]
        size = np.diff(w.first)
        k = np.minimum(size, window)
        n = np.where(k > 0, size - k + 1, 0)
        self.text, self.k = np.repeat(np.arange(len(items)), n), np.repeat(k, n)
        self.item = np.searchsorted(self.items, [i for i, _ in items])[self.text] if items else self.text
        self.pos = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        begin = np.repeat(w.first[:-1], n) + self.pos
        ids = np.r_[np.searchsorted(self.vocab, w.hash) + 1, np.zeros(window, "int64")]
        part = np.arange(window)[None, :] < self.k[:, None]
        q = ids[begin[:, None] + np.arange(window)]
        self.low, self.high = self._keys(np.where(part, q, 0)), self._keys(np.where(part, q, 0xFFFFFFFF))
        self.probes = {}
        for size in range(1, min(PROBE, window) + 1):
            g = grams(w.hash, size)
            use = begin[(self.k == size) | (self.k > size) & (size == min(PROBE, window))]
            if len(use):
                self.probes[size] = Probe(g[use])

    def _keys(self, ids: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(ids.astype(">u4")).view(f"S{4 * self.window}").ravel()

    def word_ids(self, w: Words, at: np.ndarray) -> np.ndarray:
        """Benchmark word numbers (from 1) of the words at `at`; 0 where the bytes differ."""
        ids = _within(w.hash[at], self.vocab) + 1
        for i in np.flatnonzero(ids):
            if w.word(at[i]) != self.words[ids[i] - 1]:
                ids[i] = 0
        return ids

    def search(self, w: Words):
        """All places of all windows: word number in the shard, window number."""
        starts = np.unique(np.concatenate([p.places(grams(w.hash, n)) for n, p in self.probes.items()])) if self.probes else np.empty(0, "int64")
        if not len(starts):
            return starts, starts
        stop = w.first[np.searchsorted(w.first, starts, "right")]
        reach = starts[:, None] + np.arange(self.window)
        near, back = np.unique(np.minimum(reach, len(w.hash) - 1), return_inverse=True)
        ids = self.word_ids(w, near)[back.reshape(reach.shape)]
        keys = self._keys(np.where(reach < stop[:, None], ids, 0))
        order = np.argsort(keys, kind="stable")
        keys, starts = keys[order], starts[order]
        lo, hi = np.searchsorted(keys, self.low, "left"), np.searchsorted(keys, self.high, "right")
        n = np.maximum(hi - lo, 0)
        spot = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        return starts[spot], np.repeat(np.arange(len(n)), n)

    def judge(self, w: Words) -> dict:
        """Per text: words, words hit, hit runs, items with an occurring window, longest verbatim match."""
        docs = len(w.first) - 1
        at, win = self.search(w)
        out = {"n_words": np.diff(w.first), "n_hit": np.zeros(docs, "int64"), "starts": [[]] * docs, "lengths": [[]] * docs, "items": [[]] * docs, "longest": [None] * docs}
        if not len(at):
            return out
        step = np.bincount(at, minlength=len(w.hash) + 1) - np.bincount(at + self.k[win], minlength=len(w.hash) + 1)
        hit = np.cumsum(step)[:-1] > 0
        out["n_hit"] = np.diff(np.r_[0, np.cumsum(hit)][w.first])
        order = np.lexsort((at, at - self.pos[win], self.text[win]))
        at, win = at[order], win[order]
        doc, item, diagonal, k = np.searchsorted(w.first, at, "right") - 1, self.item[win], at - self.pos[win], self.k[win]
        cut = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(diagonal) != 0) | (np.diff(self.text[win]) != 0) | (np.diff(doc) != 0)])
        size = np.diff(np.r_[cut, len(at)]) - 1 + k[cut]
        for i in np.lexsort((item[cut], at[cut], size)):  # the longest of a text comes last and stays, of equal ones the last by place and item
            d = doc[cut[i]]
            out["longest"][d] = {"words": int(size[i]), "start": int(at[cut[i]] - w.first[d]), "item": self.items[item[cut[i]]]}
        for d in np.unique(doc):
            h = np.diff(np.r_[0, hit[w.first[d]:w.first[d + 1]].view("int8"), 0])
            out["starts"][d] = np.flatnonzero(h == 1)
            out["lengths"][d] = np.flatnonzero(h == -1) - out["starts"][d]
        pairs = np.unique(doc * len(self.items) + item)
        for d in np.unique(pairs // len(self.items)):
            out["items"][d] = []
        for x in pairs:
            out["items"][x // len(self.items)].append(self.items[x % len(self.items)])
        return out


def find_matches(docs: DataFrame, items: list[tuple[str, bytes]], window: int = WINDOW, key: str | None = None) -> DataFrame:
    """Matches of the benchmark windows of one block, a row per row of `docs`, with its `key`
    if that is given."""
    ids = ["doc_id", key] if key else ["doc_id"]
    block = Block(items, window)
    kinds = {"n_words": pa.int64(), "n_hit": pa.int64(), "starts": pa.list_(pa.int32()), "lengths": pa.list_(pa.int32()), "items": pa.list_(pa.string()),
             "longest": pa.struct([("words", pa.int32()), ("start", pa.int32()), ("item", pa.string())])}

    def run(batches):
        for b in batches:
            for lo, hi in runs(b.column("text"), SHARD_BYTES):
                part = b.slice(lo, hi - lo)
                found = block.judge(scan(part.column("text").to_pylist()))
                yield columns(part, ids, {c: pa.array(found[c], t) for c, t in kinds.items()})

    return docs.select(*ids, utf8()).mapInArrow(run, ", ".join([f"`{c}` bigint" for c in ids] + [FOUND]))


def _union(starts, lengths) -> int:
    """Words inside any run."""
    total, reach = 0, 0
    for s, n in sorted(zip(starts, lengths)):
        total += max(0, s + n - max(reach, s))
        reach = max(reach, s + n)
    return total


def benchmark_blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES):
    """The benchmark in blocks of bounded bytes, one block at a time on the driver;
    items larger than a block form their own."""
    sized = benchmark.where("item_id is not null and text is not null").select(
        F.col("item_id").cast("string").alias("item_id"), "text", F.octet_length("text").alias("_b"), F.floor(F.pmod(F.xxhash64("item_id"), F.lit(1 << 20))).alias("_h"))
    per = sized.groupBy("_h").agg(F.sum("_b").alias("_b"))
    block = per.select("_h", F.floor(F.sum("_b").over(Window.orderBy("_h").rowsBetween(Window.unboundedPreceding, 0)) / block_bytes).alias("_k"))
    last = block.agg(F.max("_k")).first()[0]
    if last is None:
        return
    placed = sized.join(block, "_h")
    for k in range(int(last) + 1):
        rows = placed.where(F.col("_k") == k).select("item_id", "text").collect()
        if rows:
            yield [(r.item_id, r.text.encode()) for r in rows]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the longest
    verbatim match of the window length or more (a whole item if that is shorter): its words,
    first word and item.

    Null or empty text has no words and is clean; null items are skipped; repeated items
    count once by id; each row is judged by its own text, whatever its id and the number of
    benchmark blocks; an empty benchmark marks nothing. Extra columns are ignored."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = benchmark_blocks(benchmark)
    first, after = next(blocks, []), next(blocks, None)
    if after is None:
        out = find_matches(docs, first, window)
    else:  # rows are numbered once; a block's matches are a table before the next block is read
        docs, _ = numbered(docs, "_row")
        parts = ["n_hit", "starts", "lengths", "items", "longest"]
        out = materialise(find_matches(docs, first, window, key="_row"), "matches")
        found = out.where("n_hit > 0").select("_row", *parts)
        while after is not None:
            found = found.unionByName(materialise(find_matches(docs, after, window, key="_row").where("n_hit > 0").select("_row", *parts), "matches"))
            after = next(blocks, None)
        union = F.pandas_udf(lambda s, n: pd.Series([_union(a, b) for a, b in zip(s, n)], dtype="int64"), "long")
        found = found.groupBy("_row").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "lengths", "items")], F.max("longest").alias("longest"))
        found = found.select("_row", union("starts", "lengths").alias("n_hit"), F.array_distinct("items").alias("items"), "longest")
        out = out.select("_row", "doc_id", "n_words").join(found, "_row", "left").withColumns({"n_hit": F.coalesce("n_hit", F.lit(0)), "items": F.coalesce("items", F.array().cast("array<string>"))})
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                      ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
                      F.coalesce("longest.words", F.lit(0)).alias("longest_words"), F.col("longest.start").alias("longest_start"), F.col("longest.item").alias("longest_item"))


def op5_decontaminate(spark, sf_dir):
    """Every document against the whole benchmark; edge cases as in `decontaminate`."""
    from .common import table

    # The longest match is left to callers of the operator: SQL has no row for it.
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("longest_words", "longest_start", "longest_item")


_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SQL = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT DISTINCT item, k, list_slice(w, i, i + k - 1) AS win FROM (SELECT item, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT doc_id, i, k, list_slice(w, i, i + k - 1) AS win FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, ks WHERE len(w) >= k)),
m AS (SELECT doc_id, i, k, item FROM dw JOIN bw USING (k, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS its FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(its, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""
