"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star edges.

Every distinct shingle set is a node. One hash deals its shingles over `BINS` bins, of which
each keeps its least value; an empty bin borrows from the first full bin of a probe sequence
that depends on the bin alone, the same for all sets. `BANDS` groups of bins are buckets.

A bucket proposes no pairs of its members, only edges from a centre to them: a star. Centres
are the members of least number, so clusters agree on them over all their buckets. The parts that
these edges join are settled in tasks by exact intersections of the full sets, again in stars:
a node is compared with all nodes of its part that share a shingle, and only nodes outside the
part's largest component become a next centre. So every pair of bucket mates is linked, or in
one component, or compared; near copies of one text cost one star and not their square.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, skew_join, utf8
from .jaccard_join import components
from .scan import GRAPH, columns, grams, mix, runs, scan

SHINGLE, PERCENT = 4, 80
#: A pair at the threshold shares no bucket with probability (1 - 0.8**ROWS)**BANDS, 6e-8 here.
BANDS, ROWS = 42, 5
BINS = BANDS * ROWS
#: Sets that are hashed at once, and sets that a worker remembers so that copies are not hashed again.
SLICE, MEMO = 2048, 50_000
#: Bounds of a task: nodes and shingles of a block.
BLOCK, BLOCK_SHINGLES = 4096, 1 << 20
_EMPTY = np.uint32(0xFFFFFFFF)


def one_permutation(sets: list[np.ndarray]) -> np.ndarray:
    """Densified bins of sets of 64-bit hashes, none empty: rows x BINS."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    h = mix(np.concatenate(sets) + np.uint64(0x632BE59BD9B4E019))
    spot = row * BINS + ((h >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype("int64")
    low = np.full(len(sets) * BINS, _EMPTY)
    np.minimum.at(low, spot, (h & np.uint64(0xFFFFFFFE)).astype("uint32"))
    low = low.reshape(len(sets), BINS)
    full = low != _EMPTY
    alone = full.sum(axis=1) == 1
    low[alone] = low[alone].min(axis=1, keepdims=True)
    r, c = np.nonzero(~full & ~alone[:, None])
    t = 0
    while len(r):
        t += 1
        probe = (mix(c.astype("uint64") * np.uint64(0x9E3779B97F4A7C15) + np.uint64(t)) % np.uint64(BINS)).astype("int64")
        hit = full[r, probe]
        low[r[hit], c[hit]] = low[r[hit], probe[hit]]
        r, c = r[~hit], c[~hit]
    return low


def bands(low: np.ndarray) -> np.ndarray:
    """Bucket names of densified bins: rows x BANDS."""
    key = np.broadcast_to(np.arange(BANDS, dtype="uint64") + np.uint64(1), (len(low), BANDS)).copy()
    for j in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + low[:, j::ROWS])
    return key.view("int64")


def shingle_sets(texts: list[bytes], n: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Numbers of words and sorted distinct shingle hashes of texts; fewer words than a shingle form one."""
    w = scan(texts, GRAPH)
    g, first = grams(w.hash, n), w.first
    out = []
    for a, b in zip(first[:-1], first[1:]):
        out.append(np.unique(g[a:b - n + 1]) if b - a >= n else grams(w.hash[a:b], int(b - a)) if b > a else g[:0])
    return np.diff(first), out


def _lists(rows: list[np.ndarray]) -> pa.Array:
    sizes = np.cumsum([0] + [len(r) for r in rows])
    flat = np.concatenate(rows).view("int64") if rows else np.empty(0, "int64")
    return pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(flat, pa.int64()))


def _sign(n_words: int):
    def run(batches):
        known: dict[bytes, None] = {}
        for b in batches:
            for lo, hi in runs(b.column("text")):
                for at in range(lo, hi, SLICE):
                    part = b.slice(at, min(SLICE, hi - at))
                    sets = shingle_sets(part.column("text").to_pylist(), n_words)[1]
                    nodes = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                    new = [k for k, node in enumerate(nodes) if node is not None and node not in known]
                    keys: list = [None] * len(part)
                    if new:
                        for k, row in zip(new, bands(one_permutation([sets[k] for k in new]))):
                            keys[k] = row
                            known[nodes[k]] = None
                    if len(known) > MEMO:
                        known.clear()
                    yield columns(part, ["row", "doc_id", "tkey"], {
                        "node": pa.array(nodes, pa.binary()), "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                        "bands": pa.array(keys, pa.list_(pa.int64()))})
    return run


def _full_sets(n_words: int):
    def run(batches):
        done: set[int] = set()  # repeated rows bring a text again, and equal keys may be different texts
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                sets = shingle_sets(part.column("text").to_pylist(), n_words)[1]
                use = []
                for k, (i, node) in enumerate(zip(part.column("id").to_pylist(), part.column("node").to_pylist())):
                    if i not in done and xxhash.xxh3_128_digest(sets[k].tobytes()) == node:
                        done.add(i)
                        use.append(k)
                yield columns(part.take(pa.array(use, pa.int64())), ["id"], {"shingles": _lists([sets[k] for k in use])})
    return run


class Stars:
    """Full sets of the nodes of a task, with the nodes of each shingle that is met more than once."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.size = np.array([len(x) for x in sets], "int64")
        self.percent = percent
        row = np.repeat(np.arange(len(sets)), self.size)
        _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        keep = times[code] > 1
        row, code = row[keep], code[keep]
        self.first = np.searchsorted(row, np.arange(len(sets) + 1))
        self.code, self.times = code, np.where(times > 1, times, 0)
        self.start = np.r_[0, np.cumsum(self.times)[:-1]]
        self.nodes = row[np.argsort(code, kind="stable")]

    def linked(self, x: int) -> np.ndarray:
        """Nodes whose sets are alike enough to that of x, without x."""
        c = self.code[self.first[x]:self.first[x + 1]]
        n = self.times[c]
        at = np.repeat(self.start[c] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        both = np.bincount(self.nodes[at], minlength=len(self.size))
        out = 100 * both >= self.percent * (self.size[x] + self.size - both)
        out[x] = False
        return np.flatnonzero(out)


def settle(stars: Stars, part: np.ndarray, centre: np.ndarray, known: np.ndarray) -> np.ndarray:
    """One node of its component for each node. `part`: parts of the nodes, which share no link;
    `known`: nodes that are in one component of their part already; `centre`: nodes that may be
    compared with all others. Nodes outside the hub are compared: the hub is the known component
    where there is one, the largest where all nodes may be centres, else empty."""
    root = np.arange(len(part))
    order = np.argsort(part, kind="stable")
    for idx in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        todo, whole = centre[idx].copy(), bool(centre[idx].all())
        if known[idx].any():
            root[idx[known[idx]]] = idx[known[idx]][0]
        while len(idx) > 1:
            r = root[idx]
            hub = r[known[idx]][0] if known[idx].any() else np.bincount(r).argmax() if whole else -1
            left = np.flatnonzero(todo & (r != hub))
            if not len(left):
                break
            x = idx[left[0]]
            todo[left[0]] = False
            met = np.unique(root[np.r_[stars.linked(x), x]])
            if len(met) > 1:
                root[idx[np.isin(r, met)]] = met[0]
    return root


def _settle(percent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("centre", ascending=False).drop_duplicates("id")  # a centre also comes as a node
        ids, part = pdf["id"].to_numpy("int64"), pd.factorize(pdf["label"])[0]
        stars = Stars([np.asarray(x, "int64").view("uint64") for x in pdf["shingles"]], percent)
        root = settle(stars, part, pdf["centre"].to_numpy(bool), pdf["known"].to_numpy(bool))
        joined = np.bincount(root, minlength=len(ids))[root] > 1
        return pd.DataFrame({"id": ids[joined], "grp": ids[root[joined]]})
    return run


def _tasks(nodes: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows of tasks (task, i, j, id, label, shingles, known, centre) and links known already (id,
    grp). `nodes`: id, label, n, edges. Parts that fit share tasks. In a larger one all nodes are
    first compared with its hub, the node of most edges; those that are not linked to it, in
    blocks, then meet all its nodes, in blocks."""
    sized = nodes.groupBy("label").agg(F.count(F.lit(1)).alias("_w"), F.sum("n").alias("_s"), F.max(F.struct("edges", "id")).alias("_c"))
    sized = materialise(sized.where("_w > 1").select("label", "_w", "_s", F.col("_c.id").alias("hub_id"), ((F.col("_w") > BLOCK) | (F.col("_s") > BLOCK_SHINGLES)).alias("large")), "sized")
    n, s, large = sized.agg(F.coalesce(F.sum("_w"), F.lit(0)), F.coalesce(F.sum("_s"), F.lit(0)), F.count(F.when(F.col("large"), 1))).first()
    bins = 1 + max(4 * s // BLOCK_SHINGLES, 4 * n // BLOCK)
    placed = skew_join(nodes.select("id", "label"), sized, ["label"], "_w", "id", n).join(sets, "id")
    if large:
        placed = materialise(placed, "placed")
    one = F.lit(0).cast("int")
    out = placed.where("not large").select((-1 - F.pmod(F.xxhash64("label"), F.lit(bins))).alias("task"), one.alias("i"), one.alias("j"), "id", "label", "shingles", F.lit(False).alias("known"), F.lit(True).alias("centre"))
    if not large:
        return out, None
    big = placed.where("large")
    hubs = big.where("id = hub_id").select("label", F.col("shingles").alias("hub"))
    common, both = F.size(F.array_intersect("shingles", "hub")), F.size("shingles") + F.size("hub")
    big = big.join(hubs.hint("merge"), "label").withColumn("known", 100 * common >= percent * (both - common)).drop("hub")
    big = materialise(big, "large")
    blocks = big.groupBy("label").agg(F.greatest(F.ceil(F.sum(F.size("shingles")) / BLOCK_SHINGLES), F.ceil(F.count(F.lit(1)) / BLOCK)).cast("int").alias("nj"),
                                      F.greatest(F.lit(1), F.ceil(F.sum(F.when(~F.col("known"), F.size("shingles"))) / BLOCK_SHINGLES), F.ceil(F.count(F.when(~F.col("known"), 1)) / BLOCK)).cast("int").alias("ni"))
    big = big.join(F.broadcast(blocks), "label")  # large parts: fewer than all shingles over a block's
    block = lambda k: F.pmod(F.xxhash64("id", F.lit(7)), F.col(k)).cast("int")
    every = big.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("ni") - 1))).withColumn("j", block("nj")).withColumn("centre", F.lit(False))
    open_ = big.where("not known").withColumn("i", block("ni")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("nj") - 1))).withColumn("centre", F.lit(True))
    rows = every.unionByName(open_).select(F.col("label").alias("task"), "i", "j", "id", "label", "shingles", "known", "centre")
    return out.unionByName(rows), big.where("known").select("id", F.col("hub_id").alias("grp"))


def minhash_dedup(docs: DataFrame, percent: int = PERCENT, n_words: int = SHINGLE) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (least doc_id reachable over links), kept.

    Words are runs of bytes that are no ASCII white space, A-Z lower-cased; null and empty texts
    have no shingles and are linked with nothing. Rows with equal sets are one node, whatever
    their ids; of rows that share an id with other texts each is judged by its own text; a null
    id can be in a component but never names it unless all its ids are null. Every repeated row
    is reported. An empty table gives no rows; extra columns are ignored."""
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(), F.xxhash64("text").alias("tkey"))
    signed = materialise(src.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _sign(n_words), "row bigint, doc_id bigint, tkey bigint, node binary, n_shingles bigint, bands array<bigint>"), "signed")
    worded = signed.where("node is not null")
    nodes = worded.groupBy("node").agg(F.max(F.struct("doc_id", "tkey")).alias("head"), F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("_w"),
                                       F.max("bands").alias("bands"), F.first("n_shingles").alias("n"))
    nodes = materialise(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    spots = nodes.select("id", F.explode("bands").alias("key"))
    total = nodes.count() * BANDS
    shared = materialise(spots.groupBy("key").agg(F.count(F.lit(1)).alias("_w"), F.min("id").alias("hub_id")).where("_w > 1"), "shared")
    edges = skew_join(spots, shared, ["key"], "_w", "id", total).select("id", F.col("hub_id").alias("grp")).distinct()
    edges = materialise(edges, "stars")
    degree = edges.groupBy(F.col("grp").alias("id")).agg(F.count(F.lit(1)).alias("edges"))
    parts = components(edges, total).join(degree, "id", "left").withColumn("edges", F.coalesce("edges", F.lit(0)))
    parts = materialise(parts.join(nodes.select("id", "n", "node", F.col("head.doc_id").alias("_d"), F.col("head.tkey").alias("_t")), "id"), "parts")

    # Full sets of these nodes; their texts are found again by id and key. Copies of a head's row
    # can meet in several tasks, so one set of each id is taken.
    # The heads grow with the corpus, so they are not broadcast at any size.
    texts = src.join(parts.select("id", "node", "_d", "_t").hint("merge"), F.col("_d").eqNullSafe(F.col("doc_id")) & (F.col("_t") == F.col("tkey"))).select("id", "node", "text")
    sets = texts.mapInArrow(_full_sets(n_words), "id bigint, shingles array<bigint>").dropDuplicates(["id"])
    tasks, known = _tasks(parts.select("id", "label", "n", "edges"), sets, percent)
    found = tasks.groupBy("task", "i", "j").applyInPandas(_settle(percent), "id bigint, grp bigint")
    found = materialise(found if known is None else found.unionByName(known), "found")
    labels = components(found.unionByName(found.select(F.col("grp").alias("id"), "grp")), total)
    classes = materialise(nodes.select("id", "node", "_w", "low").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id")), "classes")
    names = materialise(classes.groupBy("label").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("_c")), "names")
    classes = materialise(skew_join(classes, names, ["label"], "_c", "node", total).select("node", "_w", "component_id"), "by_node")
    known = skew_join(worded.select("row", "doc_id", "n_shingles", "node"), classes, ["node"], "_w", "row", total // BANDS)
    plain = signed.where("node is null").withColumn("component_id", F.col("doc_id"))
    out = ["doc_id", "n_shingles", "component_id"]
    return known.select(*out).unionByName(plain.select(*out)).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op11_minhash(spark, sf_dir):
    """Every document with its component; edge cases as in `minhash_dedup`."""
    from .common import table

    return minhash_dedup(table(spark, sf_dir, "documents"))


WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
      ELSE list_distinct([array_to_string(w[i:i + {SHINGLE - 1}], ' ') for i in range(1, len(w) - {SHINGLE - 2})]) END AS g FROM d),
n AS (SELECT doc_id, len(g) AS n FROM s), x AS MATERIALIZED (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c, any_value(a.n + b.n) AS t FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id
      AND 100 * least(a.n, b.n) >= {PERCENT} * greatest(a.n, b.n) GROUP BY ALL),
h AS (SELECT a, b FROM p WHERE 100 * c >= {PERCENT} * (t - c)), e AS (FROM h UNION ALL SELECT b, a FROM h),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
k AS (SELECT a, min(b) AS component_id FROM r GROUP BY a)
SELECT n.doc_id, n.n AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN k ON k.a = n.doc_id"""
