"""N-gram Jaccard join by a MinHash LSH forest and exact verification.

Every distinct word sequence is a node and gets a signature of `TREES` sorted prefix tries of
`DEPTH` minima. Nodes that share a prefix of the floor depth in any tree are connected, and
connected nodes meet in tasks of bounded size (blocks of a large component meet in pairs).
There each tree's signatures are sorted and prefixes are shortened from the full depth: the
pairs met at a depth are estimated on whole signatures, and shortening ends when the expected
share of pairs still missed, one at the threshold included, falls below the target; the floor
is the depth at which a lone pair at the threshold meets the target. Pairs whose estimate is
far below the threshold connect nothing more, so chains of weak likeness end here. What stays
connected is verified by exact overlaps of shingle sets, made for these texts alone.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, skew_join, utf8
from .scan import Words, columns, grams, runs, scan

SHINGLE, THRESHOLD = 5, 0.8
TREES, DEPTH, RECALL = 32, 8, 0.9999
#: Estimates this far below the threshold (over six standard deviations) connect nothing.
MARGIN = 0.16
#: Bounds of a task: nodes of a block, and bytes of its shingles.
BLOCK, BLOCK_BYTES = 2048, 8 << 20
#: Signatures that a worker remembers, so that copies are not signed again.
MEMO = 20_000


def meets(similarity, depth: int, trees: int = TREES):
    """Probability that a pair shares a prefix of `depth` in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def floor_depth(threshold=THRESHOLD, trees=TREES, depth=DEPTH, recall=RECALL) -> int:
    """Longest prefix at which a pair at the threshold meets with the target recall."""
    while depth > 1 and meets(threshold, depth, trees) < recall:
        depth -= 1
    return depth


def _family(k: int):
    r = np.random.default_rng(1)
    return r.integers(0, 2**31, (k, 1), dtype="uint32") * np.uint32(2) + np.uint32(1), r.integers(0, 2**32, (k, 1), dtype="uint32")


_A, _B = _family(TREES * DEPTH)


def signature(shingles: np.ndarray) -> bytes:
    """Minima of a set of 64-bit hashes, 16 bits each, tree by tree."""
    x = (shingles >> np.uint64(32)).astype("uint32")
    low = np.full(TREES * DEPTH, 0xFFFFFFFF, "uint32")
    for i in range(0, len(x), 512):
        np.minimum(low, (x[None, i:i + 512] * _A + _B).min(axis=1), out=low)
    return ((low * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype("uint16").tobytes()


class Shingles:
    """Node names and shingle hashes of the texts of a run; fewer words than a shingle form one, none gives none."""

    def __init__(self, w: Words, n: int):
        self.w, self.n, self.g = w, n, grams(w.hash, n)

    def node(self, k: int) -> bytes | None:
        a, b = self.w.first[k], self.w.first[k + 1]
        return xxhash.xxh3_128_digest(self.w.hash[a:b].tobytes()) if b > a else None

    def of(self, k: int) -> np.ndarray:
        a, b = self.w.first[k], self.w.first[k + 1]
        return self.g[a:b - self.n + 1] if b - a >= self.n else grams(self.w.hash[a:b], b - a)


def components(edges: DataFrame, n: int) -> DataFrame:
    """Labels (id, label = largest id) of the parts joined by shared groups. `edges`: id, grp.
    Each round takes the best label of a group and of a node; lineage is cut by a table."""
    edges = materialise(edges.distinct(), "edges")
    labels = edges.select("id", F.col("id").alias("label")).distinct()
    weight = edges.groupBy("id").agg(F.count(F.lit(1)).alias("_w"))
    labels = materialise(labels.join(weight, "id"), "labels")
    total = edges.count()
    while True:
        named = materialise(skew_join(edges.withColumn("_k", F.xxhash64("grp", "id")), labels, ["id"], "_w", "_k", total).select("id", "grp", "label"), "named")
        best = named.groupBy("grp").agg(F.max("label").alias("best"), F.min("label").alias("worst"), F.count(F.lit(1)).alias("_w"))
        best = materialise(best.where("best <> worst"), "best")  # only groups that still disagree do anything
        if best.isEmpty():
            return labels.select("id", "label")
        moved = materialise(skew_join(named.select("id", "grp"), best, ["grp"], "_w", "id", total).groupBy("id").agg(F.max("best").alias("best")), "moved")
        # Pointer jumping: also follow the label's own label, so long chains take few rounds.
        step = labels.join(moved, "id", "left").select("id", F.greatest("label", F.coalesce("best", "label")).alias("label"), "_w")
        step = materialise(step, "step")
        changed = step.join(moved, "id", "left_semi").select("id", "label")
        hop = step.select(F.col("id").alias("label"), F.col("label").alias("further"))
        per = materialise(changed.groupBy("label").agg(F.count(F.lit(1)).alias("_w")).join(hop, "label").where("further <> label"), "hops")
        jumped = skew_join(changed, per, ["label"], "_w", "id", total).select("id", "further")
        labels = materialise(step.join(jumped, "id", "left").select("id", F.coalesce("further", "label").alias("label"), "_w"), "labels")


def _roots(links: np.ndarray) -> np.ndarray:
    root = np.arange(len(links))
    while True:
        new = np.maximum(root, np.where(links, root[None, :], -1).max(axis=1, initial=-1))
        new = np.maximum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _star(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Root of each of n nodes under the links a - b."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.maximum.at(new, a, root[b])
        np.maximum.at(new, b, root[a])
        new = np.maximum(new, new[new])
        if (new == root).all():
            return root
        root = new


def near_pairs(sig: np.ndarray, threshold: float, recall: float, margin: float = MARGIN) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows whose estimated similarity is near the threshold or above, by descending
    sorted prefixes. `sig`: rows x trees x depth."""
    n, trees, depth = sig.shape
    flat, met = sig.reshape(n, -1), np.zeros((n, n), bool)
    keys = [np.zeros((n, trees), "uint64")]
    for d in range(depth):
        keys.append((keys[-1] + sig[:, :, d] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) ^ (keys[-1] >> np.uint64(31)))
    a, b, s = [], [], []
    stop = floor_depth(threshold, trees, depth, recall)
    done = met.copy()
    for d in range(depth, stop - 1, -1):
        for t in range(trees):
            k = keys[d][:, t]
            order = np.argsort(k, kind="stable")
            cut = np.flatnonzero(np.r_[True, k[order][1:] != k[order][:-1], True])
            for i in np.flatnonzero(np.diff(cut) > 1):
                r = order[cut[i]:cut[i + 1]]
                met[np.ix_(r, r)] = True
        for i in np.flatnonzero((met & ~done).any(axis=1)):
            j = i + 1 + np.flatnonzero(met[i, i + 1:] & ~done[i, i + 1:])
            if len(j):
                est = (flat[i] == flat[j]).mean(axis=1)
                j, est = j[est >= threshold - margin], est[est >= threshold - margin]
                a.append(np.full(len(j), i))
                b.append(j)
                s.append(est)
        done = met.copy()
        good = np.concatenate(s) if s else np.empty(0)
        good = good[good >= threshold]
        missed = (1 / meets(good, d, trees) - 1).sum() + 1 - meets(threshold, d, trees)
        if missed <= (1 - recall) * (len(good) + 1):
            break
    none = np.empty(0, "int64")
    return (np.concatenate(a), np.concatenate(b)) if a else (none, none)


def _sketch(threshold: float, recall: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(pdf["sig"]), "uint16").reshape(len(pdf), TREES, DEPTH)
        a, b = near_pairs(sig, threshold, recall)
        ids = pdf["id"].to_numpy("int64")
        linked = np.unique(np.r_[a, b])
        root = _star(a, b, len(ids))
        return pd.DataFrame({"id": ids[linked], "grp": ids[root[linked]]})
    return run


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Exact pairwise intersection sizes, by columns of the distinct shingles in chunks."""
    n = len(sets)
    if n == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]], "float64")
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, col, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[col] > 1  # a shingle of one text overlaps nothing
    row, col = row[shared], np.unique(col[shared], return_inverse=True)[1] if shared.any() else col[shared]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((n, n), "float32")
    width = int(col[-1]) + 1 if len(col) else 0
    step = 4096 if n > 64 else 1 << 16
    for c in range(0, width, step):
        a, b = np.searchsorted(col, [c, c + step])
        m = np.zeros((n, min(step, width - c)), "float32")
        m[row[a:b], col[a:b] - c] = 1
        out += m @ m.T
    return out.astype("float64")


def _verify(threshold: float):
    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        """All pairs within a label, of different blocks where the task holds two."""
        two = pdf["block"].nunique() > 1
        own = bool((pdf["i"] == pdf["j"]).all())
        out = []
        for _, part in pdf.drop_duplicates("id").groupby("label", sort=False):
            if len(part) < 2:
                continue
            sets = [np.frombuffer(s, "uint64") for s in part["shingles"]]
            sizes = np.array([len(s) for s in sets], "float64")
            both = _overlaps(sets)
            links = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
            np.fill_diagonal(links, False)
            has = links.any(axis=1)
            if not has.any():
                continue
            ids, root = part["id"].to_numpy("int64"), _roots(links)
            if two and not own:
                blk = part["block"].to_numpy()
                links &= blk[:, None] != blk[None, :]
            out.append(pd.DataFrame({"id": ids[has], "root": ids[root[has]], "links": links.sum(axis=1)[has]}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "root": [], "links": []}).astype("int64")
    return verify


def _dealt(members: DataFrame, size: str, per_task: int) -> DataFrame:
    """Rows of tasks: parts that fit in a task share one, larger parts are cut into blocks that
    meet in pairs. `members`: id, label, `size`; adds bin, i, j, block."""
    sized = materialise(members.groupBy("label").agg(F.sum(size).alias("_s"), F.count(F.lit(1)).alias("_w")), "sized")
    n, total = sized.agg(F.coalesce(F.sum("_w"), F.lit(0)), F.coalesce(F.sum("_s"), F.lit(0))).first()
    bins = 1 + max(total // per_task, n // BLOCK)
    nb = F.greatest(F.ceil(F.col("_s") / per_task), F.ceil(F.col("_w") / BLOCK)).cast("int")
    placed = skew_join(members, sized, ["label"], "_w", "id", n).withColumn("nb", nb)
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id", F.lit(7)), F.col("nb")).cast("int")).withColumn(
        "bin", F.when(F.col("nb") > 1, F.col("label")).otherwise(-1 - F.pmod(F.xxhash64("label"), F.lit(bins))))
    return placed.drop("_s", "_w")


def _in_pairs(placed: DataFrame) -> DataFrame:
    """One row per task of a node: its block meets every block of its part."""
    return placed.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))).withColumns(
        {"i": F.least("block", "o"), "j": F.greatest("block", "o")}).drop("o", "nb")


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD, n_words: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """Per row: doc_id, class_id (largest doc_id of the class), n_links (different word
    sequences of similarity >= threshold), is_class_head.

    Words are those of the decontamination operator. Rows with the same words are one node and
    share its class, whatever their ids; a null id can be in a class but never names it. Texts
    without words form no links and stay alone. Repeated rows are reported each, and of rows
    that share an id with other texts each is judged by its own text; an empty table gives
    none; extra columns are ignored."""
    def sign(batches):
        known: dict[bytes, None] = {}
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                s = Shingles(scan(part.column("text").to_pylist()), n_words)
                nodes = [s.node(k) for k in range(len(part))]
                sigs: list[bytes | None] = []
                for k, node in enumerate(nodes):
                    sigs.append(None if node is None or node in known else signature(s.of(k)))
                    if node is not None:
                        known[node] = None
                if len(known) > MEMO:
                    known.clear()
                yield columns(part, ["row", "doc_id", "tkey"], {"node": pa.array(nodes, pa.binary()), "n_words": pa.array(np.diff(s.w.first)), "sig": pa.array(sigs, pa.binary())})

    src = docs.select("doc_id", utf8(), F.xxhash64("text").alias("tkey"))
    signed = materialise(src.withColumn("row", F.monotonically_increasing_id()).mapInArrow(sign, "row bigint, doc_id bigint, tkey bigint, node binary, n_words bigint, sig binary"), "signed")
    worded = signed.where("node is not null")
    nodes = worded.groupBy("node").agg(F.max(F.struct("doc_id", "tkey")).alias("head"), F.count(F.lit(1)).alias("_w"), F.max("sig").alias("sig"), F.max("n_words").alias("n_words"))
    nodes = materialise(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()

    # Nodes that share a leaf of the floor depth in any tree.
    stop, width = floor_depth(threshold, recall=recall), 2 * DEPTH
    spots = nodes.select("id", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")).select(
        "id", F.xxhash64("tree", F.substring("sig", F.col("tree") * width + 1, F.lit(2 * stop))).alias("grp"))
    met = materialise(spots.groupBy("grp").agg(F.count(F.lit(1)).alias("_w")).where("_w > 1"), "met")
    parts = components(skew_join(spots, met, ["grp"], "_w", "id", n * TREES).select("id", "grp"), n)
    tasks = _in_pairs(_dealt(parts.withColumn("_one", F.lit(1)), "_one", BLOCK).join(nodes.select("id", "sig"), "id"))
    near = tasks.groupBy("bin", "i", "j").applyInPandas(_sketch(threshold, recall), "id bigint, grp bigint")
    parts = components(materialise(near, "near"), n)

    # Shingle sets of what is left: texts are found again by their own key.
    members = parts.join(nodes.select("id", "node", "head", (8 * F.col("n_words")).alias("_bytes")), "id")
    placed = _dealt(members, "_bytes", BLOCK_BYTES).select("id", "node", "label", "nb", "block", "bin", F.col("head.doc_id").alias("_d"), F.col("head.tkey").alias("_t"))

    def shingled(batches):
        done: set[int] = set()
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                s = Shingles(scan(part.column("text").to_pylist()), n_words)
                ids, nodes_ = part.column("id").to_pylist(), part.column("node").to_pylist()
                # Repeated rows bring a text again, and equal keys may be different texts.
                use = []
                for k, i in enumerate(ids):
                    if i not in done and s.node(k) == nodes_[k]:
                        done.add(i)
                        use.append(k)
                yield columns(part.take(pa.array(use, pa.int64())), ["id", "label", "nb", "block", "bin"], {"shingles": pa.array([np.unique(s.of(k)).tobytes() for k in use], pa.binary())})

    texts = src.select("doc_id", "tkey", "text").join(placed, F.col("_d").eqNullSafe(F.col("doc_id")) & (F.col("_t") == F.col("tkey"))).select("id", "node", "label", "nb", "block", "bin", "text")
    sets = texts.mapInArrow(shingled, "id bigint, label bigint, nb int, block int, bin bigint, shingles binary")
    checked = materialise(_in_pairs(sets).groupBy("bin", "i", "j").applyInPandas(_verify(threshold), "id bigint, root bigint, links bigint"), "checked")
    links = checked.groupBy("id").agg(F.sum("links").alias("n_links"))
    edges = checked.select("id", F.col("root").alias("grp")).unionByName(checked.select(F.col("root").alias("id"), F.col("root").alias("grp")))
    classes = components(edges, n)
    named = nodes.select("id", "node", "_w", F.col("head.doc_id").alias("top")).join(classes, "id", "left").join(links, "id", "left")
    named = materialise(named.select("node", "_w", "top", F.coalesce("label", "id").alias("label"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")), "named")
    heads = named.groupBy("label").agg(F.max("top").alias("class_id"), F.count(F.lit(1)).alias("_c"))
    named = skew_join(named, materialise(heads, "heads"), ["label"], "_c", "node", n).select("node", "_w", "class_id", "n_links")
    known = skew_join(worded.select("row", "doc_id", "node"), materialise(named, "classes"), ["node"], "_w", "row", n).select("doc_id", "class_id", "n_links")
    plain = signed.where("node is null").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return known.unionByName(plain).withColumn("is_class_head", F.col("doc_id").eqNullSafe(F.col("class_id")))


def op10_jaccard_join(spark, sf_dir):
    """Every document with its class; edge cases as in `jaccard_join`."""
    from .common import table

    return jaccard_join(table(spark, sf_dir, "documents"))
