"""Removal of byte strings of 100 or more that start earlier in the corpus.

Every 100-byte window has a minimiser, the least hash of its 32-byte strings. A maximal run
of windows with one minimiser is a piece: its windows can repeat only in pieces of the same
minimiser. Minimisers of one text alone repeat nowhere else and are set aside first. Of the
others, an equal piece (by a 128-bit cryptographic digest of its bytes) in an earlier document
settles all its windows; pieces that differ but share a minimiser are compared by
Burrows-Wheeler transforms: each partition builds one transform per bucket of minimisers, and
a bucket merges the transforms of all partitions by refining their interleave once per
compared byte. The blocks left after 100 rounds are the suffixes with a common prefix of 100
bytes, so no merged suffix is sorted again. Pieces of one minimiser that together exceed
`LIMIT` bytes have their windows grouped by digests instead, which is exact in the same way,
so no task depends on how often a passage repeats. Repeats inside a document are found there
and compared byte by byte.

Texts are kept once, compressed, in a table bucketed by their key; what later steps learn is
joined to it in place, so text is shuffled once.
"""

from __future__ import annotations

import functools
import hashlib
import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, salts, shared_dir, skew_join, utf8
from .scan import columns, powers, runs

LENGTH, GRAM = 100, 32
#: Bytes of the different pieces of one minimiser that are compared in one task, and of a bucket of minimisers.
LIMIT, BUCKET_BYTES = 4 << 20, 1 << 20
#: Texts that a worker remembers while it drops copies.
MEMO = 200_000
#: Bytes of texts that are hashed together.
RUN_BYTES = 1 << 16
_WORD, _GRAM = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


class Run:
    """Texts that are hashed together, as calls on short ones cost more than their bytes."""

    def __init__(self, texts: list[bytes]):
        size = np.array([len(t) for t in texts])
        self.data, self.begin, self.n = b"".join(texts), np.cumsum(np.r_[0, size]), np.maximum(0, size - LENGTH + 1)

    @functools.cached_property
    def grams(self) -> np.ndarray:
        """Hash of each 32-byte string, made of those of its four words of 8 bytes."""
        h = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,)) * _WORD
        h ^= h >> np.uint64(32)
        for k in (8, 16):
            low = h[:-k] * _WORD
            low += h[k:]
            h = low
        h ^= h >> np.uint64(32)
        h *= _GRAM
        h ^= h >> np.uint64(29)
        return h

    @functools.cached_property
    def pieces(self):
        """First window, number of windows and minimiser of each piece, and the first piece of each text."""
        if not self.n.any():
            return (np.empty(0, "int64"),) * 3 + (np.zeros(len(self.n) + 1, "int64"),)
        grams, k, span = self.grams, 1, LENGTH - GRAM + 1
        while 2 * k <= span:
            grams, k = np.minimum(grams[:-k], grams[k:]), 2 * k
        most = len(self.data) - LENGTH + 1
        least = np.minimum(grams[:most], grams[span - k:span - k + most])
        begin, end = self.begin[:-1], self.begin[:-1] + self.n
        inside = np.zeros(most + 1, "int8")
        inside[begin[self.n > 0]] = 1
        inside[end[self.n > 0]] = -1
        edge = np.r_[True, least[1:] != least[:-1]]
        edge[begin[self.n > 0]] = True
        edge &= np.cumsum(inside[:-1], dtype="int8").view(bool)
        first = np.flatnonzero(edge)
        cut = np.searchsorted(first, self.begin)
        own = np.diff(cut)
        return first - np.repeat(begin, own), np.minimum(np.r_[first[1:], most], np.repeat(end, own)) - first, least[first].view("int64"), cut

    @functools.cached_property
    def twice(self) -> np.ndarray:
        """Texts in which a 32-byte string that starts at a multiple of 64 may come again. Every window
        holds such a string, so in other texts none repeats."""
        out = np.zeros(len(self.n), bool)
        if self.n.any():
            known, high = np.zeros(1 << 16, bool), (self.grams >> np.uint64(48)).astype("uint16")
            known[high[::64]] = True
            at = np.flatnonzero(known[high])
            text = np.searchsorted(self.begin, at, "right") - 1
            key = self.grams[at] + text.astype("uint64") * _WORD
            by = np.argsort(key)
            out[text[by[1:][key[by[1:]] == key[by[:-1]]]]] = True
        return out & (self.n > 1)


class Windows:
    """A document's 100-byte windows: `whole` (hash of each), `first`, `count` and `v` (first
    window, number of windows and minimiser of each piece), made when they are asked for, the
    latter for all texts of a run."""

    def __init__(self, data: bytes, run: Run | None = None, number: int = 0):
        self.data, self.n = data, max(0, len(data) - LENGTH + 1)
        self.run, self.number = run or Run([data]), number

    @functools.cached_property
    def whole(self) -> np.ndarray:
        if not self.n:
            return np.empty(0, "uint64")
        up, down = powers(len(self.data) + 1)
        sums = np.empty(len(self.data) + 1, "uint64")
        sums[0] = 0
        np.cumsum((np.frombuffer(self.data, "uint8") + np.uint64(1)) * up[:-1], out=sums[1:])
        return (sums[LENGTH:] - sums[:-LENGTH]) * down[:self.n]

    @functools.cached_property
    def _runs(self):
        *cols, cut = self.run.pieces
        return [c[cut[self.number]:cut[self.number + 1]] for c in cols]

    first = property(lambda self: self._runs[0])
    count = property(lambda self: self._runs[1])
    v = property(lambda self: self._runs[2])

    def piece(self, i: int) -> bytes:
        return self.data[self.first[i]:self.first[i] + self.count[i] + LENGTH - 1]

    def later_inside(self) -> np.ndarray:
        """Windows that start earlier in the document too: found by hash, then compared byte by byte."""
        later = np.zeros(self.n, bool)
        if not self.run.twice[self.number]:
            return later
        order = np.argsort(self.whole)
        head = np.flatnonzero(np.r_[True, np.diff(self.whole[order]) != 0])
        from_ = np.repeat(np.minimum.reduceat(order, head), np.diff(np.r_[head, self.n]))
        more = order != from_
        at, from_, words = order[more], from_[more], np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,)).copy()
        for k in (*range(0, LENGTH - 7, 8), LENGTH - 8):
            same = words[at + k] == words[from_ + k]
            if not same.all():
                at, from_ = at[same], from_[same]
        later[at] = True
        return later


def shard_transform(strings: list[bytes]) -> np.ndarray:
    """Burrows-Wheeler transform of strings with one terminator each (0; byte b is b + 1,
    UTF-8 has no 255). Row i below len(strings) is the terminator of string i.

    Suffixes are ranked by their first four bytes and then by twice as many bytes a round; only
    those that still share their rank are sorted again."""
    m = len(strings)
    raw = np.frombuffer(b"\xff".join(strings) + b"\xff", "uint8")
    text = raw + np.uint8(1)  # the mark between strings wraps to 0
    n, k = len(text), 4
    key, on, ahead = np.zeros(n, "uint64"), np.ones(n, "uint8"), np.r_[text, np.zeros(k, "uint8")]
    for j in range(k):  # what follows a terminator does not count
        on &= ahead[j:j + n] != 0
        key <<= np.uint64(8)
        key |= ahead[j:j + n] * on
    key = np.sort(key << np.uint64(32) | np.arange(n, dtype="uint64"))  # equal terminators stay in the order of their strings
    order, key = (key & np.uint64(0xFFFFFFFF)).astype("int64"), key >> np.uint64(32)
    cut = np.r_[True, key[1:] != key[:-1]] | (key & np.uint64(0xFF) == 0)
    rank = np.empty(n + 1, "int64")
    rank[order] = np.maximum.accumulate(np.where(cut, np.arange(n), 0))
    rank[n] = -1
    open_ = order[~(cut & np.r_[cut[1:], True])]
    while len(open_):
        key = rank[open_] * (n + 1) + rank[np.minimum(open_ + k, n)] + 1
        by = np.argsort(key)
        open_, key = open_[by], key[by]
        old = rank[open_]
        at = np.arange(len(open_))
        group = np.maximum.accumulate(np.where(np.r_[True, old[1:] != old[:-1]], at, 0))
        cut = np.r_[True, key[1:] != key[:-1]]
        rank[open_] = old + np.maximum.accumulate(np.where(cut, at, 0)) - group
        open_ = open_[~(cut & np.r_[cut[1:], True])]
        k *= 2
    place = np.empty(n, "int64")
    place[rank[:n]] = np.arange(n)
    return text[place - 1]


def merge_transforms(shards: list[np.ndarray], depth: int = LENGTH, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows (counted through the shards, one after another) of the suffixes that share a
    prefix of `depth` with another one, in merged order, and their blocks. With `start`, of
    the suffixes alone that are `depth` bytes longer than those of the rows `start`.

    Each round reads the symbols under the present interleave and deals the rows before
    them by symbol, stably, which makes the interleave right for one more byte; a row starts
    a block when its symbol or the block it came from changes. What precedes a suffix alone
    in its block is alone too, so such rows are settled and set aside."""
    flat = np.concatenate(shards)
    back = np.concatenate([_before(s) for s in shards]) + np.repeat(np.cumsum([0, *map(len, shards[:-1])]), [len(s) for s in shards])
    back = back.astype("int32")  # a bucket has far fewer bytes
    rows = np.arange(len(flat), dtype="int32") if start is None else start.astype("int32")
    block = np.zeros(len(rows), "int32")
    for _ in range(depth):
        symbol = flat[rows]
        order = np.argsort(symbol, kind="stable")[np.count_nonzero(symbol == 0):]
        symbol, came = symbol[order], block[order]
        edge = np.ones(len(order) + 1, bool)
        edge[1:-1] = (symbol[1:] != symbol[:-1]) | (came[1:] != came[:-1])
        shared = ~(edge[:-1] & edge[1:])
        rows, block = back[rows[order[shared]]], np.cumsum(edge[:-1][shared], dtype="int32")
    return rows, block


def _before(shard: np.ndarray) -> np.ndarray:
    """Row of the suffix one byte longer; 0 where a string starts."""
    m = np.count_nonzero(shard == 0)
    back = np.zeros(len(shard), "int64")
    back[np.argsort(shard, kind="stable")[m:]] = np.arange(m, len(shard))
    return back


def places(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """String and distance from its end of each row, by walking all strings backwards."""
    m, back = np.count_nonzero(shard == 0), _before(shard)
    string, dist = np.empty(len(shard), "int64"), np.empty(len(shard), "int64")
    lane, row, step = np.arange(m), np.arange(m), 0
    while len(row):
        string[row], dist[row] = lane, step
        on = shard[row] != 0
        lane, row, step = lane[on], back[row[on]], step + 1
    return string, dist


def repeats(pdf: pd.DataFrame) -> pd.DataFrame:
    """Windows of a bucket that also start in an earlier document: text, piece, offsets."""
    shards = [np.frombuffer(b, "uint8") for b in pdf["bwt"]]
    string, dist, base = [], [], 0
    for s in shards:
        a, d = places(s)
        string.append(a + base)
        dist.append(d)
        base += int((s == 0).sum())
    tk, pk, ord_ = np.concatenate(pdf["tks"].tolist()), [x for xs in pdf["pks"] for x in xs], np.concatenate(pdf["ords"].tolist())
    string, dist = np.concatenate(string), np.concatenate(dist)
    size = np.zeros(base, "int64")
    np.maximum.at(size, string, dist)
    # A window ends where 100 bytes come before: the refinement goes from there to its first byte.
    at, block = merge_transforms(shards, LENGTH, np.flatnonzero(dist <= size[string] - LENGTH))
    s, offs = string[at], (size[string] - dist)[at]
    least = np.full(block.max(initial=0) + 1, np.iinfo("int64").max)
    np.minimum.at(least, block, ord_[s])
    bad = np.flatnonzero(ord_[s] > least[block])
    bad = bad[np.argsort(s[bad], kind="stable")]
    s, at = s[bad], offs[bad]
    cuts = np.flatnonzero(np.r_[True, s[1:] != s[:-1]]) if len(s) else np.empty(0, int)
    return pd.DataFrame({"tk": tk[s[cuts]], "pk": [pk[i] for i in s[cuts]], "offs": pd.Series([x.astype("int32") for x in np.split(at, cuts[1:])] if len(s) else [], dtype=object)})


def covered(starts: np.ndarray, size: int) -> np.ndarray:
    d = np.bincount(starts, minlength=size + 1) - np.bincount(np.minimum(starts + LENGTH, size), minlength=size + 1)
    return np.cumsum(d[:-1]) > 0


def _documents(batches):
    """Text key, whole digest and length of every row."""
    for b in batches:
        for lo, hi in runs(b.column("text"), 32 << 20):
            part = b.slice(lo, hi - lo)
            sha = [hashlib.sha256(t).digest() for t in part.column("text").to_pylist()]
            yield columns(part, ["row", "doc_id"], {"tk": pa.array([int.from_bytes(h[:8], "little", signed=True) for h in sha]), "sha": pa.array(sha, pa.binary()), "n_bytes": pa.array([len(t) for t in part.column("text").to_pylist()], pa.int64())})


def _packed(batches):
    """Texts long enough to repeat, compressed, without the copies that one task meets."""
    seen, pack = set(), zstandard.ZstdCompressor(level=3)
    for b in batches:
        for lo, hi in runs(b.column("text"), 8 << 20):
            keys, out = [], []
            for t in b.column("text").slice(lo, hi - lo).to_pylist():
                h = hashlib.sha256(t).digest()
                if len(t) >= LENGTH and h not in seen:
                    seen.add(h)
                    keys.append(int.from_bytes(h[:8], "little", signed=True))
                    out.append(pack.compress(t))
            if len(seen) > MEMO:
                seen.clear()
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(out, pa.binary())], names=["tk", "z"])


def _one_of_each(batches):
    """All copies of a text come to one partition, one from a task at most."""
    seen = set()
    for b in batches:
        keys = b.column("tk").to_pylist()
        use = [i for i, k in enumerate(keys) if k not in seen and not seen.add(k)]
        yield b.take(pa.array(use, pa.int64()))


def _each(batch: pa.RecordBatch):
    """(row number, windows) of a batch of compressed texts."""
    unpack = zstandard.ZstdDecompressor()
    z = batch.column("z")
    texts, size = [], 0
    for i in range(len(batch)):
        texts.append(unpack.decompress(z[i].as_py()))
        size += len(texts[-1])
        if size > RUN_BYTES or i + 1 == len(batch):
            run = Run(texts)
            for k, t in enumerate(texts):
                yield i + 1 - len(texts) + k, Windows(t, run, k)
            texts, size = [], 0


def _minimisers(with_text: bool):
    """Distinct minimisers of each text, with its key when asked."""
    def run(batches):
        for b in batches:
            tks = b.column("tk").to_numpy()
            out, n = [], 0
            for i, w in _each(b):
                out.append((i, np.unique(w.v)))
                n += len(out[-1][1])
                if n > 200_000 or i + 1 == len(b):
                    cols = {"v": pa.array(np.concatenate([v for _, v in out]))}
                    if with_text:
                        cols["tk"] = pa.array(np.repeat(tks[[k for k, _ in out]], [len(v) for _, v in out]))
                    yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))
                    out, n = [], 0
    return run


def _pieces(batches):
    """Different pieces of the shared minimisers of each text: v, pk, tk, ord, size."""
    for b in batches:
        tks, ords, shared = b.column("tk").to_pylist(), b.column("ord").to_pylist(), b.column("vs").to_pylist()
        cols = [[], [], [], [], []]

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if k == 1 else pa.int64()) for k, c in enumerate(cols)], names=["v", "pk", "tk", "ord", "size"])

        for i, w in _each(b):
            seen = set()
            for k in np.flatnonzero(np.isin(w.v, np.array(shared[i], "int64"))):
                piece = w.piece(k)
                pk = digest(piece)
                if pk not in seen:
                    seen.add(pk)
                    for c, x in zip(cols, (int(w.v[k]), pk, tks[i], ords[i], len(piece))):
                        c.append(x)
            if len(cols[0]) > 50_000:
                yield flush()
                cols = [[], [], [], [], []]
        yield flush()


def _chosen(w: Windows, vs, pks):
    """(piece number, digest) of the pieces with the given minimisers and digests, each digest once."""
    want = set(pks)
    for k in np.flatnonzero(np.isin(w.v, np.array(vs, "int64"))):
        pk = digest(w.piece(k))
        if pk in want:
            want.discard(pk)
            yield k, pk


def _shards(buckets: int):
    """One transform per bucket of minimisers and run of texts."""
    def run(batches):
        held, n = {}, 0

        def flush():
            rows = [(k, shard_transform([x[0] for x in v]).tobytes(), *([x[i] for x in v] for i in (1, 2, 3))) for k, v in held.items()]
            kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["bucket", "bwt", "tks", "pks", "ords"])

        for b in batches:
            tks, ords, vs, pks = (b.column(c).to_pylist() for c in ("tk", "ord", "vs", "pks"))
            for i, w in _each(b):
                for k, pk in _chosen(w, vs[i], pks[i]):
                    held.setdefault(int(w.v[k]) % buckets, []).append((w.piece(k), tks[i], pk, ords[i]))
                    n += int(w.count[k]) + LENGTH
                if n > 8 * BUCKET_BYTES:
                    yield flush()
                    held, n = {}, 0
        if held:
            yield flush()
    return run


def _loose_windows(batches):
    """Different windows of pieces of very frequent minimisers, by digest."""
    for b in batches:
        tks, ords, vs, pks = (b.column(c).to_pylist() for c in ("tk", "ord", "vs", "pks"))
        for i, w in _each(b):
            at = sorted({j for k, _ in _chosen(w, vs[i], pks[i]) for j in range(w.first[k], w.first[k] + w.count[k])})
            for a in range(0, len(at), 50_000):
                part = {digest(w.data[j:j + LENGTH]) for j in at[a:a + 50_000]}
                yield pa.RecordBatch.from_arrays([pa.array(list(part), pa.binary()), pa.array([tks[i]] * len(part), pa.int64()), pa.array([ords[i]] * len(part), pa.int64())], names=["h", "tk", "ord"])


def _cut(batches):
    """Removed bytes, runs and the digest of what is left, for texts that lose any."""
    for b in batches:
        tks, gone, hs, vs = (b.column(c).to_pylist() for c in ("tk", "gone", "hs", "vs"))
        out = []
        for i, w in _each(b):
            bad = w.later_inside()
            if gone[i] or hs[i]:  # minimisers are computed for these texts alone
                offs: dict[bytes, list] = {}
                for g in gone[i] or []:
                    offs.setdefault(g["pk"], []).append(g["offs"])
                loose = set(hs[i] or [])
                for k in np.flatnonzero(np.isin(w.v, np.array(vs[i], "int64"))):
                    first, n = w.first[k], w.count[k]
                    for o in offs.get(digest(w.piece(k)), []):
                        bad[first + (np.arange(n) if o is None else np.array(o))] = True
                    if loose:
                        for j in range(first, first + n):
                            if not bad[j] and digest(w.data[j:j + LENGTH]) in loose:
                                bad[j] = True
            if bad.any():
                m = covered(np.flatnonzero(bad), len(w.data))
                left = np.frombuffer(w.data, "uint8")[~m].tobytes()
                out.append((tks[i], int(m.sum()), int(np.count_nonzero(np.diff(np.r_[0, m.view("int8")]) == 1)), hashlib.sha256(left).hexdigest()))
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["tk", "n_removed", "n_spans", "kept_sha256"])


def text_table(docs: DataFrame) -> DataFrame:
    """Different texts of 100 bytes or more, compressed (tk, z), in a table bucketed by tk."""
    spark = docs.sparkSession
    n, name = salts(spark), f"texts_{uuid.uuid4().hex}"
    texts = docs.select("text").mapInArrow(_packed, "tk bigint, z binary").repartition(n, "tk").mapInArrow(_one_of_each, "tk bigint, z binary")
    texts.write.bucketBy(n, "tk").option("path", f"{shared_dir(spark)}-texts").saveAsTable(name)
    return spark.table(name)


def suffix_dedup(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null text counts as empty; texts below 100 bytes lose nothing; of exact copies the
    smallest id stays, all bytes of the others go; repeated rows of one id count as copies
    of which one stays, and different texts of one id do not count against each other; rows of
    a null id come first in order. An empty table gives no rows. Extra columns are ignored."""
    src = docs.select("doc_id", utf8())
    base = materialise(src.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_documents, "row bigint, doc_id bigint, tk bigint, sha binary, n_bytes bigint"), "base")
    order = F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))
    heads = base.groupBy("tk", "sha").agg(F.min(F.struct(order.alias("ord"), "row")).alias("m"), F.count(F.lit(1)).alias("_w"))
    heads = materialise(heads.select("tk", "sha", F.col("m.ord").alias("ord"), F.col("m.row").alias("head"), "_w"), "heads")
    firsts = heads.groupBy("tk").agg(F.min("ord").alias("ord"))
    texts = text_table(src)

    # Minimisers of more than one text, and the texts that have them.
    shared = texts.mapInArrow(_minimisers(False), "v bigint").groupBy("v").agg(F.count(F.lit(1)).alias("_w")).where("_w > 1")
    shared = materialise(shared, "shared")
    n = shared.agg(F.coalesce(F.sum("_w"), F.lit(0))).first()[0]
    known = skew_join(texts.mapInArrow(_minimisers(True), "v bigint, tk bigint"), shared, ["v"], "_w", "tk", n).groupBy("tk").agg(F.collect_list("v").alias("vs"))
    known = materialise(known.join(firsts, "tk"), "known")
    pieces = materialise(texts.join(known, "tk").mapInArrow(_pieces, "v bigint, pk binary, tk bigint, ord bigint, size bigint"), "pieces")

    same = materialise(pieces.groupBy("v", "pk").agg(F.min("ord").alias("least"), F.count(F.lit(1)).alias("_w"), F.max("size").alias("size")), "same")
    kinds = same.groupBy("v").agg(F.count(F.lit(1)).alias("_d"), F.sum("size").alias("bytes"))
    kinds = materialise(kinds.select("v", F.when(F.col("_d") == 1, F.lit(None)).when(F.col("bytes") > limit, "loose").otherwise("shard").alias("kind"), "_d"), "kinds")
    judged = skew_join(same.drop("size"), kinds, ["v"], "_d", "pk", n).where("_w > 1 or kind is not null").select("v", "pk", "least", "_w", "kind")
    tagged = skew_join(pieces, materialise(judged, "judged"), ["v", "pk"], "_w", "tk", n)
    tagged = tagged.select("v", "pk", "tk", "size", F.when(F.col("ord") > F.col("least"), "gone").otherwise(F.col("kind")).alias("kind")).where("kind is not null")
    tagged = materialise(tagged, "tagged")

    def texts_of(kind: str) -> DataFrame:
        per = tagged.where(F.col("kind") == kind).groupBy("tk").agg(F.collect_set("v").alias("vs"), F.collect_list("pk").alias("pks"))
        return texts.join(per.join(firsts, "tk"), "tk")

    open_bytes = tagged.where("kind = 'shard'").agg(F.sum("size")).first()[0] or 0
    shards = texts_of("shard").mapInArrow(_shards(1 + open_bytes // BUCKET_BYTES), "bucket bigint, bwt binary, tks array<bigint>, pks array<binary>, ords array<bigint>")
    found = shards.groupBy("bucket").applyInPandas(repeats, "tk bigint, pk binary, offs array<int>")
    seen = materialise(texts_of("loose").mapInArrow(_loose_windows, "h binary, tk bigint, ord bigint"), "seen")
    least = seen.groupBy("h").agg(F.min("ord").alias("least"), F.max("ord").alias("most"), F.count(F.lit(1)).alias("_w")).where("least < most").drop("most")
    loose = skew_join(seen, materialise(least, "least"), ["h"], "_w", "tk", seen.count()).where("ord > least").groupBy("tk").agg(F.collect_list("h").alias("hs"))

    gone = tagged.where("kind = 'gone'").select("tk", "pk", F.lit(None).cast("array<int>").alias("offs")).unionByName(found)
    gone = gone.groupBy("tk").agg(F.collect_list(F.struct("pk", "offs")).alias("gone"))
    found = materialise(gone.join(loose, "tk", "full").join(known.select("tk", "vs"), "tk"), "found")
    done = texts.join(found, "tk", "left").select("tk", "z", "gone", "hs", "vs").mapInArrow(_cut, "tk bigint, n_removed bigint, n_spans bigint, kept_sha256 string")
    heads = materialise(heads.join(done, "tk", "left"), "done")

    out = skew_join(base, heads, ["tk", "sha"], "_w", "row", base.count())
    first = F.col("row") == F.col("head")
    long = F.col("n_bytes") >= LENGTH
    return out.select("doc_id", "n_bytes", F.when(first, F.coalesce("n_removed", F.lit(0))).when(long, F.col("n_bytes")).otherwise(0).cast("long").alias("n_removed"),
                      F.when(first, F.coalesce("n_spans", F.lit(0))).when(long, 1).otherwise(0).cast("long").alias("n_spans"),
                      F.when(~first & long, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce(F.when(first, F.col("kept_sha256")), F.lower(F.hex("sha")))).alias("kept_sha256"))


def op3_suffix_dedup(spark, sf_dir):
    """Every document cut; edge cases as in `suffix_dedup`."""
    from .common import table

    return suffix_dedup(table(spark, sf_dir, "documents"))
