"""Exact dedup by counting quotient filters.

Each partition counts its fingerprints in a quotient filter: the high bits choose a
quotient, the sorted remainders below it are stored with their counts. Filters merge
without loss by interleaving the sorted remainders of equal quotients and adding the
counts. Only fingerprints whose merged count is above one are compared byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, skew_join, utf8
from .scan import columns, runs

FILTER = "quotient int, remainders array<bigint>, counts array<bigint>"


def _runs(fps: np.ndarray, counts: np.ndarray):
    """Sorted distinct fingerprints with added counts."""
    order = np.argsort(fps, kind="stable")
    fps, counts = fps[order], counts[order]
    first = np.flatnonzero(np.r_[True, fps[1:] != fps[:-1]])
    return fps[first], np.add.reduceat(counts, first)


def build_filters(fps: DataFrame, quotient_bits: int) -> DataFrame:
    """One filter per partition, a row per occupied quotient. `fps` has column fp."""
    shift = 63 - quotient_bits

    def build(batches):
        keys, counts = np.empty(0, "int64"), np.empty(0, "int64")
        for b in batches:
            x = b["fp"].to_numpy("int64")
            if len(x):
                keys, counts = _runs(np.r_[keys, x], np.r_[counts, np.ones(len(x), "int64")])
        if len(keys):
            q = keys >> shift
            cuts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            ends = np.r_[cuts[1:], len(q)]
            low = keys & ((1 << shift) - 1)
            for k in range(0, len(cuts), 256):
                part = [(int(q[a]), low[a:e], counts[a:e]) for a, e in zip(cuts[k:k + 256], ends[k:k + 256])]
                yield pd.DataFrame(part, columns=["quotient", "remainders", "counts"])

    return fps.mapInPandas(build, FILTER)


def merge_filters(filters: DataFrame, quotient_bits: int) -> DataFrame:
    """Lossless merge: rows (fp, n), one per distinct fingerprint. A quotient holds at
    most the distinct fingerprints of its range, whatever the number of copies."""
    shift = 63 - quotient_bits

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        low, n = _runs(np.concatenate(pdf["remainders"].tolist()), np.concatenate(pdf["counts"].tolist()))
        return pd.DataFrame({"fp": (np.int64(pdf["quotient"].iloc[0]) << shift) | low, "n": n})

    return filters.groupBy("quotient").applyInPandas(merge, "fp bigint, n bigint")


def _digests(names: list[str], with_text: bool):
    """Fingerprint and SHA-256 of each lower-cased text, with the text itself when asked."""
    def run(batches):
        for b in batches:
            for lo, hi in runs(b.column("text"), 32 << 20):
                part = b.slice(lo, hi - lo)
                texts = [t.lower() for t in part.column("text").to_pylist()]  # of bytes: A-Z only
                fp = np.array([xxhash.xxh3_64_intdigest(t) for t in texts], "uint64") >> np.uint64(1)
                out = {"fp": fp.view("int64"), "text_sha256": [hashlib.sha256(t).hexdigest() for t in texts]}
                yield columns(part, names, out | ({"norm": pa.array(texts, pa.binary())} if with_text else {}))
    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: str | None = None) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256, and `key` if a column of that
    name is given, which must tell rows apart.

    Nulls count as empty text; empty texts form one group. Exactly one row of a group is
    kept: one with its largest id, or any one if all its ids are null; among rows with that id
    the largest key decides. An empty table gives no rows; extra columns are ignored."""
    row = key or "_row"
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), *([key] if key else []), utf8(text_col).alias("text"))
    src = src if key else src.withColumn(row, F.monotonically_increasing_id())
    kinds = "fp bigint, text_sha256 string"
    # Thin rows are written once: the number of a row is the same for all that read them.
    thin = materialise(src.mapInArrow(_digests(["doc_id", row], False), f"doc_id bigint, `{row}` bigint, {kinds}"), "thin")
    n = thin.count()
    bits = max(4, int(np.ceil(np.log2(max(1, n) / 20_000 + 1))) + 1)
    counted = merge_filters(build_filters(thin.select("fp"), bits), bits)
    suspects = materialise(counted.where("n > 1"), "suspects")
    # Byte verification: only texts whose fingerprint was met again are grouped by their bytes.
    texts = src.select(F.xxhash64(row).alias("_deal"), "text").mapInArrow(_digests(["_deal"], True), f"_deal bigint, {kinds}, norm binary")
    same = skew_join(texts, suspects, ["fp"], "n", "_deal", n).groupBy("fp", "text_sha256", "norm").agg(F.count(F.lit(1)).alias("group_size"))
    groups = materialise(same.where("group_size > 1").select("text_sha256", "group_size"), "groups")
    best = skew_join(thin, groups, ["text_sha256"], "group_size", row, n).groupBy("text_sha256", "group_size").agg(F.max(F.struct("doc_id", row)).alias("_best"))
    out = skew_join(thin, materialise(best, "best"), ["text_sha256"], "group_size", row, n, "left")
    alone = F.col("group_size").isNull()
    return out.select("doc_id", *([key] if key else []), F.when(alone, F.col("doc_id")).otherwise(F.col("_best.doc_id")).alias("keep_id"),
                      F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"), (alone | (F.col(row) == F.col(f"_best.{row}"))).alias("kept"), "text_sha256")


def op2_exact_dedup(spark, sf_dir):
    """Every document with its group of equal texts; edge cases as in `exact_dedup`."""
    from .common import table

    return exact_dedup(table(spark, sf_dir, "documents"))


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL = f"""
WITH d AS (SELECT doc_id, {LOWER} AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)"""
