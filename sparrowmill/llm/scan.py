"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

Texts reach Python as Arrow binary columns and are looked at in runs of bounded bytes, so
memory does not grow with a batch. A word's hash is that of its bytes alone.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

RUN_BYTES = 2_000_000
_P = 0x9E3779B97F4A7C15
_PINV = pow(_P, -1, 2**64)

#: Bytes of words. Any byte of a code point beyond ASCII is above 0x7F, so both classes can be read off bytes.
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
GRAPH = np.ones(256, bool)
GRAPH[[0x20, *range(0x09, 0x0E)]] = False


@functools.lru_cache(maxsize=2)
def _table(n: int):
    up, down = np.full(n, _P, "uint64"), np.full(n, _PINV, "uint64")
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int):
    """Powers of the base and of its inverse, modulo 2^64; tables are made for powers of two."""
    up, down = _table(1 << max(20, int(n - 1).bit_length()))
    return up[:n], down[:n]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


@dataclass
class Words:
    """Words of `n` texts in order: text number, first byte, byte behind the last, hash;
    `first[k]:first[k + 1]` are the words of text k. `raw` holds all lower-cased bytes, those of
    text k from `begin[k]` on."""

    raw: bytes
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray
    begin: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]


def scan(texts: list[bytes], table: np.ndarray = ALNUM) -> Words:
    """Words of texts, A-Z lower-cased."""
    raw = b" " + b" ".join(texts) + b" "
    raw = raw.lower()  # of bytes: A-Z only
    data = np.frombuffer(raw, "uint8")
    edge = np.diff(table[data].view("int8"))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    up, down = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, "uint64")
    sums[0] = 0
    np.cumsum((data + np.uint64(1)) * up[:-1], out=sums[1:])
    h = mix((sums[end] - sums[start]) * down[start])
    begin = np.cumsum([1] + [len(t) + 1 for t in texts])
    return Words(raw, start, end, h, np.searchsorted(start, begin), begin)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each word on, where n are left."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, "uint64")
    out = np.zeros(m, "uint64")
    for j in range(n):
        out = out * np.uint64(_P) + h[j:j + m]
    return mix(out)


def runs(texts: pa.Array, limit: int = RUN_BYTES):
    """Row ranges whose texts have about `limit` bytes, one row at least."""
    size = np.cumsum(np.asarray(pc.binary_length(texts).fill_null(0), "int64"))
    lo = 0
    while lo < len(size):
        done = size[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(size, done + limit, "right")))
        yield lo, hi
        lo = hi


def columns(batch: pa.RecordBatch, names, extra: dict[str, pa.Array | list]) -> pa.RecordBatch:
    """Columns of `batch` handed on as they are, so that no id goes through a float, and new ones."""
    cols = {c: batch.column(c) for c in names} | {k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in extra.items()}
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def words(text: str | None) -> list[str]:
    """Words of one text."""
    w = scan([(text or "").encode()])
    return [w.word(i).decode() for i in range(len(w.hash))]
