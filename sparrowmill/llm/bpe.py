"""Byte-level BPE by backtracking, decoding by an offset table.

One Aho-Corasick pass over a piece gives the longest token from each position. It is tried
first and stands if the table of compatible pairs says that merging would keep it apart from
the token before. Otherwise the next shorter prefix of the token is tried, and if none fits
the last token is taken back. Each position fails at most once, so the work is linear in the
text and equals the merges. Ids are decoded a run at a time by gathering from an offset table.
"""

from __future__ import annotations

import hashlib
import json
from array import array

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import utf8
from .scan import columns, runs

# The split pattern of the vocabulary, with white space as Unicode defines it.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
#: Bounds of a worker's memory: pieces whose ids are remembered, their characters, and pairs in the table.
MEMO, MEMO_CHARS, PAIRS = 300_000, 64, 2_000_000


def byte_alphabet() -> dict[int, str]:
    """Printable stand-ins of the 256 bytes: those outside the printable Latin ranges move to 256 and up, in order."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in keep]
    return {b: chr(b) for b in keep} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder for one tokenizer file; made once per Python worker."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        back = {c: b for b, c in byte_alphabet().items()}
        raw = {i: bytes(back[c] for c in t) for t, i in vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.by_bytes = {b: i for i, b in raw.items()}
        # Rank: order of creation; single bytes before all merges.
        self.rank = {i: -1 for i in raw}
        self.parts = {i: (i, i) for i in raw}
        self.pairs = {}
        for r, (a, b) in enumerate(merges):
            i = vocab[a + b]
            self.rank[i], self.parts[i] = r, (vocab[a], vocab[b])
            self.pairs[vocab[a], vocab[b]] = r
        self.size = {i: len(b) for i, b in raw.items()}
        self.tokens = ahocorasick.Automaton()
        for i, b in raw.items():
            self.tokens.add_word(b.decode("latin-1"), i)
        self.tokens.make_automaton()
        self.prefix: dict[int, int | None] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.memo = _Memo(self)
        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        # Offset table: token i's bytes are blob[offset[i]:offset[i+1]].
        for t, i in self.special.items():
            raw.setdefault(i, t.encode())
        n = max(raw) + 1
        self.offset = np.r_[0, np.cumsum([len(raw.get(i, b"")) for i in range(n)])]
        self.blob = np.frombuffer(b"".join(raw.get(i, b"") for i in range(n)), "uint8")

    def _longest(self, s: str) -> list[int | None]:
        """Longest token from each position: later ends of one start overwrite earlier ones."""
        out: list[int | None] = [None] * len(s)
        size = self.size
        for end, i in self.tokens.iter(s):
            out[end + 1 - size[i]] = i
        return out

    def _next_shorter(self, i: int) -> int | None:
        """Longest token that is a proper prefix of token i."""
        if i not in self.prefix:
            s = self.blob[self.offset[i]:self.offset[i + 1]].tobytes().decode("latin-1")
            self.prefix[i] = next((k for n in range(len(s) - 1, 0, -1) if (k := self.tokens.get(s[:n], None)) is not None), None)
        return self.prefix[i]

    def compatible(self, a: int, b: int) -> bool:
        """Whether BPE leaves tokens a and b side by side: no merge across their border
        comes before the merges that make the pieces next to the border. Kept in a table."""
        if len(self.fits) > PAIRS:
            self.fits.clear()
        known = self.fits[a, b] = self._compatible(a, b)
        return known

    def _compatible(self, a: int, b: int) -> bool:
        left, right, limit = a, b, float("inf")  # limit: when the piece that holds the border's neighbour is made
        while True:
            r = self.pairs.get((left, right))
            if r is not None and r < limit:
                return False
            # Go back in time: undo the younger of both border pieces. On a tie of equal merges the left one is made first.
            ra, rb = self.rank[left], self.rank[right]
            if ra < 0 and rb < 0:
                return True
            if ra > rb:
                limit, left = ra, self.parts[left][1]
            else:
                limit, right = rb + 0.5, self.parts[right][0]

    def piece(self, s: str) -> list[int]:
        """Ids of one piece, whose bytes are the characters of `s`."""
        n, size, fits = len(s), self.size, self.fits
        longest = self._longest(s)
        token = longest[0]
        if size[token] == n:
            return [token]
        out, at, last, open_ = [], 0, -1, bytearray(b"\1") * (n + 1)
        while True:
            while token is not None:
                end = at + size[token]
                if open_[end]:
                    ok = last < 0 or fits.get((last, token))
                    if ok is None:
                        ok = self.compatible(last, token)
                    if ok:
                        break
                token = self._next_shorter(token)
            if token is None:  # nothing fits here: take the last token back and try its shorter prefixes
                open_[at] = 0
                token = out.pop()
                at -= size[token]
                last = out[-1] if out else -1
                token = self._next_shorter(token)
                continue
            out.append(token)
            if end == n:
                return out
            at, last, token = end, token, longest[end]

    def pieces(self, text: str) -> list[str]:
        """Pieces that are encoded by themselves; special tokens come with a mark in front."""
        if self.cut is None:
            return self.split.findall(text)
        out: list[str] = []
        for part in self.cut.split(text):
            out += [SPECIAL + part] if part in self.special else self.split.findall(part)
        return out

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as 32-bit integers, and as decimals joined by commas."""
        found = list(map(self.memo.__getitem__, self.pieces(text)))
        self.memo.trim()
        return b"".join([f[0] for f in found]), "".join([f[1] for f in found])[1:]

    def decode(self, ids: np.ndarray, counts: list[int]) -> list[bytes]:
        """Bytes of consecutive texts, of `counts` ids each."""
        start = self.offset[ids]
        size = self.offset[ids + 1] - start
        behind = np.cumsum(size)
        flat = self.blob[np.repeat(start - behind + size, size) + np.arange(behind[-1] if len(ids) else 0)].tobytes()
        cut = np.r_[0, behind][np.cumsum([0, *counts])]
        return [flat[a:b].decode("utf-8", "replace").encode() for a, b in zip(cut[:-1], cut[1:])]


#: No text holds a lone surrogate, so no piece starts with this.
SPECIAL = "\ud800"


class _Memo(dict):
    """Piece -> its ids as bytes and as decimals with a comma before each."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec, self.older = codec, {}

    def __missing__(self, w: str):
        out = self.older.get(w)
        if out is None:
            ids = [self.codec.special[w[1:]]] if w[0] == SPECIAL else self.codec.piece(w.encode().decode("latin-1"))
            out = array("i", ids).tobytes(), "," + ",".join(map(str, ids))
        if len(w) < MEMO_CHARS:
            self[w] = out
        return out

    def trim(self):
        """Pieces met since the last but one trim stay."""
        if len(self) > MEMO:
            self.older = dict(self)
            self.clear()


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_decode(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded when asked).

    Null counts as empty text, which has no tokens; very long texts are one row each;
    repeated rows are encoded again; an empty table gives none; extra columns are ignored."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if keep_ids else "")

    def run(batches):
        c = codec(path)
        for b in batches:
            for lo, hi in runs(b.column("text")):
                part = b.slice(lo, hi - lo)
                coded = [c.encode(t.decode()) for t in part.column("text").to_pylist()]
                n = [len(x) // 4 for x, _ in coded]
                back = c.decode(np.frombuffer(b"".join([x for x, _ in coded]), "int32"), n)
                out = {"n_tokens": pa.array(n, pa.int64()), "ids_sha256": [hashlib.sha256(d.encode()).hexdigest() for _, d in coded], "decoded_sha256": [hashlib.sha256(x).hexdigest() for x in back]}
                if keep_ids:
                    out |= {"ids": pa.array([np.frombuffer(x, "int32") for x, _ in coded], pa.list_(pa.int32())), "decoded": pa.array([x.decode() for x in back], pa.string())}
                yield columns(part, ["doc_id"], out)

    return docs.select("doc_id", utf8()).mapInArrow(run, schema)


def op6_bpe(spark, sf_dir):
    """Every document encoded and decoded; edge cases as in `encode_decode`."""
    import public_tokenizers

    from .common import table

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
