"""Texts to token ids, piece by piece of the byte-level BPE pattern, where equal pieces are encoded once.

For texts of plain characters (`common.plain`) the pieces are found with array operations over all texts of a slice at
once and grouped by a 64-bit hash. All pieces of a group are compared with its first one, byte by byte; should any differ, the
slice's texts take the way of other texts, which the caller gives. Distinct pieces are looked up by their bytes, and only new ones
go to the encoder.
"""

from __future__ import annotations

import unicodedata
from array import array
from collections.abc import Callable
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa

from . import common

_L, _N, _O, _S = range(4)
_CLASS = np.full(256, _O, np.uint8)
for _c in range(256):
    _kind = unicodedata.category(chr(_c))[0]
    _CLASS[_c] = _S if _c in (9, 10, 13, 32) else _L if _kind == "L" else _N if _kind == "N" else _O


def boundaries(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Where pieces start in Latin-1 bytes of plain texts, as the pattern
    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+ has them; off: the texts' offsets."""
    n = len(raw)
    if not n:
        return np.zeros(0, np.int64)
    kind = _CLASS[raw]
    begins = np.zeros(n + 1, bool)
    begins[off[:-1]] = True
    cut = begins[:n].copy()
    cut[1:] |= kind[1:] != kind[:-1]
    # White space before something else: its last character goes with that if it is a space, else stands alone.
    after = np.flatnonzero(cut[1:] & (kind[:-1] == _S) & (kind[1:] != _S) & ~begins[1:n]) + 1
    cut[after - 1] = True
    cut[after[raw[after - 1] == 32]] = False
    # Contractions: an apostrophe that starts a piece, and letters after it in the same text.
    at = np.flatnonzero((raw[:-1] == 39) & cut[:-1] & (kind[1:] == _L) & ~begins[1:n])
    one, two = raw[at + 1], np.where(begins[np.minimum(at + 2, n)], 0, raw[np.minimum(at + 2, n - 1)])
    single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    double = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
    double &= at + 2 < n
    for where, size in ((at[single], 1), (at[double], 2)):
        cut[where + 1] = False
        rest = where + 1 + size
        cut[rest[rest < n]] = True
    return np.flatnonzero(cut)


def alike(raw: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray) -> bool:
    """Whether each piece has the same bytes as the piece whose number `other` gives."""
    size = end - start
    if not np.array_equal(size, size[other]):
        return False
    at = common.eights(raw)
    differ = other != np.arange(len(other))
    live = np.flatnonzero(differ & (size <= common.LONG))
    for done in range(0, common.LONG, 8):
        if not len(live):
            break
        left = size[live] - done
        if ((at[start[live] + done] ^ at[start[other[live]] + done]) & common._FIRST[np.minimum(left, 8)]).any():
            return False
        live = live[left > 8]
    return all(np.array_equal(raw[start[i] : end[i]], raw[start[other[i]] : end[other[i]]]) for i in np.flatnonzero(differ & (size > common.LONG)).tolist())


class PieceEncoder:
    """new: ids of each of many pieces; odd: ids of each of many texts that are not plain; special: substrings that make a text odd."""

    #: Memory for known pieces; beyond it the older half of them goes.
    KEEP_BYTES = 160 << 20

    def __init__(self, new: Callable[[list[str]], list[list[int]]], odd: Callable[[list[str]], list[np.ndarray]], special: tuple[str, ...] = (), keep_bytes: int = KEEP_BYTES):
        self.new, self.odd, self.special, self.keep_bytes = new, odd, special, keep_bytes
        self.known: dict[bytes, bytes] = {}
        self.held = 0

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (uint32) of each text."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain, body, odd = [], [], []
        for i, x in enumerate(texts):
            raw = None if any(s in x for s in self.special) else common.plain(x)
            if raw is None:
                odd.append(i)
            else:
                plain.append(i)
                body.append(raw)
        for i, ids in zip(odd, self.odd([texts[i] for i in odd]), strict=True):
            out[i] = ids
        off = np.concatenate([[0], np.cumsum([len(x) for x in body])]).astype(np.int64)
        raw = np.frombuffer(b"".join(body), np.uint8)
        # An empty text has no first byte of its own.
        start = boundaries(raw, off[:-1][np.diff(off) > 0].tolist() + [len(raw)] if len(raw) else off)
        end = np.append(start[1:], len(raw)) if len(start) else start
        back = pa.array(common.word_hashes(raw, start, end, lower=False)).dictionary_encode().indices.to_numpy()
        first = np.zeros(int(back.max(initial=-1)) + 1, np.int64)
        first[back[::-1]] = np.arange(len(back) - 1, -1, -1)
        if not alike(raw, start, end, first[back]):
            for i, ids in zip(plain, self.odd([texts[i] for i in plain]), strict=True):
                out[i] = ids
            return out
        if self.held > self.keep_bytes:
            old = list(islice(self.known.items(), len(self.known) // 2))
            for k, ids in old:
                del self.known[k]
                self.held -= len(ids) + len(k) + 200
        whole = raw.tobytes()
        keys = [whole[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
        got = list(map(self.known.get, keys))
        lack = [i for i, x in enumerate(got) if x is None]
        if lack:
            ids = self.new([keys[i].decode("latin-1") for i in lack])
            at = [0, *accumulate(map(len, ids))]
            body = array("I", chain.from_iterable(ids)).tobytes()
            self.held += len(body) + sum(len(keys[i]) for i in lack) + 200 * len(lack)
            for i, a, b in zip(lack, at, at[1:]):
                got[i] = self.known[keys[i]] = body[4 * a : 4 * b]
        size = np.fromiter(map(len, got), np.int64, len(got)) // 4
        ids = np.frombuffer(b"".join(got), "<u4")
        src, n = (np.cumsum(size) - size)[back], size[back]
        to = np.cumsum(n)
        ids = ids[np.arange(to[-1] if len(to) else 0) + np.repeat(src - to + n, n)]
        upto = np.concatenate([[0], to])[np.searchsorted(start, off)]
        for k, i in enumerate(plain):
            out[i] = ids[upto[k] : upto[k + 1]]
        return out
