"""Hashes of words and of word runs, over batches of texts at once with numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SPACE = np.zeros(256, dtype=bool)  # white space of the contracts: 20, 09-0D
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_LETTER = np.ones(256, dtype=bool)  # all ASCII but a-z
NOT_LETTER[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = False

CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)
_SYMBOL = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.random.default_rng(8).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def range_bucket(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """Buckets by range, so that sorted hashes have sorted buckets."""
    return ((hashes >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2^64."""
    if len(_powers[0]) <= n:
        for k, base in ((0, _BASE), (1, _BASE_INV)):
            p = np.full(n + 1, base, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def chunks(texts: Iterable[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, texts) in runs of about ``most`` bytes."""
    part, first, size = [], 0, 0
    for i, t in enumerate(texts):
        if part and size + len(t) > most:
            yield first, part
            part, first, size = [], i, 0
        part.append(t)
        size += len(t)
    if part:
        yield first, part


class Rolling:
    """Hashes of runs of bytes, by differences of one running sum."""

    def __init__(self, data: bytes):
        buf = np.frombuffer(data, dtype=np.uint8)
        pw, self._inv = _power(len(buf) + 1)
        self._sum = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(_SYMBOL[buf] * pw[:len(buf)], out=self._sum[1:])

    def all(self, n: int) -> np.ndarray:
        """Of the n bytes from each place on."""
        s = self._sum
        return mix64((s[n:] - s[:len(s) - n]) * self._inv[:max(0, len(s) - n)])

    def at(self, start: np.ndarray, n: int) -> np.ndarray:
        return mix64((self._sum[start + n] - self._sum[start]) * self._inv[start])


class Words:
    """Words of some texts: ``doc`` (index of the text), and hashes of a word or
    of its first bytes. Separators are the bytes of ``gap``."""

    def __init__(self, texts: list[bytes], gap: np.ndarray = SPACE):
        buf = np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)
        is_gap = gap[buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], is_gap, [True])).view(np.int8)))
        self.start, self.end = edge[::2], edge[1::2]
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.doc = np.searchsorted(ends, self.start, side="right")
        self.n_docs = len(texts)
        pw, self._inv = _power(len(buf) + 1)
        self._sum = np.zeros(len(buf) + 1, dtype=np.uint64)
        np.cumsum(_SYMBOL[buf] * pw[:len(buf)], out=self._sum[1:])

    def hashes(self, first_bytes: int | None = None) -> np.ndarray:
        end = self.end if first_bytes is None else np.minimum(self.end, self.start + first_bytes)
        h = (self._sum[end] - self._sum[self.start]) * self._inv[self.start]
        return mix64(h + (end - self.start).astype(np.uint64) * _STEP[63])


def shingles(words: Words, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(doc, hash) of the distinct runs of ``width`` words of each text, sorted
    by doc and hash; a text of fewer words gives its whole sequence."""
    h, doc = words.hashes(), words.doc
    n = len(h)
    count = np.bincount(doc, minlength=words.n_docs)
    acc = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        acc[:n - k] += h[k:] * _STEP[k] if n > k else np.uint64(0)
    first = np.cumsum(count) - count
    at = np.arange(n) - first[doc]
    full = at + width <= count[doc]
    out_doc, out = doc[full], mix64(acc[full] + np.uint64(width))
    short = np.flatnonzero((count > 0) & (count < width))
    if len(short):
        own = np.flatnonzero((count < width)[doc])
        part = np.zeros(words.n_docs, dtype=np.uint64)
        np.add.at(part, doc[own], h[own] * _STEP[at[own]])
        out_doc = np.concatenate([out_doc, short])
        out = np.concatenate([out, mix64(part[short] + count[short].astype(np.uint64))])
    order = np.lexsort((out, out_doc))
    out_doc, out = out_doc[order], out[order]
    new = np.ones(len(out), dtype=bool)
    new[1:] = (out[1:] != out[:-1]) | (out_doc[1:] != out_doc[:-1])
    return out_doc[new], out[new]
