"""Words of an Arrow text column as numpy arrays.

A word is a run of bytes outside ``\\x20`` and ``\\x09-\\x0D``; those bytes never
occur inside a longer UTF-8 sequence, so splitting the raw bytes equals
splitting the decoded text. Everything here works on whole Arrow batches cut
into blocks of at most ``BLOCK_BYTES`` (a longer text is a block of its own).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
HASH_BYTES = 1 << 18  # hashed at once: the powers and sums of a window are 64 times its bytes
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32
_M = 0x9E3779B97F4A7C15
_M_INV = pow(_M, -1, 1 << 64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (xor-shift and multiply)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(HASH_BYTES, n).bit_length()
    if size not in _POWERS:
        _POWERS.clear()

        def run(base: int) -> np.ndarray:
            p = np.full(size, base, np.uint64)
            p[0] = 1
            return np.cumprod(p)  # wraps modulo 2**64
        _POWERS[size] = (run(_M), run(_M_INV))
    return _POWERS[size]


@dataclass
class Block:
    """Documents ``first .. first + n_docs - 1`` of a batch."""
    first: int
    n_docs: int
    data: np.ndarray       # uint8, all texts of the block end to end
    offsets: np.ndarray    # int64, n_docs + 1 byte offsets into data
    start: np.ndarray      # int64 per word
    end: np.ndarray
    doc: np.ndarray        # int64 per word, index inside the block
    word_offsets: np.ndarray  # int64, n_docs + 1: words of a document are contiguous

    @property
    def n_words(self) -> np.ndarray:
        return np.diff(self.word_offsets)

    def hashes(self, seed: int = 0, ends: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash per word, or per word up to ``ends`` (polynomial in its bytes, then mixed with its length)."""
        out = np.empty(len(self.start), np.uint64)
        stop = self.end if ends is None else ends
        a = 0
        while a < len(out):
            base = self.start[a]
            b = max(a + 1, int(np.searchsorted(self.end, base + HASH_BYTES, "right")))
            lo, hi = int(base), int(self.end[b - 1])
            p, q = _powers(hi - lo)
            c = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum((self.data[lo:hi].astype(np.uint64) + np.uint64(1)) * p[:hi - lo], out=c[1:])
            s, e = self.start[a:b] - lo, stop[a:b] - lo
            out[a:b] = (c[e] - c[s]) * q[s] ^ ((e - s).astype(np.uint64) << np.uint64(48))
            a = b
        return mix64(out ^ np.uint64(seed))

    def words(self) -> list[bytes]:
        """The words themselves."""
        raw = self.data.tobytes()
        return [raw[s:e] for s, e in zip(self.start.tolist(), self.end.tolist())]


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    return _LOWER[data]


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    off = np.frombuffer(off, np.int64 if wide else np.int32, len(col) + 1 + col.offset)[col.offset:] if off else np.zeros(1)
    return (np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)), off.astype(np.int64)


def blocks(col: pa.Array, lower: bool = False, block_bytes: int = BLOCK_BYTES, space: np.ndarray = _SPACE) -> Iterator[Block]:
    """Cut a text column into blocks and find their words; ``lower`` maps A-Z to
    a-z first, ``space`` marks the bytes that part words."""
    data, off = text_buffers(col)
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + block_bytes, "right")) - 1)
        d = data[off[a]:off[b]]
        if lower:
            d = _LOWER[d]
        o = off[a:b + 1] - off[a]
        inner = ~space[d]
        edge = np.zeros(len(d) + 1, bool)
        edge[o] = True  # a document's bounds end words
        edge[0] = True
        before = np.concatenate(([False], inner[:-1])) if len(d) else inner
        start = np.flatnonzero(inner & (~before | edge[:-1]))
        after = np.concatenate((inner[1:], [False])) if len(d) else inner
        end = np.flatnonzero(inner & (~after | edge[1:])) + 1
        wo = np.searchsorted(start, o, "left")
        doc = np.repeat(np.arange(b - a), np.diff(wo))
        yield Block(a, b - a, d, o, start, end, doc, wo)
        a = b


def rolling(h: np.ndarray, width: int, odd: int) -> np.ndarray:
    """Order-sensitive hash of every ``width`` consecutive words (``len(h) - width + 1`` values)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    f = 1
    for j in range(width):
        out += h[j:j + n] * np.uint64(f)
        f = f * odd % (1 << 64)
    return mix64(out)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Concatenation of ``range(s, s + c)`` for every pair."""
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts, counts) + np.repeat(starts, counts)
