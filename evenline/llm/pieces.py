"""A subword vocabulary as a lattice over words: batched forward and backward recursions.

A word is a space byte and its bytes. Arcs are the vocabulary's pieces (its
word-start mark is the space) and every single byte. Words of one length are
one matrix; each (start, end) pair looks its substring's hash up for all of
them at once. Words above ``LONG`` bytes go through the same recursions in
stretches of ``STRETCH`` bytes: each starts from the columns that the longest
piece can reach back to, so no segmentation is lost and memory is bounded by
the stretch. The backward pass makes the forward columns of a stretch again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from evenline.llm.words import mix64

LONG = 64
STRETCH = 256
MANY = 512   # long words at once
MARK = "▁"
_M = 0x9E3779B97F4A7C15
_INV = pow(_M, -1, 1 << 64)
_SLOT_BITS = 22


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


_P, _Q = _powers(_M, LONG + 2), _powers(_INV, LONG + 2)


def _length_salt(n: int) -> np.uint64:
    return np.uint64((n & 255) << 56)


class HashTable:
    """64-bit key -> position, or -1: open slots by the key's high bits, keys that share a slot in a sorted rest."""

    def __init__(self, keys: np.ndarray, slot_bits: int = _SLOT_BITS):
        self.bits = np.uint64(64 - slot_bits)
        self.slot = np.full(1 << slot_bits, -1, np.int32)
        self.keys = keys
        at = (keys >> self.bits).astype(np.int64)
        order = np.arange(len(keys) - 1, -1, -1)
        self.slot[at[order]] = order  # the first key of a slot stays
        rest = np.flatnonzero(self.slot[at] != np.arange(len(keys)))
        rest = rest[np.argsort(keys[rest], kind="stable")]
        self.rest, self.rest_keys = rest.astype(np.int32), keys[rest]

    def find(self, h: np.ndarray) -> np.ndarray:
        at = self.slot[(h >> self.bits).astype(np.int64)]
        if not len(self.keys):
            return at
        hit = (at >= 0) & (self.keys[at] == h)
        out = np.where(hit, at, -1)
        if len(self.rest):
            miss = np.flatnonzero(~hit & (at >= 0))
            k = np.minimum(np.searchsorted(self.rest_keys, h[miss]), len(self.rest) - 1)
            out[miss] = np.where(self.rest_keys[k] == h[miss], self.rest[k], -1)
        return out


def load_pieces(model_file: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece file that words can use, then all single bytes
    not among them, and their scores as log-weights. Unigram scores are log
    probabilities already; a merge-ranked vocabulary scores by rank, which
    becomes Zipf's law over ranks."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    names, scores = [], []
    for i in range(sp.get_piece_size()):
        if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i) or sp.get_score(i) <= -1e8:
            continue
        raw = sp.id_to_piece(i).replace(MARK, " ").encode()
        if raw and b" " not in raw[1:]:
            names.append(raw)
            scores.append(sp.get_score(i))
    have = set(names)
    score = np.array(scores)
    ranked = len(score) > 0 and bool((score == np.round(score)).all())
    weight = -np.log(10.0 - score) if ranked else score
    rest = [bytes([c]) for c in range(256) if bytes([c]) not in have]
    floor = weight.min() - 2 if len(weight) else 0.0
    return names + rest, np.concatenate((weight, np.full(len(rest), floor)))


class Lattice:
    """Log-probabilities of words under piece weights: a column of ``weights`` per class, each summing to one."""

    def __init__(self, names: list[bytes], weights: np.ndarray):
        self.names, self.weights = names, weights.reshape(len(names), -1)
        self.longest = max(len(x) for x in names)
        self.inner = {len(x) for x in names if x[:1] != b" "}  # lengths of pieces that may start inside a word
        self.lengths = sorted(self.inner | {len(x) for x in names})
        self.p, self.q = _powers(_M, STRETCH + self.longest + 2), _powers(_INV, STRETCH + self.longest + 2)
        self.table = HashTable(piece_hashes(names))
        self.single = np.zeros(256, np.int64)
        for k, x in enumerate(names):
            if len(x) == 1:
                self.single[x[0]] = k

    def _arcs(self, x: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """``start, end, piece or -1`` for every pair of places in words of one length (rows of ``x``)."""
        n, length = x.shape
        c = np.zeros((length + 1, n), np.uint64)
        np.cumsum((x.T.astype(np.uint64) + np.uint64(1)) * _P[:length, None], axis=0, out=c[1:])
        every = set(self.lengths)
        for j in range(1, length + 1):
            for i in range(j):
                if j - i == 1:
                    yield i, j, self.single[x[:, i]]
                elif j - i in (self.inner if i else every):
                    yield i, j, self.table.find(mix64((c[j] - c[i]) * _Q[i] ^ _length_salt(j - i)))

    def _forward(self, x: np.ndarray, keep: list | None = None) -> np.ndarray:
        n, length = x.shape
        a = np.full((length + 1, n, self.weights.shape[1]), -np.inf)
        a[0] = 0.0
        for i, j, p in self._arcs(x):
            on = np.flatnonzero(p >= 0)
            if len(on):
                p = p[on]
                a[j, on] = np.logaddexp(a[j, on], a[i, on] + self.weights[p])
                if keep is not None:
                    keep.append((i, j, on, p))
        return a

    @staticmethod
    def _groups(words: list[bytes], chunk: int = 20_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``owner, matrix``: words of equal length up to ``LONG`` with their space, at most ``chunk`` at once."""
        by: dict[int, list[tuple[int, bytes]]] = {}
        for k, w in enumerate(words):
            if len(w) < LONG:
                by.setdefault(len(w) + 1, []).append((k, b" " + w))
        for length, items in by.items():
            for s in range(0, len(items), chunk):
                part = items[s:s + chunk]
                yield np.array([k for k, _ in part]), np.frombuffer(b"".join(w for _, w in part), np.uint8).reshape(len(part), length)

    @staticmethod
    def _long_groups(words: list[bytes], size: int = 1 << 22) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``owner, padded matrix, lengths``: the other words, longest first, about ``size`` bytes at once."""
        order = sorted((k for k, w in enumerate(words) if len(w) >= LONG), key=lambda k: -len(words[k]))
        while order:
            length = len(words[order[0]]) + 1
            part, order = order[:max(1, min(MANY, size // length))], order[max(1, min(MANY, size // length)):]
            x = np.frombuffer(b"".join((b" " + words[k]).ljust(length, b"\0") for k in part), np.uint8).reshape(len(part), length)
            yield np.array(part), x, np.array([len(words[k]) + 1 for k in part])

    def _long_arcs(self, x: np.ndarray, lo: int, hi: int) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """``start, end, rows, pieces`` with ends in ``lo + 1 .. hi``, by end."""
        base = max(0, lo + 1 - self.longest)
        c = np.zeros((hi - base + 1, len(x)), np.uint64)
        np.cumsum((x[:, base:hi].T.astype(np.uint64) + np.uint64(1)) * self.p[:hi - base, None], axis=0, out=c[1:])
        by_end: list[list] = [[] for _ in range(hi - lo)]
        for n in self.lengths:
            first, last = max(0, lo + 1 - n), hi - n if n in self.inner else min(0, hi - n)
            if first > last:
                continue
            if n == 1:
                p = self.single[x[:, first:last + 1].T]
            else:
                s = np.arange(first, last + 1) - base
                p = self.table.find(mix64(((c[s + n] - c[s]) * self.q[s, None]).ravel() ^ _length_salt(n))).reshape(len(s), len(x))
            at, on = np.nonzero(p >= 0)
            p = p[at, on]
            cut = np.flatnonzero(np.diff(at, prepend=-1))
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(at)]):
                i = first + int(at[a])
                by_end[i + n - lo - 1].append((i, i + n, on[a:b], p[a:b]))
        return [arc for arcs in by_end for arc in arcs]

    def _long_forward(self, x: np.ndarray, lengths: np.ndarray, weights: np.ndarray) -> Iterator[tuple]:
        """Per stretch: ``lo, hi, base``, the forward columns from place ``base`` as it starts (those up to ``lo``) and as it ends, and its arcs."""
        base, tail = 0, np.zeros((1, len(x), weights.shape[1]))
        for lo in range(0, x.shape[1], STRETCH):
            hi = min(x.shape[1], lo + STRETCH)
            tail = tail[:, :int((lengths > lo).sum())]
            a, arcs = self._stretch(x, lo, hi, base, tail, weights)
            yield lo, hi, base, tail, a, arcs
            new = max(0, hi - self.longest)
            base, tail = new, a[new - base:].copy()

    def _stretch(self, x: np.ndarray, lo: int, hi: int, base: int, tail: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, list]:
        a = np.full((hi - base + 1, *tail.shape[1:]), -np.inf)
        a[:len(tail)] = tail
        arcs = self._long_arcs(x[:tail.shape[1]], lo, hi)
        for i, j, on, p in arcs:
            a[j - base, on] = np.logaddexp(a[j - base, on], a[i - base, on] + weights[p])
        return a, arcs

    def log_probability(self, words: list[bytes]) -> np.ndarray:
        """Natural log of the sum over all segmentations, per word and class."""
        out = np.zeros((len(words), self.weights.shape[1]))
        for own, x in self._groups(words):
            out[own] = self._forward(x)[-1]
        for own, x, lengths in self._long_groups(words):
            for lo, hi, base, _, a, _ in self._long_forward(x, lengths, self.weights):
                ends = np.flatnonzero((lengths > lo) & (lengths <= hi))
                out[own[ends]] = a[lengths[ends] - base, ends]
        return out

    def expected_counts(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected uses of every piece (forward-backward under the first column's
        weights) over words seen ``counts`` times; counts may have a column per class."""
        counts = np.asarray(counts, float).reshape(len(words), -1)
        out = np.zeros((len(self.names), counts.shape[1]))
        for own, x in self._groups(words):
            arcs: list = []
            a = self._forward(x, arcs)[:, :, 0]
            w = self.weights[:, 0]
            b = np.full(a.shape, -np.inf)
            b[-1] = 0.0
            for i, j, on, p in reversed(arcs):  # ends descend, so b[j] is complete
                b[i, on] = np.logaddexp(b[i, on], b[j, on] + w[p])
            for i, j, on, p in arcs:
                share = np.exp(a[i, on] + w[p] + b[j, on] - a[-1, on])
                for c in range(counts.shape[1]):
                    out[:, c] += np.bincount(p, share * counts[own[on], c], len(out))
        w = self.weights[:, :1]
        for own, x, lengths in self._long_groups(words):
            starts, total = [], np.zeros(len(x))
            for lo, hi, base, tail, a, _ in self._long_forward(x, lengths, w):
                starts.append((lo, hi, base, tail))
                ends = np.flatnonzero((lengths > lo) & (lengths <= hi))
                total[ends] = a[lengths[ends] - base, ends, 0]
            later, carry = 0, np.zeros((0, 0))
            for lo, hi, base, tail in reversed(starts):
                a, arcs = self._stretch(x, lo, hi, base, tail, w)
                b = np.full(a.shape[:2], -np.inf)
                b[later - base:later - base + len(carry), :carry.shape[1]] = carry
                ends = np.flatnonzero((lengths > lo) & (lengths <= hi))
                b[lengths[ends] - base, ends] = 0.0
                used, rows, shares = [], [], []
                for i, j, on, p in reversed(arcs):
                    rest = b[j - base, on] + w[p, 0]
                    b[i - base, on] = np.logaddexp(b[i - base, on], rest)
                    used.append(p)
                    rows.append(own[on])
                    shares.append(np.exp(a[i - base, on, 0] + rest - total[on]))
                used, rows, shares = np.concatenate(used), np.concatenate(rows), np.concatenate(shares)
                for c in range(counts.shape[1]):
                    out[:, c] += np.bincount(used, shares * counts[rows, c], len(out))
                later, carry = base, b[:lo - base + 1]
        return out


def piece_hashes(names: list[bytes]) -> np.ndarray:
    out = np.empty(len(names), np.uint64)
    powers = _powers(_M, max(map(len, names), default=0) + 1)
    for k, x in enumerate(names):
        v = np.frombuffer(x, np.uint8).astype(np.uint64) + np.uint64(1)
        out[k] = (v * powers[:len(x)]).sum(dtype=np.uint64) ^ _length_salt(len(x))
    return mix64(out)
