"""Plain versions of the operators' contracts, for small tables."""

import hashlib
import zlib


def words(t):
    return (t or "").encode().split()  # splits at \x20 and \x09-\x0D alone


def lower(t):
    return [w.lower() for w in words(t)]


def remainder(i, m):
    return zlib.crc32(str(i).encode()) % m


def removed(rows, width=20):
    seen, out = set(), {}
    for i, t in sorted((r[0], r[1]) for r in rows):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            key = tuple(w[k:k + width])
            if key in seen:
                gone[k:k + width] = [True] * width
            seen.add(key)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


def shingles(t, n=5):
    w = lower(t)
    if not w:
        return set()
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)}


def components(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(ids[a]), find(ids[b])
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def targets(sizes):
    """source -> target by repeated resharing; sizes: source -> words."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: k % 3 + 1 for k, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**fixed, **share}
        fixed.update({s: 3.0 * sizes[s] for s in over})


def slack(lengths, target):
    """How far the best choice of whole copies plus a subset must stay from a
    target, plus the shortest document (a plan may fix proportional shares first)."""
    total = sum(lengths)
    full = min(3, int(target // total)) if total else 0
    sums = {0}
    if full < 3:
        for x in lengths:
            sums |= {s + x for s in sums}
    best = min(abs(full * total + s - target) for s in sums)
    return best + max(1, min((x for x in lengths if x), default=1))
