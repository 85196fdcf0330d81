"""Operator 12 against a search over all edits of short conversations, and against itself in small pieces for long ones."""

import hashlib
import heapq
import random
import re
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from evenline.llm import queries as Q
from evenline.llm import turns as T

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
STATES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def damage(rows):
    out = []
    for c, t, r, x in rows:
        r, x = " " if r is None else r, " " if x is None else x
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if h == 1 else re.sub("[.!?]", "", x) if h == 2 else x
        out += [(c, t, "user" if h == 4 else r, x)] * {0: 0, 3: 2}.get(h, 1)
    return out


def cheapest(rows):
    """rows: (role, text, fault). Dijkstra over (cost, audit): the first goal popped is the cheapest, ASCII-least one."""
    heap, seen = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, k, q, out = heapq.heappop(heap)
        if k == len(rows) and q in (0, 3):
            return cost, audit, out
        if (k, q) in seen:
            continue
        seen.add((k, q))
        for role in ("user", "assistant"):
            if role[0] in STATES[q]:
                heapq.heappush(heap, (cost + 3, audit + "I", k, STATES[q][role[0]], out + ((role, ""),)))
        if k == len(rows):
            continue
        role, text, fault = rows[k]
        heapq.heappush(heap, (cost + 4, audit + "D", k + 1, q, out))
        if fault not in ("blank", "duplicate"):
            late = 3 if fault == "truncated" else 0
            if role[:1] in STATES[q]:
                heapq.heappush(heap, (cost + late, audit + "K", k + 1, STATES[q][role[:1]], out + ((role, text),)))
            for new in ("user", "assistant"):
                if new[0] in STATES[q]:
                    heapq.heappush(heap, (cost + 3 + late, audit + "R", k + 1, STATES[q][new[0]], out + ((new, text),)))


def plain(rows):
    ids = {c for c, *_ in rows}
    rows = damage(rows)
    out = {}
    for c in ids:
        mine = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1] is not None, x[1] or 0, x[2], hashlib.md5(f"{x[2]}\0{x[3]}".encode()).hexdigest()))
        turns = [x[1] for x in mine if x[1] is not None]
        found, seen = [], set()
        for _, _, role, text in mine:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            found.append((role, text, fault))
        cost, audit, kept = cheapest(found)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(found, found[1:]))
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[sum(f == k for *_, f in found) for k in ("blank", "duplicate", "truncated")],
                  illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())
    return out


def conversations(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(n), None]:
        for t in range(rnd.choice([0, 1, 2, 3, 6, 9])):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "Assistant", None])
            text = rnd.choice(["Yes.", "No!", "Why?  \n", "so it", "and \t", "", " \n", None, f"word {rnd.randrange(4)}."])
            rows += [(c, rnd.choice([t, t, t, t + 1, None, 40]), role, text)] * rnd.choice([1, 1, 1, 1, 2, 5])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def run(spark, path, rows):
    cols = list(zip(*rows)) if rows else [()] * 4
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
    odd = {k: pa.array([1] * len(rows), pa.int64()) for k in ("block", "step", "place", "times", "rows", "digest", "first")}
    pq.write_table(pa.table({k: pa.array(c, t) for k, c, t in zip(("conv_id", "turn", "role", "text"), cols, kinds)} | odd), f"{path}/conversations.parquet")
    df = Q.op12_conversation_repair(spark, str(path))
    assert df.columns == NAMES
    got = df.collect()
    assert len({r[0] for r in got}) == len(got)
    return {r[0]: tuple(r)[1:] for r in got}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_short_conversations(spark, tmp_path, seed):
    rows = conversations(seed)
    assert run(spark, tmp_path, rows) == plain(rows)


@pytest.mark.parametrize("block, fan", [(1, 2), (3, 2), (4, 1024)])
def test_conversations_of_many_segments(spark, tmp_path, monkeypatch, block, fan):
    """Segments and tree nodes of a few rows: long conversations are solved over several levels."""
    monkeypatch.setattr(T, "BLOCK", block)
    monkeypatch.setattr(T, "FAN", fan)
    monkeypatch.setattr(T, "CHUNK", 7)
    rnd = random.Random(7)
    rows = conversations(4, 12)
    rows += [(100, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Yes.", "no", f"word {t}."])) for t in range(40)]
    rows += [(101, None, "user", "copy.")] * 30
    assert run(spark, tmp_path, rows) == plain(rows)


def test_nothing_left_and_empty_tables(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, tmp_path, [(gone, 0, "user", "Hello.")])[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    empty = tmp_path / "empty"
    empty.mkdir()
    assert run(spark, empty, []) == {}


def test_very_long_text(spark, tmp_path):
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", " " * 100_000), (1, 2, "assistant", "x" * 300_000)]
    assert run(spark, tmp_path, rows) == plain(rows)


def test_ranks_by_doubling_give_the_least_of_all_cheapest_audits(spark):
    """Every audit of the least cost by enumeration, for all conversations of three rows."""
    import itertools

    import numpy as np
    for codes in itertools.product([1, 2, 3, 0, 4 + 2, 8 + 3], repeat=3):
        s = T.Segments(np.array(codes), np.ones(3, np.int64), np.array([3]))
        length, _, label, _ = s.least_paths(T.CLOSED[None, :], np.zeros(1, np.int64), np.ones(1, bool))
        role = {0: "x", 1: "s", 2: "u", 3: "a"}
        want = cheapest([(role[c & 3], str(k), "blank" if c & 4 else "truncated" if c & 8 else "") for k, c in enumerate(codes)])
        assert "".join(T.LABELS[k] for k in label) == want[1], codes
