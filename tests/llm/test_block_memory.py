"""What a worker holds for a block of text does not depend on the size of its batch."""

import tracemalloc

import numpy as np
import pyarrow as pa

from evenline.llm import words


def test_hashing_a_large_batch_holds_little_memory(monkeypatch):
    texts = pa.array([" ".join(f"w{n}x{k}" for k in range(600)) for n in range(1200)])
    monkeypatch.setattr(words, "_POWERS", {})
    tracemalloc.start()
    got = [b.hashes() for b in words.blocks(texts)]
    held = sum(h.nbytes for h in got)
    peak = tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    assert peak < 64 << 20, f"{peak >> 20} MB"
    monkeypatch.setattr(words, "HASH_BYTES", 1 << 20)
    whole = [b.hashes() for b in words.blocks(texts, block_bytes=16 << 20)]
    assert np.array_equal(np.concatenate(got), np.concatenate(whole))
