"""Texts that an operator need not move stay out of its shuffles."""

import pytest

from evenline.llm import repeats as R

PASSAGE = " ".join(f"p{k}" for k in range(25))
ROWS = [(n, " ".join(f"w{n}_{k}" for k in range(30))) for n in range(200)] + [(1000 + n, f"own{n} {PASSAGE} end{n}") for n in range(5)] + [(2000, PASSAGE), (2001, PASSAGE), (None, PASSAGE), (2002, None)]


@pytest.mark.parametrize("most", [64, R.MAX_LISTED_CELLS])
def test_texts_without_a_repeat_are_not_moved(spark, most):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    changed = {1001, 1002, 1003, 1004, 2000, 2001}
    kept, moved = R.split_listed(docs, spark.createDataFrame([(x,) for x in changed], "doc_id long"), most)
    kept, moved = ([r["doc_id"] for r in d.collect()] for d in (kept, moved))
    assert sorted(kept + moved, key=str) == sorted((r[0] for r in ROWS), key=str)
    assert changed <= set(moved) and len(moved) < len(ROWS) / 2
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in R.remove_repeats(docs, max_listed_cells=most).collect()}
    for x, text in ROWS:
        words = (text or "").split()
        left = [] if x in (2000, 2001) else [words[0], words[-1]] if x in changed else words
        assert got[x] == (len(words), len(words) - len(left), " ".join(left))


def test_no_change_moves_no_text(spark):
    docs = spark.createDataFrame(ROWS[:5], "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in R.remove_repeats(docs).collect()} == dict(ROWS[:5])
    kept, moved = R.split_listed(docs, docs.where("doc_id < 0"))
    assert (kept.count(), moved.count()) == (5, 0)
