"""Small tables with every awkward case: nulls, empty and long texts, repeated
rows, copies, near copies, shared passages, leaks, clashing extra columns."""

import os
import random
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(__file__))

VOWELS = {"en": ["the", "of", "er", "th", "ing", "on", "st"], "de": ["der", "ung", "sch", "en", "ä", "keit"], "fr": ["le", "eau", "é", "tion", "oi"]}


def word(rnd, lang, n=None):
    return "".join(rnd.choice(VOWELS[lang]) for _ in range(n or rnd.randint(1, 4)))


def prose(rnd, lang, n):
    out = []
    for k in range(n):
        w = word(rnd, lang)
        out.append(w + (rnd.choice([".", ",", ""]) if k % 9 == 8 else "") + ("\n" if k % 31 == 30 else ""))
    return " ".join(out)


def make_documents():
    rnd = random.Random(3)
    rows, labels = [], []
    passage = prose(rnd, "en", 60)
    leak = "Marta counts 12 km of road and 30 trees near Ulm while her brother holds seven lamps over the long wet bridge"
    for i in range(150):
        lang = ["en", "de", "fr"][i % 3]
        t = prose(rnd, lang, rnd.choice([3, 20, 60, 120, 300]))
        toxic = i % 5 == 0
        if toxic:
            t = t + " you " + rnd.choice(["idiot", "scum", "moron"]) + " and " + rnd.choice(["trash", "loser"]) + ". " + prose(rnd, lang, 10)
        if i % 11 == 3:
            t = t + " " + passage
        if i % 17 == 5:
            t = t + " and then " + leak + " so"
        rows.append((i, t, lang, ["a", "b", "c", "d", None][i % 5] if i % 2 else "a"))
        labels.append((i, 1, int(toxic)))
    base = rows[7][1] + " " + prose(rnd, "de", 200)
    for k in range(12):  # near copies
        w = base.split()
        w[(k * 13) % len(w)] = f"x{k}"
        rows.append((200 + k, " ".join(w), "de", "b"))
    for k in range(6):  # exact copies
        rows.append((300 + k, rows[40][1], "fr", "a"))
    rows += [(400, None, "en", "a"), (401, "", "en", None), (402, " \t\n ", None, "c"), (403, "one two three", "en", "a"), (404, "one two three", "en", "a"),
             (405, "ab " * 400, "en", "a"), (406, "1234 5678 !!", "de", "b"), (407, "x" * 70_000, "en", "c"), (408, prose(rnd, "en", 30_000), "en", "c"),
             (409, "tab\tsep\x0bvt\x0cff\r\nline end", "fr", "zz"), (410, "日本語 のテキスト ✓  nbsp", "en", "é"), (411, rows[2][1].upper(), "fr", "b"), (412, passage, "en", "a"),
             (413, leak.replace("12", "47").replace("30", "99").replace("Marta", "Sonia") + " again", "en", "a"),
             (414, leak.replace("12", "30"), "en", "d"), (415, "<|endoftext|> a<|ENDOFTEXT|>b it's THE Σίσυφος", "en", "d")]
    bench = [(0, leak), (1, prose(rnd, "fr", 30)), (2, None), (3, ""), (4, "tiny two"), (5, leak)]
    return rows, labels, bench


def write(path, rows, labels, bench, extra=True):
    os.makedirs(path, exist_ok=True)
    i, t, lang, s = (list(x) for x in zip(*rows)) if rows else ([], [], [], [])
    cols = {"doc_id": pa.array(i, pa.int64()), "text": pa.array(t, pa.string()), "lang": pa.array(lang, pa.string()), "source": pa.array(s, pa.string()), "n_chars": pa.array([len(x or "") for x in t], pa.int64())}
    if extra:  # names that operators use for columns of their own
        cols |= {k: pa.array([7] * len(i), pa.int64()) for k in ("score", "size", "n", "node", "h", "bucket", "target", "kept", "word", "class", "part", "root")}
    pq.write_table(pa.table(cols), f"{path}/documents.parquet")
    a, b, c = (list(x) for x in zip(*labels)) if labels else ([], [], [])
    pq.write_table(pa.table({"doc_id": pa.array(a, pa.int64()), "quality": pa.array(b, pa.int64()), "toxic": pa.array(c, pa.int64())}), f"{path}/labels.parquet")
    a, b = (list(x) for x in zip(*bench)) if bench else ([], [])
    pq.write_table(pa.table({"item_id": pa.array(a, pa.int64()), "text": pa.array(b, pa.string())}), f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="session")
def tables(tmp_path_factory):
    rows, labels, bench = make_documents()
    return write(str(tmp_path_factory.mktemp("tables")), rows, labels, bench), rows, labels, bench


@pytest.fixture(scope="session")
def odd_tables(tmp_path_factory):
    """Null ids and repeated rows, beside a few plain ones."""
    rows = [(1, "a b c d e f g h", "en", "a"), (1, "a b c d e f g h", "en", "a"), (1, "other words than the ones above here now", "en", "b"), (None, "a b c d e f g h", None, None),
            (None, None, "en", "a"), (2, None, None, None), (3, "a b c d e f g h", "de", None)]
    return write(str(tmp_path_factory.mktemp("odd")), rows, [(1, 1, 1), (1, 1, 0), (None, 0, 1), (9, None, None)], [(None, "a b c d e f"), (1, None)])


@pytest.fixture(scope="session")
def empty_tables(tmp_path_factory):
    return write(str(tmp_path_factory.mktemp("empty")), [], [], [], extra=False)
