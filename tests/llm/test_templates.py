"""Operator 2 against a plain matcher, and the cases that template windows of one width would miss."""

import random
import re

import pytest

from evenline.llm import templates as T

NUM, NAME, UNIT = 1, 2, 3


def plain_tokens(text):
    """(folded word, kind, may open a sentence as a name)."""
    out, end = [], 0
    for m in re.finditer(r"[^\x20\t-\r]+", text or ""):
        w = m.group()
        core = re.sub(r"^[^A-Za-z0-9\x80-\U0010ffff]+|[^A-Za-z0-9\x80-\U0010ffff]+$", "", w)
        if not core:
            continue
        start = m.start() + w.index(core)
        opens = not out or re.search(r"[.!?\n]", text[end:start]) is not None
        end = start + len(core)
        low = "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else c for c in core)
        number = low in T.NUMBERS or re.fullmatch(r"[\x21-\x7e]+", core) is not None and re.fullmatch(r"[^A-Za-z]*", core) is not None and re.search("[0-9]", core) is not None
        unit = bool(out) and out[-1][1] == NUM and low in T.UNITS or not number and core[0] in "0123456789"
        capital = "A" <= core[0] <= "Z" or "À" <= core[0] <= "Þ" and core[0] != "×"
        kind = NUM if number else UNIT if unit else NAME if capital and not opens else 0
        out.append((low, kind, capital and opens and kind == 0))
    return out


def plain_windows(toks, widths, main, only_short):
    out = []
    for width in widths:
        if width != main and only_short and len(toks) != width:
            continue
        for i in range(len(toks) - width + 1):
            span = toks[i:i + width]
            bare = all(k == 0 for _, k, _ in span)
            out.append(((width, tuple(w for w, _, _ in span)), i, T.ONLY_WORDS if bare else T.VERBATIM, ()))
            for how in (T.AS_WORDS, T.AS_NAMES):
                kinds = [NAME if how == T.AS_NAMES and m else k for _, k, m in toks]
                j = i + width
                while width == main and j < len(toks) and sum(1 if k else 4 for k in kinds[i:j]) < T.MIN_WEIGHT:
                    j += 1
                weight, words = sum(1 if k else 4 for k in kinds[i:j]), sum(k == 0 for k in kinds[i:j])
                if not any(kinds[i:j]) or (weight < T.MIN_WEIGHT if width == main else words < min(T.MIN_LITERALS, width)) or how == T.AS_NAMES and not any(m for _, _, m in toks[i:j]):
                    continue
                out.append((("t", tuple(k or w for (w, _, _), k in zip(toks[i:j], kinds[i:j]))), i, how, tuple(w for (w, _, _), k in zip(toks[i:j], kinds[i:j]) if k)))
    return out


def plain_matches(docs, items, main=8, least=4, coverage=0.4):
    found = {}
    lengths = {len(plain_tokens(t)) for _, t in items}
    widths = [main, *sorted(n for n in lengths if least <= n < main)]
    for k, item in items:
        have = plain_windows(plain_tokens(item), widths, main, True)
        places, can = {p for _, p, _, _ in have}, {p for _, p, how, _ in have if how != T.VERBATIM}
        for d, text in docs:
            units = {}
            for h, p, how, slots in plain_windows(plain_tokens(text), widths, main, False):
                for h2, p2, how2, slots2 in have:
                    if h == h2:
                        at, pairs = units.setdefault((p - p2, how == T.AS_NAMES, how2 == T.AS_NAMES), (set(), set()))
                        at.add(p2)
                        pairs.update(zip(slots2, slots))
            units = [(at, pairs) for at, pairs in units.values() if len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)]
            merged = {}
            for at, pairs in units:
                merged.setdefault(frozenset(pairs), set()).update(at)
            best = 0.0
            for seed in merged:
                for order in (sorted(merged, key=lambda u: -len(merged[u])),):
                    there, back, got = {}, {}, set()
                    for u in [seed, *order]:
                        if any(there.get(a, b) != b or back.get(b, a) != a for a, b in u):
                            continue
                        there.update(u)
                        back.update((b, a) for a, b in u)
                        got |= merged[u]
                    best = max(best, len(got) / len(places), len(got & can) / len(can) if can else 0.0)
            if best >= coverage:
                found[d, k] = best
    return found


def run(spark, docs, items):
    got = T.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    return {(r["doc_id"], r["item_id"]): r for r in got.collect()}


DENSE = "Anna 5 kg, Ben 7 kg, Carl 9 kg, Dora 11 kg, Emil 13 kg, Fay 15 kg, Gus 17 kg of plums"
DENSE_NEW = "Hugo 21 kg, Ida 22 kg, Jan 23 kg, Kim 24 kg, Lea 25 kg, Max 26 kg, Nia 27 kg of plums"
OPENS = "Marta has 12 apples and eats 5 daily"
PROBLEM = ("Marta bakes 12 loaves every morning and sells them at the market in Ulm for 3 euros each. Peter, her brother, buys 4 of them on the "
           "first day of June and gives the rest to a school near the river")
PROBLEM_NEW = ("Sonia bakes 35 loaves every morning and sells them at the market in Bonn for 9 euros each. Aron, her brother, buys 7 of them on the "
               "first day of March and gives the rest to a school near the river")


def test_names_first_dense_slots_and_long_rulers(spark):
    ruler = "-" * 500
    docs = [(1, DENSE_NEW), (2, f"she wrote {DENSE_NEW} again"), (3, OPENS.replace("Marta", "Sonia").replace("12", "14").replace("5", "6")), (4, "here Sonia has 14 apples and eats 6 daily"),
            (5, PROBLEM_NEW), (6, f"{ruler}\nold {PROBLEM_NEW} {ruler} new"), (7, PROBLEM.replace(" sells", f" {ruler} sells")), (8, re.sub("2[0-9]", "21", DENSE_NEW))]
    got = run(spark, docs, [(1, DENSE), (2, OPENS), (3, PROBLEM)])
    assert set(got) == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, 3), (7, 3)}, "8 gives seven item values one value"
    assert got[5, 3]["coverage"] > 0.9 and got[7, 3]["kind"] == "copy" and got[4, 2]["changed"] == 3


def test_shuffled_items_are_not_found(spark):
    rnd, docs = random.Random(2), []
    for k in range(40):
        w = rnd.choice([DENSE, PROBLEM, OPENS]).split()
        rnd.shuffle(w)
        docs.append((k, " ".join(w)))
    assert run(spark, docs, [(1, DENSE), (2, OPENS), (3, PROBLEM)]) == {}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equal_to_a_plain_matcher(spark, seed):
    rnd = random.Random(seed)
    words = ["the", "of", "boats", "sold", "near", "Anna", "Ben", "Zoë", "kg", "12", "7", "3.5", "days", "Élan", "twenty", "5km", "--", "(so)", "Then", "bread", "and"]
    items = []
    for k in range(12):
        w = [rnd.choice(words) + rnd.choice(["", "", "", ",", "."]) for _ in range(rnd.choice([3, 5, 8, 14, 30]))]
        items.append((k, " ".join(w)))
    items += [(90, None), (91, ""), (92, items[0][1])]
    docs = []
    for d in range(60):
        t = rnd.choice(items[:12])[1]
        swap = {a: b for a, b in zip(["Anna", "Ben", "12", "7", "kg"], rnd.choice([["Ida", "Jan", "40", "41", "km"], ["Ben", "Anna", "12", "7", "kg"], ["Ida", "Ida", "40", "40", "kg"]]))}
        t = re.sub(r"\b(Anna|Ben|12|7|kg)\b", lambda m: swap[m.group()], t) if rnd.random() < 0.7 else t
        docs.append((d, rnd.choice(["", "so ", "Old bread. "]) + t + rnd.choice(["", " and " + rnd.choice(items[:12])[1]])))
    docs += [(100, None), (101, ""), (102, "!!!"), (103, "x " * 3000)]
    got, want = run(spark, docs, items), plain_matches([d for d in docs if d[1] is not None], [i for i in items if i[1]])
    assert set(got) == set(want) and len(want) > 30
