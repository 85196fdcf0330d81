"""The pipeline, stage by stage, against plain versions on the fixture tables."""

from collections import Counter, defaultdict

import brute
import corpus_pipeline as P

from evenline.llm import queries as Q
from evenline.llm.spool import spool


def test_stages_keep_columns_and_decide_as_told(spark, tables):
    path, rows, _, _ = tables
    docs = spark.read.parquet(path + "/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        docs = spool(stage(spark, docs, path), name)
        assert docs.columns == columns, name
        kept[name] = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    toxic = {r["doc_id"] for r in Q.op1_toxicity(spark, path).collect() if r["predicted"]}
    assert Counter(kept["toxicity"]) == Counter(r for r in rows if r[0] not in toxic)
    one = brute.components(kept["toxicity"])
    assert Counter(kept["near_duplicates"]) == Counter(r for r in kept["toxicity"] if one[r[0]][1] == r[0])
    leaks = {r["doc_id"] for r in Q.op2_decontamination(spark, path).collect()}
    assert Counter(kept["decontamination"]) == Counter(r for r in kept["near_duplicates"] if r[0] not in leaks)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in kept["decontamination"]:
        sizes[r[3]] += len(brute.words(r[1]))
    for r in kept["mixing"]:
        taken[r[3]] += len(brute.words(r[1]))
    want = brute.targets(sizes)
    lens = defaultdict(list)
    for r in kept["decontamination"]:
        lens[r[3]].append(len(brute.words(r[1])))
    assert all(abs(taken[s] - want[s]) <= brute.slack(lens[s], want[s]) for s in sizes)
    assert max(Counter(r[0] for r in kept["mixing"]).values()) <= 3
    last = P.token_output(spark, docs, path).collect()
    assert len(last) == len(kept["mixing"])
    at = 0
    for r in sorted(last, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]


def test_odd_and_empty_tables(spark, odd_tables, empty_tables):
    assert P.run(spark, empty_tables).count() == 0
    assert P.run(spark, odd_tables).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
