"""The whole pipeline, stage by stage, on the smallest given tables."""

from collections import defaultdict

import corpus_pipeline
from ledgerlake.llm import mixing, quality
from test_documents import shingles

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_takes_effect(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    given, kept = rows, {}
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, rows, FOLDER).cache()
        kept[name] = rows
        if name != "packing":
            assert rows.columns == given.columns
    good = {r.doc_id for r in quality.judged(given, labels).where("kept").collect()}
    texts = {r.doc_id: r.text for r in given.collect()}
    assert {r.doc_id for r in kept["quality"].collect()} == good
    last = {}
    for i in sorted(good):
        last[texts[i]] = i
    single = set(last.values())
    assert {r.doc_id for r in kept["exact_dedup"].collect()} == single
    sets = {i: shingles(texts[i], 5) for i in single}
    links = defaultdict(set)
    for a in single:
        for b in single:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    links[a].add(b)
                    links[b].add(a)
    gone, seen = set(), set()
    for a in sorted(single):
        todo = [a] if a not in seen else []
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                gone |= {x} - {a}
                todo += links[x]
    assert {r.doc_id for r in kept["near_dedup"].collect()} == single - gone
    copies = {r.doc_id: r.copies for r in mixing.plan(kept["near_dedup"]).collect()}
    found = defaultdict(int)
    for r in kept["mixing"].collect():
        found[r.doc_id] += 1
    assert dict(found) == {i: c for i, c in copies.items() if c}
    packed = defaultdict(int)
    for r in kept["packing"].where("piece = 0").collect():
        packed[r.doc_id] += 1
    assert packed == found
    assert corpus_pipeline.ORACLE_SQL is None
