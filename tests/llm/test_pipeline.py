"""The pipeline against its stages' rules by brute force, on the smallest tables."""
from __future__ import annotations

import re

import corpus_pipeline
from lanestride.llm import packing
from lanestride.llm.simhash import LOWER
from tests.llm.test_operators import passages_by_force

SF = "/root/testdata/sf0.001"


def similar_by_force(docs: dict[int, str]) -> dict[int, int]:
    """The smallest document of each component of texts whose sets of 5-word shingles are similar by 0.8 or more."""
    sets = {}
    for d, t in docs.items():
        words = t.encode().translate(LOWER).split()
        sets[d] = {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}
    root = {d: d for d in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(docs)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in docs}


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "decontamination", "packing"]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    docs = {d: t for d, t in docs.items() if t and any(map(str.isalpha, t))}
    seen = set()
    for d in sorted(docs):
        tidy = re.sub(r"[\x20\x09-\x0D]+", " ", docs[d])
        if tidy in seen:
            del docs[d]
        seen.add(tidy)
    parts = similar_by_force(docs)
    assert sum(parts[d] != d for d in docs) > 0  # the tables hold near copies at all
    docs = {d: t for d, t in docs.items() if parts[d] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r[0] for r in passages_by_force(docs.items(), items) if not r[-1]}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in rows} == clean
    encoder = packing.Encoder(packing.tokenizer_file())
    assert sum(r.length for r in rows) == sum(len(encoder.encode([docs[d]])[0]) // 4 + 1 for d in clean)
