"""The near_dedup stage on planted copies, against the similarity of all pairs of shingle sets."""
from __future__ import annotations

import random

import pytest

import corpus_pipeline
from lanestride.llm import near_copies, simhash


def shingles(text: str) -> set:
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def planted() -> list[tuple[int, str]]:
    """Texts of 300 words, with copies of which 0.5 to 6 % of the words are replaced."""
    rng = random.Random(12)
    texts = []
    for _ in range(30):
        base = [f"w{rng.randrange(5000)}" for _ in range(300)]
        texts.append(base)
        for share in (0.005, 0.01, 0.02, 0.06):
            texts.append([f"w{rng.randrange(5000)}" if rng.random() < share else w for w in base])
    return list(enumerate([" ".join(t) for t in texts] + ["", "one two", "one three", "ONE two"]))


@pytest.mark.parametrize("tile", [2, 4096])
def test_stage_keeps_one_of_each_component_of_similar_texts(spark, tile):
    rows = planted()
    sets = {d: shingles(t) for d, t in rows}
    alike = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for (a, b), similarity in alike.items():
        if similarity >= 0.8:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    assert sum(0.8 <= s < 0.96 for s in alike.values()) > 50 and sum(0.3 <= s < 0.8 for s in alike.values()) > 50
    docs = spark.createDataFrame([(d, t, "aa", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = near_copies.drop_near_copies(docs, tile_docs=tile) if tile < 4096 else corpus_pipeline.distinct_contents(spark, docs, "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({find(d) for d in sets})


def test_stage_compares_fingerprints_as_operator_5_does(spark, monkeypatch):
    rows = planted()
    docs = spark.createDataFrame([(d, t, "aa", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    seen = []
    real = simhash.fingerprint_links
    monkeypatch.setattr(simhash, "fingerprint_links", lambda prints, radius: seen.append(radius) or real(prints, radius))
    corpus_pipeline.distinct_contents(spark, docs, "").collect()
    assert seen == [simhash.RADIUS]
    prints = {d: simhash.fingerprint(t.encode(), near_copies.SHINGLE) for d, t in rows}
    keys = near_copies.banded(docs)
    assert {r.doc_id: r.fp % 2 ** 64 for r in keys.collect()} == prints
    links = {(r.doc_id, r.least) for r in near_copies.fingerprint_candidates(keys).collect()}
    close = {(a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= simhash.RADIUS}
    assert close

    def classes(pairs):
        root = {d: d for d in prints}
        for a, b in [*pairs] * len(prints):
            root[a] = root[b] = min(root[a], root[b])
        return root
    assert classes(links) == classes(close)
