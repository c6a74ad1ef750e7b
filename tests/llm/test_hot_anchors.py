"""A phrase in ever different surroundings must not put all its segments into one task."""
from __future__ import annotations

import random

import numpy as np

from lanestride.llm import substring_dedup
from tests.llm.test_operators import repeats_by_force

PHRASE = "Posted by the staff writer of the day "


def noise(rng: random.Random, size: int) -> str:
    return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(size))


def test_one_phrase_in_many_contexts(spark):
    rng = random.Random(11)
    rows = [(i, noise(rng, 40) + PHRASE + noise(rng, 40)) for i in range(400)]
    rows += [(1000 + i, noise(rng, 30) + rows[i][1][20:75 + i] + noise(rng, 30)) for i in range(20)] + [(2000, None), (2001, PHRASE * 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(repeats_by_force(rows))
    assert sum(w[2] for w in want) > 1000
    assert sorted(map(tuple, substring_dedup.remove_repeats(docs, block_bytes=4000, bucket_bytes=4000, hot_segments=50).collect())) == want
    blocks = substring_dedup.text_blocks(docs, 4000)
    largest = []
    for bound in (1 << 30, 50):
        met, hot = substring_dedup.announced(blocks, 12, bound)
        assert (len(hot) > 0) == (bound == 50)
        sent = substring_dedup.candidate_segments(blocks, met, 12, hot).selectExpr("bucket", "length(counts) n").groupBy("bucket").sum("n").collect()
        largest.append(max(r[1] for r in sent))
    assert largest[0] > 300 and largest[1] <= 50
    assert (np.diff(hot) > 0).all()
