"""Repeated strings: further anchor levels and sorting rounds look only at what is open, with the same results."""
from __future__ import annotations

import numpy as np

from lanestride.llm import substring_dedup as S


def test_further_levels_read_only_the_strings_of_hot_anchors(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = np.array([30_000, 0, 49, 50, 400, 120_000])
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    flat = rng.integers(97, 123, offsets[-1]).astype(np.uint8)
    plain = S.segments(flat, offsets, S.NOT_HOT)
    assert not len(plain[1][0]) and not len(plain[2][0])
    read, anchored = [0] * len(S.ANCHORS), S.anchored

    def counted(here, starts, level, *rest):
        read[level] += len(here)
        return anchored(here, starts, level, *rest)

    monkeypatch.setattr(S, "anchored", counted)
    hot = np.sort(plain[0][2][::300])
    runs = S.segments(flat, offsets, hot)
    hot = np.sort(np.concatenate([hot, runs[1][2][::2]]))
    read[:] = [0] * len(read)
    runs = S.segments(flat, offsets, hot)
    assert all(len(first) for first, _, _ in runs)
    assert read[1] < read[0] / 20 and read[2] < read[0] / 20
    valid = {int(i) for a, b in zip(offsets[:-1], offsets[1:], strict=True) for i in range(a, b - S.LENGTH + 1)}
    open_starts = sorted(valid)
    for level, (first, count, value) in enumerate(runs):
        starts = S.spread(first, count)
        assert starts.tolist() == open_starts
        assert set((value & np.uint64(3)).tolist()) == {level}
        apart = S.among(value, hot)
        open_starts = S.spread(first[apart], count[apart]).tolist()
        for i in range(0, len(starts), max(1, len(starts) // 50)):  # a string by itself has the anchor that it has in a text
            alone = flat[starts[i]:starts[i] + S.LENGTH]
            assert anchored(alone, np.zeros(1, np.int64), level)[2][0] == np.repeat(value, count)[i]


def test_order_and_expansion_over_wide_alphabets():
    rng = np.random.default_rng(5)
    for length, letters in [(1, 3), (4, 2), (16, 2), (50, 4), (50, 250)]:
        text = np.append(rng.integers(1, letters + 1, 1500), 0)
        text[300:390] = text[700:790]
        text[900:960] = text[310:370]
        order = S.bounded_order(text, length)
        word = [tuple(text[i:i + length]) for i in order]
        assert sorted(order.tolist()) == list(range(len(text))) and word == sorted(word)
        assert S.repeat_bounds(text, order, length).tolist() == [i == 0 or word[i] != word[i - 1] for i in range(len(word))]


def test_later_rounds_sort_only_places_that_share_their_span(monkeypatch):
    text = np.append(np.random.default_rng(8).integers(1, 200, 20_000), 0)
    text[4000:4100] = text[9000:9100]
    sorted_places, rounds = S.sorted_places, []
    monkeypatch.setattr(S, "sorted_places", lambda key, bits: rounds.append(len(key)) or sorted_places(key, bits))
    S.bounded_order(text, 50)
    assert rounds[0] == len(text) and len(rounds) > 2 and max(rounds[1:]) < 1000
