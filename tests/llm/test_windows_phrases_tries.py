"""Repeated windows, collocations and the conversation trie against brute force, with small bounds on every path."""
from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from lanestride.llm import collocations, prefix_trie, window_dedup, words
from tests.llm.test_operators import SCHEMA, odd_texts

TINY = [{}, {"hot": 3, "block_bytes": 600, "bucket_bytes": 2000}, {"hot": 0, "block_bytes": 1, "bucket_bytes": 1 << 30}]


def word_rows() -> list[tuple[int | None, str | None]]:
    """The odd texts, a frequent phrase in ever different surroundings, shared passages, and rows that repeat or lack a doc_id."""
    rng = random.Random(8)
    fresh = lambda n: " ".join(f"v{rng.randrange(900)}" for _ in range(n))
    passage, phrase = fresh(60), fresh(6)
    rows = [*odd_texts(), *((100 + i, f"{fresh(20)} {phrase}\t{fresh(15)}") for i in range(40))]
    rows += [(200 + i, f"{fresh(rng.randrange(30))}\n {passage} {fresh(rng.randrange(30))}") for i in range(12)]
    rows += [(300, passage + " " + passage), (301, " ".join(["again"] * 40)), (302, "é" + " again" * 14), (200, fresh(5) + " " + passage), (201, passage), (201, passage)]
    return [*rows, (None, passage), (None, None), (303, " ".join(passage.split()[:13])), (304, " ".join(passage.split()[1:13]))]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(d, t, "aa", "s", None, 99, 99, 99, 99, 99, 0.5, "x", "h", "y", 99, 99) for d, t in word_rows()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def kept_by_force(rows, window=13):
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    least: dict[tuple, int] = {}
    for d, w in split:
        for i in range(len(w) - window + 1):
            if d is not None:
                least[tuple(w[i:i + window])] = min(d, least.get(tuple(w[i:i + window]), d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and least[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("bounds", TINY)
def test_repeated_windows(spark, texts, bounds):
    want = kept_by_force(word_rows())
    got = window_dedup.remove_repeated_windows(texts, with_text=True, **bounds).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(w[2] for w in want) and {w[2] for w in want if w[0] in (303, 304)} == {0, 13}
    assert window_dedup.remove_repeated_windows(texts.limit(0), **bounds).count() == 0


def test_windows_of_other_lengths(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(12)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for window, minimiser in ((1, 1), (2, 1), (5, 3), (7, 7)):
        got = window_dedup.remove_repeated_windows(docs, window, minimiser, block_bytes=40, bucket_bytes=100, hot=5).collect()
        assert sorted(map(tuple, got)) == sorted(w[:4] for w in kept_by_force(rows, window))


def test_window_names_are_exact():
    code = np.random.default_rng(1).integers(0, 3, 500)
    for window in (1, 2, 3, 13, 16):
        name = window_dedup.window_names(code, window)
        spans = [tuple(code[i:i + window]) for i in range(len(code) - window + 1)]
        assert len(name) == len(spans) and len(set(zip(name.tolist(), spans, strict=True))) == len(set(spans)) == len(set(name.tolist()))


def test_words_of_texts():
    texts = [b"", b" ", b"a", b"b c", b"\t\xc3\xa9  b\n", b"b"]
    offsets = np.cumsum([0, *map(len, texts)])
    found = words.Words(np.frombuffer(b"".join(texts), np.uint8), offsets, window_dedup.GAPS)
    assert found.first.tolist() == [0, 0, 0, 1, 3, 5, 6] and found.flat.tobytes() == b"a b c \xc3\xa9 b b "
    assert found.code[1] == found.code[4] == found.code[5] and len(set(found.code.tolist())) == found.size == 4
    assert len(words.Words(np.zeros(0, np.uint8), np.array([0]), window_dedup.GAPS)) == 0


def phrases_by_force(rows, most, least, top):
    """Each language's best phrases, counted word by word."""
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            for i in range(len(w)):
                for k in range(1, min(most, len(w) - i) + 1):
                    f[lang or "und"][tuple(w[i:i + k])] += 1
    out = []
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        scored = []
        for p, a in often.items():
            if any(len(q) > len(p) and a <= b and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in often.items()):
                continue
            score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:top])]
    return out


@pytest.mark.parametrize("bounds", TINY)
def test_collocations(spark, bounds):
    rng = random.Random(9)
    draw = lambda: rng.choice(["on", "the", "The", "old", "mill", "é", "x,", "y", "a\tb", "end.", "new york city", "new york"])
    rows = [(rng.choice(["aa", "bb", None]), " ".join(draw() for _ in range(rng.randrange(60)))) for _ in range(120)]
    rows += [("cc", None), ("cc", ""), ("aa", "the " * 30), ("zz z", "one two\none two, one two")] + [(lang, t) for lang, (_, t) in zip("abcde", odd_texts(), strict=False)]
    docs = spark.createDataFrame([(i, t, lang, "phrase", 5, "n", "a", 1) for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, words long, phrase string, n string, k long")
    for most, least, top in ((5, 4, 2000), (3, 2, 7)):
        got = collocations.collocations(docs, most=most, least=least, top=top, **bounds)
        assert sorted(map(tuple, got.collect())) == sorted(phrases_by_force(rows, most, least, top))
    assert collocations.collocations(docs.limit(0), **bounds).count() == 0
    assert collocations.collocations(docs.where("doc_id < 3"), least=10_000, **bounds).count() == 0


def test_scores_pass_64_bits(spark):
    docs = spark.createDataFrame([(i, "aa", "p q") for i in range(4)], "doc_id long, lang string, text string")
    found = collocations.collocations(docs, least=1, scale=10 ** 17).collect()
    assert [(r.phrase, r.score) for r in found] == [("p q", 10 ** 17 * 4 * 8 // 16)]


def trie_by_force(rows, share=100, most=6):
    """Nodes by the prefixes of every rebuilt conversation."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append((turn is not None, turn or 0, digest, (role, text)))
    turns = {c: [x[-1] for x in sorted(t)] for c, t in turns.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = tuple(turns.get(c - int(math.fmod(c, share)), [])[:h] + own[h:])
    members = defaultdict(list)
    for c, t in built.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)

    def sums(p):
        below = [sums(k) for k in kids[p]]
        own = (len(members[p]) - 1) * len(p[-1][1]) if p else 0
        return sum(b[0] for b in below) or 1, own + sum(b[1] for b in below)
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(built[c]) == len(p)))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), *sums(p), hashlib.sha256(ends.encode()).hexdigest()))
    return out


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


@pytest.mark.parametrize("columns", [1, 2, 8])
def test_conversation_trie(spark, columns):
    rng = random.Random(3)
    rows = []
    for c in [*range(0, 14), *range(100, 112), *range(205, 215), 1000, 1001, -7]:
        stem = rng.choice(["long", "short", "own"])
        for t in range(rng.randrange(1, 8) if stem != "long" else 11):
            rows.append((c, t, rng.choice(["user", "assistant"]) if stem == "own" else "user", stem + "é" * t if rng.random() < 0.95 else None))
    rows += [(3, None, "late", "first"), (3, 1, "user", "tie"), (3, 1, "user", "tie"), (4, 2, None, None), (None, 1, "user", "x")]
    frame = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, key string, level long, seq long").repartition(3)
    got = prefix_trie.trie_nodes(frame, columns).select(*COLUMNS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, trie_by_force(rows)))
    if columns == 8:
        assert prefix_trie.trie_nodes(frame.limit(0)).count() == 0
        assert prefix_trie.trie_nodes(frame.where("conv_id is null")).count() == 0


def test_conversations_that_are_left_without_turns(spark):
    rows = [(c, 0, "user", "only") for c in range(5, 11)]  # conversation 0 is absent
    got = prefix_trie.trie_nodes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).select(*COLUMNS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, trie_by_force(rows)))
    assert any(r.depth == 0 and r.ends_sha256 != prefix_trie.NO_ENDS for r in got)
