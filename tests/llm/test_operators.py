"""Each operator against a brute-force version on a small fixture with the awkward cases in it."""
from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from lanestride.llm import (
    decontaminate,
    language,
    packing,
    pii,
    quality,
    radix_dedup,
    simhash,
    substring_dedup,
    token_rollup,
    url_filter,
)

WORDS = "alder birch cedar dogwood elm fir ginkgo hazel juniper larch maple oak pine rowan spruce willow".split()
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, keep_id long, fp long, block long, bin long, "
          "copy long, score double, stats string, host string, text_sha256 string, component_id long, tokens long")


def prose(rng: random.Random, words: int) -> str:
    return " ".join(rng.choice(WORDS) for _ in range(words))


def odd_texts() -> list[tuple[int, str | None]]:
    rng = random.Random(3)
    base = prose(rng, 400)
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a"), (6, prose(rng, 9)), (7, base), (8, base), (9, base.replace(" ", "\n\t", 40)),
           (10, base[:900] + " changed " + base[900:]), (11, prose(rng, 20) + " " + base[100:700]), (12, prose(rng, 30_000)),
           (13, "ÄÖÜ straße 東京 " + prose(rng, 40)), (14, "\x00\x01" + prose(rng, 12) + "\x7f"), (15, "!!! ??? 123 456"), (16, "x" * 400), (17, "x" * 90)]
    return out + [(7, base), (20, prose(rng, 120)), (40, base)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(d, t, "aa" if d % 2 else None, None if d == 6 else "s", None, 99, 99, 99, 99, 99, 0.5, "x", "h", "y", 99, 99) for d, t in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_exact_classes(odd, none):
    tidy = [(d, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for d, t in odd_texts()]
    classes = defaultdict(list)
    for d, t in tidy:
        classes[t].append(d)
    want = sorted((d, min(classes[t]), len(classes[t]), d == min(classes[t]), hashlib.sha256(t.encode()).hexdigest()) for d, t in tidy)
    assert sorted(map(tuple, radix_dedup.exact_duplicates(odd).collect())) == want
    assert radix_dedup.exact_duplicates(none).count() == 0
    kept = radix_dedup.drop_exact_duplicates(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {w[0] for w in want if w[3]}


def test_long_shared_prefixes_need_several_rounds(spark):
    stem = "p" * 20_000
    rows = [(1, stem + "a"), (2, stem + "b"), (3, stem + "a"), (4, stem), (5, stem[:64]), (6, stem[:64]), (7, stem[:63])]
    found = radix_dedup.radix_groups(spark.createDataFrame(rows, "doc_id long, content string"), "doc_id", "content")
    assert sorted(map(tuple, found.collect())) == [(1, 1, 2), (3, 1, 2), (5, 5, 2), (6, 5, 2)]


def components_by_force(prints: dict[int, int], radius: int) -> dict[int, int]:
    root = {d: d for d in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_fingerprint_bits():
    import xxhash
    text = "One two THREE four two"
    grams = ["one two three", "two three four", "three four two"]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > 3)
    assert simhash.fingerprint(text.encode()) == want
    assert simhash.fingerprint(b"Two words") == xxhash.xxh64_intdigest(b"two words", 42)
    assert simhash.fingerprint(b" \n") == 0


def test_near_components(odd, none):
    prints = {d: simhash.fingerprint((t or "").encode()) for d, t in odd_texts()}
    parts = components_by_force(prints, simhash.RADIUS)
    found = simhash.near_duplicates(odd).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in found) == sorted((d, f"{prints[d]:016x}", parts[d]) for d, _ in odd_texts())
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(odd).columns == odd.columns


@pytest.mark.parametrize("tile", [8, 4096])
def test_links_of_crowded_buckets(spark, tile):
    rng = random.Random(1)
    centre = rng.getrandbits(64)
    values = {centre}
    for _ in range(150):
        values.add(rng.choice(sorted(values)) ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(1, 5))))
    values |= {rng.getrandbits(64) for _ in range(100)}
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in signed], "fp long"), tile=tile).collect()
    root = {v: v for v in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in links:
        x, y = find(r.a), find(r.b)
        root[max(x, y)] = min(x, y)
    want = components_by_force({v: v & (1 << 64) - 1 for v in signed}, 3)
    assert {v: find(v) for v in signed} == want


def test_carry_save_counts():
    rng = np.random.default_rng(2)
    values = rng.integers(0, 1 << 63, 200, np.uint64)
    values[1] = values[0] ^ np.uint64(0b1011)
    for radius in (0, 1, 3, 6, 30):
        grid = np.unpackbits(simhash.within(values, simhash.planes_of(values), radius).view(np.uint8), axis=1, bitorder="little")[:, :200]
        assert (grid.astype(bool) == (np.bitwise_count(values[:, None] ^ values) <= radius)).all()


def test_url_rules(spark):
    urls = ["http://com/", "https://EXAMPLE.com/en/x?q#f", "http://www.example.com/en/", "http://a.b.net/es/1", "http://net/fr/", "http://net/fr",
            "http://notnet/es/", "http://example.com", "x", None, "", "http://", "a://b://c.com/", "http://example.com?/en/", "http://.net/es/", "http://com./", "http://é.com/ü/"]
    pages = spark.createDataFrame([(i, u, "z", "z") for i, u in enumerate(urls)] + [(0, urls[0], "z", "z")], "page_id long, url string, host string, verdict string")
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))

    def judged(i, u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        for v, h, p in rules:
            if host and (host == h or host.endswith("." + h)) and path.startswith(p):
                return i, host, path, h + p, v
        return i, host, path, None, "allow"
    want = [judged(i, u) for i, u in enumerate(urls)]
    got = url_filter.judge(pages, url_filter.rule_table(spark)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want + want[:1], key=str)
    assert url_filter.judge(pages.limit(0), url_filter.rule_table(spark)).count() == 0
    inside = url_filter.rule_table(spark, [("block", "com", "/a/b"), ("block", "com", "/a/b"), ("allow", None, "/")])
    some = spark.createDataFrame([(1, "http://x.com/a/bc"), (2, "http://x.com/a/c")], "page_id long, url string")
    assert {r.page_id: r.rule for r in url_filter.judge(some, inside).collect()} == {1: "com/a/b", 2: None}
    assert {r.page_id for r in url_filter.keep_allowed(some, inside).collect()} == {2}


def test_languages(spark, odd, none):
    rng = random.Random(5)
    tongues = {"aa": "lorem ipsum dolor sit amet".split(), "bb": "zweiz drejt vierk fumfz sexch".split()}
    rows = [(i, " ".join(rng.choice(tongues[k]) for _ in range(30)), k) for i in range(120) for k in [rng.choice(["aa", "bb"])]]
    rows += [(500, None, "aa"), (501, "123 !!", "bb"), (502, "", None), (503, "東京 都", None), (504, "Lorem IPSUM " * 3000, None)]
    found = {r.doc_id: r for r in language.predict_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(found[d].lang_pred == k for d, _, k in rows[:120]) and found[504].lang_pred == "aa"
    assert [found[d].lang_pred for d in (500, 501, 502)] == ["und"] * 3 and found[503].lang_pred in tongues
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 for d, r in found.items())
    assert language.predict_languages(none).count() == 0
    assert len(language.predict_languages(odd).collect()) == len(odd_texts())
    assert language.keep_known_languages(odd).columns == odd.columns
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language.predict_languages(unlabelled).first().lang_pred == "und"


def test_filter_holds_what_it_was_given():
    flat = np.frombuffer(b"some words to be found again", np.uint8)
    hashes, valid = language.grams(flat, np.array([0, len(flat)]))
    table = np.zeros(1 << 12, np.uint8)
    for at in language.probes(hashes, 1 << 12):
        table[at] |= 2
    assert (language.LanguageFilter(["x", "y"], table, np.zeros(2)).lookup(hashes) == 2).all()


def test_quality(spark, odd, none):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        good = rng.random() < 0.6
        rows.append((i, prose(rng, 60) + "." if good else " ".join(w + "###" for w in prose(rng, 60).split())))
        labels.append((i, int(good)))
    docs = spark.createDataFrame(rows + [(900, None), (901, "")], "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (901, None), (5, 0)], "doc_id long, quality int")
    found = {r.doc_id: r for r in quality.score_documents(docs, marks).collect()}
    assert len(found) == 602 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found.values())
    out = [found[i] for i, _ in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert out and all(r.held_out and r.predicted == labels[r.doc_id][1] for r in out)
    assert quality.score_documents(none, marks).count() == 0
    assert {r.score for r in quality.score_documents(odd, marks.limit(0)).collect()} == {0.5}


def test_statistics_do_not_depend_on_neighbours():
    texts = ["one two two\nthree", "", "A b c###", "é è", "\n\n", "two two"]
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    whole = quality.statistics(np.frombuffer(b"".join(raw), np.uint8), offsets)
    for i, r in enumerate(raw):
        assert np.allclose(whole[i], quality.statistics(np.frombuffer(r, np.uint8), np.array([0, len(r)]))[0])
    assert np.allclose(quality.pooled(np.array([0.1, 0.5, 0.3, 0.9]), np.ones(4)), [0.1, 0.4, 0.4, 0.9])


PATTERNS = [re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            re.compile(r"[0-9]([\x20-]?[0-9])+"), re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")]


def personal_by_force(text: str) -> list[tuple[int, int, int]]:
    out = []
    for k, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            digits = re.sub("[^0-9]", "", m.group())
            good = (k == 0 or k == 1 and all(int(p) <= 255 for p in m.group().split(".")) or k == 3 and 9 <= len(digits) <= 15
                    or k == 2 and 13 <= len(digits) <= 19 and sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0)
            if good:
                out.append((k, m.start(), m.end()))
    return out


def test_personal_data(spark, odd, none):
    rng = random.Random(8)
    bits = ["@", ".", "a.b@c.de", "1.2.3.4", "256.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111-1111 1111", "4111111111111112", "+1 (415) 555-0100", "+1", " ", "é", "x@y", "x@y@z.com",
            "00.1.02.3", "5", "-", "word", "4111111111111111 4111111111111111", "call", "version"]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randrange(1, 14))) for _ in range(400)] + [None, "", "9" * 5000, "a" * 3000 + "@", "1." * 2000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find_personal_data(rows).collect()}
    for i, t in enumerate(texts):
        base = sorted(personal_by_force(t or ""))
        told = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in base)
        assert found[i].base_sha256 == hashlib.sha256(told.encode()).hexdigest(), t
        assert set(filter(None, told.split(","))) <= set(filter(None, found[i].spans.split(",")))
        assert [found[i].n_email, found[i].n_ip, found[i].n_card, found[i].n_phone] == [sum(s[0] == k for s in base) for k in range(4)]
    assert pii.find_personal_data(none).count() == 0
    assert len(pii.find_personal_data(odd).collect()) == len(odd_texts())


def test_reliabilities_find_the_good_labelers():
    rng = np.random.default_rng(0)
    truth = rng.random(4000) < 0.4
    votes = np.stack([np.where(rng.random(4000) < p, truth, ~truth) * 2 - 1 for p in (0.95, 0.9, 0.85, 0.55)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    prior, table, _ = pii.reliabilities(patterns, counts.astype(float))
    assert abs(prior - 0.4) < 0.05 and table[1, 0, 2] > 0.9 > table[1, 3, 2]


def passages_by_force(docs, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def low(t):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)
    windows = defaultdict(set)
    for i, t in items:
        w = word.findall(low(t or ""))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(str(i))
    for d, t in docs:
        w, hit, found = word.findall(low(t or "")), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    found |= windows[tuple(w[k:k + size])]
        yield d, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_benchmark_passages(spark, odd, none, block):
    texts = dict(odd_texts())
    items = [(1, texts[7][200:420]), (2, texts[7][380:520]), (3, "Alder, birch!"), (4, None), (5, "..."), (10, texts[7][200:420].upper()), (11, "東京")]
    bench = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id long")
    once = {d: t for d, t in odd_texts()}
    docs = odd.dropDuplicates(["doc_id"])
    got = decontaminate.contamination(docs, bench, block_words=block).drop("spans").collect()
    assert sorted(map(tuple, got)) == sorted(passages_by_force(once.items(), items))
    assert decontaminate.contamination(none, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).where("contaminated").count() == 0
    clean = {r.doc_id: r.text for r in decontaminate.cut_passages(docs, bench).collect()}
    assert clean[13].startswith("ÄÖÜ straße  ") and len(clean[7]) < len(once[7])


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(4)
    text = rng.integers(0, 4, 3000)
    index = decontaminate.FMIndex(text)
    for size in (1, 3, 6):
        phrases = rng.integers(1, 4, (40, size))
        low, high = index.search(phrases, np.full(40, size))
        for p, a, b in zip(phrases, low, high, strict=True):
            want = [i for i in range(len(text) - size + 1) if (text[i:i + size] == p).all()]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def repeats_by_force(rows):
    first = {}
    for d, t in sorted(rows, key=lambda r: r[0]):
        raw = (t or "").encode()
        hit = np.zeros(len(raw), bool)
        for i in range(len(raw) - 49):
            if first.setdefault(raw[i:i + 50], d) < d:
                hit[i:i + 50] = True
        spans = int((hit & ~np.concatenate([[False], hit[:-1]])).sum()) if len(raw) else 0
        kept = bytes(np.frombuffer(raw, np.uint8)[~hit])
        yield d, len(raw), int(hit.sum()), spans, hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize(("bucket", "block"), [(8 << 20, 2 << 20), (20_000, 3_000)])
def test_repeated_strings(spark, odd, none, bucket, block):
    got = substring_dedup.remove_repeats(odd, bucket_bytes=bucket, block_bytes=block).collect()
    assert sorted(map(tuple, got)) == sorted(repeats_by_force(odd_texts()))
    assert substring_dedup.remove_repeats(none).count() == 0


def test_interval_expansion_finds_the_common_prefixes():
    rng = np.random.default_rng(9)
    for length in (3, 7, 20):
        text = np.append(rng.integers(1, 3, 900), 0)
        text[300:340] = text[500:540]
        order = substring_dedup.bounded_order(text, length)
        bound = substring_dedup.repeat_bounds(text, order, length)
        word = [tuple(text[i:i + length]) for i in order]
        assert [i == 0 or word[i] != word[i - 1] for i in range(len(word))] == bound.tolist()


def test_packing(odd, none):
    rows = packing.pack(odd, capacity=64).collect()
    encoder = packing.Encoder(packing.tokenizer_file())
    ids = sorted(encoder.encode([t or ""])[0] + b"\x02\0\0\0" for _, t in odd_texts())
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    assert sum(r.length for r in rows) == sum(len(x) // 4 for x in ids)
    assert len(by_sequence) <= 1.02 * -(-sum(r.length for r in rows) // 64) + 1
    texts = {d: encoder.encode([t or ""])[0] + b"\x02\0\0\0" for d, t in odd_texts()}
    for r in rows:
        assert zlib.crc32(texts[r.doc_id][4 * r.start:4 * (r.start + r.length)]) == r.ids_crc32
        assert r.length == 64 or r.piece == 0
    assert packing.pack(none).count() == 0


def test_units_give_the_tokenizer_ids():
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(packing.tokenizer_file())
    plain.encode_special_tokens = True
    rng = random.Random(2)
    bits = [" ", "  ", "\n", "\t", "\r\n", "a", "It's", "é", "12", "...", "<|endoftext|>", "\u00a0", "\u2003", "\x1c", "東京", "   x"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 25))) for _ in range(500)]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert packing.Encoder(packing.tokenizer_file(), cache_units=50).encode(texts) == want


def test_crossover_keeps_every_item():
    rng = random.Random(4)
    sizes = [rng.randrange(1, 60) for _ in range(300)]
    people = packing.evolve(sizes, 64, 1, [])
    for p in people:
        assert sorted(i for b in p.bins for i in b) == list(range(300)) and all(sum(sizes[i] for i in b) == f <= 64 for b, f in zip(p.bins, p.fill, strict=True))
    child = packing.crossover(people[0], people[-1], sizes, rng)
    assert sorted(i for b in child.bins for i in b) == list(range(300))


def test_token_rollup(spark, odd, none, tmp_path):
    rollup = token_rollup.TokenRollup(spark, str(tmp_path / "r"))
    columns = "op string, source string, lang string, tokenizer string, tokens long, old_source string, old_lang string, old_tokenizer string, old_tokens long"
    first = [("insert", "a", "x", "v1", 5, None, None, None, None), ("insert", "a", "x", "v1", 5, None, None, None, None), ("insert", None, None, "v1", None, None, None, None, None)]
    second = [("revise", "b", "x", "v2", 7, "a", "x", "v1", 5), ("delete", None, None, None, None, None, None, "v1", None)]
    assert rollup.totals().count() == 0
    assert rollup.commit("one", spark.createDataFrame(first, columns)) and not rollup.commit("one", spark.createDataFrame(first, columns))
    # an attempt that never finished does not count and is overwritten
    os.makedirs(tmp_path / "r" / "batch-two")
    (tmp_path / "r" / "batch-two" / "part-0.parquet").write_bytes(b"torn")
    assert {tuple(r) for r in rollup.totals().collect()} == {("a", "x", "v1", 2, 10), (None, None, "v1", 1, 0)}
    assert rollup.commit("two", spark.createDataFrame(second, columns))
    want = {("a", "x", "v1", 1, 5), ("b", "x", "v2", 1, 7)}
    assert {tuple(r) for r in rollup.totals().collect()} == want
    rollup.compact()
    assert {tuple(r) for r in rollup.totals().collect()} == want and not rollup.commit("two", spark.createDataFrame(second, columns))
    with pytest.raises(Exception, match="unknown op"):
        rollup.commit("bad", spark.createDataFrame([("x", *first[0][1:])], columns))
    encoder, left = packing.Encoder(packing.tokenizer_file()), {}
    for d, t in sorted(odd_texts(), key=lambda r: r[0]):
        left.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), d)
    rows = token_rollup.corpus_totals(odd.dropDuplicates(["doc_id"])).collect()
    assert sum(r.docs for r in rows) == len(left)
    assert sum(r.tokens for r in rows) == sum(len(b) // 4 for b in encoder.encode(list(left)))
    assert token_rollup.corpus_totals(none).count() == 0


def test_repeated_and_unnumbered_rows_stay_apart(spark):
    """Rows that repeat or lack a doc_id: classes, what is left of them, and the same result for any size of a block."""
    rows = [(7, "q"), (7, "q"), (None, "q"), (1, "other"), (1, "q  q"), (None, "alone"), (None, "alone"), (2, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in radix_dedup.exact_duplicates(docs).collect())
    want = [("7", "7", 3, True), ("7", "7", 3, True), ("None", "7", 3, False), ("1", "1", 1, True), ("1", "1", 1, True), ("None", "None", 2, True),
            ("None", "None", 2, False), ("2", "2", 2, True), ("None", "2", 2, False)]
    assert got == sorted(want)
    kept = radix_dedup.drop_exact_duplicates(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept if r.text) == [("1", "other"), ("1", "q  q"), ("7", "q"), ("None", "alone")] and len(kept) == 5
    phrase = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, phrase), (1, "clean"), (None, phrase), (None, "clean"), (None, "clean")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("a", phrase), ("b", "another item with words of its own, more than ten of them here"), ("c", "short one")], "item_id string, text string")
    found = [sorted(map(str, decontaminate.contamination(docs, benchmark, block_words=size).collect())) for size in (4, 12, 1 << 20)]
    assert len(found[0]) == 5 and found[0] == found[1] == found[2] and sum("contaminated=True" in r for r in found[0]) == 2


def test_rows_without_a_doc_id_keep_their_bytes(spark):
    text = "x" * 30 + "yz" * 30
    docs = spark.createDataFrame([(1, text), (None, text), (2, text), (None, None)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed) for r in substring_dedup.remove_repeats(docs).collect())
    assert got == [("1", 90, 0), ("2", 90, 90), ("None", 0, 0), ("None", 90, 0)]
