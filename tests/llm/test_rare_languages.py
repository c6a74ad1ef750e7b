"""Language filter with many labels, rare labels and none."""
from __future__ import annotations

import random

from lanestride.llm import language


def words_of(seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(6)]


def test_seventy_labels(spark):
    rng = random.Random(1)
    rows = [(70 * i + k, " ".join(rng.choice(words_of(k)) for _ in range(20)), f"l{k:02d}") for i in range(12) for k in range(70)]
    found = {r.doc_id: r.lang_pred for r in language.predict_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert found == {d: k for d, _, k in rows}


def thai(rng: random.Random, words: list[str]) -> str:
    return " ".join(rng.choice(words) for _ in range(30))


def test_stage_keeps_what_nothing_speaks_against(spark):
    rng = random.Random(4)
    common, junk = words_of(900), [words_of(1000 + i) for i in range(3)]
    siamese = ["".join(chr(rng.randrange(0xE01, 0xE2F)) for _ in range(5)) for _ in range(8)]
    greek = ["".join(chr(rng.randrange(0x3B1, 0x3CA)) for _ in range(6)) for _ in range(8)]
    rows = [(i, " ".join(rng.choice(common) for _ in range(30)), "aa") for i in range(80)]
    rows += [(100, thai(rng, siamese), "th"), (101, thai(rng, siamese), None), (102, thai(rng, greek), None), (103, "12 34 !!", None), (104, None, "aa")]
    rows += [(200 + i, " ".join(rng.choice(words) for _ in range(40)), None) for i, words in enumerate(junk)]
    schema = "doc_id long, text string, lang string"
    kept = {r.doc_id for r in language.keep_known_languages(spark.createDataFrame(rows, schema)).collect()}
    assert kept == {*range(80), 100, 101, 102}
    unlabelled = spark.createDataFrame([(d, t, None) for d, t, _ in rows], schema)
    assert {r.doc_id for r in language.keep_known_languages(unlabelled).collect()} == {d for d, _, _ in rows} - {103, 104}


def test_one_document_teaches_a_language(spark):
    rng = random.Random(6)
    siamese = ["".join(chr(rng.randrange(0xE01, 0xE2F)) for _ in range(5)) for _ in range(8)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(words_of(900)) for _ in range(30)), "aa") for i in range(40)] + [(100, thai(rng, siamese), "th")], "doc_id long, text string, lang string")
    other = spark.createDataFrame([(1, thai(rng, siamese))], "doc_id long, text string")
    assert language.identify(other, language.fit_languages(docs)).first().lang_pred == "th"
