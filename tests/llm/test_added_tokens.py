"""Ids of op1 and op6 against an unmodified tokenizer, on texts that hold its added token."""
from __future__ import annotations

import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from lanestride.llm import packing, token_rollup


def test_ids_are_those_of_the_unmodified_tokenizer(spark):
    plain = Tokenizer.from_file(packing.tokenizer_file())
    rng = random.Random(3)
    bits = ["<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", " ", "  ", "\n", "a", "It's", "é", "12", "東京", " two"]
    texts = ["one <|endoftext|> two", "<|endoftext|>", "<|endoftext|><|endoftext|> "] + ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 25))) for _ in range(300)]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert want[0] == np.array([505, 220, 50256, 734], "<u4").tobytes()
    assert packing.encoder_of(packing.tokenizer_file()).encode(texts) == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.length, r.ids_crc32) for r in packing.pack(docs).collect()}
    assert found == {i: (len(w) // 4 + 1, zlib.crc32(w + b"\x02\0\0\0")) for i, w in enumerate(want)}
    counts = token_rollup.token_counts(docs, {"text": "tokens"}).collect()
    assert {r.doc_id: r.tokens for r in counts} == {i: len(w) // 4 for i, w in enumerate(want)}
