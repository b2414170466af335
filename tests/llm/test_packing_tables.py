"""The packing tokenizer's tables: what is used again is not encoded again, and they stay within their bound."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import regex

from factloom.llm import packing


class Counting:
    def __init__(self, model):
        self.model, self.seen = model, []

    def tokenize(self, word: str):
        self.seen.append(word)
        return self.model.tokenize(word)


def test_words_in_use_outlive_a_full_table():
    coder, r = packing.ChunkTokenizer(public_tokenizers.path(packing.TOKENIZER), 200), random.Random(5)
    coder.model = model = Counting(coder.model)
    common = ["often", "Often", "often,", "été"]
    for _ in range(40):
        rare = ["".join(r.choice("abcdefgh") for _ in range(9)) for _ in range(60)]
        texts = [" ".join(common + rare)]
        (ids,) = coder.encode(texts)
        assert np.frombuffer(ids, "<u4").tolist() == coder.tokenizer.encode(texts[0], add_special_tokens=False).ids
        assert len(coder.ids) + len(coder.older) <= 2 * (200 + 2 * len(texts[0].split()))
    assert model.seen.count("often") == 1 and len(model.seen) < 40 * 60 + 5


def test_plain_words_are_the_vocabularys():
    rule = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")
    every, r = [chr(c) for c in range(0x21, 0x180) if packing.PLAIN_LINES.fullmatch(chr(c))], random.Random(6)
    assert len(every) == 94 + 0x180 - 0xA1 - 1
    coder = packing.ChunkTokenizer(public_tokenizers.path(packing.TOKENIZER))
    for _ in range(3000):
        text = "".join(r.choice([*every, *"''''stdmlver\n\n  "]) for _ in range(r.randint(0, 12)))
        line = text.replace(" ", "").lower()
        assert packing.WORDS.findall(line) == rule.findall(line)
        (ids,) = coder.encode([text])
        assert np.frombuffer(ids, "<u4").tolist() == coder.tokenizer.encode(text, add_special_tokens=False).ids, text
