import random

import numpy as np
import public_tokenizers
import pytest

from tradewind.llm import tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
COMMON = ["river", "stone", "ÉTÉ", "forêt"]


class Counting:
    """A tokenizer, and its own model, that notes what goes through the model."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model, self.seen = tokenizer, self, []

    def tokenize(self, word):
        self.seen.append(word)
        return self.tokenizer.model.tokenize(word)

    def encode(self, text, **options):
        return self.tokenizer.encode(text, **options)


@pytest.fixture
def encoder():
    encoder = tokens.Encoder(PATH)
    encoder.tokenizer = Counting(encoder.tokenizer)
    return encoder


def same_as_library(encoder, text):
    (found,) = encoder.encode([text])
    return np.frombuffer(found, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_met_again_outlast_those_met_once(encoder, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 40_000)
    draw = random.Random(7)
    for _ in range(40):
        once = ["".join(draw.choice("abcdefgh") for _ in range(12)) for _ in range(60)]
        assert same_as_library(encoder, " ".join(COMMON + once))
        assert len(encoder.chunks) < 400
    assert encoder.tokenizer.seen.count("river") == 1


def test_case_and_marks_take_no_memory_of_their_own(encoder):
    marks = ["", ".", ",", ";", "!", "?!", "(", ")]", "...", "-"]
    forms = [f(w) + m for w in COMMON for f in (str.lower, str.upper, str.title) for m in marks]
    assert same_as_library(encoder, " ".join(forms))
    assert len(encoder.chunks) <= len(COMMON) + len(marks)
    assert len(encoder.tokenizer.seen) == len(set(encoder.tokenizer.seen))


@pytest.mark.parametrize("text", ["a.b. c", ".a", "...", "a" * 99 + ".", "A" * 100, "A" * 101, "B" * 150 + " bb", "-" * 101, "ßÀ--.", "日本. a日. 日a", "<|endoftext|> <|ENDOFTEXT|>", "H̱ ẖ", "ªº µ µA"])
def test_words_marks_and_what_is_neither(encoder, text):
    assert same_as_library(encoder, text) and same_as_library(encoder, f"{text}\n{text} {text}")
    assert max(map(len, encoder.chunks)) <= tokens.LONGEST_REMEMBERED
