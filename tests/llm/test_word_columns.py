"""The word encoder works on columns of bytes and gives the library's ids for any bytes."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ticketgrain.llm.word_bpe import WordEncoder

WORD = public_tokenizers.path("word_bpe_49k.json")
PARTS = (
    *"aBzéÉ×÷ßÿŸÀÞıİ'!-_~09@[`{/: \n\t\r\x0b\x0c", "\x7f", "\x00", "\x1c", "\x85", "\xa0", "​", "́", "̸",
    "'s", "Ã", "中", "ﬁ", "ſ", "😀", "<|endoftext|>",
)


class Uncut(bytes):
    def split(self, *_):
        raise AssertionError("every word of the text becomes a Python object")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


def test_texts_are_not_cut_into_python_words(library):
    texts = ["one Word, and one word more: éÉ one.", "", " \n", "one"]
    found = WordEncoder(WORD).encode([Uncut(t.encode()) for t in texts])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]


def test_odd_bytes_and_a_full_memo(library):
    rng = random.Random(8)
    encoder = WordEncoder(WORD, entries=50)
    for _ in range(400):
        texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))).encode() for _ in range(rng.randint(0, 5))]
        texts = [t + bytes(rng.choices(b"\xc3\x9f\xbf\xff a\xe9A", k=rng.randint(0, 4))) for t in texts]
        expected = [library.encode(t.decode("utf-8", "replace"), add_special_tokens=False).ids for t in texts]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in encoder.encode(texts)] == expected
