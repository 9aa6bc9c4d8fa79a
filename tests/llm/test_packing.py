"""Ids of words: plain ones by the tokenizer's model, all others by the whole tokenizer."""

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from floorlens.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


class NoRules:
    """A tokenizer that codes no text."""

    def __getattr__(self, name):
        raise AssertionError(f"{name} of the whole tokenizer was used")


def test_plain_words_need_no_rules():
    words, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    words.tokenizer = NoRules()
    texts = ["the straße, of ñandú###$$$ x", "Ciónraías. Stunger,", ""]
    bounds, ids = words.encode(pa.array(texts), 1)
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts]


def test_all_words_equal_the_tokenizer():
    words, plain = packing.WordIds(PATH), Tokenizer.from_file(PATH)
    odd = ["it's", "a's,", "'s", "foo<|", "foo<|endoftext|>", "x" * 5000, "á,", "a b", "Å≠", "9a", "a9", "a.b", "İx", "ΣΣ", "..."]
    odd += [f"{first}{chr(c)}{last}" for c in range(0x21, 0x300) for first in ("", "a", "é") for last in ("", "b", ",")]
    bounds, ids = words.encode(pa.array(odd), 1)
    for i, text in enumerate(odd):
        assert ids[bounds[i] : bounds[i + 1]].tolist() == [*plain.encode(text, add_special_tokens=False).ids, 1], repr(text)


def test_other_rules_leave_all_words_to_the_tokenizer():
    words = packing.WordIds(PATH)
    words.rules = [None, None]
    calls, whole = [], words._others
    words._others = lambda given: calls.extend(given) or whole(given)
    assert words._make(["plain", "it's"])[0].tolist() == packing.WordIds(PATH)._make(["plain", "it's"])[0].tolist()
    assert calls == ["plain", "it's"]
